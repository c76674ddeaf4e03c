import random
import re

import pytest

import rowloom.llm.licenses as L
from conftest import DATA
from rowloom.llm.queries import QUERIES

DOCS = "doc_id long, text string, key string, words string"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def base(text):
    w, places, labels = words(text), [], set()
    for p in L.PHRASES:
        v = p.words()
        at = [i for i in range(len(w) - len(v) + 1) if w[i : i + len(v)] == v]
        places += at
        labels |= {p.label} if at else set()
    return len(w), len(places), min(places, default=None), max(places, default=None), sorted(labels)


def found(spark, rows):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], DOCS)
    return L.scan_licenses(df).collect()


def test_phrases_against_brute_force(spark):
    rng = random.Random(6)
    parts = "gnu general public license apache CC by mit License, é x".split()
    rows = [(i, " ".join(rng.choice(parts) for _ in range(rng.randrange(0, 60)))) for i in range(60)]
    rows += [(100, None), (101, ""), (None, "MIT-License"), (102, "cc by " * 30_000), (5, rows[5][1]), (103, "mit license " * 2)]
    got = [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, list(r.base_labels)) for r in found(spark, rows)]
    assert sorted(got, key=repr) == sorted(((i, *base(t)) for i, t in rows), key=repr)
    assert found(spark, []) == []


@pytest.mark.parametrize("notice", range(len(L.NOTICES)))
def test_notices(spark, notice):
    t = L.NOTICES[notice]
    w = t.words()
    changed = w[: len(w) // 2] + ["inserted", "here"] + w[len(w) // 2 :]
    rows = [(1, "a b c " + " ".join(w).upper() + " d"), (2, " ".join(changed)), (3, " ".join(w[: len(w) // 3])), (4, " ".join(reversed(w)))]
    got = {r.doc_id: r for r in found(spark, rows)}
    assert t.label in got[1].labels and got[1].score == 1.0
    assert t.label in got[2].labels and 0.7 <= got[2].score
    assert t.label not in set(got[3].labels) - set(got[3].base_labels)
    assert t.label not in set(got[4].labels) - set(got[4].base_labels)


def test_whole_table(spark):
    want = {r.doc_id: base(r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    for r in QUERIES["op5_license_scan"](spark, DATA).collect():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, [x for x in r.base_labels.split(",") if x]) == want[r.doc_id]
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_templates_are_bounded(spark):
    with pytest.raises(ValueError):
        L.license_spans(spark.createDataFrame([], DOCS), (L.Template("x", "one two"),))


def test_repeated_phrases_hide_no_notice(spark):
    """A phrase of the notice over and over, before or behind it, chains its diagonals."""
    for t in (L.NOTICES[5], L.NOTICES[0]):
        tail = " ".join(t.words()[-3:]) if t.label != "mpl" else "mozilla public license"
        notice = " ".join(t.words())
        rows = [(1, notice), (2, notice + f" {tail}" * 10), (3, f"{tail} " * 10 + notice), (4, f"{tail} " * 5000 + notice + f" {tail}" * 5000), (5, f"{tail} " * 200)]
        rows.append((6, "This Source Code Form is subject to the terms of the Mozilla Public License" + " mozilla public license" * 10))
        got = {r.doc_id: r for r in found(spark, rows)}
        for i in (1, 2, 3, 4):
            assert t.label in got[i].labels and got[i].score == 1.0
        assert "mpl" in got[6].labels and 0.8 < got[6].score < 1
        assert t.label not in set(got[5].labels) - set(got[5].base_labels)
