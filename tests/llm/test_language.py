import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import rowloom.llm.language as L
from conftest import DATA
from rowloom.llm.queries import QUERIES

DOCS = "doc_id long, text string, lang string, found string, row string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", None) for r in rows], DOCS)


ROWS = [
    (1, "the cat and the dog", "en"),
    (2, "the bird and a fish", "en"),
    (3, "der hund und die katze", "de"),
    (4, "die katze und der vogel, der Hund", "de"),
    (5, None, "en"),
    (6, "no label here", None),
]


def test_model_counts(spark):
    model = L.train(frame(spark, ROWS))
    assert model.languages == ["de", "en"]
    words = defaultdict(Counter)
    for _, text, lang in ROWS:
        if text and lang:
            words[lang].update(text.lower().replace(",", " ").split())
    for word in {w for c in words.values() for w in c}:
        for i, lang in enumerate(model.languages):
            total = sum(words[lang].values())
            assert model.scores[model.tables[0][word]][i] == pytest.approx(math.log((words[lang][word] or 0.3) / total))
    # An unseen word is scored by its longest known n-grams: <hund is known, <hunde> is not a word.
    grams = [model.tables[5][g] for g in ("<hund",) if g in model.tables[5]]
    assert np.allclose(model.score("hunde"), model.scores[grams].mean(axis=0))


def test_edges(spark):
    model = L.train(frame(spark, ROWS))
    texts = [None, "", " 12 ²³ !", "THE the", "Der Hund " * 100_000, "qqq", "the der", "the der"]
    got = {i: r for i, r in enumerate(L.predict(frame(spark, [(i, t, None) for i, t in enumerate(texts)]), model).orderBy("doc_id").collect())}
    assert [got[i].lang_pred for i in range(5)] == ["und", "und", "und", "en", "de"]
    assert got[0].score == 0 and all(0 <= r.score <= 1 for r in got.values()) and got[6].score == got[7].score
    empty = L.train(frame(spark, []))
    assert [r.lang_pred for r in L.predict(frame(spark, ROWS[:1]), empty).collect()] == ["und"]
    assert L.predict(frame(spark, []), model).collect() == []
    kept = L.drop_unidentified(frame(spark, ROWS), model)
    assert kept.columns == frame(spark, ROWS).columns and {r.doc_id for r in kept.collect()} >= {1, 2, 3, 4}


def test_forgetting_changes_nothing(spark, monkeypatch):
    import pandas as pd

    model = L.train(frame(spark, ROWS))
    texts = pd.Series(["the hund " * 700 + " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(600)), "die katze"] * 3)
    plain = pd.concat(L._labels(model, iter([texts])))
    monkeypatch.setattr(L, "REMEMBERED", 1)
    assert plain.equals(pd.concat(L._labels(model, iter([texts]))))


def test_held_out_accuracy(spark):
    rows = QUERIES["op7_language_id"](spark, DATA).collect()
    lang = {r.doc_id: (r.lang, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    assert {r.doc_id for r in rows} == set(lang) and len(rows) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    tested = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id][0] for r in tested) >= 0.95 * len(tested)


def plain_model(rows, words, grams):
    """Log frequencies per language by dictionaries: for words, and for n-grams of each length."""
    counts = defaultdict(lambda: defaultdict(Counter))
    for text, lang in rows:
        for word in re.findall(r"[^\W\d_]+", text.lower()):
            counts[0][lang][word] += 1
            marked = f"<{word}>"
            for n in range(1, L.LONGEST + 1):
                counts[n][lang].update(marked[i : i + n] for i in range(len(marked) - n + 1))
    model = []
    for n in range(L.LONGEST + 1):
        kept, totals = {}, {}
        for lang, counter in counts[n].items():
            best = sorted(counter.items(), key=lambda item: (-item[1], item[0].encode()))[: grams if n else words]
            kept[lang], totals[lang] = dict(best), sum(counter.values())
        known = {unit for units in kept.values() for unit in units}
        model.append({u: {g: math.log(kept[g].get(u, 0.3) / totals[g]) for g in kept} for u in known})
    return sorted(counts[0]), model


def plain_label(languages, model, text):
    words = re.findall(r"[^\W\d_]+", (text or "").lower())
    if not words:
        return "und", 0.0
    total = dict.fromkeys(languages, 0.0)
    for word in words:
        hits = [model[0][word]] if word in model[0] else []
        marked = f"<{word}>"
        for n in range(L.LONGEST, 0, -1):
            hits = hits or [model[n][g] for i in range(len(marked) - n + 1) if (g := marked[i : i + n]) in model[n]]
        for hit in hits:
            for lang in languages:
                total[lang] += hit[lang] / len(hits)
    best = max(languages, key=lambda g: (total[g], [-ord(c) for c in g]))
    return best, 1 / sum(math.exp(max(v - total[best], -700)) for v in total.values())


def same(got, want):
    """Equal labels, but for languages whose likelihoods differ by rounding alone."""
    assert got.keys() == want.keys()
    for i, (lang, score) in want.items():
        assert got[i][1] == pytest.approx(score, rel=1e-6, abs=1e-9)
        assert got[i][0] == lang or abs(score - 0.5) < 1e-6


def test_the_whole_table_is_labelled_as_by_a_plain_scorer(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang").collect()
    taught = [(d.text, d.lang) for d in docs if d.text and d.lang and zlib.crc32(str(d.doc_id).encode()) % 5]
    assert max(Counter(lang for _, lang in taught).values()) <= 2000  # the sample is all rows
    languages, model = plain_model(taught, 20_000, 10_000)
    got = {r.doc_id: (r.lang_pred, r.score) for r in QUERIES["op7_language_id"](spark, DATA).collect()}
    same(got, {d.doc_id: plain_label(languages, model, d.text) for d in docs})


def test_unseen_words_fall_back_as_in_a_plain_scorer(spark):
    """Random words of few letters, a model cut to few units, words known in one language only."""
    draw = random.Random(3)

    def text(letters):
        return " ".join("".join(draw.choices(letters, k=draw.randrange(1, 8))) for _ in range(draw.randrange(1, 30)))

    rows = [(i, text("abcdé" if i % 2 else "cdefß"), "xx" if i % 2 else "yy") for i in range(60)]
    rows += [(60, "zz zzz", "zz"), (61, "ça, ça; C'est", "xx"), (62, "same words", "xx"), (63, "same words", "yy")]
    model = L.train(frame(spark, rows), words=25, grams=12)
    languages, plain = plain_model([(t, g) for _, t, g in rows], 25, 12)
    assert model.languages == languages
    asked = [(i, text("abcdefßéz"), None) for i in range(200)] + [(200, "same", None), (201, "q", None), (202, "1 2", None)]
    got = {r.doc_id: (r.lang_pred, r.score) for r in L.predict(frame(spark, asked), model).collect()}
    same(got, {i: plain_label(languages, plain, t) for i, t, _ in asked})
