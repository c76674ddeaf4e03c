import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from rowloom.llm import phrases as P
from rowloom.llm.common import TIDY, staged


def brute(docs, longest=3, threshold=10, top=2000):
    f, total = {}, Counter()
    for lang, text in docs:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower):
            words = re.findall("[^ \t]+", piece)
            total[lang or "und"] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    f.setdefault(lang or "und", Counter())[tuple(words[i : i + size])] += 1
    out = []
    for lang, counts in f.items():
        cands = {p: a for p, a in counts.items() if len(p) > 1 and a >= threshold}
        rows = []
        for p, a in cands.items():
            inside = any(
                len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) and 2 * b >= a for q, b in cands.items()
            )
            if not inside:
                score, _, left, right = min((1_000_000 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
                rows.append((" ".join(p), a, left, right, score))
        rows.sort(key=lambda r: (-r[4], -r[1], r[0].encode()))
        out += [(lang, n, p, a, x, y, total[lang], s) for n, (p, a, x, y, s) in enumerate(rows[:top], 1)]
    return sorted(out)


def result(spark, docs, **given):
    df = spark.createDataFrame([(1, lang, text, "x", 2) for lang, text in docs], "doc_id long, lang string, text string, phrase string, n long")
    return sorted(tuple(r) for r in P.collocations(df, **given).collect())


def corpus(seed, n=120):
    rng = random.Random(seed)
    words = ["the", "The", "of", "new", "york", "city", "é", "É", "x.y", "a", "a", "\x00", "ab-c", "naïve"] + [f"w{i}" for i in range(60)]
    piece = lambda: " ".join(rng.choice(words) for _ in range(rng.randrange(9)))
    docs = []
    for _ in range(n):
        parts = [rng.choice(["New York  City", "a a a a", "of the\tnew", piece()]) for _ in range(rng.randrange(20))]
        docs.append((rng.choice(["en", "fr", None]), "".join(p + rng.choice([" ", ". ", "\n", ",", "\x0b", "! "]) for p in parts)))
    return docs


@pytest.mark.parametrize("capacity, longest", [(1 << 20, 3), (700, 3), (60, 4)])
def test_against_brute_force(spark, capacity, longest):
    """Small capacities make summaries forget, and grow where they must not forget more."""
    docs = corpus(capacity)
    assert result(spark, docs, capacity=capacity, longest=longest) == brute(docs, longest)


def test_without_broadcast_and_small_slices(spark, monkeypatch):
    for name, value in (("BROADCAST_ROWS", 0), ("SLICE", 500), ("HELD", 400)):
        monkeypatch.setattr(P, name, value)
    docs = corpus(4)
    assert result(spark, docs, top=7) == brute(docs, top=7)


def test_edges(spark):
    docs = [("en", None), ("en", ""), ("en", " \t "), ("en", "...!?\n"), (None, "one two " * 30), ("en", "one two " * 50_000)]
    docs += [("de", "a b")] * 10 + [("de", "x" * 100_000 + " y")] * 10
    assert result(spark, docs) == brute(docs)
    assert result(spark, []) == []
    assert result(spark, docs[:4]) == []


def test_summary_keeps_frequent_keys():
    rng = np.random.default_rng(1)
    keys = np.concatenate((rng.integers(0, 10**6, 50_000), np.repeat(np.arange(-40, 0), 10)))
    rng.shuffle(keys)
    parts = []
    for half in np.array_split(keys, 2):
        summary = P.Summary(len(keys) // 10 + 1, 10)
        for batch in np.array_split(half, 7):
            summary.merge(*np.unique(batch, return_counts=True))
        parts.append(summary)
    parts[0].merge(parts[1].keys, parts[1].counts, parts[1].error)
    assert parts[0].error < 10
    assert set(range(-40, 0)) <= set(parts[0].survivors().tolist())
    small = P.Summary(50, 10)  # less than mass over threshold: grows instead of losing any
    for batch in np.array_split(keys, 9):
        small.merge(*np.unique(batch, return_counts=True))
    assert small.error < 10 and set(range(-40, 0)) <= set(small.survivors().tolist())


def test_many_words():
    """Word numbers too large to pack three into one number."""
    ids = np.array([5, 7, 5, 7, 5, -1, 7, 5, 7])
    for n_words in (8, 1 << 40):
        for size in (1, 2, 3):
            grams = P._grams(ids, n_words, size)
            want = Counter(tuple(ids[i : i + size].tolist()) for i in range(len(ids) - size + 1) if (ids[i : i + size] >= 0).all())
            assert {tuple(w): n for w, n in zip(grams.words.tolist(), grams.counts.tolist(), strict=True)} == want


def test_hashes_travel_in_bundles():
    """A task hands on a row per range of hashes, not one per n-gram; a range holds what lies in it, counts capped."""
    texts = [" ".join(f"w{i * 37 % 1000}" for i in range(j, j + 500)) for j in range(6)] + ["a " * 300]
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * len(texts), "text": [t.encode() for t in texts]})
    rows = [r for b in P._local_counts(3, 10, 8)(iter([batch])) for r in b.to_pylist()]
    assert sorted(r["part"] for r in rows) == list(range(8))
    seen = {}
    for r in rows:
        keys, counts = np.frombuffer(r["hashes"], np.int64), np.frombuffer(r["counts"], np.uint8)
        assert len(keys) == len(counts) and (np.diff(keys) > 0).all()
        assert {((int(k) + (1 << 63)) * 8) >> 64 for k in keys} == {r["part"]}
        seen |= dict(zip(keys.tolist(), counts.tolist(), strict=True))
    expected = {}
    for _, _, grams, hashes in P._counted(iter([batch]), 3):
        expected |= dict(zip(hashes.view(np.int64).tolist(), np.minimum(grams.counts, 10).tolist(), strict=True))
    assert seen == expected and max(seen.values()) == 10


@pytest.mark.parametrize("n", [0, 1, 2, 3, 1000])
def test_known_hashes_are_found_by_leading_bits(n):
    rng = np.random.default_rng(n)
    known = rng.integers(0, 1 << 64, n, dtype=np.uint64)
    known[: n // 2] >>= np.uint64(40)  # many that begin alike
    known = np.unique(known)
    asked = np.concatenate((rng.permutation(known), rng.integers(0, 1 << 64, 500, dtype=np.uint64), known + np.uint64(1)))
    found = P._Known(known).rows(asked)
    assert found.tolist() == [i for i, h in enumerate(asked.tolist()) if h in set(known.tolist())]


def test_hashes_dealt_unevenly_lose_nothing(spark):
    """Survivors are those of all counts, however many ranges there are and whatever the capacity."""
    texts = [(i, "en", " ".join(f"w{(i * j) % 60}" for j in range(40))) for i in range(60)]
    docs = spark.createDataFrame(texts, "doc_id long, lang string, text string").selectExpr("lang", "cast(text AS binary) AS text")
    batch = pa.Table.from_pandas(docs.toPandas()).combine_chunks().to_batches()[0]
    expected = set()
    for _, _, grams, hashes in P._counted(iter([batch]), 3):
        expected |= set(hashes.view(np.int64)[grams.counts >= 10].tolist())
    found = P.frequent_hashes(docs, 3, 10, capacity=50).toPandas()["hash"].tolist()
    assert len(found) == len(set(found)) and expected <= set(found)


def test_beyond_the_broadcast_only_likely_survivors_travel(spark, monkeypatch):
    """Many survivors are broadcast as bits: of the n-grams that do not survive, few leave the task that reads them."""
    seen, whole = [], P._exact_counts

    def recorded(longest, known, *more):
        seen.append(known)
        return whole(longest, known, *more)

    monkeypatch.setattr(P, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(P, "_exact_counts", recorded)
    rare = " ".join(f"r{i}" for i in range(20_000))
    docs = [("en", rare)] + [("en", "new york city is new. ")] * 40 + [(None, "a b")] * 12
    assert result(spark, docs) == brute(docs)
    assert seen[0] is not None
    monkeypatch.undo()
    batch = pa.RecordBatch.from_pydict({"lang": [lang or "und" for lang, _ in docs], "text": [t.encode() for _, t in docs]})
    rows = [r for b in whole(3, seen[0], 8)(iter([batch])) for r in b.to_pylist()]
    found = pa.concat_tables([P._unpacked(*(r[c] for c in P.PACKED.names[1:])) for r in rows]).to_pylist()
    counts = {(r["lang"], r["phrase"].decode()): r["n"] for r in found if r["words"]}
    assert counts["en", "new york city"] == 40 and counts["en", "new"] == 80 and counts["und", "a b"] == 12
    assert len(counts) == sum(r["n"] for r in rows if r["words"]) < 2000  # of 60,000
    assert {r["lang"]: r["n"] for r in found if not r["words"]} == {"en": 20_200, "und": 24}


@pytest.mark.parametrize("bits", [19, 22])
def test_likely_finds_all_that_are_known(bits):
    rng = np.random.default_rng(bits)
    known = np.unique(rng.integers(0, 1 << 64, 5000, dtype=np.uint64))
    likely = P._Likely(bits)
    parts = [pa.RecordBatch.from_pydict({"hash": half.view(np.int64)}) for half in np.array_split(rng.permutation(known), 3)]
    marks = [b for part in parts for b in P._marks(bits)(iter([part]))]
    for r in [r for b in P._merged_marks(iter(marks)) for r in b.to_pylist()]:
        likely.marks[r["chunk"] << 16 : r["chunk"] + 1 << 16] = np.frombuffer(r["marks"], np.uint8)
    asked = rng.integers(0, 1 << 64, 50_000, dtype=np.uint64)
    assert len(likely.rows(known)) == len(known)
    assert likely.rows(asked).tolist() == np.flatnonzero(np.isin(asked >> np.uint64(64 - bits), known >> np.uint64(64 - bits))).tolist()


def test_phrases_are_packed_and_unpacked():
    texts = [b"", "é".encode(), b"a b", b"x" * 70_000, b"\x00 z"]
    whole = pa.array([b"before", *texts, b"after"], pa.large_binary())
    counts = np.array([1, 300, 70_000, 2, 1 << 40])
    table = P._unpacked("en", 2, *P._packed(whole[1:-1], counts))
    assert table.column("phrase").to_pylist() == texts and table.column("n").to_pylist() == counts.tolist()


def test_tidy_staging_restores_the_setting(spark):
    before = spark.conf.get(TIDY)
    assert staged(spark.range(5).repartition(2), "test", tidy=True).count() == 5 and spark.conf.get(TIDY) == before
    with pytest.raises(Exception, match="no"):
        staged(spark.range(1).selectExpr("raise_error('no') AS x"), "test", tidy=True)
    assert spark.conf.get(TIDY) == before
