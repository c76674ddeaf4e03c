import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from conftest import DATA
from rowloom.llm import spelling as S
from rowloom.llm.queries import QUERIES


def brute(docs, shortest=5, least=3):
    counts = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if h % 97 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    n = {w: c for w, c in counts.items() if len(w) >= shortest and c >= least}
    near = {w: set() for w in n}
    holes = {}
    for w in n:
        for at in range(len(w)):
            holes.setdefault((w[:at], w[at + 1 :]), []).append(w)
            shorter = w[:at] + w[at + 1 :]
            if shorter in n:
                near[w].add(shorter)
                near[shorter].add(w)
    for group in holes.values():
        for w in group:
            near[w].update(x for x in group if x != w)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, n[w], len(near[w]), form[w] or "", n.get(form[w], 0), root(w)) for w in n)


def shown(df):
    return sorted((r.word, r.n, r.n_near, r.form or "", r.form_n or 0, r.root) for r in df.collect())


def result(spark, docs, **given):
    df = spark.createDataFrame([(i, t, "x", 3) for i, t in docs], "doc_id long, text string, word string, n long")
    return shown(S.spelling_variants(df, **given))


def corpus(seed, n=400):
    rng = random.Random(seed)
    base = ["letter", "letters", "better", "bitter", "été" * 2, "ÉTÉété", "aaaaa", "aaaaaa", "aaaa", "abababab", "naïveté", "straße", "x×y÷zz"]
    words = []
    for _ in range(120):
        w = rng.choice(base)
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(w))
            w = rng.choice([w[:at] + w[at + 1 :], w[:at] + rng.choice("aeté") + w[at:], w[:at] + rng.choice("abÉ") + w[at + 1 :]])
        words.append(w)
    weights = [rng.random() ** 6 for _ in words]
    return [(i, " ".join(rng.choices(words, weights, k=rng.randrange(30)))) for i in range(n)]


@pytest.mark.parametrize("tile, cells", [(256, 1 << 20), (4, 1 << 20), (16, 20)])
def test_against_brute_force(spark, tile, cells):
    """Small tiles make blocks split down to single places."""
    docs = corpus(tile + cells)
    found = result(spark, docs, tile=tile, cells=cells)
    assert found == brute(docs)


def test_edges(spark):
    docs = [(1, None), (2, ""), (None, "alpha alphb"), (None, "alpha 12 alphb"), (3, "alpha,alphb-ALPHA"), (3, "alpha,alphb-ALPHA")]
    docs += [(4, "w" * 3000 + " " + "w" * 2999 + "x")] * 3 + [(5, "alphas " * 20_000), (6, "four fou five")]
    assert result(spark, docs, cells=5000) == brute(docs)
    assert result(spark, []) == []
    assert result(spark, docs[:2]) == []


def test_one_replaced_letter_everywhere(spark):
    """One group of words that all differ in one place, and doubled letters whose edit has several places."""
    letters = "abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêë"
    words = [f"pre{c}post" for c in letters] + ["prepost"] + ["aabbcc"[:k] + "aabbcc"[k - 1 :] for k in range(1, 7)] + ["aabbcc"]
    docs = [(i, " ".join(words)) for i in range(3)]
    assert result(spark, docs, tile=8) == brute(docs)


def test_long_chain_of_forms(spark):
    words = ["".join("b" if j < i else "a" for j in range(9)) for i in range(9)]
    docs = [(i, " ".join(" ".join([w] * 3 * 2**k) for k, w in enumerate(words))) for i in range(2)]
    found = result(spark, docs)
    assert found == brute(docs)
    assert {r[5] for r in found} == {words[-1]}


def test_pairs_are_reported_once():
    rng = np.random.default_rng(0)
    words = sorted({"".join(rng.choice(list("ab"), size=rng.integers(5, 8))) for _ in range(60)})
    n = len(words)
    for longest in (6, 7):
        chosen = [w for w in words if longest - 1 <= len(w) <= longest]
        m = len(chosen)
        same = [np.zeros(m, np.int64), np.full(m, longest), np.zeros(m, np.int64), np.full(m, longest)]
        a, b = S.near_pairs(chosen, *same)
        assert len({tuple(sorted(p)) for p in zip(a.tolist(), b.tolist(), strict=True)}) == len(a)
    assert n > 10


def test_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    assert shown(QUERIES["op13_spelling_variants"](spark, DATA)) == brute(docs)
