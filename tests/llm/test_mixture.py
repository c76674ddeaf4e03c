import math
import random
from collections import Counter, defaultdict

import pytest

import rowloom.llm.mixture as M

DOCS = "doc_id long, text string, source string, epoch string, weight string"


def corpus(seed=1, big=400):
    rng = random.Random(seed)
    sizes = {"a": big, "b": 60, "c": 12, None: 5}
    rows = [(s, "w " * rng.randrange(1, 40)) for s, n in sizes.items() for _ in range(n)]
    rng.shuffle(rows)
    return [(i, t, s) for i, (s, t) in enumerate(rows)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], DOCS)


def weights(totals, x):
    shares = {s: t / sum(totals.values()) for s, t in totals.items()}
    z = sum(v**x for v in shares.values())
    return {s: v**x / z for s, v in shares.items()}


def entropy(p):
    return -sum(v * math.log(v) for v in p.values())


@pytest.mark.parametrize("target, limit, budget, bucket", [(0.8, 9, None, 50), (1.0, 3, None, 7), (0.0, 4, 900.5, 2000)])
def test_against_brute_force(spark, monkeypatch, target, limit, budget, bucket):
    monkeypatch.setattr(M, "BUCKET", bucket)
    rows = corpus()
    tokens = {i: len(t.split()) for i, t, _ in rows}
    totals = Counter()
    for i, _, s in rows:
        totals["" if s is None else "=" + s] += tokens[i]
    total = sum(totals.values())
    got = [r.asDict() for r in M.mixture(frame(spark, rows), target, limit, budget).collect()]
    passes = (budget or total) / total

    low, high = 0.0, 1.0  # plain bisection: entropy first, then the limit
    for test in (lambda p: entropy(p) >= target * math.log(len(p)),):
        if not test(weights(totals, 1.0)):
            for _ in range(60):
                mid = (low + high) / 2
                low, high = (mid, high) if test(weights(totals, mid)) else (low, mid)
        x = 1.0 if test(weights(totals, 1.0)) else low
    repeats = lambda x: max(weights(totals, x)[s] * passes * total / totals[s] for s in totals)
    if repeats(x) > max(limit, passes):
        low, high = x, 1.0
        for _ in range(60):
            mid = (low + high) / 2
            low, high = (mid, high) if repeats(mid) > max(limit, passes) else (low, mid)
        x = high
    want = weights(totals, x)
    seen = {r["origin"]: r["weight"] for r in got}
    for s in seen:
        assert seen[s] == pytest.approx(want[s], rel=1e-4)

    source = {i: "" if s is None else "=" + s for i, _, s in rows}
    by_pass = defaultdict(list)
    for r in got:
        assert 0 <= r["place"] < 1 and r["tokens"] == tokens[r["doc_id"]] and r["origin"] == source[r["doc_id"]]
        by_pass[r["origin"], r["epoch"]].append(r["doc_id"])
    for s in totals:
        epochs = seen.get(s, want[s]) * passes * total / totals[s]
        whole = {i for i in source if source[i] == s}
        for e in range(math.floor(epochs + 1e-9)):
            assert sorted(by_pass.pop((s, e))) == sorted(whole)
        part = by_pass.pop((s, math.floor(epochs + 1e-9)), [])
        rest = (epochs - math.floor(epochs + 1e-9)) * totals[s]
        assert len(set(part)) == len(part) and set(part) <= whole
        assert sum(tokens[i] for i in part) <= rest + 1e-6
        assert sum(tokens[i] for i in part) > rest - 40  # the next document would not fit
    assert not by_pass
    if target == 0.8:  # every half of the output has the weights, roughly
        first = Counter()
        for r in got:
            if r["place"] < 0.5:
                first[r["origin"]] += r["tokens"]
        assert first["=a"] / sum(first.values()) == pytest.approx(want["=a"], abs=0.08)


def test_rows_and_edges(spark):
    rows = [(1, None, "a"), (2, "", "a"), (None, "x y", "a"), (3, "x y", None), (3, "x y", None), (4, None, "empty")]
    out = M.mixed(frame(spark, rows), entropy=1.0, max_epochs=1.0)
    assert out.columns == ["doc_id", "text", "source", "weight", "epoch", "place"]
    kept = sorted(((r.doc_id, r.text, r.source, r.epoch) for r in out.collect()), key=repr)
    assert kept == sorted([(*r, 0) for r in rows if r[2] != "empty"], key=repr)
    assert M.mixed(frame(spark, [])).collect() == [] and M.mixture(frame(spark, rows[:2])).collect() == []
    long = [(1, "w " * 300_000, "a"), (2, "w", "b")]
    assert {r.doc_id for r in M.mixture(frame(spark, long), entropy=0.0).collect()} == {1, 2}
