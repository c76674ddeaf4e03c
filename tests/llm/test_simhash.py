import random
from itertools import combinations

import pytest
import xxhash
from pyspark.sql import functions as F

import rowloom.llm.simhash as S
from conftest import DATA
from rowloom.llm.components import components
from rowloom.llm.queries import QUERIES


def brute_bits(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lower = lower.replace(c, " ")
    words = [w for w in lower.split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_roots(nodes, linked):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in linked:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    return {n: find(n) for n in nodes}


def expected(docs):
    bits = {i: brute_bits(t) for i, t in docs}
    linked = [(a, b) for a, b in combinations(bits, 2) if (bits[a] ^ bits[b]).bit_count() <= 2]
    roots = brute_roots(list(bits), linked)
    least = {}
    for i, r in roots.items():
        least[r] = min(least.get(r, i), i)
    return {i: (bits[i], least[roots[i]]) for i in bits}


def test_whole_table(spark):
    """The registered query on the whole small table, against all pairs."""
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    want = {(i, f"{b:016x}", c) for i, (b, c) in expected(docs).items()}
    assert {tuple(r) for r in QUERIES["op2_simhash_dedup"](spark, DATA).collect()} == want


def test_edges(spark):
    docs = [(9, None), (4, ""), (5, " \t"), (7, "One"), (8, "one"), (2, "A b"), (3, "É a b c"), (6, "x y z " * 60_000)]
    df = spark.createDataFrame([(i, t, "b") for i, t in docs], "doc_id long, text string, bits string")
    got = {r.doc_id: (r.bits % 2**64, r.component_id) for r in S.near_duplicates(df).collect()}
    assert got == expected(docs)
    kept = S.drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {c for _, c in expected(docs).values()}
    assert S.near_duplicates(df.limit(0)).collect() == [] and S.drop_near_duplicates(df.limit(0)).collect() == []


def test_repeated_and_missing_ids(spark):
    rows = [(1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (2, "a b c d"), (None, "q r s t u"), (3, "q r s t u")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = S.near_duplicates(df).select("doc_id", "component_id").collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(1, 1), (1, 1), (None, 1), (2, 1), (None, 3), (3, 3)], key=repr)
    assert sorted((tuple(r) for r in S.drop_near_duplicates(df).collect()), key=repr) == sorted(
        [(1, "a b c d"), (None, "a b c d"), (None, "q r s t u"), (3, "q r s t u")], key=repr
    )


@pytest.mark.parametrize("crowd", [1, 64])
@pytest.mark.parametrize("distance", [0, 1, 2, 3])
def test_links_connect_exactly(spark, monkeypatch, crowd, distance):
    """Both ways of handling a signature give the components of all pairs; every link is a pair."""
    monkeypatch.setattr(S, "CROWD", crowd)
    rng = random.Random(distance)
    nodes = set()
    for _ in range(25):
        centre = rng.getrandbits(64)
        for _ in range(8):
            centre ^= sum(1 << b for b in rng.sample(range(64), rng.randrange(distance + 2)))
            nodes.add(centre)
    signed = {n - 2**64 if n >> 63 else n for n in nodes}
    df = spark.createDataFrame([(n,) for n in signed], "bits long")
    near = [(a, b) for a, b in combinations(sorted(signed), 2) if ((a ^ b) % 2**64).bit_count() <= distance]
    found = {tuple(r) for r in S.links(df, distance).collect()}
    assert found <= set(near)
    assert brute_roots(signed, found) == brute_roots(signed, near)


def test_components(spark):
    rng = random.Random(1)
    links = {(i, i + 1) for i in range(200)} | {(1000, i) for i in range(1001, 1100)}
    links |= {tuple(sorted(rng.sample(range(2000, 2100), 2))) for _ in range(60)}
    got = components(spark.createDataFrame(sorted(links), "a long, b long")).collect()
    want = brute_roots({n for x in links for n in x}, links)
    assert sorted(map(tuple, got)) == sorted(want.items())
    assert components(spark.createDataFrame([], "a long, b long")).where(F.lit(True)).collect() == []


def test_exploded_rows_are_not_broadcast(spark, monkeypatch, tmp_path):
    """A row per signature is many times what Spark makes of the size: such rows never go through the driver."""
    plans = {}

    def recorded(df, label):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return staged(df, label)

    staged = S.staged
    monkeypatch.setattr(S, "staged", recorded)
    monkeypatch.setattr(S, "CROWD", 2)
    spark.range(300).selectExpr("id * 3 AS bits").write.parquet(f"{tmp_path}/nodes")
    found = S.links(spark.read.parquet(f"{tmp_path}/nodes"))
    assert found.count() > 0
    plans["links"] = found._jdf.queryExecution().executedPlan().toString()
    assert plans["simhash-shared"].count("SortMergeJoin") >= 1 and plans["links"].count("SortMergeJoin") >= 2
    assert not any("Broadcast" in p for p in plans.values())
