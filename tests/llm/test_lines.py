import random

import pytest

from rowloom.llm import lines as L

BLANKS = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, least=10):
    first = {}
    split = [(i, (t or "").split("\n")) for i, t in docs]
    key = lambda line: line.strip(BLANKS).translate(LOWER)
    for i, rows in split:
        for line in rows:
            if i is not None:
                first[key(line)] = min(first.get(key(line), i), i)
    out = []
    for i, rows in split:
        kept = [x for x in rows if i is None or len(key(x)) < least or first[key(x)] == i]
        out.append((i, len(rows), len(rows) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def result(spark, docs):
    df = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in docs], "doc_id long, text string, key string, h1 long, name int")
    return sorted((tuple(r) for r in L.without_repeated_lines(df).collect()), key=repr)


@pytest.mark.parametrize("parts", ["1", "8", "40"])
def test_against_brute_force(spark, parts):
    """A line of a third of all documents crosses the borders of many ranges."""
    rng = random.Random(int(parts))
    pool = ["Common line of text", " common LINE of text\t", "\x0bcommon line of text\r", "ÉTÉ was a long line", "été was a long line"]
    pool += ["short", "", "ninechars", "tenchars10"] + [f"line number {n} of the pool" for n in range(30)]
    docs = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(8)))) for i in rng.sample(range(-300, 3000), 300)]
    docs += [(5000 + i, "the hot line of them all") for i in range(150)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        assert result(spark, docs) == brute(docs)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_edges(spark):
    line = "a line that is long enough"
    docs = [(1, None), (2, ""), (3, line), (3, line), (3, line + "\nother"), (4, f"{line}\n{line}\n"), (None, line), (None, None)]
    docs += [(5, "\n".join([line, "x"] * 50_000)), (6, "y" * 200_000), (7, "Y" * 200_000 + "\n"), (2**60, line.upper() + "\r\n" + line[:9])]
    assert result(spark, docs) == brute(docs)
    assert result(spark, []) == []


def test_bitmaps(spark):
    df = spark.createDataFrame([(1, "first line here\nb"), (2, "a\nfirst line here\nc")], "doc_id long, text string")
    found = {r.doc_id: (r.n_lines, r.n_dropped, L.keep_mask(r.keep, r.n_lines).tolist()) for r in L.line_bitmaps(df).collect()}
    assert found == {1: (2, 0, [True, True]), 2: (3, 1, [True, False, True])}


def test_hot_line_is_spread(spark):
    """Ranges end in document and position: no task gets all rows of a line."""
    df = spark.range(20_000).selectExpr("id AS doc_id", "'one line for everybody' AS text")
    rows = L.staged(L.line_rows(df), "line-rows")
    order = ["h1", "h2", "doc_id", "name", "line"]
    sizes = [r["count"] for r in rows.repartitionByRange(8, *order).groupBy(L.F.spark_partition_id()).count().collect()]
    assert max(sizes) < 10_000
    assert L.dropped_lines(df).count() == 19_999
