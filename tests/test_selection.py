"""Keys at ranks of a sort, found by counting: against plain sorted lists."""

import random

import pytest
from pyspark.sql import DataFrame

import rowloom as rl
from rowloom.plans import order, selection

N = 3000


@pytest.fixture
def small_steps(monkeypatch):
    """Several rounds even on small tables."""
    monkeypatch.setattr(selection, "SAMPLE_ROWS", 200)
    monkeypatch.setattr(selection, "LAST_ROWS", 60)
    monkeypatch.setattr(order, "TOP_K", 0)
    monkeypatch.setattr(order, "SORT_BUCKET_ROWS", 100)
    monkeypatch.setattr(order, "write_rows", lambda df: pytest.fail("a copy was written"))


def rows_of(seed):
    draw = random.Random(seed)
    nan, inf = float("nan"), float("inf")
    shared = "passage " * 60
    out = []
    for i in range(N):
        hot = i % 3 == 0
        number = 7.5 if hot else draw.choice([None, nan, inf, -inf, -0.0, draw.uniform(-9, 9)])
        text = shared if hot else draw.choice([None, "", shared + str(draw.randrange(99)), str(draw.randrange(999)), "é" * 300])
        whole = 5 if hot else draw.choice([None, draw.randrange(-(2**62), 2**62)])
        out.append((i, number, text, None if text is None else text.encode(), whole))
    return out


def in_order(rows, column, reverse):
    def odd(value):
        return 2 if value is None else 1 if value != value else 0

    plain = [r for r in rows if odd(r[column]) == 0]
    code = (lambda v: v.encode()) if column == 2 else (lambda v: v)
    plain.sort(key=lambda r: code(r[column]), reverse=reverse)
    return [r[0] for r in plain] + [r[0] for kind in (1, 2) for r in rows if odd(r[column]) == kind]


@pytest.mark.parametrize("reverse", [False, True])
@pytest.mark.parametrize(("name", "column"), [("d", 1), ("t", 2), ("b", 3), ("n", 4)])
def test_pages_of_a_sort(spark, small_steps, name, column, reverse):
    """Hot values, ties, nulls, NaN and long texts that begin alike."""
    rows = rows_of(column)
    frame = rl.from_dataframe(spark.createDataFrame(rows, "i int, d double, t string, b binary, n bigint").repartition(5), key="i")
    by, want = rl.sort_rows(frame, name, reverse), in_order(rows, column, reverse)
    assert rl.to_list(rl.take_rows(rl.skip_rows(by, 1234), 60), "i") == want[1234:1294]
    found = selection.keys_at_ranks(by, [0, 1, 999, 1000, 1001, 2998, 2999, 3000], N)
    assert [found[r][1] for r in (0, 1, 999, 1000, 1001, 2998, 2999)] == [want[r] for r in (0, 1, 999, 1000, 1001, 2998, 2999)]
    assert 3000 not in found


def test_keys_that_are_not_unique_end_the_search(spark, small_steps):
    frame = rl.from_dataframe(spark.range(N).selectExpr("id div 1000 AS k"), key="k")
    assert selection.keys_at_ranks(frame, [5, 999, 1000, 2500], N) == {5: (0,), 999: (0,), 1000: (1,), 2500: (2,)}


def test_empty_table(spark, small_steps):
    frame = rl.sort_rows(rl.from_dataframe(spark.createDataFrame([], "i int, v int"), key="i"), "v")
    assert rl.to_list(rl.take_rows(rl.skip_rows(frame, 3), 4)) == []


def test_only_a_sample_is_sorted(spark, small_steps, tmp_path, monkeypatch):
    """Nothing is kept in executors, and only samples of the keys are put in order."""
    spark.range(N).selectExpr("id", "hash(id) AS v", "repeat('x', 50) AS wide").write.parquet(f"{tmp_path}/t")
    by = rl.sort_rows(rl.load(spark, f"{tmp_path}/t/*.parquet"), "v")
    monkeypatch.setattr(DataFrame, "persist", lambda df: pytest.fail("rows were kept"))
    sort, sorted_plans = type(by.df).orderBy, []

    def spied(df, *columns):
        sorted_plans.append(df._jdf.queryExecution().executedPlan().toString())
        return sort(df, *columns)

    with monkeypatch.context() as patch:
        patch.setattr(type(by.df), "orderBy", spied)
        page = rl.take_rows(rl.skip_rows(by, 2000), 100)
    assert sorted_plans and all("Sample" in text and "ReadSchema: struct<v:int,_tmp_metadata_row_index:bigint>" in text for text in sorted_plans)
    text = page.unordered_rows()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange rangepartitioning" not in text and "GreaterThanOrEqual(v," in text
    part = selection.keys_only(by)
    counted = part.df.agg(selection.F.count_if(selection.before(part, (5, 7))))
    assert "rangepartitioning" not in counted._jdf.queryExecution().executedPlan().toString()


# -- dense numbers of a sort --------------------------------------------------------------


@pytest.mark.parametrize("reverse", [False, True])
@pytest.mark.parametrize(("name", "column"), [("d", 1), ("t", 2), ("b", 3), ("n", 4)])
def test_dense_numbers_of_a_sort(spark, small_steps, name, column, reverse):
    """Row index, interleaved shard and index list of a sort, without a copy, however the rows are spread."""
    rows, got = rows_of(column), []
    want = in_order(rows, column, reverse)
    for tasks in (2, 16):
        table = spark.createDataFrame(rows, "i int, d double, t string, b binary, n bigint").repartition(tasks)
        by = rl.sort_rows(rl.from_dataframe(table, key="i"), name, reverse)
        numbered = rl.map_column(by, "at", "row index").unordered_rows()
        got.append(sorted((r["at"], r["i"]) for r in numbered.select("at", "i").collect()))
    assert got == [list(enumerate(want))] * 2
    assert rl.to_list(rl.take_shard(by, 7, 3, contiguous=False), "i") == want[3::7]
    assert rl.to_list(rl.select_rows(by, "2999, 4, 10:1500:300, 4"), "i") == [want[i] for i in (2999, 4, *range(10, 1500, 300), 4)]


def test_intervals_hold_like_numbers_of_rows(spark, small_steps):
    """A value, or the first part of a long text, that a third of all rows share is cut by the keys behind it."""
    for column, name in ((1, "d"), (2, "t"), (4, "n")):
        table = spark.createDataFrame(rows_of(column), "i int, d double, t string, b binary, n bigint")
        by = rl.sort_rows(rl.from_dataframe(table, key="i"), name)
        (interval,) = order._buckets(by).columns
        sizes = [r["count"] for r in by.df.groupBy(interval).count().collect()]
        assert len(sizes) > 20 and max(sizes) < 400


TYPES = {
    "decimal(38,3)": "CAST(v / -8 AS decimal(38,3))",
    "date": "date_add(DATE'2024-01-31', CAST(v AS int))",
    "timestamp": "timestamp_micros(v * 86400000001)",
    "timestamp_ntz": "CAST(timestamp_micros(v * 86400000001) AS timestamp_ntz)",
    "boolean": "v % 2 = 1",
    "float": "CAST(v / 3 AS float)",
    "tinyint": "CAST(v % 100 AS tinyint)",
}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_keys_of_any_type_divide_a_sort(spark, small_steps, zone):
    """Keys come back from the driver unchanged: the same numbers as Spark's own ranks."""
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        columns = [f"CASE WHEN id % 11 <> 0 THEN {value} END AS c{i}" for i, value in enumerate(TYPES.values())]
        table = spark.range(1500).selectExpr("id", "id * 7919 % 997 AS v").selectExpr("id", *columns)
        for i, kind in enumerate(TYPES):
            assert table.schema[f"c{i}"].dataType.simpleString() == kind
            by = rl.sort_rows(rl.from_dataframe(table, key="id"), f"c{i}", reverse=True)
            got = [r["id"] for r in rl.map_column(by, "at", "row index").unordered_rows().orderBy("at").collect()]
            assert got == [r["id"] for r in table.orderBy(selection.F.col(f"c{i}").desc_nulls_last(), "id").collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_numbering_a_sort_moves_rows_once(spark, small_steps, tmp_path, monkeypatch):
    spark.range(N).selectExpr("id", "hash(id) AS v", "repeat('x', 50) AS wide").write.parquet(f"{tmp_path}/t")
    by = rl.sort_rows(rl.load(spark, f"{tmp_path}/t/*.parquet"), "v")
    monkeypatch.setattr(DataFrame, "persist", lambda df: pytest.fail("rows were kept"))
    plan = rl.map_column(by, "at", "row index").unordered_rows()._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "SortMergeJoin" in plan
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    # the rows, and the row counts of the intervals twice
    assert len(exchanges) == 3 and plan.count("wide") and sum("SinglePartition" in x for x in plan.splitlines()) == 1


def test_keys_too_long_for_a_plan_are_sorted(spark, monkeypatch):
    """The rows are written in order instead, with the same numbers."""
    monkeypatch.setattr(order, "SORT_BUCKET_ROWS", 10)
    monkeypatch.setattr(selection, "POINT_BYTES", 1000)
    table = spark.range(200).selectExpr("id", "concat(repeat('y', 300), id * 37 % 200) AS t")
    by = rl.sort_rows(rl.from_dataframe(table, key="id"), "t")
    want = sorted(range(200), key=lambda i: str(i * 37 % 200))
    assert rl.to_list(rl.map_column(by, "at", "row index"), "id") == want
