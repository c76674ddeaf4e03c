"""Row operators against plain Python lists, on one file and on files of very different sizes."""

import math
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

import rowloom as rl
from rowloom.operators.rows import parse_selection


@pytest.fixture(params=["one", "nine"])
def frame(request, spark, layouts):
    return rl.load(spark, layouts[request.param])


def ids(frame):
    return [row.event_id for row in rl.to_data_list(rl.select_columns(frame, "event_id")).collect()]


def numbered(frame):
    rows = rl.to_data_list(rl.map_column(frame, "at", "row index")).collect()
    assert [row["at"] for row in rows] == list(range(len(rows)))
    return [row.event_id for row in rows]


def hashed(position, seed):
    start = xxhash.xxh64_intdigest(struct.pack("<q", seed), seed=42)
    return xxhash.xxh64_intdigest(struct.pack("<q", position), seed=start) >> 1


def shuffled(positions, seed):
    return sorted(positions, key=lambda p: (hashed(p, seed), p))


CHAINS = {
    "scan": (lambda f: f, lambda rows: rows),
    "filter": (
        lambda f: rl.filter_rows(f, "event_type", "in", "click, view"),
        lambda rows: [r for r in rows if r["event_type"] in ("click", "view")],
    ),
    "nothing": (lambda f: rl.filter_rows(f, "event_id", "<", "0"), lambda rows: []),
    "sorted": (lambda f: rl.sort_rows(f, "event_type"), lambda rows: sorted(rows, key=lambda r: r["event_type"])),
    "reversed": (
        lambda f: rl.sort_rows(f, "user_id", reverse=True),
        lambda rows: sorted(rows, key=lambda r: -r["user_id"]),
    ),
    "shuffled": (lambda f: rl.shuffle(f, 5), lambda rows: [rows[p] for p in shuffled(range(len(rows)), 5)]),
    "filter shuffled": (
        lambda f: rl.shuffle(rl.filter_rows(f, "value", ">=", "50"), 1),
        lambda rows: [rows[p] for p in shuffled([i for i, r in enumerate(rows) if r["value"] >= 50], 1)],
    ),
    "interleaved": (lambda f: rl.take_shard(f, 3, 1, contiguous=False), lambda rows: rows[1::3]),
    "selected": (
        lambda f: rl.select_rows(f, "900:100:-3, 5, 5, 7"),
        lambda rows: [*rows[900:100:-3], rows[5], rows[5], rows[7]],
    ),
    "skipped twice": (lambda f: rl.skip_rows(rl.skip_rows(f, 65), 300), lambda rows: rows[365:]),
}


@pytest.fixture(params=CHAINS)
def chain(request, frame, event_rows):
    build, model = CHAINS[request.param]
    return build(frame), [r["event_id"] for r in model(event_rows)]


def test_rows_and_count(chain):
    frame, expected = chain
    assert ids(frame) == expected
    assert rl.count_rows(frame) == len(expected)


def test_row_index(chain):
    frame, expected = chain
    assert numbered(frame) == expected


def test_take_skip(chain):
    frame, expected = chain
    for n in (0, 1, 64, 500, 5000):
        assert ids(rl.take_rows(frame, n)) == expected[:n]
    for n in (0, 11, 500, 5000):
        assert ids(rl.skip_rows(frame, n)) == expected[n:]
    assert numbered(rl.take_rows(rl.skip_rows(frame, 20), 30)) == expected[20:50]


def test_shards(chain):
    frame, expected = chain
    size, longer = divmod(len(expected), 7)
    blocks = [rl.take_shard(frame, 7, i) for i in (0, 3, 6)]
    starts = [i * size + min(i, longer) for i in range(8)]
    for i, block in zip((0, 3, 6), blocks, strict=True):
        assert ids(block) == expected[starts[i] : starts[i + 1]]
    assert numbered(rl.take_shard(frame, 4, 3, contiguous=False)) == expected[3::4]


def test_split(chain):
    frame, expected = chain
    if not expected:
        with pytest.raises(ValueError, match="empty"):
            rl.train_test_split(frame, 0.3)
        return
    held_out = math.ceil(len(expected) * 0.3)
    train, test = rl.train_test_split(frame, 0.3, shuffle=False)
    assert ids(train) == expected[:-held_out]
    assert ids(test) == expected[-held_out:]
    train, test = (ids(part) for part in rl.train_test_split(frame, 0.3, seed=9))
    assert (len(train), len(test)) == (len(expected) - held_out, held_out)
    assert sorted(train + test) == sorted(expected)


def test_unique_in_order_of_appearance(chain, event_rows):
    frame, expected = chain
    types = {r["event_id"]: r["event_type"] for r in event_rows}
    found = [row[0] for row in rl.unique_values(frame, "event_type").rows().collect()]
    assert found == list(dict.fromkeys(types[i] for i in expected))


def test_shuffle_is_a_permutation_and_depends_on_the_seed(chain):
    frame, expected = chain
    first, second = ids(rl.shuffle(frame, 1)), ids(rl.shuffle(frame, 2))
    assert sorted(first) == sorted(second) == sorted(expected)
    if len(set(expected)) > 10:
        assert first != second and first != expected
    assert ids(rl.shuffle(rl.shuffle(frame, 1), 1)) != first or not expected


def test_partitioning_does_not_matter(spark, layouts):
    def chain(f):
        return rl.take_rows(rl.skip_rows(rl.shuffle(rl.filter_rows(f, "value", "<", "70"), 3), 10), 200)

    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes")}
    try:
        results = []
        for partitions, size in (("2", "134217728b"), ("16", "2048b")):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            results += [numbered(chain(rl.load(spark, path))) for path in layouts.values()]
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert all(r == results[0] for r in results)


@pytest.mark.parametrize("in_one_task", [1 << 17, 0])
def test_small_buckets(monkeypatch, spark, layouts, event_rows, in_one_task):
    """Ranks that cross many buckets, and a shuffle with several hash digits."""
    import rowloom.plans.order as order

    monkeypatch.setattr(order, "BUCKETS_IN_ONE_TASK", in_one_task)
    monkeypatch.setattr(order, "_bucket_rows", lambda frame: 3)
    for path in layouts.values():
        frame = rl.filter_rows(rl.load(spark, path), "value", ">=", "30")
        expected = [r["event_id"] for r in event_rows if r["value"] >= 30]
        assert numbered(frame) == expected
        assert ids(rl.take_rows(rl.skip_rows(frame, 100), 301)) == expected[100:401]
        mixed = shuffled(expected, 4)
        assert numbered(rl.shuffle(frame, 4)) == mixed
        assert ids(rl.take_rows(rl.skip_rows(rl.shuffle(frame, 4), 7), 90)) == mixed[7:97]


def test_offsets_joined_by_shuffle_when_the_file_table_is_large(monkeypatch, spark, layouts, event_rows):
    import rowloom.sources.files as files

    monkeypatch.setattr(files, "BROADCAST_BYTES", 0)
    frame = rl.load(spark, layouts["nine"])
    expected = [r["event_id"] for r in event_rows]
    assert numbered(frame) == expected
    assert numbered(rl.filter_rows(frame, "event_id", ">=", "55")) == expected[55:]


def test_large_selection_joined_by_shuffle(monkeypatch, spark, layouts):
    import rowloom.operators.rows as rows

    frame = rl.load(spark, layouts["nine"])
    assert numbered(rl.select_rows(frame, "999:0:-1, 0:50, 7, 500:3:-7")) == [
        *range(999, 0, -1), *range(50), 7, *range(500, 3, -7)
    ]
    monkeypatch.setattr(rows, "SELECTION_EXPRESSIONS", 1)
    assert numbered(rl.select_rows(frame, "20, 3, 3, 900:880:-3")) == [20, 3, 3, *range(900, 880, -3)]
    monkeypatch.setattr(rows, "SELECTION_BROADCAST_ROWS", 10)
    assert numbered(rl.select_rows(frame, "999:0:-1, 0:50")) == [*range(999, 0, -1), *range(50)]


def test_top_k_over_very_many_tasks(monkeypatch, spark, layouts, event_rows):
    import rowloom.plans.order as order

    monkeypatch.setattr(order, "FAN_IN_ROWS", 10)
    monkeypatch.setattr(order, "TASK_BYTES", 100)
    frame = rl.sort_rows(rl.load(spark, layouts["nine"]), "value", reverse=True)
    expected = [r["event_id"] for r in sorted(event_rows, key=lambda r: -r["value"])]
    top = rl.take_rows(frame, 40)
    assert "WindowGroupLimit" in top.df._jdf.queryExecution().executedPlan().toString()
    assert ids(top) == expected[:40]


def test_nulls_and_nan_sort_last_both_ways(spark):
    nan = float("nan")
    rows = [(0, nan), (1, None), (2, 2.0), (3, float("-inf")), (4, nan), (5, None), (6, 2.0), (7, float("inf"))]
    frame = rl.from_dataframe(spark.createDataFrame(rows, "event_id int, v double"), key="event_id")
    assert ids(rl.sort_rows(frame, "v")) == [3, 2, 6, 7, 0, 4, 1, 5]
    assert ids(rl.sort_rows(frame, "v", reverse=True)) == [7, 2, 6, 3, 0, 4, 1, 5]
    values = [row.v for row in rl.unique_values(frame, "v").rows().collect()]
    assert [repr(v) for v in values] == ["nan", "None", "2.0", "-inf", "inf"]


def test_sort_keeps_working_after_its_column_is_gone(spark, layouts, event_rows):
    frame = rl.sort_rows(rl.load(spark, layouts["nine"]), "value")
    expected = [r["event_id"] for r in sorted(event_rows, key=lambda r: r["value"])]
    assert ids(rl.remove_columns(frame, "value")) == expected
    assert ids(rl.rename_column(frame, "value", "v")) == expected
    assert ids(rl.map_column(frame, "value", "constant", "x")) == expected
    assert ids(rl.take_rows(rl.remove_columns(frame, "value"), 20)) == expected[:20]


def test_dataframe_without_key_keeps_its_order(spark):
    df = spark.range(100, numPartitions=7).selectExpr("99 - id AS event_id")
    assert numbered(rl.from_dataframe(df)) == list(range(99, -1, -1))


def test_column_names_used_inside_are_free(spark, tmp_path):
    names = ["start", "n", "upto", "at", "rows", "before", "inside", "place", "rank", "bytes", "event_id"]
    spark.range(200).selectExpr(*[f"id AS `{name}`" for name in names]).coalesce(1).write.parquet(f"{tmp_path}/x")
    frame = rl.load(spark, f"{tmp_path}/x/*.parquet")
    for name in ("start", "upto", "rank"):
        kept = rl.filter_rows(frame, name, ">=", "100")
        numbered_frame = rl.map_column(rl.skip_rows(kept, 5), "pos", "row index")
        first = numbered_frame.rows().first()
        assert (first["pos"], first["start"], first["rows"]) == (0, 105, 105)
        assert ids(rl.select_rows(rl.sort_rows(frame, name, True), "1, 0")) == [198, 199]
    assert sorted(ids(rl.take_rows(rl.shuffle(frame, 1), 200))) == list(range(200))


def test_selection_text():
    assert [list(r) for r in parse_selection("0, 2 ,4", 5)] == [[0], [2], [4]]
    assert [list(r) for r in parse_selection("0:10:2", 10)] == [[0, 2, 4, 6, 8]]
    assert [list(r) for r in parse_selection("7:,:2", 9)] == [[7, 8], [0, 1]]
    assert [list(r) for r in parse_selection("5:5", 9)] == [[]]
    for bad, message in (
        ("", "indices"),
        ("9", "goes beyond"),
        ("-1", "goes beyond"),
        ("0:100", "goes beyond"),
        ("a,b", "no row number"),
        ("1:2:x", "no row number"),
        ("1:2:3:4", "colons"),
        ("1:4:0", "step"),
    ):
        with pytest.raises(ValueError, match=message):
            parse_selection(bad, 5)


def test_empty_dataset(spark):
    frame = rl.from_dataframe(spark.createDataFrame([], "event_id int"), key="event_id")
    assert rl.count_rows(frame) == 0
    for empty in (rl.take_rows(frame, 3), rl.skip_rows(frame, 3), rl.shuffle(frame, 1), rl.take_shard(frame, 3, 2)):
        assert ids(empty) == []
    assert numbered(frame) == []
    with pytest.raises(ValueError, match="goes beyond"):
        rl.select_rows(frame, "0:1")


@pytest.mark.parametrize("reverse", [False, True])
@pytest.mark.parametrize("top", [1000, 0])
def test_cuts_of_a_sort_write_nothing(spark, monkeypatch, reverse, top):
    """Pages, shards, splits and selections of a sort with nulls, NaN and ties: filters on its keys."""
    import datetime as dt

    from rowloom.plans import order

    monkeypatch.setattr(order, "TOP_K", top)
    monkeypatch.setattr(order, "write_rows", lambda df: pytest.fail("a copy was written"))
    nan, inf = float("nan"), float("inf")
    scores = [3.0, None, nan, 1.5, 3.0, -inf, None, 0.0, inf, nan, 3.0, -2.0] * 3
    day = dt.datetime(2024, 3, 31, 1, 30)
    rows = [(i, s, None if i % 5 == 0 else day + dt.timedelta(minutes=i % 7), bytes([i % 3])) for i, s in enumerate(scores)]
    df = spark.createDataFrame(rows, "event_id int, s double, t timestamp_ntz, b binary")
    frame = rl.from_dataframe(df.withColumn("z", F.col("t").cast("timestamp")), key="event_id")

    def place(column):
        """Row numbers in order: values, NaN, nulls; ties as they come."""
        empty = [r for r in rows if r[column] is None]
        odd = [r for r in rows if r[column] is not None and r[column] != r[column]]
        plain = [r for r in rows if r not in empty and r not in odd]
        plain.sort(key=lambda r: r[column], reverse=reverse)
        return [r[0] for r in plain + odd + empty]

    for name, column in (("s", 1), ("t", 2), ("z", 2), ("b", 3)):
        want = place(column)
        by = rl.sort_rows(frame, name, reverse)
        if name != "s":  # the other types: one page each
            assert ids(rl.take_rows(rl.skip_rows(by, 30), 5)) == want[30:35]
            continue
        assert ids(by) == want
        assert ids(rl.take_rows(rl.skip_rows(by, 10), 7)) == want[10:17]
        assert ids(rl.skip_rows(rl.take_rows(by, 30), 28)) == want[28:30]
        assert ids(rl.skip_rows(by, 99)) == [] and ids(rl.take_rows(by, 99)) == want
        assert [ids(rl.take_shard(by, 5, i)) for i in range(5)] == [want[:8], want[8:15], want[15:22], want[22:29], want[29:]]
        train, test = rl.train_test_split(by, 0.25, shuffle=False)
        assert (ids(train), ids(test)) == (want[:27], want[27:])
        assert ids(rl.select_rows(by, "4:9")) == want[4:9]


def test_only_the_first_files_are_counted(spark, tmp_path):
    for i in range(30):
        spark.range(i * 10, i * 10 + 10).withColumnRenamed("id", "event_id").coalesce(1).write.parquet(f"{tmp_path}/{i:03d}")
    frame = rl.load(spark, f"{tmp_path}/*/*.parquet")
    first = rl.take_rows(frame, 15)
    assert ids(first) == list(range(15)) and len(frame.files.counts) <= 9
    assert ids(rl.take_rows(rl.skip_rows(frame, 95), 10)) == list(range(95, 105))
    assert len(frame.files.counts) < 30
    assert rl.count_rows(frame) == 300 and ids(rl.skip_rows(frame, 290)) == list(range(290, 300))
    assert ids(rl.take_rows(frame, 999)) == list(range(300)) and ids(rl.skip_rows(frame, 300)) == []
    assert rl.count_rows(rl.take_rows(frame, 999)) == 300


def opened(df):
    return {r.f.rsplit("/", 2)[-2] for r in df.selectExpr("input_file_name() AS f").distinct().collect()}


def test_far_indices_open_only_their_files(spark, tmp_path, monkeypatch):
    from rowloom.sources import files

    for i in range(20):
        rows = spark.range(i * 50, i * 50 + 50).withColumnRenamed("id", "event_id")
        rows.coalesce(1).write.parquet(f"{tmp_path}/{i:02d}")
    frame = rl.load(spark, f"{tmp_path}/*/*.parquet")
    far = rl.select_rows(frame, "5, 994, 5")
    assert ids(far) == [5, 994, 5] and far.df.rdd.getNumPartitions() <= 2
    assert opened(far.df) == {"00", "19"}
    steps = rl.select_rows(frame, "990:100:-300, 1:999:450")
    assert ids(steps) == [990, 690, 390, 1, 451, 901] and opened(steps.df) == {"00", "07", "09", "13", "18", "19"}
    late = rl.select_rows(rl.skip_rows(frame, 120), "3, 700, 0")
    assert ids(late) == [123, 820, 120] and opened(late.df) == {"02", "16"}
    monkeypatch.setattr(files, "MOST_RUNS", 2)
    many = rl.select_rows(frame, ", ".join(str(i) for i in (0, 110, 120, 240, 980)))
    assert ids(many) == [0, 110, 120, 240, 980] and opened(many.df) == {"00", "02", "04", "19"}
    assert len(frame.files.runs([(0, 0, 1), (110, 110, 1), (240, 240, 1), (980, 980, 1)])) == 2
    listed = rl.select_rows(rl.filter_rows(frame, "event_id", ">=", "10"), "0, 900, 1")
    assert ids(listed) == [10, 910, 11]
