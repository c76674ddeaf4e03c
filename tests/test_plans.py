"""What the physical plans do and, above all, do not do."""

import re

import pytest

import rowloom as rl


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def pushed(df):
    return "".join(re.findall(r"PushedFilters: \[.*\], ReadSchema", plan(df)))


@pytest.fixture
def frame(spark, layouts):
    return rl.load(spark, layouts["nine"])


def scan_columns(df):
    return re.search(r"ReadSchema: struct<(.*?)>", plan(df)).group(1)


@pytest.mark.parametrize(
    ("operator", "value", "expected"),
    [
        ("==", "3", "EqualTo(user_id,3)"),
        ("!=", "3", "Not(EqualNullSafe(user_id,3))"),
        ("<", "3.5", "LessThanOrEqual(user_id,3)"),
        (">=", "3", "GreaterThanOrEqual(user_id,3)"),
        ("in", "3, 4", "In(user_id, [3,4])"),
        ("not in", "3, 4", "Not(In(user_id, [3,4]))"),
        ("is null", "", "IsNull(user_id)"),
    ],
)
def test_filters_reach_parquet(spark, layouts, operator, value, expected):
    kept = rl.filter_rows(rl.load(spark, layouts["one"]), "user_id", operator, value)
    assert expected in pushed(rl.select_columns(kept, "event_id").unordered_rows())


def test_float_and_text_filters_reach_parquet(frame):
    kept = rl.filter_rows(rl.filter_rows(frame, "value", ">", "3"), "event_type", "starts with", "cl")
    text = pushed(rl.map_column(kept, "at", "row index").unordered_rows())
    assert "GreaterThan(value,3.0)" in text and "StringStartsWith(event_type,cl)" in text


def test_only_needed_columns_are_read(frame):
    out = rl.select_columns(rl.filter_rows(frame, "value", ">", "3"), "event_id").unordered_rows()
    assert scan_columns(out) == "event_id:bigint,value:double"
    assert "Exchange" not in plan(out)
    assert scan_columns(rl.count_table(frame)) == ""
    assert "event_type" in scan_columns(rl.unique_values(frame, "event_type").df)
    assert "props" not in scan_columns(rl.unique_values(frame, "event_type").df)


def test_cut_of_a_scan_is_a_filter_and_opens_few_files(frame):
    cut = rl.take_rows(rl.skip_rows(frame, 5), 20)
    text = plan(cut.unordered_rows())
    assert "Exchange" not in text and "Join" not in text and "Window" not in text
    files = cut.unordered_rows().selectExpr("input_file_name() AS f").distinct().collect()
    assert len(files) == 3
    (folder,) = {f.f.rsplit("/", 1)[0] for f in files}
    assert folder
    # the first three of nine files are the only ones planned
    assert cut.df.rdd.getNumPartitions() <= 3


def test_take_after_filter_and_split_do_not_shuffle_rows(frame):
    kept = rl.filter_rows(frame, "event_type", "==", "click")
    for piece in (
        rl.take_rows(kept, 20),
        rl.skip_rows(kept, 20),
        rl.take_shard(kept, 4, 2),
        *rl.train_test_split(kept, 0.2, shuffle=False),
        *rl.train_test_split(frame, 0.2, seed=1),
    ):
        text = plan(piece.unordered_rows())
        assert "hashpartitioning" not in text and "rangepartitioning" not in text and "SinglePartition" not in text


def test_row_index_of_a_scan_needs_no_shuffle_of_rows(frame):
    text = plan(rl.map_column(frame, "at", "row index").unordered_rows())
    assert "BroadcastHashJoin" in text
    assert "hashpartitioning" not in text and "SinglePartition" not in text


def test_row_index_after_filter_shuffles_rows_once(frame):
    kept = rl.filter_rows(frame, "event_type", "==", "click")
    text = plan(rl.map_column(kept, "at", "row index").unordered_rows())
    rows_side = text.split(":- ", 1)[1].split("\n      +- ", 1)[0]
    assert rows_side.count("Exchange hashpartitioning") == 1
    assert text.count("SinglePartition") == 1  # the bucket table: one small row per bucket


def test_whole_rows_never_go_to_one_task(frame):
    kept = rl.filter_rows(frame, "event_type", "==", "click")
    for out in (
        frame.rows(),
        rl.sort_rows(kept, "value").rows(),
        rl.shuffle(kept, 1).rows(),
        rl.take_shard(frame, 3, 1, contiguous=False).unordered_rows(),
        rl.select_rows(frame, "5::3").unordered_rows(),
        rl.select_rows(frame, "7, 3, 500:1:-1").unordered_rows(),
        rl.unique_values(frame, "user_id").rows(),
    ):
        assert "SinglePartition" not in plan(out)


def test_index_lists_need_no_join(spark, layouts):
    text = plan(rl.select_rows(rl.load(spark, layouts["one"]), "7, 3, 500:1:-1").unordered_rows())
    assert "Join" not in text and "Exchange" not in text


def test_float32_filters_reach_parquet(spark, tmp_path):
    spark.sql("SELECT CAST(id AS FLOAT) AS x FROM range(9)").write.parquet(f"{tmp_path}/x.parquet")
    frame = rl.load(spark, f"{tmp_path}/x.parquet")
    for operator, value in ((">", "0.1"), ("<=", "3"), ("in", "2, 2.5")):
        kept = rl.filter_rows(frame, "x", operator, value)
        assert re.search(r"(GreaterThanOrEqual|LessThanOrEqual|EqualTo|In)\(x,", pushed(kept.unordered_rows()))

def test_paths_are_not_shuffled_with_rows(frame):
    for out in (frame.rows(), rl.sort_rows(frame, "value").rows(), rl.shuffle(frame, 1).rows()):
        exchange = [line for line in plan(out).splitlines() if "Exchange rangepartitioning" in line]
        assert exchange and all("__rl_file" not in line for line in exchange)


def test_unique_is_one_hash_aggregation(frame):
    text = plan(rl.unique_values(frame, "event_type").df)
    assert text.count("HashAggregate") == 2 and "SortAggregate" not in text


def test_top_k_uses_a_bounded_heap(frame):
    assert "TakeOrderedAndProject" in plan(rl.take_rows(rl.sort_rows(frame, "value"), 10).unordered_rows())


def test_take_of_text_opens_only_the_first_files(spark, tmp_path):
    for i in range(20):
        (tmp_path / f"part-{i:02d}.txt").write_text(f"line {i}\n" * 3)
    head = rl.take_rows(rl.load(spark, f"{tmp_path}/*.txt"), 5)
    assert head.df.rdd.getNumPartitions() <= 8
    assert rl.to_list(head, "text") == ["line 0"] * 3 + ["line 1"] * 2
