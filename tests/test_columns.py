import pytest

import rowloom as rl


@pytest.fixture(scope="module")
def frame(spark):
    df = spark.createDataFrame([(i, f"row-{i}", i % 2) for i in range(6)], "id int, text string, label int")
    return rl.from_dataframe(df, key="id")


def rows(frame):
    return [tuple(row) for row in frame.rows().collect()]


def test_select_in_listed_order(frame):
    out = rl.select_columns(frame, " label ,id")
    assert out.columns == ["label", "id"] and rows(out)[:2] == [(0, 0), (1, 1)]


def test_remove(frame):
    assert rl.remove_columns(frame, "label").columns == ["id", "text"]
    out = rl.remove_columns(frame, "id, label")  # the order key goes, the order stays
    assert rows(out) == [(f"row-{i}",) for i in range(6)]


def test_rename(frame):
    out = rl.rename_column(frame, " id ", " number ")
    assert out.columns == ["number", "text", "label"] and rows(out) == rows(frame)
    assert rl.rename_column(frame, "id", "id") is frame


def test_map_constant_is_text_and_not_trimmed(frame):
    out = rl.map_column(frame, "label", "constant", " 1 ")
    assert out.columns == ["id", "text", "label"] and rows(out)[0] == (0, "row-0", " 1 ")
    out = rl.map_column(frame, "text", "constant", "")
    assert out.columns == ["id", "label", "text"] and rows(out)[5] == (5, 1, "")


def test_map_copy(frame):
    assert rl.map_column(frame, "twin", "copy column", " text ").columns == ["id", "text", "label", "twin"]
    assert rows(rl.map_column(frame, "id", "copy column", "label")) == [(f"row-{i}", i % 2, i % 2) for i in range(6)]
    assert rl.map_column(frame, "id", "copy column", "id") is frame


def test_map_row_index_counts_the_present_rows(frame):
    out = rl.map_column(rl.filter_rows(frame, "label", "==", "1"), "id", "row index")
    assert rows(out) == [("row-1", 1, 0), ("row-3", 1, 1), ("row-5", 1, 2)]


def test_flatten(spark):
    df = spark.sql(
        """SELECT id, IF(id = 1, NULL, named_struct('a', id, 'b', named_struct('c', array(named_struct('d', id)),
           'e', map('k', id)))) AS s, named_struct('x', 1) AS t FROM range(2)"""
    )
    out = rl.flatten(rl.from_dataframe(df, key="id"))
    assert out.columns == ["id", "s.a", "s.b.c", "s.b.e", "t.x"]
    first, second = out.rows().collect()
    assert (first[1], first[2][0].d, first[3], first[4]) == (0, 0, {"k": 0}, 1)
    assert tuple(second) == (1, None, None, None, 1)
    again = rl.flatten(out)
    assert again.columns == out.columns
    assert rl.select_columns(out, "s.a").columns == ["s.a"]


def test_flatten_name_clash(spark):
    df = spark.sql("SELECT id, named_struct('a', 1) AS s, 2 AS `s.a` FROM range(1)")
    with pytest.raises(ValueError, match="s.a"):
        rl.flatten(rl.from_dataframe(df, key="id"))


def test_guards(frame):
    for call, message in (
        (lambda: rl.select_columns(frame, " , "), "at least one"),
        (lambda: rl.select_columns(frame, "id, nope"), "Unknown columns 'nope'"),
        (lambda: rl.select_columns(frame, "id, id"), "twice"),
        (lambda: rl.remove_columns(frame, "nope"), "Unknown columns"),
        (lambda: rl.remove_columns(frame, "id,text,label"), "empty"),
        (lambda: rl.rename_column(frame, "", "x"), "blank"),
        (lambda: rl.rename_column(frame, "id", " "), "blank"),
        (lambda: rl.rename_column(frame, "nope", "x"), "Unknown column to rename"),
        (lambda: rl.rename_column(frame, "id", "text"), "already exists"),
        (lambda: rl.rename_column(frame, "id", "TEXT"), "case"),
        (lambda: rl.map_column(frame, " ", "constant", "x"), "has no name"),
        (lambda: rl.map_column(frame, "x", "copy column", "nope"), "source column"),
        (lambda: rl.map_column(frame, "x", "explode", ""), "cannot be filled"),
        (lambda: rl.map_column(frame, "__rl_pos", "constant", "x"), "reserved"),
        (lambda: rl.sort_rows(frame, "nope"), "Unknown sort column"),
        (lambda: rl.take_rows(frame, -1), "at least 0"),
        (lambda: rl.skip_rows(frame, -1), "at least 0"),
        (lambda: rl.shuffle(frame, -1), "seed"),
        (lambda: rl.take_shard(frame, 2, 2), "There is no shard"),
        (lambda: rl.take_shard(frame, 0, 0), "num_shards"),
        (lambda: rl.take_shard(frame, 2, -1), "index"),
        (lambda: rl.train_test_split(frame, 0.0), "between"),
        (lambda: rl.train_test_split(frame, 1.0), "between"),
        (lambda: rl.unique_values(frame, ""), "blank"),
        (lambda: rl.to_list(frame, "nope"), "There is no column 'nope'"),
        (lambda: rl.to_list(frame, limit=-2), "limit"),
        (lambda: rl.count_rows("x"), "Expected a dataset"),
    ):
        with pytest.raises(ValueError, match=message):
            call()


def test_lists(frame):
    assert rl.to_list(frame, limit=2) == [{"id": i, "text": f"row-{i}", "label": i % 2} for i in range(2)]
    assert rl.to_list(frame, "text", limit=None) == [f"row-{i}" for i in range(6)]
    assert rl.to_list(frame, limit=0) == []
    assert rl.to_list(frame, " label ") == [0, 1] * 3
    assert list(rl.iterate(frame, "id", 3)) == [0, 1, 2]
    assert sorted(row[0] for row in rl.to_data_list(frame, "id", ordered=False).collect()) == list(range(6))


def test_bytes(spark):
    df = spark.sql(
        """SELECT 0 AS id, encode('café', 'utf-8') AS ok, X'FFFE' AS bad, CAST(NULL AS BINARY) AS none,
           named_struct('a', array(X'C3A9'), 'm', map('k', X'80')) AS deep"""
    )
    (row,) = rl.to_list(rl.from_dataframe(df, key="id"))
    assert row == {"id": 0, "ok": "café", "bad": "fffe", "none": None, "deep": {"a": ["é"], "m": {"k": "80"}}}
    frame = rl.from_dataframe(spark.sql("SELECT id, X'C3A9' AS b FROM range(3)"), key="id")
    assert [row.b for row in rl.unique_values(frame, "b").rows().collect()] == ["é"]
