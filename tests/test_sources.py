"""Formats, dataset directories, splits and slices."""

import gzip
import json

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import rowloom as rl
from rowloom.sources.formats import extension_of, infer_format
from rowloom.sources.splits import parse_split, resolve_split

ROWS = [{"id": i, "text": f'say "{i}", twice\nor not' if i % 3 == 0 else f"row-{i}", "x": i / 4} for i in range(20)]


def read(frame):
    return rl.to_list(rl.map_column(frame, "at", "row index"))


def expected(rows):
    return [{**row, "at": i} for i, row in enumerate(rows)]


def write_parquet(path, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    pq.write_table(pa.Table.from_pylist(rows), path)


@pytest.mark.parametrize(
    ("path", "fmt"),
    [
        ("/a/b.csv", "csv"),
        ("/a/b.TSV", "csv"),
        ("data.jsonl", "json"),
        ("x.ndjson", "json"),
        ("x.json", "json"),
        ("https://x/y.parquet?token=abc#part", "parquet"),
        ("/a/b.arrow", "arrow"),
        ("notes.txt", "text"),
        ("a.csv.gz", "csv"),
        ("data/part-?.parquet", "parquet"),
        ("org/dataset", None),
        ("/a/dir_without_ext", None),
        ("/a/file.xyz", None),
    ],
)
def test_format_from_path(path, fmt):
    assert infer_format(path) == fmt


def test_extension_of_compressed():
    assert extension_of("a/b.TSV.GZ") == ".tsv"


def test_csv_and_tsv(spark, tmp_path):
    import csv

    for name, sep in (("t.csv", ","), ("t.tsv", "\t")):
        with open(tmp_path / name, "w", newline="") as file:
            writer = csv.DictWriter(file, ["id", "text", "x"], delimiter=sep)
            writer.writeheader()
            writer.writerows(ROWS)
        assert read(rl.load(spark, str(tmp_path / name))) == expected(ROWS)
        assert rl.load(spark, str(tmp_path / name)).df.schema["x"].dataType.typeName() == "double"


def test_csv_options_and_gzip(spark, tmp_path):
    with gzip.open(tmp_path / "t.csv.gz", "wt") as file:
        file.write("a;b\n1;2\n")
    frame = rl.load(spark, str(tmp_path / "t.csv.gz"), sep=";", schema="a string, b string")
    assert read(frame) == [{"a": "1", "b": "2", "at": 0}]


def test_csv_is_split(spark, tmp_path, small_splits):
    rows = [{"id": i, "text": f'a "quoted" word, {i}'} for i in range(500)]
    lines = ['id,text', *(f'{r["id"]},"{r["text"].replace(chr(34), chr(34) * 2)}"' for r in rows)]
    (tmp_path / "flat.csv").write_text("\n".join(lines) + "\n")
    frame = rl.load(spark, str(tmp_path / "flat.csv"))
    assert frame.df.rdd.getNumPartitions() > 8
    assert read(frame) == expected(rows)
    (tmp_path / "spans.csv").write_text("\n".join(lines) + '\n500,"two\nlines"\n')
    frame = rl.load(spark, str(tmp_path / "spans.csv"))
    assert read(frame)[-1] == {"id": 500, "text": "two\nlines", "at": 500}


def test_json_lines_arrays_and_documents(spark, tmp_path):
    for name in ("a.jsonl", "a.ndjson", "a.json"):
        (tmp_path / name).write_text("".join(json.dumps(row) + "\n" for row in ROWS))
        assert read(rl.load(spark, str(tmp_path / name))) == expected(ROWS)
    (tmp_path / "one_line.json").write_text(json.dumps(ROWS))
    (tmp_path / "pretty.json").write_text(json.dumps(ROWS, indent=2))
    (tmp_path / "single.json").write_text(json.dumps(ROWS[0], indent=2))
    assert read(rl.load(spark, str(tmp_path / "one_line.json"))) == expected(ROWS)
    assert read(rl.load(spark, str(tmp_path / "pretty.json"))) == expected(ROWS)
    assert read(rl.load(spark, str(tmp_path / "single.json"))) == expected(ROWS[:1])


def test_text_keeps_blank_lines(spark, tmp_path):
    (tmp_path / "t.txt").write_text("one\n\n  two \nthree")
    assert read(rl.load(spark, str(tmp_path / "t.txt"))) == expected(
        [{"text": "one"}, {"text": ""}, {"text": "  two "}, {"text": "three"}]
    )


@pytest.fixture(scope="module")
def many_lines(tmp_path_factory):
    """Text files of different sizes; the largest one is cut into many splits."""
    folder = tmp_path_factory.mktemp("lines")
    lines = [f"line {i}" for i in range(3000)]
    edges = [0, 5, 5, 2600, 2610, 3000]
    for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
        (folder / f"part-{i}.txt").write_text("".join(line + "\n" for line in lines[a:b]))
    return folder, lines


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000b")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_line_order_over_files_and_splits(spark, many_lines, small_splits):
    folder, lines = many_lines
    frame = rl.load(spark, f"{folder}/*.txt")
    assert frame.df.rdd.getNumPartitions() > 8
    assert rl.to_list(frame, "text") == lines
    assert rl.to_list(rl.take_rows(frame, 7), "text") == lines[:7]
    assert rl.to_list(rl.take_rows(frame, 2607), "text") == lines[:2607]
    assert rl.to_list(rl.skip_rows(frame, 2598), "text") == lines[2598:]
    some = rl.filter_rows(frame, "text", "ends with", "7")
    sevens = [line for line in lines if line.endswith("7")]
    assert rl.to_list(rl.take_rows(some, 40), "text") == sevens[:40]
    assert [row["at"] for row in read(some)] == list(range(300))
    assert rl.to_list(rl.sort_rows(frame, "text", reverse=True), "text") == sorted(lines, reverse=True)
    assert [r.text for r in rl.unique_values(some, "text").rows().collect()] == sevens
    assert sorted(rl.to_list(rl.shuffle(frame, 1), "text")) == sorted(lines)
    assert rl.to_list(rl.concat([rl.take_rows(frame, 3), some]), "text") == lines[:3] + sevens
    assert rl.to_list(rl.concat([frame, frame]), "text", 3003)[2998:] == lines[2998:] + lines[:3]
    assert rl.count_rows(frame) == 3000


def write_arrow(path, rows, size, stream):
    table = pa.Table.from_pylist(rows)
    with (pa.ipc.new_stream if stream else pa.ipc.new_file)(str(path), table.schema) as writer:
        writer.write_table(table, max_chunksize=size)


@pytest.mark.parametrize("stream", [False, True])
def test_arrow(spark, tmp_path, stream, monkeypatch):
    import rowloom.sources.arrow_ipc as arrow_ipc

    monkeypatch.setattr(arrow_ipc, "RUN_ROWS", 10)
    rows = [{"id": i, "text": f"row-{i}", "v": [i, -i], "s": {"a": i}} for i in range(500)]
    write_arrow(tmp_path / "a.arrow", rows[:400], 7, stream)
    write_arrow(tmp_path / "b.arrow", rows[400:], 1000, stream)
    frame = rl.load(spark, f"{tmp_path}/*.arrow")
    assert read(frame) == expected(rows)
    assert rl.count_rows(frame) == 500
    assert rl.to_list(rl.take_rows(rl.skip_rows(frame, 395), 10), "id") == list(range(395, 405))
    odd = rl.select_columns(rl.filter_rows(frame, "text", "ends with", "1"), "id")
    assert rl.to_list(rl.take_rows(odd, 45), "id") == list(range(1, 450, 10))
    assert read(odd)[-1] == {"id": 491, "at": 49}
    assert rl.load(spark, f"{tmp_path}/*.arrow", columns=["id"]).columns == ["id"]


def test_take_of_arrow_opens_only_the_first_files(spark, tmp_path):
    for i in range(6):
        write_arrow(tmp_path / f"{i}.arrow", [{"id": i * 10 + j} for j in range(10)], 4, False)
    frame = rl.load(spark, f"{tmp_path}/*.arrow")
    head = rl.take_rows(rl.filter_rows(frame, "id", ">=", "0"), 15)
    table = frame.files.paths  # listed; now make the later files unreadable
    for path in table[2:]:
        with open(path.removeprefix("file:"), "wb") as file:
            file.write(b"x")
    assert rl.to_list(rl.take_rows(rl.map_column(frame, "c", "constant", "k"), 15), "id") == list(range(15))
    del head


def test_explicit_loader_beats_extension(spark, tmp_path):
    (tmp_path / "data.csv").write_text('{"a": 1}\n')
    assert read(rl.load(spark, str(tmp_path / "data.csv"), loader="json")) == [{"a": 1, "at": 0}]
    (tmp_path / "noext").write_text("x\n")
    assert read(rl.load(spark, str(tmp_path / "noext"), loader="text")) == [{"text": "x", "at": 0}]


def test_force_reload_sees_new_rows(spark, tmp_path):
    write_parquet(tmp_path / "d" / "a.parquet", ROWS[:3])
    assert rl.count_rows(rl.load(spark, f"{tmp_path}/d/*.parquet")) == 3
    write_parquet(tmp_path / "d" / "b.parquet", ROWS[3:5])
    assert read(rl.load(spark, f"{tmp_path}/d/*.parquet", reload_tick=1)) == expected(ROWS[:5])


# -- directories and splits ---------------------------------------------------------------


def splits(spark, path, **kwargs):
    rows = rl.list_splits(spark, str(path), **kwargs).collect()
    return {row["split"]: (row["files"], row["is_default"]) for row in rows}


def test_split_names_in_files_and_folders(spark, tmp_path):
    write_parquet(tmp_path / "a" / "train-00000-of-00002.parquet", ROWS[:2])
    write_parquet(tmp_path / "a" / "train-00001-of-00002.parquet", ROWS[2:3])
    write_parquet(tmp_path / "a" / "val.parquet", ROWS[3:5])
    write_parquet(tmp_path / "a" / "unsupervised-00000-of-00001.parquet", ROWS[5:9])
    (tmp_path / "a" / "README.md").write_text("not data")
    assert splits(spark, tmp_path / "a") == {"train": (2, True), "validation": (1, False), "unsupervised": (1, False)}
    assert read(rl.load(spark, str(tmp_path / "a"))) == expected(ROWS[:3])
    assert read(rl.load(spark, f" {tmp_path}/a/ ", split="unsupervised")) == expected(ROWS[5:9])
    with pytest.raises(ValueError, match="here, only: train, validation, unsupervised"):
        rl.load(spark, str(tmp_path / "a"), split="test")

    write_parquet(tmp_path / "b" / "data" / "testing" / "x.parquet", ROWS[:4])
    write_parquet(tmp_path / "b" / "data" / "dev" / "x.parquet", ROWS[4:6])
    assert splits(spark, tmp_path / "b") == {"validation": (1, True), "test": (1, False)}
    assert read(rl.load(spark, str(tmp_path / "b"))) == expected(ROWS[4:6])  # plain train falls back
    with pytest.raises(ValueError, match="here, only: validation, test"):
        rl.load(spark, str(tmp_path / "b"), split="train[:1]")

    write_parquet(tmp_path / "c" / "split=odd" / "x.parquet", ROWS[1:2])
    assert splits(spark, tmp_path / "c") == {"odd": (1, True)}
    write_parquet(tmp_path / "d" / "part.parquet", ROWS[:6])
    assert splits(spark, tmp_path / "d") == {"train": (1, True)}
    assert read(rl.load(spark, str(tmp_path / "d"))) == expected(ROWS[:6])


def test_odd_characters_in_paths(spark, tmp_path):
    root = tmp_path / "my dir é%41+x"
    for i, name in enumerate(("train a.parquet", "train b+c.parquet", "train [1] {x}.parquet", "test.parquet")):
        write_parquet(root / name, ROWS[i : i + 1])
    assert rl.to_list(rl.load(spark, str(root)), "id") == [2, 0, 1]  # path order
    assert splits(spark, root) == {"train": (3, True), "test": (1, False)}
    frame = rl.load(spark, str(root), split="train", streaming=True)
    assert rl.to_list(rl.drain(rl.skip_rows(frame, 1)), "id") == [0, 1]
    assert rl.to_list(rl.take_shard(frame, 3, 1), "id") == [0]
    (root / "t").mkdir()
    (root / "t" / "x y.txt").write_text("1\n2\n")
    (root / "t" / "x z.txt").write_text("3\n")
    assert rl.to_list(rl.load(spark, f"{root}/t/*.txt"), "text") == ["1", "2", "3"]
    write_arrow(root / "t" / "q r.arrow", ROWS[:3], 2, False)
    assert rl.to_list(rl.load(spark, f"{root}/t/*.arrow"), "id") == [0, 1, 2]


def test_different_readers_are_an_error(spark, tmp_path):
    write_parquet(tmp_path / "p1.parquet", ROWS[:1])
    write_parquet(tmp_path / "p2.parquet", ROWS[1:2])
    (tmp_path / "notes.txt").write_text("x\n")
    with pytest.raises(ValueError, match="mixes formats"):
        rl.load(spark, str(tmp_path))


def ids(frame, column="a"):
    return rl.to_list(frame, column)


def test_extensions_of_one_reader(spark, tmp_path):
    for name, lines in (("train-0.jsonl", [1, 2]), ("train-1.json", [3]), ("train-2.ndjson", [4])):
        (tmp_path / name).write_text("".join(f'{{"a": {i}}}\n' for i in lines))
    assert ids(rl.load(spark, str(tmp_path))) == [1, 2, 3, 4]
    assert ids(rl.drain(rl.load(spark, str(tmp_path), streaming=True))) == [1, 2, 3, 4]
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "x.csv").write_text("a,b\n1,2\n")
    (tmp_path / "t" / "y.tsv").write_text("b\ta\n4\t3\n")
    assert rl.to_list(rl.load(spark, str(tmp_path / "t"))) == [{"a": 1, "b": 2}, {"a": 3, "b": 4}]


def test_json_documents_and_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"a": {"x": 1}\n, "b": 2}\n')
    assert rl.to_list(rl.load(spark, str(tmp_path / "a.json"))) == [{"a": {"x": 1}, "b": 2}]
    for big, name in ((3, "document first"), (60, "lines first")):
        root = tmp_path / name
        root.mkdir()
        rows = ",\n".join(f'{{"a": {i},\n "b": "x"}}' for i in range(big))
        (root / "one.json").write_text(f"\n[\n{rows}\n]\n")
        (root / "two.json").write_text('{"a": 100.5}\n\n{"a": 101}\n')
        frame = rl.load(spark, str(root))
        assert frame.columns == ["a", "b"]
        assert ids(frame) == [*map(float, range(big)), 100.5, 101.0]
        with pytest.raises(ValueError, match="one layout"):
            rl.load(spark, str(root), streaming=True)


def test_csv_columns_are_matched_by_name(spark, tmp_path):
    (tmp_path / "1.csv").write_text("a,b\n1,x\n")
    (tmp_path / "2.csv").write_text('b,a\n"y\nz",2\n')
    (tmp_path / "3.csv").write_text("c,a\n7,word\n")
    (tmp_path / "4.csv").write_text("")
    rows = [{"a": "1", "b": "x", "c": None}, {"a": "2", "b": "y\nz", "c": None}, {"a": "word", "b": None, "c": 7}]
    assert rl.to_list(rl.load(spark, f"{tmp_path}/*.csv")) == rows
    typed = rl.load(spark, f"{tmp_path}/[12].csv", schema="a int, b string")
    assert rl.to_list(typed) == [{"a": 1, "b": "x"}, {"a": 2, "b": "y\nz"}]
    (tmp_path / "q").mkdir()
    (tmp_path / "q" / "x.csv").write_text("a,b\n'it\ngoes',2\n")
    assert rl.to_list(rl.load(spark, f"{tmp_path}/q/x.csv", quote="'")) == [{"a": "it\ngoes", "b": 2}]


def test_schemas_are_united(spark, tmp_path):
    write_parquet(tmp_path / "p" / "1.parquet", [{"a": 1}])
    write_parquet(tmp_path / "p" / "2.parquet", [{"a": 2, "extra": "e"}])
    write_arrow(tmp_path / "1.arrow", [{"a": 1}], 1, False)
    write_arrow(tmp_path / "2.arrow", [{"a": 2, "extra": "e"}], 1, True)
    rows = [{"a": 1, "extra": None}, {"a": 2, "extra": "e"}]
    assert rl.to_list(rl.load(spark, f"{tmp_path}/p/*.parquet")) == rows
    assert rl.to_list(rl.load(spark, f"{tmp_path}/*.arrow")) == rows
    write_arrow(tmp_path / "3.arrow", [{"a": "text"}], 1, False)
    with pytest.raises(ValueError, match="different types"):
        rl.load(spark, f"{tmp_path}/*.arrow")


def test_streams_take_the_files_of_the_batch(spark, tmp_path):
    write_parquet(tmp_path / "r" / "train-0.PARQUET", ROWS[:2])
    write_parquet(tmp_path / "r" / "@v2" / "train-0.parquet", ROWS[2:4])
    write_parquet(tmp_path / "r" / "loose.parquet", ROWS[4:5])
    (tmp_path / "r" / "train-0.parquet.md").write_text("no data")
    frame = rl.load(spark, str(tmp_path / "r"))
    assert read(frame) == expected(ROWS[:2])
    assert ids(rl.drain(rl.load(spark, str(tmp_path / "r"), streaming=True)), "id") == ids(frame, "id")


def test_several_configs_need_a_name(spark, tmp_path):
    write_parquet(tmp_path / "en" / "train.parquet", ROWS[:1])
    write_parquet(tmp_path / "de" / "train.parquet", ROWS[1:2])
    with pytest.raises(ValueError, match=r"several configs \(de, en\)"):
        rl.load(spark, str(tmp_path))
    assert read(rl.load(spark, str(tmp_path), config="de")) == expected(ROWS[1:2])
    write_parquet(tmp_path / "s" / "train" / "x.parquet", ROWS[:1])
    write_parquet(tmp_path / "s" / "test" / "x.parquet", ROWS[1:2])
    assert splits(spark, tmp_path / "s") == {"train": (1, True), "test": (1, False)}


def test_mirror_with_config_and_revision(spark, tmp_path):
    base = tmp_path / "org" / "set"
    write_parquet(base / "first" / "train.parquet", ROWS[:2])
    write_parquet(base / "second" / "train.parquet", ROWS[2:4])
    write_parquet(base / "@old" / "second" / "train.parquet", ROWS[4:5])
    hub = str(tmp_path)
    assert read(rl.load(spark, "org/set", config="first", hub_root=hub)) == expected(ROWS[:2])
    assert read(rl.load(spark, "org/set", loader="hub", config=" second ", hub_root=hub)) == expected(ROWS[2:4])
    assert read(rl.load(spark, "org/set", config="second", revision="old", hub_root=hub)) == expected(ROWS[4:5])
    with pytest.raises(ValueError, match="several configs"):
        rl.list_splits(spark, "org/set", hub_root=hub)
    with pytest.raises(ValueError, match="Cannot list"):
        rl.load(spark, "org/set", config="third", hub_root=hub)


def test_splits_of_many_sources_in_one_table(spark, tmp_path):
    """A source whose splits cannot be told is a row with the reason."""
    base = tmp_path / "org" / "set"
    write_parquet(base / "first" / "train.parquet", ROWS[:2])
    write_parquet(base / "second" / "val.parquet", ROWS[2:4])
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "notes.md").write_text("not data")
    asked = [("org/set", "first"), ("org/set", "second"), ("org/set", ""), ("org/set", "third")]
    tables = [rl.list_splits(spark, path, config=c, hub_root=str(tmp_path), reasons=True) for path, c in asked]
    tables += [rl.list_splits(spark, path, reasons=True) for path in (f"{tmp_path}/empty", f"{tmp_path}/nowhere", "")]
    assert len({tuple((f.name, f.dataType) for f in table.schema) for table in tables}) == 1
    found = [table.collect() for table in tables]
    assert [(r.split, r.files, r.is_default, r.error) for rows in found[:2] for r in rows] == [
        ("train", 1, True, None),
        ("validation", 1, True, None),
    ]
    assert all(len(rows) == 1 and rows[0].split is None and rows[0].error for rows in found[2:])
    assert "several configs" in found[2][0].error and "Cannot list" in found[3][0].error


def test_single_files_have_one_split(spark, tmp_path):
    write_parquet(tmp_path / "test.parquet", ROWS[:2])
    assert splits(spark, tmp_path / "test.parquet") == {"train": (1, True)}
    assert read(rl.load(spark, str(tmp_path / "test.parquet"), split="  ")) == expected(ROWS[:2])
    with pytest.raises(ValueError, match="here, only: train"):
        rl.load(spark, str(tmp_path / "test.parquet"), split="test")
    for path in ("", "   "):
        with pytest.raises(ValueError, match="path"):
            rl.load(spark, path)
    with pytest.raises(ValueError, match="Unknown loader"):
        rl.load(spark, "x.csv", loader="excel")


def test_default_and_resolved_split():
    assert resolve_split("train", ["validation", "test"]) == "validation"
    assert resolve_split("train", ["other"]) == "other"
    assert resolve_split("", ["train"]) == "train"
    assert resolve_split("train", ["test"]) == "test"
    assert resolve_split("test[:10%]", ["test"]) == "test[:10%]"
    with pytest.raises(ValueError, match="here, only: test"):
        resolve_split("nope", ["test"])


@pytest.mark.parametrize(
    ("text", "low", "high"),
    [
        ("train", 0, 251),
        ("train[:100]", 0, 100),
        ("train[100:]", 100, 251),
        ("train[-20:]", 231, 251),
        ("train[:-20]", 0, 231),
        ("train[:10%]", 0, 25),
        ("train[50%:]", 126, 251),
        ("train[-10%:]", 226, 251),
        ("train[10%:20%]", 25, 50),
        ("train[10%:20%](pct1_dropremainder)", 20, 40),
        ("train[ 20 : 10 ]", 20, 20),
    ],
)
def test_slice_bounds(text, low, high):
    (part,) = parse_split(text)
    assert part.bounds(251) == (low, high)


def test_bad_slices():
    for text in ("train[1:2:3]", "train[a:]", "train[:10%:", "train[5]", "train[1:10%]", "train[:200%]", ""):
        with pytest.raises(ValueError):
            parse_split(text)
    with pytest.raises(ValueError, match="does not fit"):
        parse_split("train[:300]")[0].bounds(251)


def test_slices_and_sums(spark, layouts, tmp_path):
    for path in layouts.values():
        frame = rl.load(spark, path, split="train[95%:]+train[:3]+train[10:12]")
        assert rl.to_list(frame, "event_id") == [*range(950, 1000), 0, 1, 2, 10, 11]
        assert read(rl.filter_rows(frame, "event_id", "<", "11"))[-1]["at"] == 3
        assert rl.to_list(rl.skip_rows(frame, 51), "event_id") == [1, 2, 10, 11]
        assert rl.count_rows(frame) == 55
    (tmp_path / "t.txt").write_text("a\nb\nc\nd\n")
    assert rl.to_list(rl.load(spark, str(tmp_path / "t.txt"), split="train[1:3]"), "text") == ["b", "c"]


@pytest.mark.parametrize(
    ("text", "rows"),
    [
        ('{"a": NaN, "b": 1}\n{"a": 2.0, "b": 2}\n{"a": 3.0, "b": 3}\n', [1, 2, 3]),
        ("{'b': 1}\n{'b': 2}\n", [1, 2]),
        ('\n{"a": Infinity, "b": 1},\n{"a": 1, "b": 2}\n', [1, 2]),
        ('{"b": 1, "a": {\n{"b": 2}\n{"b": 3}\n', [None, 2, 3]),
        ('{"a": \n{"b": 2}\n', [None, 2]),
        ('[\n{"a": NaN, "b": 1},\n{"b": 2}]\n', [1, 2]),
        ('[{"b": 1},\n\n{"b": 2}\n]', [1, 2]),
        ('{"a": "}",\n "c": \n{"x": "["}\n, "b": 1}', [1]),
        ('\ufeff{"a": [1,\n2], "b": 1}\n\n', [1]),
    ],
)
def test_json_layout_by_the_reader(spark, tmp_path, text, rows):
    """Rows behind a first line that only Spark's parser accepts, or that is damaged, are not lost."""
    (tmp_path / "x.json").write_text(text)
    assert [r["b"] for r in rl.to_list(rl.load(spark, str(tmp_path / "x.json")))] == rows


@pytest.mark.parametrize("text", ['{\n"b": 1\n}\n{\n"b": 2\n}\n', '[{"b": 1},\n{"b": 2}]\n]\n', '{\n"b": 1\n}} x'])
def test_json_behind_a_document_is_an_error(spark, tmp_path, text):
    (tmp_path / "x.json").write_text(text)
    with pytest.raises(ValueError, match="x.json"):
        rl.load(spark, str(tmp_path / "x.json"))


class Counting:
    """An input file that counts the bytes read of it."""

    def __init__(self, path):
        self.file, self.bytes, self.closed = open(path, "rb"), 0, False

    def read(self, n=-1):
        data = self.file.read(n)
        self.bytes += len(data)
        return data

    def __getattr__(self, name):
        return getattr(self.file, name)


@pytest.mark.parametrize("stream", [False, True])
def test_arrow_rows_are_counted_without_bodies(tmp_path, stream):
    from rowloom.sources import arrow_ipc

    write_arrow(tmp_path / "a.arrow", [{"id": i, "text": "x" * 500} for i in range(9000)], 1000, stream)
    size = (tmp_path / "a.arrow").stat().st_size
    spy = Counting(tmp_path / "a.arrow")
    headers, seekable = arrow_ipc._batch_headers(pa.PythonFile(spy, "r"))
    assert [h.rows for h in headers] == [1000] * 9 and seekable and spy.bytes < size / 100
    if not stream:
        spy = Counting(tmp_path / "a.arrow")
        run = {"first": 2, "batches": 3, "at": 0}
        batches = [*arrow_ipc._run_batches(pa.PythonFile(spy, "r"), run, ["id"])]
        assert [b["id"][0].as_py() for b in batches] == [2000, 3000, 4000] and spy.bytes < size / 30


def test_arrow_layouts_that_must_be_read_from_the_start(spark, tmp_path, monkeypatch):
    """Dictionaries, compression, columns without values, empty batches and files; a damaged file is an error."""
    from rowloom.sources import arrow_ipc

    monkeypatch.setattr(arrow_ipc, "RUN_ROWS", 5)
    words = pa.array([f"w{i % 7}" for i in range(60)])
    table = pa.table({"id": range(60), "word": words.dictionary_encode(), "none": pa.nulls(60)})
    for name, make in (("a", pa.ipc.new_stream), ("b", pa.ipc.new_file)):
        options = pa.ipc.IpcWriteOptions(compression="zstd" if name == "b" else None)
        with make(str(tmp_path / f"{name}.arrow"), table.schema, options=options) as writer:
            writer.write_table(table, max_chunksize=4)
            writer.write_table(table.slice(0, 0))
    with pa.ipc.new_file(str(tmp_path / "c.arrow"), table.schema):
        pass
    frame = rl.load(spark, f"{tmp_path}/*.arrow")
    assert rl.count_rows(frame) == 120
    kept = rl.select_columns(frame, "id, word")
    assert [(r["id"], r["word"]) for r in rl.to_list(kept)] == [(i, f"w{i % 7}") for i in range(60)] * 2
    assert rl.to_list(rl.select_rows(kept, "119, 3"), "id") == [59, 3]
    raw = (tmp_path / "b.arrow").read_bytes()
    (tmp_path / "b.arrow").write_bytes(raw[: len(raw) // 2])
    with pytest.raises(Exception, match="footer is damaged|Not an Arrow file"):
        rl.count_rows(rl.load(spark, f"{tmp_path}/*.arrow"))


def test_arrow_reads_only_needed_columns(spark, tmp_path):
    rows = [{"a": i, "b": str(i), "c": -i, "d": i / 2} for i in range(50)]
    write_arrow(tmp_path / "1.arrow", rows[:30], 8, False)
    write_arrow(tmp_path / "2.arrow", rows[30:], 8, True)
    frame = rl.load(spark, f"{tmp_path}/*.arrow")

    def read_columns(some):
        text = some.unordered_rows()._jdf.queryExecution().executedPlan().toString()
        (node,) = {line.split("MapInArrow")[1] for line in text.splitlines() if "MapInArrow" in line}
        return {name for name in "abcd" if f" {name}#" in node.replace("[", " ").replace(",", " ")}

    assert read_columns(frame) == set("abcd")
    assert read_columns(rl.select_columns(frame, "b")) == {"b"}
    chain = rl.remove_columns(rl.take_rows(rl.skip_rows(rl.filter_rows(frame, "c", "<", "-9"), 5), 22), "c, d")
    assert read_columns(chain) == set("abc")
    assert rl.to_list(chain) == [{"a": i, "b": str(i)} for i in range(15, 37)]
    again = rl.select_columns(rl.rename_column(rl.select_columns(frame, "a, b"), "a", "z"), "z")
    assert read_columns(again) == {"a", "b"} and rl.to_list(again, "z") == list(range(50))
    late = rl.select_columns(rl.skip_rows(frame, 35), "d")
    assert read_columns(late) == {"d"} and rl.to_list(late, "d") == [i / 2 for i in range(35, 50)]
