"""Records of JSON and CSV files that are cut block by block."""

import csv
import gzip
import io
import json
import random

import numpy as np
import pytest

import rowloom as rl
from rowloom.sources import blocks as B


@pytest.fixture(params=[1, 2, 16])
def split(request, spark):
    """Splits files into this many blocks."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def into(path):
        size = path.stat().st_size
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        spark.conf.set("spark.sql.files.maxPartitionBytes", f"{-(-size // request.param)}b" if request.param > 1 else "1g")
        return request.param

    yield into
    for k, v in before.items():
        spark.conf.set(k, v)


def blocks_of(spark, machine, path):
    _, scanned = B.scan(spark, machine, [str(path)])
    return len(next(iter(scanned.values())).starts)


def values(n, rng):
    odd = ['a "quoted" }{ word', "back\\slash", "\\", '\\"', "[{", "}]", "it's", "é𝔸", "", "\n", "x" * 50]
    return [{"id": i, "t": rng.choice(odd), "v": [{"w": rng.choice(odd)}] * rng.randrange(3)} for i in range(n)]


def same(frame, rows):
    found = rl.to_list(frame)
    assert [(r["id"], r["t"]) for r in found] == [(r["id"], r["t"]) for r in rows]
    assert [[x["w"] for x in r["v"] or []] for r in found] == [[x["w"] for x in r["v"]] for r in rows]


@pytest.mark.parametrize("form", ["array in one line", "pretty array", "values in lines"])
def test_json_in_blocks(spark, tmp_path, split, form, monkeypatch):
    monkeypatch.setattr("rowloom.sources.formats.LONG_LINE", 0)
    rows = values(120, random.Random(form))
    text = {
        "array in one line": lambda: json.dumps(rows),
        "pretty array": lambda: "﻿\n" + json.dumps(rows, indent=3, ensure_ascii=False) + "\n\n",
        "values in lines": lambda: "\n".join("".join(json.dumps(r) for r in rows[i : i + 3]) for i in range(0, 120, 3)),
    }[form]()
    path = tmp_path / "x.json"
    path.write_text(text)
    n = split(path)
    assert blocks_of(spark, B.JsonText(), path) >= n - 1
    frame = rl.load(spark, str(path))
    same(frame, rows)
    assert rl.to_list(rl.take_rows(rl.skip_rows(frame, 50), 3), "id") == [50, 51, 52]
    if n > 2:  # rows come from several tasks
        assert len(frame.df.inputFiles()) > 1


def test_a_value_over_many_blocks(spark, tmp_path, split):
    rows = values(3, random.Random(1))
    rows[1]["t"] = "long }{\"'\\ " * 3000
    (tmp_path / "x.json").write_text(json.dumps(rows))
    split(tmp_path / "x.json")
    same(rl.load(spark, str(tmp_path / "x.json")), rows)
    (tmp_path / "one.json").write_text(json.dumps(rows[1], indent=1))
    split(tmp_path / "one.json")
    same(rl.load(spark, str(tmp_path / "one.json")), rows[1:2])


def test_single_quotes(spark, tmp_path, split):
    text = "[" + ",\n".join(f"{{'id': {i}, 't': '}} \"{{ \\' {i}'}}" for i in range(60)) + "]"
    (tmp_path / "x.json").write_text(text)
    split(tmp_path / "x.json")
    assert rl.to_list(rl.load(spark, str(tmp_path / "x.json")), "t") == [f"}} \"{{ ' {i}" for i in range(60)]


@pytest.mark.parametrize(
    "text",
    ['{"a":1}{"a":2} x', '{"a":1}{"a":2}[{"a":3}]', '[{"a": 1},\n{"a": 2}] {"a": 3}', '[{"a": 1}, 2\n]', '{\n"a": 1\n}}', '{"a":1}{"a":2', '{\n"a": "x'],
)
def test_text_that_is_no_record_is_an_error(spark, tmp_path, text):
    (tmp_path / "x.json").write_text(text)
    with pytest.raises(ValueError, match="x.json"):
        rl.load(spark, str(tmp_path / "x.json"))


def test_values_of_several_files_and_types(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"a":1}{"a":2}\n{"a":3},{"a":4}\n')
    (tmp_path / "b.json").write_text('{"a": 5.5, "b": "} {"}\n')
    (tmp_path / "c.json").write_text('[{"a": 6},\n {"b": "x"}]')
    with gzip.open(tmp_path / "d.json.gz", "wt") as file:
        file.write('{"a":7}{"a":8}')
    assert rl.to_list(rl.load(spark, f"{tmp_path}/*"), "a") == [1.0, 2.0, 3.0, 4.0, 5.5, 6.0, None, 7.0, 8.0]
    assert rl.to_list(rl.load(spark, f"{tmp_path}/a.json", schema="a string"), "a") == ["1", "2", "3", "4"]
    with pytest.raises(ValueError, match="one JSON value per line"):
        rl.load(spark, f"{tmp_path}/a.json", streaming=True)


def test_states_compose():
    """A text read piece by piece ends in the state of the whole, from every state."""
    rng = random.Random(3)
    for simple in (True, False):
        machine = B.JsonText(simple)
        for _ in range(300):
            parts = ["".join(rng.choice('{}[]"\\ab' + ("" if simple else "'")) for _ in range(rng.randrange(12))).encode() for _ in range(4)]
            for state in machine.states:
                whole, _, end = machine.brackets(b"".join(parts), state)
                at, places = 0, []
                for part in parts:
                    found, _, state = machine.brackets(part, state)
                    places += (found + at).tolist()
                    at += len(part)
                assert (places, state) == (whole.tolist(), end)
            if simple:
                both = [m.brackets(b"".join(parts), (0, 0)) for m in (machine, B.JsonText(False))]
                assert np.array_equal(both[0][0], both[1][0]) and both[0][2] == both[1][2]


def cells(rng):
    return rng.choice(["plain", "", "two\nlines", 'a "quoted"\n\nword', "a,b", '"', '"\n"', "é,\n", " space "])


def test_csv_in_blocks(spark, tmp_path, split):
    rng = random.Random(7)
    rows = [{"id": str(i), "t": cells(rng), "u": cells(rng) or "u"} for i in range(200)]
    out = io.StringIO()
    writer = csv.DictWriter(out, ["id", "t", "u"], lineterminator="\n", quoting=csv.QUOTE_ALL)
    writer.writeheader()
    writer.writerows(rows)
    path = tmp_path / "x.csv"
    path.write_text(out.getvalue())
    n = split(path)
    assert blocks_of(spark, B.QuotedLines(), path) >= n - 1
    frame = rl.load(spark, str(path))
    want = [(int(r["id"]), r["t"] or None, r["u"]) for r in rows]
    assert [(r["id"], r["t"] or None, r["u"]) for r in rl.to_list(frame)] == want
    assert [(r["id"], r["t"] or None, r["u"]) for r in rl.to_list(rl.take_rows(rl.skip_rows(frame, 90), 20))] == want[90:110]
    typed = rl.load(spark, str(path), schema="u string, id string, t string")
    assert rl.to_list(typed, "id") == [r["id"] for r in rows]


def test_a_field_over_many_blocks(spark, tmp_path, split):
    text = "line, with \"\"quotes\"\"\n" * 400
    (tmp_path / "x.csv").write_text(f'a,b\n1,"{text}"\n2,"y\nz"\n3\n')
    split(tmp_path / "x.csv")
    rows = rl.to_list(rl.load(spark, str(tmp_path / "x.csv")))
    assert rows == [{"a": 1, "b": text.replace('""', '"')}, {"a": 2, "b": "y\nz"}, {"a": 3, "b": None}]


@pytest.mark.parametrize("lines", ["1,2\n3\n4,5,6\n", '1,"x\ny"\n3\n4,5,6\n'])
def test_rows_with_too_many_fields_are_an_error(spark, tmp_path, lines):
    (tmp_path / "x.csv").write_text("a,b\n" + lines)
    with pytest.raises(ValueError, match=r"Row 3 of .*x\.csv has 3 fields where 2 are expected"):
        rl.load(spark, str(tmp_path / "x.csv"))
    assert rl.to_list(rl.load(spark, str(tmp_path / "x.csv"), mode="DROPMALFORMED", schema="a string, b string"), "a")[0] == "1"


def test_short_rows_and_empty_ends_lose_nothing(spark, tmp_path):
    (tmp_path / "x.csv").write_text('a,b\n1,2,\n3\n"4,5",6,,\n')
    assert rl.to_list(rl.load(spark, str(tmp_path / "x.csv"))) == [{"a": "1", "b": 2}, {"a": "3", "b": None}, {"a": "4,5", "b": 6}]


def test_other_quotes_and_separators(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a;b\n'it\\'s;\ngoes';2\n'x';3\n" + "y;4\n" * 30)
    rows = rl.to_list(rl.load(spark, str(tmp_path / "x.csv"), quote="'", escape="\\", sep=";"))
    assert rows[:3] == [{"a": "it's;\ngoes", "b": 2}, {"a": "x", "b": 3}, {"a": "y", "b": 4}]
    (tmp_path / "h.csv").write_text('1,"p\nq"\n2,r\n')
    assert [tuple(r.values()) for r in rl.to_list(rl.load(spark, str(tmp_path / "h.csv"), header=False))] == [(1, "p\nq"), (2, "r")]
