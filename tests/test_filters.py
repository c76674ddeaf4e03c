"""Filter conditions against a row-by-row Python model."""

import datetime as dt
import decimal
import operator as op

import pytest

import rowloom as rl
from rowloom.functions.predicates import OPERATORS

NAN, INF = float("nan"), float("inf")
NTZ = dt.datetime(2024, 2, 29, 12, 30, 0, 500000)
COLUMNS = {
    "n": ("bigint", [None, 0, 5, -3, 2**53, 2**53 + 1, 2**63 - 1, -(2**63)]),
    "small": ("tinyint", [None, 0, 5, -128, 127, 1, 2, 3]),
    "x": ("double", [None, 0.0, 5.0, -3.25, NAN, INF, -INF, 1e20]),
    "x32": ("float", [None, 0.0, 5.0, 0.5, NAN, INF, -INF, 2.0**24]),
    "s": ("string", [None, "", "5", "click", " click", "Click", "é", "z"]),
    "b": ("boolean", [None, True, False, True, False, True, True, False]),
}
VALUES = (
    "5| 5 |5.0|5.5|-3.25|abc|nan|inf|-inf|1e3|9007199254740993|127|128|99999999999999999999|-99999999999999999999|"
    "yes|no|true|click|1_0|0.1|1e300|-1e300|16777217|1e-60|9007199254740992.0"
).split("|")
LISTS = ["5, abc, 0", "click,,z", "yes", "nan, inf", "5.5, 2.0, 127, 300", " , ", "9007199254740993, -3.25"]
COMPARE = {"==": op.eq, "!=": op.ne, "<": op.lt, "<=": op.le, ">": op.gt, ">=": op.ge}
WORDS = {**dict.fromkeys(("1", "true", "yes", "y"), True), **dict.fromkeys(("0", "false", "no", "n"), False)}


def parse(text, cell):
    """What the text means next to a cell of this Python type."""
    text = text.strip()
    if isinstance(cell, bool):
        return WORDS.get(text.lower(), text)
    for kind in {int: (int, float), float: (float,)}.get(type(cell), ()):
        try:
            return kind(text)
        except ValueError:
            continue
    return text


def keeps(cell, operator, value):
    if operator in COMPARE:
        try:
            return COMPARE[operator](cell, parse(value, cell))
        except TypeError:
            return False
    hit = any(parse(part, cell) == cell for part in value.split(",") if part.strip())
    return hit == (operator == "in")


@pytest.fixture(scope="module")
def frame(spark):
    rows = list(zip(range(8), *(values for _, values in COLUMNS.values()), strict=True))
    schema = "id int, " + ", ".join(f"{name} {kind}" for name, (kind, _) in COLUMNS.items())
    return rl.from_dataframe(spark.createDataFrame(rows, schema), key="id")


def kept(frame, column, operator, value=""):
    return [row.id for row in rl.filter_rows(frame, column, operator, value).rows().collect()]


@pytest.mark.parametrize("column", COLUMNS)
def test_comparisons_and_memberships(frame, column):
    from pyspark.sql import functions as F

    from rowloom.frame import quoted
    from rowloom.functions.predicates import predicate

    cases = [(o, v) for o in COMPARE for v in VALUES] + [(o, v) for o in ("in", "not in") for v in LISTS]
    dtype = frame.df.schema[column].dataType
    flags = [F.coalesce(predicate(quoted(column), dtype, column, o, v), F.lit(False)) for o, v in cases]
    table = frame.df.orderBy("id").select(*[f.alias(f"c{i}") for i, f in enumerate(flags)]).collect()
    for i, (operator, value) in enumerate(cases):
        expected = [keeps(cell, operator, value) for cell in COLUMNS[column][1]]
        assert [row[i] for row in table] == expected, (column, operator, value)


def test_filter_uses_the_condition(frame):
    assert kept(frame, "n", "<=", "5.5") == [1, 2, 3, 7]
    assert kept(frame, "x", "!=", "5") == [0, 1, 3, 4, 5, 6, 7]
    assert kept(frame, "s", "==", "") == [1]


def test_null_checks(frame):
    assert kept(frame, "x", "is null") == [0]
    assert kept(frame, "x", "is not null", "anything") == list(range(1, 8))


def test_text_searches(frame):
    assert kept(frame, "s", "contains", "lick") == [3, 4, 5]
    assert kept(frame, "s", "contains", " c") == [4]  # the needle is not trimmed
    assert kept(frame, "s", "not contains", "lick") == [0, 1, 2, 6, 7]
    assert kept(frame, "s", "starts with", "cl") == [3]
    assert kept(frame, "s", "ends with", "k") == [3, 4, 5]
    assert kept(frame, "b", "starts with", "Tr") == [1, 3, 5, 6]
    assert kept(frame, "n", "contains", "92") == [4, 5, 6, 7]
    assert kept(frame, "x", "ends with", ".0") == [1, 2]
    assert kept(frame, "x", "contains", "nan") == [4]
    assert kept(frame, "x", "contains", "e+20") == [7]


def test_float_text(spark):
    from pyspark.sql import functions as F

    from rowloom.functions.text import float_text

    values = [0.0, -0.0, 1.0, 0.1, 123.456, 1e7, 12345678.9, 1e15, 1e16, 1.5e16, 123456789012345680.0, 1e-3, 1.25e-3,
              1e-4, 9.5e-5, 1.5e-5, 1e-300, -2.5e21, -1e-4, 1e100, 4503599627370497.5, NAN, INF, -INF, 2.0**24 + 1]
    df = spark.createDataFrame([(v,) for v in values], "v double").select(float_text(F.col("v")).alias("t"))
    assert [row.t for row in df.collect()] == [repr(v) for v in values]


def test_dates_times_decimals(spark):
    rows = [(0, None, None, None), (1, dt.date(2024, 2, 29), NTZ, decimal.Decimal("12.50")),
            (2, dt.date(2024, 3, 1), dt.datetime(2024, 3, 1), decimal.Decimal("-1"))]
    frame = rl.from_dataframe(spark.createDataFrame(rows, "id int, d date, t timestamp_ntz, p decimal(9,2)"), key="id")
    assert kept(frame, "d", "==", " 2024-02-29 ") == [1]
    assert kept(frame, "d", "!=", "2024-02-29") == [0, 2]
    assert kept(frame, "d", ">", "someday") == []
    assert kept(frame, "d", "!=", "someday") == [0, 1, 2]
    assert kept(frame, "t", "<", "2024-03-01T00:00:00") == [1]
    assert kept(frame, "t", "in", "2024-03-01, 2024-02-29 12:30:00.5") == [1, 2]
    assert kept(frame, "t", "==", "2024-03-01T00:00:00+00:00") == []
    assert kept(frame, "t", "ends with", "30:00.500000") == [1]
    assert kept(frame, "p", "==", "12.5") == [1]
    assert kept(frame, "p", "<", "12.499") == [2]
    assert kept(frame, "p", "not in", "12.5, x") == [0, 2]
    assert kept(frame, "p", "contains", "12.50") == [1]


def test_nested_columns(spark):
    df = spark.sql("SELECT id, array(id) AS a, named_struct('v', id) AS st, X'01' AS bin FROM range(3)")
    frame = rl.from_dataframe(df, key="id")
    for column in ("a", "st", "bin"):
        assert kept(frame, column, "==", "1") == []
        assert kept(frame, column, "!=", "1") == [0, 1, 2]
        assert kept(frame, column, "<", "1") == []
        assert kept(frame, column, "not in", "1") == [0, 1, 2]
        with pytest.raises(ValueError, match="no text"):
            kept(frame, column, "contains", "1")


def test_guards(frame):
    for arguments, message in (
        (("", "==", "1"), "blank"),
        (("nope", "==", "1"), "Unknown column"),
        (("N", "==", "1"), "Unknown column"),
        (("n", "~", "1"), "No such filter"),
    ):
        with pytest.raises(ValueError, match=message):
            rl.filter_rows(frame, *arguments)
    for operator in OPERATORS:
        if operator in ("==", "!=", "is null", "is not null"):
            rl.filter_rows(frame, "n", operator, " ")
        else:
            with pytest.raises(ValueError, match="Give a 'value'"):
                rl.filter_rows(frame, "n", operator, " ")
    with pytest.raises(ValueError, match="Expected a dataset"):
        rl.filter_rows([{"n": 1}], "n", "==", "1")


def test_odd_column_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["a.b", "c d", "e`f"])
    frame = rl.from_dataframe(df, key="a.b")
    assert rl.filter_rows(frame, "e`f", "==", "3").rows().collect() == df.collect()
    renamed = rl.rename_column(rl.filter_rows(frame, "a.b", "==", "1"), "c d", "g.h")
    assert renamed.rows().columns == ["a.b", "g.h", "e`f"]
    assert rl.unique_values(renamed, "g.h").rows().collect()[0][0] == 2


@pytest.mark.parametrize("text", "nan inf -inf 1e400 -1e400 12.345 -0.001 999.99 999.995 1000 -1000 5 5.000000000000000000000000000 x".split())
def test_decimal_literals(text):
    """Rewritten comparisons agree with exact ones, for every value of a small column."""
    from pyspark.sql import types as T

    from rowloom.functions.literals import UNTYPED, decimal_bound, typed

    dtype = T.DecimalType(5, 2)
    value = typed(text, dtype)
    if value is UNTYPED:
        assert text == "x"
        return
    cells = [decimal.Decimal(c) for c in ("-999.99", "-1", "-0.01", "0", "0.01", "5", "12.34", "12.35", "999.98", "999.99")]
    for name, compare in COMPARE.items():
        bound = decimal_bound(name, value, dtype)
        for cell in cells:
            exact = name == "!=" if value.is_nan() else compare(cell, value)
            assert (bound if isinstance(bound, bool) else COMPARE[bound[0]](cell, bound[1])) is exact, (name, cell)
        if not isinstance(bound, bool):
            assert abs(bound[1]) < 1000 and bound[1] == bound[1].quantize(decimal.Decimal("0.01"))
