"""Text form of a cell, as the text predicates see it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.functions.literals import FLOATS, INTEGERS


def float_text(col: Column) -> Column:
    """Shortest decimal text of a double: plain from 1e-4 up to 1e16, else like ``1.5e-05``.

    Spark switches to an exponent at 1e7 already, so the digits are laid out again here.  The digits
    are the JVM's; before Java 19 it prints one more than needed for a few values (2e23).
    """
    value = col.cast("double")
    spark_text = F.abs(value).cast("string")
    mantissa = F.split_part(spark_text, F.lit("E"), F.lit(1))
    exponent = F.split_part(spark_text, F.lit("E"), F.lit(2)).cast("int")
    digits = F.regexp_replace(F.regexp_replace(mantissa, r"\.0$", ""), r"\.", "")
    whole = F.length(digits) <= exponent + 1
    plain_big = F.when(whole, F.concat(F.rpad(digits, exponent + 1, "0"), F.lit(".0"))).otherwise(
        F.concat(F.substr(digits, F.lit(1), exponent + 1), F.lit("."), F.substr(digits, exponent + 2))
    )
    plain_small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -exponent - 1), digits)
    mark = F.when(exponent < 0, "e-").otherwise("e+")
    zero = F.when(F.abs(exponent) < 10, "0").otherwise("")
    power = F.abs(exponent).cast("string")
    scientific = F.concat(F.regexp_replace(mantissa, r"\.0$", ""), mark, zero, power)
    unsigned = (
        F.when(~F.contains(spark_text, F.lit("E")), spark_text)
        .when((exponent >= 0) & (exponent < 16), plain_big)
        .when((exponent < 0) & (exponent >= -4), plain_small)
        .otherwise(scientific)
    )
    minus = F.when(F.startswith(value.cast("string"), F.lit("-")), "-").otherwise("")
    return (
        F.when(F.isnan(value), "nan")
        .when(value == float("inf"), "inf")
        .when(value == float("-inf"), "-inf")
        .otherwise(F.concat(minus, unsigned))
    )


def cell_text(col: Column, dtype: T.DataType, column: str) -> Column:
    """Text of a cell; null stays null."""
    if isinstance(dtype, T.StringType):
        return col
    if isinstance(dtype, T.BooleanType):
        return F.when(col, "True").when(~col, "False")
    if isinstance(dtype, FLOATS):
        return F.when(col.isNotNull(), float_text(col))
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        micros = F.date_format(col, "SSSSSS")
        seconds = F.date_format(col, "yyyy-MM-dd HH:mm:ss")
        return F.when(micros == "000000", seconds).otherwise(F.concat(seconds, F.lit("."), micros))
    if isinstance(dtype, (*INTEGERS, T.DecimalType, T.DateType)):
        return col.cast("string")
    raise ValueError(f"Column {column!r} of type {dtype.simpleString()} has no text to search.")
