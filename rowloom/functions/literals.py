"""Typing of the text a user compares a column with.

The text is parsed once, on the driver, by the column's type.  Spark never casts it: in ANSI
mode ``bigint = 'abc'`` would fail at run time, whereas here text that does not parse simply
never equals a cell.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
from typing import Any

import numpy as np
from pyspark.sql import types as T

# The words accepted for a boolean.
TRUE_WORDS = ("1", "true", "yes", "y")
FALSE_WORDS = ("0", "false", "no", "n", "")

INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FLOATS = (T.FloatType, T.DoubleType)
INT_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}

#: The text has no value of the column's type.
UNTYPED = object()


def typed(text: str, dtype: T.DataType) -> Any:
    """Python value of ``text`` for a column of ``dtype``, or ``UNTYPED``."""
    text = text.strip()
    if isinstance(dtype, T.StringType):
        return text
    if isinstance(dtype, T.BooleanType):
        word = text.lower()
        return True if word in TRUE_WORDS else False if word in FALSE_WORDS else UNTYPED
    try:
        if isinstance(dtype, INTEGERS):
            try:
                return int(text)
            except ValueError:
                return float(text)
        if isinstance(dtype, FLOATS):
            return float(text)
        if isinstance(dtype, T.DecimalType):
            return decimal.Decimal(text)
        if isinstance(dtype, T.DateType):
            return dt.date.fromisoformat(text)
        if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
            return dt.datetime.fromisoformat(text)
    except (ValueError, decimal.InvalidOperation):
        return UNTYPED
    return UNTYPED


def integer_range(dtype: T.DataType) -> tuple[int, int]:
    half = 1 << (INT_BITS[type(dtype)] - 1)
    return -half, half - 1


def integer_bound(operator: str, value: float | int) -> tuple[str, int] | bool | None:
    """Rewrite ``int_column operator value`` with an integer value, exactly.

    Returns (operator, integer), or the constant result for every non-null cell.
    """
    if isinstance(value, int):
        return operator, value
    if math.isnan(value):
        return operator == "!="
    if math.isinf(value):
        return {"==": False, "!=": True, "<": value > 0, "<=": value > 0}.get(operator, value < 0)
    if value.is_integer():
        return operator, int(value)
    if operator in ("==", "!="):
        return operator == "!="
    # a fraction lies strictly between two integers
    return ("<=", math.floor(value)) if operator in ("<", "<=") else (">=", math.ceil(value))


def float32_bound(operator: str, value: float) -> tuple[str, float] | bool:
    """Rewrite ``float32_column operator value`` with a value that float32 holds exactly.

    Without it Spark would widen the column, and no file could be skipped.
    """
    if math.isnan(value):
        return operator == "!="
    with np.errstate(over="ignore"):
        near = np.float32(value)
    if float(near) == value:
        return operator, value
    if operator in ("==", "!="):
        return operator == "!="
    # the value lies strictly between two neighbouring float32 numbers
    if operator in ("<", "<="):
        below = near if float(near) < value else np.nextafter(near, np.float32(-np.inf))
        return "<=", float(below)
    above = near if float(near) > value else np.nextafter(near, np.float32(np.inf))
    return ">=", float(above)


def decimal_bound(operator: str, value: decimal.Decimal, dtype: T.DecimalType) -> tuple[str, decimal.Decimal] | bool:
    """Rewrite ``decimal_column operator value`` with a value of the column's own precision and scale.

    Returns (operator, decimal), or the constant result for every non-null cell.  A literal of another
    scale would widen the column, and no file could be skipped.
    """
    if value.is_nan():
        return operator == "!="
    beyond = value.is_infinite() or value != 0 and value.adjusted() >= dtype.precision - dtype.scale
    if beyond:
        return {"==": False, "!=": True, "<": value > 0, "<=": value > 0}.get(operator, value < 0)
    with decimal.localcontext(prec=200, Emin=decimal.MIN_EMIN, Emax=decimal.MAX_EMAX):
        step = decimal.Decimal(1).scaleb(-dtype.scale)
        below = value.quantize(step, rounding=decimal.ROUND_FLOOR)
        if below == value:
            return operator, below
        if operator in ("==", "!="):
            return operator == "!="
        # the value lies strictly between two neighbouring values of the column
        if operator in ("<", "<="):
            return "<=", below
        above = below + step
        return operator == "!=" if above.adjusted() >= dtype.precision - dtype.scale and above > 0 else (">=", above)
