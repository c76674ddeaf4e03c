"""The fourteen filter conditions, compiled to Catalyst expressions.

Nulls follow the data-preparation reading, not SQL's: a null cell is unequal to every value, so
``!=`` and ``not in`` keep it, while ``==``, ordering and ``in`` drop it.  NaN equals nothing and
is never smaller or larger.  Conditions keep a shape that Parquet can push down.
"""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.functions.literals import (
    FLOATS,
    INTEGERS,
    UNTYPED,
    decimal_bound,
    float32_bound,
    integer_bound,
    integer_range,
    typed,
)
from rowloom.functions.text import cell_text

# The filter operators, in four groups.
COMPARISONS = ("==", "!=", "<", "<=", ">", ">=")
TEXT_SEARCHES = ("contains", "not contains", "starts with", "ends with")
MEMBERSHIPS = ("in", "not in")
NULL_CHECKS = ("is null", "is not null")
TIMESTAMPS = (T.TimestampType, T.TimestampNTZType)
OPERATORS = COMPARISONS + TEXT_SEARCHES + MEMBERSHIPS + NULL_CHECKS


def predicate(col: Column, dtype: T.DataType, column: str, operator: str, value: str = "") -> Column:
    """Condition ``column operator value``; ``value`` is the text the user typed."""
    if operator not in OPERATORS:
        raise ValueError(f"No such filter: {operator!r}. There are: {', '.join(OPERATORS)}.")
    if not value.strip() and operator not in ("==", "!=", *NULL_CHECKS):
        raise ValueError(f"Give a 'value' to compare with by {operator!r}.")
    if operator == "is null":
        return col.isNull()
    if operator == "is not null":
        return col.isNotNull()
    if operator in TEXT_SEARCHES:
        return _search(cell_text(col, dtype, column), operator, value)
    if operator in MEMBERSHIPS:
        return _membership(col, dtype, operator, value)
    return _comparison(col, dtype, operator, typed(value, dtype))


def _search(text: Column, operator: str, needle: str) -> Column:
    literal = F.lit(needle)
    if operator == "starts with":
        return F.startswith(text, literal)
    if operator == "ends with":
        return F.endswith(text, literal)
    if operator == "contains":
        return F.contains(text, literal)
    return text.isNull() | ~F.contains(text, literal)


def _constant(col: Column, operator: str, result: bool) -> Column:
    """Same answer for every non-null cell."""
    if operator == "!=":
        return F.lit(True) if result else col.isNull()
    return col.isNotNull() if result else F.lit(False)


def _comparison(col: Column, dtype: T.DataType, operator: str, value: object) -> Column:
    if value is UNTYPED:
        return _constant(col, operator, operator == "!=")
    if isinstance(dtype, INTEGERS):
        bound = integer_bound(operator, value)
        if isinstance(bound, bool):
            return _constant(col, operator, bound)
        operator, number = bound
        low, high = integer_range(dtype)
        if not low <= number <= high:
            above = number > high
            answer = {"==": False, "!=": True, "<": above, "<=": above}.get(operator, not above)
            return _constant(col, operator, answer)
        return _ordered(col, operator, F.lit(number).cast(dtype))
    if isinstance(dtype, FLOATS):
        bound = float32_bound(operator, value) if isinstance(dtype, T.FloatType) else (operator, value)
        if isinstance(bound, bool) or math.isnan(value):
            return _constant(col, operator, operator == "!=")
        operator, number = bound
        condition = _ordered(col, operator, F.lit(float(number)).cast(dtype))
        # Spark ranks NaN above every number and lets it equal itself
        return condition & ~F.isnan(col) if operator in (">", ">=") else condition
    if isinstance(dtype, T.DecimalType):
        bound = decimal_bound(operator, value, dtype)
        if isinstance(bound, bool):
            return _constant(col, operator, bound)
        return _ordered(col, bound[0], F.lit(bound[1]).cast(dtype))
    literal = _timestamp(value, dtype) if isinstance(dtype, TIMESTAMPS) else F.lit(value)
    if literal is None:
        return _constant(col, operator, operator == "!=")
    return _ordered(col, operator, literal)


def _timestamp(value: dt.datetime, dtype: T.DataType) -> Column | None:
    """Timestamp literal; a time without zone has no counterpart for a text that names one."""
    if isinstance(dtype, T.TimestampNTZType) and value.tzinfo is not None:
        return None
    return F.lit(value.isoformat(sep=" ")).cast(dtype)


def _ordered(col: Column, operator: str, literal: Column) -> Column:
    if operator == "==":
        return col == literal
    if operator == "!=":
        return ~col.eqNullSafe(literal)
    if operator == "<":
        return col < literal
    if operator == "<=":
        return col <= literal
    if operator == ">":
        return col > literal
    return col >= literal


def _membership(col: Column, dtype: T.DataType, operator: str, value: str) -> Column:
    parts = [part.strip() for part in value.split(",") if part.strip()]
    members = [m for m in (_member(typed(p, dtype), dtype) for p in parts) if m is not None]
    if not members:
        return F.lit(operator == "not in")
    hit = col.isin(members)
    return hit if operator == "in" else col.isNull() | ~hit


def _member(value: object, dtype: T.DataType) -> Column | None:
    """Literal that a cell of ``dtype`` can equal, or None when no cell can."""
    if value is UNTYPED:
        return None
    if isinstance(dtype, INTEGERS):
        bound = integer_bound("==", value)
        if isinstance(bound, bool):
            return None
        low, high = integer_range(dtype)
        return F.lit(bound[1]).cast(dtype) if low <= bound[1] <= high else None
    if isinstance(dtype, FLOATS):
        if math.isnan(value) or isinstance(dtype, T.FloatType) and float32_bound("==", value) is False:
            return None
        return F.lit(float(value)).cast(dtype)
    if isinstance(dtype, T.DecimalType):
        bound = decimal_bound("==", value, dtype)
        return None if isinstance(bound, bool) else F.lit(bound[1]).cast(dtype)
    return _timestamp(value, dtype) if isinstance(dtype, TIMESTAMPS) else F.lit(value)
