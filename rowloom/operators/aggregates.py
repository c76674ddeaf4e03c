"""Count and distinct values."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.frame import POS, Frame, Key, quoted
from rowloom.functions.values import plain
from rowloom.guards import require_column, require_loaded
from rowloom.plans.order import count_of, settle, stable_position, with_lines, with_rows


def count_rows(frame: Frame) -> int:
    """Number of rows; an unfiltered scan answers from file footers."""
    return count_of(require_loaded(frame, "Count"))


def count_table(frame: Frame) -> DataFrame:
    """The row count as a one-row DataFrame, for use inside a larger query."""
    return require_loaded(frame, "Count").df.agg(F.count(F.lit(1)).alias("count"))


def unique_values(frame: Frame, column: str) -> Frame:
    """Distinct values of ``column`` in order of first appearance; null counts once, NaN once.

    One partial and one final hash aggregation, so a value held by most rows costs no more than
    any other; the frame that comes back has one row per value.
    """
    require_loaded(frame, "Unique")
    name = require_column(frame, column)
    if frame.kind == "lines":
        frame = with_lines(frame)
    elif frame.kind == "files" and frame.files is not None:
        frame = replace(stable_position(frame), order=(Key(POS),))
    else:
        frame = with_rows(frame)
    keys = frame.order
    if len(keys) == 1 and not keys[0].descending:
        first, back = F.min(quoted(keys[0].name)), False  # stays in hash aggregation
    else:
        back = _mirrored(frame)
        if back is None:
            return unique_values(settle(frame), column)
        parts = [part for key in keys for part in _ranked(key, back)]
        first = (F.max if back else F.min)(F.struct(*[p.alias(f"k{i}") for i, p in enumerate(parts)]))
    grouped = frame.df.groupBy(quoted(name).alias(name)).agg(first.alias(POS))
    normal = plain(quoted(name), frame.df.schema[name].dataType).alias(name)
    kind = "position" if frame.order_names == [POS] else "sorted"
    return Frame(grouped.select(normal, F.col(POS)), (Key(POS, descending=back),), kind)


def _mirrored(frame: Frame) -> bool | None:
    """Whether the first row is the largest of mirrored keys; None if keys go both ways and cannot be turned."""
    fixed = {k.descending for k in frame.order if not isinstance(frame.df.schema[k.name].dataType, T.IntegralType)}
    return None if len(fixed) > 1 else fixed.pop() if fixed else False


def _ranked(key: Key, back: bool) -> list[Column]:
    """Columns that compare like the sort order of ``key``, or (``back``) the other way round; never null first."""
    col = quoted(key.name)
    missing = col.isNotNull() if back else col.isNull()
    if key.descending != back:  # whole numbers only: -1 - x mirrors all of them
        return [missing, F.bitwise_not(col)]
    return [missing, ~F.isnan(col), col] if key.descending and key.nan_last else [missing, col]
