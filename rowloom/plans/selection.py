"""The order keys at given ranks of a sort, found by counting instead of sorting.

A bounded sample of the keys gives pivots close to each wanted rank.  One aggregation counts the rows
before every pivot, which leaves a much shorter interval of keys around the rank; the next round samples
inside it.  Rows are read a few times, keys only, and nothing but counts is shuffled.  When an interval is
short enough, its rows are ranked by one task.

Every round is exact, whatever the sample: counts decide, the sample only tells where to look.

The same keys, spread over all ranks, divide a sort into intervals (``interval_numbers``).  They are fixed in the
plan, so every pass over the rows divides them alike and dense numbers need no copy of the sorted rows.
"""

from __future__ import annotations

import base64
import datetime
import decimal
import json
import math
from collections.abc import Sequence
from dataclasses import replace
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from rowloom.frame import HIDDEN, Frame, quoted

#: Keys that a round brings to the driver, at most and on average.
SAMPLE_ROWS = 1 << 13
#: An interval of so many rows is ranked by one task.
LAST_ROWS = 1 << 17
#: Characters or bytes of a text key that a pivot holds at first; a pivot need not be a whole key.
PIVOT_WIDTH = 256
#: Distances of pivots from the place of a rank in the sample, in standard deviations of that place.
SPREAD = (-4.0, -1.0, -0.3, 0.0, 0.3, 1.0, 4.0)
#: Keys that divide a sort, at most; with more rows the intervals grow.
MOST_POINTS = 1 << 14
#: Sampled keys for every one of them.
OVERSAMPLED = 8
#: Bytes of all keys that divide a sort, as the plan holds them.
POINT_BYTES = 4 << 20

Values = tuple[Any, ...]


def comparable(frame: Frame) -> bool:
    """Whether all order keys are single values, which a filter can be compared with."""
    kinds = (T.StringType, T.BinaryType, T.BooleanType, T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)
    return all(isinstance(frame.df.schema[k.name].dataType, kinds) for k in frame.order)


def _portable(col: Column, dtype: T.DataType) -> Column:
    """A key in a form that comes back from the driver unchanged, whatever the time zones."""
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(col)
    return col.cast("string") if isinstance(dtype, T.TimestampNTZType) else col


def _literal(value: Any, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.TimestampType):
        return F.timestamp_micros(F.lit(value))
    return F.lit(bytes(value) if isinstance(value, bytearray) else value).cast(dtype)


def before(frame: Frame, values: Values) -> Column:
    """Whether a row comes before the row with the order keys ``values`` (all of them, or the first ones)."""
    condition = F.lit(False)
    for key, value in reversed([*zip(frame.order, values, strict=False)]):
        col, dtype = quoted(key.name), frame.df.schema[key.name].dataType
        floats = isinstance(dtype, (T.FloatType, T.DoubleType))
        if value is None:  # nulls are last, so all others come before
            condition = col.isNotNull() | condition
            continue
        literal = _literal(value, dtype)
        less = col > literal if key.descending else col < literal
        if key.descending and key.nan_last and floats:
            less = col.isNotNull() & ~F.isnan(col) if math.isnan(value) else less & ~F.isnan(col)
        condition = F.coalesce(less, F.lit(False)) | (col.eqNullSafe(literal) & condition)
    return condition


def _same(frame: Frame, values: Values) -> Column:
    conditions = [
        quoted(k.name).isNull() if v is None else quoted(k.name).eqNullSafe(_literal(v, frame.df.schema[k.name].dataType))
        for k, v in zip(frame.order, values, strict=True)
    ]
    return reduce(lambda a, b: a & b, conditions)


def within(frame: Frame, low: Values | None, high: Values | None) -> Frame:
    """Rows from the key ``low`` on and before the key ``high``."""
    if low is not None:
        frame = frame.filtered(~before(frame, low))
    if high is not None:
        frame = frame.filtered(before(frame, high))
    for hint in _ranges(frame, low, high):
        frame = frame.filtered(hint)
    return frame


def _ranges(frame: Frame, low: Values | None, high: Values | None) -> list[Column]:
    """What the bounds say about the first key alone, in a form that scans push down."""
    key, out = frame.order[0], []
    col, dtype = quoted(key.name), frame.df.schema[key.name].dataType
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return []  # statistics of files do not cover NaN
    if low is not None and low[0] is not None:
        value = _literal(low[0], dtype)
        out.append((col <= value if key.descending else col >= value) | col.isNull())
    if low is not None and low[0] is None:
        out.append(col.isNull())
    if high is not None and high[0] is not None:
        value = _literal(high[0], dtype)
        out.append(col >= value if key.descending else col <= value)
    return out


def keys_at_ranks(frame: Frame, ranks: Sequence[int], rows: int) -> dict[int, Values]:
    """Order keys of the rows at ``ranks`` of a frame of ``rows`` rows; ranks beyond the last row are left out."""
    keys = keys_only(frame)
    found: dict[int, Values] = {}
    open_: list[tuple[Values | None, Values | None, int, int, int, int, list[int]]] = []
    wanted = sorted({r for r in ranks if r < rows})
    if wanted:
        open_.append((None, None, 0, rows, PIVOT_WIDTH, 0, wanted))
    while open_:
        low, high, start, stop, width, turn, inside = open_.pop()
        part = within(keys, low, high)
        if stop - start <= LAST_ROWS:
            found.update(_ranked(part, start, inside))
            continue
        pivots = _pivots(part, stop - start, [r - start for r in inside], width, turn)
        counts = _counted(part, pivots) if pivots else []
        nearer: dict[tuple[int, int], tuple[Values | None, Values | None, list[int]]] = {}
        for rank in inside:
            a, b, lo, hi = start, stop, low, high
            for values, (less, equal) in zip(pivots, counts, strict=True):
                at = start + less
                if at <= rank < at + equal:
                    found[rank] = values
                    break
                if a < at <= rank:
                    a, lo = at, values
                elif rank < at < b:
                    b, hi = at, values
            else:
                nearer.setdefault((a, b), (lo, hi, []))[2].append(rank)
        for (a, b), (lo, hi, some) in nearer.items():
            # pivots that leave the interval as it was are too short, or an unlucky sample
            longer = width * 16 if (a, b) == (start, stop) else width
            open_.append((lo, hi, a, b, longer, turn + 1, some))
    return found


def keys_only(frame: Frame) -> Frame:
    """The frame with its order columns alone."""
    return frame.rebuilt(frame.df.select(*[quoted(n) for n in frame.order_names]))


def shown_keys(frame: Frame) -> list[Column]:
    """The order keys in the form in which they come to the driver."""
    types = [frame.df.schema[k.name].dataType for k in frame.order]
    return [_portable(quoted(k.name), t).alias(f"{HIDDEN}k{i}") for i, (k, t) in enumerate(zip(frame.order, types, strict=True))]


def _ranked(part: Frame, start: int, ranks: list[int]) -> dict[int, Values]:
    """Keys at the ranks of a short interval that begins at rank ``start``."""
    rank = F.row_number().over(Window.orderBy(*part.sort_columns())) + F.lit(start - 1)
    rows = part.df.select(*shown_keys(part), rank.alias(HIDDEN + "rank")).filter(F.col(HIDDEN + "rank").isin(ranks)).collect()
    return {row[HIDDEN + "rank"]: tuple(row)[:-1] for row in rows}


def _cropped(frame: Frame, width: int) -> DataFrame:
    """The keys, texts no longer than ``width``, and at which key a row was cropped."""
    crop, shown = F.lit(None).cast("int"), []
    for i, (key, col) in reversed([*enumerate(zip(frame.order, shown_keys(frame), strict=True))]):
        dtype = frame.df.schema[key.name].dataType
        if isinstance(dtype, (T.StringType, T.BinaryType)):
            text = quoted(key.name)
            # a text of just this length counts as cropped too, so that pivots stay in order
            crop = F.when(F.length(text) >= width, i).otherwise(crop)
            col = F.substring(text, 1, width).alias(f"{HIDDEN}k{i}")
        shown.append(col)
    return frame.df.select(*reversed(shown), crop.alias(HIDDEN + "crop"), *[quoted(n) for n in frame.order_names])


def _pivots(part: Frame, rows: int, ranks: list[int], width: int, turn: int) -> list[Values]:
    """Keys around ``ranks``, from a sample; a cropped text ends its pivot, which then stands before all such texts."""
    fraction = min(1.0, SAMPLE_ROWS / rows)
    columns = [f"{HIDDEN}k{i}" for i in range(len(part.order))]
    sample = _cropped(part, width).sample(fraction, seed=turn).orderBy(*part.sort_columns())
    found = [tuple(r) for r in sample.select(*columns, HIDDEN + "crop").collect()]
    places = set()
    for rank in ranks:
        share = (rank + 0.5) / rows
        spread = math.sqrt(len(found) * share * (1 - share)) + 1
        places |= {int(share * len(found) + s * spread) for s in SPREAD}
    chosen = [found[p] for p in sorted(places) if 0 <= p < len(found)]
    pivots = [row[:-1] if row[-1] is None else row[: row[-1] + 1] for row in chosen]
    return [p for i, p in enumerate(pivots) if i == 0 or p != pivots[i - 1]]


def _counted(part: Frame, pivots: list[Values]) -> list[tuple[int, int]]:
    """Rows before each pivot, and rows with just its keys (none for a cropped pivot)."""
    counts = []
    for values in pivots:
        counts.append(F.count_if(before(part, values)))
        counts.append(F.count_if(_same(part, values)) if len(values) == len(part.order) else F.lit(0))
    row = part.df.agg(*[c.alias(f"n{i}") for i, c in enumerate(counts)]).first()
    return [(row[2 * i], row[2 * i + 1]) for i in range(len(pivots))]


# -- intervals of a sort --------------------------------------------------------------------


def interval_numbers(frame: Frame, rows: int, size: int) -> Column | None:
    """Number of the interval that a row falls in, ascending in the order; intervals hold about ``size`` rows.

    None when the keys that would tell the intervals apart are too long for a plan.
    """
    points = _dividing_keys(frame, rows, size)
    if not points:
        return None if points is None else F.lit(0)
    types = [frame.df.schema[k.name].dataType for k in frame.order]
    fields = [T.StructField(f"k{i}", _stored_type(t)) for i, t in enumerate(types)]
    table = [{"n": len(p), **{f"k{i}": _stored(v) for i, v in enumerate(p)}} for p in points]
    schema = T.ArrayType(T.StructType([*fields, T.StructField("n", T.IntegerType())]))
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(points).bit_length()))])

    def search(listed: Column) -> Column:
        def narrowed(at: Column, step: Column) -> Column:
            point = F.get(listed, at + step - 1)
            return F.when((at + step <= len(points)) & ~_before_point(frame, point), at + step).otherwise(at)

        return F.aggregate(steps, F.lit(0), narrowed)

    listed = F.from_json(F.lit(json.dumps(table)), schema)  # folded to a literal, which is in the plan once
    return F.transform(F.array(listed), search)[0]


def _dividing_keys(frame: Frame, rows: int, size: int) -> list[Values] | None:
    """Keys about evenly spaced in the order, from a sample.  None when they would be too long."""
    wanted = min(MOST_POINTS, rows // size)
    if wanted == 0:
        return []
    part = keys_only(frame)
    fraction = min(1.0, wanted * OVERSAMPLED / rows)
    rank, columns = HIDDEN + "rank", [f"{HIDDEN}k{i}" for i in range(len(part.order))]
    width = PIVOT_WIDTH
    while True:
        sample = _cropped(part, width).sample(fraction, seed=wanted)  # bounded, so one task ranks it
        ranked = sample.withColumn(rank, F.row_number().over(Window.orderBy(*part.sort_columns())))
        every = max(1, round(rows * fraction / wanted))
        found = [tuple(r) for r in ranked.filter(F.col(rank) % every == 0).select(*columns, HIDDEN + "crop").collect()]
        points = [row[:-1] if row[-1] is None else row[: row[-1] + 1] for row in found]
        if sum(len(str(v)) for p in points for v in p) > POINT_BYTES:
            return None
        kept = [p for i, p in enumerate(points) if i == 0 or p != points[i - 1]]
        if not any(row[-1] is not None and a == b for row, a, b in zip(found, points, points[1:], strict=False)):
            return kept
        width *= 16  # long texts begin alike: more of them tells their rows apart


def _stored_type(dtype: T.DataType) -> T.DataType:
    if isinstance(dtype, T.TimestampType):
        return T.LongType()
    return T.StringType() if isinstance(dtype, (T.TimestampNTZType, T.StringType)) else dtype


def _stored(value: Any) -> Any:
    """A key as JSON holds it."""
    if isinstance(value, (bytes, bytearray)):
        return base64.b64encode(value).decode()
    if isinstance(value, decimal.Decimal):
        return format(value, "f")
    return value.isoformat() if isinstance(value, datetime.date) else value


def _before_point(frame: Frame, point: Column) -> Column:
    """Like ``before``, for keys in a struct of which the first ``n`` count."""
    condition = F.lit(False)
    for i, key in reversed([*enumerate(frame.order)]):
        col, dtype, value = quoted(key.name), frame.df.schema[key.name].dataType, point.getField(f"k{i}")
        if isinstance(dtype, T.TimestampType):
            value = F.timestamp_micros(value)
        elif isinstance(dtype, T.TimestampNTZType):
            value = value.cast(dtype)
        less = col > value if key.descending else col < value
        if key.descending and key.nan_last and isinstance(dtype, (T.FloatType, T.DoubleType)):
            less = ~F.isnan(col) & (F.isnan(value) | less)
        less = F.coalesce(F.when(value.isNull(), col.isNotNull()).otherwise(less & col.isNotNull()), F.lit(False))
        inner = F.when(point.getField("n") > i + 1, condition).otherwise(False)
        condition = less | (col.eqNullSafe(value) & inner)
    return condition
