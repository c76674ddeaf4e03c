"""Column operators: select, remove, rename, flatten, map."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.frame import HIDDEN, POS, Frame, quoted
from rowloom.guards import require_column, require_columns, require_frame, require_loaded, require_new_name
from rowloom.plans.order import number
from rowloom.streaming.steps import index_step, on_streams

# The ways to fill a column.
COLUMN_OPERATIONS = ("constant", "copy column", "row index")


def _keep(frame: Frame, columns: list[Column], dropped: list[str], uses: list[str] | None = None) -> Frame:
    """Project to ``columns``; a dropped column that defines the order is kept hidden."""
    order, hidden = [], []
    for key in frame.order:
        if key.name in dropped:
            name = f"{HIDDEN}key_{uuid.uuid4().hex[:8]}"
            hidden.append(quoted(key.name).alias(name))
            order.append(replace(key, name=name))
        else:
            order.append(key)
    hidden += [quoted(c) for c in frame.df.columns if c.startswith(HIDDEN)]
    return frame.narrowed(lambda df: df.select(*columns, *hidden), uses, order=tuple(order))


@on_streams()
def select_columns(frame: Frame, columns: str) -> Frame:
    """Keep the comma-separated ``columns``, in the listed order."""
    names = require_columns(require_frame(frame), columns)
    dropped = [c for c in frame.columns if c not in names]
    return _keep(frame.pruned(names), [quoted(c) for c in names], dropped, names)


@on_streams()
def remove_columns(frame: Frame, columns: str) -> Frame:
    """Drop the comma-separated ``columns``; at least one column has to stay."""
    names = require_columns(require_frame(frame), columns)
    left = [c for c in frame.columns if c not in names]
    if not left:
        raise ValueError("Removing every column would leave an empty dataset.")
    return _keep(frame.pruned(left), [quoted(c) for c in left], names, left)


@on_streams()
def rename_column(frame: Frame, original_column: str, new_column: str) -> Frame:
    """Rename one column in place."""
    require_frame(frame)
    new = (new_column or "").strip()
    old = require_column(frame, original_column, "column to rename")
    if not new:
        raise ValueError("Give the new column name; it cannot be blank.")
    if new == old:
        return frame
    require_new_name(frame, new, replacing=old)
    order = tuple(replace(k, name=new) if k.name == old else k for k in frame.order)
    renamed = [quoted(c).alias(new) if c == old else quoted(c) for c in frame.df.columns]
    return frame.narrowed(lambda df: df.select(*renamed), order=order)


def _leaves(col: Column, name: str, dtype: T.DataType) -> list[Column]:
    if isinstance(dtype, T.StructType) and dtype.fields:
        out: list[Column] = []
        for field in dtype.fields:
            out += _leaves(col.getField(field.name), f"{name}.{field.name}", field.dataType)
        return out
    return [col.alias(name)]


def flatten(frame: Frame) -> Frame:
    """Replace every struct column by its fields, named ``parent.child``, all levels deep.

    Fields of a null struct are null; arrays and maps stay as they are.
    """
    require_loaded(frame, "Flatten")
    columns: list[Column] = []
    for name in frame.columns:
        columns += _leaves(quoted(name), name, frame.df.schema[name].dataType)
    names = frame.df.select(*columns).columns
    clash = sorted({n for n in names if names.count(n) > 1})
    if clash:
        raise ValueError(f"Flattening would create {', '.join(clash)} twice.")
    gone = [c for c in frame.columns if c not in names]
    return _keep(frame, columns, gone)


@on_streams(stateful=lambda args: "row index" in args)
def map_column(frame: Frame, column: str, operation: str, value: str = "") -> Frame:
    """Add ``column``, or replace it (it then moves to the end).

    ``constant``: the text ``value`` as it is.  ``copy column``: the column named ``value``.
    ``row index``: the 0-based position of the row at this point of the chain.
    """
    require_frame(frame)
    target = (column or "").strip()
    if not target:
        raise ValueError("The new column has no name.")
    operation = operation.strip()
    if operation not in COLUMN_OPERATIONS:
        raise ValueError(f"A column cannot be filled by {operation!r}, only by: {', '.join(COLUMN_OPERATIONS)}.")
    if operation == "copy column":
        source = require_column(frame, value, "source column")
        if source == target:
            return frame
        new = quoted(source)
    elif operation == "constant":
        new = F.lit(value)
    else:
        if target not in frame.columns:
            require_new_name(frame, target)
        if not frame.bounded:
            return index_step(frame, target, put_column)
        frame = number(frame)
        new = quoted(POS)
    return put_column(frame, target, new)


def put_column(frame: Frame, target: str, value: Column) -> Frame:
    if target not in frame.columns:
        require_new_name(frame, target)
    stay = [quoted(c) for c in frame.columns if c != target]
    return _keep(frame, [*stay, value.alias(target)], [target])

