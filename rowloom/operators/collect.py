"""Handing rows on: ordered DataFrames and lists, with images and masks."""

from __future__ import annotations

import logging
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count
from typing import Any
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.frame import HIDDEN, Frame, quoted
from rowloom.functions.images import (
    MIXED,
    Decoder,
    content_of,
    decode_nested,
    decoded,
    from_reader,
    has_alpha,
    holds_image,
    is_image_struct,
    is_read_image,
    looks_like_image,
    pillow,
)
from rowloom.functions.values import bytes_to_text, plain
from rowloom.guards import require_frame, require_int
from rowloom.operators.rows import take_rows
from rowloom.plans.order import settle, sorted_rows
from rowloom.streaming.drain import drain

log = logging.getLogger("rowloom")


@dataclass(frozen=True)
class ImageColumn:
    """What is known of a column with images."""

    alpha: bool = False  # some cell has transparency
    mixed: bool = False  # some cells are other bytes


#: What header bytes told before, by DataFrame and by column, whether it was named as images, and masks asked for.
_LOOKED_AT: WeakKeyDictionary[DataFrame, dict[tuple[str, bool, bool], ImageColumn | None]] = WeakKeyDictionary()


def _image_columns(
    frame: Frame, images: list[str] | None, masks: bool, only: list[str] | None = None
) -> dict[str, ImageColumn]:
    """Columns with image cells, found by type and header bytes; with ``only`` no others are looked at.

    ``struct<bytes, path>`` and the image reader's struct are images by their type; they are looked at
    for their masks only.  Cells of a binary column are images one by one; a column that ``images``
    names holds nothing else.  At most one aggregation, over header bytes of those columns, and what
    it found is kept for the DataFrame.
    """
    known = _LOOKED_AT.setdefault(frame.df, {})
    found: dict[str, list[Column | None]] = {}
    names = [n for n in (frame.columns if images is None else images) if only is None or n in only]
    df = frame.df
    for name in names:
        if (name, images is None, masks) in known:
            continue
        dtype, col = frame.df.schema[name].dataType, quoted(name)
        if is_read_image(dtype):
            found[name] = [None, None, F.max(col.getField("nChannels") == 4)]
        elif is_image_struct(dtype):
            if masks:  # a column of its own: header parts are followed by lambdas, which cannot read files
                content = f"{HIDDEN}content{len(found)}"
                df = df.withColumn(content, content_of(col, dtype))
            found[name] = [None, None, F.max(has_alpha(F.col(content))) if masks else None]
        elif isinstance(dtype, T.BinaryType) and images is None:
            image = looks_like_image(col)
            found[name] = [F.max(image), F.min(image), F.max(image & has_alpha(col)) if masks else None]
        elif isinstance(dtype, T.BinaryType):
            found[name] = [None, None, F.max(has_alpha(col)) if masks else None]
        elif images is not None:
            raise ValueError(f"The column {name!r} cannot hold images.")
    tests = [p.alias(f"t{i}_{j}") for i, parts in enumerate(found.values()) for j, p in enumerate(parts) if p is not None]
    row = df.agg(*tests).first() if tests else {}
    for i, (name, parts) in enumerate(found.items()):
        some, all_, alpha = (None if p is None else row[f"t{i}_{j}"] for j, p in enumerate(parts))
        image = ImageColumn(bool(alpha) and masks, parts[1] is not None and not all_)
        known[name, images is None, masks] = image if parts[0] is None or some else None
    looked = {name: known.get((name, images is None, masks)) for name in names}
    return {name: image for name, image in looked.items() if image is not None}


def _suffixes(stem: str) -> Iterator[str]:
    yield stem
    yield from (f"{stem}{n}" for n in count(1))


def _mask_names(frame: Frame, images: dict[str, ImageColumn]) -> dict[str, str]:
    """Name of the mask column of every image column with transparency: the first free one."""
    names: dict[str, str] = {}
    for column in (c for c, image in images.items() if image.alpha):
        used = {*frame.columns, *names.values()}
        stem = f"{column}_mask"
        names[column] = next(n for n in _suffixes(stem) if n not in used)
        if names[column] != stem:
            log.info("%r is taken, so the mask of %r goes to %r.", stem, column, names[column])
    return names


def _prepared(
    frame: Frame, column: str, limit: int | None, ordered: bool, decoder: Decoder, images: list[str] | None, masks: bool
) -> Frame:
    """Loaded frame with the rows and columns to hand on, values converted."""
    frame = require_frame(frame)
    limit = -1 if limit is None else require_int(limit, "limit", -1)
    if not frame.bounded:
        frame = frame.twin() if frame.twin is not None else drain(frame)
    if limit >= 0:
        frame = take_rows(frame, limit)
    if frame.kind == "decoded" and (ordered or masks):  # else one pass does
        frame = settle(frame)
    column = (column or "").strip()
    found = _image_columns(frame, images, masks, [column] if column and column in frame.columns else None)
    names = _mask_names(frame, found)
    if column and column not in frame.columns and column not in names.values():
        virtual = f" Mask columns: {', '.join(sorted(names.values()))}." if names else ""
        raise ValueError(f"There is no column {column!r} in: {', '.join(frame.columns)}.{virtual}")
    return _converted(frame, found, names, column, ordered, decoder)


def _converted(
    frame: Frame, images: dict[str, ImageColumn], masks: dict[str, str], column: str, ordered: bool, decoder: Decoder
) -> Frame:
    columns: list[Column] = []
    for name in frame.columns:
        dtype, col = frame.df.schema[name].dataType, quoted(name)
        wanted = not column or column in (name, masks.get(name))
        if not wanted:
            continue
        if name not in images:
            nested = holds_image(dtype) and not is_image_struct(dtype)
            value = decode_nested(col, dtype, decoder) if nested else plain(col, dtype)
            columns.append(value.alias(name))
            continue
        if is_read_image(dtype):
            pixels = from_reader(*[col.getField(f) for f in ("height", "width", "nChannels", "data")])
        else:
            content = content_of(col, dtype)
            pixels = decoded(F.when(looks_like_image(content), content) if images[name].mixed else content, decoder)
        if not column or column == name:
            value = pixels.getField("image")
            if images[name].mixed:
                text = F.when(~looks_like_image(col), bytes_to_text(col))
                value = F.when(col.isNotNull(), F.struct(value.alias("image"), text.alias("text"))).cast(MIXED)
            columns.append(value.alias(name))
        if name in masks and (not column or column == masks[name]):
            columns.append(pixels.getField("mask").alias(masks[name]))
    shown = [f"{HIDDEN}out{i}" for i in range(len(columns))]
    names = frame.df.select(*columns).columns
    # sort before converting: decoded images are not shuffled
    source = sorted_rows(frame) if ordered else frame.df
    out = source.select(*[c.alias(s) for c, s in zip(columns, shown, strict=True)])
    final = out.select(*[quoted(s).alias(n) for s, n in zip(shown, names, strict=True)])
    return Frame(final, (), "sorted")


def to_data_list(
    frame: Frame,
    column: str = "",
    limit: int | None = -1,
    ordered: bool = True,
    decoder: Decoder = pillow,
    images: list[str] | None = None,
    masks: bool = True,
) -> DataFrame:
    """The rows as an ordered DataFrame: all columns, or just ``column``.

    Bytes become text or hex.  Image columns become ``struct<height, width, data>`` (RGB, 0..1),
    and one with transparency gains ``<column>_mask``; ``column`` may name that mask.  A binary
    column in which only some cells are images becomes ``struct<image, text>``.
    ``images`` names the image columns, so that cells need not be looked at to find them; with
    ``masks=False`` transparency is not looked for.  ``decoder`` turns embedded bytes into RGBA.
    ``limit`` keeps the first rows; -1 keeps all.  ``ordered=False`` gives the same rows without
    the global sort, for consumers that do not need their order.
    """
    return _prepared(frame, column, limit, ordered, decoder, images, masks).df


def to_list(frame: Frame, column: str = "", limit: int | None = -1, **how: Any) -> list[Any]:
    """The rows on the driver: dicts, or the values of one column.  Meant for bounded results."""
    return list(iterate(frame, column, limit, **how))


def iterate(frame: Frame, column: str = "", limit: int | None = -1, **how: Any) -> Iterator[Any]:
    """Like :func:`to_list`, but one partition at a time reaches the driver; mixed cells are what they are."""
    one = bool((column or "").strip())
    rows = to_data_list(frame, column, limit, **how)
    mixed = [f.name for f in rows.schema if f.dataType == MIXED]
    for row in rows.toLocalIterator(prefetchPartitions=True):
        cells = row.asDict(recursive=True)
        for name in mixed:
            cells[name] = cells[name] and (cells[name]["image"] or cells[name]["text"])
        yield next(iter(cells.values())) if one else cells
