"""Image cells: recognise them and their transparency by header bytes, and turn pixels into RGB and a mask.

Everything that headers tell is a Catalyst expression, decided cell by cell.  Image *files* are decoded by
Spark's own image reader (``loader="image"``).  Pixels of embedded bytes need a decoder that the cluster
brings: a function from bytes to an RGBA array, by default Pillow's.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Leading bytes of the image formats, in hex.
MAGIC = {
    "png": "89504E470D0A1A0A",
    "jpeg": "FFD8FF",
    "gif87": "474946383761",
    "gif89": "474946383961",
    "tiff_little": "49492A00",
    "tiff_big": "4D4D002A",
    "jxl_stream": "FF0A",
    "jxl_box": "0000000C4A584C20",
}
BMP, RIFF, WEBP = "424D", "52494646", "57454250"

#: Parts (chunks, blocks, tags) of a header that are looked at in one go; longer headers take several.
HEADER_PARTS = 256
#: Pixel samples (4 per pixel, 4 bytes each) that leave the decoder at a time.
BATCH_SAMPLES = 1 << 22

Decoder = Callable[[bytes], np.ndarray]

IMAGE = T.StructType(
    [
        T.StructField("height", T.IntegerType()),
        T.StructField("width", T.IntegerType()),
        T.StructField("data", T.ArrayType(T.FloatType())),
    ]
)
DECODED = T.StructType([T.StructField("image", IMAGE), T.StructField("mask", IMAGE)])
#: Cells of a column in which some are images: one of the two is null.
MIXED = T.StructType([T.StructField("image", IMAGE), T.StructField("text", T.StringType())])


# -- kinds of cells -------------------------------------------------------------------------


def is_image_struct(dtype: T.DataType) -> bool:
    """``struct<bytes, path>`` or a part of it: an image that has not been decoded yet."""
    if not isinstance(dtype, T.StructType) or not dtype.fields:
        return False
    kinds = {"bytes": T.BinaryType, "path": T.StringType}
    return all(f.name in kinds and isinstance(f.dataType, kinds[f.name]) for f in dtype.fields)


def is_read_image(dtype: T.DataType) -> bool:
    """A cell of Spark's image reader."""
    return isinstance(dtype, T.StructType) and {"height", "width", "nChannels", "data"} <= set(dtype.names)


def holds_image(dtype: T.DataType) -> bool:
    """Whether undecoded images are somewhere inside a list, map or struct."""
    if isinstance(dtype, T.ArrayType):
        return is_image_struct(dtype.elementType) or holds_image(dtype.elementType)
    if isinstance(dtype, T.MapType):
        return is_image_struct(dtype.valueType) or holds_image(dtype.valueType)
    if isinstance(dtype, T.StructType):
        return any(is_image_struct(f.dataType) or holds_image(f.dataType) for f in dtype.fields)
    return False


def shown_type(dtype: T.DataType) -> T.DataType:
    """Type of a nested value once its images are decoded and its bytes are text."""
    if is_image_struct(dtype):
        return IMAGE
    if isinstance(dtype, T.BinaryType):
        return T.StringType()
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(shown_type(dtype.elementType))
    if isinstance(dtype, T.MapType):
        return T.MapType(shown_type(dtype.keyType), shown_type(dtype.valueType))
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, shown_type(f.dataType)) for f in dtype.fields])
    return dtype


def content_of(col: Column, dtype: T.DataType) -> Column:
    """Encoded bytes of an image cell; a path without bytes is read by the task that holds the cell."""
    if isinstance(dtype, T.BinaryType):
        return col
    names = [f.name for f in dtype.fields]
    content = col.getField("bytes") if "bytes" in names else F.lit(None).cast("binary")
    if "path" not in names:
        return content
    path = col.getField("path")
    # the function sees the paths of cells without bytes only
    return F.coalesce(content, _fetched(F.when(content.isNull(), path)))


def _read(path: str) -> bytes:
    filesystem, place = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    with filesystem.open_input_stream(place) as file:
        return file.read()


@F.pandas_udf(T.BinaryType())
def _fetched(paths: pd.Series) -> pd.Series:
    return paths.map(lambda p: _read(p) if p else None)


# -- headers, in Catalyst ---------------------------------------------------------------------


def _hex(content: Column, at: Column | int, length: int) -> Column:
    """Bytes from ``at`` (counted from 0), in hex; shorter at the end of the content."""
    return F.hex(F.substring(content, F.lit(at) + 1 if isinstance(at, int) else at + 1, F.lit(length)))


def _number(content: Column, at: Column | int, length: int, little: Column | bool = False) -> Column:
    """Unsigned number in some bytes; null beyond the end."""
    big = _hex(content, at, length)
    turned = F.concat(*[F.substring(big, 2 * i + 1, 2) for i in reversed(range(length))])
    digits = turned if little is True else big if little is False else F.when(little, turned).otherwise(big)
    return F.when(F.length(big) == 2 * length, F.conv(digits, 16, 10).cast("long"))


def looks_like_image(content: Column) -> Column:
    """Whether encoded bytes start like an image file."""
    head = _hex(content, 0, 12)
    known = F.lit(False)
    for magic in MAGIC.values():
        known = known | F.startswith(head, F.lit(magic))
    # two letters are not enough: a BMP file states its own size, and two zero fields follow
    size = _number(content, 2, 4, little=True)
    bmp = F.startswith(head, F.lit(BMP)) & (size == F.length(content)) & (_hex(content, 6, 4) == "00000000")
    known = known | F.coalesce(bmp, F.lit(False))
    return known | (F.startswith(head, F.lit(RIFF)) & F.endswith(head, F.lit(WEBP)))


def _walk(content: Column, start: Column, step: Callable[[Column], tuple[Column, Column, Column]]) -> Column:
    """Follow the parts of a header: ``step(at, mode)`` gives (next place, next mode, verdict or null).

    Every part moves on by a byte at least, so the length of the content bounds the parts.
    """
    nothing = F.lit(None).cast("boolean")
    state = F.struct(start.cast("long").alias("at"), F.lit(0).alias("mode"), nothing.alias("found"))

    def go(acc: Column, _: Column) -> Column:
        at, mode, found = step(acc["at"], acc["mode"])
        moved = F.struct(at.cast("long").alias("at"), mode.cast("int").alias("mode"), found.alias("found"))
        return F.when(acc["found"].isNotNull(), acc).otherwise(moved)

    def walked(acc: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.lit(HEADER_PARTS)), acc, go)

    def on(acc: Column) -> Column:
        goes = F.sequence(F.lit(0), F.floor(F.length(content) / HEADER_PARTS))
        rest = F.aggregate(goes, acc, lambda a, _: F.when(a["found"].isNotNull(), a).otherwise(walked(a)))
        return F.when(acc["found"].isNotNull(), acc["found"]).otherwise(rest["found"])

    return F.coalesce(F.element_at(F.transform(F.array(walked(state)), on), 1), F.lit(False))


def _png_transparency(content: Column) -> Column:
    """An alpha channel (colour types 4 and 6), or a transparency chunk before the pixels."""

    def chunk(at: Column, mode: Column) -> tuple[Column, Column, Column]:
        kind = _hex(content, at + 4, 4)
        over = (F.length(kind) < 8) | kind.isin("49444154", "49454E44")
        return at + 12 + F.coalesce(_number(content, at, 4), F.lit(0)), mode, F.when(kind == "74524E53", True).when(over, False)

    return _hex(content, 25, 1).isin("04", "06") | _walk(content, F.lit(8), chunk)


def _gif_transparency(content: Column) -> Column:
    """The transparent flag of the graphic control block before the first picture."""
    flags = _number(content, 10, 1)
    table = F.when(flags >= 128, (6 * F.pow(F.lit(2), flags % 8)).cast("long")).otherwise(0)

    def block(at: Column, mode: Column) -> tuple[Column, Column, Column]:
        head, size = _hex(content, at, 2), F.coalesce(_number(content, at, 1), F.lit(0))
        control = (mode == 0) & (head == "21F9")
        extension = (mode == 0) & F.startswith(head, F.lit("21"))
        found = F.when(control, _number(content, at + 3, 1) % 2 == 1).when((mode == 0) & ~extension, False)
        return (
            F.when(mode == 0, at + 2).otherwise(at + 1 + size),
            F.when((mode == 1) & (size == 0), 0).otherwise(1),
            found,
        )

    return _walk(content, 13 + F.coalesce(table, F.lit(0)), block)


def _webp_transparency(content: Column) -> Column:
    kind = _hex(content, 12, 4)
    bit = F.when(kind == "56503858", _number(content, 20, 1)).when(kind == "5650384C", _number(content, 24, 1))
    return F.coalesce(F.floor(bit / 16) % 2 == 1, F.lit(False))


def _tiff_transparency(content: Column) -> Column:
    """An extra sample (tag 338) that is alpha."""
    little = _hex(content, 0, 2) == "4949"
    first = _number(content, 4, 4, little)
    end = first + 2 + 12 * _number(content, first, 2, little)

    def tag(at: Column, mode: Column) -> tuple[Column, Column, Column]:
        extra = _number(content, at, 2, little) == 338
        alpha = F.coalesce(_number(content, at + 8, 2, little).isin(1, 2), F.lit(False))
        return at + 12, mode, F.when((at >= end) | end.isNull(), False).when(extra, alpha)

    return _walk(content, F.coalesce(first, F.lit(0)) + 2, tag)


def has_alpha(content: Column) -> Column:
    """Transparency of an image cell as its header states it; null and other formats have none."""
    head = _hex(content, 0, 12)
    found = F.when(F.startswith(head, F.lit(MAGIC["png"])), _png_transparency(content))
    found = found.when(F.startswith(head, F.lit("47494638")), _gif_transparency(content))
    found = found.when(F.startswith(head, F.lit(RIFF)), _webp_transparency(content))
    tiff = F.startswith(head, F.lit(MAGIC["tiff_little"])) | F.startswith(head, F.lit(MAGIC["tiff_big"]))
    return F.coalesce(found.when(tiff, _tiff_transparency(content)), F.lit(False))


# -- pixels -----------------------------------------------------------------------------------


def pillow(content: bytes) -> np.ndarray:
    """RGBA pixels by Pillow, if the executors have it."""
    try:
        from PIL import Image
    except ImportError:
        raise ValueError("there is no image decoder on the executors; pass decoder=, or load files with loader='image'") from None
    return np.asarray(Image.open(io.BytesIO(content)).convert("RGBA"))


def _split(rgba: np.ndarray) -> dict[str, Any]:
    height, width = rgba.shape[:2]
    colors = (rgba[..., :3].astype(np.float32) / np.float32(255)).reshape(-1)
    mask = (1 - rgba[..., 3].astype(np.float32) / np.float32(255)).reshape(-1)
    size = {"height": height, "width": width}
    return {"image": {**size, "data": colors}, "mask": {**size, "data": mask}}


def _decode(content: Any, decoder: Decoder) -> dict[str, Any] | None:
    if content is None:
        return None
    try:
        return _split(decoder(bytes(content)))
    except Exception as error:
        raise ValueError(f"Could not decode a dataset image: {error}.") from error


def _in_batches(cells: Iterator[dict[str, Any] | None]) -> Iterator[pd.DataFrame]:
    """Decoded pixels are many times larger than the file, so they leave in batches of their own."""
    held: list[dict[str, Any] | None] = []
    samples = 0
    for cell in cells:
        held.append(cell)
        samples += 0 if cell is None else 4 * len(cell["mask"]["data"])
        if samples >= BATCH_SAMPLES:
            yield _columns(held)
            held, samples = [], 0
    if held:
        yield _columns(held)


def _columns(cells: list[dict[str, Any] | None]) -> pd.DataFrame:
    return pd.DataFrame({k: [None if c is None else c[k] for c in cells] for k in ("image", "mask")})


def decoded(content: Column, decoder: Decoder) -> Column:
    """RGB and mask of every cell, values 0..1, mask 1 where transparent; null stays null."""

    @F.pandas_udf(DECODED)
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield from _in_batches(_decode(c, decoder) for c in batch)

    return decode(content)


def _from_reader(height: int, width: int, channels: int, data: bytes) -> dict[str, Any]:
    """Spark's reader gives rows of BGR(A), or gray levels."""
    samples = np.frombuffer(data, np.uint8).reshape(height, width, channels)
    rgba = np.full((height, width, 4), 255, np.uint8)
    rgba[..., :3] = samples[..., 2::-1] if channels >= 3 else samples[..., :1]
    if channels == 4:
        rgba[..., 3] = samples[..., 3]
    return _split(rgba)


@F.pandas_udf(DECODED)
def from_reader(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
    """Like :func:`decoded`, for (height, width, channels, data) of Spark's image reader."""
    for batch in batches:
        rows = zip(*batch, strict=True)
        yield from _in_batches(None if d is None else _from_reader(int(h), int(w), int(n), d) for h, w, n, d in rows)


def decode_nested(col: Column, dtype: T.DataType, decoder: Decoder) -> Column:
    """``col`` with the images inside it decoded to RGB, in batches of bounded size."""

    @F.pandas_udf(T.ArrayType(shown_type(dtype)))
    def convert(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for cells in batches:
            held, samples = [], 0
            for wrapped in cells:
                sizes: list[int] = []
                held.append([_shown(value, dtype, decoder, sizes) for value in wrapped])
                samples += sum(sizes)
                if samples >= BATCH_SAMPLES:
                    yield pd.Series(held)
                    held, samples = [], 0
            if held:
                yield pd.Series(held)

    # wrapped in a list, because pandas would take a struct column apart
    return convert(F.array(col))[0]


def _shown(value: Any, dtype: T.DataType, decoder: Decoder, sizes: list[int]) -> Any:
    if value is None:
        return None
    if is_image_struct(dtype):
        names = [f.name for f in dtype.fields]
        content, path = (value[n] if n in names else None for n in ("bytes", "path"))
        cell = _decode(_read(path) if content is None and path else content, decoder)
        sizes.append(0 if cell is None else 4 * len(cell["mask"]["data"]))
        return None if cell is None else cell["image"]
    if isinstance(dtype, T.BinaryType):
        data = bytes(value)
        try:
            return data.decode("utf-8")
        except UnicodeDecodeError:
            return data.hex()
    if isinstance(dtype, T.ArrayType):
        return [_shown(item, dtype.elementType, decoder, sizes) for item in value]
    if isinstance(dtype, T.MapType):
        pairs = dict(value).items()
        return {_shown(k, dtype.keyType, decoder, sizes): _shown(v, dtype.valueType, decoder, sizes) for k, v in pairs}
    if isinstance(dtype, T.StructType):
        return {f.name: _shown(value[f.name], f.dataType, decoder, sizes) for f in dtype.fields}
    return value
