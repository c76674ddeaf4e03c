"""Plain values: binary cells become text, at any depth of nesting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def bytes_to_text(col: Column) -> Column:
    """UTF-8 text of the bytes, or lowercase hex when they are not valid UTF-8."""
    text = col.cast("string")
    return F.when(F.is_valid_utf8(text), text).otherwise(F.lower(F.hex(col)))


def holds_bytes(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.BinaryType):
        return True
    if isinstance(dtype, T.ArrayType):
        return holds_bytes(dtype.elementType)
    if isinstance(dtype, T.MapType):
        return holds_bytes(dtype.keyType) or holds_bytes(dtype.valueType)
    if isinstance(dtype, T.StructType):
        return any(holds_bytes(f.dataType) for f in dtype.fields)
    return False


def plain(col: Column, dtype: T.DataType) -> Column:
    """``col`` with every nested binary value turned into text; other types are untouched."""
    if not holds_bytes(dtype):
        return col
    if isinstance(dtype, T.BinaryType):
        return bytes_to_text(col)
    if isinstance(dtype, T.ArrayType):
        return F.transform(col, lambda item: plain(item, dtype.elementType))
    if isinstance(dtype, T.MapType):
        values = F.transform_values(col, lambda _, v: plain(v, dtype.valueType))
        return F.transform_keys(values, lambda k, _: plain(k, dtype.keyType))
    fields = [plain(col.getField(f.name), f.dataType).alias(f.name) for f in dtype.fields]
    return F.when(col.isNotNull(), F.struct(*fields))
