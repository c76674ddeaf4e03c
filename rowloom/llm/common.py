"""Expressions and steps that several operators of this folder share."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.plans.staging import staging_path

#: Spark removes the shuffle files of a query when it ends.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: What stands between words: all ASCII but digits and (lower-case) letters.
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, everything else as it is (``lower`` alone would change É as well)."""
    only_ascii = F.octet_length(text) == F.length(text)
    return F.when(only_ascii, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def words_of(text: Column) -> Column:
    """Words of a text: runs of a-z, 0-9 and everything outside ASCII, after lower-casing A-Z.

    A null text has no words.
    """
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), BETWEEN_WORDS), "")


def text_key(text: Column) -> Column:
    """128 bits that stand for a text; null counts as the empty text."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def shifted(values: Column, by: int) -> tuple[Column, Column]:
    """``values`` without its last ``by`` entries, and without its first ``by`` entries."""
    left = F.greatest(F.size(values) - by, F.lit(0))
    return F.slice(values, F.lit(1), left), F.slice(values, F.lit(by + 1), left)


def _paired(df: DataFrame, column: str, by: int, combine, other: str | None = None, name: str | None = None) -> DataFrame:
    first, second = F.col(column), F.col(other or column)
    left = F.greatest(F.least(F.size(second) - by, F.size(first)), F.lit(0))
    pair = F.zip_with(F.slice(first, F.lit(1), left), F.slice(second, F.lit(by + 1), left), combine)
    return df.withColumn(name or column, pair)


def with_grams(df: DataFrame, hashes: str, k: int, name: str) -> DataFrame:
    """Add the hashes of all runs of ``k`` entries of the array ``hashes``, by doubling the length.

    Entry i stands for entries i..i+k-1; an array shorter than ``k`` gives an empty one.
    """
    df, length = df.withColumn(name, F.col(hashes)), 1
    while length < k:
        step = min(length, k - length)
        df, length = _paired(df, name, step, lambda a, b: F.xxhash64(a, b)), length + step
    return df


def with_sliding_min(df: DataFrame, values: str, width: int, name: str) -> DataFrame:
    """Add the minimum of every ``width`` consecutive entries; none if the array is shorter."""
    df, length = df.withColumn(name, F.col(values)), 1
    while length < width:
        step = min(length, width - length)
        df, length = _paired(df, name, step, lambda a, b: F.least(a, b)), length + step
    return df


def staged(df: DataFrame, label: str, tidy: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it again: later steps survive lost executors.

    ``tidy``: its shuffle files go with the write, not when the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = staging_path(spark, label)
    before = spark.conf.get(TIDY, None)
    if tidy:
        spark.conf.set(TIDY, "true")
    try:
        df.write.parquet(path)
    finally:
        if tidy:
            spark.conf.unset(TIDY) if before is None else spark.conf.set(TIDY, before)
    return spark.read.schema(df.schema).parquet(path)
