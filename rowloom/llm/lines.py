"""Removal of repeated lines, answered by a keep bitmap per document instead of text.

A line's *key* is the line without white space at both ends, A-Z in lower case.  A key of at least
``least`` code points keeps its lines only in the smallest doc_id that has it.

1. Every such line becomes one row (128-bit hash of the key, doc_id, text name, position).  Text goes no further.
2. The rows are range-partitioned and sorted by hash, document and position.  The ranges are cut on all of
   these, so that a line held by a third of all documents spreads over many tasks.  A task streams its rows
   and notes the first document of each hash as it passes by; it holds one row, however long a run is.
3. A run may go on in the next range.  The last hash of each range, one row per task, says where it began.
4. Rows behind their first document are the dropped positions; they meet by document and become a bitmap, a bit
   per line, packed and deflated.  ``apply_bitmaps`` joins bitmaps with texts, the only time texts are shuffled.

Defined results: a null or empty text is one empty line; very long texts are split whole, and their rows
spread like any others; documents of one doc_id do not take lines from each other (rows that differ in text get
a bitmap each); equal lines of the smallest document all stay; repeated rows get equal results, a row each; rows
without doc_id neither take nor lose lines; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import ascii_lower, staged

#: What is stripped from both ends of a line.
BLANKS = " \t\n\x0b\x0c\r"
#: Texts handed on at a time, in bytes.
HELD = 16 << 20


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _name(text: Column) -> Column:
    """Tells apart rows of one doc_id."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def line_rows(docs: DataFrame, least: int = 10) -> DataFrame:
    """(h1, h2, doc_id, name, line) of every line whose key has ``least`` code points."""
    rows = docs.where("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"), _name(F.col("text")).alias("name"), F.posexplode(_lines(F.col("text"))).alias("line", "text")
    )
    rows = rows.withColumn("key", ascii_lower(F.btrim("text", F.lit(BLANKS)))).where(F.length("key") >= least)
    return rows.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "doc_id", "name", "line")


def _firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add ``first``, the document in which the run of equal hashes begins in this partition."""
    last = None  # hash and first document of the run that is open
    for batch in batches:
        if not batch.num_rows:
            continue
        h1, h2, doc = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("h1", "h2", "doc_id"))
        fresh = np.concatenate(([True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])))
        starts = np.flatnonzero(fresh)
        first = doc[starts].copy()
        if last is not None and last[:2] == (h1[0], h2[0]):
            first[0] = last[2]
        last = (h1[-1], h2[-1], first[-1])
        column = pa.array(first[np.cumsum(fresh) - 1], pa.int64())
        yield pa.RecordBatch.from_arrays([*batch.columns, column], [*batch.schema.names, "first"])


def dropped_lines(docs: DataFrame, least: int = 10) -> DataFrame:
    """(doc_id, name, line) of every line that a smaller doc_id has."""
    spark = docs.sparkSession
    rows = staged(line_rows(docs, least), "line-rows")  # ranges are cut by a sample, so rows are read twice
    order = ["h1", "h2", "doc_id", "name", "line"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    kinds = "h1 long, h2 long, doc_id long, name long, line int, part int, first long"
    rows = staged(rows.mapInArrow(_firsts, kinds), "line-firsts")
    # one row per task of the sort: the run that is open at its end
    tails = rows.groupBy("part").agg(F.max(F.struct("h1", "h2", "first")).alias("tail")).select("tail.*")
    tails = tails.groupBy("h1", "h2").agg(F.min("first").alias("open"))
    rows = rows.join(F.broadcast(tails), ["h1", "h2"], "left")
    return rows.where(F.col("doc_id") > F.least("first", "open")).select("doc_id", "name", "line")


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, name, n_lines, dropped positions) -> bitmaps."""
    for batch in batches:
        bits = []
        for n, gone in zip(batch.column("n_lines").to_pylist(), batch.column("gone").to_pylist(), strict=True):
            keep = np.ones(n, bool)
            keep[gone or []] = False
            bits.append(zlib.compress(np.packbits(keep).tobytes()))
        gone = [len(g or ()) for g in batch.column("gone").to_pylist()]
        columns = [batch.column(c) for c in ("doc_id", "name", "n_lines")]
        columns += [pa.array(gone, pa.int64()), pa.array(bits, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "name", "n_lines", "n_dropped", "keep"])


def line_bitmaps(docs: DataFrame, least: int = 10) -> DataFrame:
    """One row per document (doc_id, name of its text): n_lines, n_dropped, keep (bit per line, see ``keep_mask``)."""
    gone = dropped_lines(docs, least).groupBy("doc_id", "name").agg(F.collect_set("line").alias("gone"))
    sizes = docs.where("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"), _name(F.col("text")).alias("name"), F.size(_lines(F.col("text"))).cast("long").alias("n_lines")
    )
    sizes = sizes.groupBy("doc_id", "name").agg(F.max("n_lines").alias("n_lines"))
    kinds = "doc_id long, name long, n_lines long, n_dropped long, keep binary"
    return sizes.join(gone, ["doc_id", "name"], "left").mapInArrow(_packed, kinds)


def keep_mask(keep: bytes, n_lines: int) -> np.ndarray:
    """The lines of a document that stay, as booleans."""
    return np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=n_lines).astype(bool)


def _applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [()] * 4
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        names = ["doc_id", "n_lines", "n_dropped", "kept"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    for batch in batches:
        rows, held = [], 0
        ids, keeps, gone = (batch.column(c).to_pylist() for c in ("doc_id", "keep", "n_dropped"))
        for doc, text, keep, n in zip(ids, batch.column("text"), keeps, gone, strict=True):
            text = text.as_py()
            lines = text.split("\n")
            if n:
                text = "\n".join([lines[i] for i in np.flatnonzero(keep_mask(keep, len(lines)))])
            rows.append((doc, len(lines), n or 0, text))
            held += len(text)
            if held > HELD:
                yield batch_of(rows)
                rows, held = [], 0
        yield batch_of(rows)


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_lines, n_dropped, kept (the lines that stay, joined by line ends)."""
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), _name(F.col("text")).alias("name"), F.coalesce("text", F.lit("")).alias("text")
    )
    marked = texts.join(bitmaps.select("doc_id", "name", "n_dropped", "keep"), ["doc_id", "name"], "left")
    return marked.select("doc_id", "text", "n_dropped", "keep").mapInArrow(
        _applied, "doc_id long, n_lines long, n_dropped long, kept string"
    )


def without_repeated_lines(docs: DataFrame, least: int = 10) -> DataFrame:
    """Bitmaps of ``docs``, applied to them."""
    return apply_bitmaps(docs, line_bitmaps(docs, least))
