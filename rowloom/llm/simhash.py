"""SimHash near-dedup with deletion-variant signatures.

``fingerprints`` makes one 64-bit SimHash per text.  Texts whose fingerprints differ in at most
``distance`` bits are linked, and linked texts form components.

The 64 bits are cut into ``distance // 2 + 1`` segments: of two linked fingerprints at least one
segment then differs in at most one bit.  Each fingerprint is indexed under every segment with each
of its bits left out in turn, joined by equality, and verified on all bits.  A signature that more
than ``CROWD`` fingerprints share is not paired off.  Its members are indexed again: they agree in
all but one bit of the segment, so the remaining bits are left out directly (every choice of as many
as may still differ).  Members with equal remainders are linked for certain, to the smallest of
them: the work per fingerprint is bounded whatever the size of the crowd, and no pairs are listed.
Spark sizes exploded rows like the fingerprints they come from and would broadcast them through the
driver while those are few, so these joins ask for a merge of sorted rows.

Equal fingerprints are one node, so copies cost nothing beyond a partial aggregation.  Components
are found by star contraction, with every round written to the shared folder.

Defined results: a null or empty text has fingerprint zero and is linked like any other; a row
without doc_id is kept, and is not counted when a component's smallest id is chosen (null if the
component has no id); repeated rows share a component; very long texts are counted whole, in parts of
bounded size; a bit that is set in just half the hashes is 0; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import staged
from rowloom.llm.components import components

#: Members of one signature that are still compared pair by pair (at most CROWD comparisons each).
CROWD = 64
#: Hashes counted at a time: bounds the memory for one very long text.
BLOCK = 1 << 18


def simhash(text: bytes | None, words_per_shingle: int = 3, seed: int = 42) -> int:
    """Fingerprint of one UTF-8 text, as an unsigned number (bit 63 is the first of 16 hex digits)."""
    words = (text or b"").lower().split()  # on bytes: A-Z only, and ASCII white space only
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= words_per_shingle:
        return xxhash.xxh64_intdigest(line, seed)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
    stops = (starts + lengths)[words_per_shingle - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    count, ones = len(stops), np.zeros(64, np.int64)
    firsts = starts[:count].tolist()
    for at in range(0, count, BLOCK):
        hashes = [digest(line[a:b], seed) for a, b in zip(firsts[at : at + BLOCK], stops[at : at + BLOCK], strict=True)]
        bits = np.unpackbits(np.array(hashes, dtype=">u8").view(np.uint8)).reshape(-1, 64)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > count).view(">u8")[0])


def fingerprints(docs: DataFrame, words_per_shingle: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, bits): the fingerprint of every document as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            bits = np.array([simhash(t.as_py(), words_per_shingle, seed) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(bits)], ["doc_id", "bits"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    return rows.mapInArrow(run, "doc_id long, bits long")


def _segments(distance: int) -> list[tuple[int, int]]:
    """(lowest bit, number of bits) of each segment."""
    parts = distance // 2 + 1
    edges = [64 * i // parts for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _signatures(distance: int) -> list[tuple[int, int, int]]:
    """(number, mask of the segment without one bit, that bit) of every signature."""
    out = []
    for low, width in _segments(distance):
        mask = ((1 << width) - 1) << low
        out += [(mask & ~(1 << bit), 1 << bit) for bit in range(low, low + width)]
    return [(i, *x) for i, x in enumerate(out)]


def links(nodes: DataFrame, distance: int = 2) -> DataFrame:
    """Links (a, b), a < b as signed longs, that connect what distance <= ``distance`` connects.

    ``nodes`` holds distinct fingerprints ``bits``.  Every linked pair is joined by a link or by a
    path of links; every link is a linked pair.
    """
    signatures = _signatures(distance)
    # fingerprints are narrow, and each becomes a row per signature: keep them from being merged into few tasks
    nodes = nodes.repartition(int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")), "bits")
    table = F.array(*[F.struct(F.lit(i).alias("sig"), F.lit(_signed(m)).alias("mask")) for i, m, _ in signatures])
    indexed = nodes.select("bits", F.explode(table).alias("s")).select(
        F.xxhash64(F.col("s.sig"), F.col("bits").bitwiseAND(F.col("s.mask"))).alias("key"), F.col("s.sig").alias("sig"), "bits"
    )
    # Most signatures have one member: only the others go on.
    sizes = indexed.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    shared = staged(indexed.join(sizes.hint("merge"), "key"), "simhash-shared")
    few = shared.where(F.col("members") <= CROWD).select("key", "bits")
    pairs = few.join(few.withColumnRenamed("bits", "other").hint("merge"), "key").where("bits < other")
    pairs = pairs.where(F.bit_count(F.col("bits").bitwiseXOR(F.col("other"))) <= distance)
    pairs = pairs.select(F.col("bits").alias("a"), F.col("other").alias("b"))

    crowds = shared.where(F.col("members") > CROWD).select("key", "sig", "bits")
    rest = crowds.select("bits", "key", F.explode(_remainders(F.col("sig"), signatures, distance)).alias("mask"))
    rest = rest.select("bits", "key", "mask", F.col("bits").bitwiseAND(F.col("mask")).alias("rest"))
    least = rest.groupBy("key", "mask", "rest").agg(F.min("bits").alias("a"), F.count("*").alias("n")).where("n > 1")
    stars = rest.join(least.hint("merge"), ["key", "mask", "rest"]).where("a < bits").select("a", F.col("bits").alias("b"))
    return pairs.unionByName(stars).distinct()


def _remainders(sig: Column, signatures: list[tuple[int, int, int]], distance: int) -> Column:
    """Masks for the members of a crowd: its segment's open bit and ``distance - 1`` more bits left out.

    Pairs that agree in the open bit share the signatures of all bits of the segment, where ``distance``
    bits elsewhere may differ.  They are found under the first one, or pair by pair if that is small.
    """
    whole = (1 << 64) - 1
    out = None
    firsts = {low for low, _ in _segments(distance)}
    for i, mask, open_bit in signatures:
        others = [1 << b for b in range(64) if not (mask | open_bit) >> b & 1]
        low = open_bit.bit_length() - 1
        choices = [sum(c) | open_bit for c in combinations(others, distance - 1)] if distance else [0]
        if low in firsts and distance:
            choices += [sum(c) for c in combinations(others, distance)]
        values = F.array(*[F.lit(_signed(whole & ~c)) for c in choices])
        out = F.when(sig == i, values) if out is None else out.when(sig == i, values)
    return out


def near_duplicates(docs: DataFrame, distance: int = 2, words_per_shingle: int = 3, seed: int = 42) -> DataFrame:
    """One row per document: doc_id, bits, component_id (smallest doc_id of its component)."""
    marked = staged(fingerprints(docs, words_per_shingle, seed), "simhash")
    nodes = marked.groupBy("bits").agg(F.min("doc_id").alias("least"))
    joined = components(links(nodes.select("bits"), distance))
    root = F.coalesce("root", "bits")
    labelled = nodes.join(joined.withColumnRenamed("node", "bits"), "bits", "left").select("bits", "least", root.alias("root"))
    labelled = staged(labelled, "simhash-roots")
    smallest = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    of_bits = labelled.join(smallest, "root").select("bits", "component_id")
    return marked.join(of_bits, "bits").select("doc_id", "bits", "component_id")


def drop_near_duplicates(docs: DataFrame, distance: int = 2, words_per_shingle: int = 3, seed: int = 42) -> DataFrame:
    """The rows of ``docs``, all columns, with one document (the smallest doc_id) of each component.

    Of several rows with that doc_id one stays.  Rows without doc_id all stay: nothing tells them apart.
    """
    found = near_duplicates(docs.select("doc_id", "text"), distance, words_per_shingle, seed)
    gone = found.where("doc_id != component_id").select(F.col("doc_id").alias("id")).distinct()
    repeated = docs.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("id")).count().where("count > 1").select("id")
    repeated = staged(repeated.join(gone, "id", "left_anti"), "simhash-repeated")
    rows = docs.select(F.struct("*").alias("row"))
    same_id = F.col("row.doc_id") == F.col("id")
    kept = rows.join(gone.unionByName(repeated), same_id, "left_anti")
    if not repeated.isEmpty():
        again = rows.join(repeated, same_id, "left_semi").select("row", F.col("row.doc_id").alias("id"))
        kept = kept.unionByName(again.dropDuplicates(["id"]).select("row"))
    return kept.select("row.*")
