"""Phrase collocations: frequent n-grams by mergeable Misra-Gries summaries, then exact counts.

1. Tasks count the n-grams of their texts by a 64-bit hash of language and words.  Counts are capped at
   ``threshold`` and exchanged by hash, so a common n-gram is at most one small entry per task and flush.
   They travel as bundles: a row holds the sorted hashes of one range and their counts as bytes.
2. Each range of hashes keeps a Misra-Gries summary: sorted hashes and counts, merged batch by batch.  Beyond
   ``capacity`` entries it takes the (capacity+1)-th largest count off all of them and keeps what is
   above 0.  An entry is short by at most the sum of what was taken off, ``error``.  There are so many partitions
   that capacity exceeds the mass of a partition divided by the threshold (mass is bounded by the bytes of the
   texts, which are summed first), so ``error`` stays below the threshold and no frequent n-gram is
   lost.  Should hashes fall so unevenly that it would not, the summary grows instead.
3. The second pass counts the n-grams whose hash survived, by their words: exact, whatever the hashes.  They travel
   as bundles too, with the phrases compressed, and a task counts the phrases of one range of hashes.
   The leading bits of a hash tell the few survivors it may equal.
   Survivors are broadcast up to ``BROADCAST_ROWS`` (counted).  Beyond that a bit for the leading bits of each is
   broadcast, at most ``2**MARK_BITS``: n-grams whose bit is not set stay where they are read, and the few others
   that share a bit with a survivor are counted too, and go by their counts.
4. Parts of a candidate are at least as frequent as itself, so scores need nothing but these counts.

Defined results: a null text is empty and has no words; a null lang is ``und``; very long texts are one slice of
a task; ties of score and count follow the phrase; repeated rows count each; an empty table gives no rows;
other columns, doc_id included, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowloom.llm.common import staged

#: Characters that end a piece, and the byte (no part of any text) that stands for them.
ENDS, END = b".,;:!?\n\x0b\x0c\r", b"\xff"
#: Bytes of text whose n-grams are counted together, and n-grams a task holds before it hands them on.
SLICE, HELD = 8 << 20, 1 << 20
#: Rows, and bytes of bundles, handed on at a time.
ROWS, BUNDLE_BYTES = 50_000, 4 << 20
#: Entries of a summary.
CAPACITY = 1 << 20
#: Surviving hashes (8 bytes each) that are broadcast.
BROADCAST_ROWS = 4 << 20
#: Leading bits of more survivors (2**MARK_BITS bits are as large as BROADCAST_ROWS hashes), and bits gathered together.
MARK_BITS, CHUNK_BITS = 28, 19
#: Survivors of a range whose phrases are counted by one task.
MERGED = 1 << 19

_TABLE = bytes.maketrans(ENDS, END * len(ENDS))


# -- n-grams of a slice ------------------------------------------------------------------------


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Grams:
    """Distinct runs of ``size`` words of a slice: a row of word numbers each, and how often they stand there."""

    words: np.ndarray
    counts: np.ndarray


def _tokens(texts: list[bytes]) -> tuple[np.ndarray, pa.Array]:
    """Word numbers of the texts, -1 where a piece ends, and the words (binary)."""
    raw = END.join(texts).lower().translate(_TABLE).replace(END, b" " + END + b" ")
    # a view as text: the split looks at ASCII bytes only
    whole = pa.Array.from_buffers(pa.large_string(), 1, [None, pa.py_buffer(np.array([0, len(raw)], np.int64)), pa.py_buffer(raw)])
    coded = pc.ascii_split_whitespace(whole).values.dictionary_encode()
    values = coded.dictionary.cast(pa.large_binary())
    ids = coded.indices.to_numpy().astype(np.int64)
    ids[ids == pc.index(values, END).as_py()] = -1
    return ids[ids != pc.index(values, b"").as_py()] if pc.index(values, b"").as_py() >= 0 else ids, values


def _grams(ids: np.ndarray, n_words: int, size: int) -> Grams:
    """All runs of ``size`` words within pieces."""
    spots = len(ids) - size + 1
    if spots <= 0:
        return Grams(np.empty((0, size), np.int64), np.empty(0, np.int64))
    whole = np.logical_and.reduce([ids[i : spots + i] >= 0 for i in range(size)])
    columns = [ids[i : spots + i][whole] for i in range(size)]
    if n_words**size < 1 << 62:
        key = columns[0]
        for c in columns[1:]:
            key = key * n_words + c
        found, counts = np.unique(key, return_counts=True)
        rows = []
        for _ in range(size):
            found, last = np.divmod(found, n_words)
            rows.append(last)
        return Grams(np.stack(rows[::-1], axis=1), counts)
    # more words than fit into one number: number the runs as they grow
    key = columns[0]
    for c in columns[1:]:
        key = np.unique(key, return_inverse=True)[1].reshape(-1) * n_words + c
    _, at, counts = np.unique(key, return_index=True, return_counts=True)
    return Grams(np.stack([c[at] for c in columns], axis=1), counts)


def _hashes(grams: Grams, hashes: np.ndarray) -> np.ndarray:
    """A hash per row; ``hashes`` belong to the words (and their language)."""
    h = np.full(len(grams.words), grams.words.shape[1], np.uint64)
    for column in grams.words.T:
        h = _mixed(h * np.uint64(0x9E3779B97F4A7C15) + hashes[column])
    return h


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """(lang, texts) of about ``SLICE`` bytes."""
    held: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
            raw = text.as_py()
            held.setdefault(lang, []).append(raw)
            sizes[lang] = sizes.get(lang, 0) + len(raw)
            if sizes[lang] > SLICE:
                yield lang, held.pop(lang)
                del sizes[lang]
        if sum(sizes.values()) > 4 * SLICE:  # many languages
            yield from held.items()
            held, sizes = {}, {}
    yield from held.items()


def _counted(batches: Iterator[pa.RecordBatch], longest: int):
    """(lang, words, grams, their hashes) by slice and size of n-gram."""
    for lang, texts in _slices(batches):
        ids, words = _tokens(texts)
        seed = xxhash.xxh3_64_intdigest(lang.encode())
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(w.as_buffer(), seed=seed) for w in words), np.uint64, len(words))
        for size in range(1, longest + 1):
            grams = _grams(ids, len(words), size)
            yield lang, words, grams, _hashes(grams, hashes)


# -- first pass: summaries ---------------------------------------------------------------------


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.add.reduceat(counts, first, dtype=np.int64) if len(first) else counts


@dataclass
class Summary:
    """Misra-Gries summary; frequent keys (``threshold`` or more) are always among ``survivors``."""

    capacity: int
    threshold: int
    error: int = 0
    keys: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    counts: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))

    def merge(self, keys: np.ndarray, counts: np.ndarray, error: int = 0) -> None:
        """Take in counts, or another summary with its error."""
        self.keys, self.counts = _summed(np.concatenate((self.keys, keys)), np.concatenate((self.counts, counts)))
        self.error += error
        over = len(self.keys) - self.capacity
        if over > 0:
            off = int(np.partition(self.counts, over - 1)[over - 1])
            if self.error + off < self.threshold:
                self.error += off
                stay = self.counts > off
                self.keys, self.counts = self.keys[stay], self.counts[stay] - off

    def survivors(self) -> np.ndarray:
        return self.keys[self.counts + self.error >= self.threshold]


def _edges(parts: int) -> np.ndarray:
    """What divides all 64-bit numbers into ``parts`` ranges of one length: the first of each range but the first one."""
    return np.array([i * (1 << 64) // parts - (1 << 63) for i in range(1, parts)], np.int64)


def _bundles(keys: np.ndarray, counts: np.ndarray, edges: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Sorted hashes and their counts as a row per range."""
    ends = [0, *np.searchsorted(keys, edges).tolist(), len(keys)]
    rows: list[tuple[int, bytes, bytes]] = []
    size = 0
    for part, (a, b) in enumerate(zip(ends, ends[1:], strict=False)):
        if a < b:
            rows.append((part, keys[a:b].tobytes(), counts[a:b].tobytes()))
            size += len(rows[-1][1]) + len(rows[-1][2])
        if rows and (size >= BUNDLE_BYTES or b == len(keys)):
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.binary(), pa.binary()), strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["part", "hashes", "counts"])
            rows, size = [], 0


def _local_counts(longest: int, threshold: int, parts: int):
    """Texts -> bundles of (hash, count) of their n-grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        room, least = 0, HELD
        small, edges = np.min_scalar_type(threshold), _edges(parts)

        def summed() -> tuple[np.ndarray, np.ndarray]:
            keys, counts = _summed(*map(np.concatenate, zip(*held, strict=True)))
            return keys, np.minimum(counts, threshold).astype(small)

        for _, _, grams, hashes in _counted(batches, longest):
            held.append((hashes.view(np.int64), np.minimum(grams.counts, threshold).astype(small)))
            room += len(hashes)
            if room > 2 * least:
                held = [summed()]
                room = len(held[0][0])
                if room > least:
                    yield from _bundles(*held[0], edges)
                    held, room = [], 0
        if held:
            yield from _bundles(*summed(), edges)

    return run


def _surviving(capacity: int, threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary = Summary(capacity, threshold)
        held: list[tuple[np.ndarray, np.ndarray]] = []
        room, small = 0, np.min_scalar_type(threshold)
        for batch in batches:
            for hashes, counts in zip(batch.column("hashes"), batch.column("counts"), strict=True):
                held.append((np.frombuffer(hashes.as_buffer(), np.int64), np.frombuffer(counts.as_buffer(), small)))
                room += len(held[-1][0])
                if room >= capacity // 2:
                    keys, found = map(np.concatenate, zip(*held, strict=True))
                    summary.merge(keys, found.astype(np.int64))
                    held, room = [], 0
        if held:
            keys, found = map(np.concatenate, zip(*held, strict=True))
            summary.merge(keys, found.astype(np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(summary.survivors())], ["hash"])

    return run


def frequent_hashes(docs: DataFrame, longest: int, threshold: int, capacity: int = CAPACITY) -> DataFrame:
    """Hashes of n-grams up to ``longest`` words, with all that occur ``threshold`` times; ``docs`` has lang and text (bytes)."""
    size = docs.agg(F.sum(F.length("text")).alias("bytes"), F.count("*").alias("rows")).first()
    mass = longest * ((size["bytes"] or 0) // 2 + size["rows"])  # a word and what ends it take two bytes
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), mass // (capacity * threshold) + 1)
    counts = docs.mapInArrow(_local_counts(longest, threshold, parts), "part int, hashes binary, counts binary")
    # a range of hashes a task: at most ``capacity * threshold`` n-grams, however large the table is
    return counts.repartitionById(parts, "part").mapInArrow(_surviving(capacity, threshold), "hash long")


# -- second pass: exact counts -----------------------------------------------------------------


class _Known:
    """Sorted hashes (unsigned), looked up by their leading bits: a few places in a short table each."""

    def __init__(self, keys: np.ndarray):
        bits = max(1, len(keys).bit_length() - 1)
        self.keys, self.shift = keys, np.uint64(64 - bits)
        self.starts = np.zeros((1 << bits) + 1, np.int32)
        np.cumsum(np.bincount((keys >> self.shift).astype(np.int64), minlength=1 << bits), out=self.starts[1:])

    def rows(self, hashes: np.ndarray) -> np.ndarray:
        """Places of ``hashes`` that are known, ascending."""
        first = (hashes >> self.shift).astype(np.int64)
        at, end = self.starts[first], self.starts[first + 1]
        known = np.zeros(len(hashes), bool)
        rows = np.flatnonzero(at < end)
        while len(rows):
            hit = self.keys[at[rows]] == hashes[rows]
            known[rows[hit]] = True
            at[rows] += 1
            rows = rows[~hit & (at[rows] < end[rows])]
        return np.flatnonzero(known)


class _Likely:
    """A bit for the leading ``bits`` of each of many hashes: tells all of them, and few others."""

    def __init__(self, bits: int):
        self.bits, self.marks = bits, np.zeros(1 << bits >> 3, np.uint8)

    def rows(self, hashes: np.ndarray) -> np.ndarray:
        """Places of ``hashes`` that may be known, ascending."""
        at = (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        return np.flatnonzero(self.marks[at >> 3] >> (at & 7).astype(np.uint8) & 1)


def _marks(bits: int):
    """Hashes -> (chunk, marks): the bits to set for them, 2**CHUNK_BITS at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            at = np.sort((batch.column("hash").to_numpy().view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64))
            chunks, firsts = np.unique(at >> CHUNK_BITS, return_index=True)
            for chunk, own in zip(chunks.tolist(), np.split(at & ((1 << CHUNK_BITS) - 1), firsts[1:]), strict=False):
                marks = held.setdefault(chunk, np.zeros(1 << CHUNK_BITS >> 3, np.uint8))
                np.bitwise_or.at(marks, own >> 3, np.uint8(1) << (own & 7).astype(np.uint8))
        yield from _as_rows(held)

    return run


def _merged_marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(chunk, marks) of several tasks -> one row per chunk."""
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, marks in zip(batch.column("chunk").to_pylist(), batch.column("marks"), strict=True):
            own = np.frombuffer(marks.as_buffer(), np.uint8)
            held[chunk] = held[chunk] | own if chunk in held else own.copy()
    yield from _as_rows(held)


def _as_rows(held: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for chunk, marks in held.items():
        yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([marks.tobytes()])], ["chunk", "marks"])


def _likely(survivors: DataFrame, n: int) -> _Likely:
    """The bits of ``n`` survivors; each chunk is put together by one task, so the driver gets every bit once."""
    likely = _Likely(max(CHUNK_BITS, min(MARK_BITS, n.bit_length() + 4)))
    kinds, size = "chunk int, marks binary", 1 << CHUNK_BITS >> 3
    found = survivors.mapInArrow(_marks(likely.bits), kinds).repartition("chunk").mapInArrow(_merged_marks, kinds)
    for batch in found.toArrow().to_batches():
        for chunk, marks in zip(batch.column("chunk").to_pylist(), batch.column("marks"), strict=True):
            likely.marks[chunk * size : (chunk + 1) * size] = np.frombuffer(marks.as_buffer(), np.uint8)
    return likely


def _exact_counts(longest: int, known, parts: int):
    """Texts -> bundles of the n-grams whose hash is (or may be) ``known``, and of the words of each lang (words 0).

    A row holds the n-grams of one size and range of hashes of a slice: how often each stands there, its length and
    all phrases in a run, compressed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = known.value if isinstance(known.value, _Likely) else _Known(known.value)
        edges = _edges(parts)
        rows: list[tuple] = []
        room = 0
        for lang, words, grams, hashes in _counted(batches, longest):
            size = grams.words.shape[1]
            if size == 1:
                rows.append((0, lang, 0, *_packed(pa.array([b""], pa.large_binary()), grams.counts.sum(keepdims=True))))
            keep = wanted.rows(hashes)
            at = np.searchsorted(edges, hashes[keep].view(np.int64), side="right")
            order = np.argsort(at, kind="stable")  # n-grams that begin alike stay together
            keep, ends = keep[order], np.searchsorted(at[order], np.arange(parts + 1)).tolist()
            columns = [words.take(pa.array(c)) for c in grams.words[keep].T]
            phrases = pc.binary_join_element_wise(*columns, pa.scalar(b" ", pa.large_binary())) if size > 1 else columns[0]
            counts = grams.counts[keep]
            for part, (a, b) in enumerate(zip(ends, ends[1:], strict=False)):
                if a < b:
                    rows.append((part, lang, size, *_packed(phrases[a:b], counts[a:b])))
                    room += sum(map(len, rows[-1][3:6]))
                if room >= BUNDLE_BYTES:
                    yield _batch(rows, PACKED)
                    rows, room = [], 0
        if rows:
            yield _batch(rows, PACKED)

    return run


#: Columns of a bundle of phrases, and of counted phrases.
PACKED = pa.schema([("part", pa.int32()), ("lang", pa.string()), ("words", pa.int32()), ("counts", pa.binary()), ("lengths", pa.binary()), ("phrases", pa.binary()), ("n", pa.int32())])
BUNDLE = "part int, lang string, words int, counts binary, lengths binary, phrases binary, n int"
COUNTED = pa.schema([("lang", pa.string()), ("phrase", pa.large_binary()), ("words", pa.int32()), ("n", pa.int64())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _packed(phrases: pa.Array, counts: np.ndarray) -> tuple[bytes, bytes, bytes, int]:
    """(counts, lengths, phrases) as bytes, and how many they are; numbers are as wide as the largest asks for."""
    ends = np.frombuffer(phrases.buffers()[1], np.int64)[phrases.offset : phrases.offset + len(phrases) + 1]
    text = phrases.buffers()[2].slice(int(ends[0]), int(ends[-1] - ends[0])) if ends[-1] > ends[0] else b""
    numbers = [x.astype(f"u{np.min_scalar_type(int(x.max())).itemsize}").tobytes() for x in (counts, np.diff(ends))]
    return *numbers, pa.compress(text, "zstd", asbytes=True), len(counts)


def _unpacked(lang: str, words: int, counts: bytes, lengths: bytes, phrases: bytes, n: int) -> pa.Table:
    counts, lengths = (np.frombuffer(x, f"u{len(x) // n}").astype(np.int64) for x in (counts, lengths))
    ends = np.concatenate(([0], np.cumsum(lengths)))
    text = pa.decompress(phrases, int(ends[-1]), "zstd")
    rows = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(ends), text])
    return pa.table([pa.repeat(lang, n), rows, pa.repeat(pa.scalar(words, pa.int32()), n), pa.array(counts)], schema=COUNTED)


def _totalled(threshold: int):
    """Bundles of a range of hashes -> (lang, phrase, words, n) with ``threshold`` occurrences, and the words of each lang (words 0)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        room, least = 0, MERGED

        def summed() -> pa.Table:
            found = pa.concat_tables(held).group_by(["lang", "phrase", "words"], use_threads=False).aggregate([("n", "sum")])
            return found.select(["lang", "phrase", "words", "n_sum"]).rename_columns(COUNTED.names)

        for batch in batches:
            for row in batch.to_pylist():
                held.append(_unpacked(*(row[c] for c in PACKED.names[1:])))
                room += row["n"]
                if room > 2 * least:
                    held = [summed()]
                    room = held[0].num_rows
                    least = max(least, room)
        if held:
            found = summed()
            found = found.filter(pc.or_(pc.greater_equal(found["n"], threshold), pc.equal(found["words"], 0)))
            yield from found.cast(COUNTED).combine_chunks().to_batches(max_chunksize=ROWS)

    return run


def phrase_counts(docs: DataFrame, longest: int = 3, threshold: int = 10, capacity: int = CAPACITY) -> tuple[DataFrame, DataFrame]:
    """Exact (lang, phrase, words, n) of all phrases with n >= ``threshold``, and (lang, n) of all words."""
    spark = docs.sparkSession
    docs = docs.select(
        F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).cast("binary").alias("text")
    )
    survivors = staged(frequent_hashes(docs, longest, threshold, capacity), "phrase-survivors", tidy=True)
    n = survivors.count()
    if n <= BROADCAST_ROWS:
        known = np.sort(survivors.toArrow()["hash"].combine_chunks().to_numpy().view(np.uint64))
    else:
        known = _likely(survivors, n)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n // MERGED + 1)
    rows = docs.mapInArrow(_exact_counts(longest, spark.sparkContext.broadcast(known), parts), BUNDLE)
    rows = rows.repartitionById(parts, "part").mapInArrow(_totalled(threshold), "lang string, phrase binary, words int, n long")
    rows = staged(rows.withColumn("phrase", F.col("phrase").cast("string")), "phrase-counts", tidy=True)
    return rows.where("words > 0"), rows.where("words = 0").select("lang", "n")


# -- scores ------------------------------------------------------------------------------------


def collocations(
    docs: DataFrame, longest: int = 3, threshold: int = 10, top: int | None = 2000, inside: int = 50, capacity: int = CAPACITY
) -> DataFrame:
    """The best phrases of each lang: lang, rank, phrase, a, l, r, n, score.

    A phrase is cut in two where that scores least.  It goes if a longer candidate around it has ``inside`` percent
    of its occurrences.  ``top=None`` returns all.
    """
    counts, totals = phrase_counts(docs, longest, threshold, capacity)
    known = counts.select("lang", "phrase", "n")
    cands = counts.where("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"), F.split("phrase", " ").alias("parts"))
    cuts = cands.select("lang", "phrase", "a", "parts", "words", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select(
        "lang",
        "phrase",
        "a",
        "k",
        F.array_join(F.slice("parts", F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice("parts", F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("rest"),
    )
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l")), ["lang", "first"])
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"])
    # decimals of 38 digits: exact for counts up to 10^16
    wide = {c: F.col(c).cast("decimal(16,0)") for c in ("a", "l", "r")}
    cuts = cuts.withColumn("up", wide["a"] * wide["a"] * F.lit(1_000_000).cast("decimal(7,0)"))
    cuts = cuts.withColumn("score", F.expr("up div (cast(l AS decimal(16,0)) * cast(r AS decimal(16,0)))"))
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    # phrases inside a longer candidate, one row each with the largest count around them
    around = cands.select("lang", "parts", "words", "a", F.explode(F.sequence(F.lit(2), F.greatest(F.col("words") - 1, F.lit(2)))).alias("size"))
    around = around.where("size < words").withColumn("at", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)))
    around = around.select("lang", F.array_join(F.slice("parts", F.col("at"), F.col("size")), " ").alias("phrase"), F.col("a").alias("around"))
    around = around.groupBy("lang", "phrase").agg(F.max("around").alias("around"))
    kept = scored.join(around, ["lang", "phrase"], "left")
    kept = kept.where(F.col("around").isNull() | (100 * F.col("around") < inside * F.col("a")))

    best = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(best))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    ranked = ranked.join(totals, "lang")
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
