"""Spelling variants: words one edit apart, found by dense prefix-suffix tiles.

Two words are *near* if they differ by exactly one inserted, deleted or replaced code point: the common prefix
plus the common suffix reach the longer length less one.  That test runs on padded matrices of code
points, tile against tile; which words meet in a tile is decided so that no pair is missed:

* Words of length M and M-1 form class M (so a word is in two classes).  The edit of a pair stands where its
  common prefix ends, at 0 <= e < M.  The places are cut into intervals [lo, hi); words that agree before lo
  and after hi meet in one *block*, so every pair meets in the one block that holds its e, and is reported there only.
* A block of more than ``TILE`` words (or ``CELLS`` code points) is split: its interval is halved, which
  gives its words longer keys.  At an interval of one place, a block holds words that are all near each other, at
  most one per letter of the alphabet.  So no group grows with the data, and all pairs that are looked at there are results.

Words are counted by document with a map-side combine; only distinct words go further.  Links are
combined per word as they are found.  The form of a word is at least twice as frequent, so a chain of forms doubles
its counts at each step and pointer doubling reaches its root in six rounds at most.

Defined results: a null text has no words; a null doc_id counts as an empty one; very long texts and words are
handled whole; ties follow code points; repeated rows count each; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import staged

#: A run of letters: ASCII and Latin-1 (× and ÷ included), after lower-casing A-Z.
LETTERS = "[a-zÀ-ÿ]+"
#: One in this many (document, word) pairs is misspelt.
MISSPELT = 97
#: Words of a block, and code points of a tile.
TILE, CELLS = 256, 1 << 20
#: Intervals that the places of a class are cut into at first.
INTERVALS = 4
#: Distinct words a task holds before it hands them on.
HELD = 200_000


# -- words -------------------------------------------------------------------------------------


def misspelt(doc_id: str, word: str) -> str:
    """``word`` without one letter, if the checksum of document and word says so."""
    h = zlib.crc32(f"{doc_id}:{word}".encode())
    at = h % len(word)
    return word if h % MISSPELT else word[:at] + word[at + 1 :]


def _words(shortest: int):
    find = re.compile(LETTERS).findall

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"])

        total: dict[str, int] = {}
        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                start = zlib.crc32(f"{doc}:".encode())  # checksums go on from here
                for word, n in Counter(find(text.as_py().lower().decode())).items():
                    h = zlib.crc32(word.encode(), start)
                    if h % MISSPELT == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                    if len(word) >= shortest:
                        total[word] = total.get(word, 0) + n
                if len(total) > HELD:
                    yield batch_of()
                    total = {}
        yield batch_of()

    return run


def count_words(docs: DataFrame, shortest: int = 5, least: int = 3) -> DataFrame:
    """(word, n) of all words of ``shortest`` code points that occur ``least`` times, misspellings applied."""
    # bytes: lower() changes A-Z only
    texts = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    words = texts.mapInArrow(_words(shortest), "word string, n long")
    return words.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


# -- blocks ------------------------------------------------------------------------------------


def _keyed(rows: DataFrame) -> DataFrame:
    """Add ``key``: what the words of a block (longest, lo, hi) agree in."""
    word, lo, tail = F.col("word"), F.col("lo"), F.col("longest") - F.col("hi")
    return rows.withColumn("key", F.xxhash64("longest", "lo", F.substring(word, F.lit(1), lo), F.right(word, tail)))


def blocks(words: DataFrame, tile: int = TILE, cells: int = CELLS) -> DataFrame:
    """(key, longest, lo, hi, word, n): every near pair shares exactly one block that holds its place in [lo, hi)."""
    rows = words.withColumn("longest", F.explode(F.array(F.length("word"), F.length("word") + 1)))
    step = F.greatest(F.ceil(F.col("longest") / INTERVALS).cast("int"), F.lit(1))
    rows = rows.withColumn("step", step).withColumn("lo", F.explode(F.sequence(F.lit(0), F.col("longest") - 1, F.col("step"))))
    rows = _keyed(rows.withColumn("hi", F.least(F.col("lo") + F.col("step"), F.col("longest"))).drop("step"))
    done = None
    while True:
        sizes = rows.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
        rows = staged(rows.join(sizes, "key"), "spelling-blocks")
        large = (F.col("hi") - F.col("lo") > 1) & ((F.col("size") > tile) | (F.col("size") * F.col("longest") > cells))
        small = rows.where(~large).drop("size")
        done = small if done is None else done.unionByName(small)
        rows = rows.where(large).drop("size")
        if rows.isEmpty():  # an interval is halved in each round
            return done
        middle = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
        halves = F.explode(F.array(F.struct("lo", middle.alias("hi")), F.struct(middle.alias("lo"), "hi")))
        rows = _keyed(rows.withColumn("half", halves).select("longest", "half.lo", "half.hi", "word", "n"))


# -- tiles -------------------------------------------------------------------------------------


def _matrix(words: list[str], width: int) -> np.ndarray:
    """Code points, a row per word, padded with 0."""
    return np.array(words, dtype=f"U{width}").view(np.uint32).reshape(len(words), width)


def _common(a: np.ndarray, b: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each pair of rows, at most ``limit``."""
    differ = a != b
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), a.shape[1])
    return np.minimum(first, limit)


def near_pairs(words: list[str], keys: np.ndarray, longest: np.ndarray, lo: np.ndarray, hi: np.ndarray, cells: int = CELLS) -> tuple[np.ndarray, np.ndarray]:
    """Indices of all near pairs among rows sorted by block, each in the block that holds the pair's place.

    Rows are compared with those 1, 2, ... places further on, as long as blocks reach that far: a band of
    dense tiles, of at most ``cells`` code points each.
    """
    length = np.fromiter(map(len, words), np.int64, len(words))
    width = max(int(length.max(initial=1)), 1)
    forward, backward = _matrix(words, width), _matrix([w[::-1] for w in words], width)
    same = (keys[1:] == keys[:-1]) & (longest[1:] == longest[:-1]) & (lo[1:] == lo[:-1]) & (hi[1:] == hi[:-1])
    block = np.concatenate(([0], np.cumsum(~same)))
    reach = int(np.bincount(block).max())
    left, right, tile = [], [], max(cells // width, 1)
    for d in range(1, reach):
        candidates = np.flatnonzero(block[d:] == block[:-d])
        for at in range(0, len(candidates), tile):
            i = candidates[at : at + tile]
            # words one shorter than the class meet each other in their own class
            i = i[np.maximum(length[i], length[i + d]) == longest[i]]
            j = i + d
            shorter = np.minimum(length[i], length[j])
            prefix = _common(forward[i], forward[j], shorter)
            suffix = _common(backward[i], backward[j], shorter)
            near = (prefix + suffix >= longest[i] - 1) & (prefix < longest[i]) & (prefix >= lo[i]) & (prefix < hi[i])
            left.append(i[near])
            right.append(j[near])
    none = np.empty(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def _links(tile: int, cells: int):
    """Blocks, sorted by key -> (word, other, other_n) both ways."""
    names = ["key", "longest", "lo", "hi", "n"]
    limit = 16 * tile

    def compared(rows: pa.Table) -> pa.RecordBatch:
        words = rows["word"].to_pylist()
        n = rows["n"].to_numpy()
        a, b = near_pairs(words, *(rows[c].to_numpy() for c in names[:4]), cells=cells)
        one, two = np.concatenate((a, b)), np.concatenate((b, a))
        columns = [pa.array([words[i] for i in one], pa.string()), pa.array([words[i] for i in two], pa.string()), pa.array(n[two], pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["word", "other", "other_n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                held.append(batch.slice(at, limit))
                at += limit
                rows = pa.Table.from_batches(held)
                wide = rows.num_rows * int(rows["longest"].to_numpy().max())
                if rows.num_rows < limit and wide < cells:
                    continue
                # whole blocks are compared; the last one may go on
                block = rows["key"].to_numpy()
                whole = len(block) - int(np.argmax(block[::-1] != block[-1])) if (block != block[-1]).any() else 0
                if whole:
                    yield compared(rows.slice(0, whole))
                held = rows.slice(whole).combine_chunks().to_batches()
        if held:
            yield compared(pa.Table.from_batches(held))

    return run


def near_words(words: DataFrame, tile: int = TILE, cells: int = CELLS) -> DataFrame:
    """(word, n_near, form, form_n): the most frequent of its near words, of those that have any."""
    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # tiles are as wide as their longest word, so words of one class stand together
    met = blocks(words, tile, cells).repartition(parts, "key").sortWithinPartitions("longest", "key", "lo", "hi")
    links = met.mapInArrow(_links(tile, cells), "word string, other string, other_n long")
    best = F.min(F.struct((-F.col("other_n")).alias("down"), "other"))
    found = links.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    return found.select("word", "n_near", F.col("best.other").alias("form"), (-F.col("best.down")).alias("form_n"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form, from (word, form)."""
    steps = staged(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        steps = steps.join(further, "root", "left")
        steps = staged(steps.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        ended = steps.where("moved").isEmpty()
        steps = steps.drop("moved")
        if ended:  # counts double with every form, so there are at most 63 steps, passed in six rounds
            return steps


def spelling_variants(docs: DataFrame, shortest: int = 5, least: int = 3, ratio: int = 2, tile: int = TILE, cells: int = CELLS) -> DataFrame:
    """One row per word: word, n, n_near, form (a near word at least ``ratio`` times as frequent), form_n, root."""
    words = staged(count_words(docs, shortest, least), "spelling-words")
    found = words.join(near_words(words, tile, cells), "word", "left")
    counts = F.col("form_n") >= ratio * F.col("n")
    found = found.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(counts, F.col("form")).alias("form"),
        F.when(counts, F.col("form_n")).alias("form_n"),
    )
    found = staged(found, "spelling-forms")
    roots = _roots(found.where("form IS NOT NULL"))
    return found.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
