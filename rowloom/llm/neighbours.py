"""Approximate nearest neighbours by collision counting on single projections.

Each vector is projected on ``projections`` random directions; for each direction a block of vectors has
one sorted array.  A query opens a window of half-width h around its own projection in every array
(virtual rehashing: h grows by ``growth``, and only the entries that come in are counted).  A vector
that lies in at least ``threshold`` of the windows is verified by its exact distance.  The query
stops once h is at least its k-th smallest verified distance: a vector nearer than that is inside
each window with probability 0.68 or more, so it has reached the threshold (36 of 64) in
at least 98 of 100 cases, whatever the data.

Vectors and queries meet in pairs of blocks of at most about ``BLOCK`` rows each, spread by hash; a task
holds one pair.  Every vector is indexed.  Each pair returns k rows a query, and a window picks
the k best.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components take no
part, nor do rows without id; rows equal in id and vector count once; a query meets vectors of its
own dimension only, and none with its own id; ties go to the smaller id; fewer candidates than k are
all returned; an empty table gives no rows.  A block is bounded in rows, not in bytes: choose ``BLOCK`` by the
width of the vectors (2^14 rows of 1000 numbers take 130 MB).  Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 1 << 14
PROJECTIONS, THRESHOLD, GROWTH = 64, 36, 1.3
#: Rows of a block from which a query guesses how wide its first window is.
GUESS = 256


class SortedProjections:
    """The sorted arrays of one block."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, projections: int, seed: int = 5):
        self.ids, self.vectors = ids, vectors
        self.directions = np.random.default_rng(seed).standard_normal((vectors.shape[1], projections))
        projected = vectors @ self.directions
        self.guess = projected[:GUESS]
        self.order = np.argsort(projected, axis=0, kind="stable").T.astype(np.int32)
        self.sorted = np.take_along_axis(projected, self.order.T, axis=0).T.copy()

    def search(self, own: int, query: np.ndarray, k: int, threshold: int, growth: float) -> tuple[np.ndarray, np.ndarray]:
        """Ids and distances of the (up to) k nearest verified vectors, nearest first."""
        n, m = len(self.ids), len(self.sorted)
        at = query @ self.directions
        lows = np.array([a.searchsorted(x) for a, x in zip(self.sorted, at, strict=True)])
        highs = lows.copy()
        counts = np.zeros(n, np.int32)
        done = self.ids == own
        found_ids, found = np.empty(0, np.int64), np.empty(0)
        half = 0.25 * float(np.median(np.abs(self.guess - at)))
        while True:
            if half > 0:
                new_lows = np.array([a.searchsorted(x - half, "left") for a, x in zip(self.sorted, at, strict=True)])
                new_highs = np.array([a.searchsorted(x + half, "right") for a, x in zip(self.sorted, at, strict=True)])
            else:  # no scale to go by: take everything
                new_lows, new_highs, half = np.zeros(m, np.int64), np.full(m, n), np.inf
            entering = [o[a:b] for o, a, b in zip(self.order, new_lows, lows, strict=True) if a < b]
            entering += [o[a:b] for o, a, b in zip(self.order, highs, new_highs, strict=True) if a < b]
            if entering:
                counts += np.bincount(np.concatenate(entering), minlength=n).astype(np.int32)
            lows, highs = np.minimum(lows, new_lows), np.maximum(highs, new_highs)
            passed = np.flatnonzero((counts >= threshold) & ~done)
            if len(passed):
                done[passed] = True
                apart = self.vectors[passed] - query
                ids = np.concatenate((found_ids, self.ids[passed]))
                distances = np.concatenate((found, np.sqrt((apart * apart).sum(axis=1))))
                best = np.lexsort((ids, distances))[:k]
                found_ids, found = ids[best], distances[best]
            if (len(found) == k and half >= found[-1]) or (highs - lows == n).all():
                return found_ids, found
            half *= growth


def _usable(vector: Column) -> Column:
    return F.coalesce(
        (F.size(vector) > 0)
        & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        & F.exists(vector, lambda x: x != 0),
        F.lit(False),
    )


def _blocks(rows: int) -> int:
    return max(1, -(-rows // BLOCK))


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    projections: int = PROJECTIONS,
    threshold: int = THRESHOLD,
    growth: float = GROWTH,
) -> DataFrame:
    """For each row (vec_id, embedding) with ``is_query``: query_id, rank (from 1), vec_id, score (distance)."""
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("embedding"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    )
    rows = rows.where(F.col("vec_id").isNotNull() & _usable(F.col("embedding")))
    rows = rows.groupBy("vec_id", "embedding").agg(F.max("asks").alias("asks"))
    rows = rows.withColumn("dim", F.size("embedding"))
    sizes = rows.agg(F.count("*").alias("n"), F.count_if("asks").alias("asking")).first()
    blocks, groups = _blocks(sizes.n), _blocks(sizes.asking)
    place = F.xxhash64("vec_id", "embedding")

    def pairs(df: DataFrame, block: Column, group: Column) -> DataFrame:
        return df.select("dim", block.alias("block"), group.alias("asked"), "vec_id", "embedding")

    all_groups = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long")))
    all_blocks = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
    stored = pairs(rows, F.pmod(place, F.lit(blocks)).cast("long"), all_groups)
    asking = pairs(rows.where("asks"), all_blocks, F.pmod(place, F.lit(groups)).cast("long"))

    def matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        ids = table.column("vec_id").to_numpy()
        flat = table.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        return ids, flat.reshape(len(ids), -1)

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
        if left.num_rows and right.num_rows:
            index = SortedProjections(*matrix(left), projections)
            for own, query in zip(*matrix(right), strict=True):
                ids, distances = index.search(own, query, k, threshold, growth)
                out["query_id"] += [int(own)] * len(ids)
                out["vec_id"] += ids.tolist()
                out["score"] += distances.tolist()
        return pa.table(out, schema=pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]))

    keys = ("dim", "block", "asked")
    found = (
        stored.groupBy(*keys).cogroup(asking.groupBy(*keys)).applyInArrow(search, "query_id long, vec_id long, score double")
    )
    nearest_first = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(nearest_first)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
