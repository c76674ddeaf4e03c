"""Connected components of a graph too large for one machine, by star contraction.

Each round links every node's larger neighbours to its smallest one (large star), then every node's
smaller neighbours to the smallest (small star).  The number of rounds grows with the logarithm of
the longest path.  Neighbours are reduced to their minimum before they are joined, so a node with
many neighbours is never gathered.  Each round is written to the shared folder: no long lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import staged


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").where("a < b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("b").agg(F.min("a").alias("m"))
    joined = links.join(least, "b")
    down = joined.where("a > m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return down.unionByName(least.select(F.col("m").alias("a"), "b")).distinct()


def _state(links: DataFrame) -> tuple[int, int]:
    total = F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0)).alias("total")
    row = links.agg(F.count("*").alias("n"), total).first()
    return row.n, int(row.total)


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of the links (a, b), a < b: root is the component's smallest node."""
    links = staged(links, "links")
    last, state = None, _state(links)
    while state != last and state[0]:
        links = staged(_small_star(_large_star(links)), "links")
        last, state = state, _state(links)
    members = links.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return members.unionByName(links.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
