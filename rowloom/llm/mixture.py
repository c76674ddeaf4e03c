"""Mixing sources to target weights by temperature.

A source with a share s of all tokens gets the weight s^x / sum(s^x).  The exponent x is bisected in
[0, 1]: the largest one whose weights reach the target entropy (as a part of the entropy of equal
weights), raised as far as the repetition limit asks for (no source is passed more than
``max_epochs`` times).  Each step of the search halves the interval six times over at once: one
aggregation of the source table evaluates 63 exponents.

The weights are realised as block permutations.  The block of a source is all its documents; each
pass over it is a fresh permutation (by hash of document, pass and seed).  A source is passed as
often as its budget of tokens holds the block, and then up to the document that would exceed it.
``place`` in [0, 1) interleaves the sources, so that every stretch of the output has the weights.

Only (source, hash, tokens) of each document is shuffled, summed into buckets of the hash, about
``BUCKET`` documents each, so a source that holds most rows is spread over many groups; one bucket a
source is looked at document by document.  The rows themselves are not shuffled.

Defined results: rows with null source are a source of their own; null and empty texts have no tokens
and are passed with their source; a source without tokens has no weight and goes; documents equal
in id and text share their place and are taken together; an empty table gives an empty mixture; a
column of the input named like an added one is replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowloom.llm.common import staged

#: Documents of one hash bucket, on average.
BUCKET = 2000
#: Exponents evaluated at once, and how often.
SECTIONS, ROUNDS = 64, 4


def _source(rows_source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), rows_source), F.lit(""))


def _identity() -> Column:
    return F.xxhash64(F.col("doc_id"), F.col("text"))


def _unit(hashed: Column) -> Column:
    """A hash as a number in [0, 1)."""
    return F.shiftrightunsigned(hashed, 11) / F.lit(float(2**53))


def _drawn(identity: Column, epoch: Column, seed: int) -> Column:
    return F.xxhash64(identity, epoch.cast("long"), F.lit(seed).cast("long"))


def measured(docs: DataFrame) -> DataFrame:
    """(origin, identity, tokens, doc_id) of every document, written once; tokens are white-space words."""
    tokens = F.size(F.array_remove(F.split(F.coalesce("text", F.lit("")), r"\s+"), "")).cast("long")
    origin = _source(F.col("source")).alias("origin")
    return staged(docs.select(origin, _identity().alias("identity"), tokens.alias("tokens"), "doc_id"), "mix-measured")


def weigh(sources: DataFrame, entropy: float, max_epochs: float, budget: float | None) -> tuple[DataFrame, float]:
    """``sources`` (origin, docs, tokens) with ``weight`` and ``epochs``; the exponent."""
    sources = sources.where("tokens > 0")
    totals = sources.agg(F.count("*").alias("n"), F.sum("tokens").alias("tokens")).first()
    if not totals.n:
        return sources.withColumns({"weight": F.lit(0.0), "epochs": F.lit(0.0)}), 1.0
    share = F.col("tokens") / F.lit(float(totals.tokens))
    passes = (budget or totals.tokens) / totals.tokens  # of a source whose weight is its share
    low, high, x = 0.0, 1.0, 1.0
    for _ in range(ROUNDS):
        tried = sorted({low + (high - low) * i / (SECTIONS - 1) for i in range(SECTIONS)})
        powers = sources.select(share.alias("s"), F.explode(F.array(*map(F.lit, tried))).alias("x"))
        power = F.pow("s", "x")
        sums = powers.groupBy("x").agg(
            F.sum(power).alias("z"), F.sum(power * F.log("s")).alias("l"), F.max(F.pow("s", F.col("x") - 1)).alias("most")
        )
        by_x = {r.x: r for r in sums.collect()}  # SECTIONS rows
        least = entropy * math.log(totals.n)

        def entropy_of(r) -> float:
            return math.log(r.z) - r.x * r.l / r.z

        def within(r) -> bool:
            return passes * r.most / r.z <= max(max_epochs, passes) * (1 + 1e-12)

        # Larger exponents: less entropy, fewer repetitions.
        diverse = [i for i, t in enumerate(tried) if entropy_of(by_x[t]) >= least - 1e-12]
        i = max(diverse, default=0)
        if not within(by_x[tried[i]]):
            i = next((j for j in range(i, len(tried)) if within(by_x[tried[j]])), len(tried) - 1)
            low, high = tried[max(i - 1, 0)], tried[i]
        else:
            low, high = tried[i], tried[min(i + 1, len(tried) - 1)]
        x, z = tried[i], by_x[tried[i]].z
    weight = F.pow(share, F.lit(x)) / F.lit(z)
    return sources.withColumn("weight", weight).withColumn("epochs", F.col("weight") / share * F.lit(passes)), x


def plan(
    measures: DataFrame, entropy: float = 0.97, max_epochs: float = 4.0, budget: float | None = None, seed: int = 11
) -> DataFrame:
    """One row per source: origin, docs, tokens, weight, epochs, full (whole passes), cut (last hash of the last pass).

    ``budget`` is the number of tokens to give out; all tokens of the corpus if None.
    """
    sources = measures.groupBy("origin").agg(F.count("*").alias("docs"), F.sum("tokens").alias("tokens"))
    weighed, _ = weigh(staged(sources, "mix-sources"), entropy, max_epochs, budget)
    weighed = weighed.withColumn("full", F.floor(F.col("epochs") + 1e-9).cast("long"))
    weighed = weighed.withColumn("rest", F.greatest(F.col("epochs") - F.col("full"), F.lit(0.0)) * F.col("tokens"))
    weighed = staged(weighed.withColumn("buckets", F.ceil(F.col("docs") / BUCKET)), "mix-weights")
    drawn = measures.join(weighed.select("origin", "full", "buckets", "rest"), "origin")
    drawn = drawn.withColumn("drawn", _drawn(F.col("identity"), F.col("full"), seed))
    drawn = drawn.withColumn("bucket", F.floor(_unit(F.col("drawn")) * F.col("buckets")))
    # The bucket in which each source's last pass ends.
    ordered = Window.partitionBy("origin").orderBy("bucket")
    sums = drawn.groupBy("origin", "rest", "bucket").agg(F.sum("tokens").alias("sum"))
    sums = sums.withColumn("upto", F.sum("sum").over(ordered))
    ends = sums.where("upto > rest").groupBy("origin").agg(F.min_by(F.struct("bucket", "upto", "sum"), "bucket").alias("e"))
    ends = ends.select("origin", F.col("e.bucket").alias("last"), (F.col("e.upto") - F.col("e.sum")).alias("before"))
    ends = staged(ends, "mix-ends")
    # The last document of that bucket which still fits.
    inside = drawn.join(ends, "origin").where("bucket = last")
    running = Window.partitionBy("origin").orderBy(_unit(F.col("drawn")))
    inside = inside.withColumn("upto", F.col("before") + F.sum("tokens").over(running)).where("upto <= rest")
    cuts = inside.groupBy("origin").agg(F.max(_unit(F.col("drawn"))).alias("cut"))
    nothing = F.col("rest") <= 1e-6  # the passes come out even
    return staged(
        weighed.join(ends, "origin", "left")
        .join(cuts, "origin", "left")
        .select(
            "origin",
            "docs",
            "tokens",
            "weight",
            "epochs",
            "full",
            # No bucket ends the pass: it is whole.  No document of it fits: the pass ends below it.
            F.when(nothing, -1.0).when(F.col("last").isNull(), 1.0).otherwise(F.coalesce("cut", F.lit(-1.0))).alias("cut"),
            F.when(nothing, 0.0).otherwise(F.coalesce(F.col("last") / F.col("buckets"), F.lit(1.0))).alias("below"),
        ),
        "mix-plan",
    )


def _realised(rows: DataFrame, planned: DataFrame, seed: int) -> DataFrame:
    """``rows`` with ``origin`` and ``identity``, once for each pass that takes them, with ``epoch`` and ``place``."""
    drawn = _unit(_drawn(F.col("identity"), F.col("full"), seed))
    joined = rows.join(planned.select("origin", "epochs", "full", "cut", "below"), "origin")
    joined = joined.withColumn("part", (drawn < F.col("below")) | (drawn <= F.col("cut")))
    last = F.col("full") - F.when(F.col("part"), 0).otherwise(1)
    passes = F.when(last >= 0, F.sequence(F.lit(0).cast("long"), last)).otherwise(F.array().cast("array<long>"))
    out = joined.withColumn("epoch", F.explode_outer(passes)).where("epoch IS NOT NULL")
    at = (F.col("epoch") + _unit(_drawn(F.col("identity"), F.col("epoch"), seed))) / F.col("epochs")
    return out.withColumn("place", F.least(at, F.lit(1 - 2.0**-53)))


def mixture(
    docs: DataFrame, entropy: float = 0.97, max_epochs: float = 4.0, budget: float | None = None, seed: int = 11
) -> DataFrame:
    """The mixture without texts: doc_id, origin, tokens, weight, epoch, place."""
    measures = measured(docs)
    planned = plan(measures, entropy, max_epochs, budget, seed)
    out = _realised(measures, planned, seed).join(planned.select("origin", "weight"), "origin")
    return out.select("doc_id", "origin", "tokens", "weight", "epoch", "place")


def mixed(
    docs: DataFrame, entropy: float = 0.97, max_epochs: float = 4.0, budget: float | None = None, seed: int = 11
) -> DataFrame:
    """The rows of ``docs``, all columns, in the mixture, with ``epoch`` and ``place``."""
    planned = plan(measured(docs), entropy, max_epochs, budget, seed)
    rows = docs.select(F.struct("*").alias("row"), _source(F.col("source")).alias("origin"), _identity().alias("identity"))
    kept = [F.col("row")[c].alias(c) for c in docs.columns if c not in ("epoch", "place")]
    return _realised(rows, planned, seed).select(*kept, "epoch", "place")
