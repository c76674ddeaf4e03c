"""Language identification: known words first, then ever shorter character n-grams.

``train`` counts words and character n-grams per language over a bounded, documented sample of
labelled rows; ``predict`` scores each word of a text.  A word of the model adds its log frequency in
every language.  An unseen word falls back to its longest n-grams of which the model knows any
(``LONGEST`` characters, then fewer, word borders included), and adds their mean.

The model has at most ``words`` + ``LONGEST`` * ``grams`` entries per language, so it fits every task;
it is built by Spark aggregations of which only the kept entries reach the driver.  Prediction is one
pass over the documents without a shuffle.  A task keeps the scores of the words it met (at most
``REMEMBERED``), which changes no result.

What the bounds cost: a language that is not among the ``languages`` commonest of the corpus is never
predicted, its texts get the nearest one; a word or n-gram beyond those kept counts as unseen.

Defined results: text that is null or has no letter is ``und`` with score 0; so is every text if no
row could be learnt from.  Very long texts are scored whole; an empty table gives no rows.  Ties go to the language that sorts first.  Rows with null language teach
nothing; repeated rows are counted as often as they are sampled; the sample takes the rows with the
smallest hash of id and text.  Other columns do not matter.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

UNKNOWN = "und"
#: Characters of the longest n-gram tried for an unseen word.
LONGEST = 5
#: Words whose scores a task keeps at hand, and their scores in all languages together.
REMEMBERED, REMEMBERED_SCORES = 200_000, 4_000_000
#: A run of letters (of any script) and what stands between them.
_LETTERS = r"[^\p{L}]+"
_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class LanguageModel:
    """Log frequencies: ``tables[0]`` finds words, ``tables[n]`` n-grams, as rows of ``scores`` (a column per language)."""

    languages: list[str]
    tables: list[dict[str, int]]
    scores: np.ndarray

    def score(self, word: str) -> np.ndarray:
        known = self.tables[0].get(word)
        if known is not None:
            return self.scores[known]
        marked = f"<{word}>"
        for n in range(LONGEST, 0, -1):
            table = self.tables[n]
            found = [s for i in range(len(marked) - n + 1) if (s := table.get(marked[i : i + n])) is not None]
            if found:
                return self.scores[found].mean(axis=0)
        return np.zeros(len(self.languages))


def _sample(docs: DataFrame, per_language: int, languages: int) -> DataFrame:
    """At most ``per_language`` rows (lang, text) of each of the ``languages`` commonest: those with the smallest hash.

    Counts come first, so that rows with no chance are dropped where they are read.
    """
    place = F.xxhash64(F.col("doc_id"), F.col("text"))
    rows = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text", place.alias("place"))
    common = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages)
    share = common.select("lang", F.least(F.lit(1.0), F.lit(1.5 * per_language) / F.col("count")).alias("share"))
    near = rows.join(F.broadcast(share), "lang").where(
        F.col("place") / F.lit(float(2**63)) <= F.col("share") * 2 - 1
    )
    first = Window.partitionBy("lang").orderBy("place")
    return near.withColumn("n", F.row_number().over(first)).where(F.col("n") <= per_language).select("lang", "text")


def _counts(words: DataFrame, unit: Column, keep: int) -> DataFrame:
    """The ``keep`` most frequent units of each language: (lang, unit, rows, total)."""
    counted = words.select("lang", "rows", F.explode_outer(unit).alias("unit")).where("unit != ''")
    counted = counted.groupBy("lang", "unit").agg(F.sum("rows").alias("rows"))
    best = Window.partitionBy("lang").orderBy(F.desc("rows"), "unit")
    kept = counted.withColumn("place", F.row_number().over(best)).where(F.col("place") <= keep)
    return kept.join(counted.groupBy("lang").agg(F.sum("rows").alias("total")), "lang").drop("place")


def train(
    docs: DataFrame, per_language: int = 2000, words: int = 20_000, grams: int = 10_000, languages: int = 1000
) -> LanguageModel:
    """Learn from ``docs`` (doc_id, text, lang): at most ``per_language`` rows of each of at most ``languages``."""
    sample = _sample(docs.select("doc_id", "text", "lang"), per_language, languages)
    seen = sample.select("lang", F.explode_outer(F.split(F.lower("text"), _LETTERS)).alias("word")).where("word != ''")
    seen = seen.groupBy("lang", "word").agg(F.count("*").alias("rows")).cache()
    marked = F.concat(F.lit("<"), F.col("word"), F.lit(">"))
    tables: list[dict[str, int]] = []
    scores: list[np.ndarray] = []
    try:
        names = [r.lang for r in seen.select("lang").distinct().orderBy("lang").collect()]
        at = {lang: i for i, lang in enumerate(names)}
        for n in range(LONGEST + 1):
            rows = _counts(seen, _units(marked, n), grams if n else words).collect()  # bounded: languages * keep
            floor = np.zeros(len(names))
            for r in rows:
                floor[at[r.lang]] = math.log(0.3 / r.total)
            table: dict[str, int] = {}
            for r in rows:
                if r.unit not in table:
                    table[r.unit] = len(scores)
                    scores.append(floor.copy())
                scores[table[r.unit]][at[r.lang]] = math.log(r.rows / r.total)
            tables.append(table)
    finally:
        seen.unpersist()
    return LanguageModel(names, tables, np.array(scores).reshape(len(scores), len(names)))


def _units(marked: Column, n: int) -> Column:
    """The word itself (``n`` = 0), or its character n-grams with its borders."""
    if not n:
        return F.array("word")
    last = F.greatest(F.length(marked) - n, F.lit(0))
    parts = F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(marked, i + 1, F.lit(n)))
    return F.filter(parts, lambda g: F.length(g) == n)


def _labels(model: LanguageModel, texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    n = len(model.languages)
    size = max(1000, min(REMEMBERED, REMEMBERED_SCORES // max(n, 1)))
    place: dict[str, int] = {}
    scores = np.zeros((size, max(n, 1)))

    def label(text: str | None) -> tuple[str, float]:
        words = _WORD.findall(text.lower()) if text and n else []
        if not any(c.isalpha() for w in words for c in w):
            return UNKNOWN, 0.0
        total = np.zeros(n)
        for start in range(0, len(words), size // 2):
            part = words[start : start + size // 2]
            try:
                rows = [place[w] for w in part]
            except KeyError:
                if len(place) + len(part) > size:
                    place.clear()
                for w in part:
                    if w not in place:
                        scores[len(place)] = model.score(w)
                        place[w] = len(place)
                rows = [place[w] for w in part]
            total += scores[rows].sum(axis=0)
        best = int(total.argmax())
        return model.languages[best], float(1 / np.exp(np.maximum(total - total[best], -700)).sum())

    for batch in texts:
        yield pd.DataFrame([label(t) for t in batch], columns=["lang", "score"])


def labelled(model: LanguageModel, spark: SparkSession, text: Column) -> Column:
    """struct(lang, score) of a text column."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def label(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        return _labels(shared.value, texts)

    return label(text)


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """One row per document: doc_id, lang_pred, score (the language's share of the likelihood)."""
    rows = docs.select("doc_id", labelled(model, docs.sparkSession, F.col("text")).alias("found"))
    return rows.select("doc_id", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"))


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: a fifth of all ids."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def drop_unidentified(docs: DataFrame, model: LanguageModel, least: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, that have a language with at least ``least`` of the likelihood."""
    rows = docs.select(F.struct("*").alias("row"), F.col("text").alias("text"))
    rows = rows.select("row", labelled(model, docs.sparkSession, F.col("text")).alias("found"))
    return rows.where((F.col("found.lang") != UNKNOWN) & (F.col("found.score") >= least)).select("row.*")
