"""From raw documents to a training mixture, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet to the
shared folder and read again as the next one's ``docs``, so a lost executor costs no earlier stage.
All stages but the last return the columns of ``documents``; the last adds ``epoch`` and ``place``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rowloom.llm.common import staged
from rowloom.llm.decontaminate import drop_contaminated
from rowloom.llm.language import drop_unidentified, train
from rowloom.llm.mixture import mixed
from rowloom.llm.secrets import redact_secrets
from rowloom.llm.simhash import drop_near_duplicates


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that have a language; those without letters, or undecided between languages, go."""
    return drop_unidentified(docs, train(docs))


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest doc_id) of each group of near duplicates."""
    return drop_near_duplicates(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no ten words in a row of a benchmark item."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark and n_chars counted anew."""
    return redact_secrets(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as their source's weight asks for, with ``epoch`` and ``place``."""
    return mixed(docs)


STAGES = [
    ("language ID", identify_language),
    ("SimHash near-dedup", remove_near_duplicates),
    ("benchmark decontamination", remove_benchmark),
    ("secret scans", mask_secrets),
    ("mixing sources", mix_sources),
]

#: Language models and 64-bit hashes have no SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{number}")
    return docs
