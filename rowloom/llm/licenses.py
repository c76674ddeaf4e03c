"""License scans by diagonal voting.

All rolling word k-gram hashes of the documents are joined with the k-gram positions of the templates.
A match at document word p and template word t votes for the diagonal p - t: an unchanged copy puts
all its votes on one diagonal, a copy with a few words more or less on neighbouring ones.  Votes are
counted per diagonal, diagonals of one template at most ``gap`` apart are merged, and a merged span
is verified: the words of the template that its votes cover, as a share of the template, must reach the
template's ``least`` share, and the span may be at most half as long again as the template.  A longer
span is verified diagonal by diagonal, each with its neighbours, so that a repeated phrase hides no notice.

A *phrase* is a template that must be matched whole on one diagonal; its places are the base result.

The templates are a parameter of bounded size (at most ``MOST_GRAMS`` k-grams), so they are broadcast and
documents are not shuffled; only votes are, one row per text, template and diagonal after partial
aggregation.  Copies of a text vote once.

Defined results: a null text has no words; very long texts are handled whole; phrases may overlap; labels that
tie in score are all listed; repeated rows get equal results, a row
each; texts without a match have score 0 and no labels; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowloom.llm.common import staged, text_key, with_grams, words_of

#: Templates of more k-grams than this are refused: they would not be small enough to broadcast.
MOST_GRAMS = 100_000


@dataclass(frozen=True)
class Template:
    """Words of a license text or phrase; ``gap`` and ``least`` as above, ``k`` words per vote."""

    label: str
    text: str
    k: int = 3
    gap: int = 3
    least: float = 0.7
    phrase: bool = False

    def words(self) -> list[str]:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), self.text)
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def phrase(label: str, text: str) -> Template:
    return Template(label, text, k=2, gap=0, least=1.0, phrase=True)


#: Phrases that name a license.
PHRASES = (
    phrase("gpl", "gnu general public license"),
    phrase("apache", "apache license"),
    phrase("cc-by", "cc by"),
    phrase("mit", "mit license"),
)
#: Notices by which works are put under a license.
NOTICES = (
    Template(
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation",
    ),
    Template(
        "apache",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
        "with the License",
    ),
    Template("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction",
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
    ),
    Template("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
)


def _template_grams(spark: SparkSession, templates: tuple[Template, ...]) -> tuple[DataFrame, DataFrame]:
    """(k, gram, template, at) of all template positions, and one row of settings per template."""
    rows = [(i, t.label, t.words(), t.k, t.gap, t.least, t.phrase) for i, t in enumerate(templates)]
    if any(len(words) < k for _, _, words, k, *_ in rows):
        raise ValueError("A template needs at least k words.")
    if sum(len(r[2]) for r in rows) > MOST_GRAMS:
        raise ValueError(f"The templates have more than {MOST_GRAMS} words.")
    known = spark.createDataFrame(
        rows, "template int, label string, words array<string>, k int, gap int, least double, phrase boolean"
    )
    known = known.withColumn("h", F.transform("words", lambda w: F.xxhash64(w)))
    grams = None
    for k in sorted({t.k for t in templates}):
        own = with_grams(known.where(F.col("k") == k), "h", k, "grams")
        own = own.select("k", "template", F.posexplode_outer("grams").alias("at", "gram"))
        grams = own if grams is None else grams.unionByName(own)
    return grams, known.select("template", "label", F.size("words").alias("n"), "k", "gap", "least", "phrase")


def license_spans(docs: DataFrame, templates: tuple[Template, ...] = PHRASES + NOTICES) -> DataFrame:
    """Verified spans of every distinct text: key, label, phrase, first, last (words), score."""
    grams, settings = _template_grams(docs.sparkSession, templates)
    tokens = docs.select(text_key(F.col("text")).alias("key"), words_of(F.col("text")).alias("words"))
    tokens = tokens.select("key", F.transform("words", lambda w: F.xxhash64(w)).alias("h"))
    votes = None
    for k in sorted({t.k for t in templates}):
        own = with_grams(tokens, "h", k, "grams").select("key", F.posexplode_outer("grams").alias("place", "gram"))
        own = own.join(F.broadcast(grams.where(F.col("k") == k).drop("k")), "gram")
        own = own.select("key", "template", (F.col("place") - F.col("at")).alias("diagonal"), "at")
        votes = own if votes is None else votes.unionByName(own)
    # One row per diagonal: which template positions voted (at most the template's length).
    diagonals = votes.groupBy("key", "template", "diagonal").agg(F.collect_set("at").alias("ats"))
    diagonals = staged(diagonals, "license-diagonals").join(F.broadcast(settings), "template")
    # A phrase needs all its votes on one diagonal; the rest is noise already here.
    diagonals = diagonals.where(~F.col("phrase") | (F.size("ats") == F.col("n") - F.col("k") + 1))
    ordered = Window.partitionBy("key", "template").orderBy("diagonal")
    step = F.col("diagonal") - F.lag("diagonal").over(ordered)
    fresh = F.when(step <= F.col("gap"), 0).otherwise(1)
    merged = diagonals.withColumn("fresh", fresh).withColumn("run", F.sum("fresh").over(ordered))
    merged = merged.withColumns(
        {"first": F.col("diagonal") + F.array_min("ats"), "end": F.col("diagonal") + F.array_max("ats")}
    )
    settled = ("label", "n", "k", "least", "phrase")
    spans = merged.groupBy("key", "template", "run").agg(
        F.min("first").alias("first"),
        F.max("end").alias("end"),
        F.array_distinct(F.flatten(F.collect_set("ats"))).alias("ats"),
        *[F.first(c).alias(c) for c in settled],
    )
    spans = spans.withColumn("last", F.col("end") + F.col("k") - 1)
    short = F.col("last") - F.col("first") + 1 <= 1.5 * F.col("n")
    # Repeated words chain diagonals into a run that is no copy as a whole.  Then every diagonal is looked at by
    # itself, with those at most ``gap`` away: a copy among them is on one of these.
    chained = merged.join(spans.where(~short).select("key", "template", "run"), ["key", "template", "run"])
    spans = spans.where(short).select("key", "template", "first", "last", "ats", *settled)
    for gap in sorted({t.gap for t in templates if not t.phrase}):
        near = Window.partitionBy("key", "template", "run").orderBy("diagonal").rangeBetween(-gap, gap)
        single = chained.where(F.col("gap") == gap).select(
            "key",
            "template",
            F.min("first").over(near).alias("first"),
            (F.max("end").over(near) + F.col("k") - 1).alias("last"),
            F.array_distinct(F.flatten(F.collect_list("ats").over(near))).alias("ats"),
            *settled,
        )
        spans = spans.unionByName(single)
    covered = F.size(F.array_distinct(F.flatten(F.transform("ats", lambda t: F.sequence(t, t + F.col("k") - 1)))))
    spans = spans.withColumn("score", covered / F.col("n")).where(F.col("score") >= F.col("least"))
    return spans.select("key", "label", "phrase", "first", "last", "score").distinct()


def scan_licenses(docs: DataFrame, templates: tuple[Template, ...] = PHRASES + NOTICES) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels (arrays), score."""
    spans = license_spans(docs, templates)
    of_phrase = F.when(F.col("phrase"), F.col("first"))
    found = spans.groupBy("key").agg(
        F.count(of_phrase).alias("n_base"),
        F.min(of_phrase).cast("long").alias("first_word"),
        F.max(of_phrase).cast("long").alias("last_word"),
        F.array_sort(F.collect_set(F.when(F.col("phrase"), F.col("label")))).alias("base_labels"),
        F.array_sort(F.collect_set("label")).alias("labels"),
        F.max("score").alias("score"),
    )
    rows = docs.select(
        "doc_id", text_key(F.col("text")).alias("key"), F.size(words_of(F.col("text"))).cast("long").alias("n_words")
    )
    none = F.array().cast("array<string>")
    return rows.join(found, "key", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", none).alias("base_labels"),
        F.coalesce("labels", none).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
