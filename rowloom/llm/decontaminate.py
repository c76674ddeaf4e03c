"""Benchmark decontamination by winnowing, in DataFrame functions only.

A *window* is a run of ``length`` consecutive words of an item; a shorter item is one window.  Of
every ``length - k + 1`` consecutive k-gram hashes the smallest is a fingerprint, so any two texts
that share ``length`` words share a fingerprint there.  The fingerprints of the documents are joined
with those of the items.  Each hit is extended to all windows around it, whose words are compared;
so nothing is missed, and no hash decides.  An item of m < ``length`` words has its own m-gram as
fingerprint, and documents are fingerprinted by m-grams as well for each such m in the benchmark.

Documents are read three times, and only texts with a matching fingerprint are shuffled, one row per
text and task however often it occurs.  Item fingerprints, windows and the keys of such texts are broadcast while
they are fewer than ``BROADCAST_ROWS`` (counted); beyond that both sides are shuffled.  Arrays are unnested by the outer
form: the inner one adds a filter that computes the array a second time.

Defined results: null text has no words; very long texts are handled whole; an empty benchmark hits nothing; a text counts by itself, so
repeated rows and repeated ids get equal results, a row each; items that repeat count once; an item
without id marks words but is not listed; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowloom.llm.common import staged, text_key, with_grams, with_sliding_min, words_of

#: Rows (a hash, or a window of at most ``length`` words) up to which the item side is broadcast.
BROADCAST_ROWS = 200_000


def _tokens(rows: DataFrame, *keep: str) -> DataFrame:
    """``words`` and their hashes ``h`` beside the columns ``keep``, from ``text``."""
    return rows.select(*keep, words_of(F.col("text")).alias("words")).withColumn(
        "h", F.transform("words", lambda w: F.xxhash64(w))
    )


def _window(words: Column, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(words, start + 1, length), " ")


def _item_windows(items: DataFrame, length: int) -> DataFrame:
    """Distinct (item_id, n, window)."""
    tokens = items.select("item_id", words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
    n = F.least(F.size("words"), F.lit(length))
    starts = F.explode(F.sequence(F.lit(0), F.size("words") - n))
    rows = tokens.select("item_id", "words", n.alias("n"), starts.alias("start"))
    return rows.select("item_id", "n", _window(F.col("words"), F.col("start"), F.col("n")).alias("window")).distinct()


def _with_fingerprints(tokens: DataFrame, length: int, k: int, short: list[int]) -> DataFrame:
    """Add ``prints``: the smallest k-gram hashes of all windows, and all m-gram hashes for m in ``short``."""
    df = with_sliding_min(with_grams(tokens, "h", k, "grams"), "grams", length - k + 1, "least")
    parts = ["least"]
    for m in short:
        df = with_grams(df, "h", m, f"short{m}")
        parts.append(f"short{m}")
    return df.withColumn("prints", F.array_distinct(F.concat(*parts))).drop("least", *parts[1:])


def _bounded(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def find_windows(docs: DataFrame, items: DataFrame, length: int = 10, k: int = 7) -> tuple[DataFrame, DataFrame]:
    """Occurrences of item windows, one row (key, start, n, window) per place in each distinct text; the windows.

    ``key`` is the :func:`~rowloom.llm.common.text_key` of the text; ``start`` counts words from 0.
    """
    docs = docs.select("text")
    windows = staged(_item_windows(items.select("item_id", "text"), length), "item-windows")
    sizes = {r.n: r.rows for r in windows.groupBy("n").agg(F.count("*").alias("rows")).collect()}  # <= length rows
    short = sorted(m for m in sizes if m < length)
    grams = _with_fingerprints(_tokens(items.select("text"), "text"), length, k, [])
    long_prints = grams.select(F.explode_outer("prints").alias("print"), F.lit(length).alias("n"))
    own = windows.where(F.col("n") < length).select(F.split("window", " ").alias("words"), "n")
    own = own.withColumn("h", F.transform("words", lambda w: F.xxhash64(w)))
    prints = long_prints
    for m in short:
        whole = with_grams(own.where(F.col("n") == m), "h", m, "gram")
        prints = prints.unionByName(whole.select(F.explode_outer("gram").alias("print"), F.lit(m).alias("n")))
    prints = staged(prints.where("print IS NOT NULL").distinct(), "item-prints")
    rows = prints.count()

    # Which texts share a fingerprint with an item.
    tokens = _tokens(docs.select(text_key(F.col("text")).alias("key"), "text"), "key")
    exploded = _with_fingerprints(tokens, length, k, short).select("key", F.explode_outer("prints").alias("print"))
    known = _bounded(prints.select("print").distinct(), rows)
    keys = staged(exploded.join(known, "print", "left_semi").select("key").distinct(), "leaked-keys")
    texts = docs.select(text_key(F.col("text")).alias("key"), "text").join(_bounded(keys, keys.count()), "key", "left_semi")
    texts = staged(texts.dropDuplicates(["key"]), "leaked-texts")

    # Where they share it, and the windows around each place.
    grams = with_grams(_tokens(texts, "key"), "h", k, "grams")
    places = grams.select("key", F.lit(length).alias("n"), F.posexplode_outer("grams").alias("at", "print"))
    for m in short:
        more = with_grams(_tokens(texts, "key"), "h", m, "grams")
        places = places.unionByName(more.select("key", F.lit(m).alias("n"), F.posexplode_outer("grams").alias("at", "print")))
    hits = places.join(_bounded(prints, rows), ["print", "n"], "left_semi")
    hits = hits.groupBy("key").agg(F.collect_set(F.struct("n", "at")).alias("hits"))  # at most a text's words
    reach = F.when(F.col("hit.n") == length, length - k).otherwise(0)
    around = (
        texts.select("key", words_of(F.col("text")).alias("words"))
        .join(hits, "key")
        .select("key", "words", F.explode("hits").alias("hit"))
        .select(
            "key",
            F.col("hit.n").alias("n"),
            F.greatest(F.col("hit.at") - reach, F.lit(0)).alias("from"),
            F.slice(
                "words",
                F.greatest(F.col("hit.at") - reach, F.lit(0)) + 1,
                F.col("hit.n") + F.least(F.col("hit.at"), reach),
            ).alias("near"),
        )
        .where(F.size("near") >= F.col("n"))
    )
    starts = F.explode(F.sequence(F.lit(0), F.size("near") - F.col("n")))
    found = around.select("key", "n", "from", "near", starts.alias("step")).select(
        "key",
        (F.col("from") + F.col("step")).alias("start"),
        "n",
        _window(F.col("near"), F.col("step"), F.col("n")).alias("window"),
    )
    known = _bounded(windows.select("n", "window").distinct(), sum(sizes.values()))
    return found.join(known, ["n", "window"], "left_semi").distinct(), windows


def leaks(docs: DataFrame, items: DataFrame, length: int = 10, k: int = 7) -> DataFrame:
    """Per distinct text with a hit: key, n_hit (words inside an occurrence), items (ids as sorted strings)."""
    found, windows = find_windows(docs, items, length, k)
    found = staged(found, "leaks")
    before = Window.partitionBy("key").orderBy("start", "n").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("n")
    covered = F.coalesce(F.max(end).over(before), F.lit(0))
    new = F.greatest(end - F.greatest("start", covered), F.lit(0))
    words = found.select("key", new.alias("new")).groupBy("key").agg(F.sum("new").cast("long").alias("n_hit"))
    by_window = found.select("key", "n", "window").distinct().join(windows, ["n", "window"])
    ids = by_window.groupBy("key").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    return words.join(ids, "key")


def decontaminate(docs: DataFrame, items: DataFrame, length: int = 10, k: int = 7) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, items (array of ids), contaminated."""
    counted = docs.select(
        "doc_id", text_key(F.col("text")).alias("key"), F.size(words_of(F.col("text"))).cast("long").alias("n_words")
    )
    found = counted.join(leaks(docs, items, length, k), "key", "left")
    return found.select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, length: int = 10, k: int = 7) -> DataFrame:
    """The rows of ``docs``, all columns, whose text holds no window of an item."""
    rows = docs.select(text_key(F.col("text")).alias("key"), F.struct("*").alias("row"))
    found, _ = find_windows(docs, items, length, k)
    found = staged(found.select("key").distinct(), "leaks")
    return rows.join(_bounded(found, found.count()), "key", "left_anti").select("row.*")
