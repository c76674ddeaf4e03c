"""Row ranks on distributed data: cut by rank, number densely, fix an order.

Three tools, chosen so that no step puts data-sized work into one task:

* ``cut``    keeps rows by rank.  The rank is turned into the *key* found at that rank, so the
             cut itself is a plain filter on the order keys: no shuffle, and files outside the
             range are never opened.
* ``number`` gives every row its 0-based rank.  Rows are ranked inside small buckets (a run of
             rows of one file, the leading bits of a hash) and bucket offsets are joined on the same
             partitioning, so there is a single exchange of the rows.
* ``settle`` writes rows once in order, for orders whose ranks cannot be derived from the data
             (text formats), or whose rows cost too much to make them twice (image files).  Cuts of a sort count rows around its keys, and the buckets of a sort are
             intervals between sampled keys (``selection``).

One task totals a table of row counts: one small row per bucket, or per group of some thousand buckets
when there are many.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce
from typing import Any
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rowloom.frame import FILE, HASH, HIDDEN, LINE, POS, ROW, Frame, Key, quoted
from rowloom.plans.selection import comparable, interval_numbers, keys_at_ranks, keys_only, shown_keys, within
from rowloom.plans.staging import staging_path
from rowloom.sources.files import FileTable

#: Rows per bucket: at most this many, fewer when rows are wide.
BUCKET_ROWS, MIN_BUCKET_ROWS, BUCKET_BYTES = 1 << 20, 1 << 12, 32 << 20
#: Rows of an interval of a sort.
SORT_BUCKET_ROWS = 1 << 16
#: Ranks of a sort that a top-k finds; others are looked up by counting.  The rows are the same.
TOP_K = 1000
#: Rows that all tasks of a top-k may hand to its final task, and the usual size of a scan task.
FAN_IN_ROWS, TASK_BYTES = 5_000_000, 128 << 20
#: Scan tasks over files that are decoded whose rows go to one file of the written copy.
TASKS_PER_COPY = 16
#: How wide rows are written: row groups of bounded size, however few rows they hold.
WIDE_ROWS = {"parquet.block.size": 32 << 20, "parquet.block.size.row.check.min": 1, "parquet.page.size.row.check.min": 1}
#: Bits of the shuffle hash; it is never negative.
HASH_BITS = 63
#: Buckets that one task totals; beyond it their groups are totalled.
BUCKETS_IN_ONE_TASK = 1 << 17
#: What was written in order already, by DataFrame and order.
_SETTLED: WeakKeyDictionary[DataFrame, dict[tuple[Key, ...], Frame]] = WeakKeyDictionary()
#: Row counts that were needed before.
_COUNTS: WeakKeyDictionary[DataFrame, int] = WeakKeyDictionary()
BUCKET, FILE_NUMBER = HIDDEN + "bucket", HIDDEN + "filenumber"


# -- scans ------------------------------------------------------------------------------


def scan_frame(df: DataFrame) -> Frame:
    """Frame over a Parquet scan, ordered by (file path, row number in the file)."""
    # this scan reads no column; a filter on the path keeps it to some files
    counted = df.groupBy(F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_size").alias("bytes")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    return Frame(df, (Key(FILE), Key(ROW)), "files", files=FileTable(counted, lambda: _listed(df)), whole=True)


def _listed(df: DataFrame) -> list[str]:
    """The files of a scan, from Spark's listing, written as in the metadata column (file:/x, not file:///x)."""
    return [re.sub(r"^(\w+):///", r"\1:/", path) for path in df.inputFiles()]


def with_rows(frame: Frame) -> Frame:
    """Add the order columns of a Parquet scan.

    They are added as late as possible, because a scan that once mentions its metadata produces it
    for every row, used or not.
    """
    if frame.kind != "files" or ROW in frame.df.columns:
        return frame

    def add(df: DataFrame) -> DataFrame:
        metadata = df.metadataColumn("_metadata")
        return df.select("*", metadata.getField("file_path").alias(FILE), metadata.getField("row_index").alias(ROW))

    return frame.narrowed(add)


def write_rows(df: DataFrame, **options: Any) -> Frame:
    """Write rows as they are partitioned; the result is an ordinary scan in that order."""
    path = staging_path(df.sparkSession, "settled")
    df.write.options(**options).parquet(path)
    return scan_frame(df.sparkSession.read.parquet(path))


def settle(frame: Frame) -> Frame:
    """Write the rows once in their order.

    Ties and hot values are no problem for the range partitioning: the order keys end in a
    unique row key, so a value held by a third of all rows is spread over many partitions.
    """
    known = _SETTLED.setdefault(frame.df, {})
    if frame.order not in known and frame.kind == "decoded":
        known[frame.order] = write_rows(_decoded_once(frame).rows(), **WIDE_ROWS)
    elif frame.order not in known:
        known[frame.order] = write_rows(frame.rows())
    return known[frame.order]


def _decoded_once(frame: Frame) -> Frame:
    """The rows and their order keys, written by the tasks that decode them.

    A sort looks at its rows twice, so it reads this copy.  Scan tasks hold few files when these are small.
    """
    path = staging_path(frame.spark, "decoded")
    tasks = frame.df.select(FILE).rdd.getNumPartitions()  # of a frame of its own, which does not keep the listed files twice
    copies = max(frame.spark.sparkContext.defaultParallelism * 4, tasks // TASKS_PER_COPY)
    frame.df.coalesce(copies).write.options(**WIDE_ROWS).parquet(path)
    return frame.rebuilt(frame.spark.read.parquet(path), kind="sorted")


def sorted_rows(frame: Frame) -> DataFrame:
    """All columns, in row order.  Paths are replaced by numbers so that they are not shuffled."""
    if frame.kind == "decoded":
        frame = settle(frame)
    if frame.kind == "lines":
        frame = with_lines(frame)
    elif frame.kind == "files" and frame.files is not None:
        return stable_position(frame).df.orderBy(POS)
    else:
        frame = with_rows(frame)
    return frame.df.orderBy(*frame.sort_columns()) if frame.order else frame.df


def with_lines(frame: Frame) -> Frame:
    """Add the running number that orders the lines of one block of a text file.

    It is added as late as possible, because no filter moves below it.
    """
    if LINE in frame.df.columns:
        return frame
    numbered = frame.df.withColumn(LINE, F.monotonically_increasing_id())
    placed = frame.files.with_file_number(numbered, FILE_NUMBER) if frame.files is not None else None
    if placed is None:
        return frame.rebuilt(numbered)
    order = tuple(replace(k, name=FILE_NUMBER) if k.name == FILE else k for k in frame.order)
    return frame.rebuilt(placed, order=order)


# -- row counts -------------------------------------------------------------------------


def count_of(frame: Frame) -> int:
    """Number of rows; a scan without a filter answers from its file table."""
    if frame.whole and frame.files is not None:
        lo, hi = frame.span
        return max(0, min(hi, frame.files.rows) - lo) if hi is not None else max(0, frame.files.rows - lo)
    return frame.df.count()


# -- buckets ----------------------------------------------------------------------------


def _bucket_rows(frame: Frame) -> int:
    """Rows per bucket: small while there are few buckets, then growing with the data."""
    if frame.files is None:
        return 1 << 16
    wide = int(BUCKET_BYTES / max(frame.files.bytes_per_row, 1e-9))
    return max(MIN_BUCKET_ROWS, min(BUCKET_ROWS, wide, frame.files.rows // BUCKETS_IN_ONE_TASK))


def _hash_bits(frame: Frame) -> int:
    """Leading bits so that a bucket of the uniform hash holds about ``_bucket_rows`` rows."""
    rows = frame.files.rows if frame.files is not None else _COUNTS.get(frame.df)
    if rows is None:
        rows = _COUNTS[frame.df] = frame.df.count()
    return max(1, math.ceil(math.log2(max(rows / _bucket_rows(frame), 1.0))))


@dataclass(frozen=True)
class Buckets:
    """Expressions that are monotone in the order and hold a bounded number of rows each.

    ``groups`` are coarser: some thousands of buckets each.  ``many`` tells whether there may be too
    many buckets to total in one task.
    """

    columns: list[Column]
    groups: list[Column]
    many: bool

    @property
    def names(self) -> list[str]:
        return [f"{BUCKET}{i}" for i in range(len(self.columns))]


def _buckets(frame: Frame) -> Buckets | None:
    first = BUCKET + "0"
    if frame.kind == "hash":
        bits = _hash_bits(frame)
        leading = F.shiftright(HASH, HASH_BITS - bits).alias(first)
        return Buckets([leading], [F.expr(f"{first} div 4096")], 2**bits > BUCKETS_IN_ONE_TASK)
    if frame.kind in ("files", "position"):
        *outer, row = frame.order_names
        size = _bucket_rows(frame)
        cols = [F.col(n).alias(f"{BUCKET}{i}") for i, n in enumerate(outer)]
        last = f"{BUCKET}{len(outer)}"
        groups = [F.col(f"{BUCKET}{i}") for i in range(len(outer))]
        many = frame.files is None or frame.files.rows // size + len(frame.files.paths) > BUCKETS_IN_ONE_TASK
        return Buckets([*cols, F.expr(f"{row} div {size}").alias(last)], [*groups, F.expr(f"{last} div 4096")], many)
    if frame.kind == "sorted" and comparable(frame):
        rows = _COUNTS.get(frame.df)
        if rows is None:
            rows = _COUNTS[frame.df] = frame.df.count()
        interval = interval_numbers(frame, rows, SORT_BUCKET_ROWS)
        return None if interval is None else Buckets([interval.alias(first)], [F.lit(0)], False)
    return None


def _bucket_table(df: DataFrame, buckets: Buckets) -> DataFrame:
    """One row per bucket: its row count ``n``, rows before it (``start``) and including it (``upto``)."""
    names = buckets.names
    counted = df.select(*buckets.columns).groupBy(*names).agg(F.count(F.lit(1)).alias("n"))
    if not buckets.many:
        upto = F.sum("n").over(Window.orderBy(*names))
        return counted.withColumn("upto", upto).withColumn("start", F.col("upto") - F.col("n"))
    # total the groups in one task, and the buckets inside each group in parallel
    groups = [f"{BUCKET}group{i}" for i in range(len(buckets.groups))]
    grouped = counted.select("*", *[c.alias(g) for c, g in zip(buckets.groups, groups, strict=True)])
    totals = grouped.groupBy(*groups).agg(F.sum("n").alias("rows"))
    before = totals.withColumn("before", F.sum("rows").over(Window.orderBy(*groups)) - F.col("rows"))
    inside = F.sum("n").over(Window.partitionBy(*groups).orderBy(*names))
    joined = grouped.withColumn("inside", inside).join(before.drop("rows"), groups)
    placed = joined.withColumn("upto", F.col("before") + F.col("inside"))
    return placed.select(*names, "n", "upto", (F.col("upto") - F.col("n")).alias("start"))


# -- rank to key ------------------------------------------------------------------------


def _key_at_least(keys: list[str], values: tuple[Any, ...]) -> Column:
    """(k1, k2, ...) >= (v1, v2, ...), written so that a scan can prune on the first key."""
    *head, last = list(zip(keys, values, strict=True))
    condition = F.col(last[0]) >= F.lit(last[1])
    for name, value in reversed(head):
        col = F.col(name)
        condition = (col >= F.lit(value)) & ((col > F.lit(value)) | condition)
    return condition


def _key_below(keys: list[str], values: tuple[Any, ...]) -> Column:
    *head, last = list(zip(keys, values, strict=True))
    condition = F.col(last[0]) < F.lit(last[1])
    for name, value in reversed(head):
        col = F.col(name)
        condition = (col <= F.lit(value)) & ((col < F.lit(value)) | condition)
    return condition


def _between(frame: Frame, low: tuple[Any, ...] | None, high: tuple[Any, ...] | None) -> list[Column]:
    names = frame.order_names
    conditions = []
    if low is not None:
        conditions.append(_key_at_least(names, low))
    if high is not None:
        conditions.append(_key_below(names, high))
    return conditions


def _scan_range(frame: Frame, lo: int, hi: int | None) -> Frame:
    """Rows at base positions lo..hi-1 of a scan ordered by (file, row)."""
    files = frame.files
    assert files is not None
    low = files.locate(lo) if lo > 0 and files.reach(lo) else None
    high = files.locate(hi) if hi is not None and files.reach(hi) else None
    return _within(frame, low, high)


def _within(frame: Frame, low: tuple[Any, ...] | None, high: tuple[Any, ...] | None) -> Frame:
    """Rows with low <= order keys < high."""
    if low or high:
        frame = with_rows(frame)
    if frame.reread is not None and (low or high):
        first, last = frame.reread.ranges[0][0], frame.reread.ranges[-1][1]
        frame = frame.reading(ranges=((low[0] if low else first, high[0] if high else last),))
    for condition in _between(frame, low, high):
        frame = frame.narrowed(lambda df, c=condition: df.filter(c), uses=())
    return frame


def _probe_spans(frame: Frame, rank: int) -> list[tuple[int, int | None]]:
    """Growing prefixes of the scan, so that a small rank reads only the first files."""
    if frame.kind != "files" or frame.files is None or frame.order_names != [FILE, ROW]:
        return [(0, None)]
    lo, hi = frame.span
    end = frame.files.rows if hi is None else min(hi, frame.files.rows)
    spans: list[tuple[int, int | None]] = []
    width = max(4 * (rank + 1), 1 << 16)
    at = lo
    while at < end:
        stop = min(end, frame.files.boundary_after(min(at + width, end) - 1))
        spans.append((at, stop))
        at, width = stop, width * 8
    return spans or [(lo, end)]


def keys_at(frame: Frame, ranks: list[int], counts: DataFrame | None = None) -> list[tuple[Any, ...] | None]:
    """Order-key values of the rows at ``ranks`` (ascending); None beyond the last row.

    ``counts`` is the frame's bucket table, when it is there already.
    """
    frame = with_rows(frame)
    buckets = _buckets(frame)
    assert buckets is not None
    found: dict[int, tuple[Any, ...]] = {}
    before = 0
    for lo, hi in _probe_spans(frame, max(ranks)) if counts is None else [(0, None)]:
        part = frame.df
        if frame.kind == "files" and frame.files is not None and (lo, hi) != (0, None):
            part = _scan_range(frame, lo, hi).df
        wanted = [r - before for r in ranks if r not in found]
        hit = reduce(lambda a, b: a | b, [(F.col("start") <= r) & (F.col("upto") > r) for r in wanted])
        bucket = F.struct(*buckets.names, "start", "upto")
        table = _bucket_table(part, buckets) if counts is None else counts
        # at most one bucket per wanted rank
        summary = table.agg(F.max("upto").alias("rows"), F.collect_list(F.when(hit, bucket)).alias("hits")).first()
        for row in summary["hits"]:
            inside = [r for r in wanted if row["start"] <= r < row["upto"]]
            here = part.select("*", *buckets.columns)
            for name in buckets.names:
                here = here.filter(F.col(name) == F.lit(row[name]))
            # one bucket: a bounded number of rows
            rank = F.row_number().over(Window.orderBy(*frame.order_names)) - 1 + F.lit(row["start"])
            for key in here.select(*frame.order_names, rank.alias("at")).filter(F.col("at").isin(inside)).collect():
                found[key["at"] + before] = tuple(key[n] for n in frame.order_names)
        before += summary["rows"] or 0
        if all(r in found for r in ranks):
            break
    return [found.get(r) for r in ranks]


# -- cut by rank ------------------------------------------------------------------------


def cut(frame: Frame, lo: int, hi: int | None = None) -> Frame:
    """Rows with rank in [lo, hi); ``hi=None`` means to the end."""
    return cuts(frame, [(lo, hi)])[0]


def cuts_of_total(
    frame: Frame, ranges_of: Callable[[int], list[tuple[int, int | None]]], total: int | None = None
) -> list[Frame]:
    """Cuts whose ranges depend on the number of rows, which is counted in the same pass."""
    if frame.kind == "sorted" and comparable(frame):
        if total is None:
            total = _COUNTS[frame.df] = frame.df.count()
        return cuts(frame, ranges_of(total))
    if frame.kind in ("sorted", "lines", "decoded"):
        frame = settle(frame)
    if total is not None or frame.whole:
        return cuts(frame, ranges_of(count_of(frame) if total is None else total))
    frame = with_rows(frame)
    counts = _bucket_table(frame.df, _buckets(frame)).persist()
    try:
        total = counts.agg(F.max("upto")).first()[0] or 0
        return cuts(frame, ranges_of(total), counts)
    finally:
        counts.unpersist()


def cuts(frame: Frame, ranges: list[tuple[int, int | None]], counts: DataFrame | None = None) -> list[Frame]:
    """Several cuts of one frame that share the lookup of their boundaries."""
    if frame.whole and frame.files is not None and frame.kind == "files":
        return [_cut_whole(frame, lo, hi) for lo, hi in ranges]
    if frame.kind == "decoded":
        return cuts(settle(frame), ranges)
    if frame.dense_from is not None:
        base = frame.dense_from
        return [_cut_dense(frame, base + lo, None if hi is None else base + hi) for lo, hi in ranges]
    if frame.kind in ("sorted", "lines"):
        ends = [hi for _, hi in ranges]
        if frame.kind == "lines" and frame.order_names[0] == FILE and None not in ends:
            frame = _first_files(frame, max(ends))
        if len(ranges) == 1 and ranges[0][0] == 0 and ends[0] is not None and ends[0] <= TOP_K:
            frame = with_lines(frame) if frame.kind == "lines" else frame
            return [frame.rebuilt(_top(frame, ends[0]), kind="sorted")]
        if frame.kind == "sorted" and comparable(frame):
            return _sorted_cuts(frame, ranges)
        return cuts(settle(frame), ranges)
    ranks = sorted({r for lo, hi in ranges for r in (lo, hi) if r is not None and r > 0})
    at = dict(zip(ranks, keys_at(frame, ranks, counts), strict=True)) if ranks else {}
    out = []
    for lo, hi in ranges:
        if hi is not None and hi <= lo or lo > 0 and at[lo] is None:
            out.append(frame.filtered(F.lit(False), uses=()))
            continue
        piece = _within(frame, at[lo] if lo > 0 else None, at[hi] if hi is not None else None)
        out.append(replace(piece, whole=False, dense_from=None))
    return out


# -- ranks of a sort ----------------------------------------------------------------------


def _sorted_keys_at(frame: Frame, ranks: list[int]) -> list[tuple[Any, ...] | None]:
    """Order keys of the rows at ``ranks``; None beyond the last row.  Rows are neither moved nor written.

    Small ranks take a top-k of the keys.  Other keys are found by counting (``selection``).
    """
    if max(ranks) <= TOP_K:
        head = replace(frame, df=_top(keys_only(frame), max(ranks) + 1))
        rows = head.df.select(*shown_keys(head)).collect()
        return [tuple(rows[r]) if r < len(rows) else None for r in ranks]
    total = _COUNTS.get(frame.df)
    if total is None:
        total = _COUNTS[frame.df] = frame.df.count()
    found = keys_at_ranks(frame, ranks, total)
    return [found.get(r) for r in ranks]


def _sorted_cuts(frame: Frame, ranges: list[tuple[int, int | None]]) -> list[Frame]:
    """Cuts of a sort as filters on its keys, which stay lazy."""
    ranks = sorted({r for lo, hi in ranges for r in (lo, hi) if r})
    at = dict(zip(ranks, _sorted_keys_at(frame, ranks), strict=True)) if ranks else {}
    out = []
    for lo, hi in ranges:
        if hi is not None and hi <= lo or lo > 0 and at[lo] is None:
            out.append(frame.filtered(F.lit(False), uses=()))
            continue
        out.append(within(frame, at[lo] if lo > 0 else None, at[hi] if hi else None))
    return out


def _top(frame: Frame, n: int) -> DataFrame:
    """The first ``n`` rows of a sort, without sorting everything.

    Every task hands its best ``n`` rows to one final task.  With very many tasks those rows are
    first reduced in groups of tasks, so that the final one stays small.
    """
    df, keys = frame.df, frame.sort_columns()
    tasks = frame.files.bytes // TASK_BYTES + 1 if frame.files is not None and frame.files.counted else 1
    if tasks * n > FAN_IN_ROWS:
        group, rank = HIDDEN + "group", HIDDEN + "rank"
        grouped = df.withColumn(group, F.pmod(F.spark_partition_id(), F.lit(math.isqrt(tasks) + 1)))
        ranked = grouped.withColumn(rank, F.row_number().over(Window.partitionBy(group).orderBy(*keys)))
        df = ranked.filter(F.col(rank) <= n).drop(group, rank)
    return df.orderBy(*keys).limit(n)


def _first_files(frame: Frame, rows: int) -> Frame:
    """A prefix of the files of a text source that holds at least ``rows`` rows."""
    paths = frame.files.paths if frame.files is not None else []
    n = 1
    while n < len(paths):
        head = frame.narrowed(lambda df, last=paths[n - 1]: df.filter(F.col(FILE) <= last))
        if head.df.count() >= rows:
            return head
        n *= 8
    return frame


def _cut_whole(frame: Frame, lo: int, hi: int | None) -> Frame:
    """A cut of a run of a scan: only the files up to its end are counted."""
    first, last = frame.span
    a = first + lo
    ends = [e for e in (last, None if hi is None else first + hi) if e is not None]
    b = min(ends, default=None)
    if b is not None and a >= b or not frame.files.reach(a):
        return replace(frame.filtered(F.lit(False), uses=()), whole=True, span=(a, a))
    return replace(_scan_range(frame, a, b), span=(a, b))


def touching(frame: Frame, ranges: list[range], low: int) -> Frame:
    """Leave out files of a run of a scan that hold no row of ``ranges``, whose smallest index is ``low``.

    Only for a frame that is numbered next: positions still count the rows left out.
    """
    if not (frame.whole and frame.files is not None and frame.kind == "files"):
        return frame
    first = frame.span[0] - low
    runs = frame.files.runs([(first + min(r[0], r[-1]), first + max(r[0], r[-1]), abs(r.step)) for r in ranges])
    if len(runs) <= 1:
        return frame  # the cut is as narrow
    frame = with_rows(frame)
    if frame.reread is not None:
        return frame.reading(ranges=tuple(runs))
    hit = reduce(lambda a, b: a | b, [F.col(FILE).between(first, last) for first, last in runs])
    return frame.narrowed(lambda df: df.filter(hit))


def _cut_dense(frame: Frame, a: int, b: int | None) -> Frame:
    df = frame.df.filter(F.col(POS) >= F.lit(a))
    if b is not None:
        df = df.filter(F.col(POS) < F.lit(b))
    return frame.rebuilt(df, dense_from=a)


# -- number densely ---------------------------------------------------------------------


def number(frame: Frame) -> Frame:
    """Give every row its 0-based rank in the hidden POS column, which becomes the order."""
    frame = with_rows(frame)
    if frame.whole and frame.files is not None and frame.kind == "files":
        placed = frame.files.with_position(frame.df, POS, frame.span[1])
        return _by_position(frame, placed, first=frame.span[0])
    if frame.dense_from is not None:
        return frame if frame.dense_from == 0 else _by_position(frame, frame.df, first=frame.dense_from)
    if frame.kind == "files" and frame.files is not None:
        # the position alone is shuffled with the rows, not the path
        frame = replace(stable_position(frame), order=(Key(POS),), kind="position")
    buckets = _buckets(frame)
    if buckets is None:
        return number(settle(frame))
    names, start, rank = buckets.names, HIDDEN + "start", HIDDEN + "rank"
    table = _bucket_table(frame.df, buckets).select(*names, F.col("start").alias(start))
    inside = Window.partitionBy(*names).orderBy(*frame.sort_columns())
    ranked = (
        frame.df.select("*", *buckets.columns)
        .withColumn(rank, F.row_number().over(inside))
        .join(table.hint("merge"), names)  # same partitioning as the window: no second exchange
    )
    return _by_position(frame, ranked.withColumn(POS, F.col(start) + F.col(rank) - F.lit(1)), first=0)


def _by_position(frame: Frame, df: DataFrame, first: int) -> Frame:
    keep = [quoted(c) for c in frame.columns]
    pos = F.col(POS) - F.lit(first) if first else F.col(POS)
    placed = df.select(*keep, pos.alias(POS))
    return frame.rebuilt(placed, order=(Key(POS),), kind="position", whole=False, dense_from=0)


def stable_position(frame: Frame) -> Frame:
    """Add POS as a repeatable, layout-independent row id; gaps are allowed.

    A scan needs no shuffle for it, filtered or not.  Other orders are settled or already have it.
    """
    if POS in frame.df.columns:
        return frame
    frame = with_rows(frame)
    if frame.files is not None and {FILE, ROW} <= set(frame.df.columns):
        return frame.rebuilt(frame.files.with_position(frame.df, POS, frame.span[1] if frame.whole else None))
    if frame.kind in ("sorted", "lines", "decoded"):
        return stable_position(settle(frame))
    return number(frame)
