"""Row counts per data file: what turns (file, row number) into a global position."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.frame import FILE, ROW

#: Largest file table sent to every executor.  Beyond it the offsets are joined by shuffle.
BROADCAST_BYTES = 64 << 20
#: Ranges of paths that one filter lists; with more, it lets some files pass that are not needed.
MOST_RUNS = 256


class FileTable:
    """Sorted data files of one scan with their row counts and first positions.

    Loaded once, on first use, from ``counted``: one row (FILE, rows, bytes) per data file, like
    the file listing that Spark's own driver keeps for the scan.  ``rows`` is missing for text
    formats, whose rows cannot be counted without parsing them.
    """

    def __init__(self, counted: DataFrame, listed: Callable[[], list[str]] | None = None):
        """``listed`` gives the paths without a job; with it, files are counted from the first one on as needed."""
        self._counted = counted
        self._listed = listed
        self._ahead: list[str] | None = None  # listed files that are not counted yet
        self._paths: list[str] = []
        self.counts: list[int] = []
        self.starts: list[int] = []
        self._rows = self._bytes = 0
        self._loaded = False

    def _take_in(self, table: DataFrame) -> None:
        found = table.toArrow().sort_by(FILE)
        self._paths += found[FILE].to_pylist()
        if self.counted:
            counts = found["rows"].to_pylist()
            self.counts += counts
            self.starts += [*accumulate(counts, initial=self._rows)][:-1]
            self._rows += sum(counts)
            self._bytes += sum(found["bytes"].to_pylist())

    def _load(self) -> None:
        if not self._loaded:
            rest = self._counted
            self._take_in(rest if not self._paths else rest.filter(F.col(FILE) > self._paths[-1]))
            self._loaded = True

    def reach(self, position: int) -> bool:
        """Count as many of the first files as it takes to know whether there is a row at ``position``."""
        if self._ahead is None:
            self._ahead = sorted(self._listed()) if self._listed is not None and not self._loaded else []
        size = 1
        while position >= self._rows and not self._loaded:
            here, self._ahead = self._ahead[:size], self._ahead[size:]
            if not self._ahead:
                self._load()
                break
            known = self._paths[-1] if self._paths else ""
            self._take_in(self._counted.filter((F.col(FILE) > known) & (F.col(FILE) <= here[-1])))
            size *= 8
        return position < self._rows

    @property
    def paths(self) -> list[str]:
        self._load()
        return self._paths

    @property
    def counted(self) -> bool:
        """Whether row counts are known (not for text formats)."""
        return "rows" in self._counted.columns

    @property
    def rows(self) -> int:
        self._load()
        return self._rows

    @property
    def bytes(self) -> int:
        self._load()
        return self._bytes

    @property
    def bytes_per_row(self) -> float:
        return self.bytes / self.rows if self.rows else 1.0

    def single(self) -> bool:
        self._load()
        return len(self._paths) <= 1

    def locate(self, position: int) -> tuple[str, int]:
        """File and row number of a global position below ``rows``."""
        self.reach(position)
        i = bisect_right(self.starts, position) - 1
        return self._paths[i], position - self.starts[i]

    def boundary_after(self, position: int) -> int:
        """First position of the file that follows the one holding ``position``."""
        self._load()
        i = bisect_right(self.starts, position)
        return self.starts[i] if i < len(self.starts) else self._rows

    def runs(self, slices: list[tuple[int, int, int]]) -> list[tuple[str, str]]:
        """(first, last) path of the runs of files with a row of ``slices`` (first, last position, step).

        At most ``MOST_RUNS``: beyond them, runs with the fewest files between them are joined.
        """
        self.reach(max(last for _, last, _ in slices))
        touched: list[tuple[int, int]] = []
        for first, last, step in slices:
            a, b = bisect_right(self.starts, first) - 1, bisect_right(self.starts, last) - 1
            # a step longer than the rows of many files passes over some of them
            stops = range(first, last + 1, step)
            if step > 1 and len(stops) <= b - a:
                touched += [(i, i) for i in (bisect_right(self.starts, p) - 1 for p in stops)]
            else:
                touched.append((a, b))
        merged: list[list[int]] = []
        for a, b in sorted(touched):
            if merged and a <= merged[-1][1] + 1:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        gaps = sorted(range(1, len(merged)), key=lambda i: merged[i - 1][1] - merged[i][0])
        cuts = [0, *sorted(gaps[: MOST_RUNS - 1]), len(merged)]
        return [(self._paths[merged[i][0]], self._paths[merged[j - 1][1]]) for i, j in zip(cuts, cuts[1:], strict=False)]

    def with_position(self, df: DataFrame, name: str, end: int | None = None) -> DataFrame:
        """Add the global position as ``name`` to rows that carry FILE and ROW.

        All rows lie before position ``end``, if it is given: files behind it are not counted.
        """
        if end is None or not self.reach(end - 1):
            self._load()
        if len(self._paths) <= 1:
            return df.withColumn(name, F.col(ROW))
        start = name + "_start"
        table = pa.table({FILE: self._paths, start: pa.array(self.starts, pa.int64())})
        if table.nbytes <= BROADCAST_BYTES:
            joined = df.join(F.broadcast(df.sparkSession.createDataFrame(table)), FILE)
        else:
            # Too many files to broadcast: shuffle, with each file cut into blocks of rows so
            # that one huge file does not land in one task.
            block, size = name + "_block", 1 << 20
            blocks = table.append_column("rows", pa.array(self.counts, pa.int64()))
            offsets = df.sparkSession.createDataFrame(blocks).select(
                FILE, start, F.explode(F.expr(f"sequence(0L, rows div {size})")).alias(block)
            )
            joined = df.withColumn(block, F.expr(f"{ROW} div {size}")).join(offsets, [FILE, block]).drop(block)
        return joined.withColumn(name, F.col(start) + F.col(ROW)).drop(start)

    def with_file_number(self, df: DataFrame, name: str) -> DataFrame | None:
        """Add the place of each row's file in path order, or None when that needs a shuffle."""
        if self.single():
            return df.withColumn(name, F.lit(0))
        table = pa.table({FILE: self._paths, name: pa.array(range(len(self._paths)), pa.int32())})
        if table.nbytes > BROADCAST_BYTES:
            return None
        return df.join(F.broadcast(df.sparkSession.createDataFrame(table)), FILE)
