"""The value that flows between operators: a DataFrame plus an explicit row order.

Spark DataFrames have no row order, and every operator here is defined on an ordered
sequence of rows.  A :class:`Frame` therefore names the columns that *define* the order.
They are ordinary columns of the DataFrame, hidden from the user by a name prefix, so
Catalyst prunes them whenever an operator does not need the order.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, replace
from functools import reduce
from typing import TYPE_CHECKING, Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

if TYPE_CHECKING:
    from rowloom.sources.files import FileTable

HIDDEN = "__rl_"
FILE, BLOCK, ROW = HIDDEN + "file", HIDDEN + "block", HIDDEN + "row"
LINE, PART = HIDDEN + "line", HIDDEN + "part"
POS, HASH = HIDDEN + "pos", HIDDEN + "hash"


def quoted(name: str) -> Column:
    """Column reference that survives dots, spaces and back-ticks in ``name``."""
    return F.col("`" + name.replace("`", "``") + "`")


@dataclass(frozen=True)
class Key:
    """One column of the row order."""

    name: str
    descending: bool = False
    nan_last: bool = False

    def sort_columns(self) -> list[Column]:
        col = quoted(self.name)
        if not self.descending:
            return [col.asc_nulls_last()]  # Spark ranks NaN above every number already
        if self.nan_last:
            return [col.isNull().asc(), F.isnan(col).asc(), col.desc()]
        return [col.desc_nulls_last()]


#: How the order keys behave, which decides how row ranks can be found:
#: ``files``    (file path, row number in file): a function of the stored data alone
#: ``position`` one unique integer column
#: ``hash``     seeded hash of the position, then the position
#: ``sorted``   user column(s) first, or keys whose distribution is unknown
#: ``lines``    text formats: valid for sorting, but not repeatable between two jobs
#: ``decoded``  a row per file, decoded anew by every pass: written once before anything that takes several
KINDS = ("files", "position", "hash", "sorted", "lines", "decoded")


@dataclass(frozen=True)
class Reread:
    """What is read of a source: ranges of files by path (first, last) and columns (None: all)."""

    read: Callable[[tuple[tuple[str | None, str | None], ...], frozenset[str] | None], DataFrame]
    ranges: tuple[tuple[str | None, str | None], ...] = ((None, None),)
    columns: frozenset[str] | None = None
    #: user columns that the changes so far refer to; None when that is not known
    used: frozenset[str] | None = frozenset()

    def rows(self) -> DataFrame:
        return self.read(self.ranges, self.columns)


@dataclass(frozen=True)
class Frame:
    """An ordered dataset.

    ``whole`` means the rows are exactly base rows ``span[0] .. span[1]-1`` of ``files``
    (nothing filtered out in between); ``dense_from`` means a ``position`` order counts
    up from that number without gaps.  Both let row ranks become literals.

    A streaming frame (``bounded=False``) also carries ``twin``, which builds the same chain as a
    lazy scan of the same files, and ``steps``, the part of the chain that needs row positions.
    """

    df: DataFrame
    order: tuple[Key, ...]
    kind: str
    files: FileTable | None = None
    whole: bool = False
    span: tuple[int, int | None] = (0, None)
    dense_from: int | None = None
    #: for sources that cannot prune files and columns themselves: read less, then replay ``narrow``
    reread: Reread | None = None
    narrow: tuple[Callable[[DataFrame], DataFrame], ...] = ()
    bounded: bool = True
    by_file: bool = False
    steps: tuple[Any, ...] = ()
    twin: Callable[[], Frame] | None = None

    @property
    def spark(self) -> SparkSession:
        return self.df.sparkSession

    @property
    def columns(self) -> list[str]:
        if self.steps:
            return self.steps[-1].columns
        return [c for c in self.df.columns if not c.startswith(HIDDEN)]

    @property
    def order_names(self) -> list[str]:
        return [k.name for k in self.order]

    def sort_columns(self) -> list[Column]:
        return [c for k in self.order for c in k.sort_columns()]

    def narrowed(
        self, change: Callable[[DataFrame], DataFrame], uses: Iterable[str] | None = None, **fields: Any
    ) -> Frame:
        """Apply a row-wise change (a filter or a projection) to the DataFrame; ``uses`` are its user columns."""
        if self.reread is not None:
            used = None if uses is None or self.reread.used is None else self.reread.used.union(uses)
            fields = {"reread": replace(self.reread, used=used), "narrow": (*self.narrow, change), **fields}
        return replace(self, df=change(self.df), **fields)

    def reading(self, **changes: Any) -> Frame:
        """Read other files or columns of the source, and replay the changes."""
        reread = replace(self.reread, **changes)
        return replace(self, reread=reread, df=reduce(lambda df, change: change(df), self.narrow, reread.rows()))

    def pruned(self, columns: Iterable[str]) -> Frame:
        """Before a projection to ``columns``: read no other columns but those used so far."""
        if self.reread is None or self.reread.used is None:
            return self
        return self.reading(columns=self.reread.used.union(columns))

    def rebuilt(self, df: DataFrame, **fields: Any) -> Frame:
        """Replace the DataFrame by one that is no longer row by row the scan."""
        return replace(self, df=df, reread=None, narrow=(), **fields)

    def filtered(self, condition: Column, uses: Iterable[str] | None = None) -> Frame:
        """Keep some rows; the order keys stay valid but ranks are no longer literal."""
        return self.narrowed(lambda df: df.filter(condition), uses, whole=False, dense_from=None)

    def rows(self) -> DataFrame:
        """User columns in row order."""
        from rowloom.plans.order import sorted_rows

        return sorted_rows(self).select(*[quoted(c) for c in self.columns])

    def unordered_rows(self) -> DataFrame:
        """User columns without paying for a global sort."""
        return self.df.select(*[quoted(c) for c in self.columns])

    def transform(self, operator: Any, *args: Any, **kwargs: Any) -> Any:
        """``frame.transform(take_rows, 10)`` reads like ``DataFrame.transform``."""
        return operator(self, *args, **kwargs)


def from_dataframe(df: DataFrame, key: str | list[str] | None = None) -> Frame:
    """Wrap a DataFrame.

    With ``key`` (columns that together are unique) the rows are ordered by it.  Without one
    the current order is fixed once by writing the rows to the shared staging folder.
    """
    from rowloom.plans.order import write_rows

    if df.isStreaming:
        raise ValueError("Use load(..., streaming=True) for streaming data.")
    taken = [c for c in df.columns if c.startswith(HIDDEN)]
    if taken:
        raise ValueError(f"Column names starting with {HIDDEN!r} are reserved: {', '.join(taken)}.")
    if key is None:
        return write_rows(df)  # files are named by partition, so path order is row order
    names = [key] if isinstance(key, str) else list(key)
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"Unknown key column {missing[0]!r}: columns are {', '.join(df.columns)}.")
    return Frame(df, tuple(Key(n) for n in names), "sorted")
