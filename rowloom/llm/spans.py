"""Places of pattern matches in whole texts, in DataFrame functions only (built-in regular expressions).

Defined results: expressions of one row each, so repeated rows get equal results, and no other column matters;
an empty text has no matches; very long texts and any number of matches are handled whole, with work in proportion.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: One match: first character, one past the last (code points, from 0), the matched text, and up to
#: ``CONTEXT`` characters on either side of it (not beyond the neighbouring matches).
NO_MATCHES = "array<struct<start:int,end:int,match:string,before:string,after:string>>"
CONTEXT = 40
#: One reported span.
NO_SPANS = "array<struct<start:int,rank:int,end:int,kind:string>>"
#: Running sums copy what they have so far, so they are built in runs of this many entries.
RUN = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _before(values: Column, combine: Callable[[Column, Column], Column], zero: int) -> Column:
    """All entries before each entry, combined; one entry more than ``values``, for all of them."""
    return F.aggregate(
        values,
        F.array(F.lit(zero)),
        lambda acc, v: F.concat(acc, F.array(combine(F.element_at(acc, -1), v))),
    )


def running(values: Column, combine: Callable[[Column, Column], Column], zero: int) -> Column:
    """All entries before each entry of a bound int array, combined; ``combine`` is associative."""
    runs = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(values) - 1) / RUN).cast("int")),
        lambda j: _before(F.slice(values, j * RUN + 1, F.lit(RUN)), combine, zero),
    )

    def joined(runs: Column) -> Column:
        offsets = _before(F.transform(runs, lambda r: F.element_at(r, -1)), combine, zero)
        shifted = F.zip_with(
            runs,
            F.slice(offsets, F.lit(1), F.size(runs)),
            lambda r, o: F.transform(F.slice(r, F.lit(1), F.size(r) - 1), lambda x: combine(x, o)),
        )
        return F.flatten(shifted)

    return let(runs, joined)


def running_sums(values: Column) -> Column:
    """Sum of all entries before each entry of a bound int array."""
    return running(values, lambda a, b: a + b, 0)


def matches_of(text: Column, pattern: str) -> Column:
    """All leftmost, non-overlapping matches of ``pattern`` (never empty) in a non-null text, in order.

    The text between the matches is split off only where there is a match; lengths of pieces and
    matches add up to the places.
    """

    def located(matches: Column, pieces: Column) -> Column:
        count = F.size(matches)
        parts = F.zip_with(
            F.zip_with(F.slice(pieces, F.lit(1), count), matches, lambda p, m: F.struct(p.alias("piece"), m.alias("match"))),
            F.slice(pieces, F.lit(2), count),
            lambda x, after: F.struct(
                F.length(x["piece"]).alias("gap"),
                F.length(x["match"]).alias("size"),
                x["match"].alias("match"),
                F.right(x["piece"], F.lit(CONTEXT)).alias("before"),
                F.left(after, F.lit(CONTEXT)).alias("after"),
            ),
        )

        def placed(parts: Column) -> Column:
            steps = F.transform(parts, lambda x: x["gap"] + x["size"])
            return F.zip_with(
                parts,
                let(steps, running_sums),
                lambda x, s: F.struct(
                    (s + x["gap"]).alias("start"),
                    (s + x["gap"] + x["size"]).alias("end"),
                    x["match"].alias("match"),
                    x["before"].alias("before"),
                    x["after"].alias("after"),
                ),
            )

        return let(parts, placed)

    def found(matches: Column) -> Column:
        split = let(F.split(text, pattern, -1), lambda pieces: located(matches, pieces))
        return F.when(F.size(matches) > 0, split).otherwise(F.array().cast(NO_MATCHES))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), found)


def as_spans(matches: Column, kind: str, rank: int) -> Column:
    """Matches as reported spans; ``rank`` orders kinds that start together."""
    return F.transform(
        matches,
        lambda m: F.struct(
            m["start"].alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end"), F.lit(kind).alias("kind")
        ),
    )


def written(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined, by start, then rank."""
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def of_kinds(spans: Column, kinds: tuple[str, ...]) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def counted(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def _merged(ordered: Column) -> Column:
    """Maximal runs (start, end) of overlapping or touching spans, from a bound, sorted, non-empty array of them."""

    def of_reach(reach: Column) -> Column:
        pairs = F.zip_with(ordered, reach, lambda s, r: F.struct(s["start"].alias("start"), r.alias("reach")))
        last = F.array_max(F.transform(ordered, lambda s: s["end"]))

        def closed(firsts: Column) -> Column:
            ends = F.transform(F.slice(firsts, F.lit(2), F.size(firsts) - 1), lambda x: x["reach"])
            return F.zip_with(
                firsts, F.concat(ends, F.array(last)), lambda x, end: F.struct(x["start"].alias("start"), end.alias("end"))
            )

        return let(F.filter(pairs, lambda x: x["start"] > x["reach"]), closed)

    ends = F.transform(ordered, lambda s: s["end"])
    return let(let(ends, lambda e: running(e, F.greatest, -1)), of_reach)


def masked(text: Column, spans: Column, mark: str) -> Column:
    """The text with every maximal run of overlapping or touching spans replaced by ``mark``.

    Places are counted from the start of a text, so it is first cut at every ``RUN``-th run: the work for a
    text grows with its length and spans, not with their product.  Without spans the text stays; null spans
    or text give null.
    """

    def replaced(runs: Column) -> Column:
        def block(j: Column) -> Column:
            own = F.slice(runs, j * RUN + 1, F.lit(RUN))
            begin = F.when(j > 0, F.get(runs, j * RUN - 1)["end"]).otherwise(F.lit(0))

            def cut(x: Column) -> Column:
                def gap(r: Column, i: Column) -> Column:
                    since = F.when(i > 0, F.get(x["own"], i - 1)["end"]).otherwise(x["begin"])
                    return F.substring(x["piece"], since - x["begin"] + 1, r["start"] - since)

                return F.concat(F.array_join(F.transform(x["own"], gap), mark), F.lit(mark))

            def with_piece(x: Column) -> Column:
                piece = F.substring(text, x["begin"] + 1, F.element_at(x["own"], -1)["end"] - x["begin"])
                return let(F.struct(x["own"].alias("own"), x["begin"].alias("begin"), piece.alias("piece")), cut)

            return let(F.struct(own.alias("own"), begin.alias("begin")), with_piece)

        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(runs) - 1) / RUN).cast("int")), block)
        rest = F.substring(text, F.element_at(runs, -1)["end"] + 1, F.length(text))
        return F.concat(F.array_join(blocks, ""), rest)

    changed = let(let(F.array_sort(spans), _merged), replaced)
    return F.when(F.size(spans) > 0, changed).when(F.size(spans) == 0, text)
