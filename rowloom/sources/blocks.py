"""Records of text files that go on over lines and blocks, cut by many tasks.

Where a record of JSON or quoted CSV ends depends on all text before it: a quote may be open, a bracket may
not be closed.  So files are read twice, block by block as Spark splits them:

1. ``scan``: a task does not know the state in which its block starts, so it follows every one of the few that there
   are.  What is left of a block is a function from states to states, with the change of depth.  These
   functions compose; the driver follows them through the blocks of each file (one small row per block, like
   Spark's own list of splits), which gives the state at the start of every block.
2. ``cut``: with that, each task cuts its blocks into records.  A record that goes on in later blocks leaves one
   piece in each of them, under the block in which it began; only those pieces are shuffled.

A *machine* knows the text.  It reads pieces of text in file order: lines, or what stands between
closing braces, so that a file of one line is split like any other.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.frame import BLOCK, FILE
from rowloom.plans.staging import staging_path

SIZE = "size"
#: Kinds of rows that a cut gives: whole records, pieces of records, and what is wrong with a file.
WHOLE, PIECE, WRONG = 0, 1, 2
RECORDS = f"{FILE} string, {BLOCK} long, place long, kind int, part long, text binary, fields long"


# -- machines --------------------------------------------------------------------------------


@dataclass(frozen=True)
class QuotedLines:
    """Lines of CSV; a state tells whether a quoted field is open."""

    separator: str = ","
    quote: str = '"'
    escape: str = '"'

    states = (0, 1)
    base = 0
    line_separator = None
    by_pieces = False

    def patterns(self) -> tuple[bytes, bytes, re.Pattern]:
        q, e = re.escape(self.quote.encode()), re.escape(self.escape.encode())
        inside = b"[^%s]*(?:%s%s[^%s]*)*" % (q, q, q, q) if q == e else b"[^%s%s]*(?:%s(?:.|$)[^%s%s]*)*" % (q, e, e, q, e)
        return self.quote.encode(), self.separator.encode(), re.compile(inside, re.DOTALL)

    def line(self, line: bytes, inside: int, patterns) -> tuple[int, int]:
        """Whether a quoted field is open behind ``line``, and the separators in it."""
        quote, separator, within = patterns
        if quote not in line:
            return inside, 0 if inside else line.count(separator)
        at, fields = 0, 0
        while True:
            if not inside and line.startswith(quote, at):
                inside, at = 1, at + len(quote)
            if inside:
                at = within.match(line, at).end()
                if at >= len(line):
                    return 1, fields
                inside, at = 0, at + len(quote)
            at = line.find(separator, at)
            if at < 0:
                return 0, fields
            fields, at = fields + 1, at + len(separator)

    def scan(self, values: list[bytes], state: int) -> tuple[int, int, int]:
        patterns, inside, low = self.patterns(), state, 0
        for value in values:
            inside, _ = self.line(value, inside, patterns)
            low = min(low, inside - state)
        return inside, inside - state, low

    def cutter(self, state: int, depth: int, **_: Any) -> LineCutter:
        return LineCutter(self, state)


class LineCutter:
    """Joins lines while a quoted field is open."""

    def __init__(self, machine: QuotedLines, inside: int):
        self.machine, self.inside, self.patterns = machine, inside, machine.patterns()
        self.open: list[bytes] = []
        self.fields = 0

    def feed(self, values: list[bytes]) -> Iterator[tuple[bytes, int]]:
        for value in values:
            begun = bool(self.inside)
            self.inside, fields = self.machine.line(value, self.inside, self.patterns)
            if not begun and not self.inside:
                if value.strip():
                    yield value, fields
                continue
            self.open.append(value)
            self.fields += fields
            if not self.inside:
                yield b"\n".join(self.open), self.fields
                self.open, self.fields = [], 0

    def finish(self) -> Iterator[tuple[bytes, int]]:
        return iter(())

    def rest(self) -> tuple[bytes, int] | None:
        """What is open at the end of the block, line end included."""
        return (b"\n".join([*self.open, b""]), self.fields) if self.inside else None


@dataclass(frozen=True)
class JsonText:
    """JSON between closing braces; a state is the open quote (0 for none) and whether the next character is escaped.

    Depth counts open brackets of both kinds.  Records are the values at depth ``base``: 0 for values that follow each
    other, 1 for the entries of an array.  ``simple`` looks at double quotes only, all at once, and
    ends in the state ``None`` where it meets another quote outside of strings.
    """

    simple: bool = True

    line_separator = "}"
    by_pieces = True

    @property
    def states(self) -> tuple:
        return tuple((q, e) for q in ((0, 34) if self.simple else (0, 34, 39)) for e in (0, 1))

    def brackets(self, data: bytes, state) -> tuple[np.ndarray, np.ndarray, Any]:
        """Places of brackets outside of strings, +1 or -1 for each, and the state behind the text."""
        if state is None:
            return np.empty(0, np.int64), np.empty(0, np.int64), None
        return (self._at_once if self.simple else self._one_by_one)(data, state)

    @staticmethod
    def _at_once(data: bytes, state: tuple[int, int]) -> tuple[np.ndarray, np.ndarray, Any]:
        codes = np.frombuffer(data, np.uint8)
        n = len(codes)
        slashes = np.flatnonzero(codes == 92)
        escaped = np.zeros(n + 1, bool)
        escaped[0] = bool(state[1])
        if len(slashes):
            first = np.concatenate(([True], np.diff(slashes) != 1))
            runs = slashes[first]
            lengths = np.diff(np.append(np.flatnonzero(first), len(slashes)))
            lengths = lengths - (state[1] and runs == 0)  # an escaped backslash escapes nothing
            escaped[(runs + np.diff(np.append(np.flatnonzero(first), len(slashes))))[lengths % 2 == 1]] = True
        quotes = (codes == 34) & ~escaped[:n]
        inside = ((np.cumsum(quotes) + (state[0] == 34)) & 1).astype(bool)
        end = (34 if (inside[-1] if n else state[0] == 34) else 0, int(escaped[n]))
        if np.any((codes == 39) & ~inside):
            return np.empty(0, np.int64), np.empty(0, np.int64), None
        opening = (codes == 123) | (codes == 91)
        places = np.flatnonzero((opening | (codes == 125) | (codes == 93)) & ~inside & ~escaped[:n])
        return places, np.where(opening[places], 1, -1), end

    @staticmethod
    def _one_by_one(data: bytes, state: tuple[int, int]) -> tuple[np.ndarray, np.ndarray, Any]:
        quote, escaped = state
        places, steps = [], []
        for found in re.finditer(rb"[\"'{}\[\]]|\\", data):
            at, code = found.start(), data[found.start()]
            if escaped == at + 1:
                escaped = 0
                continue
            escaped = 0
            if code == 92:
                escaped = at + 2
            elif quote:
                quote = 0 if code == quote else quote
            elif code in (34, 39):
                quote = code
            else:
                places.append(at)
                steps.append(1 if code in (123, 91) else -1)
        return np.array(places, np.int64), np.array(steps, np.int64), (quote, int(escaped == len(data) + 1))

    def scan(self, values: list[bytes], state) -> tuple[Any, int, int]:
        _, steps, end = self.brackets(b"}".join([*values, b""]), state)
        depth = np.cumsum(steps)
        return end, int(depth[-1]) if len(depth) else 0, int(depth.min(initial=0))

    def cutter(self, state, depth: int, base: int, single: bool, begun: bool, ended: bool) -> JsonCutter:
        return JsonCutter(self, state, depth, base, single, begun, ended)


class JsonCutter:
    """Cuts values out of the text between them.

    ``single``: the file is one value, so nothing may follow it.  ``begun``: an earlier block held text.
    ``ended``: the last piece of the file is not followed by a brace.
    """

    def __init__(self, machine: JsonText, state, depth: int, base: int, single: bool, begun: bool, ended: bool):
        self.machine, self.state, self.depth, self.base, self.single = machine, state, depth, base, single
        self.closed = begun and depth == 0  # the one value is over
        self.ended = ended
        self.open: list[bytes] = []
        self.held: bytes | None = None

    def feed(self, values: list[bytes]) -> Iterator[tuple[bytes, int]]:
        # the last piece waits: it may be the one without a brace
        values = values if self.held is None else [self.held, *values]
        self.held = values[-1] if values else None
        if len(values) > 1:
            yield from self._cut(b"}".join([*values[:-1], b""]))

    def _between(self, text: bytes, level: int) -> None:
        text = text.strip(b" \t\r\n\xef\xbb\xbf\x1e")
        if text.strip(b", \t\r\n") if level or not self.single else text:
            what = "An entry of the array is not an object" if level else "More follows the first JSON value"
            raise ValueError(f"{what}: {text[:40].decode(errors='replace')!r}")

    def _cut(self, data: bytes) -> Iterator[tuple[bytes, int]]:
        places, steps, self.state = self.machine.brackets(data, self.state)
        depth = self.depth + np.cumsum(steps)
        base, at = self.base, 0
        # all that matters: brackets that open or close at the levels of records and above
        chosen = np.flatnonzero(np.where(steps > 0, depth, depth + 1) <= base + 1)
        for i in chosen:
            place, step, level = int(places[i]), int(steps[i]), int(depth[i])
            if step < 0 and level == base:  # a record closes
                self.open.append(data[at : place + 1])
                yield b"".join(self.open), 0
                self.open, at = [], place + 1
                self.closed = base == 0
                continue
            self._between(data[at:place], min(level - step, base))
            if level < 0 or self.closed and self.single or level == base + 1 and base == 0 and data[place] != 123:
                raise ValueError(f"More follows the first JSON value: {data[place : place + 40].decode(errors='replace')!r}")
            at = place if level == base + 1 else place + 1
            self.closed = self.closed or level == 0
        self.depth = int(depth[-1]) if len(depth) else self.depth
        if self.depth > base:
            self.open.append(data[at:])
        else:
            self._between(data[at:], self.depth)

    def finish(self) -> Iterator[tuple[bytes, int]]:
        """Records of the piece that waited."""
        if self.held is not None:
            yield from self._cut(self.held if self.ended else self.held + b"}")

    def rest(self) -> tuple[bytes, int] | None:
        """What is open at the end of the block."""
        return (b"".join(self.open), 0) if self.open else None


# -- first pass ------------------------------------------------------------------------------


def pieces(spark: SparkSession, machine, files: list[str]) -> DataFrame:
    """(value, FILE, BLOCK, SIZE): what the machine reads, as bytes, in file order inside each block."""
    reader = spark.read.option("lineSep", machine.line_separator) if machine.line_separator else spark.read
    names = ("file_path", FILE), ("file_block_start", BLOCK), ("file_size", SIZE)
    origin = [F.col(f"_metadata.{name}").alias(alias) for name, alias in names]
    return reader.text(files).select(F.col("value").cast("binary").alias("value"), *origin)


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int, int], list[bytes]]]:
    """((file, block, size of the file), its next pieces); a block may take several batches, a batch may hold several blocks."""
    for batch in batches:
        coded = batch.column(FILE).dictionary_encode()
        file, start = coded.indices.to_numpy(), batch.column(BLOCK).to_numpy()
        edges = np.flatnonzero((file[1:] != file[:-1]) | (start[1:] != start[:-1])) + 1
        for a, b in zip([0, *edges], [*edges, batch.num_rows], strict=True):
            if b > a:
                key = coded.dictionary[int(file[a])].as_py(), int(start[a]), batch.column(SIZE)[int(a)].as_py()
                yield key, batch.column("value").slice(int(a), int(b - a)).to_pylist()


def _summaries(machine):
    states = machine.states

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row() -> pa.RecordBatch:
            ends = [states.index(e) if e is not None else None for e, _, _ in follow]
            found = {FILE: [key[0]], BLOCK: [key[1]], "ends": [ends], "deltas": [[d for _, d, _ in follow]], "lows": [[x for *_, x in follow]], "head": [head], "bytes": [read], SIZE: [key[2]]}
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(found.values(), kinds, strict=True)], list(found))

        kinds = [pa.string(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.string(), pa.int64(), pa.int64()]
        key, follow, head, read = None, [], "", 0
        for block, values in _by_block(batches):
            if block != key:
                if key is not None:
                    yield row()
                key, head, read = block, "", 0
                follow = [(s, 0, 0) for s in states]
            read += sum(map(len, values)) + len(values)
            if not head and machine.by_pieces:
                for i, value in enumerate(values):
                    if text := value.strip(b" \t\r\n\xef\xbb\xbf\x1e"):
                        head = chr(text[0])
                    elif i < len(values) - 1:
                        head = "}"
                    if head:
                        break
            step = {s: machine.scan(values, s) if s is not None else (None, 0, 0) for s in {s for s, _, _ in follow}}
            follow = [(step[s][0], d + step[s][1], min(x, d + step[s][2])) for s, d, x in follow]
        if key is not None:
            yield row()

    return run


@dataclass(frozen=True)
class Start:
    """How a block starts, and the block in which the record that is open there began."""

    state: Any
    depth: int
    owner: int | None
    begun: bool
    last: bool


@dataclass
class Scanned:
    """Starts of all blocks of a file, and how the file ends."""

    starts: dict[int, Start]
    base: int
    depth: int
    state: Any
    #: The last piece is followed by the end of the file, not by a separator.
    ended: bool

    @property
    def unclosed(self) -> bool:
        """A record is open at the end."""
        return self.depth > 0 or self.state not in (0, (0, 0), (0, 1))


def scan(spark: SparkSession, machine, files: list[str]) -> tuple[Any, dict[str, Scanned]]:
    """The machine that understands all files, and every file's blocks."""
    kinds = f"{FILE} string, {BLOCK} long, ends array<int>, deltas array<long>, lows array<long>, head string, bytes long, {SIZE} long"
    rows = pieces(spark, machine, files).mapInArrow(_summaries(machine), kinds).toArrow().sort_by([(FILE, "ascending"), (BLOCK, "ascending")])
    by_file: dict[str, list[dict]] = {}
    for row in rows.to_pylist():
        by_file.setdefault(row[FILE], []).append(row)
    out = {}
    for file, blocks in by_file.items():
        head = next((b["head"] for b in blocks if b["head"]), "")
        base = 1 if machine.by_pieces and head == "[" else 0
        at, depth, owner, starts, begun = 0, 0, None, {}, False
        for block in blocks:
            start = machine.states[at]
            starts[block[BLOCK]] = Start(start, depth, owner, begun, block is blocks[-1])
            if block["ends"][at] is None:
                return scan(spark, JsonText(simple=False), files)
            if depth + block["lows"][at] <= base:
                owner = block[BLOCK]  # whatever is open behind this block began in it
            owner = block[BLOCK] if owner is None else owner
            begun = begun or bool(block["head"])
            at, depth = block["ends"][at], depth + block["deltas"][at]
        state, ended = machine.states[at], False
        if machine.by_pieces:
            # every piece was read with a brace behind it; the sizes tell about the last one (a mark of byte order is not read)
            over = sum(b["bytes"] for b in blocks) - blocks[0][SIZE]
            ended = over in (1, -2) if -3 <= over <= 1 else depth < 0
            depth += ended and state[0] == 0
        out[file] = Scanned(starts, base, depth, state, ended)
    return machine, out


# -- second pass -----------------------------------------------------------------------------


def _records(machine, shared, single: bool):
    """Pieces -> rows of ``RECORDS``; ``place`` is larger than that of all records before it in the file."""
    kinds = pa.schema([(FILE, pa.string()), (BLOCK, pa.int64()), ("place", pa.int64()), ("kind", pa.int32()), ("part", pa.int64()), ("text", pa.binary()), ("fields", pa.int64())])

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kinds, strict=True)], schema=kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanned = shared.value
        rows: list[tuple] = []
        key, cutter, start, place, fresh, wrong, opened = None, None, None, 0, True, False, False

        def take(found: Iterator[tuple[bytes, int]]) -> None:
            """Records of the block that is open; the first one may be the end of a piece."""
            nonlocal place, fresh, wrong
            try:
                for text, fields in found:
                    if fresh and opened:
                        rows.append((key[0], start.owner, -1, PIECE, key[1], text, fields))
                    else:
                        rows.append((key[0], key[1], key[1] + place, WHOLE, 0, text, fields))
                        place += 1
                    fresh = False
            except ValueError as error:
                wrong = True
                rows.append((key[0], key[1], 0, WRONG, 0, str(error).encode(), 0))

        def close() -> None:
            """The end of a block: the last piece, and what goes on in the next block."""
            if not wrong:
                take(cutter.finish())
            tail = cutter.rest()
            if not wrong and tail is not None:
                inner = fresh and opened
                rows.append((key[0], start.owner if inner else key[1], -1 if inner else key[1] + place, PIECE, key[1], *tail))

        for block, values in _by_block(batches):
            if block != key:
                if key is not None:
                    close()
                file = scanned[block[0]]
                key, start, place, fresh, wrong = block, file.starts[block[1]], 0, True, False
                ended = start.last and file.ended
                cutter = machine.cutter(start.state, start.depth, base=file.base, single=single or file.base == 1, begun=start.begun, ended=ended)
                opened = start.depth > file.base
            if not wrong:
                take(cutter.feed(values))
            if len(rows) > 5000:
                yield batch_of(rows)
                rows.clear()
        if key is not None:
            close()
        yield batch_of(rows)

    return run


def cut(spark: SparkSession, machine, files: list[str], scanned: dict[str, Scanned], single: bool = False) -> DataFrame:
    """(FILE, BLOCK, text, fields) of all records, written once; BLOCK orders the records of a file.

    ``fields`` counts separators.  ``single``: a file is one record, or one array of them.  Text that belongs
    to no record is an error.
    """
    shared = spark.sparkContext.broadcast(scanned)
    path = staging_path(spark, "records")
    pieces(spark, machine, files).mapInArrow(_records(machine, shared, single), RECORDS).write.parquet(path)
    rows = spark.read.schema(RECORDS).parquet(path)
    wrong = rows.where(F.col("kind") == WRONG).orderBy(FILE, BLOCK).first()
    if wrong is not None:
        raise ValueError(f"{bytes(wrong['text']).decode(errors='replace')} in {wrong[FILE]}")
    whole = rows.where(F.col("kind") == WHOLE).select(FILE, F.col("place").alias(BLOCK), "text", "fields")
    part = F.struct("part", "text")
    joined = rows.where(F.col("kind") == PIECE).groupBy(FILE, BLOCK).agg(
        F.max("place").alias("place"), F.array_sort(F.collect_list(part)).alias("parts"), F.sum("fields").alias("fields")
    )
    text = F.array_join(F.transform("parts", lambda p: p["text"].cast("string")), "")
    text = F.when(F.size("parts") == 1, F.element_at("parts", 1)["text"].cast("string")).otherwise(text)
    joined = joined.select(FILE, F.col("place").alias(BLOCK), text.alias("text"), "fields")
    return whole.withColumn("text", F.col("text").cast("string")).unionByName(joined)
