"""Arrow IPC files as rows: index the record batches, then read runs of batches in parallel.

Both steps are Spark stages over the file list, so one huge file is read by many tasks.  The index takes
row counts from the footer and the headers of messages; the bodies, which hold the values, are read once,
by the task that gives their rows, and only for the columns asked for.
"""

from __future__ import annotations

import struct
from collections.abc import Collection, Iterator
from typing import NamedTuple
from urllib.parse import unquote, urlparse

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema

from rowloom.frame import FILE, ROW

#: Rows that one read task handles at least (unless the file is smaller).
RUN_ROWS = 1 << 16
#: Bytes of files for which one more read task is planned.
TASK_BYTES = 128 << 20

# Fixed values of the Arrow IPC format.
MAGIC = b"ARROW1"
CONTINUATION = 0xFFFFFFFF
DICTIONARY_BATCH, RECORD_BATCH = 2, 3


def _open(uri: str) -> pa.NativeFile:
    """Memory map for mounted paths, else a random-access file of the URI's file system."""
    parsed = urlparse(uri)
    if parsed.scheme in ("", "file"):
        return pa.memory_map(unquote(parsed.path))
    filesystem, path = fs.FileSystem.from_uri(uri)
    return filesystem.open_input_file(path)


# -- headers --------------------------------------------------------------------------------


class _Fields:
    """Fields of one flatbuffer table, by number."""

    def __init__(self, data: bytes, at: int | None = None):
        self.data = data
        self.at = struct.unpack_from("<I", data)[0] if at is None else at
        self.vtable = self.at - struct.unpack_from("<i", data, self.at)[0]

    def _place(self, number: int) -> int | None:
        entry = 4 + 2 * number
        if entry >= struct.unpack_from("<H", self.data, self.vtable)[0]:
            return None
        offset = struct.unpack_from("<H", self.data, self.vtable + entry)[0]
        return self.at + offset if offset else None

    def value(self, number: int, kind: str) -> int:
        """A number; one that is not stored is 0."""
        place = self._place(number)
        return 0 if place is None else struct.unpack_from("<" + kind, self.data, place)[0]

    def _target(self, number: int) -> int | None:
        place = self._place(number)
        return None if place is None else place + struct.unpack_from("<I", self.data, place)[0]

    def table(self, number: int) -> _Fields | None:
        target = self._target(number)
        return None if target is None else _Fields(self.data, target)

    def structs(self, number: int, kind: str) -> list[tuple[int, ...]]:
        target = self._target(number)
        if target is None:
            return []
        count, size = struct.unpack_from("<I", self.data, target)[0], struct.calcsize("<" + kind)
        return [struct.unpack_from("<" + kind, self.data, target + 4 + i * size) for i in range(count)]


class _Message(NamedTuple):
    kind: int
    rows: int
    start: int  # where the message begins
    end: int  # where its body ends


def _message(source: pa.NativeFile, start: int) -> _Message | None:
    """The header of the message at ``start``; its body is not read.  None at the end of a stream."""
    source.seek(start)
    prefix = source.read(4)
    if len(prefix) == 4 and struct.unpack("<I", prefix)[0] == CONTINUATION:
        prefix = source.read(4)  # files of old writers have the size alone
    size = struct.unpack("<i", prefix)[0] if len(prefix) == 4 else 0
    if size == 0:
        return None
    body = source.tell() + size
    data = source.read(size)
    if len(data) < size:
        raise pa.ArrowInvalid("The header of a message ends early.")
    fields = _Fields(data)
    kind, header = fields.value(1, "B"), fields.table(2)
    rows = header.value(0, "q") if header is not None and kind == RECORD_BATCH else 0
    return _Message(kind, rows, start, body + fields.value(3, "q"))


def _is_file(source: pa.NativeFile) -> bool:
    """Whether a source is in the file layout, which has a footer; the other one is a stream of messages."""
    source.seek(0)
    return source.read(len(MAGIC)) == MAGIC


def _footer(source: pa.NativeFile) -> _Fields:
    size = source.size()
    source.seek(size - len(MAGIC) - 4)
    length, magic = struct.unpack(f"<i{len(MAGIC)}s", source.read(len(MAGIC) + 4))
    if magic != MAGIC or not 0 < length < size:
        raise pa.ArrowInvalid("The footer is damaged.")
    source.seek(size - len(MAGIC) - 4 - length)
    return _Fields(source.read(length))


def _batch_headers(source: pa.NativeFile) -> tuple[Iterator[_Message], bool]:
    """Headers of the record batches in order, and whether reading can begin at each of them."""
    if _is_file(source):
        blocks = _footer(source).structs(3, "qi4xq")
        return (_message(source, offset) for offset, _, _ in blocks), True
    found, at, seekable = [], 0, True
    while (message := _message(source, at)) is not None:
        at = message.end
        if message.kind == RECORD_BATCH:
            found.append(message)
        elif message.kind == DICTIONARY_BATCH:
            seekable = False  # later batches need it
    if at > source.size():
        raise pa.ArrowInvalid("The last message ends early.")
    return iter(found), seekable


def _schema(source: pa.NativeFile) -> pa.Schema:
    as_file = _is_file(source)
    source.seek(0)
    return (pa.ipc.open_file(source) if as_file else pa.ipc.open_stream(source)).schema


def _schemas(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for files in frames:
        found = set()
        for uri in files[FILE]:
            with _open(uri) as source:
                found.add(_schema(source).remove_metadata().serialize().to_pybytes())
        yield pd.DataFrame({"schema": list(found)})


def arrow_schema(files: DataFrame) -> T.StructType:
    """All columns of all files; a column of several types has the type that holds them, or it is an error."""
    found = files.select(FILE).repartition(_tasks(files)).mapInPandas(_schemas, "schema binary").distinct().collect()
    schemas = [pa.ipc.read_schema(pa.py_buffer(bytes(r["schema"]))) for r in sorted(found, key=lambda r: bytes(r["schema"]))]
    if not schemas:
        return T.StructType([])
    try:
        return from_arrow_schema(pa.unify_schemas(schemas, promote_options="permissive"))
    except (pa.ArrowInvalid, pa.ArrowTypeError) as error:
        raise ValueError(f"The Arrow files have columns of the same name and different types: {error}") from None


# -- index ----------------------------------------------------------------------------------


def _index(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Runs of record batches: (file, first batch, its place, batches, rows before the run, rows in it).

    A stream with dictionaries can only be read from its start and is one run.
    """
    for files in frames:
        for uri in files[FILE]:
            runs, first, at, start, rows, count = [], 0, 0, 0, 0, 0
            with _open(uri) as source:
                headers, seekable = _batch_headers(source)
                for count, header in enumerate(headers, 1):
                    if count == first + 1:
                        at = header.start
                    rows += header.rows
                    if rows >= RUN_ROWS and seekable:
                        runs.append((uri, first, at, count - first, start, rows))
                        first, start, rows = count, start + rows, 0
            if count > first:
                runs.append((uri, first, at if seekable else 0, count - first, start, rows))
            yield pd.DataFrame(runs, columns=[FILE, "first", "at", "batches", "start", "rows"])


def _runs(files: DataFrame) -> DataFrame:
    if not files.isStreaming:
        files = files.repartition(_tasks(files))
    run = f"{FILE} string, first int, at bigint, batches int, start bigint, rows bigint"
    return files.select(FILE).mapInPandas(_index, run)


def _tasks(df: DataFrame, size: int = 0) -> int:
    """Two tasks a core, and more for large files."""
    return max(df.sparkSession.sparkContext.defaultParallelism * 2, size // TASK_BYTES + 1)


def arrow_counts(files: DataFrame) -> DataFrame:
    """(FILE, rows, bytes) per file."""
    counted = _runs(files).groupBy(FILE).agg(F.sum("rows").alias("rows"))
    return counted.join(files.withColumnRenamed("length", "bytes"), FILE)


# -- rows -----------------------------------------------------------------------------------


def _run_batches(source: pa.NativeFile, run: dict, names: Collection[str]) -> Iterator[pa.RecordBatch]:
    """The batches of one run.  In the file layout the bodies of other columns than ``names`` are not read."""
    if _is_file(source):
        source.seek(0)
        reader = pa.ipc.open_file(source)
        # at least one column tells how many rows there are
        kept = [i for i, n in enumerate(reader.schema.names) if n in names] or [*range(len(reader.schema))][:1]
        if len(kept) < len(reader.schema):
            reader = pa.ipc.open_file(source, options=pa.ipc.IpcReadOptions(included_fields=kept))
        for i in range(run["first"], run["first"] + run["batches"]):
            yield reader.get_batch(i)
        return
    source.seek(0)
    stream = pa.ipc.open_stream(source)
    if not run["at"]:
        yield from stream
        return
    source.seek(run["at"])
    for _ in range(run["batches"]):
        yield pa.ipc.read_record_batch(pa.ipc.read_message(source), stream.schema)


def arrow_rows(files: DataFrame, schema: T.StructType, columns: Collection[str] | None = None, size: int = 0) -> DataFrame:
    """Rows of all ``files`` (``size`` bytes) with FILE and ROW; ``columns`` limits what is read."""
    user = T.StructType([f for f in schema.fields if columns is None or f.name in columns])
    full = T.StructType([*user.fields, T.StructField(FILE, T.StringType()), T.StructField(ROW, T.LongType())])
    target = to_arrow_schema(full)
    names = user.names

    def column(batch: pa.RecordBatch, name: str) -> pa.Array:
        kind = target.field(name).type
        at = batch.schema.get_field_index(name)
        return batch.column(at).cast(kind) if at >= 0 else pa.nulls(batch.num_rows, kind)

    def read(runs: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in runs:
            for run in chunk.to_pylist():
                at = run["start"]
                with _open(run[FILE]) as source:
                    for batch in _run_batches(source, run, names):
                        arrays = [column(batch, n) for n in names]
                        arrays.append(pa.repeat(run[FILE], batch.num_rows))
                        arrays.append(pa.array(range(at, at + batch.num_rows), pa.int64()))
                        at += batch.num_rows
                        yield pa.RecordBatch.from_arrays(arrays, schema=target)

    return _runs(files).repartition(_tasks(files, size), FILE, "first").mapInArrow(read, full)
