"""Loading one split of a dataset."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce
from typing import Any
from urllib.parse import unquote

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from rowloom.frame import FILE, PART, Frame, Key
from rowloom.plans.order import count_of, cut, settle, with_rows
from rowloom.sources.files import FileTable
from rowloom.sources.formats import (
    STREAM_OPTIONS,
    decoded,
    files_glob,
    infer_format,
    layouts_of,
    read_batch,
    read_stream,
)
from rowloom.sources.splits import (
    Source,
    SplitPart,
    available_splits,
    parse_split,
    resolve_source,
    resolve_split,
    split_files,
)

#: Files per micro-batch of a streaming load, unless ``maxFilesPerTrigger`` says otherwise.
FILES_PER_BATCH = 1000


def load(
    spark: SparkSession,
    path: str,
    loader: str = "auto",
    split: str = "train",
    config: str = "",
    revision: str = "",
    streaming: bool = False,
    reload_tick: int = 0,
    hub_root: str | None = None,
    **options: Any,
) -> Frame:
    """Load one split as an ordered, lazy :class:`Frame`.

    ``path`` is a file, a glob, a dataset directory, or (with ``hub_root``, the root of a mirror)
    a dataset id ``namespace/name``.  ``loader`` forces a format.  ``split`` may be sliced:
    ``train[:100]``, ``train[10%:20%]``, ``train[:10]+test[-5:]``.  ``config`` and ``revision``
    are directory levels (``root/@revision/config``).  A changed ``reload_tick`` drops what Spark
    remembers about the path.  ``options`` go to the Spark reader; ``schema`` fixes the columns.
    """
    source = resolve_source(path, loader, config or "", revision or "", hub_root)
    if reload_tick:
        spark.catalog.refreshByPath(source.path)
    available = available_splits(spark, source)
    if not available:
        raise ValueError(f"No data files were found in {source.path!r}.")
    parts = parse_split(resolve_split(split, available))
    if streaming:
        if len(parts) > 1 or parts[0].sliced:
            raise ValueError("A streaming load takes a plain split name; use skip and take instead of a slice.")
        return _load_stream(spark, source, parts[0], options)
    frames = [_load_part(spark, source, part, options) for part in parts]
    return frames[0] if len(frames) == 1 else concat(frames)


def _data_paths(spark: SparkSession, source: Source, split: str) -> tuple[str, list[str]]:
    """Format and files of a split of a dataset directory; one reader must do for all of them."""
    rows = split_files(spark, source).filter(F.col("split") == split).select(FILE).orderBy(FILE).toArrow()
    files = rows[FILE].to_pylist()
    formats = sorted({infer_format(file) for file in files})
    if len(formats) > 1:
        raise ValueError(f"The split {split!r} of {source.path!r} mixes formats ({', '.join(formats)}): load them one by one.")
    return formats[0], [decoded(file) for file in files]


def _load_part(spark: SparkSession, source: Source, part: SplitPart, options: dict[str, Any]) -> Frame:
    fmt, paths = (source.fmt, [source.path]) if source.fmt else _data_paths(spark, source, part.name)
    frame = read_batch(spark, fmt, paths, options)
    if not part.sliced:
        return frame
    if frame.kind in ("lines", "decoded"):
        frame = settle(frame)
    low, high = part.bounds(count_of(frame))
    return cut(frame, low, high)


def concat(frames: list[Frame]) -> Frame:
    """Rows of several loaded frames, one after the other."""
    if len({frozenset(f.columns) for f in frames}) > 1:
        raise ValueError("Only datasets with the same columns can follow one another.")
    frames = [settle(f) if f.kind not in ("files", "lines") or PART in f.df.columns else f for f in frames]
    if len({f.kind for f in frames}) > 1:
        frames = [settle(f) if f.kind == "lines" else f for f in frames]
    frames = [with_rows(f) for f in frames]
    marked = [f.df.withColumn(PART, F.lit(i)) for i, f in enumerate(frames)]
    united = reduce(lambda a, b: a.unionByName(b), marked)
    return Frame(united, (Key(PART), *frames[0].order), frames[0].kind)


def _load_stream(spark: SparkSession, source: Source, part: SplitPart, options: dict[str, Any]) -> Frame:
    """Streaming frame with a lazy twin: the same files as an ordinary scan."""
    options = {"maxFilesPerTrigger": FILES_PER_BATCH, **options}
    batch_options = {k: v for k, v in options.items() if k not in STREAM_OPTIONS}
    twin = replace(_load_part(spark, source, part, batch_options), by_file=True)
    schema = twin.unordered_rows().schema
    path, condition = source.path, None
    if source.fmt:
        fmt, files = source.fmt, split_files(spark, source)
        folder, _, name = path.rpartition("/")
        names = [row[FILE] for row in files.limit(2).collect()]
        if len(names) == 1 and unquote(names[0]).endswith("/" + name):
            # Spark streams from folders: watch the one that holds the file
            path, options = folder or ".", {"pathGlobFilter": name, **options}
        paths = [source.path]
    else:
        fmt, paths = _data_paths(spark, source, part.name)
        files = split_files(spark, source).filter(F.col("split") == part.name)
        options = {"recursiveFileLookup": "true", "pathGlobFilter": files_glob(fmt), **options}
        condition = source.holds(part.name)
    layouts = layouts_of(spark, fmt, paths, batch_options)
    if fmt == "json" and any(x.records is not None and not x.records.single for x in layouts):
        raise ValueError("A stream reads one JSON value per line; some lines hold more.")
    kinds = {(x.options.get("multiLine"), x.options.get("sep"), x.header) for x in layouts}
    if len(kinds) > 1:
        raise ValueError("The files of a stream must have one layout: the same header, separator and kind of JSON.")
    options = {**options, **{k: v for k, v in layouts[0].options.items() if k in ("multiLine", "sep")}}
    if fmt == "csv":  # rows that span lines may still arrive
        options["multiLine"] = batch_options.get("multiLine", True)
    stream = read_stream(spark, fmt, path, schema, options)
    if condition is not None:
        stream = replace(stream, df=stream.df.filter(condition))
    return replace(stream, files=FileTable(files.select(FILE)), twin=lambda: twin)
