"""One reader per file format, batch or streaming, giving user columns plus order columns."""

from __future__ import annotations

import csv
import posixpath
import re
from dataclasses import dataclass, field
from functools import reduce
from typing import Any
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.frame import BLOCK, FILE, LINE, ROW, Frame, Key, Reread, quoted
from rowloom.plans.order import scan_frame
from rowloom.plans.staging import staging_path
from rowloom.sources.arrow_ipc import arrow_counts, arrow_rows, arrow_schema
from rowloom.sources.blocks import JsonText, QuotedLines, Scanned, cut, scan
from rowloom.sources.files import FileTable

# The loaders a user may name.
FORMATS = ("arrow", "csv", "image", "json", "parquet", "text")
LOADERS = ("auto", "hub", *FORMATS)

# File extension to format, extensions of images, and the compressions that may follow a format.
EXTENSIONS = {
    ".arrow": "arrow",
    ".csv": "csv",
    ".tsv": "csv",
    ".json": "json",
    ".jsonl": "json",
    ".ndjson": "json",
    ".parquet": "parquet",
    ".txt": "text",
}
IMAGE_EXTENSIONS = "avif|bmp|dib|gif|heic|heif|jfif|jp2|jpe|jpeg|jpg|jxl|png|tif|tiff|webp"
COMPRESSIONS = (".gz", ".bz2", ".zst", ".xz")

#: Bytes of a JSON file's only line beyond which an array in it is cut by blocks.
LONG_LINE = 64 << 20
#: Different layouts (headers, separators, line or document files) that one load puts together.
MOST_LAYOUTS = 64
#: Reader options that only a streaming read takes.
STREAM_OPTIONS = ("maxFilesPerTrigger", "pathGlobFilter", "recursiveFileLookup")

#: Options of a JSON source that do not change how a value is parsed.
NOT_PARSED = ("schema", "columns", "multiLine", "lineSep", "encoding", "charset", "singleVariantColumn", *STREAM_OPTIONS)

#: Options under which a format is left to Spark's reader altogether: records are not cut here, nor fields counted.
READER_ONLY = {
    "csv": {"comment", "lineSep", "encoding", "charset", "multiLine", "mode", "ignoreLeadingWhiteSpace"},
    "json": {"lineSep", "encoding", "charset", "allowComments", "mode"},
}

LINE_ORDER = (Key(FILE), Key(BLOCK), Key(LINE))


def extension_of(path: str) -> str:
    """Lower-case format extension of a path, glob or URL ('' when there is none)."""
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]*://", path):
        path = path.split("?", 1)[0].split("#", 1)[0]
    stem, extension = posixpath.splitext(path)
    if extension.lower() in COMPRESSIONS:
        extension = posixpath.splitext(stem)[1]
    return extension.lower()


def infer_format(path: str) -> str | None:
    return EXTENSIONS.get(extension_of(path))


def files_glob(fmt: str) -> str:
    """Hadoop glob of the file names of a format, in any case."""
    ends = [e for e, f in EXTENSIONS.items() if f == fmt]
    names = [e + c for e in ends for c in ("", *COMPRESSIONS)]
    return "{" + ",".join("*" + "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in n) for n in names) + "}"


def decoded(uri: str) -> str:
    """Path to load a listed file by: Spark lists files as escaped URIs and loads plain globs."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", unquote(uri))


def list_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(FILE, length) of the data files under ``paths``; file contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    listed = reader.load(paths).select(F.col("_metadata.file_path").alias(FILE), "length")
    # a task per 128 MB of content would be far too many for reading names
    return listed.coalesce(spark.sparkContext.defaultParallelism * 2)


def read_batch(spark: SparkSession, fmt: str, paths: list[str], options: dict[str, Any]) -> Frame:
    """Loaded frame over ``paths`` (files, globs or directories of one format).

    Files are matched by column names: columns that a file lacks are null in its rows.
    """
    options = dict(options)
    if fmt == "parquet":
        merged = {} if "schema" in options else {"mergeSchema": True}
        return scan_frame(_configured(spark.read, fmt, {**merged, **options}).load(paths))
    if fmt == "arrow":
        return _read_arrow(spark, paths, options)
    if fmt == "image":  # a row per file, decoded by Spark's reader
        files = _decodable(spark.read.format("image").options(**options).load(paths))
        return Frame(files.select("image", F.col("_metadata.file_path").alias(FILE)), (Key(FILE),), "decoded")
    df = _united(spark, fmt, layouts_of(spark, fmt, paths, options), options)
    return Frame(_text_columns(df, fmt), LINE_ORDER, "lines", files=FileTable(list_files(spark, paths).select(FILE)))


def _decodable(files: DataFrame) -> DataFrame:
    """Image files that Spark's reader decodes; one that it does not is an error, other kinds of files are left out."""
    path = F.col("_metadata.file_path")
    named = F.lower(path).rlike(rf"\.(?:{IMAGE_EXTENSIONS})$")
    failed = F.raise_error(F.concat(F.lit("Could not decode the image file "), path)).cast("boolean")
    return files.where(F.when(F.col("image.height") >= 0, True).when(named, failed).otherwise(False))


def _read_arrow(spark: SparkSession, paths: list[str], options: dict[str, Any]) -> Frame:
    files = list_files(spark, paths)
    schema = options.get("schema") or arrow_schema(files)

    size = files.agg(F.sum("length")).first()[0] or 0
    limit = options.get("columns")

    def read(ranges: tuple[tuple[str | None, str | None], ...], columns: frozenset[str] | None) -> DataFrame:
        wanted = F.lit(False)
        for first, last in ranges:
            inside = F.lit(True) if first is None else F.col(FILE) >= first
            wanted = wanted | (inside if last is None else inside & (F.col(FILE) <= last))
        return arrow_rows(files.filter(wanted), schema, limit if columns is None else columns, size)

    reread = Reread(read)
    return Frame(reread.rows(), (Key(FILE), Key(ROW)), "files", files=FileTable(arrow_counts(files)), whole=True, reread=reread)


def read_stream(spark: SparkSession, fmt: str, path: str, schema: T.StructType, options: dict[str, Any]) -> Frame:
    """Streaming frame; ``path`` is a directory or glob."""
    options = {k: v for k, v in options.items() if k != "schema"}
    stream = spark.readStream
    for name in STREAM_OPTIONS:
        if name in options:
            stream = stream.option(name, options.pop(name))
    if fmt == "arrow":
        listing = spark.read.format("binaryFile").load(path).schema
        files = stream.format("binaryFile").schema(listing).load(path)
        files = files.select(F.col("_metadata.file_path").alias(FILE), "length")
        rows = arrow_rows(files, schema, options.get("columns"))
        return Frame(rows, (Key(FILE), Key(ROW)), "files", bounded=False, by_file=True)
    reader = _configured(stream, fmt, options)
    df = reader.load(path) if fmt == "text" else reader.schema(schema).load(path)
    if fmt == "parquet":
        marked = df.select("*", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.row_index").alias(ROW))
        return Frame(marked, (Key(FILE), Key(ROW)), "files", bounded=False, by_file=True)
    return Frame(_text_columns(df, fmt), LINE_ORDER, "lines", bounded=False, by_file=True)


def _text_columns(df: DataFrame, fmt: str) -> DataFrame:
    user = [F.col("value").alias("text")] if fmt == "text" else [quoted(c) for c in df.columns if c not in (FILE, BLOCK)]
    if FILE in df.columns:
        return df.select(*user, FILE, BLOCK)
    return df.select(*user, *_origin())


def _origin() -> list[Column]:
    return [F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK)]


def _configured(reader: Any, fmt: str, options: dict[str, Any]) -> Any:
    """Reader with the defaults of a format; ``options`` (and ``schema``) override them."""
    defaults: dict[str, Any] = {}
    if fmt == "csv":
        defaults = {"header": True, "escape": '"', "multiLine": True}
        if "schema" not in options:
            defaults["inferSchema"] = True
    schema = options.get("schema")
    given = {k: v for k, v in options.items() if k not in ("schema", "columns")}
    reader = reader.format(fmt).options(**{**defaults, **given})
    return reader.schema(schema) if schema is not None else reader


# -- layouts of text formats ----------------------------------------------------------------


@dataclass(frozen=True)
class Records:
    """Records that go on over lines: how to cut them out of the files, block by block."""

    machine: Any
    scanned: dict[str, Scanned] = field(hash=False)
    single: bool = False


@dataclass(frozen=True)
class Layout:
    """Files of a text format that one reader takes together."""

    files: list[str]
    options: dict[str, Any]
    header: str | None = None
    records: Records | None = None


def layouts_of(spark: SparkSession, fmt: str, paths: list[str], options: dict[str, Any]) -> list[Layout]:
    """How the files have to be read, found out file by file in one pass over the lines.

    CSV: separator (by extension), header line, and whether rows go on over several lines.  JSON: a row per
    line, several in a line, or one document.  ``multiLine=`` answers the last question beforehand; a
    JSON source is then not looked at.  A CSV row with more fields than the header is an error.
    """
    if fmt not in ("csv", "json") or fmt == "json" and "multiLine" in options:
        return [Layout(paths, options)]
    lines = spark.read.options(**{k: options[k] for k in ("lineSep",) if k in options}).text(paths)
    lines = lines.select("value", *_origin()).withColumn(LINE, F.monotonically_increasing_id())
    lines = lines.withColumn("blank", F.length(F.trim("value")) == 0)
    tabs = all(extension_of(path) == ".tsv" for path in paths)  # a folder may be named so, and not its files
    own = READER_ONLY[fmt].isdisjoint(options)
    rows = _json_layouts(spark, lines, options, own) if fmt == "json" else _csv_layouts(lines, options, own, tabs)
    found: dict[tuple, list[dict[str, Any]]] = {}
    for row in rows:
        key = (row["multiLine"], row.get("separator"), row.get("header"), row.get("single"))
        found.setdefault(key, []).append(row)
    if len(found) > MOST_LAYOUTS:
        raise ValueError(f"The files have {len(found)} different headers or layouts; load them in parts.")
    out = []
    for (multi, separator, header, single), group in found.items():
        given = {"multiLine": multi, **({"sep": separator} if separator and "delimiter" not in options else {}), **options}
        files = paths if len(found) == 1 else [decoded(row[FILE]) for row in group]
        records = None
        if single is not None:
            machine = next((r["machine"] for r in group if "machine" in r), None)
            if machine is None:
                machine, scanned = scan(spark, *(_quoted_lines(given), files) if fmt == "csv" else (JsonText(), files))
            else:
                scanned = {r[FILE]: r["scanned"] for r in group}
            for file, state in scanned.items():
                if fmt == "json" and state.unclosed:
                    raise ValueError(f"A JSON value does not end in {file}; multiLine= tells how to read it.")
            records = Records(machine, scanned, single)
        out.append(Layout(files, given, header, records))
    return out or [Layout(paths, {"multiLine": False, **options})]


def _quoted_lines(options: dict[str, Any]) -> QuotedLines:
    quote = str(options.get("quote", '"'))
    return QuotedLines(str(options.get("sep", options.get("delimiter", ","))), quote, str(options.get("escape", '"')) or quote)


def _csv_layouts(lines: DataFrame, options: dict[str, Any], own: bool, tabs: bool) -> list[dict[str, Any]]:
    """FILE, separator, header and multiLine of every CSV file that has a line; ``single`` if its rows are cut here."""
    given = options.get("sep", options.get("delimiter"))
    by_name = F.when(F.lower(FILE).rlike(rf"\.tsv(?:{'|'.join(map(re.escape, COMPRESSIONS))})?$") | F.lit(tabs), "\t").otherwise(",")
    separator = F.lit(given) if given is not None else by_name
    quote = options.get("quote", '"')
    text = F.col("value")
    if quote:
        text = F.when(text.contains(quote), F.regexp_replace(_without_escaped(options), f"{re.escape(quote)}[^{re.escape(quote)}]*{re.escape(quote)}", "")).otherwise(text)
    text = F.call_function("rtrim", separator, text)  # empty fields at the end lose nothing
    fields = ((F.length(text) - F.length(F.replace(text, separator, F.lit("")))) / F.length(separator) + 1).cast("int")
    first = F.min_by(F.when(~F.col("blank"), F.col("value")), F.struct("blank", BLOCK, LINE)).alias("first")
    wide = lines.withColumn("fields", fields)
    files = wide.groupBy(FILE).agg(first, F.max(_open_quotes(options)).alias("multiLine"), F.max("fields").alias("widest"))
    out = []
    for row in files.orderBy(FILE).toArrow().to_pylist():  # one row per file, like Spark's own listing
        if row["first"] is None:
            continue  # nothing in it
        tab = tabs or extension_of(row[FILE]) == ".tsv"
        found = {FILE: row[FILE], "separator": "\t" if tab else ",", "multiLine": row["multiLine"]}
        headed = str(options.get("header", True)).lower() == "true"
        found["header"] = row["first"] if headed else None
        if row["multiLine"] and own and quote:
            found["single"] = False
        elif own:
            width = _width(row["first"], given or found["separator"], options)
            if row["widest"] > width:
                far = wide.where((F.col(FILE) == row[FILE]) & (F.col("fields") > width)).orderBy(BLOCK, LINE).first()
                earlier = (F.col(BLOCK) < far[BLOCK]) | (F.col(BLOCK) == far[BLOCK]) & (F.col(LINE) < far[LINE])
                before = lines.where((F.col(FILE) == row[FILE]) & ~F.col("blank") & earlier)
                raise ValueError(_too_wide(row[FILE], before.count() + (0 if headed else 1), far["fields"], width))
        out.append(found)
    return out


def _too_wide(file: str, row: int, fields: int, width: int) -> str:
    return f"Row {row} of {file} has {fields} fields where {width} are expected; mode= tells Spark's reader what to do with such rows."


def _width(header: str, separator: str, options: dict[str, Any]) -> int:
    """Fields of a row: those of the first one, or of a given schema if it has more."""
    schema = options.get("schema")
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return max(len(_names(header, separator, options)), len(schema.fields) if schema is not None else 0)


def _names(header: str, separator: str, options: dict[str, Any]) -> list[str]:
    if len(separator) > 1:
        return header.split(separator)
    return next(csv.reader([header], delimiter=separator, quotechar=options.get("quote") or '"'), [])


def _json_layouts(spark: SparkSession, lines: DataFrame, options: dict[str, Any], own: bool) -> list[dict[str, Any]]:
    """FILE and multiLine of every JSON file, decided by Spark's parser under the reader's options.

    A file whose first line is a record has a row per line.  So has one in which most lines are whole
    records: in a document no two of them follow each other.  If a line holds more than its record, values are
    cut out of the text.  Any other file is one document if its brackets close, else damaged lines if
    some line is a record.  More text behind a document is an error.
    """
    given = {k: str(v).lower() if isinstance(v, bool) else str(v) for k, v in options.items() if k not in NOT_PARSED}
    given["mode"] = "PERMISSIVE"

    def record(text: Column) -> Column:
        return F.from_json(text, "array<struct<`\x01`:string>>", given).isNotNull()

    def size(text: Column, kind: str) -> Column:
        return F.size(F.from_json(text, kind, given))

    # between brackets one value is one entry; text that closes one kind of bracket does not close the other
    alone = F.rtrim(F.col("value"), F.lit(", \t\r"))
    single = size(F.concat(F.lit("["), alone, F.lit("]")), "array<string>") == 1
    single &= size(F.concat(F.lit('{"x":'), alone, F.lit("}")), "map<string,string>") == 1
    # only an object with something behind a closing brace can be more than one value
    behind = F.ltrim("value").startswith("{") & F.col("value").rlike(r"\}\s*(?:[^\s,}\]]|,\s*\{)")
    # flags are exchanged, not lines, which may be whole documents
    flags = lines.where("NOT blank").withColumn("record", record(F.col("value")))
    more = F.when(behind, F.col("record") & ~F.coalesce(single, F.lit(False))).otherwise(False)
    array = F.when(F.ltrim("value").startswith("["), F.octet_length("value"))
    files = flags.groupBy(FILE).agg(
        F.min_by("record", F.struct(BLOCK, LINE)).alias("record"), F.max(more).alias("more"), F.count("*").alias("n"), F.max(array).alias("array")
    )
    rows = files.orderBy(FILE).toArrow().to_pylist()
    found = {}
    for row in rows:
        found[row[FILE]] = {FILE: row[FILE], "multiLine": False}
        long_array = row["n"] == 1 and (row["array"] or 0) > LONG_LINE
        if own and row["record"] and (row["more"] or long_array):
            found[row[FILE]]["single"] = long_array
    unsure = [row[FILE] for row in rows if not row["record"]]
    if unsure:
        whole = record(F.col("value")) & F.trim("value").rlike("[}\\]]$")
        counts = lines.where("NOT blank").where(F.col(FILE).isin(unsure)).groupBy(FILE)
        counts = counts.agg(F.count_if(whole).alias("records"), F.count("*").alias("n")).toArrow().to_pylist()
        records = {row[FILE]: row["records"] for row in counts if 2 * row["records"] <= row["n"]}
        machine, scanned = scan(spark, JsonText(), [decoded(f) for f in sorted(records)]) if records else (None, {})
        for file, state in scanned.items():
            if not state.unclosed:
                found[file] = {FILE: file, "multiLine": True}
                if own:
                    found[file] |= {"single": True, "machine": machine, "scanned": state}
            elif not records[file]:
                raise ValueError(f"A JSON value does not end in {file}; multiLine= tells how to read it.")
    return [found[file] for file in sorted(found)]


def _open_quotes(options: dict[str, Any]) -> Column:
    """Whether a line leaves a quote open, so that its row goes on in the next line."""
    quote = options.get("quote", '"')
    if not quote:
        return F.lit(False)
    value = _without_escaped(options)
    return (F.length(value) - F.length(F.replace(value, F.lit(quote), F.lit("")))) % 2 == 1


def _without_escaped(options: dict[str, Any]) -> Column:
    """A line without escaped quotes, unless quotes escape themselves."""
    quote, escape = options.get("quote", '"'), options.get("escape", '"')
    return F.replace("value", F.lit(escape + quote), F.lit("")) if escape and escape != quote else F.col("value")


# -- records cut out of blocks ----------------------------------------------------------------


def _inferred(spark: SparkSession, fmt: str, text: DataFrame, options: dict[str, Any]) -> T.StructType:
    """Schema that Spark's reader finds in records, one per line."""
    path = staging_path(spark, "inference")
    text.select(F.translate("text", "\n\r", "  ").alias("value")).write.text(path)
    return _configured(spark.read, fmt, {k: v for k, v in options.items() if k != "multiLine"}).load(path).schema


class CutRecords:
    """Records of a layout, cut once; parsed as often as a schema is tried."""

    def __init__(self, spark: SparkSession, fmt: str, layout: Layout):
        self.spark, self.fmt, self.layout = spark, fmt, layout
        self.given = {k: v for k, v in layout.options.items() if k not in ("schema", "columns", "multiLine")}
        self.texts = {k: str(v).lower() if isinstance(v, bool) else str(v) for k, v in self.given.items()}
        records = layout.records
        self.rows = cut(spark, records.machine, layout.files, records.scanned, records.single)
        self.names: list[str] | None = None
        if fmt == "csv":
            self.texts.setdefault("escape", '"')
            self._fields()

    def _fields(self) -> None:
        """Take the header off, and hold every row against it."""
        machine = self.layout.records.machine
        firsts = self.rows.groupBy(FILE).agg(F.min(BLOCK).alias(BLOCK), F.min_by("text", BLOCK).alias("first"))
        headers = {row["first"] for row in firsts.select("first").distinct().limit(2).collect()}
        headed = str(self.given.get("header", True)).lower() == "true"
        header = next(iter(headers), "")
        if headed:
            if len(headers) > 1:
                raise ValueError("The files have headers that differ behind their first line; load them in parts.")
            path = staging_path(self.spark, "inference")
            self.spark.createDataFrame([(header.replace("\n", " "),)], "value string").write.text(path)
            self.names = _configured(self.spark.read, "csv", {**self.given, "header": True, "inferSchema": False}).load(path).columns
            # one row per file
            self.rows = self.rows.join(F.broadcast(firsts.select(FILE, BLOCK)), [FILE, BLOCK], "left_anti")
        width = _width(header.replace("\n", " "), machine.separator, self.layout.options)
        blank = F.length("text") - F.length(F.rtrim(F.col("text"), F.lit(machine.separator)))
        fields = F.col("fields") + 1 - (blank / len(machine.separator)).cast("int")
        far = self.rows.where(fields > width).orderBy(FILE, BLOCK).first()
        if far is not None:
            before = self.rows.where((F.col(FILE) == far[FILE]) & (F.col(BLOCK) < far[BLOCK])).count()
            raise ValueError(_too_wide(far[FILE], before + 1, far["fields"] + 1, width))

    def parsed(self, schema: T.StructType | None) -> DataFrame:
        """User columns, FILE and BLOCK, which orders the records of a file."""
        if self.fmt == "json":
            schema = schema if schema is not None else _inferred(self.spark, "json", self.rows, self.given)
            row = F.from_json("text", schema, self.texts)
        else:
            if schema is None:
                schema = _inferred(self.spark, "csv", self.rows, {**self.given, "header": False})
                if self.names is not None:
                    types = [f.dataType for f in schema.fields] + [T.StringType()] * len(self.names)
                    schema = T.StructType([T.StructField(n, t) for n, t in zip(self.names, types)])  # noqa: B905
            ddl = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
            row = F.from_csv("text", ddl, self.texts)
        return self.rows.select(row.alias("\x01"), FILE, BLOCK).select("`\x01`.*", FILE, BLOCK)


def _united(spark: SparkSession, fmt: str, layouts: list[Layout], options: dict[str, Any]) -> DataFrame:
    """Rows of all layouts, columns matched by name."""
    records = {id(x): CutRecords(spark, fmt, x) for x in layouts if x.records is not None}

    def read(layout: Layout, schema: T.StructType | None) -> DataFrame:
        if layout.records is not None:
            return records[id(layout)].parsed(schema)
        given = {k: v for k, v in layout.options.items() if k != "schema"}
        return _configured(spark.read, fmt, given | ({"schema": schema} if schema is not None else {})).load(layout.files)

    schema = options.get("schema")
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if len(layouts) == 1:
        return read(layouts[0], _in_file_order(schema, layouts[0]))
    if schema is not None:
        frames = [read(x, _in_file_order(schema, x)) for x in layouts]
    else:
        frames = [read(x, None) for x in layouts]
        types = _common_types([f.schema for f in frames])
        for i, (frame, layout) in enumerate(zip(frames, layouts, strict=True)):
            user = [f for f in frame.schema.fields if f.name not in (FILE, BLOCK)]
            wanted = T.StructType([T.StructField(f.name, types[f.name]) for f in user])
            if [f.dataType for f in wanted] != [f.dataType for f in user]:
                frames[i] = read(layout, wanted)
    frames = [f if FILE in f.columns else f.select(*[quoted(c) for c in f.columns], *_origin()) for f in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _in_file_order(schema: T.StructType | None, layout: Layout) -> T.StructType | None:
    """A given CSV schema in the order of the file's header; unchanged where the names differ."""
    if schema is None or layout.header is None:
        return schema
    separator = layout.options.get("sep", layout.options.get("delimiter", ","))
    names = _names(layout.header, separator, layout.options)
    fields = {f.name: f for f in schema.fields}
    return T.StructType([fields[n] for n in names]) if sorted(names) == sorted(fields) else schema


#: Inferred types that widen into the later ones.
WIDENING = (T.IntegerType(), T.LongType(), T.DoubleType())


def _common_types(schemas: list[T.StructType]) -> dict[str, T.DataType]:
    """Type of every column over several inferred schemas: the same, the wider number, else text."""
    types: dict[str, T.DataType] = {}
    for field in (f for s in schemas for f in s.fields):
        known = types.get(field.name, field.dataType)
        if known == field.dataType:
            types[field.name] = known
        elif known in WIDENING and field.dataType in WIDENING:
            types[field.name] = max(known, field.dataType, key=WIDENING.index)
        else:
            types[field.name] = T.StringType()
    return types
