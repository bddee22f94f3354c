"""JSON files -> landing rows.

Two formats. ``array``: a file holds one top-level JSON array of order documents
(``strip_outer_array``), or one bare object, or one object per line. Such files
are read whole (``text`` with ``wholetext``), so each file is one task:
parallelism comes from the number of files, as with hourly drops. ``lines``: JSON
Lines files of any size, read line by line through the splittable ``text``
source.

A parse always covers the whole text: the text is wrapped in brackets, so a
second root, or anything after the first one, makes it malformed instead of
being left out. What does not parse becomes a reject row, never nothing.

The landing area is read with all its folders. A file's name is its path below
the area; a folder ``file_name=<name>/`` (what ``write_json_array_files``
produces) names its file.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starling.session import dropped_shuffles

REASON_MALFORMED = "malformed JSON"
REASON_NOT_DOCUMENT = "not a JSON array or object"
REASON_NULL_DOCUMENT = "null document"

# Landed documents are read whole, so they are written as they are: taking them apart into a column for each path, and putting
# them together again, would be work for nothing. An option of a single write.
WHOLE_DOCUMENTS = {"spark.sql.variant.inferShreddingSchema": "false"}

# What a state or a landing table keeps on disk is packed more tightly than by Parquet's default. An option of a single write.
PACKED = {"compression": "zstd"}

# The file source skips files older than this (relative to the newest seen); a hundred years skips none.
MAX_FILE_AGE = "36500d"


@dataclass(frozen=True)
class Discovery:
    """How a stream takes new files: how many (files or bytes) at a time, and where loaded ones are moved.

    With an archive the landing area, and so the listing of each trigger, stays small: Spark moves a file, with its path,
    once the batch that loaded it is complete and a later trigger has looked for files. What was loaded is kept by the landing table.
    """

    max_files: int | None = None
    max_bytes: int | None = None
    archive: str | None = None

    def options(self) -> dict:
        if self.max_files and self.max_bytes:
            raise ValueError("a micro-batch is bounded by files or by bytes, not both")
        out = {"maxFileAge": MAX_FILE_AGE, "maxFilesPerTrigger": self.max_files, "maxBytesPerTrigger": self.max_bytes}
        if self.archive:
            out |= {"cleanSource": "archive", "sourceArchiveDir": self.archive}
        return {k: v for k, v in out.items() if v}


def _reader(spark: SparkSession, streaming: bool, discovery: Discovery | int | None):
    reader = (spark.readStream if streaming else spark.read).format("text").option("recursiveFileLookup", True)
    if streaming:
        if not isinstance(discovery, Discovery):
            discovery = Discovery(max_files=discovery)
        reader = reader.options(**discovery.options())
    return reader


def read_files(spark: SparkSession, path: str, streaming: bool = False,
               max_files_per_trigger: Discovery | int | None = None) -> DataFrame:
    """Whole-file text rows ``(file_name, value)`` from a landing area and all its folders."""
    df = _reader(spark, streaming, max_files_per_trigger).option("wholetext", True).load(path)
    return df.select(logical_name(F.col("_metadata.file_path"), path).alias("file_name"), "value")


def read_lines(spark: SparkSession, path: str, streaming: bool = False,
               max_files_per_trigger: Discovery | int | None = None) -> DataFrame:
    """JSON Lines ``(file_name, row_number, value)``, blank lines left out; large files are split between tasks.

    ``row_number`` is the line's number in its file, blank lines counted: a first pass counts the lines of each split, and a
    line's number is that in its split and those of the splits before. A stream sees each split once only: there it is
    the byte offset of the split and the number in the split, which grows with the line's place, is unique in the file, and is the
    line's number in a file of one split.
    """
    df = _reader(spark, streaming, max_files_per_trigger).load(path)
    rows = df.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), "value")
    numbered = rows.mapInArrow(_numbered, "path string, start long, value string, line long")
    if streaming:
        before = F.col("start")
    else:
        counts = rows.groupBy("path", "start").agg(F.count(F.lit(1)).alias("n"))          # one row per split
        so_far = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
        first = counts.select("path", "start", F.coalesce(F.sum("n").over(so_far), F.lit(0)).alias("before"))
        numbered, before = numbered.join(first, ["path", "start"]), F.col("before")
    return numbered.where(F.trim("value") != "").select(
        logical_name(F.col("path"), path).alias("file_name"), (before + F.col("line")).alias("row_number"), "value")


def _numbered(batches):
    """Add ``line``, the running number of each row in its split; a task reads its splits one after the other."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    split, seen = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        n = batch.num_rows
        change = np.ones(n, bool)
        for c in ("path", "start"):
            col = batch.column(c)
            same = pc.equal(col.slice(1), col.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            change[1:] &= same
        change[1:] = ~change[1:]                           # where another split begins
        first = (batch.column("path")[0].as_py(), batch.column("start")[0].as_py())
        begin = np.maximum.accumulate(np.where(change, np.arange(n), 0))
        line = np.arange(n) - begin + 1
        if first == split:
            line[begin == 0] += seen
        split = (batch.column("path")[n - 1].as_py(), batch.column("start")[n - 1].as_py())
        seen = int(line[-1])
        yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("start"), batch.column("value"), pa.array(line)],
                                         names=["path", "start", "value", "line"])


def _decoded(text: Column) -> Column:
    return F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def logical_name(file_path: Column, root: str) -> Column:
    """The path below ``root``, or the value of a last folder ``file_name=<name>``."""
    below = "/" + re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", root).strip("/") + "/"
    path = _decoded(file_path)
    folder = F.regexp_extract(path, r"/file_name=([^/]+)/[^/]*$", 1)
    at = F.instr(path, below)
    relative = F.when(at > 0, F.substr(path, at + len(below))).otherwise(F.substring_index(path, "/", -1))
    return F.when(folder != "", _decoded(folder)).otherwise(relative)


def _with(value: Column, fn) -> Column:
    """``fn`` of ``value``, which is worked out once however often ``fn`` names it (inside a lambda no common part is shared)."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def _one_root(text: Column, schema: str) -> Column:
    """The single root value of a text as ``schema``; NULL when the text holds anything else."""
    roots = F.from_json(F.concat(F.lit("["), text, F.lit("]")), f"array<{schema}>")
    return _with(roots, lambda r: F.when(F.size(r) == 1, F.get(r, F.lit(0))))


def _is_object(value: Column) -> Column:
    return F.try_variant_get(value, "$", "struct<>").isNotNull()


def _reason_of_value(value: Column) -> Column:
    """Why a parsed root is no document (NULL when it is one)."""
    return (F.when(value.isNull(), REASON_MALFORMED).when(F.is_variant_null(value), REASON_NULL_DOCUMENT)
            .when(~_is_object(value), REASON_NOT_DOCUMENT))


def _strictly(reason: Column, strict: bool) -> Column:
    """In strict mode text that is no JSON fails the load instead of becoming a reject."""
    if not strict:
        return reason
    return F.when(reason == REASON_MALFORMED, F.raise_error(F.lit(REASON_MALFORMED)).cast("string")).otherwise(reason)


def parse_json_arrays(files: DataFrame, strict: bool = False) -> DataFrame:
    """``(file_name, value)`` -> ``(file_name, row_number, payload, reject_reason, raw)``.

    One generator pass per file. A file that is one JSON array yields one row per
    element, one bare object one row. A file whose first line is an object of its own
    yields one row per line that isn't blank (a line that is no object: a reject with that
    line). Anything else (several arrays, text after the root, no JSON) yields one reject row
    carrying the whole text. An array or text without content yields no row. ``strict`` raises
    on text that is no JSON.
    """
    value = F.col("value")
    staged = files.select("file_name", "value", _one_root(value, "array<variant>").alias("_array"))
    staged = staged.select("file_name", "_array", F.when(F.col("_array").isNull(), value).alias("_text"))
    # a text that begins as an array, but is none, is no other root, nor does it begin with an object
    other = F.when(~F.ltrim(F.col("_text"), F.lit(" \r\n\t")).startswith("["), F.col("_text"))
    staged = staged.select("*", other.alias("_other"))
    staged = staged.select("*", _one_root(F.col("_other"), "variant").alias("_root"))
    # only a text that is no single root can hold one object per line
    lines = F.filter(F.split(F.when(F.col("_root").isNull(), F.col("_other")), "\r?\n"), lambda x: F.trim(x) != "")
    staged = staged.select("file_name", "_array", "_text", "_root", lines.alias("_lines"))
    by_line = _is_object(_one_root(F.get("_lines", F.lit(0)), "variant"))
    row = "struct<payload variant, reason string, raw string>"

    def made(payload, reason, raw):
        return F.struct(payload.alias("payload"), reason.alias("reason"), raw.alias("raw")).cast(row)

    none = F.lit(None).cast("string")
    of_array = F.transform("_array", lambda x: made(
        x, F.when(x.isNull() | F.is_variant_null(x), REASON_NULL_DOCUMENT).otherwise(none), none))

    def of_line(x):
        return _with(_one_root(x, "variant"), lambda root: _with(
            _reason_of_value(root), lambda reason: made(root, reason, F.when(reason.isNotNull(), x))))

    reason = _reason_of_value(F.col("_root"))
    # a text without content has no rows; only one that is no array is looked at, so the text of an array is made and read once
    blank = F.coalesce(F.trim("_text", F.lit(" \r\n\t")) == "", F.lit(True))
    rows = (F.when(F.col("_array").isNotNull(), of_array).when(blank, F.lit(None)).when(by_line, F.transform("_lines", of_line))
            .otherwise(F.array(made(F.col("_root"), reason, F.when(reason.isNotNull(), F.col("_text"))))))
    out = staged.select("file_name", F.posexplode(rows).alias("_pos", "_row"))
    # the row number of a reject that stands for a whole file is 0
    whole = F.col("_row.raw").isNotNull() & (F.col("_row.reason") != REASON_NULL_DOCUMENT) & (F.col("_pos") == 0)
    return out.select(
        "file_name", F.when(whole, 0).otherwise(F.col("_pos") + 1).cast("bigint").alias("row_number"),
        F.when(F.col("_row.reason").isNull() | (F.col("_row.reason") == REASON_NULL_DOCUMENT), F.col("_row.payload")).alias("payload"),
        _strictly(F.col("_row.reason"), strict).alias("reject_reason"), F.col("_row.raw").alias("raw"))


def parse_json_lines(lines: DataFrame, strict: bool = False) -> DataFrame:
    """``(file_name, row_number, value)`` of JSON Lines -> the columns of ``parse_json_arrays``, one row per line."""
    rows = lines.select("file_name", "row_number", "value", _one_root(F.col("value"), "variant").alias("_root"))
    reason = _reason_of_value(F.col("_root"))
    return rows.select("file_name", "row_number", F.when(reason.isNull(), F.col("_root")).alias("payload"),
                       _strictly(reason, strict).alias("reject_reason"), F.when(reason.isNotNull(), F.col("value")).alias("raw"))


def read_landing(spark: SparkSession, path: str, fmt: str = "array", streaming: bool = False,
                 max_files_per_trigger: Discovery | int | None = None, strict: bool = False) -> DataFrame:
    """Landing rows of an area in a format: ``array``, ``lines``, or (not as a stream) ``large-array``, which reads
    large array files by several tasks."""
    if fmt == "large-array" and not streaming:
        from starling.sources.split_arrays import read_split_arrays

        return _landing(read_split_arrays(spark, path, strict=strict))
    if fmt not in ("array", "lines"):
        raise ValueError(f"unknown format {fmt!r}" + " of a stream" * streaming)
    read = read_files if fmt == "array" else read_lines
    return landing_rows(read(spark, path, streaming, max_files_per_trigger), strict=strict)


def landing_rows(files: DataFrame, load_ts: Column | None = None, strict: bool = False) -> DataFrame:
    """A2: file lineage projection ``(file_name, row_number, load_ts, payload, ...)``."""
    parse = parse_json_lines if "row_number" in files.columns else parse_json_arrays
    return _landing(parse(files, strict=strict), load_ts)


def _landing(parsed: DataFrame, load_ts: Column | None = None) -> DataFrame:
    ts = F.current_timestamp() if load_ts is None else load_ts
    return parsed.select("file_name", "row_number", ts.cast("timestamp").alias("load_ts"),
                         "payload", "reject_reason", "raw")


def load_once(spark: SparkSession, source: str, landing: str, strict: bool = False, fmt: str = "array",
              checkpoint: str | None = None) -> DataFrame:
    """A3: load every file of ``source`` that ``landing`` does not hold yet; a second call adds only new files.

    The checkpoint beside the table remembers the files; it is the one that a continuous load of the same table uses.
    """
    rows = read_landing(spark, source, fmt, streaming=True, strict=strict)
    query = (rows.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
             .options(**WHOLE_DOCUMENTS, **PACKED).option("checkpointLocation", checkpoint or f"{landing.rstrip('/')}_checkpoint")
             .option("path", landing).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return spark.read.schema(rows.schema).parquet(landing)


def query_files(spark: SparkSession, source: str, fmt: str = "array") -> DataFrame:
    """Ad-hoc look at documents straight from files, nothing written."""
    return read_landing(spark, source, fmt)


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Listing of the landing area with each file's logical name; file contents are never read."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return df.select("path", "length", "modificationTime",
                     logical_name(F.col("_metadata.file_path"), path).alias("file_name"))


def write_json_array_files(files: DataFrame, path: str, compression: str = "gzip") -> None:
    """Write ``(file_name, value)`` so each row becomes one file under ``file_name=<name>/``.

    Such files are read whole, so they are packed, which readers know by the ending; ``none`` for files to be read in splits."""
    with dropped_shuffles(files.sparkSession):
        files.select("file_name", "value").write.mode("append").partitionBy("file_name").text(path, compression=compression)
