"""File sources and sinks: header-checked CSV scans, schema-evolving appends, and the
plain-file outputs of the metadata side (graph CSVs, search and profile JSON)."""

from __future__ import annotations

import json
import re
import sys
import uuid
import warnings
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.columns import col_of, find_column
from tidewater.operators.merge import merge_eras
from tidewater.sources.notes import located, names_in, read_note, write_note

# Workers need no copy of this package: its functions travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Tasks that read headers at most, and files whose headers are broadcast at most.
HEADER_TASKS = 4096
HEADER_BROADCAST = 100_000

# Header probes are tiny jobs (one task reading one line per file); at least this many
# run at once, more on a larger cluster (its default parallelism), at most the ceiling.
HEADER_PROBE_THREADS = 8
HEADER_PROBE_MAX_THREADS = 64


def probe_threads(spark: SparkSession, files: int) -> int:
    try:
        cluster = spark.sparkContext.defaultParallelism
    except Exception:  # Spark Connect has no SparkContext
        cluster = HEADER_PROBE_THREADS
    return max(1, min(files, HEADER_PROBE_MAX_THREADS, max(HEADER_PROBE_THREADS, cluster)))


def read_header(spark: SparkSession, path: str) -> list[str]:
    """Column names from the first line of one CSV (Spark reads only that line)."""
    return spark.read.option("header", True).csv(path).columns


def literal(spark: SparkSession, path: str) -> str:
    """``path`` for a reader: a file or folder of that very name is meant where there is one, else
    the name is a glob."""
    if not re.search(r"[\[\]{}*?\\]", path):
        return path
    files, file = located(spark, path)
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path) if files.exists(file) else path


def first_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(file, path, line): the first line of each file, read by the executors; no line for files in
    stores that pyarrow has no client for, an empty one for empty files."""
    from pyarrow import ArrowInvalid, ArrowNotImplementedError, fs

    for batch in batches:
        lines: list[str | None] = []
        for path in batch["path"]:
            if path.startswith("file:"):
                store, inner = fs.LocalFileSystem(), re.sub(r"^file:/+", "/", path)
            else:
                try:
                    store, inner = fs.FileSystem.from_uri(path)
                except (ArrowInvalid, ArrowNotImplementedError):  # unknown scheme, or built without its client
                    lines.append(None)
                    continue
            with store.open_input_stream(inner) as f:
                raw = b""
                while b"\n" not in raw and (more := f.read(1 << 16)):
                    raw += more
            lines.append(raw.split(b"\n", 1)[0].rstrip(b"\r").decode("utf-8", "replace"))
        yield pd.DataFrame({"file": batch["file"], "path": batch["path"], "line": pd.Series(lines, dtype=object)})


def file_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(file, path, line) of every file below ``paths``, pinned: found and read by the executors.
    ``file`` is the name a scan of the file gives it (``_metadata.file_path``)."""
    from tidewater.session import pinned

    found = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
             .select(F.col("_metadata.file_path").alias("file"), "path").coalesce(HEADER_TASKS))
    schema = "file string, path string, line string"
    lines = pinned(found.mapInPandas(first_lines, schema), "csv-headers")
    others = [tuple(r) for r in lines.where("line IS NULL").select("file", "path").collect()]
    if others:
        warnings.warn(f"{len(others)} CSV headers are read by a Spark job each, such as that of {others[0][1]}", stacklevel=3)
        with ThreadPoolExecutor(max_workers=probe_threads(spark, len(others))) as pool:
            probed = list(pool.map(lambda x: (*x, header_line(spark, x[1])), others))
        lines = pinned(lines.where("line IS NOT NULL").unionByName(spark.createDataFrame(probed, schema)), "csv-headers")
    return lines


def header_line(spark: SparkSession, path: str) -> str:
    row = spark.read.text(literal(spark, path)).first()
    return row[0] if row else ""


def string_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


def scan_csv(spark: SparkSession, paths: Sequence[str] | str, by_name: bool = False) -> DataFrame:
    """Read CSVs with a header line, every column as text, blank fields as NULL.

    ``paths`` is a path or a list of paths: files, folders (with all folders below) or globs; an
    existing name is taken literally, whatever characters it has.  A plain multi-file read takes
    the header of one file and maps every other file by position; here the executors read the
    first line of each file, and only the different lines come to the driver.  Differing headers
    raise, unless ``by_name=True``: then one scan reads all files by position, and each field goes
    to the column that its own file's header names (columns united as by U2, missing ones NULL).
    Empty files have no header and no rows; a file that comes after its header was looked for fails.
    """
    paths = [literal(spark, p) for p in ([paths] if isinstance(paths, str) else paths)]
    if not paths:
        raise ValueError("scan_csv needs at least one path")
    lines = file_lines(spark, paths)
    distinct = (lines.where("line != ''").groupBy("line").agg(F.min("path").alias("path"), F.count(F.lit(1)).alias("n"))
                .orderBy("path").collect())
    if not distinct:
        raise ValueError(f"no CSV with a header below {paths}")
    headers: dict[tuple[str, ...], str] = {}
    ids = []
    for r in distinct:  # each different line is parsed by Spark, once
        names = tuple(read_header(spark, literal(spark, r["path"])))
        headers.setdefault(names, r["path"])
        ids.append((r["line"], list(headers).index(names)))
    reader = spark.read.options(header=True, recursiveFileLookup=True)
    if len(headers) == 1:
        # every file's header is known, so the reader's mapping by position is right
        return reader.schema(string_schema(next(iter(headers)))).csv(paths)
    if not by_name:
        detail = "; ".join(f"{p}: {list(h)}" for h, p in headers.items())
        raise ValueError(f"CSV headers differ between files (pass by_name=True to unite by name): {detail}")
    return _scan_by_name(spark, reader, paths, list(headers), lines.join(
        F.broadcast(spark.createDataFrame(ids, "line string, header int")), "line").select("file", "header"),
        sum(r["n"] for r in distinct))


def _scan_by_name(spark: SparkSession, reader: DataFrameReader, paths: Sequence[str], headers: list[tuple[str, ...]],
                  files: DataFrame, n_files: int) -> DataFrame:
    """One scan of files with several headers: field k of a row is the column that the header of the
    row's file names at k.  ``files``: (file, header number), looked up by a broadcast while they are
    ``HEADER_BROADCAST`` files at most (some ten MB), else by a join of Spark's choice."""
    columns = merge_eras(*[spark.createDataFrame([], string_schema(h)) for h in headers]).columns
    at = [{name.lower(): k for k, name in enumerate(h)} for h in headers]
    fields = [f"field {k}" for k in range(max(map(len, headers)))]
    known = files.select(F.xxhash64("file").alias("file hash"), F.col("file").alias("known file"), "header")
    rows = reader.schema(string_schema(fields)).csv(list(paths)).select(*map(col_of, fields), F.col("_metadata.file_path").alias("file"))
    same = (F.xxhash64("file") == F.col("file hash")) & (F.col("file") == F.col("known file"))
    known = F.broadcast(known) if n_files <= HEADER_BROADCAST else known
    number = F.coalesce("header", F.raise_error(F.concat(F.lit("no header was read of "), F.col("file"))).cast("int"))
    joined = rows.join(known, same, "left").select(*map(col_of, fields), number.alias("header"))

    def column(name: str) -> Column:
        value = F.lit(None).cast("string")
        for k in sorted({h[name.lower()] for h in at if name.lower() in h}):
            value = F.when(F.col("header").isin([i for i, h in enumerate(at) if h.get(name.lower()) == k]),
                           col_of(fields[k])).otherwise(value)
        return value.alias(name)

    return joined.select(*map(column, columns))


# Notes of the columns that appends brought to a folder, in the order of the appends.
SCHEMA_NOTE = "_schema-"


def folder_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The columns of a folder written by :func:`append_evolve`, from its notes; None without any."""
    fields: dict[str, T.StructField] = {}
    for name in names_in(spark, path):
        if name.startswith(SCHEMA_NOTE):
            for f in T.StructType.fromJson(read_note(spark, f"{path}/{name}")).fields:
                fields.setdefault(f.name.lower(), f)
    return T.StructType(list(fields.values())) if fields else None


def _note_columns(spark: SparkSession, path: str, schema: T.StructType) -> None:
    stamp = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    write_note(spark, f"{path}/{SCHEMA_NOTE}{stamp}-{uuid.uuid4().hex[:6]}.json", json.loads(schema.json()))


def append_evolve(df: DataFrame, path: str) -> None:
    """Append to a Parquet folder; new columns are added at read time.

    The folder keeps notes of its columns, one for each append that brings new ones, so an append
    opens no data file.  (Files that something else wrote there are asked once, all of them.)  Later
    eras are respelled to the folder's existing column spelling; a column of another type than the
    folder's raises.  The note comes first: an append cut short leaves at most a column of NULLs.
    """
    spark = df.sparkSession
    known = folder_schema(spark, path)
    if known is None and any(not n.startswith(("_", ".")) for n in names_in(spark, path)):
        known = spark.read.option("mergeSchema", True).parquet(path).schema
        _note_columns(spark, path, known)
    have = {f.name.lower(): f for f in known.fields} if known else {}
    changed = [f.name for f in df.schema.fields if f.name.lower() in have and have[f.name.lower()].dataType != f.dataType]
    if changed:
        raise ValueError(f"{path}: other types in {changed}")
    df = df.select(*[col_of(c).alias(have[c.lower()].name if c.lower() in have else c) for c in df.columns])
    if added := [f for f in df.schema.fields if f.name.lower() not in have]:
        _note_columns(spark, path, T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in added]))
    df.write.mode("append").parquet(path)


def read_evolved(spark: SparkSession, path: str, order: Sequence[str] | None = None) -> DataFrame:
    """Read a folder written by :func:`append_evolve` by its notes, or, without any, by merging the
    schemas of all its files.  ``order`` (when given) is selected first, any other columns follow."""
    known = folder_schema(spark, path)
    df = spark.read.schema(known).parquet(path) if known else spark.read.option("mergeSchema", True).parquet(path)
    if order:
        head = [find_column(df, c) for c in order]
        head = [c for c in head if c is not None]
        rest = [c for c in df.columns if c not in head]
        df = df.select(*[col_of(c) for c in head + rest])
    return df


def write_graph(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """Node files by label and relationship files by type, CSV with a header."""
    if "attrs" in nodes.columns:
        nodes = nodes.withColumn("attrs", F.to_json("attrs"))
    for df, by, folder in ((nodes, "label", "nodes"), (edges, "type", "relationships")):
        lines = {f.name: one_line(f.name) for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name != by}
        (df.withColumns(lines).write.mode("overwrite").partitionBy(by)
         .options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, escape='"').csv(f"{path}/{folder}"))


def one_line(name: str) -> Column:
    """Text with line breaks (and backslashes) escaped: a record is one line, whoever reads it."""
    return F.replace(F.replace(F.replace(col_of(name), F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))


def read_graph(spark: SparkSession, path: str, folder: str) -> DataFrame:
    """The ``nodes`` or ``relationships`` files that :func:`write_graph` wrote."""
    df = spark.read.options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(f"{path}/{folder}")
    plain = lambda c: F.replace(F.replace(F.replace(F.replace(
        col_of(c), F.lit("\\\\"), F.lit("\0")), F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")), F.lit("\0"), F.lit("\\"))
    return df.withColumns({c: plain(c) for c in df.columns if df.schema[c].dataType == T.StringType()})


def write_search_docs(docs: DataFrame, path: str) -> None:
    """Search documents as JSON lines, rewritten whole on every run."""
    docs.write.mode("overwrite").json(path)


def write_profile(profile: DataFrame, path: str) -> bool:
    """Write a profile report only when the table had numeric columns.

    The profile is computed once: its few rows (one per column) are pinned with a
    reliable checkpoint, then tested for emptiness and written (testing the plan and
    then writing it would run the whole profile twice).
    """
    from tidewater.session import pinned

    found = pinned(profile, "profile-report")
    if found.isEmpty():
        return False
    found.write.mode("overwrite").json(path)
    return True
