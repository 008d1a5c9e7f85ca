"""Zone tables: catalog reads and writes (Parquet tables in named databases).

A table is a catalog entry over one *version* folder.  Every replacement (S3, S4, S6) writes a new
version folder beside it and then points the entry at it: with the same columns and layout by one
catalog change (``SET LOCATION``), else by registering the new version and swapping names.  A
version stays until :func:`vacuum`, and only an append (S5) to the current one adds files to it, so

* a write that fails leaves the table as it was, and a query may read the table it replaces;
* a frame held across a replacement goes on reading its own version, whole, and fails once that
  version is vacuumed; it never gets other rows;
* earlier versions can be listed, read and restored.

For this the partitions of a table are those of its folder: they are found when a frame is made, and
not looked up by the table's name when it runs.  (Tables that something else created become
versioned at their first replacement.)  The version folder holds a small description of itself,
its columns and layout, written last: a folder without one is a write under way or cut short.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta, timezone
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.columns import quote
from tidewater.sources.notes import delete, located, names_in, read_note, write_note

PARTITION_COLUMNS = ("pickup_year", "pickup_month")

# Marks the folder of one version of a table; its description (hidden to readers by its name).
VERSION = "-version-"
DESCRIPTION_FILE = "_version.json"
STAMP = "%Y%m%dT%H%M%S%f"

# The codec of versions where the session names none; files that a task may keep open (see unsorted_writes).
CODEC, CODEC_CONF = "zstd", "spark.sql.parquet.compression.codec"
OPEN_FILES, OPEN_FILES_CONF = 200, "spark.sql.maxConcurrentOutputFileWriters"


def table_name(zone: str, table: str) -> str:
    return f"{quote(zone)}.{quote(table)}"


def scan_table(spark: SparkSession, zone: str, table: str) -> DataFrame:
    """``select * from zone.table`` (lazy; later projections prune the scan)."""
    return spark.table(table_name(zone, table))


def _text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ensure_zone(spark: SparkSession, zone: str, location: str | None = None) -> None:
    """Create the database when missing, optionally at a location."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quote(zone)}{f' LOCATION {_text(location)}' if location else ''}")


def name_parts(name: str) -> list[str]:
    """Database and table of a quoted or plain qualified name."""
    return [(m[0].replace("``", "`") or m[1]) for m in re.findall(r"`((?:[^`]|``)+)`|([^.`]+)", name)]


def _zone_and_table(spark: SparkSession, name: str) -> tuple[str, str]:
    parts = name_parts(name)
    return (parts[0], parts[1]) if len(parts) == 2 else (spark.catalog.currentDatabase(), parts[0])


def _plain(path: str) -> str:
    """A location as the catalog gives it (a URI) as a path."""
    return re.sub(r"^file:/+", "/", unquote(path)).rstrip("/")


def table_details(spark: SparkSession, name: str) -> dict[str, str]:
    """Location (as a path), Type, Provider and Comment of a table, among others."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    at = next((i for i, r in enumerate(rows) if r["col_name"] == "# Detailed Table Information"), len(rows))
    found = {r["col_name"]: r["data_type"] for r in rows[at:]}
    return {**found, "Location": _plain(found["Location"])} if found.get("Location") else found


def table_location(spark: SparkSession, name: str) -> str | None:
    """The folder of a table's current version."""
    return table_details(spark, name).get("Location")


def shared_scan(spark: SparkSession, schema: T.StructType, layout: Sequence[str], folders: Mapping[str, object],
                tag: str) -> DataFrame:
    """One scan of many Parquet folders of like columns and layout: the columns of ``schema`` (those of
    the layout must be numbers; they are read off the files' paths) and, as ``tag``, the value that
    ``folders`` gives the folder a row's file is in.  The folders are looked up by a broadcast join
    for each depth at which they lie, of which there are few."""
    def uri(path: str) -> str:
        files, folder = located(spark, path)
        return re.sub("^file:/+", "file:/", files.makeQualified(folder).toUri().toString())  # as files' paths are given

    by_depth: dict[int, list] = {}
    for path, value in folders.items():
        by_depth.setdefault(uri(path).count("/") + 1, []).append((uri(path), value))
    last = {c.lower() for c in layout}
    stored = T.StructType([f for f in schema.fields if f.name.lower() not in last])
    scan = (spark.read.schema(stored).option("recursiveFileLookup", True).parquet(*folders)
            .select("*", F.col("_metadata.file_path").alias("file of it")))
    columns = [F.regexp_extract("file of it", f"(?i)/{re.escape(f.name)}=(-?[0-9.]+(?:E-?[0-9]+)?)/", 1).try_cast(f.dataType).alias(f.name)
               if f.name.lower() in last else F.col(quote(f.name)) for f in schema.fields]
    kind = "bigint" if all(isinstance(v, int) for v in folders.values()) else "string"
    parts = []
    for depth, rows in by_depth.items():
        names = spark.createDataFrame(rows, f"`folder of it` string, {quote(tag)} {kind}")
        parts.append(scan.join(F.broadcast(names), F.substring_index("file of it", "/", depth) == F.col("folder of it"))
                     .select(*columns, F.col(quote(tag))))
    return reduce(lambda a, b: a.unionByName(b), parts)


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    """The columns that a table is laid out by."""
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def _untracked(spark: SparkSession) -> SparkSession:
    """A session over the same catalog that registers tables without partition entries; the
    caller's session keeps its settings."""
    session = spark.newSession()
    session.conf.set("spark.sql.hive.manageFilesourcePartitions", "false")
    return session


def unsorted_writes(spark: SparkSession) -> SparkSession:
    """A session over the same catalog, with the caller's settings, whose partitioned writes keep up to
    ``OPEN_FILES`` files of a task open.  Spark else sorts a task's rows by the layout, which spills where
    a task reads some ten MB of Parquet; beyond that many files it sorts the rest.  The caller's session
    keeps its settings, and a number of open files that it names holds."""
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            session.conf.set(key, value)
    if spark.conf.get(OPEN_FILES_CONF, None) is None:
        session.conf.set(OPEN_FILES_CONF, str(OPEN_FILES))
    return session


def _columns(schema: T.StructType) -> str:
    out = []
    for f in schema.fields:
        comment = f.metadata.get("comment")
        out.append(f"{quote(f.name)} {f.dataType.simpleString()}{f' COMMENT {_text(comment)}' if comment else ''}")
    return ", ".join(out)


def _register(spark: SparkSession, name: str, schema: T.StructType, partition_by: Sequence[str], path: str,
              comment: str | None) -> None:
    layout = f" PARTITIONED BY ({', '.join(map(quote, partition_by))})" if partition_by else ""
    said = f" COMMENT {_text(comment)}" if comment else ""
    _untracked(spark).sql(f"CREATE TABLE {name} ({_columns(schema)}) USING parquet{layout}{said} LOCATION {_text(path)}")


def _same(a: T.StructType, b: T.StructType) -> bool:
    return [(f.name, f.dataType) for f in a.fields] == [(f.name, f.dataType) for f in b.fields]


def _in_order(schema: T.StructType, partition_by: Sequence[str]) -> T.StructType:
    """The columns as a table has them: those of the layout last."""
    last = {c.lower(): i for i, c in enumerate(partition_by)}
    fields = [f for f in schema.fields if f.name.lower() not in last]
    return T.StructType(fields + sorted((f for f in schema.fields if f.name.lower() in last), key=lambda f: last[f.name.lower()]))


def _versioned(spark: SparkSession, name: str, layout: Sequence[str]) -> bool:
    """Whether replacing the table may keep its entry: one of ours, without partition entries."""
    details = table_details(spark, name)
    if VERSION not in details.get("Location", "").rsplit("/", 1)[-1]:
        return False
    return not layout or details.get("Partition Provider", "") != "Catalog"


def _point_at(spark: SparkSession, name: str, schema: T.StructType, partition_by: Sequence[str], path: str) -> None:
    """Make ``path`` the current version of table ``name``."""
    zone, table = _zone_and_table(spark, name)
    name = table_name(zone, table)
    if not spark.catalog.tableExists(name):
        _register(spark, name, schema, partition_by, path, None)
        return
    old, layout = spark.table(name).schema, partition_columns(spark, name)
    if layout == list(partition_by) and _same(old, schema) and _versioned(spark, name, layout):
        spark.sql(f"ALTER TABLE {name} SET LOCATION {_text(path)}")
        spark.catalog.refreshTable(name)
        return
    # another schema or layout: comments of the table, and of columns that stay, are kept
    comments = {f.name.lower(): f.metadata["comment"] for f in old.fields if f.metadata.get("comment")}
    kept = T.StructType([T.StructField(f.name, f.dataType, True, {"comment": comments[f.name.lower()], **f.metadata})
                         if f.name.lower() in comments else f for f in schema.fields])
    tag = uuid.uuid4().hex[:12]
    fresh, before = table_name(zone, f"{table}__new_{tag}"), table_name(zone, f"{table}__old_{tag}")
    _register(spark, fresh, kept, partition_by, path, table_details(spark, name).get("Comment"))
    spark.sql(f"ALTER TABLE {name} RENAME TO {before}")
    try:
        spark.sql(f"ALTER TABLE {fresh} RENAME TO {name}")
    except Exception:
        spark.sql(f"ALTER TABLE {before} RENAME TO {name}")
        spark.sql(f"DROP TABLE {fresh}")
        raise
    spark.sql(f"DROP TABLE {before}")  # of a version, its entry alone: the folder stays


def _describe(spark: SparkSession, path: str, schema: T.StructType, partition_by: Sequence[str]) -> None:
    write_note(spark, f"{path}/{DESCRIPTION_FILE}", {"schema": json.loads(schema.json()), "partition_by": list(partition_by)})


def _description(spark: SparkSession, path: str) -> tuple[T.StructType, list[str]] | None:
    data = read_note(spark, f"{path}/{DESCRIPTION_FILE}")
    return (T.StructType.fromJson(data["schema"]), data["partition_by"]) if data else None


def _prefix(spark: SparkSession, zone: str, table: str) -> str:
    return f"{_plain(spark.catalog.getDatabase(zone).locationUri)}/{table}{VERSION}"


def _switch(df: DataFrame, name: str, partition_by: Sequence[str] = (), spark: SparkSession | None = None) -> None:
    """Replace table ``name`` by a new version; only when its rows are written does the name change.
    ``spark``: the session that goes on using the name, if it isn't the one that ``df`` is of."""
    spark = spark or df.sparkSession
    zone, table = _zone_and_table(spark, name)
    path = f"{_prefix(spark, zone, table)}{datetime.now(timezone.utc).strftime(STAMP)}-{uuid.uuid4().hex[:6]}"
    partition_by = [next((f for f in df.columns if f.lower() == c.lower()), c) for c in partition_by]
    schema = _in_order(df.schema, partition_by)
    try:
        w = df.write.mode("errorifexists")
        w = w if spark.conf.get(CODEC_CONF, None) else w.option("compression", CODEC)
        (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
        _describe(spark, path, schema, partition_by)
    except Exception:
        delete(spark, path)
        raise
    _point_at(spark, table_name(zone, table), schema, partition_by, path)


def versions(spark: SparkSession, name: str) -> list[dict]:
    """The whole versions of a table, newest first: ``version``, ``path``, ``written`` (UTC) and
    ``current``.  One listing of the zone's folder."""
    zone, table = _zone_and_table(spark, name)
    prefix = _prefix(spark, zone, table)
    folder, start = prefix.rsplit("/", 1)
    now = table_location(spark, name) if spark.catalog.tableExists(name) else None
    out = []
    for found in names_in(spark, folder):
        stamp, path = found[len(start):], f"{folder}/{found}"
        if found.startswith(start) and re.fullmatch(r"\d{8}T\d{12}-[0-9a-f]{6}", stamp) and DESCRIPTION_FILE in names_in(spark, path):
            written = datetime.strptime(stamp.split("-")[0], STAMP).replace(tzinfo=timezone.utc)
            out.append({"version": stamp, "path": path, "written": written, "current": path == now})
    return sorted(out, key=lambda v: v["version"], reverse=True)


def _version(spark: SparkSession, name: str, version: str) -> str:
    for v in versions(spark, name):
        if v["version"] == version:
            return v["path"]
    raise KeyError(f"{name} has no version {version!r}")


def scan_version(spark: SparkSession, name: str, version: str) -> DataFrame:
    """The rows of an earlier version, by its own columns and layout."""
    path = _version(spark, name, version)
    schema, _ = _description(spark, path)
    return spark.read.schema(schema).parquet(path)


def restore_version(spark: SparkSession, name: str, version: str) -> None:
    """Make an earlier version the current one again; no rows are copied."""
    path = _version(spark, name, version)
    schema, partition_by = _description(spark, path)
    _point_at(spark, name, schema, partition_by, path)


def vacuum(spark: SparkSession, name: str, keep: int = 0, older_than: timedelta = timedelta(0)) -> list[str]:
    """Delete the folders of a table's versions except the current one, the ``keep`` newest others
    and those written less than ``older_than`` ago; returns the versions deleted.  Frames that
    still read them fail from then on.  Not to be run beside a replacement of the same table."""
    limit = datetime.now(timezone.utc) - older_than
    old = [v for v in versions(spark, name) if not v["current"]][keep:]
    gone = [v for v in old if v["written"] <= limit]
    for v in gone:
        delete(spark, v["path"])
    return [v["version"] for v in gone]


def write_replace(df: DataFrame, name: str) -> None:
    """S3: overwrite rows and schema; a layout goes with the old schema, comments stay."""
    _switch(df, name)


def _schema_key(df: DataFrame) -> dict[str, str]:
    return {f.name.lower(): f.dataType.simpleString() for f in df.schema.fields}


def write_overwrite(df: DataFrame, name: str) -> None:
    """Overwrite rows; the target's columns must stay the same (names and types), and it keeps
    its spelling and order of columns, its layout and its comments."""
    spark = df.sparkSession
    layout: list[str] = []
    if spark.catalog.tableExists(name):
        target = spark.table(name)
        old, new = _schema_key(target), _schema_key(df)
        if old != new:
            raise ValueError(f"schema of {name} would change: {old} -> {new} (use write_replace)")
        df = df.select(*[F.col(quote(c)).alias(c) for c in target.columns])
        layout = partition_columns(spark, name)
    _switch(rebalanced(df, layout) if layout else df, name, layout)


def rebalanced(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Shuffle so that each output partition holds few (year, month) values and is of a
    sane size: adaptive execution splits a hot partition (one month holding a third of the
    rows) into several tasks and merges small ones; a plain ``repartition(cols)`` would put
    a hot month into one task.
    """
    return df.hint("rebalance", *cols)


def write_partitioned(
    df: DataFrame,
    name: str,
    cols: Sequence[str] = PARTITION_COLUMNS,
    rebalance: bool = True,
    spark: SparkSession | None = None,
) -> None:
    """Overwrite as a table partitioned by ``cols``; NULL keys go to the default
    partition.  ``rebalance`` bounds the file count (see :func:`rebalanced`); ``spark`` is the
    caller's session where ``df`` is of another one."""
    _switch(rebalanced(df, cols) if rebalance else df, name, cols, spark)


def append_table(df: DataFrame, name: str) -> None:
    """S5 for a catalog table: append by column name.  Columns that the table lacks are added
    to it (NULL in its old rows); columns that ``df`` lacks are NULL in the new rows; a
    column of another type than the table's raises."""
    spark = df.sparkSession
    old = {f.name.lower(): f for f in spark.table(name).schema.fields}
    new = {f.name.lower(): f for f in df.schema.fields}
    if changed := [c for c in new if c in old and new[c].dataType != old[c].dataType]:
        raise ValueError(f"{name}: other types in {changed}")
    if added := [f for c, f in new.items() if c not in old]:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'{quote(f.name)} {f.dataType.simpleString()}' for f in added)})")
    target = spark.table(name).schema
    df.select(*[F.col(quote(new[f.name.lower()].name)).alias(f.name) if f.name.lower() in new
                else F.lit(None).cast(f.dataType).alias(f.name) for f in target.fields]).write.insertInto(name)
    if added and (path := table_location(spark, name)) and _description(spark, path):
        _describe(spark, path, target, partition_columns(spark, name))
