"""Small JSON notes beside data files: written and read by the driver through Hadoop's file system.
Their names start with ``_``, so that no reader of the data sees them."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


def located(spark: SparkSession, path: str):
    """(file system, path) of a path."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def write_note(spark: SparkSession, path: str, data: object) -> None:
    files, file = located(spark, path)
    out = files.create(file, True)
    try:
        out.write(bytearray(json.dumps(data).encode()))
    finally:
        out.close()


def read_note(spark: SparkSession, path: str) -> object | None:
    """What was written, None without the file."""
    files, file = located(spark, path)
    if not files.exists(file):
        return None
    stream = files.open(file)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """The names of the files and folders in a folder, sorted; none if it is missing."""
    files, path = located(spark, folder)
    return sorted(s.getPath().getName() for s in files.listStatus(path)) if files.exists(path) else []


def delete(spark: SparkSession, path: str) -> None:
    files, folder = located(spark, path)
    files.delete(folder, True)
