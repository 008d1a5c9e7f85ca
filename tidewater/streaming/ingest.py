"""Incremental raw ingest: the S1 -> P1 -> raw-zone step as a file stream.

A landing folder receives trip CSVs over time.  Re-reading every file on each load
(what a batch ingest does) grows with the history; a file-source stream remembers
which files it has already taken (in its checkpoint, on shared storage) and, with an
``availableNow`` trigger, processes just the new ones and stops.  Each header era
lands in its own folder, so the schema of a stream is fixed by its header.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidewater.functions.columns import INGEST_RENAMES, rename_if_present
from tidewater.sources.files import string_schema


def csv_stream(spark: SparkSession, folder: str, header: Sequence[str],
               max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming frame over the CSVs of one header era, every column text.  Each file's own
    header is checked against ``header`` when it is read: a differing one fails the batch."""
    reader = spark.readStream.schema(string_schema(header)).options(header=True, enforceSchema=False)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(folder)


def ingest_new_files(
    spark: SparkSession,
    folder: str,
    header: Sequence[str],
    target: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Append the rows of CSVs not ingested before to Parquet at ``target``.

    Returns the started query (``availableNow``: it ends once the backlog is done);
    call ``awaitTermination()`` to wait.  ``checkpoint`` is a stable folder on shared
    storage that belongs to ``target``: it remembers which files were taken.
    """
    stream = rename_if_present(csv_stream(spark, folder, header), INGEST_RENAMES)
    w = (stream.writeStream.format("parquet")
         .option("checkpointLocation", checkpoint)
         .outputMode("append")
         .trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(*partition_by)
    return w.start(target)
