"""Shared scratch space.

Jobs that must cut lineage or stage intermediate files write under the folder the
cluster names in ``spark.checkpoint.dir`` (shared storage on a real cluster).  Only
when the session names none (tests, a bare local session) do we pick one ourselves.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except Exception:  # Spark Connect has no SparkContext
            root = None
    if not root:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[.*\])?", master):  # local-cluster has executors of its own
            # a machine-local folder is not shared by the executors of a cluster
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS / object store)")
        root = tempfile.mkdtemp(prefix="tidewater-ckpt-")
    # (``spark.checkpoint.dir`` is a core setting: a running session refuses to change
    # it, so a folder of our own is registered with the context only)
    try:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(root)
    except Exception:
        pass
    return root.rstrip("/")


def app_folder(spark: SparkSession) -> str:
    """This application's folder below the shared scratch root."""
    return f"{scratch_root(spark)}/tidewater/{spark.conf.get('spark.app.id')}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder of this application below the shared scratch root."""
    return f"{app_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def pinned(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a Parquet table below the scratch root and read back: computed once,
    the lineage ends there, and a lost executor loses nothing that was written."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete everything that this application has pinned below the scratch root, and nothing of
    others.  Frames that still read a pinned table can't be used afterwards."""
    path = spark._jvm.org.apache.hadoop.fs.Path(app_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
