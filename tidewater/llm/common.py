"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import scratch_path

#: The white space that separates words (fixed by the contracts): blank, \t \n \x0B \f \r.
WHITE = " \t\n\x0b\x0c\r"


def ship_by_value(module_name: str) -> None:
    """Send this module's functions to Python workers with the job, so that workers need
    no installed copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared scratch folder and read it back: the
    lineage ends there and a lost executor loses nothing that was written."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """The maximal runs of non-white characters of ``text``; null and blank texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+"), "")


def word_count(text: Column) -> Column:
    """``size(words(text))`` without the words: white-space runs of the trimmed text plus one."""
    inner = F.trim(F.coalesce(text, F.lit("")), F.lit(WHITE))
    return F.when(inner == "", F.lit(0)).otherwise(F.regexp_count(inner, F.lit("[\\x20\\x09-\\x0D]+")) + 1).cast("long")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names starting with ``names`` that clash with none of ``df`` (case-insensitively)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def need(df: DataFrame, *names: str) -> None:
    """Raise unless ``df`` has each named column exactly once."""
    for name in names:
        if df.columns.count(name) != 1:
            raise ValueError(f"column {name!r} is needed exactly once; the table has {df.columns}")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
