"""The corpus pipeline: documents to shuffled, size-balanced training shards.

``STAGES`` are applied in order; each stage's result is written as Parquet and read
again as the next one's ``docs``.  All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import stored, table


def _store(spark: SparkSession, name: str) -> Callable[[DataFrame], DataFrame]:
    return lambda df: stored(spark, df, name)


#: The columns that stages read; all others go through them in one column, so that none clashes.
READ = ("doc_id", "text", "lang", "source")


def packed(docs: DataFrame) -> DataFrame:
    rest = [c for c in docs.columns if c not in READ]
    return docs.select(*[c for c in READ if c in docs.columns], F.struct(*rest, F.lit(True).alias("there")).alias("rest of it"))


def unpacked(df: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` again, in their order."""
    return df.select(*[c if c in READ else F.col("`rest of it`")[c].alias(c) for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    from tidewater.llm.quality import quality_rules as rules

    return unpacked(rules(packed(docs), store=_store(spark, "pipe-quality")).filter("kept"), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the smallest id."""
    from tidewater.llm.simhash import one_of_each, simhash_components

    rows = packed(docs)
    return unpacked(one_of_each(simhash_components(spark, rows, _store(spark, "pipe-simhash")), rows), docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    from tidewater.llm.decontam import clean_rows, decontaminate

    rows = packed(docs)
    found = decontaminate(spark, rows, table(spark, sf_dir, "benchmark"), _store(spark, "pipe-decontam"))
    return unpacked(clean_rows(found, rows, _store(spark, "pipe-contaminated")), docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole copies of the documents, as many of each as its source's target asks for."""
    from tidewater.llm.mixing import mix

    mixed = mix(packed(docs), _store(spark, "pipe-mixing"), whole=True)
    return unpacked(mixed.withColumn("copies", F.explode("copies")), docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document and copy that the mix holds, in 40 shards of near equal bytes."""
    from tidewater.llm.shards import minimax_shards

    return minimax_shards(spark, docs, _store(spark, "pipe-shards"), keep_text=True)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: Near duplicates need connected components, which plain SQL here doesn't give.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(spark, docs, f"pipeline-{i}")
    return docs
