"""Metadata refresh (W4): catalog -> graph -> watermarks -> profiles -> search
documents -> expiry of stale relations.

The heavy steps (watermarks and profiles read table data) each run once: their
small results (one row per table / column) are cut from their lineage with a
pinned table before the graph, the search documents and the writers reuse
them.  Their records and those of the catalog are published in one merge; the published
graph is cut the same way before its three consumers.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from tidewater.operators.graph import (
    DEFAULT_EXPIRY_DAYS,
    STALE_RELATION_TYPES,
    STALENESS_MAX_PCT,
    expire_relations,
    metadata_graph,
    profile_records,
    publish_jobs,
    search_documents,
    watermark_records,
)
from tidewater.operators.profile import schema_profile
from tidewater.operators.watermark import DEFAULT_TS_COL, watermarks
from tidewater.session import pinned
from tidewater.sources.catalog import DEFAULT_CLUSTER, DEFAULT_DATABASE, schema_filter, table_metadata

# Job tags the publishing steps used.
BASE_TAG = "some_unique_tag"
WATERMARK_TAG = "wm_test"
PROFILE_TAG = "wm_test"


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def metadata_refresh(
    spark: SparkSession,
    zones: Iterable[str],
    now_ms: int,
    ts_col: str | Mapping[str, str] = DEFAULT_TS_COL,
    cluster: str = DEFAULT_CLUSTER,
    database: str = DEFAULT_DATABASE,
    graph: tuple[DataFrame, DataFrame] | None = None,
    profile_rows: int | None = None,
    expiry_days: int = DEFAULT_EXPIRY_DAYS,
    stale_types: Iterable[str] = STALE_RELATION_TYPES,
    max_pct: float = STALENESS_MAX_PCT,
    missing: str = "raise",
    include: Iterable[str] | None = None,
    profile_digits: int | None = None,
    tags: tuple[str, str, str] = (BASE_TAG, WATERMARK_TAG, PROFILE_TAG),
) -> dict[str, DataFrame]:
    """Run W4 over ``zones`` and return the resulting frames.

    ``graph`` is an existing (nodes, edges) pair to publish into; relations of the
    stale types older than ``expiry_days`` are dropped from it behind the guard.  A table
    without its time column fails the refresh, unless ``missing="skip"`` leaves it out.
    Keys: nodes, edges, watermarks, profiles, search_docs.
    """
    zones = list(zones)
    meta = table_metadata(spark, zones, cluster=cluster, database=database)
    if include is not None:  # the other zones' metadata is left out
        meta = schema_filter(meta, include=list(include))
        zones = [z for z in zones if z in set(include)]
    wm = pinned(_union([watermarks(spark, z, ts_col, cluster=cluster, database=database, missing=missing)
                        for z in zones]), "refresh-watermarks")
    prof = pinned(_union([schema_profile(spark, z, n=profile_rows, digits=profile_digits) for z in zones]),
                  "refresh-profiles")
    # the three jobs, in the order in which they were published
    jobs = [metadata_graph(meta), watermark_records(wm), profile_records(prof, database=database, cluster=cluster)]
    nodes, edges = publish_jobs([(*job, tag) for job, tag in zip(jobs, tags)], now_ms, graph=graph)

    # the published graph feeds the documents, the guard and the expiry: cut it once
    nodes, edges = pinned(nodes, "refresh-nodes"), pinned(edges, "refresh-edges")
    docs = search_documents(nodes, edges)
    edges = expire_relations(edges, now_ms, expiry_days, stale_types, max_pct)
    return {"nodes": nodes, "edges": edges, "watermarks": wm, "profiles": prof, "search_docs": docs}
