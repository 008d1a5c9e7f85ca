"""Metadata graph kept as two tables: nodes and edges (relationships).

Node frames: ``key, label, name, attrs`` (attrs: map<string,string>).
Edge frames: ``start_key, start_label, end_key, end_label, type, reverse_type``;
published frames add ``publish_tag`` and ``last_updated`` (epoch milliseconds).

Keys follow ``<database>://<cluster>.<schema>/<table>[/<column>]``.  All joins here
are on metadata-sized frames (tables x columns); they are plain equi-joins left to
the optimiser (and adaptive execution) to plan.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Labels and relation types of the graph.
DATABASE, CLUSTER, SCHEMA, TABLE, COLUMN = "Database", "Cluster", "Schema", "Table", "Column"
DESCRIPTION, WATERMARK, STAT = "Description", "Watermark", "Stat"

# Relation types the expiry job targets, and its guard and age.
STALE_RELATION_TYPES = ("READ", "READ_BY")
STALENESS_MAX_PCT = 90
DAY_MS = 86400000
DEFAULT_EXPIRY_DAYS = 3

NODE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("label", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("attrs", T.MapType(T.StringType(), T.StringType())),
    ]
)
# Tables of a graph kept in a zone, and the column that its edges are laid out by beside their type.
NODES_TABLE, EDGES_TABLE, UPDATED_DAY = "nodes", "edges", "updated_day"
EDGE_COLUMNS = ("start_key", "start_label", "end_key", "end_label", "type", "reverse_type")
EDGE_KEY = ("start_key", "end_key", "type")


def _attrs(**kv: Column) -> Column:
    items = []
    for k, v in kv.items():
        items += [F.lit(k), v.cast("string")]
    return F.create_map(*items) if items else F.create_map().cast("map<string,string>")


def _nodes(df: DataFrame, key: Column, label: str, name: Column, **attrs: Column) -> DataFrame:
    return df.select(key.alias("key"), F.lit(label).alias("label"), name.alias("name"),
                     _attrs(**attrs).alias("attrs")).dropDuplicates(["key"])


def _edges(df: DataFrame, start: Column, start_label: str, end: Column, end_label: str,
           rel: str, reverse: str) -> DataFrame:
    return df.select(start.alias("start_key"), F.lit(start_label).alias("start_label"),
                     end.alias("end_key"), F.lit(end_label).alias("end_label"),
                     F.lit(rel).alias("type"), F.lit(reverse).alias("reverse_type")).dropDuplicates(list(EDGE_KEY))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def database_key(db: Column) -> Column:
    return F.concat(F.lit("database://"), db)


def cluster_key(db: Column, cluster: Column) -> Column:
    return F.concat(db, F.lit("://"), cluster)


def schema_key(db: Column, cluster: Column, schema: Column) -> Column:
    return F.concat(db, F.lit("://"), cluster, F.lit("."), schema)


def table_key(db: Column, cluster: Column, schema: Column, table: Column) -> Column:
    return F.concat(schema_key(db, cluster, schema), F.lit("/"), table)


def column_key(db: Column, cluster: Column, schema: Column, table: Column, column: Column) -> Column:
    return F.concat(table_key(db, cluster, schema, table), F.lit("/"), column)


def metadata_graph(meta: DataFrame) -> tuple[DataFrame, DataFrame]:
    """M1: table metadata rows (S9) -> (nodes, edges).

    Database -CLUSTER-> Cluster -SCHEMA-> Schema -TABLE-> Table -COLUMN-> Column, and
    Table/Column -DESCRIPTION-> Description where the catalog holds a comment.  The
    database / cluster / schema / table levels come from one ``rollup`` (one
    aggregation instead of a de-duplication per level); column rows are unique as
    they come.  Table nodes carry their location as attributes.
    """
    db, cl, sc, tb, co = (F.col(c) for c in ("database", "cluster", "schema", "table_name", "column_name"))
    levels = (meta.rollup("database", "cluster", "schema", "table_name")
              .agg(F.first("table_type", ignorenulls=True).alias("table_type"),
                   F.first("table_description", ignorenulls=True).alias("table_description"),
                   F.grouping_id().alias("gid"))
              .where(F.col("gid") != 15))
    gid = F.col("gid")
    # gid: 7 database, 3 cluster, 1 schema, 0 table
    key = (F.when(gid == 7, database_key(db)).when(gid == 3, cluster_key(db, cl))
           .when(gid == 1, schema_key(db, cl, sc)).otherwise(table_key(db, cl, sc, tb)))
    parent = (F.when(gid == 3, database_key(db)).when(gid == 1, cluster_key(db, cl))
              .otherwise(schema_key(db, cl, sc)))
    label = F.when(gid == 7, F.lit(DATABASE)).when(gid == 3, F.lit(CLUSTER)).when(gid == 1, F.lit(SCHEMA)) \
        .otherwise(F.lit(TABLE))
    parent_label = F.when(gid == 3, F.lit(DATABASE)).when(gid == 1, F.lit(CLUSTER)).otherwise(F.lit(SCHEMA))
    name = F.when(gid == 7, db).when(gid == 3, cl).when(gid == 1, sc).otherwise(tb)
    table_attrs = _attrs(table_type=F.col("table_type"), database=db, cluster=cl, schema=sc)
    level_nodes = levels.select(key.alias("key"), label.alias("label"), name.alias("name"),
                                F.when(gid == 0, table_attrs).otherwise(_attrs()).alias("attrs"))
    level_edges = levels.where(gid != 7).select(
        parent.alias("start_key"), parent_label.alias("start_label"), key.alias("end_key"), label.alias("end_label"),
        F.upper(label).alias("type"), F.concat(F.upper(label), F.lit("_OF")).alias("reverse_type"))

    tk, ck = table_key(db, cl, sc, tb), column_key(db, cl, sc, tb, co)
    tdesc = levels.where((gid == 0) & F.col("table_description").isNotNull())
    cdesc = meta.where(F.col("column_description").isNotNull())
    nodes = union_all([
        level_nodes,
        meta.select(ck.alias("key"), F.lit(COLUMN).alias("label"), co.alias("name"),
                    _attrs(type=F.col("column_type"), sort_order=F.col("sort_order"),
                           is_partition=F.col("is_partition")).alias("attrs")),
        tdesc.select(F.concat(tk, F.lit("/_description")).alias("key"), F.lit(DESCRIPTION).alias("label"),
                     F.col("table_description").alias("name"), _attrs().alias("attrs")),
        cdesc.select(F.concat(ck, F.lit("/_description")).alias("key"), F.lit(DESCRIPTION).alias("label"),
                     F.col("column_description").alias("name"), _attrs().alias("attrs")),
    ])
    edges = union_all([
        level_edges,
        meta.select(tk.alias("start_key"), F.lit(TABLE).alias("start_label"), ck.alias("end_key"),
                    F.lit(COLUMN).alias("end_label"), F.lit("COLUMN").alias("type"),
                    F.lit("COLUMN_OF").alias("reverse_type")),
        tdesc.select(tk.alias("start_key"), F.lit(TABLE).alias("start_label"),
                     F.concat(tk, F.lit("/_description")).alias("end_key"), F.lit(DESCRIPTION).alias("end_label"),
                     F.lit("DESCRIPTION").alias("type"), F.lit("DESCRIPTION_OF").alias("reverse_type")),
        cdesc.select(ck.alias("start_key"), F.lit(COLUMN).alias("start_label"),
                     F.concat(ck, F.lit("/_description")).alias("end_key"), F.lit(DESCRIPTION).alias("end_label"),
                     F.lit("DESCRIPTION").alias("type"), F.lit("DESCRIPTION_OF").alias("reverse_type")),
    ])
    return nodes, edges


def one_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: the one whose other columns, as JSON text, come first.  Keyed
    publishing needs a rule that doesn't depend on the rows' order."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(list(keys))
    ranked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.to_json(F.struct(*rest))).alias("row_"))
    return ranked.select(*keys, "row_.*").select(*df.columns)


def insert_only(target: DataFrame, incoming: DataFrame, keys: Sequence[str] = ("key",)) -> DataFrame:
    """M2: add incoming rows whose key is new, one per key; existing rows are never overwritten."""
    fresh = one_per_key(incoming, keys).join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(fresh, allowMissingColumns=True)


def upsert_tagged(target: DataFrame, incoming: DataFrame, tag: str, now_ms: int,
                  keys: Sequence[str] = ("key",)) -> DataFrame:
    """M3: publish ``incoming``, one row per key, under a job tag: its rows replace same-key rows
    of ``target`` and carry ``publish_tag`` / ``last_updated``; other rows stay as they are."""
    incoming = one_per_key(incoming, keys)
    stamped = incoming.withColumns({"publish_tag": F.lit(tag), "last_updated": F.lit(now_ms).cast("long")})
    kept = target.join(incoming.select(*keys), list(keys), "left_anti")
    return kept.unionByName(stamped, allowMissingColumns=True)


def first_of_jobs(jobs: Sequence[DataFrame], keys: Sequence[str], tags: Sequence[str], now_ms: int,
                  keep_first: Column) -> DataFrame:
    """The rows that publishing the jobs one after the other leaves of them: one a key, from the last
    job that has it (from the first one where ``keep_first``), by the rule of :func:`one_per_key`,
    stamped with that job's tag.  One aggregation over all jobs' rows."""
    plain = union_all([df.withColumn("job_", F.lit(i)) for i, df in enumerate(jobs)])
    rest = [c for c in plain.columns if c not in (*keys, "job_")]
    rank = F.struct(F.when(F.col("first_"), F.col("job_")).otherwise(-F.col("job_")), F.to_json(F.struct(*rest)))
    ranked = (plain.withColumn("first_", keep_first).groupBy(*keys, "first_")
              .agg(F.min_by(F.struct(*rest, "job_"), rank).alias("row_")))
    tag = F.element_at(F.array(*[F.lit(t) for t in tags]), F.col("row_.job_") + 1)
    return ranked.select(*keys, *[F.col(f"row_.{c}").alias(c) for c in rest], tag.alias("publish_tag"),
                         F.lit(now_ms).cast("long").alias("last_updated"), "first_")


def publish_jobs(jobs: Sequence[tuple[DataFrame, DataFrame, str]], now_ms: int,
                 create_only_labels: Iterable[str] = (DESCRIPTION,),
                 graph: tuple[DataFrame, DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """Publish several jobs' (nodes, edges, tag) into a graph in one merge, as if each were published
    in turn (M3); nodes of the create-only labels stay as they are once they exist (M2).

    All jobs' rows are ranked by key first.  What wins is of the size of the metadata and pinned, so
    that Spark knows its size: the graph's nodes and edges are read once, by one anti-join each,
    and not shuffled while the winners are small enough to broadcast."""
    from tidewater.session import pinned

    create_only, tags = list(create_only_labels), [tag for _, _, tag in jobs]
    nodes = first_of_jobs([n for n, _, _ in jobs], ("key",), tags, now_ms, F.col("label").isin(create_only))
    edges = first_of_jobs([e for _, e, _ in jobs], EDGE_KEY, tags, now_ms, F.lit(False)).drop("first_")
    if graph is None:
        return nodes.drop("first_"), edges
    nodes, edges = pinned(nodes, "published-nodes"), pinned(edges, "published-edges")
    g_nodes, g_edges = graph
    plain = nodes.where(~F.col("first_")).select(F.col("key").alias("new_key"))
    kept = g_nodes.join(plain, (F.col("key") == F.col("new_key")) & ~F.coalesce(F.col("label").isin(create_only), F.lit(False)),
                        "left_anti")
    there = g_nodes.where(F.col("label").isin(create_only)).select(F.col("key").alias("old_key"))
    added = nodes.join(there, F.col("first_") & (F.col("key") == F.col("old_key")), "left_anti").drop("first_")
    return (kept.unionByName(added, allowMissingColumns=True),
            g_edges.join(edges.select(*EDGE_KEY), list(EDGE_KEY), "left_anti").unionByName(edges, allowMissingColumns=True))


def publish(nodes: DataFrame, edges: DataFrame, tag: str, now_ms: int,
            create_only_labels: Iterable[str] = (DESCRIPTION,),
            graph: tuple[DataFrame, DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """Publish one job's nodes and edges into a graph (see :func:`publish_jobs`)."""
    return publish_jobs([(nodes, edges, tag)], now_ms, create_only_labels, graph)


def search_documents(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """M4: one search document per table node, rebuilt whole.

    Fields: key, database, cluster, schema, name, description, column_names (in column
    order), column_descriptions, column_count.  Columns are reached over COLUMN edges
    and descriptions over DESCRIPTION edges.  A table's column list is bounded by its
    width, so the per-table ``collect_list`` never grows with the data.
    """
    def by_label(label: str) -> DataFrame:
        return nodes.where(F.col("label") == label)

    def rel(t: str) -> DataFrame:
        return edges.where(F.col("type") == t)

    tables = by_label(TABLE).select(
        "key", "name", *[F.col("attrs")[a].alias(a) for a in ("database", "cluster", "schema")])
    desc = (rel("DESCRIPTION").select(F.col("start_key").alias("owner"), F.col("end_key").alias("d_key"))
            .join(by_label(DESCRIPTION).select(F.col("key").alias("d_key"), F.col("name").alias("text")), "d_key")
            .select("owner", "text"))
    cols = (rel("COLUMN").select(F.col("start_key").alias("key"), F.col("end_key").alias("col_key"))
            .join(by_label(COLUMN).select(F.col("key").alias("col_key"), F.col("name").alias("col_name"),
                                          F.col("attrs")["sort_order"].cast("int").alias("pos")), "col_key")
            .join(desc.select(F.col("owner").alias("col_key"), F.col("text").alias("col_desc")), "col_key", "left"))
    col_lists = cols.groupBy("key").agg(
        F.sort_array(F.collect_list(F.struct("pos", "col_name", "col_desc"))).alias("cl"))
    docs = (tables.join(desc.select(F.col("owner").alias("key"), F.col("text").alias("description")), "key", "left")
            .join(col_lists, "key", "left"))
    return docs.select(
        "key", "database", "cluster", "schema", "name", "description",
        F.coalesce(F.transform("cl", lambda s: s["col_name"]), F.array().cast("array<string>")).alias("column_names"),
        F.coalesce(F.transform("cl", lambda s: s["col_desc"]), F.array().cast("array<string>"))
        .alias("column_descriptions"),
        F.coalesce(F.size("cl"), F.lit(0)).cast("int").alias("column_count"),
    )


def is_stale(edges: DataFrame, now_ms: int, days: int = DEFAULT_EXPIRY_DAYS,
             types: Iterable[str] = STALE_RELATION_TYPES) -> Column:
    """relation of a target type last updated more than ``days`` before ``now``."""
    cutoff = now_ms - DAY_MS * days
    return F.col("type").isin(list(types)) & (F.col("last_updated") < F.lit(cutoff))


def save_graph(nodes: DataFrame, edges: DataFrame, zone: str) -> None:
    """Keep a graph as tables of a zone: ``nodes`` laid out by label, ``edges`` by type and UTC day of
    ``last_updated`` (the default partition holds those without).  New versions replace old ones, so
    the frames may read the graph they replace."""
    from tidewater.sources.tables import table_name, write_partitioned

    day = F.date_from_unix_date(F.floor(F.col("last_updated") / DAY_MS).cast("int"))
    if "last_updated" not in edges.columns:
        edges = edges.withColumn("last_updated", F.lit(None).cast("long"))
    write_partitioned(nodes, table_name(zone, NODES_TABLE), ["label"])
    write_partitioned(edges.withColumn(UPDATED_DAY, day), table_name(zone, EDGES_TABLE), ["type", UPDATED_DAY])


def load_graph(spark: SparkSession, zone: str) -> tuple[DataFrame, DataFrame]:
    """The nodes and edges that :func:`save_graph` kept; the edges with their day, by which expiry
    leaves out partitions."""
    from tidewater.sources.tables import scan_table

    return scan_table(spark, zone, NODES_TABLE), scan_table(spark, zone, EDGES_TABLE)


def staleness(edges: DataFrame, now_ms: int, days: int = DEFAULT_EXPIRY_DAYS,
              types: Iterable[str] = STALE_RELATION_TYPES) -> DataFrame:
    """Per target type: total, stale and stale percentage (one row per type).

    Over edges laid out by type and day only the target types' partitions are read."""
    types = list(types)
    stale = is_stale(edges, now_ms, days, types)
    return (edges.where(F.col("type").isin(types))
            .groupBy("type")
            .agg(F.count(F.lit(1)).alias("total"), F.count_if(stale).alias("stale"))
            .withColumn("stale_pct", F.col("stale") * 100.0 / F.col("total")))


def stale_ratio_guard(edges: DataFrame, now_ms: int, days: int = DEFAULT_EXPIRY_DAYS,
                      types: Iterable[str] = STALE_RELATION_TYPES,
                      max_pct: float = STALENESS_MAX_PCT) -> None:
    """Refuse to expire when more than ``max_pct`` % of a target type is stale.

    Only the per-type summary (a handful of rows) reaches the driver.
    """
    for r in staleness(edges, now_ms, days, types).collect():
        if r["stale_pct"] > max_pct:
            raise RuntimeError(
                f"refusing to expire {r['type']}: {r['stale_pct']:.1f}% stale > {max_pct}% "
                f"({r['stale']} of {r['total']})")


def expire_relations(edges: DataFrame, now_ms: int, days: int = DEFAULT_EXPIRY_DAYS,
                     types: Iterable[str] = STALE_RELATION_TYPES,
                     max_pct: float = STALENESS_MAX_PCT, guard: bool = True) -> DataFrame:
    """M5: drop stale relations of the target types, behind the A6 guard.

    Relations of other types, and relations without a ``last_updated``, stay.
    """
    types = list(types)
    if guard:
        stale_ratio_guard(edges, now_ms, days, types, max_pct)
    if UPDATED_DAY in edges.columns:
        # whole days before the cut-off's are left out unread
        cut = F.lit(date(1970, 1, 1) + timedelta(days=(now_ms - DAY_MS * days) // DAY_MS))
        edges = edges.where(~(F.col("type").isin(types) & F.coalesce(F.col(UPDATED_DAY) < cut, F.lit(False))))
    return edges.where(~F.coalesce(is_stale(edges, now_ms, days, types), F.lit(False)))


def watermark_records(wm: DataFrame) -> tuple[DataFrame, DataFrame]:
    """M6: watermark rows (A3) -> Watermark nodes and Table -WATERMARK-> edges."""
    db, cl, sc, tb = (F.col(c) for c in ("database", "cluster", "schema", "table_name"))
    tk = table_key(db, cl, sc, tb)
    wk = F.concat(tk, F.lit("/"), F.col("part_type"), F.lit("/"))
    parts = F.split(F.col("part_name"), "=", 2)
    nodes = _nodes(wm, wk, WATERMARK, F.col("part_type"),
                   partition_key=parts[0], partition_value=parts[1], create_time=F.col("create_time"))
    edges = _edges(wm, tk, TABLE, wk, WATERMARK, "WATERMARK", "BELONG_TO_TABLE")
    return nodes, edges


def profile_records(profile: DataFrame, database: str | None = None, cluster: str | None = None,
                    schema: str | None = None, table: str | None = None) -> tuple[DataFrame, DataFrame]:
    """M7: profile rows (A4/A5) -> one Stat node per (column, statistic), attached to
    its column by a Column -STAT-> Stat edge.  Location columns missing from the
    profile are taken from the arguments."""
    from tidewater.operators.profile import COUNT_STATS, VALUE_STATS
    from tidewater.sources.catalog import DEFAULT_CLUSTER, DEFAULT_DATABASE

    p = profile
    fill = {"database": database or DEFAULT_DATABASE, "cluster": cluster or DEFAULT_CLUSTER,
            "schema": schema, "table_name": table}
    for k, v in fill.items():
        if k not in p.columns:
            if v is None:
                raise ValueError(f"profile has no {k!r} column; pass it")
            p = p.withColumn(k, F.lit(v))
    stats = [s for s in (*COUNT_STATS, *VALUE_STATS) if s in p.columns]
    long = p.select("database", "cluster", "schema", "table_name", "column_name",
                    F.inline(F.array(*[F.struct(F.lit(s).alias("stat_name"),
                                                F.col(s).cast("double").alias("stat_val")) for s in stats])))
    ck = column_key(*(F.col(c) for c in ("database", "cluster", "schema", "table_name", "column_name")))
    sk = F.concat(ck, F.lit("/"), F.col("stat_name"), F.lit("/"))
    nodes = _nodes(long, sk, STAT, F.col("stat_name"), stat_val=F.col("stat_val"), stat_type=F.col("stat_name"))
    edges = _edges(long, ck, COLUMN, sk, STAT, "STAT", "STAT_OF")
    return nodes, edges
