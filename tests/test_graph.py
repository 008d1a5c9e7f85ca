import pytest
from pyspark.sql import functions as F

from tidewater.operators.graph import (
    DAY_MS,
    expire_relations,
    insert_only,
    metadata_graph,
    search_documents,
    upsert_tagged,
)
from tidewater.sources.catalog import METADATA_SCHEMA, table_metadata
from tidewater.sources.tables import ensure_zone, write_replace

NOW = 1_700_000_000_000


def _edges(spark, rows):
    return spark.createDataFrame(
        [(f"s{i}", "A", f"e{i}", "B", t, t + "_OF", NOW - age * DAY_MS) for i, (t, age) in enumerate(rows)],
        "start_key string, start_label string, end_key string, end_label string, type string, "
        "reverse_type string, last_updated long")


def test_expire_deletes_only_old_target_types(spark):
    e = _edges(spark, [("READ", 1), ("READ", 10), ("READ_BY", 10), ("READ_BY", 1), ("OTHER", 10)])
    kept = sorted((r.type, r.start_key) for r in expire_relations(e, NOW, max_pct=90).collect())
    assert kept == [("OTHER", "s4"), ("READ", "s0"), ("READ_BY", "s3")]
    again = expire_relations(expire_relations(e, NOW), NOW)
    assert again.count() == 3  # idempotent


def test_expire_guard_raises(spark):
    e = _edges(spark, [("READ", 10)] * 19 + [("READ", 1)])
    with pytest.raises(RuntimeError, match="refusing"):
        expire_relations(e, NOW)


def test_insert_only_and_upsert(spark):
    t = spark.createDataFrame([("k1", "L", "old"), ("k2", "L", "keep")], "key string, label string, name string")
    i = spark.createDataFrame([("k1", "L", "new"), ("k3", "L", "add")], "key string, label string, name string")
    assert {r.key: r.name for r in insert_only(t, i).collect()} == {"k1": "old", "k2": "keep", "k3": "add"}
    up = {r.key: (r.name, r.publish_tag) for r in upsert_tagged(t, i, "tag", NOW).collect()}
    assert up == {"k1": ("new", "tag"), "k2": ("keep", None), "k3": ("add", "tag")}


def test_catalog_graph_and_search_docs(spark, tmp):
    ensure_zone(spark, "t_meta", f"{tmp}/meta")
    write_replace(spark.createDataFrame([(1, "a", 2.0)], "b int, a string, c double"), "t_meta.t1")
    meta = table_metadata(spark, ["t_meta"])
    assert [r.column_name for r in meta.orderBy("sort_order").collect()] == ["b", "a", "c"]
    nodes, edges = metadata_graph(meta)
    labels = sorted(r.label for r in nodes.collect())
    assert labels == ["Cluster", "Column", "Column", "Column", "Database", "Schema", "Table"]
    assert edges.count() == 6
    doc = search_documents(nodes, edges).first()
    assert doc.name == "t1" and doc.column_names == ["b", "a", "c"] and doc.schema == "t_meta"
    assert doc.database == "default" and doc.cluster == "my_delta_environment"
    assert table_metadata(spark, ["no_such_zone"]).count() == 0
    assert spark.createDataFrame([], METADATA_SCHEMA).count() == 0


def test_one_row_per_key_by_a_stated_rule(spark):
    t = spark.createDataFrame([("k0", "L", "old")], "key string, label string, name string")
    i = spark.createDataFrame([("k1", "L", "b"), ("k1", "L", "a"), ("k0", "L", "n")], "key string, label string, name string")
    for frame in (i, i.orderBy("name").coalesce(1)):
        assert sorted(map(tuple, insert_only(t, frame).collect())) == [("k0", "L", "old"), ("k1", "L", "a")]
        assert sorted(tuple(r)[:3] for r in upsert_tagged(t, frame, "tag", NOW).collect()) == [("k0", "L", "n"), ("k1", "L", "a")]


def test_graph_tables_are_pruned_by_type_and_day(spark, tmp, capsys):
    from tidewater.operators.graph import NODE_SCHEMA, load_graph, save_graph, staleness

    ensure_zone(spark, "t_graph", f"{tmp}/graph")
    cut = NOW - 3 * DAY_MS
    ages = [0, 1, 2, 2.9, 2.9999, 3, 3.00001, 3.1, 4, 20]
    rows = [(f"s{i}-{t}", "A", f"e{i}", "B", t, t + "_OF", NOW - int(a * DAY_MS)) for i, a in enumerate(ages * 3)
            for t in ("READ", "READ_BY", "OTHER")]
    rows += [(f"none-{t}", "A", "e", "B", t, "R", None) for t in ("READ", "OTHER")] + [("edge", "A", "e", "B", "READ", "R", cut)]
    edges = spark.createDataFrame(rows, "start_key string, start_label string, end_key string, end_label string, type string, "
                                        "reverse_type string, last_updated long")
    save_graph(spark.createDataFrame([("k", "Table", "n", {"a": "b"})], NODE_SCHEMA), edges, "t_graph")
    nodes, kept = load_graph(spark, "t_graph")
    assert [tuple(r) for r in nodes.select("key", "label", "name", "attrs").collect()] == [("k", "Table", "n", {"a": "b"})]
    key = lambda df: sorted((str(tuple(r)) for r in df.select(*edges.columns).collect()))
    assert key(kept) == key(edges)
    assert sorted(map(tuple, staleness(kept, NOW).collect())) == sorted(map(tuple, staleness(edges, NOW).collect()))
    after = expire_relations(kept, NOW)
    assert key(after) == key(expire_relations(edges, NOW)) and after.count() < kept.count()
    capsys.readouterr()
    after.explain()
    plan = capsys.readouterr().out
    assert "PartitionFilters" in plan and "updated_day" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    staleness(kept, NOW).explain()
    assert "type" in capsys.readouterr().out.split("PartitionFilters")[1].split("PushedFilters")[0]
    save_graph(nodes, after, "t_graph")  # the next version, from the one before
    assert key(load_graph(spark, "t_graph")[1]) == key(after)


def test_one_merge_equals_publishing_in_turn(spark, capsys):
    """Against the single steps: M3 for plain labels, M2 for create-only ones, job by job."""
    import random

    from tidewater.operators.graph import EDGE_KEY, publish_jobs

    rng = random.Random(4)
    node = "key string, label string, name string, attrs map<string,string>"
    edge = "start_key string, start_label string, end_key string, end_label string, type string, reverse_type string"

    def nodes(n):
        return spark.createDataFrame([(f"k{rng.randint(0, 30)}", rng.choice(["Table", "Description", "Stat"]), f"n{rng.randint(0, 9)}",
                                       {"a": str(rng.randint(0, 3))}) for _ in range(n)], node)

    def edges(n):
        return spark.createDataFrame([(f"k{rng.randint(0, 8)}", "A", f"k{rng.randint(0, 8)}", rng.choice("BC"), rng.choice(["T", "U"]), "R")
                                      for _ in range(n)], edge)

    old = (nodes(40), edges(40))  # with repeated keys, which stay unless a job replaces them
    jobs = [(nodes(25), edges(25), f"tag{i}") for i in range(3)]
    expected_nodes, expected_edges = old
    co = F.col("label") == "Description"
    for n, e, tag in jobs:
        stamp = {"publish_tag": F.lit(tag), "last_updated": F.lit(NOW).cast("long")}
        plain = upsert_tagged(expected_nodes.where(~co), n.where(~co), tag, NOW)
        kept = insert_only(expected_nodes.where(co), n.where(co).withColumns(stamp))
        expected_nodes = plain.unionByName(kept, allowMissingColumns=True)
        expected_edges = upsert_tagged(expected_edges, e, tag, NOW, EDGE_KEY)
    got_nodes, got_edges = publish_jobs(jobs, NOW, graph=old)
    key = lambda df, like: sorted((str(r) for r in df.select(*like.columns).collect()))
    assert key(got_nodes, expected_nodes) == key(expected_nodes, expected_nodes)
    assert key(got_edges, expected_edges) == key(expected_edges, expected_edges)
    fresh_nodes, fresh_edges = publish_jobs(jobs, NOW)
    empty = (spark.createDataFrame([], node), spark.createDataFrame([], edge))
    again_nodes, again_edges = publish_jobs(jobs, NOW, graph=empty)
    assert key(fresh_nodes, fresh_nodes) == key(again_nodes, fresh_nodes) and key(fresh_edges, fresh_edges) == key(again_edges, fresh_edges)
    got_edges.explain()
    plan = capsys.readouterr().out
    assert plan.count("LeftAnti") == 1 and "BroadcastHashJoin" in plan  # the graph is neither joined thrice nor shuffled
    assert "Exchange hashpartitioning" not in plan


def test_graph_files_keep_line_breaks_and_blanks(spark, tmp):
    from tidewater.sources.files import read_graph, write_graph

    nodes = [("k1", "A", " two\nlines \\n \"q\", "), ("k2", "B", "Trip_type ")]
    edges = [("k1", "A", "k2 ", "B", "T\r", "R")]
    write_graph(spark.createDataFrame(nodes, "key string, label string, name string"),
                spark.createDataFrame(edges, "start_key string, start_label string, end_key string, end_label string, "
                                             "reverse_type string, type string"), f"{tmp}/g")
    back = read_graph(spark, f"{tmp}/g", "nodes").select("key", "label", "name").collect()
    assert sorted(map(tuple, back)) == nodes
    back = read_graph(spark, f"{tmp}/g", "relationships").collect()
    assert [(r.start_key, r.end_key, r.reverse_type, r.type) for r in back] == [("k1", "k2 ", "T\r", "R")]
