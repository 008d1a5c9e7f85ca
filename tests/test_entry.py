import importlib

import pytest

from conftest import MEDIUM, ROOT  # noqa: F401


def test_entry_smoke(spark):
    E = importlib.import_module("__spark_entry__")
    df = E.entry(spark)
    assert df.count() > 0
    assert "pickup_datetime" in df.columns


def test_every_query_has_an_oracle():
    E = importlib.import_module("__spark_entry__")
    own = {k for k in E.queries() if not k.startswith("op") and k != "pipeline"}  # the text queries have their own tests
    assert own == {k for k in E.oracle_sql() if not k.startswith("op")}


FAST = ["clean_green", "clean_yellow", "processed", "schema_watermarks", "partitioned_watermarks",
        "expire_relations", "insert_only", "upsert_tagged", "column_profile", "schema_profile",
        "search_documents", "csv_scan_rename", "write_graph", "write_profile", "append_evolve", "taxi_load",
        "stream_ingest", "lenient_int", "rename_if_present", "cap_rows", "metadata_edges", "metadata_refresh",
        "table_metadata", "list_tables", "partitioned_write", "table_roundtrip", "merge_green_eras", "profile_records"]


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, name):
    import sys

    sys.path.insert(0, f"{ROOT}/tools")
    from oracle_check import compare, duck

    E = importlib.import_module("__spark_entry__")
    sf = "/root/testdata/sf0.001"
    got = E.queries()[name](spark, sf).toPandas()
    want = duck(sf).execute(E.oracle_sql()[name]).fetchdf()
    assert compare(name, got, want) == []
