import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    base = tempfile.mkdtemp(prefix="tidewater-tests-")
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("tidewater-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", os.path.join(base, "warehouse"))
    )
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    # only where the session names no shared folder (as here, in tests)
    if not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(os.path.join(base, "checkpoints"))
    yield s


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
