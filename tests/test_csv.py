import os

import pytest

from tidewater.plans.taxi import raw_fix
from tidewater.sources.files import scan_csv

HEADER = "VendorID,lpep_pickup_datetime,Lpep_dropoff_datetime,Fare_amount,Trip_type \n"


def _write(path, header, rows):
    with open(path, "w") as f:
        f.write(header)
        for r in rows:
            f.write(",".join(r) + "\n")


def test_scan_same_header_blank_is_null(spark, tmp):
    a, b = os.path.join(tmp, "a.csv"), os.path.join(tmp, "b.csv")
    _write(a, HEADER, [("1", "2014-01-01 00:00:00", "2014-01-01 00:10:00", "7.5", "1")])
    _write(b, HEADER, [("2", "2014-02-01 00:00:00", "", "8", "2")])
    df = raw_fix(scan_csv(spark, [a, b]))
    assert df.columns == ["VendorID", "pickup_datetime", "dropoff_datetime", "Fare_amount", "trip_type"]
    assert all(t == "string" for _, t in df.dtypes)
    rows = sorted(df.collect(), key=lambda r: r.VendorID)
    assert rows[1].dropoff_datetime is None and rows[0].trip_type == "1"


def test_scan_reordered_header_raises_or_unites(spark, tmp):
    a, b = os.path.join(tmp, "a.csv"), os.path.join(tmp, "b.csv")
    _write(a, "x,y\n", [("1", "2")])
    _write(b, "y,x\n", [("20", "10")] * 50)  # larger file second
    with pytest.raises(ValueError, match="headers differ"):
        scan_csv(spark, [a, b])
    df = scan_csv(spark, [a, b], by_name=True)
    got = sorted((r.x, r.y) for r in df.collect())
    assert got[0] == ("1", "2") and set(got[1:]) == {("10", "20")}


def test_folder_and_glob_are_checked_file_by_file(spark, tmp):
    folder = os.path.join(tmp, "in put")
    os.makedirs(folder)
    _write(os.path.join(folder, "a.csv"), "a,b\n", [("1", "2")])
    _write(os.path.join(folder, "b.csv"), "b,a\n", [("20", "10")] * 50)
    for path in (folder, f"{folder}/*.csv"):
        with pytest.raises(ValueError, match="headers differ"):
            scan_csv(spark, path)
        got = {(r.a, r.b) for r in scan_csv(spark, path, by_name=True).collect()}
        assert got == {("1", "2"), ("10", "20")}


def test_probe_threads_bounded(spark):
    from tidewater.sources.files import HEADER_PROBE_MAX_THREADS, HEADER_PROBE_THREADS, probe_threads

    assert probe_threads(spark, 1) == 1
    assert probe_threads(spark, 3) == 3
    assert HEADER_PROBE_THREADS <= probe_threads(spark, 10_000) <= HEADER_PROBE_MAX_THREADS


def test_names_with_glob_characters_are_literal(spark, tmp):
    names = ["a[1].csv", "a1.csv", "b{x}.csv", "bx.csv", "c*.csv", "cc.csv", "d?.csv", "dd.csv", "e f%20.csv"]
    for i, name in enumerate(names):
        _write(os.path.join(tmp, name), "x,y\n", [(str(i), name)])
    for i, name in enumerate(names):
        assert [tuple(r) for r in scan_csv(spark, os.path.join(tmp, name)).collect()] == [(str(i), name)]
    assert sorted(r.y for r in scan_csv(spark, tmp).collect()) == sorted(names)
    assert sorted(r.y for r in scan_csv(spark, f"{tmp}/a*.csv").collect()) == ["a1.csv", "a[1].csv"]
    _write(os.path.join(tmp, "z[2].csv"), "y,x\n", [("other", "99")])
    with pytest.raises(ValueError, match="headers differ"):
        scan_csv(spark, tmp)
    got = {(r.x, r.y) for r in scan_csv(spark, tmp, by_name=True).collect()}
    assert got == {*((str(i), n) for i, n in enumerate(names)), ("99", "other")}
    folder = os.path.join(tmp, "in[1]")
    os.makedirs(folder)
    _write(os.path.join(folder, "q.csv"), "x,y\n", [("7", "inner")])
    assert [r.y for r in scan_csv(spark, folder).collect()] == ["inner"]


def test_many_headers_are_one_scan(spark, tmp, capsys):
    import random

    rng = random.Random(6)
    expected = []
    for i in range(30):
        columns = rng.sample(["a", "b", "c", "d"], rng.randint(1, 4)) + ([f"only {i}"] if i % 10 == 0 else [])
        columns = [c.upper() if i % 2 else c for c in columns]
        rows = [{c: f"{c}{i}-{k}" for c in columns} for k in range(3)]
        expected += [{c.lower(): v for c, v in r.items()} for r in rows]
        _write(os.path.join(tmp, f"{i:02d}.csv"), ",".join(columns) + "\n", [tuple(r.values()) for r in rows])
    open(os.path.join(tmp, "empty.csv"), "w").close()
    df = scan_csv(spark, tmp, by_name=True)
    df.explain()
    plan = capsys.readouterr().out
    assert plan.count("FileScan csv") == 1 and "Union" not in plan and "BroadcastHashJoin" in plan
    got = [{c.lower(): v for c, v in r.asDict().items() if v is not None} for r in df.collect()]
    key = lambda r: sorted(r.items())
    assert sorted(got, key=key) == sorted(expected, key=key)
    # rows longer or shorter than their file's header
    _write(os.path.join(tmp, "wide.csv"), "a,b\n", [("1", "2", "3", "4"), ("5",)])
    rows = [tuple(r) for r in scan_csv(spark, tmp, by_name=True).where("a IN ('1', '5')").select("a", "b", "c").collect()]
    assert sorted(rows, key=str) == [("1", "2", None), ("5", None, None)]
    assert scan_csv(spark, [os.path.join(tmp, "0*.csv")], by_name=True).count() == 30


def test_stores_without_a_client_are_probed_by_spark(spark, tmp, monkeypatch):
    from tidewater.sources import files

    a, b = os.path.join(tmp, "a[1].csv"), os.path.join(tmp, "b.csv")
    _write(a, "x,y\n", [("1", "2")])
    _write(b, "y,x\n", [("20", "10")])
    monkeypatch.setattr(files, "first_lines", lambda batches: (x.assign(line=None)[["file", "path", "line"]] for x in batches))
    with pytest.warns(UserWarning, match="Spark job each"):
        got = {(r.x, r.y) for r in scan_csv(spark, [a, b], by_name=True).collect()}
    assert got == {("1", "2"), ("10", "20")}


def test_a_broken_header_job_is_not_swallowed(spark, tmp, monkeypatch):
    from tidewater.sources import files

    _write(os.path.join(tmp, "a.csv"), "x,y\n", [("1", "2")])
    monkeypatch.setattr(files, "first_lines", lambda batches: (1 / 0 for x in batches))
    with pytest.raises(Exception, match="division by zero"):
        scan_csv(spark, tmp)
