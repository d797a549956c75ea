"""Sources and sinks on the smallest driver tables."""

import os

from interlog.sources import fixture, io
from tests.conftest import SMALL


def test_table_sizes_equal_file_sizes(spark):
    names = ["events", "region"]
    for n in names:
        fixture.read(spark, SMALL, n).createOrReplaceTempView(f"t_{n}")
    got = {r.table_name: (r.n_files, r.size_bytes) for r in io.table_sizes(spark, [f"t_{n}" for n in names]).collect()}
    assert got == {f"t_{n}": (1, os.path.getsize(f"{SMALL}/{n}.parquet")) for n in names}


def test_export_reuses_same_plan(spark, tmp_path):
    df = fixture.read(spark, SMALL, "region")
    p1 = io.export_query(df, str(tmp_path), "csv")
    p2 = io.export_query(fixture.read(spark, SMALL, "region"), str(tmp_path), "csv")
    assert p1 == p2 and io.read_exported(spark, p1, "csv", "r_regionkey int, r_name string").count() == df.count()


def test_export_keeps_formats_and_failed_writes_apart(spark, tmp_path):
    df = fixture.read(spark, SMALL, "region")
    p1, p2 = (io.export_query(df, str(tmp_path), f) for f in ("csv", "json"))
    p3 = io.export_query(df, str(tmp_path), "csv", header=False)
    assert len({p1, p2, p3}) == 3
    assert io.read_exported(spark, p2, "json", "r_regionkey int, r_name string").count() == df.count()
    os.remove(f"{p1}/_SUCCESS")                      # as a failed job leaves it
    for f in os.listdir(p1):
        if f.startswith("part-"):
            os.remove(f"{p1}/{f}")
    assert io.read_exported(spark, io.export_query(df, str(tmp_path), "csv"), "csv", "r_regionkey int, r_name string").count() == df.count()


def test_typed_snapshot_reports_failed_casts(spark, tmp_path):
    df = spark.createDataFrame([(1, "7"), (2, "x")], "a long, b string")
    snap, failed = io.typed_snapshot(df, str(tmp_path / "s"), {"a": "int16"}, default="int")
    assert failed == ["b"] and dict(snap.dtypes) == {"a": "smallint", "b": "string"}
