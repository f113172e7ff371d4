"""Stored windows: layout, evolution, pruning, exchange and log forms."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from eventide.operators import reports
from eventide.schemas import WINDOW, WINDOW_AT_REST
from eventide.sources import windows as store

START = dt.datetime(2024, 1, 1, 14, 0, 0, 1500)


@pytest.fixture(scope="module")
def windows(spark):
    rows = [
        (START, START + dt.timedelta(seconds=10), 3, {"click": 2, "login": 1}, 2, 1.125, [("/", 3)]),
        (START + dt.timedelta(days=1), START + dt.timedelta(days=1, seconds=10), 0, {}, 0, 0.0, []),
    ]
    return spark.createDataFrame(rows, WINDOW)


def test_at_rest_form(windows):
    row = store.to_at_rest(windows).orderBy("window_start").first()
    assert json.loads(row.event_counts) == {"click": 2, "login": 1}
    assert json.loads(row.top_pages) == [{"page": "/", "count": 3}]
    assert row.window_start.microsecond == 1000


def test_write_and_load(spark, windows, tmp_path):
    path = str(tmp_path / "w")
    store.write_windows(windows, path, "r1")
    store.write_windows(windows, path, "r2")
    store.write_windows(windows, path, "r2")  # a repeated run replaces itself
    loaded = store.load_windows(spark, path)
    assert loaded.count() == 4
    first = loaded.orderBy("window_start").first()
    assert (first.event_counts, [tuple(p) for p in first.top_pages]) == (
        {"click": 2, "login": 1},
        [("/", 3)],
    )


def test_null_and_empty_json_give_empty_collections(spark):
    rows = [(START, START, 1, 1, 1.0, None, None), (START, START, 1, 1, 1.0, "", "")]
    for row in store.from_at_rest(spark.createDataFrame(rows, WINDOW_AT_REST)).collect():
        assert (row.top_pages, row.event_counts) == ([], {})


def test_empty_run_reads_as_typed_empty_table(spark, windows, tmp_path):
    path = str(tmp_path / "w")
    store.write_windows(windows.limit(0), path, "r1")
    empty = store.scan_windows(spark, path)
    assert empty.schema == WINDOW_AT_REST
    assert empty.count() == 0


def test_older_files_in_the_same_folder(spark, windows, tmp_path):
    path = str(tmp_path / "w")
    stored = store.to_at_rest(windows)
    stored.write.parquet(f"{path}/new")
    old = stored.drop("event_counts").withColumn("total_events", F.col("total_events").cast("int"))
    old.write.parquet(f"{path}/old")
    both = store.scan_windows(spark, path)
    assert dict(both.dtypes)["total_events"] == "bigint"
    assert both.count() == 4
    assert both.filter("event_counts IS NULL").count() == 2


def test_union_by_name(spark, windows):
    stored = store.to_at_rest(windows)
    old = stored.drop("event_counts").withColumn("total_events", F.col("total_events").cast("int"))
    both = store.union_windows(stored, old, stored.withColumn("extra", F.lit(1)))
    assert dict(both.dtypes)["total_events"] == "bigint"
    assert (both.count(), both.filter("event_counts IS NULL").count()) == (6, 2)
    assert both.filter("extra = 1").count() == 2


def test_date_range_prunes_days_and_pushes_bounds(spark, windows, tmp_path):
    path = str(tmp_path / "w")
    store.write_windows(windows, path, "r1")
    stored = store.scan_windows(spark, path, {"run_id": "string", "window_date": "date"})
    selected = reports.date_range(stored, "2024-01-02", "2024-01-05").select("total_events")
    assert [r.total_events for r in selected.collect()] == [0]
    plan = selected._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(window_date" in plan
    assert "GreaterThanOrEqual(window_start" in plan
    assert "LessThan(window" in plan  # the plan text cuts long lists short


def test_export_and_import(windows):
    exported = store.export_windows(windows)
    assert exported.columns == [
        "window_start",
        "window_end",
        "total_events",
        "unique_users",
        "avg_duration_ms",
    ]
    row = store.import_windows(exported).orderBy("window_start").first()
    assert (row.total_events, row.event_counts, row.top_pages) == (3, {}, [])
    assert row.window_start.microsecond == 1000


def test_log_lines(spark, windows, tmp_path):
    line = store.window_log_lines(windows, "2024-02-01T00:00:00Z").orderBy("window_start").first()
    assert line.line == (
        '{"avg_duration":"1.12","level":"INFO","msg":"window aggregated","total_events":3,'
        '"ts":"2024-02-01T00:00:00Z","unique_users":2,"window_end":"2024-01-01T14:00:10Z",'
        '"window_start":"2024-01-01T14:00:00Z"}'
    )
    store.write_log_lines(windows, str(tmp_path / "log"), "2024-02-01T00:00:00Z")
    assert spark.read.text(str(tmp_path / "log")).count() == 2


def test_folders_of_different_layouts(spark, tmp_path):
    rows = [(5, "a"), (7, "b")]
    spark.createDataFrame(rows, "total_events int, window_start string").write.parquet(str(tmp_path / "int"))
    fractional = [(5.0, "a"), (7.0, "b")]
    spark.createDataFrame(fractional, "total_events double, window_start string").write.parquet(str(tmp_path / "double"))
    wide = spark.createDataFrame([(9, "c", 1)], "total_events bigint, window_start string, extra int")
    wide.write.parquet(str(tmp_path / "wide"))
    folders = [str(tmp_path / n) for n in ("wide", "int", "absent", "double")]
    got = store.scan_folders(spark, *folders)
    assert dict(got.dtypes)["total_events"] == "double"
    assert [r.window_start for r in got.collect()] == ["a", "a", "b", "b", "c"]
    assert [r.extra for r in got.collect()] == [None] * 4 + [1]
    assert store.scan_folders(spark, str(tmp_path / "absent")).count() == 0
