"""Window aggregation on literal rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventide.operators import windows as win
from eventide.schemas import CELL, USER_EVENT
from eventide.sources import testdata as data

BASE = dt.datetime(2024, 1, 1, 14, 0, 0)
SF = "/root/testdata/sf0.001"


def event(i, user="user-1", page="/", kind="click", duration=100.0, at=None):
    time = at or BASE + dt.timedelta(milliseconds=i)
    return (f"e{i}", user, "s", kind, page, duration, None, time)


def one_window(spark, rows):
    df = spark.createDataFrame(rows, USER_EVENT)
    result = win.window_aggregate(df, "10 seconds").collect()
    assert len(result) == 1
    return result[0]


def test_total(spark):
    assert one_window(spark, [event(i) for i in range(3)]).total_events == 3


def test_unique_users(spark):
    users = ["user-1", "user-1", "user-2", "user-2", "user-3"]
    assert one_window(spark, [event(i, u) for i, u in enumerate(users)]).unique_users == 3


def test_event_counts_take_any_type(spark):
    kinds = ["click"] * 2 + ["page_view"] * 3 + ["purchase"] + ["other"]
    row = one_window(spark, [event(i, kind=k) for i, k in enumerate(kinds)])
    assert row.event_counts == {"click": 2, "page_view": 3, "purchase": 1, "other": 1}


def test_parts_can_be_asked_for_alone(spark):
    events = data.user_events(spark, SF)
    whole = win.window_aggregate(events, "1 hour")
    for part, columns in (
        ("totals", ["total_events", "unique_users"]),
        ("event_counts", ["event_counts"]),
        ("top_pages", ["top_pages"]),
    ):
        alone = win.window_aggregate(events, "1 hour", parts=[part])
        assert set(columns) < set(alone.columns)
        shown = ["window_start", "window_end", *columns]

        def rows(df, shown=shown):
            return sorted(map(str, df.select(*shown).collect()))

        assert rows(alone) == rows(whole)


def test_top_pages_order_and_limit(spark):
    pages = ["/"] * 5 + ["/catalog"] * 3 + ["/b", "/a", "/d", "/c"]
    row = one_window(spark, [event(i, page=p) for i, p in enumerate(pages)])
    assert [tuple(p) for p in row.top_pages] == [
        ("/", 5),
        ("/catalog", 3),
        ("/a", 1),
        ("/b", 1),
        ("/c", 1),
    ]


def test_average(spark):
    row = one_window(spark, [event(i, duration=d) for i, d in enumerate([100.0, 200.0, 300.0])])
    assert row.avg_duration_ms == pytest.approx(200.0, abs=0.001)


def test_short_window_holds_all_events(spark):
    df = spark.createDataFrame([event(i) for i in range(10)], USER_EVENT)
    assert win.window_aggregate(df, "100 milliseconds").first().total_events == 10


def test_null_fields_count_as_zero_values(spark):
    row = one_window(spark, [event(0), event(1, None, None, None, None)])
    assert row.unique_users == 2
    assert row.event_counts == {"": 1, "click": 1}
    assert row.avg_duration_ms == 50.0


def test_events_without_time_have_no_window(spark):
    rows = [event(0), ("e9", "u", "s", "click", "/", 1.0, None, None)]
    assert one_window(spark, rows).total_events == 1
    left_out = win.without_window(spark.createDataFrame(rows, USER_EVENT)).collect()
    assert [r.id for r in left_out] == ["e9"]


def test_offset_moves_the_grid(spark):
    df = spark.createDataFrame([event(0)], USER_EVENT)
    row = win.window_aggregate(df, "10 seconds", offset="3 seconds").first()
    assert row.window_start == BASE - dt.timedelta(seconds=7)
    assert row.window_end - row.window_start == dt.timedelta(seconds=10)


def test_arrival_time_column(spark):
    df = spark.createDataFrame([event(0), event(1)], USER_EVENT).withColumn(
        "arrival", F.lit("2024-06-01 00:00:05").cast("timestamp")
    )
    row = win.window_aggregate(df, time_col="arrival").first()
    assert row.window_start == dt.datetime(2024, 6, 1)
    assert row.total_events == 2


def test_rollup_of_split_cells_equals_direct_aggregate(spark):
    events = data.user_events(spark, SF)
    parts = [
        win.window_cells(events.filter(F.col("id").cast("bigint") % 3 == i), "1 hour")
        for i in range(3)
    ]
    cells = parts[0].unionByName(parts[1]).unionByName(parts[2])
    assert [f.name for f in cells.schema] == CELL.names

    def rows(df):
        flat = df.withColumn("avg_duration_ms", F.round("avg_duration_ms", 6)).withColumn(
            "event_counts", F.to_json("event_counts")
        )
        return sorted(map(str, flat.collect()))

    direct = rows(win.window_aggregate(events, "1 hour"))
    assert rows(win.rollup(cells, "1 hour")) == direct
    assert rows(win.rollup(win.merge_cells(cells), "1 hour")) == direct


def test_zero_fill(spark):
    late = BASE + dt.timedelta(seconds=30)
    df = spark.createDataFrame([event(0), event(1, at=late)], USER_EVENT)
    filled = win.zero_fill(win.window_aggregate(df, "10 seconds"), "10 seconds")
    rows = filled.orderBy("window_start").collect()
    assert [r.total_events for r in rows] == [1, 0, 0, 1]
    assert (rows[1].avg_duration_ms, rows[1].unique_users) == (0.0, 0)
    assert (rows[1].event_counts, rows[1].top_pages) == ({}, [])


def test_zero_fill_crosses_chunks(spark):
    late = BASE + dt.timedelta(seconds=9000)
    df = spark.createDataFrame([event(0), event(1, at=late)], USER_EVENT)
    assigned = win.assign_windows(df, "1 second")
    filled = win.zero_fill(win.with_end(win.window_totals(assigned), "1 second"), "1 second")
    assert filled.count() == 9001
    assert filled.select("window_start").distinct().count() == 9001
    assert filled.agg(F.sum("total_events")).first()[0] == 2


def test_zero_fill_of_nothing(spark):
    df = spark.createDataFrame([], USER_EVENT)
    assert win.zero_fill(win.window_aggregate(df), "10 seconds").count() == 0


def test_one_busy_window_gives_exact_results(spark):
    """A window with a third of all events, and far more pages than are kept."""
    n = 30000
    events = spark.range(n).select(
        F.col("id").cast("string").alias("id"),
        F.concat(F.lit("u"), F.col("id") % 7000).alias("user_id"),
        F.lit("s").alias("session_id"),
        F.lit("click").alias("event_type"),
        F.concat(F.lit("/p"), F.pmod(F.col("id"), F.lit(4999))).alias("page"),
        F.lit(1.0).alias("duration_ms"),
        F.when(F.col("id") % 3 == 0, F.timestamp_seconds(F.lit(0)))
        .otherwise(F.timestamp_seconds(F.col("id") * 10))
        .alias("timestamp"),
    )
    row = win.window_aggregate(events).filter("window_start = timestamp_seconds(0)").first()
    ids = range(0, n, 3)
    pages = {}
    for i in ids:
        pages[f"/p{i % 4999}"] = pages.get(f"/p{i % 4999}", 0) + 1
    assert row.total_events == len(ids)
    assert row.unique_users == len({i % 7000 for i in ids})
    best = sorted(pages.items(), key=lambda kv: (-kv[1], kv[0]))[:5]
    assert [tuple(p) for p in row.top_pages] == best


def test_zero_fill_keeps_windows_off_the_grid(spark):
    def at(minute):
        return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute)

    rows = [(at(m), at(m + 10), n) for m, n in ((0, 5), (7, 9), (20, 2), (55, 1))]
    windows = spark.createDataFrame(
        rows, "window_start timestamp, window_end timestamp, total_events bigint"
    )
    filled = win.zero_fill(windows, "10 minutes").orderBy("window_start").collect()
    assert [(r.window_start.minute, r.total_events) for r in filled] == [
        (0, 5), (7, 9), (20, 2), (30, 0), (40, 0), (55, 1)
    ]
    assert win.zero_fill(windows.limit(0), "10 minutes").collect() == []
