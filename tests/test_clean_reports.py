"""Cleaning, reports, and the text forms, on literal windows."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.functions.text import fixed2_sql
from eventide.operators import clean, reports
from eventide.schemas import WINDOW
from eventide.sources import windows as store

START = dt.datetime(2024, 1, 1, 14, 0, 0)
NUMBERED = T.StructType([*WINDOW.fields, T.StructField("seq", T.LongType())])


def window(total, users, start=START, minutes=10, seq=0, avg=100.0, counts=None):
    return (
        start,
        start + dt.timedelta(minutes=minutes),
        total,
        counts if counts is not None else ({"click": total} if total else {}),
        users,
        avg,
        [("/", total)] if total else [],
        seq,
    )


def frame(spark, *rows):
    return spark.createDataFrame(rows, NUMBERED)


def later(minutes):
    return START + dt.timedelta(minutes=minutes)


def test_dedup_keeps_the_first(spark):
    df = frame(spark, window(5, 2, seq=1), window(10, 3, seq=2))
    rows = clean.clean_windows(df).collect()
    assert [r.total_events for r in rows] == [5]


def test_dedup_of_many_copies(spark):
    copies = spark.range(5000).select(
        F.lit(START).alias("window_start"),
        F.lit(later(10)).alias("window_end"),
        (F.col("id") + 7).alias("total_events"),
        F.lit("{}").alias("event_counts"),
        F.lit(1).alias("unique_users"),
        F.lit(1.0).alias("avg_duration_ms"),
        F.col("id").alias("seq"),
    )
    rows = clean.clean_windows(copies.repartition(6)).collect()
    assert [r.total_events for r in rows] == [7]


def test_zero_windows_are_dropped(spark):
    df = frame(spark, window(0, 0), window(5, 2, later(10)))
    assert [r.total_events for r in clean.clean_windows(df).collect()] == [5]


def test_empty_first_copy_removes_the_window(spark):
    df = frame(spark, window(0, 0, seq=-1), window(5, 2, seq=0))
    assert clean.clean_windows(df).count() == 0


def test_rate_and_span(spark):
    row = clean.clean_windows(frame(spark, window(10, 3))).first()
    assert row.window_duration_sec == 600.0
    assert row.events_per_second == pytest.approx(10 / 600)
    assert row.event_counts == '{"click":10}'
    assert list(row.asDict()) == clean.CLEAN_COLUMNS


def test_window_without_extent_has_rate_zero(spark):
    row = clean.clean_windows(frame(spark, window(10, 3, minutes=0))).first()
    assert (row.window_duration_sec, row.events_per_second) == (0.0, 0.0)


def test_bounds_are_cut_to_milliseconds_after_dedup(spark):
    a = START + dt.timedelta(microseconds=1500)
    b = START + dt.timedelta(microseconds=1700)
    rows = clean.clean_windows(frame(spark, window(1, 1, a), window(2, 1, b))).collect()
    assert {r.window_start for r in rows} == {START + dt.timedelta(milliseconds=1)}
    assert len(rows) == 2


def test_audit(spark):
    df = frame(spark, window(5, 2), window(6, 2, seq=1), window(0, 0, later(10)))
    audit = clean.cleaning_audit(df)
    got = [(r.step, r.rows_before, r.rows_after) for r in audit.orderBy("step").collect()]
    assert got == [(1, 3, 3), (2, 3, 2), (3, 2, 1), (4, 1, 1), (5, 1, 1), (6, 1, 1)]
    lines = [r.line for r in clean.audit_lines(audit).orderBy("line_no").collect()]
    assert lines[1] == "Шаг 2: Удаление дубликатов (было 3 строк → стало 2 строк)"
    assert lines[6] == "Итого: финальный DataFrame содержит 1 строк, 8 колонок"


def test_audit_of_nothing(spark):
    rows = clean.cleaning_audit(frame(spark)).collect()
    assert [(r.rows_before, r.rows_after) for r in rows] == [(0, 0)] * 6


def test_hourly_rollup(spark):
    df = frame(spark, window(5, 2), window(3, 1, later(30), avg=300.0))
    rows = reports.hourly_rollup(clean.clean_windows(df)).collect()
    assert [tuple(r) for r in rows] == [(START, 8, 200.0, 3, 2)]


def test_hourly_report_median_and_order(spark):
    df = frame(
        spark,
        window(1, 1, avg=10.0),
        window(1, 1, later(10), avg=20.0),
        window(1, 1, later(20), avg=90.0),
        window(0, 0, later(30), avg=1000.0),
        window(9, 1, later(60), avg=5.0),
    )
    rows = reports.hourly_report(df).collect()
    assert [(r.total_events, r.median_duration) for r in rows] == [(9, 5.0), (3, 20.0)]


def test_hourly_totals_as_sql_and_as_frames(spark):
    df = frame(spark, window(5, 2), window(3, 1, later(30), avg=300.0), window(9, 1, later(60)))
    as_sql = reports.hourly_totals_sql(spark, df).collect()
    assert as_sql == reports.hourly_totals(df).collect()
    assert [r.total_events for r in as_sql] == [9, 8]


def test_summary_and_peak(spark):
    df = frame(spark, window(10, 2), window(20, 3, seq=1))
    assert tuple(reports.analysis_summary(df).first()) == (2, 30, 15.0)
    assert reports.peak_window(df).first().total_events == 20


def test_analysis_result(spark):
    df = frame(
        spark,
        window(10, 2, counts={"click": 4, "login": 6}),
        window(20, 3, later(10), counts={"click": 20}),
    )
    for windows in (df, store.to_at_rest(df)):
        row = reports.analysis_result(windows, "2024-02-01T00:00:00Z").first()
        assert (row.total_windows, row.total_events, row.avg_events_per_window) == (2, 30, 15.0)
        assert row.peak_window.window_start == later(10)
        assert row.event_distribution == {"click": 24, "login": 6}
        assert row.generated_at == dt.datetime(2024, 2, 1)
    row = reports.analysis_result(frame(spark), "2024-02-01T00:00:00Z").first()
    assert (row.total_windows, row.peak_window, row.event_distribution) == (0, None, {})


def test_peak_takes_the_earliest_of_equals(spark):
    df = frame(spark, window(20, 1, later(10)), window(20, 1))
    assert reports.peak_window(df).first().window_start == START


def test_reports_of_nothing(spark):
    df = frame(spark)
    assert tuple(reports.analysis_summary(df).first()) == (0, 0, 0.0)
    assert tuple(reports.kpi_metrics(df).first()) == (0, 0, 0.0, 0)
    assert reports.peak_window(df).count() == 0
    assert reports.duration_histogram(df).count() == 0
    stored = store.to_at_rest(df)
    assert reports.event_type_shares(stored).count() == 0
    assert reports.page_shares(stored).count() == 0
    assert reports.users_heatmap(df).agg(F.count("*"), F.sum("unique_users")).first()[:] == (168, 0)


def test_distribution_skips_unreadable_json(spark):
    rows = [('{"click":2,"login":1}',), (None,), ("",), ("{broken",), ("{}",), ('{"click":3}',)]
    df = spark.createDataFrame(rows, "event_counts string")
    got = [tuple(r) for r in reports.event_distribution_json(df).collect()]
    assert got == [("click", 5), ("login", 1)]
    ascending = reports.event_distribution_filtered(df, ["click", "login"]).collect()
    assert [r.event_type for r in ascending] == ["login", "click"]
    assert [r.event_type for r in reports.event_distribution_filtered(df, ["login"]).collect()] == [
        "login"
    ]


def test_distribution_filter_defaults_to_known_types(spark):
    df = spark.createDataFrame([('{"click":2,"error":9}',)], "event_counts string")
    assert [r.event_type for r in reports.event_distribution_filtered(df).collect()] == ["click"]


def test_page_totals_and_shares(spark):
    rows = [
        ('[{"page":"/","count":3},{"page":"/a","count":1}]',),
        (None,),
        ("nonsense",),
        ('[{"page":"/","count":1}]',),
    ]
    df = spark.createDataFrame(rows, "top_pages string")
    assert [tuple(r) for r in reports.page_totals(df).collect()] == [("/", 4), ("/a", 1)]
    assert [tuple(r) for r in reports.page_shares(df).collect()] == [("/", 4, 0.8), ("/a", 1, 0.2)]
    assert [r.page for r in reports.top_pages(df, 1).collect()] == ["/"]


def test_heatmap(spark):
    sunday = dt.datetime(2024, 1, 7, 23, 30)
    df = frame(spark, window(5, 2), window(3, 4, later(30)), window(1, 1, sunday))
    cells = {
        (r.day_idx, r.hour): r.unique_users
        for r in reports.users_heatmap(df).collect()
        if r.unique_users
    }
    assert cells == {(0, 14): 6, (6, 23): 1}
    pivot = reports.users_heatmap_pivot(df).collect()
    assert len(pivot) == 24
    assert (pivot[14].d0, pivot[23].d6, pivot[0].d3) == (6, 1, 0)


def test_histogram(spark):
    df = frame(spark, *[window(1, 1, later(10 * i), avg=float(a)) for i, a in enumerate((0, 39, 40, 10))])
    rows = reports.duration_histogram(df).collect()
    assert [(r.bin, r.lo, r.hi, r.n) for r in rows] == [
        (0, 0.0, 1.0, 1),
        (10, 10.0, 11.0, 1),
        (39, 39.0, 40.0, 2),
    ]
    assert rows[0].mean == pytest.approx(89 / 4)
    same = frame(spark, window(1, 1), window(1, 1, later(10)))
    assert [(r.bin, r.n) for r in reports.duration_histogram(same).collect()] == [(0, 2)]


@pytest.mark.parametrize(
    "values",
    [(0.0, 39.0, 40.0, 10.0), (0.0, 39.9), (100.0, 300.5, 180.25), (0.0012, 0.0013, 0.00125), (-7.5, 7.5), (99.99, 100.0), (1e6, 9e7)],
)
def test_round_histogram_equals_a_search(spark, values):
    """The step is the smallest of the series with at most 40 bins; every window is in its bin."""
    df = frame(spark, *[window(1, 1, later(10 * i), avg=a) for i, a in enumerate(values)])
    got = reports.round_histogram(df).collect()
    series = sorted(float(f"{m}e{e}") for m in (1, 2, 5) for e in range(-9, 10))
    step = next(s for s in series if math.floor(max(values) / s) - math.floor(min(values) / s) < 40)
    assert {r.step for r in got} == {step}
    bins = [math.floor(a / step) for a in values]
    assert [(r.bin, r.n) for r in got] == [(b, bins.count(b)) for b in sorted(set(bins))]
    assert all(r.lo == pytest.approx(r.bin * step) and r.hi == pytest.approx((r.bin + 1) * step) for r in got)


def test_round_histogram_of_equal_null_and_no_values(spark):
    same = frame(spark, window(1, 1, avg=2.5), window(1, 1, later(10), avg=2.5), window(1, 1, later(20), avg=None))
    assert [(r.bin, r.n, r.step) for r in reports.round_histogram(same).collect()] == [(2, 2, 1.0)]
    assert reports.round_histogram(same.limit(0)).count() == 0


def test_date_range_is_inclusive(spark):
    day = dt.datetime(2024, 1, 2)
    last = dt.datetime(2024, 1, 3, 23, 59, 59, 999999)
    out = dt.datetime(2024, 1, 4)
    df = frame(spark, window(1, 1), window(2, 1, day), window(3, 1, last), window(4, 1, out))
    got = reports.date_range(df, "2024-01-02", "2024-01-03").collect()
    assert sorted(r.total_events for r in got) == [2, 3]


def test_performance_table(spark):
    df = frame(spark, window(1, 1, avg=1.239), window(2, 1, later(10)))
    rows = reports.performance_table(df).collect()
    assert [r.total_events for r in rows] == [2, 1]
    assert rows[1].avg_duration_ms == 1.24
    assert reports.performance_table(df, reports.PERFORMANCE_HEADERS).columns == list(
        reports.PERFORMANCE_HEADERS.values()
    )


def test_fixed2_rounds_the_exact_value(spark):
    values = [0.125, 0.375, 1.005, 2.675, 1234567.891, -0.125, 0.0, 1e15]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r.t for r in df.select(F.expr(fixed2_sql("v")).alias("t")).collect()]
    assert got == ["%.2f" % v for v in values]
