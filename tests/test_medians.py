"""Exact medians without a buffer of a group's values."""

import random
from statistics import median

import pytest
from pyspark.sql import functions as F

from eventide.operators import reports
from eventide.sources import testdata as data

SF = "/root/testdata/sf0.001"


def check(spark, groups):
    rows = [(k, v) for k, values in groups.items() for v in values]
    df = spark.createDataFrame(rows, "k string, v double").repartition(7)
    got = {r.k: r.median for r in reports.exact_medians(df, "k", "v").collect()}
    expected = {k: [v for v in values if v is not None] for k, values in groups.items()}
    assert got == {k: pytest.approx(median(v), abs=1e-9) for k, v in expected.items() if v}


def test_small_groups(spark):
    check(spark, {"one": [3.0], "two": [1.0, 2.0], "three": [5.0, -1.0, 2.0], "null": [None], "some": [None, 4.0, 1.0], "same": [2.0] * 9})


@pytest.mark.parametrize("seed", range(3))
def test_many_values(spark, seed):
    rng = random.Random(seed)
    groups = {
        "spread": [rng.random() * 1e6 for _ in range(20_001)],
        "skewed": [rng.paretovariate(0.3) for _ in range(9_000)],
        "ties": [float(rng.randint(0, 4)) for _ in range(10_000)],
        "halves": [0.0] * 5000 + [1.0] * 5000,
        "few": [rng.gauss(0, 1) for _ in range(rng.randint(1, 50))],
    }
    check(spark, groups)


def test_a_hot_hour(spark):
    """One hour with nearly all windows: between the sketch and the middle few values are left."""
    n = 200_000
    windows = spark.range(n).select(
        F.timestamp_seconds(F.when(F.col("id") % 100 == 0, 7200).otherwise(3600) + F.col("id") % 3600).alias("window_start"),
        F.lit(1).cast("long").alias("total_events"),
        F.lit(1).cast("long").alias("unique_users"),
        (F.pmod(F.xxhash64("id"), F.lit(10**9)) / 1000).alias("avg_duration_ms"),
    )
    got = {r.hour: r.median_duration for r in reports.hourly_report(windows).collect()}
    hours = {}
    for r in windows.select(F.date_trunc("hour", "window_start").alias("hour"), "avg_duration_ms").collect():
        hours.setdefault(r.hour, []).append(r.avg_duration_ms)
    assert got == {h: pytest.approx(median(v), abs=1e-9) for h, v in hours.items()}


def test_no_buffer_in_the_plan(spark):
    plan = reports.hourly_report(data.scalar_windows(spark, SF))._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile_cont" not in plan and "collect" not in plan
    assert "percentile_approx" in plan
