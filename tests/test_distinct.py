"""Distinct users by bitmaps against the exact count of the events."""

import datetime as dt
import random

from pyspark.sql import functions as F

from eventide.operators import distinct

BASE = dt.datetime(2024, 1, 1)


def frame(spark, rows):
    return spark.createDataFrame(rows, "user_id string, timestamp timestamp")


def counted(df, span):
    return {tuple(r) for r in df.groupBy(F.date_trunc(span, "timestamp")).agg(F.count_distinct(F.coalesce("user_id", F.lit("")))).collect()}


def by_bitmaps(spark, path, span, days=None):
    found = distinct.users_per(distinct.read_bitmaps(spark, path, days), F.date_trunc(span, "window_start"))
    return {tuple(r) for r in found.collect()}


def test_spans_equal_the_exact_count(spark, tmp_path):
    rng = random.Random(3)
    names = ["", None, "busy", *(f"u{i}" for i in range(400))]
    runs = []
    for k in range(3):
        rows = [(rng.choice(names), BASE + dt.timedelta(minutes=rng.randrange(9000))) for _ in range(1500)]
        rows += [("busy", BASE + dt.timedelta(seconds=i)) for i in range(500)] + [("undated", None)]
        runs.append(rows)
        distinct.add_run(frame(spark, rows), str(tmp_path), f"run-{k}")
    everything = frame(spark, [r for rows in runs for r in rows if r[1]]).cache()
    numbers = {r.user_id: r.number for r in distinct.read_users(spark, str(tmp_path)).collect()}
    assert len(set(numbers.values())) == len(numbers) and min(numbers.values()) >= 1
    for span in ("hour", "day", "month"):
        assert by_bitmaps(spark, str(tmp_path), span) == counted(everything, span)
    # A run that is repeated changes neither numbers nor counts.
    distinct.add_run(frame(spark, runs[0]), str(tmp_path), "run-0")
    assert {r.user_id: r.number for r in distinct.read_users(spark, str(tmp_path)).collect()} == numbers
    assert by_bitmaps(spark, str(tmp_path), "day") == counted(everything, "day")
    assert "undated" not in numbers
    one_day = {r for r in counted(everything, "day") if r[0] == BASE + dt.timedelta(days=1)}
    assert by_bitmaps(spark, str(tmp_path), "day", ("2024-01-02", "2024-01-02")) == one_day


def test_stored_size_follows_windows_and_blocks(spark, tmp_path):
    """Ten times the events of the same users store no further row; more users than a block
    holds take a second one."""
    users = spark.range(40_000).select(F.concat(F.lit("u"), "id").alias("user_id"))
    events = users.withColumn("timestamp", F.lit(BASE).cast("timestamp"))
    distinct.add_run(events.withColumn("_", F.explode(F.sequence(F.lit(1), F.lit(10)))), str(tmp_path), "r")
    stored = distinct.read_bitmaps(spark, str(tmp_path))
    blocks = stored.count()
    top = distinct.read_users(spark, str(tmp_path)).agg(F.max("number")).first()[0]
    assert 2 <= blocks <= -(-top // 32_768)
    # Users fall evenly on the shards, so numbers stay close.
    assert top < 4 * 40_000
    assert by_bitmaps(spark, str(tmp_path), "day") == {(BASE, 40_000)}


def test_shards_go_on_where_they_ended(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(distinct, "SHARDS", 2)
    for k in range(3):
        rows = [(f"u{i}", BASE) for i in range(5 * k, 5 * k + 7)]
        distinct.add_run(frame(spark, rows), str(tmp_path), f"r{k}")
    numbers = [r.number for r in distinct.read_users(spark, str(tmp_path)).collect()]
    assert len(numbers) == len(set(numbers)) == 17
    assert by_bitmaps(spark, str(tmp_path), "day") == {(BASE, 17)}


def test_no_events(spark, tmp_path):
    distinct.add_run(frame(spark, [("u", None)]), str(tmp_path), "r")
    assert by_bitmaps(spark, str(tmp_path), "day") == set()
