"""Late rows of a stream: kept with a reason, and counted in corrected windows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventide.operators import windows as win
from eventide.schemas import USER_EVENT
from eventide.sources import testdata as data
from eventide.sources import windows as store
from eventide.streaming import corrections

SF = "/root/testdata/sf0.001"
DAY = dt.datetime(2024, 1, 1)


def at(spark, *minutes):
    rows = [(str(m), f"u{m % 3}", "s", "click", "/", 1.0, None, DAY + dt.timedelta(minutes=m)) for m in minutes]
    return spark.createDataFrame(rows, USER_EVENT)


def go(spark, tmp_path, size="1 hour"):
    stream = spark.readStream.schema(USER_EVENT).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/src/*")
    query = corrections.start_corrected_windows(stream, str(tmp_path / "out"), str(tmp_path / "check"), size, "10 minutes")
    query.awaitTermination()
    assert query.exception() is None
    return str(tmp_path / "out")


def windows(spark, path, version=None):
    got = corrections.read_corrected_windows(spark, path, version).orderBy("window_start").collect()
    return [(r.window_start.hour, r.total_events, r.unique_users, r.batch_id) for r in got]


def flat(df):
    shown = df.select(
        "window_start", "window_end", "total_events", "unique_users", F.round("avg_duration_ms", 6).alias("avg"),
        F.to_json("event_counts").alias("counts"), F.to_json("top_pages").alias("pages"),
    )
    return sorted(map(str, shown.collect()))


def test_late_rows_make_a_new_version(spark, tmp_path):
    for number, minutes in enumerate([(1, 5), (300,), (2, 310, 299), (600,)]):
        at(spark, *minutes).coalesce(1).write.parquet(f"{tmp_path}/src/{number}")
        out = go(spark, tmp_path)
    # Minute 299 is no late row: the watermark, minute 290, had not passed the end of its window.
    # Minute 310 takes it there.
    assert windows(spark, out) == [(0, 3, 2, 2), (4, 1, 1, 2), (5, 2, 2, 3)]
    assert windows(spark, out, version=1) == [(0, 2, 2, 1)]
    late = corrections.late_rows(spark, out).collect()
    assert [(r.id, r.window_start.hour, r.batch_id) for r in late] == [("2", 0, 2)]
    assert late[0].reason == "window closed at 2024-01-01 01:00:00, watermark 2024-01-01 04:50:00"
    assert [(r.window_start.hour, r.late) for r in corrections.late_counts(spark, out).collect()] == [(0, 1)]


def test_a_window_that_only_late_rows_reach(spark, tmp_path):
    for number, minutes in enumerate([(1,), (300,), (100,), (900,)]):
        at(spark, *minutes).coalesce(1).write.parquet(f"{tmp_path}/src/{number}")
    assert windows(spark, go(spark, tmp_path)) == [(0, 1, 1, 1), (1, 1, 1, 2), (5, 1, 1, 3)]


def test_batches_without_events_or_times(spark, tmp_path):
    undated = at(spark, 1).withColumn("timestamp", F.lit(None).cast("timestamp"))
    frames = [undated, at(spark, 1, 200), undated, at(spark, 2), at(spark, 900).unionByName(undated)]
    for number, frame in enumerate(frames):
        frame.coalesce(1).write.parquet(f"{tmp_path}/src/{number}")
        out = go(spark, tmp_path)
    assert [w[:2] for w in windows(spark, out)] == [(0, 2), (3, 1)]
    assert corrections.late_rows(spark, out).count() == 1


@pytest.mark.parametrize("order", [(0, 1, 2, 3), (3, 1, 0, 2)])
def test_closed_windows_equal_the_batch_result(spark, tmp_path, order):
    events = data.user_events(spark, SF)
    day = F.dayofmonth("timestamp")
    for number, k in enumerate(order):
        events.filter((day > 8 * k) & ((day <= 8 * k + 8) | F.lit(k == 3))).repartition(1).write.parquet(f"{tmp_path}/src/{number}")
    out = go(spark, tmp_path)
    last = events.agg(F.max("timestamp")).first()[0] - dt.timedelta(minutes=10)
    expected = win.window_aggregate(events, "1 hour").filter(F.col("window_end") <= F.lit(last))
    assert flat(store.from_at_rest(corrections.read_corrected_windows(spark, out))) == flat(expected)


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    for number, minutes in enumerate([(1, 5), (300,), (2, 310)]):
        at(spark, *minutes).coalesce(1).write.parquet(f"{tmp_path}/src/{number}")
    out = go(spark, tmp_path)
    before = windows(spark, out), corrections.late_rows(spark, out).count()
    # The last batch's commit is lost: the restart runs it again.
    for name in ("2", ".2.crc"):
        (tmp_path / "check" / "commits" / name).rename(tmp_path / f"lost{name}")
    go(spark, tmp_path)
    assert (windows(spark, out), corrections.late_rows(spark, out).count()) == before


def test_notes_stay_two(spark, tmp_path):
    for number in range(6):
        at(spark, number * 70).coalesce(1).write.parquet(f"{tmp_path}/src/{number}")
    go(spark, tmp_path)
    assert len(list((tmp_path / "out" / "noted").glob("**/*.parquet"))) == 2


def test_closing_opens_the_days_concerned(spark, tmp_path, monkeypatch):
    """Counters of days long closed may be gone."""
    for number, minutes in enumerate([(1,), (60 * 24 * 3,), (60 * 24 * 3 + 100,)]):
        at(spark, *minutes).coalesce(1).write.parquet(f"{tmp_path}/src/{number}")
        out = go(spark, tmp_path)
    (tmp_path / "out" / "cells" / "day=2024-01-01").rename(tmp_path / "gone")
    at(spark, 60 * 24 * 4).coalesce(1).write.parquet(f"{tmp_path}/src/3")
    go(spark, tmp_path)
    assert [w[1] for w in windows(spark, out)] == [1, 1, 1]
