"""Windows that begin with their collector."""

import datetime as dt
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from eventide.operators import anchored
from eventide.sources import testdata as data

SF = "/root/testdata/sf0.001"
DAY = dt.datetime(2024, 1, 1)
STARTS = "collector string, started_at timestamp"


def brute(events, anchors, size):
    windows = defaultdict(list)
    for e in events:
        starts = [s for c, s in anchors if c == e.collector and s is not None and e.timestamp is not None and s <= e.timestamp]
        if starts:
            k = (e.timestamp - max(starts)) // size
            windows[e.collector, max(starts) + k * size].append(e)
    out = []
    for (collector, start), rows in windows.items():
        pages = sorted(Counter(e.page or "" for e in rows).items(), key=lambda x: (-x[1], x[0]))[:5]
        out.append(
            (
                collector, start, start + size, len(rows), dict(Counter(e.event_type or "" for e in rows)),
                len({e.user_id or "" for e in rows}), round(sum(e.duration_ms or 0 for e in rows) / len(rows), 6), pages,
            )
        )
    return sorted(out, key=repr)


def found(df):
    rows = df.withColumn("avg_duration_ms", F.round("avg_duration_ms", 6)).collect()
    return sorted(
        (
            (r.collector, r.window_start, r.window_end, r.total_events, r.event_counts, r.unique_users, r.avg_duration_ms, [tuple(p) for p in r.top_pages])
            for r in rows
        ),
        key=repr,
    )


def test_against_brute_force(spark):
    events, anchors = data.collected_events(spark, SF)
    given = [(r.collector, r.started_at) for r in anchors.collect()]
    got = found(anchored.anchored_windows(events, anchors, "1 hour"))
    assert got == brute(events.collect(), given, dt.timedelta(hours=1))
    assert {r[1].minute for r in got} >= {59, 57, 25}


def test_odd_events_and_starts(spark):
    events, _ = data.collected_events(spark, SF)
    some = events.limit(60).withColumn("page", F.lit(None).cast("string"))
    undated = some.limit(5).withColumn("timestamp", F.lit(None).cast("timestamp"))
    both = some.unionByName(undated)
    first = some.agg(F.min("timestamp")).first()[0]
    # A start given twice, one after all events, one without a time, one of a collector without events.
    given = [("c0", first), ("c0", first), ("c0", DAY + dt.timedelta(days=400)), ("c0", None), ("c9", first)]
    anchors = spark.createDataFrame(given, STARTS)
    assert found(anchored.anchored_windows(both, anchors, "1 day")) == brute(both.collect(), given, dt.timedelta(days=1))
    assert anchored.anchored_windows(both, anchors.limit(0)).count() == 0
    assert anchored.anchored_windows(both.limit(0), anchors).count() == 0
