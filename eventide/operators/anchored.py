"""Windows of collectors that began at different times.

A collector's windows follow one another from the moment it started, not from a grid
that all share; when it starts anew, so do its windows. Events are matched with the
start in force at their time, the latest one of their collector that is not after it.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.operators.windows import (
    DEFAULT_SIZE,
    _assemble,
    _counts_map,
    _pages_list,
    event_counts,
    page_counts,
    top_pages,
    totals,
)


def assign_anchored(
    events: DataFrame,
    anchors: DataFrame,
    size: str = DEFAULT_SIZE,
    collector: str = "collector",
    time_col: str = "timestamp",
) -> DataFrame:
    """Events with ``window_start``, a struct of their collector and their window's start.

    ``anchors`` has a row (collector, started_at) per start. Each collector's starts come as one
    sorted list, so an as-of match is a join on the collector and a look into that
    list; a busy collector's events are not sorted, and may be split over tasks.
    Events of a collector that had not started, or without a time, have no window.
    """
    starts = anchors.filter("started_at IS NOT NULL").groupBy(collector).agg(F.collect_set("started_at").alias("starts"))
    time = F.col(time_col)
    matched = events.join(starts, collector).withColumn("anchor", F.array_max(F.filter("starts", lambda s: s <= time)))
    step = F.expr(f"unix_micros(timestamp_micros(0) + INTERVAL {size})")
    since = F.unix_micros(time) - F.unix_micros("anchor")
    start = F.timestamp_micros(F.unix_micros("anchor") + F.floor(since / step) * step)
    return matched.filter("anchor IS NOT NULL").select(
        F.struct(F.col(collector).alias("collector"), start.alias("start")).alias("window_start"),
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("user_id", "event_type", "page")],
        F.coalesce("duration_ms", F.lit(0.0)).alias("duration_ms"),
    )


def anchored_windows(
    events: DataFrame,
    anchors: DataFrame,
    size: str = DEFAULT_SIZE,
    collector: str = "collector",
    time_col: str = "timestamp",
) -> DataFrame:
    """One row per collector and window that has events, with all measures.

    A window ends where it would have, also if its collector starts anew before: the
    next windows then overlap it.
    """
    assigned = assign_anchored(events, anchors, size, collector, time_col)
    parts = [totals(assigned), _counts_map(event_counts(assigned)), _pages_list(top_pages(page_counts(assigned)))]
    rows = _assemble(parts)
    start = F.col("window_start.start")
    measures = [c for c in rows.columns if c != "window_start"]
    return rows.select(
        F.col("window_start.collector").alias("collector"),
        start.alias("window_start"),
        (start + F.expr(f"INTERVAL {size}")).alias("window_end"),
        *measures,
    )
