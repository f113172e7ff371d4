"""Tumbling-window aggregation of events.

Two forms give the same result:

* ``window_aggregate`` computes totals, per-type counts and top pages as three
  independent aggregations of the events. Each reads only the columns it needs,
  combines map-side, shuffles on a key that includes the user, type or page (so
  one busy window is spread over many tasks), and only then folds to one row per
  window. The parts meet in a join on the window, where both sides are already
  partitioned by it. A caller that needs one measure pays for one.
* ``window_cells`` reduces events to mergeable counters per (window, dimension,
  key). Counters of separate batches add up, so they can be appended by a stream
  and ``rollup`` turns any number of them into the same windows.

Distinct users and top pages are exact in both; no raw events are buffered and
no group is collected except the per-type map and the five page rows that form
the output row itself.
"""

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.functions.timebins import tumbling

DEFAULT_SIZE = "10 seconds"
TOP_PAGES = 5

# Windows of one size are told apart by their start; the end is added to the
# finished rows, which keeps it out of every grouping key and shuffle.
_KEY = "window_start"


def _text(name: str) -> Column:
    """Events have no null text; a missing value counts as the empty string."""
    return F.coalesce(F.col(name), F.lit(""))


def assign_windows(
    events: DataFrame,
    size: str = DEFAULT_SIZE,
    time_col: str = "timestamp",
    offset: str | None = None,
) -> DataFrame:
    """Events with their window's start; events without a time are left out.

    ``time_col`` is the event time by default, which makes results repeatable;
    pass the arrival column to group by the time of consumption instead.
    """
    return events.select(
        tumbling(time_col, size, offset).start.alias(_KEY),
        _text("user_id").alias("user_id"),
        _text("event_type").alias("event_type"),
        _text("page").alias("page"),
        F.coalesce(F.col("duration_ms"), F.lit(0.0)).alias("duration_ms"),
    )


def without_window(events: DataFrame, time_col: str = "timestamp") -> DataFrame:
    """The events no window counts, because they have no time."""
    return events.filter(F.col(time_col).isNull())


def with_end(windows: DataFrame, size: str) -> DataFrame:
    """Add ``window_end`` after the start."""
    rest = [c for c in windows.columns if c != _KEY]
    return windows.select(_KEY, (F.col(_KEY) + F.expr(f"INTERVAL {size}")).alias("window_end"), *rest)


def totals(assigned: DataFrame) -> DataFrame:
    """Events, distinct users and average duration per window.

    The distinct count makes Spark aggregate by (window, user) first and carry
    the other two along, so the one pass over the events also removes the skew
    of a busy window.
    """
    return assigned.groupBy(_KEY).agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_distinct("user_id").alias("unique_users"),
        F.avg("duration_ms").alias("avg_duration_ms"),
    )


def window_totals(assigned: DataFrame) -> DataFrame:
    return assigned.groupBy(_KEY).agg(F.count(F.lit(1)).alias("total_events"))


def window_avg_duration(assigned: DataFrame) -> DataFrame:
    return assigned.groupBy(_KEY).agg(F.avg("duration_ms").alias("avg_duration_ms"))


def window_unique_users(assigned: DataFrame) -> DataFrame:
    return assigned.groupBy(_KEY).agg(F.count_distinct("user_id").alias("unique_users"))


def event_counts(assigned: DataFrame) -> DataFrame:
    """Events per window and type, for any type text."""
    return assigned.groupBy(_KEY, "event_type").agg(F.count(F.lit(1)).alias("n"))


def page_counts(assigned: DataFrame) -> DataFrame:
    return assigned.groupBy(_KEY, "page").agg(F.count(F.lit(1)).alias("n"))


def top_pages(pages: DataFrame, limit: int = TOP_PAGES) -> DataFrame:
    """The ``limit`` most frequent pages per window, ties in page order.

    The rank filter lets Spark keep ``limit`` rows per window in every task
    before the shuffle, however many pages a window has.
    """
    order = Window.partitionBy(_KEY).orderBy(F.desc("n"), F.asc("page"))
    return (
        pages.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= limit)
        .select(_KEY, "rank", "page", "n")
    )


def _counts_map(counts: DataFrame) -> DataFrame:
    """One map per window, keys in order. Its size is the number of types."""
    entries = F.array_sort(F.collect_list(F.struct("event_type", "n")))
    return counts.groupBy(_KEY).agg(F.map_from_entries(entries).alias("event_counts"))


def _pages_list(ranked: DataFrame) -> DataFrame:
    rows = F.array_sort(F.collect_list(F.struct("rank", "page", "n")))
    return ranked.groupBy(_KEY).agg(
        F.transform(
            rows, lambda r: F.struct(r["page"].alias("page"), r["n"].alias("count"))
        ).alias("top_pages")
    )


# The independent parts of a window row; each costs its own pass over the events.
PARTS = ("totals", "event_counts", "top_pages")

_COLUMN_ORDER = [
    _KEY,
    "total_events",
    "event_counts",
    "unique_users",
    "avg_duration_ms",
    "top_pages",
]


def _assemble(parts: list[DataFrame]) -> DataFrame:
    """Join the parts; every one has a row for every window that has events."""
    joined = reduce(lambda a, b: a.join(b, _KEY, "left"), parts)
    return joined.select(*[c for c in _COLUMN_ORDER if c in joined.columns])


def window_aggregate(
    events: DataFrame,
    size: str = DEFAULT_SIZE,
    time_col: str = "timestamp",
    offset: str | None = None,
    parts: Iterable[str] = PARTS,
) -> DataFrame:
    """One row per window that has events, with all measures or the given parts.

    Reads the events once per part with different columns. That is cheap on a
    columnar table; decode JSON records into one first, or go through
    ``window_cells``, which reads them once.
    """
    assigned = assign_windows(events, size, time_col, offset)
    build = {
        "totals": lambda: totals(assigned),
        "event_counts": lambda: _counts_map(event_counts(assigned)),
        "top_pages": lambda: _pages_list(top_pages(page_counts(assigned))),
    }
    return with_end(_assemble([build[part]() for part in PARTS if part in parts]), size)


def window_cells(
    events: DataFrame,
    size: str = DEFAULT_SIZE,
    time_col: str = "timestamp",
    offset: str | None = None,
) -> DataFrame:
    """Mergeable counters: three per event before, few per task after combining.

    ``n`` counts events for each user, type and page of a window. Every event
    has exactly one type, so the type counters also carry the total and the
    duration sum of the window.
    """
    keyed = window_facts(events, time_col).withColumn(_KEY, tumbling(time_col, size, offset).start)
    return keyed.groupBy(_KEY, "dim", "key").agg(
        F.count(F.lit(1)).alias("n"), F.sum("d").alias("duration")
    )


def window_facts(events: DataFrame, time_col: str) -> DataFrame:
    """Each event as three facts (dimension, key, duration) next to its time.

    Batch and stream count these facts; only the type's fact carries the duration.
    """
    none = F.lit(0.0)
    duration = F.coalesce(F.col("duration_ms"), none)
    facts = [
        F.struct(F.lit(dim).alias("dim"), _text(dim).alias("key"), value.alias("d"))
        for dim, value in (("user_id", none), ("event_type", duration), ("page", none))
    ]
    return events.filter(F.col(time_col).isNotNull()).select(time_col, F.inline(F.array(*facts)))


def merge_cells(cells: DataFrame) -> DataFrame:
    """Add up the counters that several batches hold for the same key."""
    return cells.groupBy(_KEY, "dim", "key").agg(
        F.sum("n").alias("n"), F.sum("duration").alias("duration")
    )


def rollup(cells: DataFrame, size: str = DEFAULT_SIZE) -> DataFrame:
    """Windows of ``size`` from counters, merged or not.

    Meant for cells read from a table partitioned by ``dim``: each measure then
    scans only its own partition.
    """
    types = cells.filter("dim = 'event_type'").withColumnRenamed("key", "event_type")
    users = cells.filter("dim = 'user_id'")
    pages = cells.filter("dim = 'page'").withColumnRenamed("key", "page")
    sums = types.groupBy(_KEY).agg(
        F.sum("n").alias("total_events"),
        (F.sum("duration") / F.sum("n")).alias("avg_duration_ms"),
    )
    distinct = users.groupBy(_KEY).agg(F.count_distinct("key").alias("unique_users"))
    type_counts = types.groupBy(_KEY, "event_type").agg(F.sum("n").alias("n"))
    page_sums = pages.groupBy(_KEY, "page").agg(F.sum("n").alias("n"))
    windows = _assemble(
        [sums, distinct, _counts_map(type_counts), _pages_list(top_pages(page_sums))]
    )
    return with_end(windows, size)


# What a window without events holds.
_QUIET = {
    "total_events": "0L",
    "event_counts": "cast(map() AS map<string,bigint>)",
    "unique_users": "0L",
    "avg_duration_ms": "0.0D",
    "top_pages": "cast(array() AS array<struct<page:string,count:bigint>>)",
}


def quiet_windows(cells: DataFrame, size: str) -> DataFrame:
    """Windows whose counters hold no event."""
    busy = F.bool_or(F.col("dim") == "event_type")
    quiet = cells.groupBy(_KEY).agg(busy.alias("busy")).filter("NOT busy")
    measures = [F.expr(_QUIET[c]).alias(c) for c in _COLUMN_ORDER if c in _QUIET]
    return with_end(quiet.select(_KEY, *measures), size)


def zero_fill(windows: DataFrame, size: str) -> DataFrame:
    """Add windows without events between the first and the last one.

    Every given window stays as it is, wherever it starts. Added windows stand on the
    grid of the first window, where no given window overlaps them. A quiet window has
    zero totals, an average of 0.0, and empty nested values where the frame has those
    columns. ``size`` must be a fixed span. The grid is built in two steps, chunks and
    then slots, so no row holds a long array and the second step runs in parallel.
    """
    step = f"unix_micros(timestamp_micros(0) + INTERVAL {size})"
    bounds = windows.agg(
        F.unix_micros(F.min("window_start")).alias("lo"),
        F.unix_micros(F.max("window_start")).alias("hi"),
    )
    chunk = 4096
    slots = (
        bounds.filter("lo IS NOT NULL")
        .select("lo", F.expr(f"explode(sequence(0L, (hi - lo) div {step}, {chunk}L)) AS first"), "hi")
        .repartition("first")
        .select(
            "lo",
            F.expr(f"explode(sequence(first, least(first + {chunk - 1}, (hi - lo) div {step}))) AS slot"),
        )
    )
    # The slots that each window reaches into; a window off the grid reaches into two.
    low = bounds.select("lo").scalar()
    begin = F.unix_micros("window_start") - low
    end = F.greatest(F.unix_micros("window_end") - low - 1, begin)
    reached = windows.select(
        F.explode(F.sequence(F.floor(begin / F.expr(step)), F.floor(end / F.expr(step)))).alias("slot")
    )
    starts = F.timestamp_micros(F.col("lo") + F.col("slot") * F.expr(step))
    zero = {
        "window_start": starts,
        "window_end": starts + F.expr(f"INTERVAL {size}"),
        **{name: F.expr(value) for name, value in _QUIET.items()},
    }
    quiet = slots.join(reached.distinct(), "slot", "left_anti")
    kinds = dict(windows.dtypes)
    added = quiet.select(
        *[zero.get(name, F.lit(None)).cast(kinds[name]).alias(name) for name in windows.columns]
    )
    return windows.unionByName(added)
