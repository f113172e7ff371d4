"""Reports over window tables.

Each function takes a window frame and returns a small frame. Inputs named
``stored`` carry ``event_counts`` and ``top_pages`` as JSON text; the others
only need scalar columns. Sorted results carry a tie-break, so they are the same
on every run.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventide.functions import strict_json as js
from eventide.functions.timebins import hour_of
from eventide.schemas import EVENT_TYPES

TOP_PAGES = 10
HISTOGRAM_BINS = 40


# --- selections -----------------------------------------------------------------


def date_range(windows: DataFrame, first_day: str, last_day: str) -> DataFrame:
    """Windows that start on the given days (``yyyy-mm-dd``, both included).

    Compares the raw column, so the bounds reach the Parquet reader; on a stored
    table the day partitions are pruned as well.
    """
    start = F.col("window_start")
    first = F.lit(first_day).cast("timestamp")
    after = F.date_add(F.lit(last_day).cast("date"), 1).cast("timestamp")
    selected = windows.filter((start >= first) & (start < after))
    if "window_date" in windows.columns:
        day = F.col("window_date")
        selected = selected.filter(
            (day >= F.lit(first_day).cast("date")) & (day <= F.lit(last_day).cast("date"))
        )
    return selected


def events_timeseries(windows: DataFrame) -> DataFrame:
    return windows.select("window_start", "total_events").orderBy("window_start")


# Column headers of the displayed performance table.
PERFORMANCE_HEADERS = {
    "window_start": "Начало окна",
    "window_end": "Конец окна",
    "total_events": "Событий",
    "unique_users": "Уник. пользователей",
    "avg_duration_ms": "Avg длительность, мс",
}


def performance_table(windows: DataFrame, headers: dict[str, str] | None = None) -> DataFrame:
    """Latest windows first, average rounded to two places.

    Pass ``PERFORMANCE_HEADERS`` as ``headers`` to get the display names.
    """
    table = windows.select(
        "window_start",
        "window_end",
        "total_events",
        "unique_users",
        F.round("avg_duration_ms", 2).alias("avg_duration_ms"),
    ).orderBy(F.desc("window_start"), F.desc("window_end"))
    return table.withColumnsRenamed(headers) if headers else table


# --- by hour --------------------------------------------------------------------


def hourly_rollup(windows: DataFrame) -> DataFrame:
    """Totals per hour of cleaned windows.

    The average is the plain mean of the window averages, and ``unique_users``
    adds the windows' counts, so a user seen in two windows counts twice.
    """
    return (
        windows.groupBy(hour_of(F.col("window_start")).alias("hour"))
        .agg(
            F.sum("total_events").alias("total_events"),
            F.avg("avg_duration_ms").alias("avg_duration_ms"),
            F.sum("unique_users").alias("unique_users"),
            F.count(F.lit(1)).alias("window_count"),
        )
        .orderBy("hour")
    )


def hourly_report(windows: DataFrame) -> DataFrame:
    """Hours of non-empty windows by events, with the median window average."""
    hours = windows.filter("total_events > 0").select(
        hour_of(F.col("window_start")).alias("hour"), "total_events", "avg_duration_ms", "unique_users"
    )
    sums = hours.groupBy("hour").agg(
        F.sum("total_events").alias("total_events"),
        F.avg("avg_duration_ms").alias("avg_duration_ms"),
        F.sum("unique_users").alias("unique_users"),
    )
    middle = exact_medians(hours, "hour", "avg_duration_ms").withColumnRenamed("median", "median_duration")
    return sums.join(middle, "hour", "left").orderBy(F.desc("total_events"), "hour")


# A sketch of a group's ranks is off by at most one in this many, and the part of the
# ranks around the middle that is looked at is twice as wide.
SKETCH_ACCURACY = 1000


def exact_medians(rows: DataFrame, key: str, value: str) -> DataFrame:
    """The exact median of each group (key, median), without holding a group's values.

    A sketch of bounded size brackets the middle of each group. Values below the bracket
    are only counted, those above it left out, and the few between counted by value:
    running sums over these give the two middle ranks, and the median lies half-way
    between them. Null values count as absent; a group without values has none.
    """
    near = 2 / SKETCH_ACCURACY
    bracket = F.percentile_approx(value, [0.5 - near, 0.5 + near], SKETCH_ACCURACY)
    known = rows.filter(F.col(value).isNotNull()).select(F.col(key), F.col(value).alias("v"))
    sketches = rows.groupBy(key).agg(bracket.alias("b"), F.count(value).alias("size")).filter("size > 0")
    placed = known.join(sketches, key).filter(F.col("v") <= F.col("b")[1])
    # One row for all below the bracket, and one for each value in it.
    inside = F.when(F.col("v") >= F.col("b")[0], F.col("v"))
    counted = placed.groupBy(key, inside.alias("v")).agg(F.count(F.lit(1)).alias("n"), F.first("size").alias("size"))
    upto = F.sum("n").over(Window.partitionBy(key).orderBy(F.col("v").asc_nulls_first()))
    ranked = counted.withColumn("upto", upto)

    def at(rank: Column) -> Column:
        here = (F.col("upto") > rank) & (F.col("upto") - F.col("n") <= rank)
        return F.max(F.when(here, F.col("v")))

    low, high = at(F.floor((F.col("size") - 1) / 2)), at(F.floor(F.col("size") / 2))
    return ranked.groupBy(key).agg((low + (high - low) * 0.5).alias("median"))


def hourly_totals(windows: DataFrame) -> DataFrame:
    return (
        windows.filter("total_events > 0")
        .groupBy(hour_of(F.col("window_start")).alias("hour"))
        .agg(
            F.sum("total_events").alias("total_events"),
            F.avg("avg_duration_ms").alias("avg_duration_ms"),
        )
        .orderBy(F.desc("total_events"), "hour")
    )


HOURLY_TOTALS_SQL = """
    SELECT date_trunc('hour', window_start) AS hour,
           sum(total_events) AS total_events,
           avg(avg_duration_ms) AS avg_duration_ms
    FROM {windows}
    WHERE total_events > 0
    GROUP BY 1
    ORDER BY total_events DESC, hour
"""


def hourly_totals_sql(spark: SparkSession, windows: DataFrame) -> DataFrame:
    """``hourly_totals`` written as SQL; both give the same plan and rows."""
    return spark.sql(HOURLY_TOTALS_SQL, windows=windows)


def users_heatmap(windows: DataFrame) -> DataFrame:
    """Summed unique users per weekday (Monday 0) and hour, all 168 cells."""
    start = F.col("window_start")
    sums = windows.groupBy(
        F.weekday(start).cast("bigint").alias("day_idx"),
        F.hour(start).cast("bigint").alias("hour"),
    ).agg(F.sum("unique_users").alias("users"))
    grid = windows.sparkSession.range(7 * 24).selectExpr(
        "id div 24 AS day_idx", "id % 24 AS hour"
    )
    return (
        grid.join(sums, ["day_idx", "hour"], "left")
        .select("day_idx", "hour", F.coalesce("users", F.lit(0)).alias("unique_users"))
        .orderBy("day_idx", "hour")
    )


def users_heatmap_pivot(windows: DataFrame) -> DataFrame:
    """The heat map as 24 rows with one column per weekday, ``d0`` to ``d6``."""
    cells = users_heatmap(windows)
    return (
        cells.groupBy("hour")
        .pivot("day_idx", list(range(7)))
        .sum("unique_users")
        .select("hour", *[F.col(str(d)).alias(f"d{d}") for d in range(7)])
        .orderBy("hour")
    )


# --- totals ---------------------------------------------------------------------


def analysis_summary(windows: DataFrame) -> DataFrame:
    """Window count, event total and events per window; zeros without windows."""
    return windows.agg(*_summary_columns())


def _summary_columns() -> list[Column]:
    count = F.count(F.lit(1))
    total = F.coalesce(F.sum("total_events"), F.lit(0))
    return [
        count.alias("total_windows"),
        total.alias("total_events"),
        F.when(count > 0, total / count).otherwise(0.0).alias("avg_events_per_window"),
    ]


def peak_window(windows: DataFrame) -> DataFrame:
    """The window with the most events, the earliest of equals; no row without windows."""
    return windows.orderBy(F.desc("total_events"), "window_start", "window_end").limit(1)


def analysis_result(windows: DataFrame, generated_at: str) -> DataFrame:
    """The whole run summary as one row.

    ``peak_window`` is a struct of all columns, null without windows, and
    ``event_distribution`` a map from type to count. ``event_counts`` may be a
    map or its stored JSON text. ``generated_at`` is the instant to note.
    """
    by_type = (
        event_distribution
        if dict(windows.dtypes)["event_counts"].startswith("map")
        else event_distribution_json
    )
    entries = F.array_sort(F.collect_list(F.struct("event_type", "total_count")))
    distribution = by_type(windows).agg(F.map_from_entries(entries)).scalar()
    # The peak comes with the summary: the first by total, then start and end.
    total = F.col("total_events")
    first = F.struct(total.isNull(), -total, "window_start", "window_end")
    peak = F.min_by(F.struct(*windows.columns), first).alias("peak_window")
    return windows.agg(*_summary_columns(), peak).select(
        "*",
        distribution.alias("event_distribution"),
        F.lit(generated_at).cast("timestamp").alias("generated_at"),
    )


def kpi_metrics(windows: DataFrame) -> DataFrame:
    return windows.agg(
        F.coalesce(F.sum("total_events"), F.lit(0)).alias("total_events"),
        F.coalesce(F.sum("unique_users"), F.lit(0)).alias("unique_users"),
        F.coalesce(F.avg("avg_duration_ms"), F.lit(0.0)).alias("avg_duration_ms"),
        F.count(F.lit(1)).alias("windows"),
    )


def duration_histogram(windows: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Windows per equal-width bin of the average duration, with the overall mean.

    The range is a one-row scalar subquery. Bins without windows are left out;
    when all averages are equal, everything falls into bin 0.
    """
    value = F.col("avg_duration_ms")
    stats = windows.agg(
        F.struct(
            F.min(value).alias("lo"), F.max(value).alias("hi"), F.avg(value).alias("mean")
        ).alias("stats")
    ).scalar()
    width = (F.col("s.hi") - F.col("s.lo")) / bins
    binned = (
        windows.filter(value.isNotNull())
        .select(value, stats.alias("s"))
        .select(
            F.when(
                width > 0, F.least(F.floor((value - F.col("s.lo")) / width), F.lit(bins - 1))
            )
            .otherwise(0)
            .cast("bigint")
            .alias("bin"),
            F.col("s.lo").alias("lo"),
            width.alias("width"),
            F.col("s.mean").alias("mean"),
        )
    )
    return (
        binned.groupBy("bin", "lo", "width", "mean")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "bin",
            (F.col("lo") + F.col("bin") * F.col("width")).alias("lo"),
            (F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("hi"),
            "n",
            "mean",
        )
        .orderBy("bin")
    )


def round_histogram(windows: DataFrame, most: int = HISTOGRAM_BINS) -> DataFrame:
    """Windows per bin of the average duration with edges at round values, at most ``most`` bins (3 or more).

    The step is the smallest of 1, 2 and 5 times a power of ten with which no more bins touch the
    values; bins start at its multiples, and a value on an edge belongs to the bin it begins.
    When all averages are equal the step is 1. Bins without windows are left out.
    """
    value = F.col("avg_duration_ms")
    lo, hi = F.col("s.lo"), F.col("s.hi")
    stats = windows.agg(
        F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"), F.avg(value).alias("mean")).alias("stats")
    ).scalar()
    # One decade below that of the range per bin is where the search begins.
    first = F.floor(F.log10((hi - lo) / most)) - 1
    # Powers of ten are exact, those below 1 as divisors.
    steps = F.array(
        *[
            F.when(first + up < 0, F.lit(float(m)) / F.pow(F.lit(10.0), -(first + up))).otherwise(
                F.lit(float(m)) * F.pow(F.lit(10.0), first + up)
            )
            for up in range(3)
            for m in (1, 2, 5)
        ]
    )
    fits = F.filter(steps, lambda s: F.floor(hi / s) - F.floor(lo / s) < most)
    step = F.when(hi > lo, F.element_at(fits, 1)).otherwise(1.0)
    stepped = windows.select(stats.alias("s")).limit(1).select(F.struct("s.mean", step.alias("step"))).scalar()
    binned = windows.filter(value.isNotNull()).select(value, stepped.alias("t"))
    by_bin = binned.groupBy(F.floor(value / F.col("t.step")).alias("bin"), "t").agg(F.count(F.lit(1)).alias("n"))
    width = F.col("t.step")
    return by_bin.select(
        "bin",
        (F.col("bin") * width).alias("lo"),
        ((F.col("bin") + 1) * width).alias("hi"),
        "n",
        width.alias("step"),
        F.col("t.mean").alias("mean"),
    ).orderBy("bin")


# --- event types ----------------------------------------------------------------


def event_distribution(windows: DataFrame) -> DataFrame:
    """Events per type from the map column, most frequent first."""
    return _distribution(windows, F.col("event_counts"))


def event_distribution_json(stored: DataFrame) -> DataFrame:
    """The same from the JSON column. Null, empty and unreadable text adds nothing, nor
    does text with anything after the object; a count may be written as text or with a
    fraction, which is cut."""
    counts = F.expr(js.whole_object("event_counts"))
    whole = stored.select(F.explode(counts).alias("event_type", "value"))
    counted = whole.select("event_type", F.expr(js.whole_number("value")).alias("n"))
    return _totals(counted.filter("n IS NOT NULL"))


def _distribution(windows: DataFrame, counts: Column) -> DataFrame:
    return _totals(windows.select(F.explode(counts).alias("event_type", "n")))


def _totals(counted: DataFrame) -> DataFrame:
    return (
        counted.groupBy("event_type")
        .agg(F.sum("n").alias("total_count"))
        .orderBy(F.desc("total_count"), "event_type")
    )


def event_distribution_filtered(
    stored: DataFrame, selected: list[str] | None = None
) -> DataFrame:
    """Chosen event types only (by default the six known ones), rarest first."""
    selected = EVENT_TYPES if selected is None else selected
    return (
        event_distribution_json(stored)
        .filter(F.col("event_type").isin(selected))
        .orderBy("total_count", "event_type")
    )


def event_type_shares(stored: DataFrame) -> DataFrame:
    return _shares(
        event_distribution_json(stored).select(
            F.col("event_type").alias("key"), F.col("total_count").alias("count")
        )
    )


# --- pages ----------------------------------------------------------------------


def page_totals(stored: DataFrame) -> DataFrame:
    """Counts per page added over the windows' top-page lists.

    A page outside a window's list is not counted for that window, so these are
    lower bounds of the real totals.
    """
    pages = F.expr(js.whole_array("top_pages", {"page": "string", "count": "variant"}))
    listed = stored.select(F.inline(pages)).select("page", F.expr(js.whole_number("count")).alias("count"))
    return (
        listed.filter("count IS NOT NULL")
        .groupBy("page")
        .agg(F.sum("count").alias("count"))
        .orderBy(F.desc("count"), "page")
    )


def top_pages(stored: DataFrame, limit: int = TOP_PAGES) -> DataFrame:
    return page_totals(stored).limit(limit)


def page_shares(stored: DataFrame, limit: int = TOP_PAGES) -> DataFrame:
    """Share of each top page among the top pages."""
    return _shares(
        top_pages(stored, limit).select(F.col("page").alias("key"), "count")
    )


def _shares(counts: DataFrame) -> DataFrame:
    """Add ``share`` = count / sum; the sum is a one-row scalar subquery."""
    total = counts.agg(F.sum("count")).scalar()
    return counts.select(
        "key", "count", (F.col("count") / total).alias("share")
    ).orderBy(F.desc("count"), "key")
