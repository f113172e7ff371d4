"""The library's input frames derived from a folder of test tables.

Only ``events`` is used. Everything is computed from the whole table, so the
work of a query grows with it.
"""

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.operators.windows import PARTS, window_aggregate
from eventide.schemas import EVENT_COUNTS_TYPE, TOP_PAGES_TYPE
from eventide.session import configure
from eventide.sources.events import event_json
from eventide.sources.windows import to_at_rest

# Pages and client attributes are built from a number the event carries.
N_PAGES, N_DEVICES, N_BROWSERS, N_COUNTRIES = 8, 3, 4, 8

RAW_EVENTS = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
    "value DOUBLE, props STRING"
)

HOUR = "1 hour"
TEN_MINUTES = "10 minutes"


def _numbered(prefix: str, number: Column, values: int) -> Column:
    return F.concat(F.lit(prefix), (number % values).cast("string"))


def to_user_events(raw: DataFrame) -> DataFrame:
    """The raw event table in the ``USER_EVENT`` schema, batch or stream."""
    k = F.get_json_object("props", "$.k").cast("int")
    kind = F.col("event_type")
    number = F.col("user_id").cast("string")
    return raw.select(
        F.col("event_id").cast("string").alias("id"),
        F.concat(
            F.lit("user-"),
            F.when(F.col("user_id") < 1000, F.lpad(number, 3, "0")).otherwise(number),
        ).alias("user_id"),
        F.concat(F.lit("sess-"), (F.col("user_id") % 20).cast("string")).alias("session_id"),
        F.when(kind == "view", "page_view")
        .when(kind == "signup", "login")
        .otherwise(kind)
        .alias("event_type"),
        _numbered("/page-", k, N_PAGES).alias("page"),
        (F.col("value") * 1000).alias("duration_ms"),
        F.create_map(
            F.lit("device"),
            _numbered("device-", k, N_DEVICES),
            F.lit("browser"),
            _numbered("browser-", k, N_BROWSERS),
            F.lit("country"),
            _numbered("country-", k, N_COUNTRIES),
        ).alias("metadata"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def user_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return to_user_events(spark.read.schema(RAW_EVENTS).parquet(f"{sf_dir}/events.parquet"))


def off_grid_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten-minute windows; those of every third day start three minutes later."""
    windows = scalar_windows(spark, sf_dir, TEN_MINUTES)
    moved = F.dayofmonth("window_start") % 3 == 0
    bounds = ("window_start", "window_end")
    return windows.withColumns(
        {c: F.when(moved, F.col(c) + F.expr("INTERVAL 3 MINUTES")).otherwise(F.col(c)) for c in bounds}
    )


# Parts of the event table that streams read one after the other.
STREAM_PARTS = 4


def part_of(day: Column) -> Column:
    """The part of a day of the month: eight days each."""
    return F.least(F.floor((day - 1) / 8), F.lit(STREAM_PARTS - 1))


def stream_files(
    spark: SparkSession, sf_dir: str, path: str, order: Iterable[int] = range(STREAM_PARTS)
) -> DataFrame:
    """The event table as a stream of its parts, one micro-batch each, in the given order.

    The parts are written below ``path`` one after the other, so their files' times
    differ and follow that order; the tasks of a part write as many files as there
    are shuffle partitions, and a micro-batch reads as many.
    """
    events = user_events(spark, sf_dir)
    part = part_of(F.dayofmonth("timestamp"))
    least = events.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).agg(F.min("n")).first()[0] or 1
    files = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), least // 100))
    for number, k in enumerate(order):
        events.filter(part == k).repartition(files).write.parquet(f"{path}/{number}")
    return (
        spark.readStream.schema(events.schema).option("maxFilesPerTrigger", files).parquet(f"{path}/*")
    )


QUIET_SLOTS = 3


def tick_files(spark: SparkSession, sf_dir: str, path: str, size: str, delay: str) -> DataFrame:
    """A stream of instants, one per window of the event table, in the parts of
    ``stream_files``; the last part goes on until ``QUIET_SLOTS`` more windows are closed."""
    start = F.window("timestamp", size).start
    bounds = user_events(spark, sf_dir).agg(F.min(start).alias("lo"), F.max(start).alias("hi"))
    step = F.expr(f"INTERVAL {size}")
    until = F.col("hi") + step * (QUIET_SLOTS + 1) + F.expr(f"INTERVAL {delay}")
    ticks = bounds.select(F.explode(F.sequence("lo", until, step)).alias("timestamp"), "hi")
    part = F.when(F.col("timestamp") > F.col("hi"), STREAM_PARTS - 1).otherwise(part_of(F.dayofmonth("timestamp")))
    for k in range(STREAM_PARTS):
        ticks.filter(part == k).select("timestamp").coalesce(1).write.parquet(f"{path}/{k}")
    return spark.readStream.schema("timestamp timestamp").option("maxFilesPerTrigger", 1).parquet(f"{path}/*")


def collected_events(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Events by collector, and the starts of the collectors: two of them, which began
    at different times before the first event; the second started anew twice."""
    events = user_events(spark, sf_dir)
    collected = events.withColumn("collector", F.concat(F.lit("c"), (F.col("id").cast("bigint") % 2).cast("string")))
    day = F.date_trunc("day", F.min("timestamp"))
    starts = F.array(
        *[
            F.struct(F.lit(name).alias("collector"), (day + F.expr(f"INTERVAL '{at}' DAY TO SECOND")).alias("started_at"))
            for name, at in COLLECTOR_STARTS
        ]
    )
    return collected, events.agg(starts.alias("s")).select(F.inline("s"))


COLLECTOR_STARTS = [("c0", "-0 00:00:07"), ("c1", "-0 00:03:00"), ("c1", "9 07:03:20"), ("c1", "9 07:25:41.5")]


def damaged_json(events: DataFrame) -> DataFrame:
    """Every event as a JSON record (``id``, ``value``), some of them damaged.

    The event id decides the damage: of 20 consecutive records fourteen are, in
    turn, cut short, followed by text, without a page, with a null session, with
    a number as user, with text as duration, with two ids, with an unknown key
    (still good), empty, with an id in capitals before the id, with a number as an id
    in capitals after it, with a null id after the id, with text as a first of two
    durations, and with two metadata objects.
    """
    good = F.col("good")
    case = F.col("id").cast("bigint") % 20
    rest, most = F.expr("substr(good, 2)"), F.expr("left(good, length(good) - 1)")
    value = (
        F.when(case == 0, F.expr("left(good, length(good) - 1)"))
        .when(case == 1, F.concat(good, F.lit(" trailing")))
        .when(case == 2, F.replace(good, F.lit('"page":'), F.lit('"pg":')))
        .when(case == 3, F.regexp_replace(good, '"session_id":"[^"]*"', '"session_id":null'))
        .when(case == 4, F.regexp_replace(good, '"user_id":"[^"]*"', '"user_id":5'))
        .when(case == 5, F.regexp_replace(good, '"duration_ms":([^,]*)', '"duration_ms":"$1"'))
        .when(case == 6, F.concat(F.lit('{"id":"first",'), rest))
        .when(case == 7, F.concat(F.lit('{"extra":{"id":1},'), rest))
        .when(case == 8, F.lit(""))
        .when(case == 9, F.concat(F.lit('{"ID":"first",'), rest))
        .when(case == 10, F.concat(most, F.lit(',"ID":5}')))
        .when(case == 11, F.concat(most, F.lit(',"id":null}')))
        .when(case == 12, F.concat(F.lit('{"duration_ms":"x",'), rest))
        .when(case == 13, F.concat(F.lit('{"metadata":{"extra":"1"},'), rest))
        .otherwise(good)
    )
    return events.select("id", event_json().alias("good")).select("id", value.alias("value"))


def events_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    raw = spark.read.schema(RAW_EVENTS).parquet(f"{sf_dir}/events.parquet")
    return damaged_json(to_user_events(raw))


def event_batches(spark: SparkSession, sf_dir: str, size: int = 50) -> DataFrame:
    """The JSON records in arrays of ``size`` (``batch_id``, ``events``).

    A record that is no JSON value spoils its whole array. Every fourth array
    keeps such records, the next has a number in their place, the others an
    empty object. One array in ten is wrapped in an object.
    """
    number = F.col("id").cast("bigint")
    batch = F.expr(f"cast(id AS bigint) div {size}")
    unreadable = (number % 20).isin(0, 1, 8)
    value = (
        F.when(unreadable & (batch % 4 == 1), F.lit("7"))
        .when(unreadable & (batch % 4 > 1), F.lit("{}"))
        .otherwise(F.col("value"))
    )
    lists = (
        events_json(spark, sf_dir)
        .select(batch.alias("batch_id"), number.alias("number"), value.alias("value"))
        .groupBy("batch_id")
        .agg(F.array_sort(F.collect_list(F.struct("number", "value"))).alias("rows"))
    )
    joined = F.array_join(F.transform("rows", lambda r: r["value"]), ",")
    return lists.select(
        "batch_id",
        F.when(F.col("batch_id") % 10 == 9, F.concat(F.lit('{"v":['), joined, F.lit("]}")))
        .otherwise(F.concat(F.lit("["), joined, F.lit("]")))
        .alias("events"),
    )


def stable(windows: DataFrame) -> DataFrame:
    """Round the average to six places.

    A later rounding to two places then does not depend on the order in which
    doubles were added.
    """
    return windows.withColumn("avg_duration_ms", F.round("avg_duration_ms", 6))


def windows(
    spark: SparkSession, sf_dir: str, size: str = HOUR, parts: Iterable[str] = PARTS
) -> DataFrame:
    """Windows of all events, with all measures or the given parts."""
    return window_aggregate(user_events(spark, sf_dir), size, parts=parts)


def scalar_windows(spark: SparkSession, sf_dir: str, size: str = HOUR) -> DataFrame:
    """Windows of all events without the nested measures, which cost extra."""
    return windows(spark, sf_dir, size, ["totals"])


def windows_at_rest(spark: SparkSession, sf_dir: str, size: str = HOUR) -> DataFrame:
    return to_at_rest(windows(spark, sf_dir, size))


def stored_event_counts(spark: SparkSession, sf_dir: str, size: str = HOUR) -> DataFrame:
    """Per-type counts of each window as stored JSON text, some of it damaged."""
    counts = windows(spark, sf_dir, size, ["event_counts"])
    return counts.withColumn("event_counts", _damaged_text(F.to_json("event_counts")))


def stored_top_pages(spark: SparkSession, sf_dir: str, size: str = HOUR) -> DataFrame:
    """Top pages of each window as stored JSON text, some of it damaged."""
    pages = windows(spark, sf_dir, size, ["top_pages"])
    return pages.withColumn("top_pages", _damaged_text(F.to_json("top_pages")))


def _damaged_text(text: Column) -> Column:
    """Of seven hours one is followed by other text, one cut short, one has its numbers
    as text, and one with a fraction; the last two can be read."""
    case = F.hour("window_start") % 7
    return (
        F.when(case == 0, F.concat(text, F.lit(" junk")))
        .when(case == 1, F.regexp_replace(text, ".$", ""))
        .when(case == 2, F.regexp_replace(text, ":([0-9]+)", ':"$1"'))
        .when(case == 3, F.regexp_replace(text, ":([0-9]+)", ":$1.5"))
        .otherwise(text)
    )


def windows_dirty(
    spark: SparkSession, sf_dir: str, size: str = HOUR, parts: Iterable[str] = PARTS
) -> DataFrame:
    """Windows with duplicates and empty first copies, numbered by ``seq``.

    Every sixth hour arrives again later (seq 1) with one event more. The hours
    after those were preceded (seq -1) by an empty copy of the same window. Those after
    them arrive again (seq 2) with bounds 100 microseconds later: another window, although
    the bounds are equal in milliseconds.
    """
    base = windows(spark, sf_dir, size, parts)
    hour = F.hour("window_start")

    def copy(seq: int, changed: dict[str, Column]) -> Column:
        fields = [changed.get(c, F.col(c)).alias(c) for c in base.columns]
        return F.struct(*fields, F.lit(seq).cast("bigint").alias("seq"))

    later = copy(1, {"total_events": F.col("total_events") + 1})
    empty = copy(
        -1,
        {
            "total_events": F.lit(0).cast("bigint"),
            "unique_users": F.lit(0).cast("bigint"),
            "avg_duration_ms": F.lit(0.0),
            "event_counts": F.expr(f"cast(map() AS {EVENT_COUNTS_TYPE})"),
            "top_pages": F.expr(f"cast(array() AS {TOP_PAGES_TYPE})"),
        },
    )
    moved = copy(
        2, {c: F.col(c) + F.expr("INTERVAL 100 MICROSECONDS") for c in ("window_start", "window_end")}
    )
    copies = F.array_compact(
        F.array(
            copy(0, {}),
            F.when(hour % 6 == 0, later),
            F.when(hour % 6 == 1, empty),
            F.when(hour % 6 == 2, moved),
        )
    )
    return base.select(F.inline(copies))
