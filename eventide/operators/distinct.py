"""Distinct users that add up: bitmaps per window over numbered users.

A count of distinct users cannot be added to another one, so a day's users do not follow
from its hours'. Bitmaps can be united. ``add_run`` numbers the users it has not seen
before, once and for all, and stores one bitmap for each window and block of 32,768
numbers. ``users_per`` unites the bitmaps of any span, so days, weeks or months are read
without events and without user names: a span costs its windows times the blocks, whatever
the number of events.

Bitmaps have a fixed width of 4 KB, so they pay for windows of an hour or more; for
short windows with few users the counters of ``operators.windows`` are smaller.
"""

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.functions.timebins import tumbling

# Numbers are given out shard by shard, so that tasks share the work. A shard takes every
# SHARDS-th number; as users fall evenly on shards by their hash, few numbers stay unused.
SHARDS = 4096

USERS = T.StructType([T.StructField("user_id", T.StringType()), T.StructField("number", T.LongType())])
BITMAPS = T.StructType(
    [
        T.StructField("window_start", T.TimestampType()),
        T.StructField("block", T.LongType()),
        T.StructField("users", T.BinaryType()),
        T.StructField("day", T.DateType()),
    ]
)


def _shard(user: str) -> Column:
    return F.pmod(F.xxhash64(user), F.lit(SHARDS))


def read_users(spark: SparkSession, path: str) -> DataFrame:
    """The numbered users: user_id, number (from 1)."""
    try:
        return spark.read.schema(USERS).parquet(f"{path}/users")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], USERS)


def number_users(users: DataFrame, path: str) -> DataFrame:
    """Give a number to every user of ``users`` that has none; returns all numbered users.

    A number is never given out again or changed, so a run that is repeated finds its
    users numbered. One job at a time may add users.
    """
    spark = users.sparkSession
    known = read_users(spark, path)
    taken = known.groupBy(_shard("user_id").alias("shard")).agg(F.max("number").alias("top"))
    new = users.select("user_id").distinct().join(known, "user_id", "left_anti")
    turn = F.row_number().over(Window.partitionBy("shard").orderBy("user_id"))
    placed = new.withColumn("shard", _shard("user_id")).withColumn("turn", turn)
    # The top of a shard without users is the number before its first.
    top = F.coalesce("top", F.col("shard") + 1 - SHARDS)
    numbered = placed.join(taken, "shard", "left").select(
        "user_id", (top + F.col("turn") * SHARDS).cast("long").alias("number")
    )
    numbered.write.mode("append").parquet(f"{path}/users")
    return read_users(spark, path)


def add_run(
    events: DataFrame,
    path: str,
    run_id: str,
    size: str = "1 hour",
    time_col: str = "timestamp",
    offset: str | None = None,
) -> None:
    """Store the bitmaps of a run's events below ``path``; a repeated run replaces its own.

    Only the time and the user are read. Each task keeps one row per window and user before
    anything is shuffled, so a busy user or window is no hot key. A missing user counts as
    the empty one; events without a time have no window.
    """
    start = tumbling(time_col, size, offset).start
    seen = (
        events.filter(F.col(time_col).isNotNull())
        .select(start.alias("window_start"), F.coalesce("user_id", F.lit("")).alias("user_id"))
        .distinct()
    )
    numbered = seen.join(number_users(seen, path), "user_id")
    bitmaps = numbered.groupBy("window_start", F.bitmap_bucket_number("number").alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("users")
    )
    days = bitmaps.withColumn("day", F.to_date("window_start"))
    days.hint("rebalance", "day").write.mode("overwrite").partitionBy("day").parquet(f"{path}/bitmaps/run_id={run_id}")


def read_bitmaps(
    spark: SparkSession, path: str, days: tuple[str, str] | None = None
) -> DataFrame:
    """Bitmaps of all runs, not united; ``days`` opens the folders of a range of days only."""
    stored = spark.read.schema(BITMAPS).parquet(f"{path}/bitmaps")
    if days is not None:
        stored = stored.filter(F.col("day").between(*[F.lit(d).cast("date") for d in days]))
    return stored.select("window_start", "block", "users")


def users_per(bitmaps: DataFrame, span: Column) -> DataFrame:
    """Distinct users per value of ``span``, an expression of ``window_start``.

    Rows: span_start, unique_users. Windows stored by several runs, or twice, are united.
    """
    united = bitmaps.groupBy(span.alias("span_start"), "block").agg(F.bitmap_or_agg("users").alias("users"))
    return united.groupBy("span_start").agg(F.sum(F.bitmap_count("users")).alias("unique_users"))
