"""Tumbling windows over an event stream.

``start_cells`` keeps no state: every micro-batch is reduced to counters and
appended to a cell log under its batch id, and ``read_windows`` adds the counters
up. Nothing is ever late, every event counts as soon as its batch is committed,
and the last window needs no flush. A replayed batch replaces its own folder, so
a restart neither loses nor doubles events.

``start_closed_windows`` emits each window once, after the watermark has passed
its end. That needs Spark's state store, which holds one counter per key of the
open windows, and an allowed delay after which late events are dropped.
"""

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from eventide.operators.windows import (
    DEFAULT_SIZE,
    merge_cells,
    quiet_windows,
    rollup,
    window_cells,
    window_facts,
    zero_fill,
)
from eventide.schemas import CELL, CELL_LOG, WINDOW_AT_REST
from eventide.sources.windows import from_at_rest, scan_windows, to_at_rest, union_windows
from eventide.streaming.runs import follow_runs, trigger

EVERY_CYCLE = "30 seconds"
# The dimension of counters that hold ticks and no events.
TICK = "tick"

# Files per dimension, and of windows, that a batch of closed windows writes at most.
CELL_FILES = 4


def start_cells(
    events: DataFrame,
    path: str,
    checkpoint: str,
    size: str = DEFAULT_SIZE,
    time_col: str = "timestamp",
    offset: str | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Append the counters of every micro-batch to the cell log at ``path``.

    ``time_col`` may be the arrival column of the source for windows by time of
    consumption. Events without a time have no window and are not counted here.
    """

    def append(batch: DataFrame, batch_id: int) -> None:
        cells = window_cells(batch, size, time_col, offset)
        days = cells.withColumn("day", F.to_date("window_start"))
        days.write.mode("overwrite").partitionBy("day", "dim").parquet(
            f"{path}/batch_id={batch_id}"
        )
        note_batch(batch.sparkSession, path, batch_id)

    return (
        events.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger(every))
        .start()
    )


def note_batch(spark: SparkSession, path: str, batch_id: int) -> None:
    """Note that all batches up to this one are complete; readers open those only.

    Batches follow one another, so one number is enough. It is kept in two places in
    turn: one of them is whole while the other is written.
    """
    line = spark.range(0, 1, 1, 1).select(F.lit(batch_id).cast("long").alias("id"))
    line.write.mode("overwrite").parquet(f"{path.rstrip('/')}.done/turn={batch_id % 2}")


def last_batch(spark: SparkSession, path: str) -> int | None:
    """The last complete batch, None without any."""
    try:
        notes = spark.read.schema("id long").option("ignoreMissingFiles", "true").parquet(f"{path.rstrip('/')}.done")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return notes.agg(F.max("id")).first()[0]


def read_cells(
    spark: SparkSession,
    path: str,
    base: tuple[str, int] | None = None,
    days: tuple[str, str] | None = None,
) -> DataFrame:
    """Counters of the log, unmerged: those of complete batches.

    ``base`` is the result of ``compact_cells``: its table stands in for all
    batches up to its batch id, whose folders are then not read. ``days`` limits the
    windows to a range of days and opens their folders only. A batch that is being
    written, or written again, is left out until it is complete.
    """
    schema = T.StructType([*CELL_LOG.fields, T.StructField("day", T.DateType())])
    done, known = last_batch(spark, path), base[1] if base else -1
    # The days come first, which also shows in a shortened plan.
    span = F.lit(True) if days is None else F.col("day").between(*[F.lit(d).cast("date") for d in days])
    if done is None or done <= known:
        frames = [spark.createDataFrame([], schema)]
    else:
        number = F.col("batch_id")
        frames = [spark.read.schema(schema).parquet(path).filter(span & (number > known) & (number <= done))]
    if base is not None:
        kept = T.StructType([*CELL.fields, T.StructField("day", T.DateType())])
        frames.append(spark.read.schema(kept).parquet(base[0]).filter(span))
    return union_windows(*frames).select(*CELL.names)


def compact_cells(
    spark: SparkSession,
    path: str,
    target: str,
    base: tuple[str, int] | None = None,
) -> tuple[str, int]:
    """Merge all complete batches (and an earlier ``base``) into ``target``.

    A scheduled job: returns the base to read with, and to compact on, from then on. The
    merged batch folders can be removed once nobody reads without it.
    """
    upto = last_batch(spark, path)
    merged = merge_cells(read_cells(spark, path, base)).withColumn("day", F.to_date("window_start"))
    merged.write.mode("overwrite").partitionBy("day", "dim").parquet(target)
    return target, upto


def read_windows(
    spark: SparkSession,
    path: str,
    size: str = DEFAULT_SIZE,
    base: tuple[str, int] | None = None,
    days: tuple[str, str] | None = None,
) -> DataFrame:
    """Windows of the ``size`` the log was written with, over all complete batches,
    open windows included; ``days`` limits them to a range of days."""
    return rollup(read_cells(spark, path, base, days), size)


def clock(spark: SparkSession, time_col: str = "timestamp") -> DataFrame:
    """A stream of instants, one a second: lets windows by arrival time close while no event comes."""
    return spark.readStream.format("rate").option("rowsPerSecond", 1).load().select(F.col("timestamp").alias(time_col))


def start_closed_windows(
    events: DataFrame,
    path: str,
    checkpoint: str,
    size: str = DEFAULT_SIZE,
    delay: str = "1 minute",
    offset: str | None = None,
    every: str | None = None,
    time_col: str = "timestamp",
    empty: bool = False,
    ticks: DataFrame | None = None,
    files: int = CELL_FILES,
) -> StreamingQuery:
    """Write each window once, when events up to ``delay`` late can no longer come.

    All counters of a window close in the same micro-batch, so the batch holds
    whole windows. They are written to ``<path>/cells`` first and rolled up from
    there: the stateful plan runs once, whatever the roll-up reads. Windows go
    to ``<path>/windows`` in stored form, one folder per batch, and one line per batch
    with the number of its windows and events to ``<path>/closed``. ``time_col`` may be the
    arrival column.

    ``ticks`` is a stream of instants in ``time_col`` (``clock``, for example). It joins the
    events ahead of the watermark, so time goes on while no event comes, and a window
    that holds ticks alone closes like any other, without events. ``empty`` adds, without ticks,
    the windows between those of a batch and after the last one of the batches before.

    Adaptive execution does not work in a stateful query, so the writes are sized here:
    counters are dealt by dimension and a few salts into ``files`` per dimension at most.
    A roll-up runs in a task per shuffle partition, and its windows are dealt into ``files``
    after it: were they coalesced, each task would fold many partitions one after the other
    and hold memory for all of them.
    """
    facts = window_facts(events, time_col)
    if ticks is not None:
        beat = ticks.filter(F.col(time_col).isNotNull()).select(
            time_col, F.lit(TICK).alias("dim"), F.lit("").alias("key"), F.lit(0.0).alias("d")
        )
        facts = facts.unionByName(beat)
    cells = (
        facts.withWatermark(time_col, delay)
        .groupBy(F.window(time_col, size, startTime=offset).alias("w"), "dim", "key")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("d").alias("duration"))
        .select(F.col("w.start").alias("window_start"), "dim", "key", "n", "duration")
    )
    dims = 3 if ticks is None else 4

    def emit(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        closed = f"{path}/cells/batch_id={batch_id}"
        salt = F.pmod(F.xxhash64("window_start", "key"), F.lit(files))
        dealt = batch.repartition(dims * files, "dim", salt)
        dealt.write.mode("overwrite").partitionBy("dim").parquet(closed)
        counters = spark.read.schema(CELL).parquet(closed)
        windows = rollup(counters, size)
        if ticks is not None:
            windows = windows.unionByName(quiet_windows(counters, size))
        finished = to_at_rest(windows).repartition(files, "window_start")
        finished.write.mode("overwrite").parquet(f"{path}/windows/batch_id={batch_id}")
        written = spark.read.schema(WINDOW_AT_REST).parquet(f"{path}/windows/batch_id={batch_id}")
        last = _last_start(spark, path, batch_id - 1)
        if empty:
            known = from_at_rest(written)
            if last is not None:
                # Where the batches before ended: a row that only holds the place.
                start = F.lit(last).cast("timestamp")
                place = {"window_start": start, "window_end": start + F.expr(f"INTERVAL {size}")}
                kinds = dict(known.dtypes)
                row = [place.get(c, F.lit(None)).cast(kinds[c]).alias(c) for c in known.columns]
                known = known.unionByName(spark.range(1).select(*row))
            added = to_at_rest(zero_fill(known, size).filter("total_events = 0"))
            added.repartition(files, "window_start").write.mode("overwrite").parquet(f"{path}/empty/batch_id={batch_id}")
        line = written.agg(
            F.count(F.lit(1)).alias("windows"),
            F.coalesce(F.sum("total_events"), F.lit(0)).alias("events"),
            F.greatest(F.max("window_start"), F.lit(last).cast("timestamp")).alias("upto"),
        )
        line.write.mode("overwrite").parquet(f"{path}/closed/batch_id={batch_id}")

    return (
        cells.writeStream.outputMode("append")
        .foreachBatch(emit)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger(every))
        .start()
    )


def _last_start(spark: SparkSession, path: str, batch_id: int) -> datetime | None:
    """The start of the last window written up to a batch, from that batch's line."""
    if batch_id < 0:
        return None
    return spark.read.schema("upto timestamp").parquet(f"{path}/closed/batch_id={batch_id}").first().upto


def read_closed_windows(spark: SparkSession, path: str) -> DataFrame:
    """The closed windows written so far, with the empty ones if they were asked for."""
    windows = scan_windows(spark, f"{path}/windows")
    try:
        return windows.unionByName(scan_windows(spark, f"{path}/empty"))
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return windows


def start_drain(
    spark: SparkSession,
    windows_path: str,
    target: str,
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Hand over stored windows once: each run of this query copies the runs of windows
    announced since the last.

    A batch that failed is repeated into the same folder, and a run of windows that is
    stored again is not announced again, so nothing is lost and nothing appears twice.
    """

    def hand_over(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    return follow_runs(spark, windows_path, checkpoint, hand_over, every)
