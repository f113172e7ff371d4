"""Windows of a stream with late rows kept and counted: every change is a new version.

A batch splits its events by the watermark that the batches before it reached: those
of windows that are already closed are kept with the reason, and count all the same.
A window is written when the watermark passes its end, and again, as a corrected
version, when late rows reach it; the latest version counts.

Counters are laid out by day, then by batch, so closing and correcting open the days
concerned and nothing else. What a batch needs of those before it is one number.
"""

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from eventide.functions.timebins import tumbling
from eventide.operators.windows import DEFAULT_SIZE, rollup, window_cells
from eventide.schemas import CELL, WINDOW_AT_REST
from eventide.sources.windows import scan_windows, to_at_rest
from eventide.streaming.runs import trigger

_NOTE = "id long, seen long"


def _notes(spark: SparkSession, path: str) -> DataFrame | None:
    """The notes of the last two batches: number, and the latest time seen so far in microseconds."""
    try:
        return spark.read.schema(_NOTE).option("ignoreMissingFiles", "true").parquet(f"{path}/noted")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _seen(spark: SparkSession, path: str, batch_id: int) -> int | None:
    """The latest time that the batches up to this one saw, in microseconds."""
    notes = _notes(spark, path)
    return notes.filter(F.col("id") == batch_id).agg(F.max("seen")).first()[0] if notes is not None else None


def _last(spark: SparkSession, path: str) -> int:
    notes = _notes(spark, path)
    last = notes.agg(F.max("id")).first()[0] if notes is not None else None
    return -1 if last is None else last


def _at(micros: int, delay: str) -> Column:
    return F.timestamp_micros(F.lit(micros)) - F.expr(f"INTERVAL {delay}")


def _cells_of(spark: SparkSession, path: str, days: list[str]) -> DataFrame:
    """Counters of some days; opens no other day's folder."""
    schema = T.StructType([*CELL.fields, T.StructField("day", T.DateType())])
    reader = spark.read.schema(schema).option("basePath", path)
    try:
        return reader.parquet(f"{path}/day={{{','.join(days)}}}") if days else spark.createDataFrame([], schema)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def start_corrected_windows(
    events: DataFrame,
    path: str,
    checkpoint: str,
    size: str = DEFAULT_SIZE,
    delay: str = "1 minute",
    offset: str | None = None,
    every: str | None = None,
    time_col: str = "timestamp",
) -> StreamingQuery:
    """Write windows when they close and whenever late rows change them.

    Below ``path`` each batch has its late rows (``late``), the windows it closed or
    corrected (``windows``) and its counters (``cells``). Events are read once: a batch is held while its
    late rows and counters are written. A batch repeated after a failure replaces what
    it wrote. Events without a time have no window and are not counted here.
    """
    step = F.expr(f"INTERVAL {size}")

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = _seen(spark, path, batch_id - 1)
        dated = batch.filter(F.col(time_col).isNotNull()).persist()
        try:
            seen = dated.agg(F.unix_micros(F.max(time_col))).first()[0]
            seen = max((x for x in (seen, before) if x is not None), default=None)
            _write_late(dated, before, batch_id)
            cells = window_cells(dated, size, time_col, offset)
            cells = cells.withColumns({"day": F.to_date("window_start"), "batch_id": F.lit(batch_id)})
            cells.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
                "day", "batch_id", "dim"
            ).parquet(f"{path}/cells")
        finally:
            dated.unpersist()
        if seen is not None:
            _write_windows(spark, before, seen, batch_id)
        note = spark.range(0, 1, 1, 1).select(F.lit(batch_id).cast("long").alias("id"), F.lit(seen).cast("long").alias("seen"))
        note.write.mode("overwrite").parquet(f"{path}/noted/turn={batch_id % 2}")

    def _write_late(dated: DataFrame, before: int | None, batch_id: int) -> None:
        start = tumbling(time_col, size, offset).start
        placed = dated.withColumn("window_start", start)
        if before is None:
            late = placed.filter("false").withColumn("reason", F.lit(""))
        else:
            closed = _at(before, delay)
            reason = F.concat(F.lit("window closed at "), (F.col("window_start") + step).cast("string"), F.lit(", watermark "), closed.cast("string"))
            late = placed.filter(F.col("window_start") + step <= closed).withColumn("reason", reason)
        late.write.mode("overwrite").parquet(f"{path}/late/batch_id={batch_id}")

    def _write_windows(spark: SparkSession, before: int | None, seen: int, batch_id: int) -> None:
        """Windows that this batch's watermark closes, and closed ones that its late rows change."""
        late = spark.read.schema("window_start timestamp").parquet(f"{path}/late/batch_id={batch_id}").distinct()
        # With the first batch, every window up to its watermark closes.
        bounds = _days(spark, path, before, seen, late)
        cells = _cells_of(spark, f"{path}/cells", bounds).join(late.withColumn("corrected", F.lit(True)), "window_start", "left")
        end = F.col("window_start") + step
        closing = end <= _at(seen, delay)
        if before is not None:
            closing = closing & (end > _at(before, delay))
        affected = cells.filter(closing | F.col("corrected")).select(*CELL.names)
        versions = to_at_rest(rollup(affected, size))
        versions.write.mode("overwrite").parquet(f"{path}/windows/batch_id={batch_id}")

    def _days(spark: SparkSession, path: str, before: int | None, seen: int, late: DataFrame) -> list[str]:
        """Days with windows to write, as their folders are named."""
        until = F.to_date(_at(seen, delay))
        if before is None:
            # Nothing was written before this batch, so these are its own days.
            days = spark.read.schema("day date").parquet(f"{path}/cells").select("day")
        else:
            first = F.to_date(_at(before, delay) - step)
            days = spark.range(1).select(F.explode(F.sequence(first, F.greatest(first, until))).alias("day"))
            days = days.unionByName(late.select(F.to_date("window_start").alias("day")))
        return sorted(str(r.day) for r in days.distinct().collect())

    return (
        events.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger(every))
        .start()
    )


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows that came after their window was closed: ``window_start``, ``reason`` and ``batch_id`` besides their own columns."""
    rows = spark.read.option("basePath", f"{path}/late").parquet(f"{path}/late")
    return rows.filter(F.col("batch_id") <= _last(spark, path))


def late_counts(spark: SparkSession, path: str) -> DataFrame:
    """Late rows per window; reads the late rows alone."""
    return late_rows(spark, path).groupBy("window_start").agg(F.count(F.lit(1)).alias("late"))


def read_corrected_windows(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The latest version of every closed window, as stored, with the batch that wrote it; or
    the latest as of the batch ``version``."""
    upto = _last(spark, path) if version is None else version
    stored = scan_windows(spark, f"{path}/windows", {"batch_id": "long"}).filter(F.col("batch_id") <= upto)
    names = [*WINDOW_AT_REST.names, "batch_id"]
    latest = stored.groupBy("window_start").agg(F.max_by(F.struct(*names), "batch_id").alias("w"))
    return latest.select("w.*")
