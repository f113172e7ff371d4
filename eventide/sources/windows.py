"""Storage of window tables."""

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.functions.text import fixed2_sql, rfc3339
from eventide.functions.timebins import to_millis
from eventide.schemas import (
    EVENT_COUNTS_TYPE,
    TOP_PAGES_TYPE,
    WINDOW_AT_REST,
    WINDOW_EXPORT_COLUMNS,
)
from eventide.sources.layouts import read_mixed


def to_at_rest(windows: DataFrame) -> DataFrame:
    """Stored form: nested columns as JSON text, bounds in milliseconds.

    Columns outside the window schema (an arrival number, for example) are kept.
    """
    extra = [c for c in windows.columns if c not in WINDOW_AT_REST.names]
    return windows.select(
        to_millis(F.col("window_start")).alias("window_start"),
        to_millis(F.col("window_end")).alias("window_end"),
        "total_events",
        "unique_users",
        "avg_duration_ms",
        F.to_json("top_pages").alias("top_pages"),
        F.to_json("event_counts").alias("event_counts"),
        *extra,
    )


def from_at_rest(stored: DataFrame) -> DataFrame:
    """Typed form of stored windows; null or empty JSON gives empty collections."""
    extra = [c for c in stored.columns if c not in WINDOW_AT_REST.names]
    counts = F.from_json("event_counts", EVENT_COUNTS_TYPE)
    pages = F.from_json("top_pages", TOP_PAGES_TYPE)
    return stored.select(
        "window_start",
        "window_end",
        F.col("total_events").cast("bigint").alias("total_events"),
        F.coalesce(counts, F.expr(f"cast(map() AS {EVENT_COUNTS_TYPE})")).alias("event_counts"),
        F.col("unique_users").cast("bigint").alias("unique_users"),
        "avg_duration_ms",
        F.coalesce(pages, F.expr(f"cast(array() AS {TOP_PAGES_TYPE})")).alias("top_pages"),
        *extra,
    )


def write_windows(windows: DataFrame, path: str, run_id: str) -> str:
    """Store one run's windows below ``path``, partitioned by run and day.

    A repeated run replaces its own folder and nothing else. The rebalance hint gives
    each day files of a sensible size and splits a day that holds most of the rows. A
    run without rows leaves an empty folder, which ``scan_windows`` reads as a typed,
    empty table. Once the folder is complete the run is announced in the run log next to
    ``path``, unless it was before: whoever hands windows over follows the log, not the
    files, and so sees whole runs only, and each once. A run has one writer at a time.
    Returns the folder of the run.
    """
    target = f"{path}/run_id={run_id}"
    days = to_at_rest(windows).withColumn("window_date", F.to_date("window_start"))
    days.hint("rebalance", "window_date").write.mode("overwrite").partitionBy("window_date").parquet(target)
    announce_run(windows.sparkSession, path, run_id)
    return target


RUN_LOG = "run_id string"


def run_log(path: str) -> str:
    """Where the finished runs of a window folder are noted."""
    return f"{path.rstrip('/')}.runs"


def announce_run(spark: SparkSession, path: str, run_id: str) -> None:
    """Note a finished run in the log, in a folder of its own; a run in the log stays as it is.

    An announcement that was cut off left no row and is written again.
    """
    folder = f"{run_log(path)}/run-{run_id}"
    try:
        known = not spark.read.schema(RUN_LOG).parquet(folder).isEmpty()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        known = False
    if not known:
        line = spark.range(0, 1, 1, 1).select(F.lit(run_id).alias("run_id"))
        line.write.mode("overwrite").parquet(folder)


def scan_runs(
    spark: SparkSession, path: str, run_ids: list[str], extra: dict[str, str] | None = None
) -> DataFrame:
    """Stored windows of some runs; opens no other run's folder."""
    more = T.StructType.fromDDL(", ".join(f"`{n}` {kind}" for n, kind in (extra or {}).items()))
    schema = T.StructType(WINDOW_AT_REST.fields + more.fields)
    reader = spark.read.schema(schema).option("basePath", path)
    return reader.parquet(*[f"{path}/run_id={r}" for r in run_ids]).select(*schema.names)


def scan_windows(
    spark: SparkSession, path: str, extra: dict[str, str] | None = None
) -> DataFrame:
    """All stored windows below ``path``, in the stored schema.

    The schema is given, so no file footer is opened to infer it: files written
    before a column existed give null for it, and narrower integers widen.
    ``extra`` names further columns to read with their types, partition columns
    such as ``run_id`` and ``window_date`` included. A folder without files gives no
    rows; for folders that differ in layout or may be absent see ``scan_folders``.
    """
    more = T.StructType.fromDDL(", ".join(f"`{n}` {kind}" for n, kind in (extra or {}).items()))
    schema = T.StructType(WINDOW_AT_REST.fields + more.fields)
    return (
        spark.read.schema(schema)
        .option("recursiveFileLookup", "false" if extra else "true")
        .parquet(path)
        .select(*schema.names)
    )


def load_windows(spark: SparkSession, path: str) -> DataFrame:
    """Stored windows in typed form."""
    return from_at_rest(scan_windows(spark, path))


def union_windows(*frames: DataFrame) -> DataFrame:
    """Union by column name; absent columns become null, types widen."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def scan_folders(spark: SparkSession, *folders: str) -> DataFrame:
    """All windows of folders whose files differ in layout, by start.

    Layouts may differ from file to file of one folder: absent columns are null, types
    widen (see ``layouts``), further columns stay. A folder that does not exist adds
    nothing; without any file, the result is an empty table in the stored schema.
    """
    found = read_mixed(spark, *folders)
    if found is None:
        found = spark.createDataFrame([], WINDOW_AT_REST)
    return found.orderBy("window_start")


def export_windows(windows: DataFrame) -> DataFrame:
    """Exchange form: the scalar columns, bounds in milliseconds."""
    return windows.select(
        *[
            to_millis(F.col(c)).alias(c) if c in ("window_start", "window_end") else F.col(c)
            for c in WINDOW_EXPORT_COLUMNS
        ]
    )


def import_windows(exported: DataFrame) -> DataFrame:
    """Windows from the exchange form; the nested columns come back empty."""
    return exported.select(
        "window_start",
        "window_end",
        "total_events",
        F.expr(f"cast(map() AS {EVENT_COUNTS_TYPE})").alias("event_counts"),
        "unique_users",
        "avg_duration_ms",
        F.expr(f"cast(array() AS {TOP_PAGES_TYPE})").alias("top_pages"),
    )


def window_log_lines(windows: DataFrame, logged_at: str) -> DataFrame:
    """One JSON log line per window, keys in order.

    ``logged_at`` is the instant to print, so that a rerun gives the same text.
    """
    line = F.to_json(
        F.struct(
            F.expr(fixed2_sql("avg_duration_ms")).alias("avg_duration"),
            F.lit("INFO").alias("level"),
            F.lit("window aggregated").alias("msg"),
            F.col("total_events"),
            F.lit(logged_at).alias("ts"),
            F.col("unique_users"),
            rfc3339(F.col("window_end")).alias("window_end"),
            rfc3339(F.col("window_start")).alias("window_start"),
        )
    )
    return windows.select("window_start", line.alias("line"))


def write_log_lines(windows: DataFrame, path: str, logged_at: str) -> None:
    window_log_lines(windows, logged_at).select("line").write.mode("append").text(path)
