"""The batch cycle: gate, store, clean, report."""

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventide.operators import reports
from eventide.operators.clean import audit_lines, clean_windows, cleaning_audit
from eventide.operators.validate import validate_windows
from eventide.sources.windows import (
    from_at_rest,
    scan_runs,
    scan_windows,
    to_at_rest,
    write_windows,
)
from eventide.streaming.runs import follow_runs

# Reports over the stored windows of a run, by output folder.
REPORTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "event_distribution": reports.event_distribution_json,
    "hourly_report": reports.hourly_report,
    "hourly_totals": reports.hourly_totals,
}

# What the dashboard shows, over a range of days of all stored windows.
DASHBOARD: dict[str, Callable[[DataFrame], DataFrame]] = {
    "kpi_metrics": reports.kpi_metrics,
    "events_timeseries": reports.events_timeseries,
    "page_shares": reports.page_shares,
    "event_distribution_filtered": reports.event_distribution_filtered,
    "top_pages": reports.top_pages,
    "performance_table": reports.performance_table,
}


def run_cycle(
    spark: SparkSession,
    windows: DataFrame,
    out: str,
    run_id: str,
    seq: str = "seq",
    generated_at: str | None = None,
) -> DataFrame | None:
    """Process one hand-over of windows; returns the one-row run summary.

    ``windows`` has the window columns plus the arrival order ``seq``, of any
    type that sorts. The input is read once, to judge it and to keep the verdicts with
    full precision of the bounds under ``judged``. Everything after that reads the
    run's own folders: windows that passed the gate go to ``windows``, duplicates and
    empty ones included, those that failed to ``windows_rejected`` with the reasons;
    cleaning and its audit work on the full precision, so duplicates are told before
    bounds are cut to milliseconds; the reports read the stored windows.
    Each output folder belongs to the run and is replaced when the run is
    repeated. Without windows there are no reports and the result is None.
    ``generated_at`` is noted in the summary, by default the current time.
    """
    judged = f"{out}/judged/run_id={run_id}"
    verdicts = validate_windows(windows)
    verdicts.write.mode("overwrite").partitionBy("is_valid").parquet(judged)
    arrived = spark.read.schema(verdicts.schema).parquet(judged)
    if arrived.isEmpty():
        return None

    def save(frame: DataFrame, name: str) -> None:
        frame.write.mode("overwrite").parquet(f"{out}/{name}/run_id={run_id}")

    save(to_at_rest(arrived.filter("NOT is_valid").drop("is_valid")), "windows_rejected")
    passed = arrived.filter("is_valid").drop("is_valid", "errors")
    write_windows(passed, f"{out}/windows", run_id)
    save(clean_windows(passed, seq), "windows_clean")
    save(audit_lines(cleaning_audit(passed, seq)), "cleaning_audit")
    stored = scan_runs(spark, f"{out}/windows", [run_id])
    noted = generated_at or datetime.now(timezone.utc).isoformat()
    save(reports.analysis_result(stored, noted), "reports/analysis_result")
    for name, report in REPORTS.items():
        save(report(stored), f"reports/{name}")
    return cycle_summary(spark, out, run_id)


def scan_stored(spark: SparkSession, out: str) -> DataFrame:
    """Stored windows of all runs with their partition columns."""
    return scan_windows(spark, f"{out}/windows", {"run_id": "string", "window_date": "date"})


def rejected(spark: SparkSession, out: str) -> DataFrame:
    """Windows the gate turned away, with the reasons."""
    kinds = {"errors": "array<string>", "run_id": "string"}
    stored = scan_windows(spark, f"{out}/windows_rejected", kinds)
    return stored.select("run_id", "window_start", "window_end", "errors")


def cycle_summary(spark: SparkSession, out: str, run_id: str) -> DataFrame:
    """The summary of a finished run, from its stored result."""
    result = spark.read.parquet(f"{out}/reports/analysis_result/run_id={run_id}")
    return result.select(
        "total_windows",
        "total_events",
        "avg_events_per_window",
        F.col("peak_window.window_start").alias("peak_start"),
        F.col("peak_window.total_events").alias("peak_events"),
    )


def compact_days(spark: SparkSession, out: str, upto: str) -> None:
    """Lay the windows of all days before ``upto`` out by day, under ``windows_by_day``.

    A scheduled job. Runs add many small folders; a day that has passed becomes one
    folder, replaced as a whole when the job is repeated.
    """
    days = scan_stored(spark, out).filter(F.col("window_date") < F.lit(upto).cast("date"))
    days.hint("rebalance", "window_date").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("window_date").parquet(f"{out}/windows_by_day")


def scan_days(spark: SparkSession, out: str) -> DataFrame:
    """Windows laid out by day; a range of days opens those folders only."""
    return scan_windows(
        spark, f"{out}/windows_by_day", {"run_id": "string", "window_date": "date"}
    )


def write_dashboard(
    spark: SparkSession, out: str, first_day: str, last_day: str, compacted: bool = False
) -> None:
    """Write the dashboard's tables for a range of days over all runs.

    ``compacted`` reads the layout by day, which lists no runs.
    """
    stored = scan_days(spark, out) if compacted else scan_stored(spark, out)
    selected = reports.date_range(stored, first_day, last_day)
    for name, report in DASHBOARD.items():
        report(selected).write.mode("overwrite").parquet(f"{out}/dashboard/{name}")


def start_cycles(
    spark: SparkSession,
    windows_path: str,
    out: str,
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Run a cycle for whatever runs of windows were stored since the last one.

    ``every`` ("30 seconds", for example) keeps going at that interval; without
    it the query works off what is there and stops. The run id is the batch id,
    so a batch that is repeated after a failure replaces its own outputs; a run that
    is stored again is not processed again. Windows are ordered as they were
    written: by file time, file, and row in the file.
    """

    def cycle(batch: DataFrame, batch_id: int) -> None:
        run_cycle(batch.sparkSession, batch, out, f"batch-{batch_id}")

    order = F.struct(
        "_metadata.file_modification_time", "_metadata.file_path", "_metadata.row_index"
    )
    return follow_runs(
        spark, windows_path, checkpoint, cycle, every, lambda df: from_at_rest(df.withColumn("seq", order))
    )
