"""Named queries over a folder of test tables.

Each entry takes ``(spark, sf_dir)`` and runs one operator over the whole event
table. Results are given a neutral form for comparison with other engines:
zone-free timestamps, doubles rounded to six places, nested values as JSON.
"""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.operators import anchored, clean, distinct, reports, validate
from eventide.operators import windows as win
from eventide.plans.cycle import run_cycle, start_cycles
from eventide.session import run_dir
from eventide.sources import events as event_io
from eventide.sources import testdata as data
from eventide.sources import windows as window_io
from eventide.streaming import corrections, decode, tumbling

Query = Callable[[SparkSession, str], DataFrame]

# First and last day of the date-range query, in the middle of the test events.
FIRST_DAY, LAST_DAY = "2024-01-08", "2024-01-14"
CLOSE_DELAY = "10 minutes"
LOGGED_AT = "2024-02-01T00:00:00Z"


def present(df: DataFrame) -> DataFrame:
    """Neutral column types for comparison."""
    forms = []
    for name, kind in df.dtypes:
        column = F.col(name)
        if kind == "timestamp":
            column = column.cast("timestamp_ntz")
        elif kind == "double":
            column = F.round(column, 6)
        elif kind.startswith(("map", "array")):
            column = F.to_json(column)
        forms.append(column.alias(name))
    return df.select(*forms)


# --- events ---------------------------------------------------------------------


def decode_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = event_io.decode_events(data.events_json(spark, sf_dir))
    sorted_map = F.map_from_entries(F.array_sort(F.map_entries("metadata")))
    return present(event_io.accepted_events(decoded).withColumn("metadata", sorted_map))


def encode_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = event_io.encode_events(data.user_events(spark, sf_dir))
    back = F.from_json("value", "id string, event_type string, page string, duration_ms double")
    return present(encoded.select("key", back.alias("v")).select("key", "v.*"))


def validate_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = validate.validate_events(data.user_events(spark, sf_dir))
    return verdicts.select("id", "is_valid", F.array_join("errors", "; ").alias("errors"))


def validate_json_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.validate_json_events(data.events_json(spark, sf_dir)).select("id", "is_valid")


def validate_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = validate.validate_batch(data.event_batches(spark, sf_dir))
    return verdicts.select("batch_id", F.col("pos").cast("bigint").alias("pos"), "is_valid")


def validate_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten-minute windows, with a few averages beyond the limit."""
    windows = data.scalar_windows(spark, sf_dir, data.TEN_MINUTES)
    scaled = windows.withColumn("avg_duration_ms", F.col("avg_duration_ms") * 3)
    verdicts = validate.validate_windows(scaled)
    return present(
        verdicts.select("window_start", "is_valid", F.array_join("errors", "; ").alias("errors"))
    )


def validation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = validate.validate_events(data.user_events(spark, sf_dir))
    return validate.validation_summary(verdicts)


# --- window aggregation ---------------------------------------------------------


def _assigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return win.assign_windows(data.user_events(spark, sf_dir), data.HOUR)


def window_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(win.with_end(win.window_totals(_assigned(spark, sf_dir)), data.HOUR))


def window_unique_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(win.with_end(win.window_unique_users(_assigned(spark, sf_dir)), data.HOUR))


def window_avg_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(win.with_end(win.window_avg_duration(_assigned(spark, sf_dir)), data.HOUR))


def window_event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(win.event_counts(_assigned(spark, sf_dir)))


def window_top_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = win.top_pages(win.page_counts(_assigned(spark, sf_dir)))
    return present(
        ranked.select("window_start", F.col("rank").cast("bigint").alias("rank"), "page", "n")
    )


def window_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(win.window_aggregate(data.user_events(spark, sf_dir), data.HOUR))


def window_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same windows by way of mergeable counters."""
    path = run_dir(spark, "cells")
    cells = win.window_cells(data.user_events(spark, sf_dir), data.HOUR)
    cells.write.partitionBy("dim").parquet(path)
    return present(win.rollup(spark.read.schema(cells.schema).parquet(path), data.HOUR))


def windows_per_collector(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(anchored.anchored_windows(*data.collected_events(spark, sf_dir), data.HOUR))


def distinct_users_by_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users of each day, week and month from the hourly bitmaps of several runs, of which
    one was repeated."""
    path = run_dir(spark, "users")
    events = data.user_events(spark, sf_dir)
    part = data.part_of(F.dayofmonth("timestamp"))
    for k in (1, 0, *range(1, data.STREAM_PARTS)):
        distinct.add_run(events.filter(part == k), path, f"part-{k}", data.HOUR)
    bitmaps = distinct.read_bitmaps(spark, path)
    spans = [
        distinct.users_per(bitmaps, F.date_trunc(span, "window_start")).withColumn("span", F.lit(span))
        for span in ("day", "week", "month")
    ]
    return present(reduce(DataFrame.unionByName, spans))


def windows_zero_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = data.off_grid_windows(spark, sf_dir)
    return present(win.zero_fill(windows, data.TEN_MINUTES).drop("window_end"))


# --- streaming ------------------------------------------------------------------


def stream_window_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of several micro-batches, the parts of the table out of order."""
    path = run_dir(spark, "stream")
    events = data.stream_files(spark, sf_dir, f"{path}/events", (1, 0, 3, 2))
    tumbling.start_cells(
        events, f"{path}/cells", f"{path}/checkpoint", data.HOUR
    ).awaitTermination()
    return present(tumbling.read_windows(spark, f"{path}/cells", data.HOUR))


def stream_closed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "closed")
    events = data.stream_files(spark, sf_dir, f"{path}/events")
    tumbling.start_closed_windows(
        events, path, f"{path}/checkpoint", data.HOUR, CLOSE_DELAY
    ).awaitTermination()
    return present(window_io.from_at_rest(tumbling.read_closed_windows(spark, path)))


def stream_quiet_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows with and without events; the stream of events ends before that of ticks."""
    path = run_dir(spark, "quiet")
    events = data.stream_files(spark, sf_dir, f"{path}/events")
    ticks = data.tick_files(spark, sf_dir, f"{path}/ticks", data.TEN_MINUTES, CLOSE_DELAY)
    tumbling.start_closed_windows(
        events, path, f"{path}/checkpoint", data.TEN_MINUTES, CLOSE_DELAY, ticks=ticks
    ).awaitTermination()
    windows = tumbling.read_closed_windows(spark, path)
    return present(windows.select("window_start", "total_events", "unique_users", "avg_duration_ms"))


def _corrected(spark: SparkSession, sf_dir: str) -> str:
    """Closed windows with corrections: the second part of the table comes last, when all
    its windows are closed."""
    path = run_dir(spark, "late")
    events = data.stream_files(spark, sf_dir, f"{path}/events", (0, 2, 3, 1))
    corrections.start_corrected_windows(
        events, path, f"{path}/checkpoint", data.HOUR, CLOSE_DELAY
    ).awaitTermination()
    return path


def stream_late_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(corrections.late_counts(spark, _corrected(spark, sf_dir)))


def stream_corrected_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = corrections.read_corrected_windows(spark, _corrected(spark, sf_dir))
    return present(window_io.from_at_rest(windows.drop("batch_id")))


def _decoded(spark: SparkSession, sf_dir: str) -> str:
    """A stream of records, stored by outcome; every seventh has no time."""
    path = run_dir(spark, "decoded")
    undated = F.replace("value", F.lit('"timestamp"'), F.lit('"at"'))
    number = F.col("id").cast("bigint")
    records = data.events_json(spark, sf_dir).select(
        F.when(number % 7 == 0, undated).otherwise(F.col("value")).alias("value")
    )
    records.write.text(f"{path}/records")
    arrived = event_io.read_json_lines(spark, f"{path}/records")
    decode.start_decode(arrived, f"{path}/out", f"{path}/checkpoint").awaitTermination()
    return f"{path}/out"


def stream_decode_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of a stream by outcome."""
    return decode.outcome_counts(spark, _decoded(spark, sf_dir))


def stream_decode_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records by outcome, counted while they were decoded."""
    return decode.passing_counts(spark, _decoded(spark, sf_dir)).agg(
        *[F.sum(outcome).alias(outcome) for outcome in decode.OUTCOMES]
    )


def stream_drain_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hand over all windows in a first run; nothing is new in a second run, nor in a
    third, before which the windows were stored again."""
    path = run_dir(spark, "drain")
    windows = data.windows(spark, sf_dir)
    for run in (1, 2, 3):
        if run != 2:
            window_io.write_windows(windows, f"{path}/windows", "all")
        tumbling.start_drain(
            spark, f"{path}/windows", f"{path}/out/run={run}", f"{path}/checkpoint"
        ).awaitTermination()
    handed_over = window_io.scan_windows(spark, f"{path}/out", {"run": "bigint"})
    runs = spark.range(1, 4).withColumnRenamed("id", "run")
    counts = handed_over.groupBy("run").agg(F.count(F.lit(1)).alias("n"))
    return runs.join(counts, "run", "left").select(
        "run", F.coalesce("n", F.lit(0)).alias("new_rows")
    )


def cycles_in_turn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cycle per stored part of the windows, one part stored twice: a summary of each."""
    path = run_dir(spark, "cycles")
    windows = data.windows(spark, sf_dir)
    part = data.part_of(F.dayofmonth("window_start"))
    for k in (0, 1, *range(1, data.STREAM_PARTS)):
        window_io.write_windows(windows.filter(part == k), f"{path}/in", f"part-{k}")
        start_cycles(spark, f"{path}/in", f"{path}/out", f"{path}/checkpoint").awaitTermination()
    results = spark.read.option("basePath", f"{path}/out/reports/analysis_result").parquet(
        f"{path}/out/reports/analysis_result"
    )
    return present(results.select("total_windows", "total_events"))


# --- cleaning -------------------------------------------------------------------


def _dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaning does not look at pages."""
    return data.windows_dirty(spark, sf_dir, parts=["totals", "event_counts"])


def _cleaned(*steps: Callable[[DataFrame], DataFrame]) -> Query:
    """The cleaning chain up to and including the last of ``steps``."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = clean.load_columns(_dirty(spark, sf_dir))
        for step in steps:
            df = df.transform(step)
        return present(df.drop("seq"))

    return query


_CLEANING = [
    clean.dedup,
    clean.filter_nonempty,
    clean.cast_millis,
    clean.add_duration,
    clean.add_rate,
]


def clean_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(clean.clean_windows(_dirty(spark, sf_dir)))


def cleaning_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.cleaning_audit(data.windows_dirty(spark, sf_dir, parts=["totals"]))


# --- storage --------------------------------------------------------------------


def windows_at_rest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(data.windows_at_rest(spark, sf_dir))


def windows_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "windows")
    window_io.write_windows(data.windows(spark, sf_dir), path, "run")
    return present(window_io.load_windows(spark, path))


def windows_union_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One folder with files of today's layout next to others: without type counts and with
    narrower totals, with fractional totals, with a further column; and a folder that is not there."""
    path = run_dir(spark, "mixed")
    data.windows_at_rest(spark, sf_dir).write.parquet(f"{path}/now")
    stored = window_io.scan_windows(spark, f"{path}/now")
    total = F.col("total_events")
    layouts = [
        stored,
        stored.drop("event_counts").withColumn("total_events", total.cast("int")),
        stored.withColumn("total_events", total.cast("double")),
        stored.withColumn("collector", F.lit("c1")),
    ]
    for frame in layouts:
        frame.write.mode("append").parquet(f"{path}/mixed")
    return present(window_io.scan_folders(spark, f"{path}/mixed", f"{path}/absent"))


def window_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(window_io.export_windows(data.scalar_windows(spark, sf_dir)))


def window_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = data.stable(data.scalar_windows(spark, sf_dir))
    return present(window_io.window_log_lines(windows, LOGGED_AT))


# --- reports --------------------------------------------------------------------


def windows_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(
        reports.date_range(data.scalar_windows(spark, sf_dir), FIRST_DAY, LAST_DAY)
    )


def _type_counts(spark: SparkSession, sf_dir: str, size: str) -> DataFrame:
    return data.windows(spark, sf_dir, size, ["event_counts"])


def _report(
    report: Callable[[DataFrame], DataFrame],
    frame: Callable[..., DataFrame],
    size: str = data.HOUR,
) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(report(frame(spark, sf_dir, size)))

    return query


def performance_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = data.stable(data.scalar_windows(spark, sf_dir))
    return present(reports.performance_table(windows))


def hourly_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = data.scalar_windows(spark, sf_dir, data.TEN_MINUTES)
    cleaned = windows.transform(clean.filter_nonempty).transform(clean.cast_millis)
    return present(reports.hourly_rollup(cleaned))


def hourly_totals_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = data.scalar_windows(spark, sf_dir, data.TEN_MINUTES)
    return present(reports.hourly_totals_sql(spark, windows))


def peak_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    peak = reports.peak_window(data.scalar_windows(spark, sf_dir))
    return present(peak.select("window_start", "window_end", "total_events"))


def analysis_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = data.windows(spark, sf_dir, parts=["totals", "event_counts"])
    result = reports.analysis_result(windows, LOGGED_AT)
    peak = F.col("peak_window")
    return present(
        result.select(
            "total_windows",
            "total_events",
            "avg_events_per_window",
            peak.window_start.alias("peak_start"),
            peak.total_events.alias("peak_events"),
            "event_distribution",
            "generated_at",
        )
    )


def cycle_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole cycle with all its outputs: the run summary, and how many windows are clean."""
    path = run_dir(spark, "cycle")
    summary = run_cycle(spark, data.windows_dirty(spark, sf_dir), path, "run")
    clean_count = spark.read.parquet(f"{path}/windows_clean").agg(F.count(F.lit(1))).scalar()
    return present(summary.withColumn("clean_windows", clean_count))


def queries() -> dict[str, Query]:
    return {
        "decode_events": decode_events,
        "encode_events": encode_events,
        "validate_events": validate_events,
        "validate_json_events": validate_json_events,
        "validate_batch": validate_batch,
        "validate_windows": validate_windows,
        "validation_summary": validation_summary,
        "window_totals": window_totals,
        "window_event_counts": window_event_counts,
        "window_unique_users": window_unique_users,
        "window_avg_duration": window_avg_duration,
        "window_top_pages": window_top_pages,
        "window_aggregate": window_aggregate,
        "window_rollup": window_rollup,
        "distinct_users_by_span": distinct_users_by_span,
        "windows_zero_filled": windows_zero_filled,
        "windows_per_collector": windows_per_collector,
        "stream_window_aggregate": stream_window_aggregate,
        "stream_closed_windows": stream_closed_windows,
        "stream_quiet_windows": stream_quiet_windows,
        "stream_late_events": stream_late_events,
        "stream_corrected_windows": stream_corrected_windows,
        "stream_decode_split": stream_decode_split,
        "stream_decode_counts": stream_decode_counts,
        "stream_drain_once": stream_drain_once,
        "cycles_in_turn": cycles_in_turn,
        "clean_dedup": _cleaned(*_CLEANING[:1]),
        "clean_filter_nonempty": _cleaned(*_CLEANING[:2]),
        "clean_cast_ms": _cleaned(*_CLEANING[:3]),
        "clean_duration": _cleaned(*_CLEANING[:4]),
        "clean_events_per_second": _cleaned(*_CLEANING[:5]),
        "clean_windows": clean_windows,
        "cleaning_audit": cleaning_audit,
        "windows_at_rest": windows_at_rest,
        "windows_roundtrip": windows_roundtrip,
        "windows_union_schemas": windows_union_schemas,
        "window_export": window_export,
        "window_log_lines": window_log_lines,
        "windows_date_range": windows_date_range,
        "events_timeseries": _report(reports.events_timeseries, data.scalar_windows),
        "performance_table": performance_table,
        "hourly_rollup": hourly_rollup,
        "hourly_report": _report(reports.hourly_report, data.scalar_windows, data.TEN_MINUTES),
        "hourly_totals": _report(reports.hourly_totals, data.scalar_windows, data.TEN_MINUTES),
        "hourly_totals_sql": hourly_totals_sql,
        "users_heatmap": _report(reports.users_heatmap, data.scalar_windows),
        "users_heatmap_pivot": _report(reports.users_heatmap_pivot, data.scalar_windows),
        "analysis_summary": _report(reports.analysis_summary, data.scalar_windows),
        "peak_window": peak_window,
        "analysis_result": analysis_result,
        "kpi_metrics": _report(reports.kpi_metrics, data.scalar_windows),
        "duration_histogram": _report(reports.duration_histogram, data.scalar_windows),
        "duration_histogram_round": _report(reports.round_histogram, data.scalar_windows),
        "event_distribution": _report(reports.event_distribution, _type_counts),
        "event_distribution_json": _report(
            reports.event_distribution_json, data.stored_event_counts
        ),
        "event_distribution_filtered": _report(
            reports.event_distribution_filtered, data.stored_event_counts
        ),
        "event_type_shares": _report(reports.event_type_shares, data.stored_event_counts),
        "page_totals": _report(reports.page_totals, data.stored_top_pages),
        "top_pages": _report(reports.top_pages, data.stored_top_pages),
        "page_shares": _report(reports.page_shares, data.stored_top_pages),
        "cycle_summary": cycle_summary,
    }
