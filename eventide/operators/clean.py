"""Cleaning of window tables and the audit of its steps."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventide.functions.timebins import to_millis

KEY = ["window_start", "window_end"]

# Step descriptions and line forms of the audit log.
STEPS = [
    "Конвертация в DataFrame",
    "Удаление дубликатов",
    "Фильтрация total_events > 0",
    "Приведение типов datetime[ms, UTC]",
    "Добавление window_duration_sec",
    "Добавление events_per_second",
]
STEP_LINE = "Шаг %d: %s (было %d строк → стало %d строк)"
TOTAL_LINE = "Итого: финальный DataFrame содержит %d строк, %d колонок"

CLEAN_COLUMNS = [
    "window_start",
    "window_end",
    "total_events",
    "unique_users",
    "avg_duration_ms",
    "event_counts",
    "window_duration_sec",
    "events_per_second",
]


def load_columns(windows: DataFrame, seq: str = "seq") -> DataFrame:
    """The columns cleaning works on; per-type counts become JSON text."""
    counts = F.col("event_counts")
    if dict(windows.dtypes)["event_counts"] != "string":
        counts = F.to_json(counts)
    return windows.select(
        *KEY,
        "total_events",
        "unique_users",
        "avg_duration_ms",
        counts.alias("event_counts"),
        seq,
    )


def dedup(windows: DataFrame, seq: str = "seq") -> DataFrame:
    """Keep the first row per window bounds in arrival order ``seq``.

    ``seq`` must not repeat within equal bounds. The rank filter keeps one row
    per key in every task before the shuffle, so a window copied any number of
    times does not load a single task.
    """
    order = Window.partitionBy(*KEY).orderBy(F.asc(seq))
    return (
        windows.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").drop("_rank")
    )


def filter_nonempty(windows: DataFrame) -> DataFrame:
    return windows.filter("total_events > 0")


def cast_millis(windows: DataFrame) -> DataFrame:
    """Bounds to millisecond precision; comes after ``dedup``."""
    return windows.withColumns({name: to_millis(F.col(name)) for name in KEY})


def add_duration(windows: DataFrame) -> DataFrame:
    span = F.unix_millis("window_end") - F.unix_millis("window_start")
    return windows.withColumn("window_duration_sec", span / F.lit(1000.0))


def add_rate(windows: DataFrame) -> DataFrame:
    """``events_per_second``; 0.0 for a window without extent."""
    duration = F.col("window_duration_sec")
    return windows.withColumn(
        "events_per_second",
        F.when(duration > 0, F.col("total_events").cast("double") / duration).otherwise(0.0),
    )


def clean_windows(windows: DataFrame, seq: str = "seq") -> DataFrame:
    """All cleaning steps in their order, as one plan with one shuffle.

    Duplicates go before empty windows: when the first copy of a window is
    empty, the window disappears although a later copy has events.
    """
    return (
        load_columns(windows, seq)
        .transform(dedup, seq)
        .transform(filter_nonempty)
        .transform(cast_millis)
        .transform(add_duration)
        .transform(add_rate)
        .select(*CLEAN_COLUMNS)
    )


def cleaning_audit(windows: DataFrame, seq: str = "seq") -> DataFrame:
    """Rows before and after each of the six steps, from one pass.

    Per key only a row count and the first copy's total are needed; both combine
    map-side in fixed-size buffers.
    """
    per_key = windows.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("copies"), F.min_by("total_events", seq).alias("first_total")
    )
    counts = per_key.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("loaded"),
        F.count(F.lit(1)).alias("distinct"),
        F.count_if(F.col("first_total") > 0).alias("kept"),
    )
    befores = ["loaded", "loaded", "distinct", "kept", "kept", "kept"]
    afters = ["loaded", "distinct", "kept", "kept", "kept", "kept"]
    rows = F.array(
        *[
            F.struct(
                F.lit(i + 1).cast("bigint").alias("step"),
                F.lit(STEPS[i]).alias("description"),
                F.col(befores[i]).alias("rows_before"),
                F.col(afters[i]).alias("rows_after"),
            )
            for i in range(len(STEPS))
        ]
    )
    return counts.select(F.inline(rows))


def audit_lines(audit: DataFrame) -> DataFrame:
    """The audit as log lines (``line_no``, ``line``), closing with the final size."""
    steps = audit.select(
        F.col("step").alias("line_no"),
        F.format_string(STEP_LINE, "step", "description", "rows_before", "rows_after").alias("line"),
    )
    final = audit.filter(F.col("step") == len(STEPS)).select(
        (F.col("step") + 1).alias("line_no"),
        F.format_string(TOTAL_LINE, "rows_after", F.lit(len(CLEAN_COLUMNS))).alias("line"),
    )
    return steps.unionByName(final)
