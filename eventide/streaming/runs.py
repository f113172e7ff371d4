"""Following the run log of stored windows: each run is handed on once."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from eventide.schemas import WINDOW_AT_REST
from eventide.sources.windows import RUN_LOG, run_log


def trigger(every: str | None) -> dict:
    """Run through what is there and stop, or keep going at an interval."""
    return {"processingTime": every} if every else {"availableNow": True}


def follow_runs(
    spark: SparkSession,
    windows_path: str,
    checkpoint: str,
    handle: Callable[[DataFrame, int], None],
    every: str | None = None,
    read: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> StreamingQuery:
    """Call ``handle`` with the windows of the runs announced since the last call.

    A run is in the log once, however often it is stored, and the stream's checkpoint
    holds how far the log was read: nothing else is kept, so a batch costs the same
    after any number of runs. A batch repeated after a failure takes the same runs
    again. Only the ids of the batch's own runs come to the driver.
    """
    windows_path = windows_path.rstrip("/")

    def batch_of_runs(announced: DataFrame, batch_id: int) -> None:
        runs = sorted(r.run_id for r in announced.select("run_id").distinct().collect())
        if runs:
            reader = announced.sparkSession.read.schema(WINDOW_AT_REST).option("basePath", windows_path)
            stored = reader.parquet(*[f"{windows_path}/run_id={r}" for r in runs])
            handle(read(stored), batch_id)

    log = spark.readStream.schema(RUN_LOG).option("recursiveFileLookup", "true").parquet(run_log(windows_path))
    return (
        log.writeStream.foreachBatch(batch_of_runs)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger(every))
        .start()
    )
