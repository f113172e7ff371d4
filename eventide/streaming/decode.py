"""Decoding a stream of records: what can be read, what cannot, what has no time."""

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventide.sources.events import decode_events
from eventide.streaming.runs import trigger

OUTCOMES = ("accepted", "rejected", "undated")


def start_decode(
    records: DataFrame, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Decode every record once and store it by outcome, a folder per micro-batch.

    A batch repeated after a failure replaces its own folder. Events without a time are
    ``undated``: they are readable, but no window counts them. The records are counted by
    outcome while they are written, and a line per batch is kept for ``passing_counts``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        decoded = decode_events(batch)
        outcome = (
            F.when(~F.col("accepted"), "rejected")
            .when(F.col("event.timestamp").isNull(), "undated")
            .otherwise("accepted")
        )
        judged = decoded.withColumn("outcome", outcome).drop("accepted")
        seen = Observation()
        counted = judged.observe(seen, *[F.count_if(F.col("outcome") == o).alias(o) for o in OUTCOMES])
        counted.write.mode("overwrite").partitionBy("outcome").parquet(f"{path}/batch_id={batch_id}")
        counts = [F.lit(seen.get.get(o) or 0).cast("long").alias(o) for o in OUTCOMES]
        line = batch.sparkSession.range(0, 1, 1, 1).select(*counts)
        line.write.mode("overwrite").parquet(f"{_counts(path)}/batch_id={batch_id}")

    return (
        records.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger(every))
        .start()
    )


def _counts(path: str) -> str:
    return f"{path.rstrip('/')}.counts"


def passing_counts(spark: SparkSession, path: str) -> DataFrame:
    """Accepted, rejected and undated records of each batch, from the lines kept with the
    batches; no record is read."""
    columns = ", ".join(f"{o} long" for o in OUTCOMES)
    return spark.read.schema(f"batch_id long, {columns}").parquet(_counts(path))


def read_outcome(spark: SparkSession, path: str, outcome: str) -> DataFrame:
    """Records of one outcome with their decoded event; opens only its folders."""
    return spark.read.parquet(path).filter(F.col("outcome") == outcome).drop("outcome", "batch_id")


def outcome_counts(spark: SparkSession, path: str) -> DataFrame:
    """Records per outcome, from folder names and row counts."""
    stored = spark.read.schema("batch_id long, outcome string").parquet(path)
    return stored.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))
