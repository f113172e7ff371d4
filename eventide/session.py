"""Session settings the library relies on."""

import tempfile
import uuid

from pyspark.sql import SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Set the runtime options the operators rely on.

    Every hour and day in the reports is UTC. Of equal keys in a JSON object the
    last one counts, also inside values read as VARIANT.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder; on a cluster a
    driver-local path would be invisible to the executors, so that is an error.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="eventide-"))
        named = context.getCheckpointDir()
    return named.rstrip("/")


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
