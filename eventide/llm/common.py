"""What the operators of this subpackage share on the Spark side."""

import contextlib
import ctypes
import gc
import io
import tempfile
import zipfile
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.session import run_dir

# What runs over the Arrow batches of a partition.
Task = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]

_PACKAGE = Path(__file__).resolve().parents[1]
_shipped: set[str] = set()


# Bytes of an Arrow batch: 10,000 documents, the limit by rows, may be far more.
BATCH_BYTES = 8 << 20


def ship(spark: SparkSession) -> None:
    """Hand this package to the executors, once per application; bound Arrow batches.

    The archive is made on the driver and served by the driver to all executors;
    no executor reads the driver's folder.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for source in sorted(_PACKAGE.rglob("*.py")):
            archive.write(source, str(source.relative_to(_PACKAGE.parent)))
    path = Path(tempfile.mkdtemp(prefix="eventide-")) / f"{_PACKAGE.name}.zip"
    path.write_bytes(packed.getvalue())
    context.addPyFile(str(path))
    _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of a folder of tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tidy(run: Task) -> Task:
    """Give memory back when a task ends: Python workers live on, and tasks of other
    operators follow in them."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # other C libraries do it on their own
                ctypes.CDLL("libc.so.6").malloc_trim(0)

    return tidied


def store(df: DataFrame, name: str, options: dict[str, int] | None = None) -> DataFrame:
    """Write a frame below the shared folder and read it back: the lineage ends here.

    A lost executor then costs no recomputation of what came before, and every
    later read sees the same rows in the same files. ``options`` go to the writer.
    """
    spark = df.sparkSession
    path = run_dir(spark, name)
    df.write.options(**(options or {})).option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def only(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The input of an operator: the named columns. Whatever else a table carries plays no part."""
    ship(df.sparkSession)
    return df.select(*[F.col(f"`{c}`") for c in columns])
