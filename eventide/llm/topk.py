"""Exact top-k inner-product search over a bit-sliced index.

Components x become floor(64 * x). Rows are indexed in blocks where they are read;
chunks of queries meet every block in cells of some blocks and some chunks, and each
block returns its best rows per query, of which the best are kept.

Edge cases: vectors that are null, or hold a null or non-finite component, and rows
without an id take no part; components that a shorter vector lacks are zero; every row
is a query and a candidate of its own, rows that repeat an id or a vector too, and a
query leaves out no row but itself; ties go to the smaller vec_id; a score beyond 64
bits is cut to the nearest; empty tables give no rows; other columns are not read.

Rows of one id and vector cannot be told apart by their scores. Equal queries are
therefore searched once, for one row more than asked; one of the rows that have the
query's id and its score with itself is taken for the query and left out.
"""

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm.bitslice import Block
from eventide.llm.common import only, store, tidy

SCALE = 64
BLOCK_ROWS, CHUNK_ROWS = 16_384, 512
# Cells there are about, if there are as many pairs of block and chunk; more as a cell holds so many blocks (some 10 MB
# at 64 components) and chunks at most. A block is shuffled with about as many bytes as so many chunks.
CELLS, CELL_BLOCKS, CELL_CHUNKS, BLOCK_WEIGHS = 256, 8, 96, 8
_LIMIT = 2**63 - 1


def quantised(vector: str) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")))


def _matrix(lists: pa.ListArray) -> np.ndarray:
    """Rows of lists, filled up with zeros."""
    size = lists.value_lengths().to_numpy()
    flat = lists.flatten().to_numpy()
    out = np.zeros((len(size), int(size.max(initial=0))), dtype=np.int64)
    out[np.arange(out.shape[1]) < size[:, None]] = flat
    return out


def _chunks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, rows - n)
            held.append(part)
            n += part.num_rows
            batch = batch.slice(part.num_rows)
            if n == rows:
                yield pa.Table.from_batches(held).combine_chunks()
                held, n = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


BLOCKS = "block_ids array<long>, n int, low array<long>, bits array<int>, slices binary"


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in _chunks(batches, BLOCK_ROWS):
        ids = table["vec_id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        block = Block.build(_matrix(table["q"].combine_chunks())[order])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([ids[order]], pa.list_(pa.int64())),
                pa.array([block.n], pa.int32()),
                pa.array([block.low], pa.list_(pa.int64())),
                pa.array([block.bits], pa.list_(pa.int32())),
                pa.array([block.both[: block.half].tobytes()], pa.binary()),
            ],
            ["block_ids", "n", "low", "bits", "slices"],
        )


def _query_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = {"vec_id": pa.list_(pa.int64()), "q": pa.list_(pa.list_(pa.int64())), "times": pa.list_(pa.int64())}
    for table in _chunks(batches, CHUNK_ROWS):
        yield pa.RecordBatch.from_arrays(
            [pa.array([table[c].to_pylist()], kind) for c, kind in kinds.items()], ["query_ids", "vectors", "times"]
        )


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids = batch.column("block_ids")[row].values.to_numpy()
                n = batch.column("n")[row].as_py()
                words = -(-n // 64)
                raw = np.frombuffer(batch.column("slices")[row].as_buffer(), dtype=np.uint64)
                bits = batch.column("bits")[row].values.to_numpy().astype(np.int64)
                block = Block(n, batch.column("low")[row].values.to_numpy(), bits, raw.reshape(-1, words))
                out: list[list] = [[], [], [], [], [], []]
                times = batch.column("times")[row].values.to_pylist()
                queries = batch.column("query_ids")[row].values.to_numpy()
                vectors = batch.column("vectors")[row].values
                for number, query in enumerate(queries.tolist()):
                    weights = vectors[number].values.to_numpy()
                    itself = sum(w * w for w in weights.tolist())
                    rows, sums = block.top(weights, k)
                    found = ids[rows].tolist()
                    out[0] += [query] * len(rows)
                    out[1] += [number] * len(rows)
                    out[2] += [times[number]] * len(rows)
                    out[3] += found
                    out[4] += [max(-_LIMIT - 1, min(_LIMIT, s)) for s in sums]
                    out[5] += [v == query and s == itself for v, s in zip(found, sums, strict=True)]
                chunk = batch.column("chunk")[row].as_py()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([chunk] * len(out[0]), pa.int64()),
                        *(pa.array(c, pa.int64()) for c in out[:5]),
                        pa.array(out[5], pa.bool_()),
                    ],
                    ["chunk", "query_id", "number", "times", "vec_id", "score", "own"],
                )

    return run


def _met(blocks: DataFrame, chunks: DataFrame) -> DataFrame:
    """Every block with every chunk.

    Both are dealt to rows and columns of a grid and go to all cells of their row or
    column. The copies are many times the stored files, which is all that Spark would
    measure, so neither side may be broadcast.
    """
    n_blocks, n_chunks = blocks.count(), chunks.count()
    pairs = n_blocks * n_chunks // CELLS
    a_row = min(CELL_BLOCKS, max(1, isqrt(pairs // BLOCK_WEIGHS)))
    a_column = min(CELL_CHUNKS, max(1, pairs // a_row))
    high, wide = max(1, -(-n_blocks // a_row)), max(1, -(-n_chunks // a_column))
    placed = blocks.withColumn("row", F.pmod(F.xxhash64("block"), F.lit(high)).cast("int"))
    placed = placed.withColumn("column", F.explode(F.sequence(F.lit(0), F.lit(wide - 1))))
    sent = chunks.withColumn("column", F.pmod(F.xxhash64("chunk"), F.lit(wide)).cast("int"))
    sent = sent.withColumn("row", F.explode(F.sequence(F.lit(0), F.lit(high - 1))))
    # The join holds a cell's blocks; chunks pass by.
    return sent.hint("merge").join(placed, ["row", "column"])


def search(vectors: DataFrame, is_query: Column, k: int) -> DataFrame:
    """The ``k`` best rows of (vec_id, embedding) for each row that ``is_query`` selects.

    Returns query_id, rank, vec_id, score.
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    rows = only(vectors, ["vec_id", "embedding"]).filter(F.col("vec_id").isNotNull() & finite)
    rows = rows.select("vec_id", quantised("embedding").alias("q"))
    blocks = rows.mapInArrow(tidy(_index), BLOCKS)
    blocks = store(blocks.withColumn("block", F.monotonically_increasing_id()), "blocks")
    queries = rows.filter(is_query).groupBy("vec_id", "q").agg(F.count(F.lit(1)).alias("times"))
    chunks = queries.mapInArrow(
        tidy(_query_chunks), "query_ids array<long>, vectors array<array<long>>, times array<long>"
    )
    chunks = store(chunks.withColumn("chunk", F.monotonically_increasing_id()), "queries")
    found = _met(blocks, chunks).mapInArrow(
        tidy(_search(k + 1)), "chunk long, query_id long, number long, times long, vec_id long, score long, own boolean"
    )
    key = ["query_id", "chunk", "number"]
    best = Window.partitionBy(*key).orderBy(F.desc("score"), "vec_id")
    place = F.row_number().over(best)
    ranked = found.withColumn("place", place).filter(F.col("place") <= k + 1)
    # The first of the rows that may be the query stands for it.
    itself = F.min(F.when(F.col("own"), F.col("place"))).over(Window.partitionBy(*key))
    ranked = ranked.withColumn("itself", F.coalesce(itself, F.lit(k + 1)))
    after = F.when(F.col("place") > F.col("itself"), 1).otherwise(0)
    others = ranked.filter(F.col("place") != F.col("itself")).withColumn("rank", F.col("place") - after)
    each = others.withColumn("_", F.explode(F.sequence(F.lit(1), "times")))
    return each.select("query_id", "rank", "vec_id", "score")
