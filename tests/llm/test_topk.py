import numpy as np
import pytest
from pyspark.sql import functions as F

from eventide.llm import bitslice, topk


@pytest.mark.parametrize(("n", "d", "high"), [(1, 3, 5), (64, 4, 2), (65, 5, 100), (700, 8, 3), (300, 4, 2**40)])
def test_block_top_equals_sorting(n, d, high):
    rng = np.random.default_rng(n)
    values = rng.integers(-high, high, (n, d))
    block = bitslice.Block.build(values)
    for _ in range(4):
        weights = rng.integers(-9, 9, d)
        scores = [sum(int(a) * int(b) for a, b in zip(weights, row, strict=True)) for row in values]
        rows, sums = block.top(weights, 7)
        expected = sorted((-s, k) for k, s in enumerate(scores))[:7]
        assert sorted((-s, int(r)) for r, s in zip(rows, sums, strict=True)) == expected


def brute(rows, every, k):
    """Each row that is a query against every other row."""
    usable = [
        (vec_id, [int(np.floor(64 * float(np.float32(x)))) for x in embedding])
        for vec_id, embedding in rows
        if vec_id is not None and embedding is not None and all(x is not None and np.isfinite(np.float32(x)) for x in embedding)
    ]
    out = []
    for i, (query, vector) in enumerate(usable):
        if query % every:
            continue
        scored = [
            (-sum(a * b for a, b in zip(vector, w, strict=False)), v) for j, (v, w) in enumerate(usable) if j != i
        ]
        out += [(query, r + 1, v, -s) for r, (s, v) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [1.0, None]), (2, [nan, 1.0]), (3, None), (None, [1.0, 1.0])]
    rows += [(4, [1.0]), (5, [inf, 1.0]), (6, []), (7, [1.0, 2.0]), (8, [1.0, 2.0]), (8, [1.0, 2.0]), (20, [-3.0, 0.5, 9.0])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, q string")
    found = topk.search(df, F.col("vec_id") % 20 == 0, 4)
    assert sorted(tuple(r) for r in found.collect()) == brute(rows, 20, 4)
    assert topk.search(df.limit(0), F.col("vec_id") % 20 == 0, 4).collect() == []


def test_repeated_ids(spark, monkeypatch):
    """Rows that share the query's id, with its vector or another, are candidates."""
    monkeypatch.setattr(topk, "BLOCK_ROWS", 3)
    rows = [(20, [1.0, 2.0])] * 3 + [(7, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = sorted(tuple(r) for r in topk.search(df, F.col("vec_id") % 20 == 0, 4).collect())
    assert len(found) == 9
    assert found == brute(rows, 20, 4)
    rng = np.random.default_rng(5)
    # Small whole numbers: many ties; ids repeat with equal and with other vectors.
    rows = [(int(i), [float(x) for x in v]) for i, v in zip(rng.integers(0, 4, 60) * 10, rng.integers(-1, 2, (60, 2)), strict=True)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for k in (1, 5, 80):
        found = sorted(tuple(r) for r in topk.search(df, F.col("vec_id") % 20 == 0, k).collect())
        assert found == brute(rows, 20, k)


def test_many_blocks(spark, monkeypatch, tables):
    """Block and chunk borders change nothing."""
    vectors = spark.read.parquet(f"{tables}/embeddings.parquet")
    whole = sorted(tuple(r) for r in topk.search(vectors, F.col("vec_id") % 20 == 0, 20).collect())
    monkeypatch.setattr(topk, "BLOCK_ROWS", 70)
    monkeypatch.setattr(topk, "CHUNK_ROWS", 5)
    pieces = sorted(tuple(r) for r in topk.search(vectors, F.col("vec_id") % 20 == 0, 20).collect())
    assert whole == pieces


def test_chunks_and_blocks_do_not_pass_through_the_driver(spark, monkeypatch, tables):
    """Stored, the queries are small enough for a broadcast; their copies for all blocks are not."""
    monkeypatch.setattr(topk, "BLOCK_ROWS", 70)
    monkeypatch.setattr(topk, "CHUNK_ROWS", 5)
    found = topk.search(spark.read.parquet(f"{tables}/embeddings.parquet"), F.col("vec_id") % 20 == 0, 20)
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    found.collect()
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(("cells", "most"), [(1, 8), (1, 3), (16, 8), (10**6, 8)])
def test_any_grid_gives_the_same(spark, monkeypatch, cells, most):
    """Cells of one pair, and cells of several blocks and chunks; ids and vectors repeat."""
    sizes = {"BLOCK_ROWS": 7, "CHUNK_ROWS": 2, "CELLS": cells, "CELL_BLOCKS": most, "CELL_CHUNKS": 2 * most}
    for name, value in (sizes | {"BLOCK_WEIGHS": 2}).items():
        monkeypatch.setattr(topk, name, value)
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(x) for x in v]) for i, v in zip(rng.integers(0, 60, 90), rng.integers(-2, 3, (90, 3)), strict=True)]
    rows += rows[:20] * 2
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = topk.search(df, F.col("vec_id") % 2 == 0, 5).collect()
    assert sorted(tuple(r) for r in found) == brute(rows, 2, 5)
