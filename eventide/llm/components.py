"""Connected components of links too many for one machine."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import store


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the smallest node next to it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # Stored, so that the join may split the links of a hot node.
    least = store(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang every node and its smaller neighbours on the smallest of these."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = store(down.groupBy("a").agg(F.min("b").alias("m")), "least")
    hung = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.unionByName(least.withColumnRenamed("m", "b")).filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the links (a, b); the root is the smallest node.

    Large and small stars in turn until nothing moves; the links of each round are
    stored, so a lost executor costs no earlier round.
    """
    edges = store(edges.filter("a <> b").distinct(), "links")
    mark = None
    while True:
        sums = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64(F.least("a", "b"), F.greatest("a", "b")))).first()
        if sums[0] == 0 or tuple(sums) == mark:
            break
        mark = tuple(sums)
        edges = store(_small_star(_large_star(edges)), "links")
    hung = edges.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root"))
    return hung.unionByName(hung.select(F.col("root").alias("node"), "root").distinct())
