"""Divergence of sources: how far the word use of a language's sources lies apart.

A language keeps the terms that enough of its documents hold. Each of its sources is a
group, a row of a matrix of counts over those terms, and every entry has a price
``p = 1 + 10**9 * (count + 5) // (N + 5 * V)``. A pair of groups is as far apart as the
sum of the differences of their prices over all kept terms; a term tells a group from
its language by how much more it costs there.

Documents are reduced to counts per (language, source, term) inside tasks. The matrix is
dealt into tiles of rows and columns; a task walks the trees of two tiles jointly for
all pairs of their rows (see ``k2tree``), and Spark adds up the tiles. A tile's size is
fixed, so a language with a third of all rows, or with many sources, is more tiles.

Edge cases: null text, language or source is ''; a group without kept terms is a row of
zeros; a language without kept terms has distances of 0; repeated rows count each;
an empty table gives no rows; other columns are not read.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm import k2tree, words
from eventide.llm.common import only, store, tidy
from eventide.llm.groups import single

LEAST_DOCUMENTS = 30
TOP_TERMS = 50
# Columns of a block by hash, about; what exceeds a tile goes on in another one.
BLOCK_TERMS = k2tree.COLUMNS // 2

COUNTS = "lang string, source string, term string, n long, docs long"
ENTRIES = "lang string, block long, a long, b long, side long, row int, col int, n long, width int"
PAIRS = "lang string, x long, y long, value long"


def _strings(found: words.Words, which: np.ndarray) -> pa.Array:
    """Some words as a string column."""
    start, size = found.start[which], found.end[which] - found.start[which]
    ends = np.concatenate([[0], np.cumsum(size)])
    source = np.repeat(start - ends[:-1], size) + np.arange(ends[-1])
    buffers = [None, pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(found.data[source].tobytes())]
    return pa.LargeStringArray.from_buffers(len(which), buffers[1], buffers[2]).cast(pa.string())


def _counted(texts: pa.Array, group: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """Group, term, occurrences and documents of the terms of some texts."""
    found = words.ascii_folded(texts, words.NO_LETTER)
    doc = found.text_of
    key, check = words.hashes(found), words.hashes(found, seed=2)
    order = np.lexsort((check, key, group[doc]))
    of, key, check, doc = group[doc][order], key[order], check[order], doc[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (of[1:] != of[:-1]) | (key[1:] != key[:-1]) | (check[1:] != check[:-1])
    # Within a term the documents follow one another.
    other = new.copy()
    other[1:] |= doc[1:] != doc[:-1]
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(order)))
    docs = np.add.reduceat(other.astype(np.int64), first) if len(first) else n
    return of[first], _strings(found, order[first]), n, docs


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text")
        names = [pc.dictionary_encode(batch.column(c)) for c in ("lang", "source")]
        n_sources = max(len(names[1].dictionary), 1)
        pair = names[0].indices.to_numpy().astype(np.int64) * n_sources + names[1].indices.to_numpy()
        for at, to in words.slices(texts):
            of, terms, n, docs = _counted(texts.slice(at, to - at), pair[at:to])
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": names[0].dictionary.take(pa.array(of // n_sources)).cast(pa.string()),
                    "source": names[1].dictionary.take(pa.array(of % n_sources)).cast(pa.string()),
                    "term": terms,
                    "n": pa.array(n, pa.int64()),
                    "docs": pa.array(docs, pa.int64()),
                }
            )


def _filled(docs: DataFrame) -> DataFrame:
    rows = only(docs, ["text", "lang", "source"])
    return rows.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("text", "lang", "source")])


def term_counts(docs: DataFrame) -> DataFrame:
    """Occurrences of each term per language and source, and the documents that hold it."""
    counted = _filled(docs).mapInArrow(tidy(_counts), COUNTS)
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _price(count: str, total: str, terms: str) -> str:
    """``k2tree.prices`` in SQL, whose decimals hold the product."""
    scaled = f"CAST({count} + {k2tree.PRIOR} AS DECIMAL(20, 0)) * 1000000000BD"
    return f"1 + {scaled} div CAST({total} + {k2tree.PRIOR} * {terms} AS DECIMAL(20, 0))"


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distances of all pairs of rows of two tiles."""
    for cell in single(batches, ["lang", "block", "a", "b"]):
        a, b = cell["a"][0].as_py(), cell["b"][0].as_py()
        side, row, col, n = (cell[c].to_numpy() for c in ("side", "row", "col", "n"))
        trees, rows = [], []
        for tile in (a, b):
            head, body = (side == tile) & (col < 0), (side == tile) & (col >= 0)
            divisor = np.zeros(k2tree.ROWS, dtype=np.int64)
            divisor[row[head]] = n[head]
            trees.append(k2tree.build(row[body].astype(np.int64), col[body].astype(np.int64), n[body], divisor))
            rows.append(np.sort(row[head]))
        value = k2tree.distances(trees[0], trees[1], int(cell["width"].to_numpy().max()))
        x, y = np.repeat(rows[0], len(rows[1])), np.tile(rows[1], len(rows[0]))
        kept = (x < y) if a == b else np.ones(len(x), dtype=bool)
        x, y = x[kept], y[kept]
        yield pa.RecordBatch.from_pydict(
            {
                "lang": pa.array([cell["lang"][0].as_py()] * len(x), pa.string()),
                "x": pa.array(a * k2tree.ROWS + x, pa.int64()),
                "y": pa.array(b * k2tree.ROWS + y, pa.int64()),
                "value": pa.array(value[x, y], pa.int64()),
            }
        )


def _entries(matrix: DataFrame, rows: DataFrame, terms: DataFrame) -> DataFrame:
    """What the tasks walk: the entries of every pair of tiles, and a head per row with its divisor.

    A tile meets each tile of its language, so it is sent once per group block.
    """
    blocks = terms.groupBy("lang", "block").agg(F.count(F.lit(1)).cast("int").alias("width"))
    named = rows.select("lang", "source", F.col("side"), F.col("row"), "sides")
    body = matrix.join(named, ["lang", "source"]).join(terms.select("lang", "term", "block", "col"), ["lang", "term"])
    body = body.select("lang", "block", "side", "sides", "row", "col", "n", F.lit(0).alias("width"))
    # A language without kept terms has one block without columns.
    heads = rows.join(blocks, "lang", "left").select(
        "lang",
        F.coalesce("block", F.lit(0)).alias("block"),
        "side",
        "sides",
        "row",
        F.lit(-1).alias("col"),
        F.col("divisor").alias("n"),
        F.coalesce("width", F.lit(0)).alias("width"),
    )
    both = body.unionByName(heads).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("sides") - 1)))
    return both.select(
        "lang", "block", F.least("side", "other").alias("a"), F.greatest("side", "other").alias("b"), "side", "row",
        "col", "n", "width",
    )


def audit(docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP_TERMS) -> DataFrame:
    """Distances between the sources of a language, and the terms that mark a source.

    Rows are (lang, source, part, item, value, rank): part ``pair`` has every other source
    of the language, part ``term`` the ``top`` kept terms that cost more in the group
    than in its language.
    """
    counts = store(term_counts(docs), "term-counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
    kept = store(kept.filter(F.col("docs") >= least).drop("docs"), "kept-terms")
    matrix = counts.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n")
    matrix = store(matrix, "term-matrix")

    totals = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("lang_n").alias("lang_total"))
    sums = matrix.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    every = _filled(docs).select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(totals, "lang", "left")
    # Sources of a language in order; their number, not that of their rows, is what one task sees.
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    size = F.count(F.lit(1)).over(Window.partitionBy("lang"))
    every = every.select(
        "lang", "source",
        F.coalesce("total", F.lit(0)).alias("total"),
        F.coalesce("terms", F.lit(0)).alias("terms"),
        F.coalesce("lang_total", F.lit(0)).alias("lang_total"),
        nth.cast("long").alias("nth"),
        F.ceil(size / k2tree.ROWS).alias("sides"),
    )
    every = store(every, "sources")

    rows = every.select(
        "lang", "source", "sides",
        F.floor(F.col("nth") / k2tree.ROWS).alias("side"),
        (F.col("nth") % k2tree.ROWS).cast("int").alias("row"),
        (F.col("total") + k2tree.PRIOR * F.col("terms")).alias("divisor"),
    )
    blocks = F.ceil(F.col("terms") / BLOCK_TERMS)
    hashed = kept.join(totals.select("lang", "terms"), "lang").withColumn("block", F.pmod(F.xxhash64("term"), blocks))
    # Frequent terms first: what is not zero lies together.
    place = F.row_number().over(Window.partitionBy("lang", "block").orderBy(F.desc("lang_n"), "term")) - 1
    placed = hashed.withColumn("place", place)
    terms = placed.select(
        "lang", "term",
        (F.col("block") * 1000 + F.floor(F.col("place") / k2tree.COLUMNS)).alias("block"),
        (F.col("place") % k2tree.COLUMNS).cast("int").alias("col"),
    )
    entries = _entries(matrix, rows, store(terms, "term-places"))
    keys = ["lang", "block", "a", "b"]
    dealt = entries.repartition(*keys).sortWithinPartitions(*keys)
    found = dealt.mapInArrow(tidy(_walk), PAIRS).groupBy("lang", "x", "y").agg(F.sum("value").alias("value"))
    ways = found.select("lang", F.inline(F.array(F.struct("x", "y", "value"), F.struct(F.col("y").alias("x"), F.col("x").alias("y"), "value"))))
    named = every.select("lang", "source", "nth")
    pairs = ways.join(named.withColumnRenamed("nth", "x"), ["lang", "x"]).join(
        named.select("lang", F.col("source").alias("item"), F.col("nth").alias("y")), ["lang", "y"]
    )
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value")

    priced = matrix.join(every, ["lang", "source"]).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
        (F.expr(_price("n", "total", "terms")) - F.expr(_price("lang_n", "lang_total", "terms"))).alias("value"),
    )
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order).alias("rank")
    marks = priced.filter("value > 0").select("*", rank).filter(F.col("rank") <= top)
    return pairs.select("*", rank).unionByName(marks)
