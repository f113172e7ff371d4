"""Mixing sources to target weights by pivotal dependent rounding.

Every source has a target number of words. A document's share of its source,
``target / source_size``, is a number of copies; the whole part is taken as it
is, and the fractions are rounded against each other: of two documents, one
gives words to the other at random until one of them is at a whole number, and
the other goes on. Words given equal words got, so the words a source takes miss
its target by at most the one document that is left at the end.

The rounding is a tree: documents are dealt by the hash of their id to buckets of
about ``FAN_IN``, each bucket folds to one residual, residuals are dealt to
buckets again, and so on until each source has one. A source with a third of all
rows therefore works in as many tasks as it has buckets. Chances come from hashes
of ids and texts, so a rerun takes the same documents. Built-in functions only.

Edge cases: a null text has no words; documents without words take none and are
rounded on their own; a null source is a source, last in order; rows that repeat
an id, equal rows included, are documents of their own; a source of no words
has target 0; an empty table gives no rows; other columns are not read.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm.common import only, store

FAN_IN = 128
# Equal rows dealt out together.
CHUNK = 4096
# Fractions this near to a whole number are whole.
SNAP = 1e-9
WHITE_SPACE = r"[\x20\x09-\x0D]+"

_ITEM = "struct<h: bigint, doc_id: bigint, size: bigint, p: double>"

# One step of the fold: ``s`` holds the item at a fraction and those at a whole
# number, ``b`` is the next item. A gains d words or gives -d words, with the
# chances that leave the expected share of both as it is.
_FOLD = f"""
aggregate(items, cast(named_struct('carry', null, 'done', array())
                      as struct<carry: {_ITEM}, done: array<{_ITEM}>>),
  (s, b) -> CASE WHEN s.carry IS NULL THEN named_struct('carry', b, 'done', s.done) ELSE
    element_at(transform(transform(transform(
      array(named_struct(
        'up', least((1 - s.carry.p) * s.carry.size, b.p * b.size),
        'down', least(s.carry.p * s.carry.size, (1 - b.p) * b.size),
        'u', pmod(xxhash64(s.carry.h, b.h, {{seed}}), 9007199254740992) / 9007199254740992D)),
      t -> IF(t.u * (t.up + t.down) < t.down, t.up, -t.down)),
      d -> transform(
        array(named_struct('i', s.carry, 'q', s.carry.p + d / s.carry.size),
              named_struct('i', b, 'q', b.p - d / b.size)),
        x -> named_struct('h', x.i.h, 'doc_id', x.i.doc_id, 'size', x.i.size,
                          'p', CASE WHEN x.q < {SNAP} THEN 0D WHEN x.q > 1 - {SNAP} THEN 1D ELSE x.q END))),
      two -> named_struct(
        'carry', try_element_at(filter(two, x -> x.p > 0 AND x.p < 1), 1),
        'done', concat(s.done, filter(two, x -> x.p = 0 OR x.p = 1)))), 1)
  END)
"""


def word_count(text: str | Column) -> Column:
    """Number of words, 0 for null."""
    text = F.col(text) if isinstance(text, str) else text
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), WHITE_SPACE), "")).cast("bigint")


def source_targets(sizes: DataFrame, weights: Sequence[int], most: int) -> DataFrame:
    """Per source its rows, words, and target words.

    Sources in order of their code points, null last, have the weights in turn. A
    target stops at ``most`` times the source's words; what it leaves goes to the
    others by weight. With sources ordered by words per weight, the level at which
    the first k are full is known from running sums, and the highest of these levels
    is the one that holds. Both windows see one row per source.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    place = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    weighted = totals.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), place + 1))
    cap = F.col("source_size") * F.lit(most)
    by_level = Window.orderBy(cap / F.col("weight"), F.col("source").asc_nulls_last())
    below = by_level.rowsBetween(Window.unboundedPreceding, -1)
    above = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = by_level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(below), F.lit(0))) / F.sum(
        "weight"
    ).over(above)
    leveled = weighted.withColumn("level", level)
    target = F.least(cap.cast("double"), F.max("level").over(everything) * F.col("weight"))
    return leveled.select("source", "source_size", "n", target.alias("target"))


def _numbered(docs: DataFrame) -> DataFrame:
    """Rows with their words; equal rows are told apart by a number.

    Equal rows are counted and dealt out again, many of them in chunks over all tasks, so
    neither one id nor one row, however often it stands in the table, meets in one task.
    """
    sized = docs.select("doc_id", "source", word_count("text").alias("size"), F.xxhash64("text").alias("text_hash"))
    counted = sized.groupBy("doc_id", "source", "size", "text_hash").agg(F.count(F.lit(1)).alias("rows"))
    few = counted.filter(F.col("rows") <= CHUNK).withColumn("chunk", F.lit(0).cast("bigint"))
    many = counted.filter(F.col("rows") > CHUNK).withColumn(
        "chunk", F.explode(F.expr(f"sequence(0L, (rows - 1) div {CHUNK})"))
    )
    numbers = F.expr(f"sequence(chunk * {CHUNK}, least(rows, (chunk + 1) * {CHUNK}) - 1)")
    dealt = few.unionByName(many.repartition("text_hash", "chunk"))
    return dealt.select("doc_id", "source", "size", "text_hash", F.explode(numbers).alias("nth"))


def mix(docs: DataFrame, weights: Sequence[int], most: int = 3, seed: int = 1) -> DataFrame:
    """Copies of each document (doc_id, text, source): adds size, source_size, target, copies.

    One row per row of ``docs``.
    """
    sizes = store(_numbered(only(docs, ["doc_id", "source", "text"])), "sizes")
    targets = store(source_targets(sizes, weights, most), "targets")
    key = sizes["source"].eqNullSafe(targets["source"])
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(share + SNAP)
    rest = F.greatest(share - whole, F.lit(0.0))
    units = sizes.join(targets, key).select(
        sizes["source"],
        "doc_id",
        "size",
        whole.cast("int").alias("whole"),
        F.when(rest < SNAP, 0.0).otherwise(rest).alias("p"),
        F.xxhash64("doc_id", "text_hash", "nth", F.lit(seed)).alias("h"),
        F.ceil(F.col("n") / FAN_IN).alias("buckets"),
    )
    # Nothing to round against: no fraction, or no words.
    chance = F.pmod(F.xxhash64("h", F.lit(seed)), F.lit(1 << 53)) / F.lit(float(1 << 53))
    alone = (F.col("p") == 0) | (F.col("size") == 0)
    settled = units.filter(alone).select(
        "source", "doc_id", "size", (chance < F.col("p")).cast("int").alias("extra")
    )
    left = units.filter(~alone).select("source", "h", "doc_id", "size", "p", F.pmod("h", "buckets").alias("bucket"), "buckets")
    done = [settled]
    most_buckets = targets.agg(F.max(F.ceil(F.col("n") / FAN_IN))).first()[0] or 0
    while most_buckets:
        folded = store(_fold(left, seed), "folded")
        item = F.col("d")
        done.append(
            folded.select("source", F.explode("state.done").alias("d")).select(
                "source", item.doc_id.alias("doc_id"), item.size.alias("size"), item.p.cast("int").alias("extra")
            )
        )
        fewer = F.ceil(F.col("buckets") / FAN_IN)
        carry = F.col("state.carry")
        left = folded.filter(carry.isNotNull()).select(
            "source", carry.h.alias("h"), carry.doc_id.alias("doc_id"), carry.size.alias("size"),
            carry.p.alias("p"), F.pmod("bucket", fewer).alias("bucket"), fewer.alias("buckets"),
        )
        if most_buckets == 1:
            break
        most_buckets = -(-most_buckets // FAN_IN)
    if most_buckets:
        done.append(left.select("source", "doc_id", "size", (chance < F.col("p")).cast("int").alias("extra")))
    rounded = done[0]
    for more in done[1:]:
        rounded = rounded.unionByName(more)
    key = rounded["source"].eqNullSafe(targets["source"])
    return rounded.join(targets, key).select(
        "doc_id", rounded["source"], "size", "source_size", "target", (whole.cast("bigint") + F.col("extra")).alias("copies")
    )


def _fold(units: DataFrame, seed: int) -> DataFrame:
    """One level of the tree: each bucket's documents at a whole number, and its residual."""
    item = F.struct("h", "doc_id", "size", "p")
    buckets = units.groupBy("source", "bucket", "buckets").agg(F.array_sort(F.collect_list(item)).alias("items"))
    return buckets.select("source", "bucket", "buckets", F.expr(_FOLD.format(seed=seed)).alias("state"))


def repeat(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The documents as often as the mix takes them, with their own columns.

    Rows of one id, source and size share their copies evenly.
    """

    def keys(doc_id: Column, source: Column, size: Column) -> list[Column]:
        return [F.xxhash64(doc_id, source, size, F.lit(k)).alias(f"k{k}") for k in (1, 2)]

    copies = mixed.select(*keys(F.col("doc_id"), F.col("source"), F.col("size")), "copies")
    copies = copies.groupBy("k1", "k2").agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows"))
    # The columns of a document travel in one, so none can clash with these.
    doc = F.col("doc")
    keyed = docs.select(F.struct("*").alias("doc")).select("doc", *keys(doc.doc_id, doc.source, word_count(doc.text)))
    order = Window.partitionBy("k1", "k2").orderBy(F.xxhash64(doc.text))
    numbered = keyed.withColumn("nth", F.row_number().over(order)).join(copies, ["k1", "k2"])
    own = F.floor(F.col("copies") / F.col("rows")) + (F.col("nth") <= F.col("copies") % F.col("rows")).cast("int")
    taken = numbered.withColumn("own", own.cast("int")).filter("own > 0")
    return taken.select("doc", F.explode(F.sequence(F.lit(1), "own")).alias("copy")).select("doc.*")
