"""Benchmark decontamination by spaced-seed hashing.

A seed is the hash of the tokens that a fixed mask keeps of a run of tokens; the
positions it skips may be substituted. Seeds of the benchmark and of the documents
are joined, and along the diagonal of each hit the two token sequences are compared
position by position: a run is an overlap if it has ``LEAST`` equal tokens (nine tenths
of a shorter item) and four of five tokens are equal. Of the runs of a pair, the first
with the most equal tokens is reported. ``MASKS`` are such that every run that meets
this rule holds a seed, so none is lost. Tokens are runs of letters and digits in lower case.

A filter sized by the number of the benchmark's seeds holds them, so that a document's
seeds leave its task only if they may occur in the benchmark. A filter has ``FILTER_BITS``
at most; a benchmark with more seeds than fit is taken in ranges of seed values, and each
range reads the documents with a filter of its own. Of the seeds of other texts a filter
lets few through (``FEWEST_BITS``); how many it lets through changes no result.

Edge cases: null and empty texts have no tokens; items of under ``SHORTEST`` tokens are
too short to tell and take no part; an item shorter than a mask is looked for by the
shorter masks; repeated items count once per id; repeated documents are found one
by one; empty tables give no overlaps; other columns are not read.
"""

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm import words as W
from eventide.llm.common import only, store, tidy

# Fixed masks: 1 keeps a token, 0 skips it. The shortest is as long as the shortest item.
MASKS = ["1110010011", "1101001101", "1011010101", "1100110101", "1010111001", "111111", "1101111"]
LEAST, SHORTEST, EQUAL = 10, 6, 0.8
# Equal tokens that a substituted one takes beside it: four of five are equal.
SUBSTITUTED = 4
# Bits of a seed filter: 64 MB at most, which is what a task is sent; bits set per seed; bits
# per seed, and the fewest before the seeds are cut into ranges. A document's tokens leave its
# task with its first seed that passes, so few others may: 6 in a million at 32 bits, 43 at 24.
FILTER_BITS, SET, SEED_BITS, FEWEST_BITS = 1 << 29, 8, 32, 24
_BIT = np.left_shift(1, np.arange(8)).astype(np.uint8)


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    found = W.folded(texts, W.NO_ALNUM)
    return W.hashes(found), found.first


def _seeds(tokens: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per mask: the seeds and the token each begins at."""
    room = np.repeat(first[1:], np.diff(first)) - np.arange(len(tokens))
    for number, mask in enumerate(MASKS):
        n = len(tokens) - len(mask) + 1
        if n <= 0:
            continue
        seed = np.full(n, 1 + number, dtype=np.uint64)
        for k, kept in enumerate(mask):
            if kept == "1":
                seed *= np.uint64(0x100000001B3)
                seed += tokens[k : k + n]
        at = np.flatnonzero(room[:n] >= len(mask))
        yield W.mix(seed[at]), at


def filter_size(seeds: int, most: int) -> tuple[int, int]:
    """Bits of each filter for so many seeds, a power of two of at most ``most``, and how many
    ranges the seeds are cut into. The number of ranges is odd, so that a seed's range says
    nothing about its bits."""
    ranges = max(1, -(-seeds * FEWEST_BITS // most)) | 1
    bits = max(1 << 13, -(-seeds // ranges) * SEED_BITS)
    return min(most, 1 << (bits - 1).bit_length()), ranges


def _known(packed: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """Which seeds have all their places set: the low half plus multiples of the high half."""
    live = np.arange(len(seed))
    slot, step = seed & np.uint64(0xFFFFFFFF), seed >> np.uint64(32)
    for _ in range(SET):
        at = slot & np.uint64(8 * len(packed) - 1)
        some = packed[(at >> np.uint64(3)).view(np.int64)] & _BIT[(at & np.uint64(7)).view(np.int64)]
        keep = np.flatnonzero(some)
        live, step = live[keep], step[keep]
        slot = slot[keep] + step
    return live


def benchmark_seeds(benchmark: DataFrame) -> DataFrame:
    """Items with their tokens and seeds: item_id, tokens, seeds array of (seed, at)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("item_id"), batch.column("text")
            tokens, first = _tokens(texts)
            rows = []
            for k in range(batch.num_rows):
                own = tokens[first[k] : first[k + 1]]
                if len(own) < SHORTEST:
                    continue
                seeds = [
                    {"seed": int(s), "at": int(a)}
                    for seed, at in _seeds(own, np.array([0, len(own)]))
                    for s, a in zip(seed.view(np.int64), at, strict=True)
                ]
                rows.append((ids[k].as_py(), own.view(np.int64).tolist(), seeds))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([r[1] for r in rows], pa.list_(pa.int64())),
                    pa.array([r[2] for r in rows], pa.list_(pa.struct([("seed", pa.int64()), ("at", pa.int32())]))),
                ],
                ["item_id", "tokens", "seeds"],
            )

    rows = only(benchmark, ["item_id", "text"]).distinct()
    kinds = "item_id long, tokens array<long>, seeds array<struct<seed: long, at: int>>"
    return rows.mapInArrow(tidy(run), kinds)


def _filter(items: DataFrame, bits: int, ranges: int, number: int) -> np.ndarray:
    """The filter of one range of seeds, put together from at most ``bits / 64`` words."""
    seed = F.col("s.seed")
    own = items.select(F.explode("seeds").alias("s")).filter(F.pmod(seed, F.lit(ranges)) == number)
    low, step = seed.bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned(seed, 32)
    slots = F.array(*[(low + step * k).bitwiseAND(bits - 1) for k in range(SET)])
    word = F.expr("shiftleft(1L, cast(bit % 64 as int))")
    words = own.select(F.explode(slots).alias("bit")).groupBy(F.shiftright("bit", 6).cast("int").alias("w"))
    found = words.agg(F.bit_or(word).alias("v")).toArrow()
    out = np.zeros(bits // 64, dtype=np.int64)
    out[found["w"].to_numpy()] = found["v"].to_numpy()
    return out.view(np.uint8)


def _document_hits(packed: np.ndarray, ranges: int, number: int):
    """Documents with seeds of the range in its filter: their tokens and these seeds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for a, b in W.slices(texts):
                tokens, first = _tokens(texts.slice(a, b - a))
                seeds, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
                for seed, at in _seeds(tokens, first):
                    hit = _known(packed, seed)
                    if ranges > 1:
                        hit = hit[seed[hit].view(np.int64) % ranges == number]
                    seeds.append(seed[hit])
                    places.append(at[hit])
                seed, at = np.concatenate(seeds), np.concatenate(places)
                if not len(seed):
                    continue
                order = np.argsort(at, kind="stable")
                seed, at = seed[order].view(np.int64), at[order]
                bounds = np.searchsorted(at, first)
                docs = np.flatnonzero(np.diff(bounds))
                for k in docs:
                    lo, hi = bounds[k], bounds[k + 1]
                    hits = pa.StructArray.from_arrays(
                        [pa.array(seed[lo:hi]), pa.array((at[lo:hi] - first[k]).astype(np.int32))], ["seed", "at"]
                    )
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("row").slice(a + k, 1),
                            batch.column("doc_id").slice(a + k, 1),
                            pa.ListArray.from_arrays([0, first[k + 1] - first[k]], tokens[first[k] : first[k + 1]].view(np.int64)),
                            pa.ListArray.from_arrays([0, hi - lo], hits),
                        ],
                        ["row", "doc_id", "tokens", "hits"],
                    )

    return run


def longest_run(doc: np.ndarray, item: np.ndarray, shift: int, need: int) -> tuple[int, int, int]:
    """Run with the most equal tokens, four of five equal, on one diagonal: first and last
    item token, and how many are equal; (0, -1, 0) if these are fewer than ``need``."""
    lo, hi = max(0, -shift), min(len(item), len(doc) - shift)
    equal = doc[lo + shift : hi + shift] == item[lo:hi]
    if equal.sum() < need:
        return 0, -1, 0
    same = np.concatenate([[0], np.cumsum(equal)])
    # Four of five are equal from i to j if the total does not fall; the first such i for each j.
    total = np.concatenate([[0], np.cumsum(np.where(equal, 1, -SUBSTITUTED))])
    begin = np.searchsorted(-np.minimum.accumulate(total), -total)
    end = int(np.argmax(same - same[begin]))
    begin = int(begin[end])
    count = int(same[end] - same[begin])
    if count < need:
        return 0, -1, 0
    return lo + begin + int(np.argmax(equal[begin:end])), lo + end - 1, count


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for k in range(batch.num_rows):
            doc = batch.column("tokens")[k].values.to_numpy()
            item = batch.column("item_tokens")[k].values.to_numpy()
            need = min(LEAST, int(np.ceil(0.9 * len(item))))
            best = (0, 0, 0, 0)
            for shift in sorted(set(batch.column("shifts")[k].as_py())):
                begin, end, equal = longest_run(doc, item, shift, need)
                if equal > best[2]:
                    best = (begin + shift, end + shift, equal, end - begin + 1)
            if best[2]:
                ids = batch.column("doc_id")[k].as_py(), batch.column("item_id")[k].as_py()
                rows.append((*ids, *best, best[2] / len(item)))
        if rows:
            kinds = [pa.int64()] * 6 + [pa.float64()]
            names = ["doc_id", "item_id", "first_token", "last_token", "n_equal", "n_tokens", "item_share"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names
            )


OVERLAPS = "doc_id long, item_id long, first_token long, last_token long, n_equal long, n_tokens long, item_share double"


def overlaps(docs: DataFrame, benchmark: DataFrame, most_bits: int = FILTER_BITS) -> DataFrame:
    """Overlaps of documents (doc_id, text) with benchmark items (item_id, text), the best per pair of rows.

    ``most_bits``, a power of two, bounds a filter.
    """
    items = store(benchmark_seeds(benchmark), "items")
    n_seeds = items.agg(F.sum(F.size("seeds"))).first()[0]
    if not n_seeds:
        return docs.sparkSession.createDataFrame([], OVERLAPS)
    bits, ranges = filter_size(n_seeds, most_bits)
    # The number of a document row tells repeated ids apart; ranges must see the same ones.
    texts = only(docs, ["doc_id", "text"]).withColumn("row", F.monotonically_increasing_id())
    if ranges > 1:
        texts = store(texts, "rows")
    kinds = "row long, doc_id long, tokens array<long>, hits array<struct<seed: long, at: int>>"
    passes = []
    for number in range(ranges):
        run = _document_hits(_filter(items, bits, ranges, number), ranges, number)
        passes.append(store(texts.mapInArrow(tidy(run), kinds), "hits"))
    found = reduce(DataFrame.unionByName, passes)
    hits = found.select("row", F.inline("hits")).withColumnRenamed("at", "doc_at")
    if ranges > 1:
        found = found.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("tokens").alias("tokens"))
    seeds = items.select("item_id", F.xxhash64("tokens").alias("version"), F.inline("seeds"))
    pairs = (
        hits.join(seeds, "seed")
        .groupBy("row", "item_id", "version")
        .agg(F.collect_set(F.col("doc_at") - F.col("at")).alias("shifts"))
    )
    texts = items.select("item_id", F.xxhash64("tokens").alias("version"), F.col("tokens").alias("item_tokens"))
    texts = texts.dropDuplicates(["item_id", "version"])
    item = pairs["item_id"].eqNullSafe(texts["item_id"]) & (pairs["version"] == texts["version"])
    candidates = (
        pairs.join(texts, item)
        .select("row", pairs["item_id"], "shifts", "item_tokens")
        .join(found.select("row", "doc_id", "tokens"), "row")
    )
    return candidates.select("doc_id", "item_id", "tokens", "item_tokens", "shifts").mapInArrow(tidy(_verify), OVERLAPS)


def drop_overlapping(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents without an overlap, as they are; all rows of an id go together."""
    bad = overlaps(docs, benchmark).select(F.col("doc_id").alias("_bad")).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["_bad"]), "left_anti")


