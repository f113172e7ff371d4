"""N-gram Jaccard join with Bayesian candidate pruning.

Texts are sets of five-word shingles. Texts that share all rows of a MinHash band
are candidates; their MinHash values are compared ``STEP`` at a time, and a pair is
dropped once the posterior probability that its similarity reaches the threshold
falls below ``TOLERANCE``. What is left is verified by exact set intersection.

Equal texts are one text with a number of copies throughout. No pair is ever a row:
a bucket or a group of texts is cut into chunks, two chunks meet in one cell, and a
cell returns at most one link per text. So the work for a group of near copies is
spread over its cells, and a hot bucket is no single task.

Of the first part only the connected groups of candidates go on; there every pair
of a group is verified exactly, so links are lost only if no chain of candidates
ties their texts. With 32 bands of 4 rows a pair of similarity 0.8 shares no band
with a probability of 5e-8.

Edge cases: texts without words (null, empty, blank) have no links and each is a class
of its own; a text of one to four words is one shingle; repeated rows are copies of
one another; a null doc_id is kept; an empty table gives no rows; other columns are
not read.
"""

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.llm import words as W
from eventide.llm.common import only, store, tidy
from eventide.llm.components import components
from eventide.llm.groups import bounds, groups

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
STEP, TOLERANCE = 16, 1e-6
# Texts of a chunk: of signatures, and of shingle sets.
SIGNATURES, SETS = 768, 512
# Cells of the dense incidence matrix at once.
MATRIX_CELLS = 1 << 22

_rng = np.random.default_rng(20)
_A = _rng.integers(0, 2**32, HASHES, dtype=np.uint32) | np.uint32(1)
_B = _rng.integers(0, 2**32, HASHES, dtype=np.uint32)


def least_matches(compared: int, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> int:
    """Fewest equal values among ``compared`` that keep a pair.

    Under a uniform prior the similarity has the Beta(m + 1, n - m + 1) posterior,
    and the chance that it reaches t is that of at most m hits in n + 1 trials of t.
    """
    n, chance = compared + 1, 0.0
    for m in range(n + 1):
        chance += math.comb(n, m) * threshold**m * (1 - threshold) ** (n - m)
        if chance >= tolerance:
            return m
    return n


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts, repeats included, and where each text's begin."""
    found = W.split(texts)
    tokens, counts = W.hashes(found), found.counts
    value, at = W.windows(tokens, found.first, SHINGLE)
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    extra = np.zeros(len(short), dtype=np.uint64)
    for k in range(SHINGLE - 1):
        has = counts[short] > k
        extra[has] = W.mix(extra[has] * np.uint64(31) + tokens[found.first[short[has]] + k])
    # A short text's one shingle goes where the text begins.
    place = np.concatenate([at, found.first[short]])
    order = np.argsort(place, kind="stable")
    size = np.where(counts >= SHINGLE, counts - SHINGLE + 1, (counts > 0).astype(np.int64))
    return np.concatenate([value, extra])[order], np.concatenate([[0], np.cumsum(size)])


def signatures(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """MinHash values of each text (text x hash) and its number of shingles."""
    value, first = shingles(texts)
    size = np.diff(first)
    some = np.flatnonzero(size)
    out = np.zeros((len(size), HASHES), dtype=np.uint32)
    if len(some):
        low = (value >> np.uint64(32)).astype(np.uint32)
        work = np.empty_like(low)
        for k in range(HASHES):
            np.multiply(low, _A[k], out=work)
            work += _B[k]
            out[some, k] = np.minimum.reduceat(work, first[some])
    return out, size


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text")
        for a, b in W.slices(texts):
            value, size = signatures(texts.slice(a, b - a))
            flat = pa.array(value.view(np.int32).reshape(-1))
            listed = pa.ListArray.from_arrays(np.arange(b - a + 1, dtype=np.int32) * HASHES, flat)
            rest = [batch.column(c).slice(a, b - a) for c in ("row", "doc_id", "t1", "t2")]
            yield pa.RecordBatch.from_arrays(
                [*rest, pa.array(size, pa.int64()), listed], ["row", "doc_id", "t1", "t2", "n_shingles", "minhash"]
            )


def _text_key(k: int) -> Column:
    return F.xxhash64(F.lit(k), "text").alias(f"t{k}")


def survivors(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of ``b`` stay candidates of the one signature ``a``."""
    live, equal = np.arange(len(b)), np.zeros(len(b), dtype=np.int64)
    for at in range(0, HASHES, STEP):
        equal = equal + (b[live, at : at + STEP] == a[at : at + STEP]).sum(axis=1)
        keep = equal >= _LEAST[at // STEP]
        live, equal = live[keep], equal[keep]
    return live


_LEAST = [least_matches(n) for n in range(STEP, HASHES + 1, STEP)]


class Forest:
    """Union-find over the places of a cell."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def root(self, k: int) -> int:
        while self.up[k] != k:
            self.up[k] = self.up[self.up[k]]
            k = self.up[k]
        return int(k)

    def join(self, k: int, others: np.ndarray) -> None:
        roots = {self.root(k), *(self.root(int(o)) for o in np.unique(self.up[others]))}
        low = min(roots)
        for r in roots:
            self.up[r] = low
        self.up[others] = low
        self.up[k] = low

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        roots = np.array([self.root(k) for k in range(len(self.up))], dtype=np.int64)
        at = np.flatnonzero(roots != np.arange(len(roots)))
        return at, roots[at]


def _prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links that tie the surviving candidates of each cell together."""
    keys = ["bucket", "lo", "hi"]
    for table in groups(batches, keys):
        cuts = bounds(table, keys)
        table = table.combine_chunks()
        rep, chunk = table["rep"].to_numpy(), table["chunk"].to_numpy()
        lo, hi = table["lo"].to_numpy(), table["hi"].to_numpy()
        lists = table["minhash"].combine_chunks()
        value = lists.flatten().to_numpy().view(np.uint32).reshape(-1, HASHES)
        left, right = [], []
        for begin, end in itertools.pairwise(cuts):
            part, own = value[begin:end], rep[begin:end]
            if end - begin < 2:
                continue
            forest = Forest(end - begin)
            # All that are tied to the first need not be compared with one another.
            near = survivors(part[0], part[1:]) + 1
            forest.join(0, near)
            rest = np.setdiff1d(np.arange(1, end - begin), near)
            cross = lo[begin] != hi[begin]
            side = chunk[begin:end]
            for k in rest:
                others = np.arange(end - begin)
                others = others[(others != k) & ((side != side[k]) if cross else (others > k) | np.isin(others, near))]
                if len(others):
                    found = others[survivors(part[k], part[others])]
                    if len(found):
                        forest.join(int(k), found)
            at, root = forest.links()
            left.append(own[at])
            right.append(own[root])
        if left:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(left)), pa.array(np.concatenate(right))], ["a", "b"])


def _distinct(value: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shingles without repeats, and the text of each."""
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    return value[new], owner[new]


def common_shingles(value: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Sizes of all intersections among ``n`` sets."""
    _, which, seen = np.unique(value, return_inverse=True, return_counts=True)
    shared = seen > 1
    number = np.cumsum(shared) - 1
    keep = shared[which]
    column, row = number[which[keep]], owner[keep]
    out = np.zeros((n, n), dtype=np.float32)
    width = max(1, MATRIX_CELLS // n)
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    for begin in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(column, [begin, begin + width])
        part = np.zeros((n, width), dtype=np.float32)
        part[row[a:b], column[a:b] - begin] = 1
        out += part @ part.T
    return out


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per cell and text: its links there, and one link that ties it to its class."""
    keys = ["root", "lo", "hi"]
    for table in groups(batches, keys):
        cuts = bounds(table, keys)
        table = table.combine_chunks()
        rep, copies, chunk = (table[c].to_numpy() for c in ("rep", "copies", "chunk"))
        lo, hi = table["lo"].to_numpy(), table["hi"].to_numpy()
        texts = table["text"].combine_chunks()
        out: list[list[np.ndarray]] = [[], [], [], []]
        for begin, end in itertools.pairwise(cuts):
            n = end - begin
            value, owner = _distinct(*shingles(texts.slice(begin, n)))
            size = np.bincount(owner, minlength=n)
            common = common_shingles(value, owner, n)
            linked = common >= THRESHOLD * (size[:, None] + size[None, :] - common) - 1e-6
            linked &= common > 0
            np.fill_diagonal(linked, False)
            if lo[begin] != hi[begin]:
                side = chunk[begin:end]
                linked &= side[:, None] != side[None, :]
            forest = Forest(n)
            for k in np.flatnonzero(linked.any(axis=1)):
                forest.join(int(k), np.flatnonzero(linked[k]))
            tie = np.array([forest.root(k) for k in range(n)], dtype=np.int64)
            for to, column in zip(
                out, (rep[begin:end], linked @ copies[begin:end], linked.sum(axis=1), rep[begin:end][tie]), strict=True
            ):
                to.append(column.astype(np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], ["rep", "links", "texts", "tie"])


def _cells(members: DataFrame, chunks: Column) -> DataFrame:
    """Deal the members of each group to cells of two chunks (or of one with itself)."""
    chunked = members.withColumn("chunks", chunks.cast("int")).withColumn(
        "chunk", F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int")
    )
    met = chunked.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    return met.withColumns({"lo": F.least("chunk", "other"), "hi": F.greatest("chunk", "other")}).drop("other", "chunks")


def join(docs: DataFrame) -> DataFrame:
    """Classes and links of documents (doc_id, text), one row per document.

    Returns row (its number in the input), doc_id, t1 and t2 (hashes of the text), class_id
    (the smallest doc_id of all texts tied to it by links), keeper (whether it is the row
    that stands for its class), n_links (documents with a similarity of at least 0.8, copies
    included), n_texts (different texts among them) and n_copies (rows of this text).
    """
    rows = only(docs, ["doc_id", "text"]).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", _text_key(1), _text_key(2), "text"
    )
    sketch = store(
        rows.mapInArrow(tidy(_sketch), "row long, doc_id long, t1 long, t2 long, n_shingles long, minhash array<int>"), "sketch"
    )
    some = sketch.filter("n_shingles > 0")
    # The first row of a text stands for it: that of the smallest id.
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first")
    classes = some.groupBy("t1", "t2").agg(first, F.count(F.lit(1)).alias("copies"))
    classes = store(
        classes.select("t1", "t2", F.col("first.row").alias("rep"), F.col("first.doc_id").alias("rep_doc"), "copies"),
        "texts",
    )
    reps = some.join(classes.select(F.col("rep").alias("row")), "row", "left_semi").select(F.col("row").alias("rep"), "minhash")

    band = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda b: F.xxhash64(b, F.slice("minhash", b * ROWS + 1, F.lit(ROWS))),
    )
    bands = store(reps.select("rep", F.explode(band).alias("bucket")), "bands")
    buckets = bands.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("rep")).alias("all"), F.min("rep").alias("least")
    )
    # Bands that hold the same texts need be looked at once.
    buckets = buckets.filter("n > 1").groupBy("n", "all", "least").agg(F.min("bucket").alias("bucket"))
    members = bands.join(buckets.select("bucket", "n"), "bucket")
    cells = _cells(members, F.ceil(F.col("n") / SIGNATURES)).drop("n").join(reps, "rep")
    order = ["bucket", "lo", "hi"]
    ordered = cells.repartition(*order).sortWithinPartitions(*order)
    tied = components(ordered.mapInArrow(tidy(_prune), "a long, b long"))

    groups = store(tied, "groups")
    sizes = groups.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    grouped = groups.join(sizes, "root").withColumnRenamed("node", "rep").join(classes, "rep")
    texts = only(docs, ["text"]).select(_text_key(1), _text_key(2), "text")
    # A text may stand in many rows, of which one is enough.
    one = texts.join(grouped, ["t1", "t2"]).groupBy("root", "n", "rep", "copies").agg(F.min("text").alias("text"))
    order = ["root", "lo", "hi"]
    cells = _cells(one, F.ceil(F.col("n") / SETS)).select(*order, "chunk", "rep", "copies", "text")
    ordered = cells.repartition(*order).sortWithinPartitions(*order)
    checked = store(ordered.mapInArrow(tidy(_verify), "rep long, links long, texts long, tie long"), "checked")
    links = checked.groupBy("rep").agg(F.sum("links").alias("links"), F.sum("texts").alias("texts"))
    final = components(checked.select(F.col("rep").alias("a"), F.col("tie").alias("b")))

    by_text = classes.join(links, "rep", "left").join(final.withColumnRenamed("node", "rep"), "rep", "left")
    by_text = by_text.withColumn("root", F.coalesce("root", "rep"))
    first = F.min(F.struct(F.col("rep_doc").isNull().alias("no"), F.col("rep_doc").alias("doc"), "rep"))
    heads = by_text.groupBy("root").agg(first.alias("head"))
    headed = by_text.join(heads, "root").select(
        "t1", "t2", "copies", "links", "texts",
        F.col("head.doc").alias("class_id"), F.col("head.rep").alias("keeper_row"),
    )
    out = sketch.select("row", "doc_id", "t1", "t2").join(headed, ["t1", "t2"], "left")
    # Rows without words are not among the texts.
    return out.select(
        "row",
        "doc_id",
        "t1",
        "t2",
        F.when(F.col("copies").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce(F.col("row") == F.col("keeper_row"), F.lit(True)).alias("keeper"),
        (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0))).alias("n_links"),
        F.coalesce("texts", F.lit(0)).alias("n_texts"),
        F.coalesce("copies", F.lit(1)).alias("n_copies"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents, one of each class of near copies: that of the smallest id.

    Rows of one id and text are told apart by nothing, so one of them stays. Documents
    without words all stay.
    """
    kept = join(docs).filter("keeper").select("t1", "t2", F.xxhash64("doc_id").alias("d")).distinct()
    # The columns of a document travel in one, so none can clash with these.
    keyed = docs.select(
        F.struct("*").alias("doc"), _text_key(1), _text_key(2), F.xxhash64("doc_id").alias("d")
    )
    has_words = F.coalesce(F.col("doc.text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    # Equal rows fall together before they are sent.
    one = keyed.filter(has_words).groupBy("t1", "t2", "d").agg(F.first("doc").alias("doc"))
    chosen = one.join(kept, ["t1", "t2", "d"], "left_semi")
    return chosen.select("doc").unionByName(keyed.filter(~has_words).select("doc")).select("doc.*")
