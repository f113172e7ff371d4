"""Alignment of two tokenizers over the bytes of every document.

Inside tasks everything is an Arrow column: the ids of a slice of documents are lists,
flattened next to the index of their document; token ends are cumulative sums within a
document; the places where both tokenizers end a token come from a hash join on
(document, end) and cut the tokens into groups. Pairs of ids of a group are counted
with ``Table.group_by`` per document and per slice. Keys of several columns are joined
and counted as one whole number, (document, end) as the place in the slice.

Spark adds up the slices' counts: a pair of ids stands once in a slice, however often
it occurs there, so a pair that nearly every document holds is one row per slice. The
finished counts go back to the slices they came from, where the documents' sums are
taken. A slice is some 0.5 MB of whole documents; no list is longer than its slice. What a
worker and a reader of slices hold does not grow with the number of slices: the coded
pieces a worker keeps and the rows of a stored row group are bounded.

Edge cases: null and empty texts, and texts that either tokenizer does not give back
byte by byte, have no tokens and zeros; repeated rows are documents of their own and
count as such; a null doc_id is kept; an empty table gives no rows; other columns are
not read.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm import pieces, words
from eventide.llm.common import only, store, tidy

SLICE_BYTES = 1 << 19
# Coded pieces that a worker keeps for each tokenizer, at some 100 bytes while they are merged.
KEPT_PIECES = 300_000
# Slices of a stored row group: a reader holds one row group, and a row is a slice.
GROUP_SLICES = 32

SLICES = (
    "slice long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
    "groups_sha256 array<string>, pair_a array<int>, pair_b array<int>, pair_docs array<long>, "
    "link_doc array<int>, link_n array<long>"
)
ALIGNED = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)


def _ends(lists: pa.Array, token_bytes: pa.Array, offsets: np.ndarray) -> pa.Table:
    """The tokens of all documents: document, id, and the byte of the slice where each ends.

    A token has a byte at least, so the place tells the document and the end in it.
    """
    ids, doc = pc.list_flatten(lists), pc.list_parent_indices(lists)
    size = pc.binary_length(token_bytes).take(ids)
    total = pc.cumulative_sum(size.cast(pa.int64()))
    # Bytes before each document: the running total behind the last token of the one before.
    first = lists.offsets.to_numpy()[:-1] - lists.offsets[0].as_py()
    running = np.concatenate([[0], total.to_numpy()])
    # Places in the slice: those of a document lie behind those of the documents before it.
    shift = pa.array(offsets[:-1] - running[first]).take(doc)
    return pa.table({"doc": doc, "id": ids, "place": pc.add(total, shift)})


def _whole(lists: pa.Array, token_bytes: pa.Array, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which documents' tokens, joined, are the bytes of the document."""
    joined = token_bytes.take(pc.list_flatten(lists))
    ends = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset : joined.offset + len(joined) + 1]
    at = ends[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
    raw = joined.buffers()[2]
    found = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    bounds = zip(at[:-1].tolist(), at[1:].tolist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)
    return np.array([np.array_equal(found[a:b], data[c:d]) for a, b, c, d in bounds], dtype=bool)


def _emptied(lists: pa.Array, kept: np.ndarray) -> pa.Array:
    """The lists, those of other documents empty."""
    if kept.all():
        return lists
    size = np.where(kept, np.diff(lists.offsets.to_numpy()), 0)
    ids = pc.list_flatten(lists).filter(pa.array(np.repeat(kept, np.diff(lists.offsets.to_numpy()))))
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()), ids)


def _texts(ids: pa.Array, group: np.ndarray, n_groups: int) -> pa.Array:
    """The ids of each group as decimal numbers between commas."""
    first = np.searchsorted(group, np.arange(n_groups + 1))
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(first, pa.int32()), ids.cast(pa.string())), ",")


def _digests(a: pa.Table, b: pa.Table, group_doc: np.ndarray, n_docs: int) -> list[str]:
    n = len(group_doc)
    sides = [_texts(t["id"].combine_chunks(), t["group"].to_numpy(), n) for t in (a, b)]
    groups = pc.binary_join_element_wise(*sides, "|")
    first = np.searchsorted(group_doc, np.arange(n_docs + 1))
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(first, pa.int32()), groups), ";")
    has = np.diff(first) > 0
    return [hashlib.sha256(t.as_buffer()).hexdigest() if h else "" for t, h in zip(joined, has.tolist(), strict=True)]


def _occurrences(tokens: pa.Table, name: str, n_ids: int) -> pa.Table:
    """How often each id stands in a group."""
    key = pa.array(tokens["group"].to_numpy() * np.int64(n_ids) + tokens["id"].to_numpy())
    counted = pa.table({"key": key}).group_by("key", use_threads=False).aggregate([([], "count_all")])
    group, number = np.divmod(counted["key"].to_numpy(), n_ids)
    return pa.table({"group": group, name: number, f"n_{name}": counted["count_all"]})


def _sorted(counted: pa.Table, value: str) -> tuple[np.ndarray, np.ndarray]:
    """Keys in order, and their values."""
    key = counted["key"].to_numpy()
    order = np.argsort(key)
    return key[order], counted[value].to_numpy()[order]


def _slice(texts: pa.Array, doc_ids: pa.Array, number: int, path_a: str, path_b: str) -> pa.RecordBatch:
    """All that a slice of documents gives, as one row."""
    n_docs = len(texts)
    data, offsets = words.buffers(texts)
    filled = np.diff(offsets) > 0
    data, offsets = pieces.prefixed(data, offsets)
    found = pieces.cut(data, offsets, space_only=True)
    bytes_a, bytes_b = pieces.byte_tokens(path_a), pieces.piece_tokens(path_b)
    different = pieces.distinct(found)
    lists = []
    for coder in (pieces.byte_coder(path_a, True, KEPT_PIECES), pieces.piece_coder(path_b, KEPT_PIECES)):
        ids, first = coder.encode(found, different)
        lists.append(pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids.astype(np.int32))))
    kept = filled & _whole(lists[0], bytes_a, data, offsets) & _whole(lists[1], bytes_b, data, offsets)
    lists = [_emptied(part, kept) for part in lists]
    a, b = _ends(lists[0], bytes_a, offsets), _ends(lists[1], bytes_b, offsets)

    shared = a.select(["place", "doc"]).join(b.select(["place"]), "place", join_type="inner", use_threads=False)
    group_doc, place = shared["doc"].to_numpy(), shared["place"].to_numpy()
    order = np.argsort(place)
    group_doc, place = group_doc[order], place[order]
    # By place, how many groups end before it.
    closes = np.zeros(len(data) + 1, dtype=np.int32)
    closes[place] = 1
    closed = np.cumsum(closes, dtype=np.int32) - closes

    def grouped(tokens: pa.Table) -> pa.Table:
        return tokens.append_column("group", pa.array(closed[tokens["place"].to_numpy()]))

    a, b = grouped(a), grouped(b)
    both = np.bincount(a["group"].to_numpy(), minlength=len(place)) * np.bincount(b["group"].to_numpy(), minlength=len(place))
    until = np.concatenate([[0], np.cumsum(both)])
    first = np.searchsorted(group_doc, np.arange(n_docs + 1))
    row = {
        "slice": pa.array([number], pa.int64()),
        "doc_id": _one(doc_ids.cast(pa.int64())),
        "n_a": _one(lists[0].value_lengths().cast(pa.int64())),
        "n_b": _one(lists[1].value_lengths().cast(pa.int64())),
        "n_groups": _one(pa.array(np.diff(first), pa.int64())),
        "n_links": _one(pa.array(np.diff(until[first]), pa.int64())),
        "groups_sha256": _one(pa.array(_digests(a, b, group_doc, n_docs), pa.string())),
    }
    counts = _occurrences(a, "a", len(bytes_a)), _occurrences(b, "b", len(bytes_b))
    links = counts[0].join(counts[1], "group", join_type="inner", use_threads=False)
    pair = links["a"].to_numpy() * np.int64(len(bytes_b)) + links["b"].to_numpy()
    key = pa.array(pair * n_docs + group_doc[links["group"].to_numpy()])
    links = pa.table({"key": key, "n": pc.multiply(links["n_a"], links["n_b"])})
    of_docs, link_n = _sorted(links.group_by("key", use_threads=False).aggregate([("n", "sum")]), "n_sum")
    # Sorted by pair, so runs of equal pairs are the documents that hold it.
    pair, doc = np.divmod(of_docs, max(n_docs, 1))
    pairs = pa.table({"key": pair}).group_by("key", use_threads=False).aggregate([([], "count_all")])
    pairs, pair_docs = _sorted(pairs, "count_all")
    pair_a, pair_b = np.divmod(pairs, len(bytes_b))
    row |= {
        "pair_a": _one(pa.array(pair_a, pa.int32())),
        "pair_b": _one(pa.array(pair_b, pa.int32())),
        "pair_docs": _one(pa.array(pair_docs, pa.int64())),
        "link_doc": _one(pa.array(doc, pa.int32())),
        "link_n": _one(pa.array(link_n, pa.int64())),
    }
    return pa.RecordBatch.from_pydict(row)


def _one(values: pa.Array) -> pa.Array:
    """A column of one row that holds the values as a list."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _slices(path_a: str, path_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            texts, doc_ids = batch.column("text"), batch.column("doc_id")
            for at, to in words.slices(texts, SLICE_BYTES):
                yield _slice(texts.slice(at, to - at), doc_ids.slice(at, to - at), number, path_a, path_b)
                number += 1

    return run


def slices(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Aligned documents by slice: counts and digests per document, and the id pairs that its
    documents link, with the documents and the number of links each has there."""
    return only(docs, ["doc_id", "text"]).mapInArrow(tidy(_slices(path_a, path_b)), SLICES)


def pair_counts(sliced: DataFrame) -> DataFrame:
    """Pairs of ids (a, b) with the number of documents that link them, and whether no other
    pair of the same ``a`` has more."""
    pairs = sliced.select(F.inline(F.arrays_zip("pair_a", "pair_b", "pair_docs")).alias("a", "b", "n"))
    counted = pairs.groupBy("a", "b").agg(F.sum("n").alias("count"))
    counted = store(counted, "pair-counts")
    most = counted.groupBy("a").agg(F.max("count").alias("most"))
    return counted.join(most, "a").select("a", "b", "count", (F.col("count") == F.col("most")).alias("top"))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums over each document's links, a slice at a time."""
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    for batch in batches:
        for row in range(batch.num_rows):
            values = {n: batch.column(n)[row].values for n in [*names, "pair_docs", "link_doc", "link_n"]}
            doc, n = values["link_doc"].to_numpy(), values["link_n"].to_numpy()
            found = batch.column("found")[row].values
            n_docs = len(values["doc_id"])
            sums = {"n_best": np.zeros(n_docs, np.int64), "count_sum": np.zeros(n_docs, np.int64)}
            if found is not None and len(found):
                size = values["pair_docs"].to_numpy()
                count = np.repeat(found.field("count").to_numpy(), size)
                top = np.repeat(found.field("top").to_numpy(zero_copy_only=False), size)
                np.add.at(sums["n_best"], doc, n * top)
                np.add.at(sums["count_sum"], doc, n * count)
            columns = {n: values[n] for n in names} | {n: pa.array(v) for n, v in sums.items()}
            yield pa.RecordBatch.from_pydict({n: columns[n] for n in _ORDER})


_ORDER = [part.split()[0] for part in ALIGNED.split(", ")]


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Documents with the sums of their links between the tokens of two tokenizers.

    ``path_a`` is a byte-level tokenizer file, coding each text behind a space, and
    ``path_b`` a piece model, which adds that space. The slices are written once; their
    distinct pairs are shuffled to be counted, and the counts back to the slices.
    """
    sliced = store(slices(docs, path_a, path_b), "alignment", {"parquet.block.row.count.limit": GROUP_SLICES})
    pairs = sliced.select("slice", F.posexplode(F.arrays_zip("pair_a", "pair_b")).alias("k", "pair"))
    pairs = pairs.select("slice", "k", F.col("pair.pair_a").alias("a"), F.col("pair.pair_b").alias("b"))
    known = pairs.join(pair_counts(sliced), ["a", "b"])
    # At most as many entries as the slice has tokens.
    back = known.groupBy("slice").agg(F.array_sort(F.collect_list(F.struct("k", "count", "top"))).alias("found"))
    kept = sliced.drop("pair_a", "pair_b")
    return kept.join(back, "slice", "left").mapInArrow(tidy(_sums), ALIGNED)
