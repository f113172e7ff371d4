"""Token-ID output: texts as Simple-8b coded ids in block files, and back.

A token file is a Parquet file of blocks. A block holds whole documents, about
``BLOCK_IDS`` ids together, and names its part, its place in the part, its
documents and their lengths; ``simple8b`` describes the coding. Parts follow the
order of doc_id, null first; equal ids follow the hash of their text. The start of
a document is the number of ids of all documents before it.

Edge cases: a null or empty text is the end id alone; a null doc_id is kept and
sorts first; repeated rows are documents of their own; an empty table gives no
blocks and no rows; other columns are not read.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventide.llm import simple8b, words
from eventide.llm.common import only, tidy

BLOCK_IDS = 1 << 18
# Coded pieces a Python worker keeps, at about 40 bytes each.
CACHE_PIECES = 1_000_000
SLICE_BYTES = 3 << 20
# Words coded in one call.
JOINED = 4096

_ASCII_LETTER = ~words.NO_LETTER & (np.arange(256) < 0x80)
# ASCII signs that no rule of the tokenizer joins with letters before them.
_SIGN = np.zeros(256, dtype=bool)
_SIGN[0x21:0x7F] = words.NO_ALNUM[0x21:0x7F]
_SIGN[ord("'")] = False

BLOCKS = "part int, block int, first long, n_ids long, doc_ids array<long>, lengths array<long>, ids binary"
DOCUMENTS = "doc_id long, start long, n_tokens long, ids binary"

_loaded: dict[str, Any] = {}


class _Codes:
    """Ids of the pieces a worker has coded, by two hashes of a piece.

    Sorted arrays, so that a slice's pieces are looked up together: new pieces go to a
    small run that is merged into the large one as it grows.
    """

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.runs = [(np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int32))] * 2
        self.flat = np.zeros(1 << 16, dtype=np.uint32)
        self.used = 0

    def __len__(self) -> int:
        return sum(len(r[0]) for r in self.runs)

    def find(self, key: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each piece begin, and how many they are: 0 if it is not here."""
        begin, size = np.zeros(len(key), np.int32), np.zeros(len(key), np.int32)
        for keys, checks, begins, sizes in self.runs:
            if len(keys):
                at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                here = (keys[at] == key) & (checks[at] == check)
                begin[here], size[here] = begins[at[here]], sizes[at[here]]
        return begin, size

    def add(self, key: np.ndarray, check: np.ndarray, ids: np.ndarray, size: np.ndarray) -> None:
        if self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat[: self.used], np.zeros(self.used + 2 * len(ids), np.uint32)])
        self.flat[self.used : self.used + len(ids)] = ids
        begin = self.used + np.cumsum(size) - size
        self.used += len(ids)
        new = (key, check, begin.astype(np.int32), size.astype(np.int32))
        large, small = self.runs
        small = self._merged(small, new)
        if len(small[0]) * 8 > len(large[0]):
            large, small = self._merged(large, small), tuple(c[:0] for c in small)
        self.runs = [large, small]

    @staticmethod
    def _merged(one: tuple, two: tuple) -> tuple:
        both = [np.concatenate(c) for c in zip(one, two, strict=True)]
        order = np.argsort(both[0], kind="stable")
        return tuple(c[order] for c in both)


@dataclass
class _Coder:
    """A tokenizer of this worker, the ids that end a piece, and the pieces coded so far."""

    tokenizer: Any
    closing: np.ndarray
    codes: _Codes


def _coder(path: str) -> _Coder:
    if path not in _loaded:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        closing = np.zeros(tokenizer.get_vocab_size(), dtype=bool)
        for token, number in tokenizer.get_vocab().items():
            closing[number] = token.endswith("</w>")
        _loaded[path] = _Coder(tokenizer, closing, _Codes())
    return _loaded[path]


def _pieces(found: words.Words) -> tuple[np.ndarray, words.Words, np.ndarray]:
    """Cut words of letters only (ASCII, Latin-1) from the punctuation after them.

    Returns the bytes with the letters of such words in lower case, the pieces, and
    which pieces are plain words. The tokenizer splits between letters and signs,
    folds case, and has no rule that reaches over this cut but those with an
    apostrophe, so the ids of the pieces are those of the word.
    """
    data, start, end = found.data, found.start, found.end
    if not len(start):
        return data, found, np.zeros(0, dtype=bool)
    places = np.arange(len(data), dtype=np.int32 if len(data) < 1 << 31 else np.int64)
    solid = np.maximum.accumulate(np.where(_SIGN[data], -1, places))[end - 1].astype(np.int64) + 1
    lead = data == 0xC3
    after = np.zeros(len(data), dtype=bool)
    after[1:] = lead[:-1] & (data[1:] != 0x97) & (data[1:] != 0xB7)
    lead[:-1] &= after[1:]
    other = np.zeros(len(data) + 1, dtype=places.dtype)
    np.cumsum(~(_ASCII_LETTER[data] | lead | after), out=other[1:])
    body_end = np.maximum(solid, start)
    plain = (body_end > start) & (other[body_end] == other[start])
    cut = plain & (body_end < end)
    folded = data.copy()
    upper = np.flatnonzero((data >= 0x41) & (data <= 0x5A))
    # The word around each upper-case letter.
    around = np.searchsorted(start, upper, side="right") - 1
    folded[upper[plain[around] & (upper < body_end[around])]] += 32
    count = 1 + cut.astype(np.int64)
    first = np.concatenate([[0], np.cumsum(count)])
    piece_start, piece_end = np.repeat(start, count), np.repeat(end, count)
    piece_end[first[:-1][plain]] = body_end[plain]
    tails = first[:-1][cut] + 1
    piece_start[tails] = body_end[cut]
    whole = np.repeat(plain, count)
    whole[tails] = False
    return folded, words.Words(folded, piece_start, piece_end, first[found.first]), whole


def _code(coder: _Coder, plain: list[bytes], others: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the pieces, one after the other, and how many each has.

    Plain words are coded together, with white space between them.
    """
    batch = coder.tokenizer.encode_batch_fast
    ids, size = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]

    def alone(pieces: list[bytes]) -> None:
        for coded in batch([p.decode() for p in pieces], add_special_tokens=False):
            ids.append(np.array(coded.ids, dtype=np.uint32))
            size.append(np.array([len(coded.ids)]))

    for at in range(0, len(plain), JOINED):
        some = plain[at : at + JOINED]
        (coded,) = batch([b" ".join(some).decode()], add_special_tokens=False)
        found = np.array(coded.ids, dtype=np.uint32)
        stop = np.flatnonzero(coder.closing[found]) + 1
        if len(stop) == len(some):
            ids.append(found)
            size.append(np.diff(stop, prepend=0))
        else:
            alone(some)
    alone(others)
    return np.concatenate(ids), np.concatenate(size)


def encode(texts: pa.Array, path: str, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts and the number of each, with ``end_id`` after every text.

    The tokenizer never joins what white space separates, so a text's ids are
    those of its pieces; each different piece is coded once.
    """
    coder = _coder(path)
    codes = coder.codes
    data, found, plain = _pieces(words.split(texts))
    key, first, which = np.unique(words.hashes(found), return_index=True, return_inverse=True)
    start, end = found.start[first], found.end[first]
    check = words.hashes(words.Words(data, start, end, np.array([0, len(first)])), seed=2)
    if len(codes) > CACHE_PIECES:
        codes.clear()
    begin, size = codes.find(key, check)
    new = np.flatnonzero(size == 0)
    simple = plain[first[new]]
    new = np.concatenate([new[simple], new[~simple]])
    raw = data.tobytes()
    pieces = [raw[a:b] for a, b in zip(start[new].tolist(), end[new].tolist(), strict=True)]
    n_simple = int(simple.sum())
    ids, n = _code(coder, pieces[:n_simple], pieces[n_simple:])
    begin[new] = codes.used + np.cumsum(n) - n
    size[new] = n
    codes.add(key[new], check[new], ids, n)
    n = size[which]
    before = np.concatenate([[0], np.cumsum(n, dtype=np.int64)])
    # Every text's end is a place of its own behind its ids.
    closes = before[found.first[1:]] + np.arange(len(found.first) - 1)
    out = np.full(before[-1] + len(closes), end_id, dtype=np.uint32)
    inside = np.ones(len(out), dtype=bool)
    inside[closes] = False
    source = np.repeat((begin[which] - before[:-1]).astype(np.int32), n)
    source += np.arange(before[-1], dtype=np.int32)
    out[inside] = codes.flat[source]
    return out, np.diff(np.concatenate([[-1], closes]))


def _blocks(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, first = TaskContext.get().partitionId(), 0, 0
        held: list[tuple] = []
        n_held = 0

        def flush() -> pa.RecordBatch:
            ids = np.concatenate([i for _, _, i in held])
            row = {
                "part": pa.array([part], pa.int32()),
                "block": pa.array([block], pa.int32()),
                "first": pa.array([first], pa.int64()),
                "n_ids": pa.array([len(ids)], pa.int64()),
                "doc_ids": pa.array([[d for ds, _, _ in held for d in ds]], pa.list_(pa.int64())),
                "lengths": pa.array([[int(n) for _, ns, _ in held for n in ns]], pa.list_(pa.int64())),
                "ids": pa.array([simple8b.pack(ids)], pa.binary()),
            }
            return pa.RecordBatch.from_pydict(row)

        for batch in batches:
            texts, doc_ids = batch.column("text"), batch.column("doc_id").to_pylist()
            for a, b in words.slices(texts, SLICE_BYTES):
                ids, size = encode(texts.slice(a, b - a), path, end_id)
                stops = np.cumsum(size)
                at, done = 0, 0
                while at < b - a:
                    to = int(np.searchsorted(stops, done + BLOCK_IDS - n_held, side="left")) + 1
                    to = min(max(to, at + 1), b - a)
                    held.append((doc_ids[a + at : a + to], size[at:to], ids[done : stops[to - 1]]))
                    n_held += int(stops[to - 1]) - done
                    at, done = to, int(stops[to - 1])
                    if n_held >= BLOCK_IDS:
                        yield flush()
                        block, first, held, n_held = block + 1, first + n_held, [], 0
        if held:
            yield flush()

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    """Code all documents (doc_id, text) into token files below ``path``."""
    rows = only(docs, ["doc_id", "text"])
    # Equal ids are dealt by their text, equal rows by their place in the input.
    order = [F.col("doc_id"), F.col("by_text"), F.col("place")]
    dealt = rows.select(
        "doc_id", "text", F.xxhash64("text").alias("by_text"), F.monotonically_increasing_id().alias("place")
    )
    sorted_rows = dealt.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    blocks = sorted_rows.mapInArrow(tidy(_blocks(tokenizer, end_id)), BLOCKS)
    blocks.write.option("compression", "zstd").parquet(path)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            ids = simple8b.unpack(batch.column("ids")[row].as_py()).astype("<u4")
            size = batch.column("lengths")[row].values.to_numpy()
            stops = np.concatenate([[0], np.cumsum(size)])
            ends = pa.py_buffer((4 * stops).astype(np.int64).tobytes())
            raw = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, ends, pa.py_buffer(ids.tobytes())])
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_ids")[row].values,
                    "start": pa.array(batch.column("start")[row].as_py() + stops[:-1], pa.int64()),
                    "n_tokens": pa.array(size, pa.int64()),
                    "ids": raw.cast(pa.binary()),
                }
            )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Documents of token files: doc_id, start, n_tokens, and the ids as little-endian 32-bit numbers.

    Blocks are decoded independently of one another. What precedes a part is
    added up over one row per part.
    """
    blocks = spark.read.schema(BLOCKS).parquet(path)
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    # Two numbers for each task that wrote: a bound that does not grow with a task's rows.
    placed = blocks.join(F.broadcast(parts), "part").select(
        (F.col("base") + F.col("first")).alias("start"), "doc_ids", "lengths", "ids"
    )
    return placed.mapInArrow(tidy(_documents), DOCUMENTS)
