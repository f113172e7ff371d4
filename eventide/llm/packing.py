"""Packing documents into sequences: best fit, then a local search by exchanges.

A document is its ids and an end id; one longer than a sequence is cut, its first
piece taking what does not fill a whole one. Whole sequences need no packing. The
other pieces are dealt into cells by hash. In a cell, best fit by falling length gives
a first packing; then the emptiest sequences are emptied step by step: a piece moves,
or one or two are exchanged for one, where that makes the sum of squared fills grow.
The emptiest sequences left in a cell pass to the next level, where those of ``FAN``
cells are packed anew, up to a single cell: what is lost to the cells' borders is
bounded by the last level, not by their number.

Edge cases: a null or empty text is the end id alone; a null doc_id is kept; repeated
rows are documents of their own; an empty table gives no rows; other columns are not
read. Ties go to the piece numbered first when documents were coded.
"""

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm import pieces, words
from eventide.llm.common import only, store, tidy
from eventide.llm.groups import single

SLICE_BYTES = 3 << 20
# Pieces of a cell, about; sequences a cell hands on at most, and cells that hand on to one.
CELL_PIECES = 8192
HANDED_ON = 32
FAN = 64
# Sequences that the search tries to empty in a cell, and exchanges for each.
TRIED, EXCHANGES = 256, 64

PIECES = "item long, doc_id long, piece int, start long, length long, ids binary"


def _cut(path: str, end_id: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = pieces.byte_coder(path, False)
        item = TaskContext.get().partitionId() << 33
        for batch in batches:
            texts, doc_ids = batch.column("text"), batch.column("doc_id")
            for at, to in words.slices(texts, SLICE_BYTES):
                ids, first = coder.encode(pieces.cut(*words.buffers(texts.slice(at, to - at))))
                ids = np.insert(ids, first[1:], end_id)
                first = first + np.arange(len(first))
                n = np.diff(first)
                count = -(-n // size)
                doc = np.repeat(np.arange(len(n)), count)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
                head = n - (count - 1) * size
                start = np.where(piece == 0, 0, head[doc] + (piece - 1) * size)
                length = np.where(piece == 0, head[doc], size)
                raw = pa.py_buffer(ids.astype("<u4").tobytes())
                ends = pa.py_buffer((4 * np.append(first[doc] + start, len(ids))).astype(np.int64).tobytes())
                binary = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(doc), [None, ends, raw])
                yield pa.RecordBatch.from_pydict(
                    {
                        "item": pa.array(item + np.arange(len(doc)), pa.int64()),
                        "doc_id": doc_ids.slice(at, to - at).take(pa.array(doc)),
                        "piece": pa.array(piece, pa.int32()),
                        "start": pa.array(start, pa.int64()),
                        "length": pa.array(length, pa.int64()),
                        "ids": binary.cast(pa.binary()),
                    }
                )
                item += len(doc)

    return run


def cut_documents(docs: DataFrame, tokenizer: str, end_id: int, size: int) -> DataFrame:
    """Pieces of all documents (``PIECES``): ``item`` numbers them within one run of this job,
    so store the result before it is used twice. ``ids`` are little-endian 32-bit numbers."""
    return only(docs, ["doc_id", "text"]).mapInArrow(tidy(_cut(tokenizer, end_id, size)), PIECES)


def best_fit(lengths: np.ndarray, size: int) -> np.ndarray:
    """The sequence of each length (longest first): the fullest one with room for it, else a new one."""
    by_room: list[list[int]] = [[] for _ in range(size + 1)]
    rooms, made = 0, 0  # bit r: some sequence has room r
    out = np.empty(len(lengths), dtype=np.int64)
    for k, length in enumerate(lengths.tolist()):
        fits = rooms >> length
        if fits:
            room = length + (fits & -fits).bit_length() - 1
            here = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, here = size, made
            made += 1
        out[k] = here
        if room > length:
            by_room[room - length].append(here)
            rooms |= 1 << (room - length)
    return out


class _Search:
    """Exchanges between the sequences of a cell that are not full."""

    def __init__(self, lengths: np.ndarray, where: np.ndarray, size: int) -> None:
        self.size = size
        fill = np.bincount(where, weights=lengths).astype(np.int64)
        self.member = np.flatnonzero(fill[where] < size)
        self.length = lengths[self.member]
        self.where = where[self.member].copy()
        self.fill = fill

    def run(self) -> None:
        """Empty one sequence after the other, the emptiest first, while there is room for one."""
        named = np.unique(self.where)
        for target in named[np.argsort(self.fill[named], kind="stable")][:TRIED].tolist():
            if (self.size - self.fill[np.unique(self.where)]).sum() < self.size:
                return
            for _ in range(EXCHANGES):
                if not self.fill[target] or not self._exchange(target):
                    break

    def _given(self, target: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What the target can give: one piece or two, and their length together. Of equal
        lengths the first choice stands for all."""
        own = np.flatnonzero(self.where == target)
        own = own[np.unique(self.length[own], return_index=True)[1]]
        every = np.flatnonzero(self.where == target)
        one, two = own, np.full(len(own), -1)
        if len(every) > 1:
            # A second of the same length pairs with the first.
            values, counts = np.unique(self.length[every], return_counts=True)
            i, j = np.triu_indices(len(values))
            fine = (i != j) | (counts[i] > 1)
            i, j = i[fine], j[fine]
            second = {int(v): int(k) for v, k in zip(self.length[every][::-1], every[::-1], strict=True)}
            last = {int(v): int(k) for v, k in zip(self.length[every], every, strict=True)}
            one = np.concatenate([one, [second[int(values[k])] for k in i]]).astype(np.int64)
            two = np.concatenate([two, [last[int(values[k])] for k in j]]).astype(np.int64)
        total = self.length[one] + np.where(two >= 0, self.length[two], 0)
        first = np.unique(total, return_index=True)[1]
        first = first[total[first] <= self.size]
        return one[first], two[first], total[first]

    def _exchange(self, target: int) -> bool:
        """The exchange that makes the sum of squared fills grow most; false if none does."""
        one, two, total = self._given(target)
        others = np.unique(self.where)
        others = others[others != target]
        # Taken in return: nothing (entries of sequences) or one piece (entries of pieces).
        back = np.flatnonzero(self.where != target)
        length = np.concatenate([np.zeros(len(others), np.int64), self.length[back]])
        at = np.concatenate([others, self.where[back]])
        if not len(at):
            return False
        moved = total[:, None] - length[None, :]
        gain = moved * (self.fill[at][None, :] - self.fill[target] + moved)
        gain[(moved <= 0) | (moved > (self.size - self.fill[at])[None, :])] = 0
        best = int(np.argmax(gain))
        g, r = divmod(best, len(at))
        if gain[g, r] <= 0:
            return False
        to = int(at[r])
        for piece in (one[g], two[g]):
            if piece >= 0:
                self.where[piece] = to
        if r >= len(others):
            self.where[back[r - len(others)]] = target
        self.fill[to] += moved[g, r]
        self.fill[target] -= moved[g, r]
        return True


def pack_lengths(lengths: np.ndarray, size: int) -> np.ndarray:
    """The sequence of each length, longest first: best fit, then exchanges."""
    where = best_fit(lengths, size)
    if len(where) and (where.max() + 1) * size - lengths.sum() >= size:
        search = _Search(lengths, where, size)
        search.run()
        where[search.member] = search.where
    return where


def _pack_cells(size: int, handed_on: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in single(batches, ["cell"]):
            lengths = cell["length"].to_numpy()
            where = pack_lengths(lengths, size)
            order = np.argsort(where, kind="stable")
            cell, lengths, where = cell.take(pa.array(order)), lengths[order], where[order]
            head = np.flatnonzero(np.append(True, where[1:] != where[:-1]))
            nth = np.cumsum(np.append(True, where[1:] != where[:-1])) - 1
            before = np.cumsum(lengths) - lengths
            fill = np.add.reduceat(lengths, head)
            emptiest = np.argsort(fill, kind="stable")[:handed_on]
            open_ = np.zeros(len(head), dtype=bool)
            open_[emptiest[fill[emptiest] < size]] = True
            columns = {
                "sequence_id": pa.array(cell["item"].to_numpy()[head][nth]),
                "offset": pa.array(before - before[head][nth]),
                "open": pa.array(open_[nth]),
            }
            for name in ("sequence_id", "offset", "open"):
                at = cell.column_names.index(name)
                cell = cell.set_column(at, name, columns[name])
            yield from cell.combine_chunks().to_batches()

    return run


def pack(cut: DataFrame, size: int) -> DataFrame:
    """Pieces (``item``, ``length`` and what goes with them) with their sequence and place in it.

    A sequence is named after its first piece. Every level is written before the next.
    """
    whole = cut.filter(F.col("length") >= size).withColumns({"sequence_id": F.col("item"), "offset": F.lit(0).cast("long")})
    rest = cut.filter(F.col("length") < size)
    cells = max(1, -(-rest.count() // CELL_PIECES))
    level = rest.withColumns(
        {
            "sequence_id": F.lit(0).cast("long"),
            "offset": F.lit(0).cast("long"),
            "open": F.lit(True),
            "cell": F.pmod(F.xxhash64("item"), F.lit(cells)),
        }
    )
    done = [whole]
    while True:
        dealt = level.repartition(cells, "cell").sortWithinPartitions("cell", F.desc("length"), "item")
        run = tidy(_pack_cells(size, HANDED_ON if cells > 1 else 0))
        packed = store(dealt.mapInArrow(run, dealt.schema), "packing")
        done.append(packed.filter("NOT open").drop("open", "cell"))
        if cells == 1:
            return reduce(DataFrame.unionByName, done)
        cells = -(-cells // FAN)
        level = packed.filter("open").withColumn("cell", F.floor(F.col("cell") / FAN))


def sequences(packed: DataFrame) -> DataFrame:
    """The ids of each sequence of packed pieces that carry ``ids``: at most a sequence's size in one row."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda ids, part: F.concat(ids, part["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"), F.sum("length").alias("n_tokens"))
