"""Groups of a sorted stream of Arrow batches."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows of the stream, which is sorted by ``keys``, in tables of whole groups."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        new = bounds(table, keys)
        if held:
            tail = pa.Table.from_batches(held[-1:]).slice(held[-1].num_rows - 1)
            joined = pa.concat_tables([tail, table.slice(0, 1)])
            same = len(bounds(joined, keys)) == 2
        else:
            same = False
        # The last group may go on in the next batch.
        if len(new) > 2 or (held and not same):
            cut = int(new[-2])
            if cut or held:
                yield pa.concat_tables([pa.Table.from_batches(held), table.slice(0, cut)] if held else [table.slice(0, cut)])
            held = [pa.Table.to_batches(table.slice(cut).combine_chunks())[0]]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def single(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The same, one group at a time."""
    for table in groups(batches, keys):
        cuts = bounds(table, keys).tolist()
        for at, to in zip(cuts[:-1], cuts[1:], strict=True):
            yield table.slice(at, to - at)


def bounds(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Where groups begin, and the end."""
    new = np.zeros(table.num_rows, dtype=bool)
    for key in keys:
        column = table[key].to_numpy()
        new[1:] |= column[1:] != column[:-1]
    new[:1] = True
    return np.append(np.flatnonzero(new), table.num_rows)
