import numpy as np
import pyarrow as pa
import pytest

from eventide.llm.groups import bounds, groups


@pytest.mark.parametrize("batch", [1, 2, 3, 7, 100])
def test_groups_are_whole(batch):
    rng = np.random.default_rng(batch)
    key = np.sort(rng.integers(0, 12, 60))
    other = np.arange(60) // 20
    order = np.lexsort((other, key))
    table = pa.table({"k": key[order], "o": other[order], "v": np.arange(60)})
    found = list(groups(iter(table.to_batches(max_chunksize=batch)), ["k", "o"]))
    assert pa.concat_tables(found)["v"].to_pylist() == list(range(60))
    ends = [(t["k"][-1].as_py(), t["o"][-1].as_py()) for t in found]
    starts = [(t["k"][0].as_py(), t["o"][0].as_py()) for t in found]
    assert all(e != s for e, s in zip(ends, starts[1:], strict=False))
    assert list(groups(iter([]), ["k"])) == []
    assert bounds(table.slice(0, 0), ["k"]).tolist() == [0]
