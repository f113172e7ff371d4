import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from eventide.llm import packing
from eventide.llm.common import store

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)
END, SIZE = 2, 256


def packed_rows(df, size=SIZE):
    return packing.pack(store(packing.cut_documents(df, PATH, END, size), "pieces"), size)


def expected_pieces(given, size):
    out = []
    for doc_id, text in given:
        ids = TOKENIZER.encode(text or "", add_special_tokens=False).ids + [END]
        head = len(ids) - (-(-len(ids) // size) - 1) * size
        starts = [0, *range(head, len(ids), size)]
        for piece, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
            out.append((doc_id, piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    return sorted(out, key=repr)


def sequences(found, size):
    """Checks that sequences are gapless and fit, and gives their number."""
    by_id = defaultdict(list)
    for r in found:
        by_id[r.sequence_id].append((r.offset, r.length))
    for parts in by_id.values():
        parts.sort()
        assert [a for a, _ in parts] == np.concatenate([[0], np.cumsum([n for _, n in parts])[:-1]]).tolist()
        assert sum(n for _, n in parts) <= size
    return len(by_id)


def check(df, size=SIZE):
    found = packed_rows(df, size).withColumn("crc", F.crc32("ids")).collect()
    given = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    pieces = sorted(((r.doc_id, r.piece, r.start, r.length, r.crc) for r in found), key=repr)
    assert pieces == expected_pieces(given, size)
    return sequences(found, size), -(-sum(r.length for r in found) // size)


def test_documents(documents):
    n, least = check(documents)
    assert n <= least + 1


def test_cells_lose_nothing_to_their_borders(documents, monkeypatch):
    """Cells of eight pieces: the levels above put together what they leave."""
    monkeypatch.setattr(packing, "CELL_PIECES", 8)
    monkeypatch.setattr(packing, "FAN", 4)
    n, least = check(documents.repartition(4))
    assert n <= least + 2


def test_reruns_agree(documents):
    cut = store(packing.cut_documents(documents, PATH, END, SIZE).drop("ids"), "pieces")
    one, two = (sorted(map(tuple, packing.pack(df, SIZE).collect())) for df in (cut, cut.repartition(7)))
    assert one == two


def test_sequences(documents):
    cut = store(packing.cut_documents(documents, PATH, END, SIZE), "pieces")
    packed = packing.pack(cut, SIZE)
    parts = defaultdict(list)
    for r in packed.collect():
        parts[r.sequence_id].append((r.offset, bytes(r.ids)))
    made = {r.sequence_id: (bytes(r.ids), r.n_tokens) for r in packing.sequences(packed).collect()}
    whole = {k: b"".join(ids for _, ids in sorted(v)) for k, v in parts.items()}
    assert made == {k: (v, len(v) // 4) for k, v in whole.items()}


def test_odd(odd, clashing):
    for df in (odd, clashing):
        check(df)
    assert packed_rows(odd.limit(0)).collect() == []


def test_special_token_in_a_text(spark):
    texts = ["a <|endoftext|> b", "<|endoftext|>", "a<|endoftext|>", "x  <|endoftext|>  y <|endo"]
    df = spark.createDataFrame([(k, t, "en", "a", 0) for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    check(df)


def fills(lengths, where):
    return np.bincount(where, weights=lengths).astype(int)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 60), max_size=80))
def test_search_keeps_pieces_and_needs_no_more_sequences(lengths):
    lengths = np.array(sorted(lengths, reverse=True), dtype=np.int64)
    first = packing.best_fit(lengths, 60)
    where = packing.pack_lengths(lengths, 60)
    assert (fills(lengths, where) <= 60).all()
    assert len(np.unique(where)) <= len(np.unique(first))
    squares = [(fills(lengths, w) ** 2).sum() for w in (first, where)]
    assert squares[1] >= squares[0]


# Exchanges and plain moves, each from a packing that best fit would not make.
@pytest.mark.parametrize(
    ("lengths", "where"),
    [
        ([7, 6, 5, 4, 2], [0, 1, 2, 0, 1]),
        ([5, 5, 4, 3, 3], [0, 1, 0, 1, 2]),
        ([6, 3, 2], [0, 1, 0]),
    ],
)
def test_search_empties_sequences(lengths, where):
    lengths, where = np.array(lengths), np.array(where)
    search = packing._Search(lengths, where, 12)
    before = (fills(lengths, where) ** 2).sum()
    search.run()
    assert (search.fill**2).sum() > before
    assert len(np.unique(search.where)) < len(np.unique(where))
