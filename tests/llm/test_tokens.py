import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from eventide.llm import simple8b, token_files
from eventide.session import run_dir
from tests.llm.conftest import rows

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)
ODD = [
    "", "a<|endoftext|>b", "X<|ENDOFTEXT|>", "abc<|", "it's IT'S don't...", "é. É.. ×. ÷, a×.", "…. a….", "é. ≮",
    "a1b2, 12.5!", " x y", "Ça!!va?", "ÀÈ***", "'s. x's.", "naïve's", "\x00a \x1c.", "日本。a", "a_b__c.", "ſt. ß, ﬁ.",
    "İI. ", "á. é", "x" * 500 + "!", " a　b.", "word.'s", "A.B.C.", "''' '", "#$%", "é̸.",
]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 40) | st.integers(0, 50_000), max_size=2500))
def test_round_trip(ids):
    assert simple8b.unpack(simple8b.pack(np.array(ids, dtype=np.uint64))).tolist() == ids


@pytest.mark.parametrize("n", [0, 1, 59, 60, 61, 1023, 1024, 1025, 5000])
@pytest.mark.parametrize("high", [0, 1, 2, 50_000, 2**31, 2**60 - 1, 2**60, 2**64 - 1])
def test_round_trip_of_sizes(n, high):
    ids = np.random.default_rng(n).integers(0, high, n, dtype=np.uint64, endpoint=True)
    packed = simple8b.pack(ids)
    assert np.array_equal(simple8b.unpack(packed), ids)
    if high == 1 and n == 5000:
        assert len(packed) < 5000 / 8 * 1.3


def direct(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [1]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(codec="utf-8", max_codepoint=0x2FF) | st.sampled_from("'.,!<|>é ñ́…")), max_size=4))
def test_pieces_give_the_ids_of_whole_texts(texts):
    ids, size = token_files.encode(pa.array(texts, pa.string()), PATH, 1)
    assert ids.tolist() == [x for t in texts for x in direct(t)]
    assert size.tolist() == [len(direct(t)) for t in texts]


def test_odd_texts():
    ids, _ = token_files.encode(pa.array(ODD), PATH, 1)
    assert ids.tolist() == [x for t in ODD for x in direct(t)]


def expected(given):
    out, start = [], 0
    for doc_id, text in sorted(given):
        ids = direct(text)
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("block", [1 << 18, 500])
def test_files_hold_all_documents_in_order(spark, documents, monkeypatch, block):
    from pyspark.sql import functions as F

    monkeypatch.setattr(token_files, "BLOCK_IDS", block)
    path = run_dir(spark, "tokens")
    token_files.write_tokens(documents.repartition(5), path, PATH, 1)
    back = token_files.read_tokens(spark, path).withColumn("crc", F.crc32("ids"))
    assert rows(back, "doc_id", "start", "n_tokens", "crc") == sorted(
        expected([(r.doc_id, r.text) for r in documents.collect()]), key=repr
    )


def test_odd_documents(spark, odd, clashing):
    found = []
    for df in (odd, clashing, odd.limit(0)):
        path = run_dir(spark, "tokens")
        token_files.write_tokens(df, path, PATH, 1)
        found.append(token_files.read_tokens(spark, path).collect())
    sizes = sorted((r.doc_id is not None, r.doc_id or 0, r.start, r.n_tokens, bytes(r.ids)) for r in found[0])
    assert sizes == sorted((r.doc_id is not None, r.doc_id or 0, r.start, r.n_tokens, bytes(r.ids)) for r in found[1])
    assert [r[2] for r in sizes] == np.concatenate([[0], np.cumsum([r[3] for r in sizes])])[:-1].tolist()
    assert found[2] == []
    by_id = {r.doc_id: r for r in found[0] if r.doc_id}
    assert by_id[1].n_tokens == by_id[2].n_tokens == 1
    assert np.frombuffer(by_id[4].ids, "<u4").tolist() == direct("one")
