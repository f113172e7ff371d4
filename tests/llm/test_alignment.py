import hashlib
from collections import Counter, defaultdict
from functools import cache

import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from eventide.llm import alignment, pieces, words
from tests.llm.conftest import DOCUMENT, rows

BYTE_PATH, PIECE_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
BYTES = Tokenizer.from_file(BYTE_PATH)
BYTES.encode_special_tokens = True
PIECES = sentencepiece.SentencePieceProcessor(model_file=PIECE_PATH)
GAPS = "abé \n\t 　 \x1c\x85'.1<|>▁日"
ODD = [
    " ", "  ", "a ", " a", "a  ", "  a  b ", "x\n\n y", "x \n y\t z", "a  b  c", "é è à", "a　 b", "a\x1c b",
    "<|endoftext|> <s> </s> <unk>", "it's IT'S 've", "日本語 日 本", "😀😀 👩‍👩‍👧", "ﬁ ① ½", "a▁b", "x" * 3000, "ab" * 700 + " c",
    "\x00 \x00", "​ a", "ạ́ b",
]


LETTERS = pieces._byte_letters()


@cache
def token_bytes_a(number):
    return bytes(LETTERS[c] for c in BYTES.id_to_token(number))


@cache
def token_bytes_b(number):
    if PIECES.is_byte(number):
        return bytes([int(PIECES.id_to_piece(number)[3:-1], 16)])
    return PIECES.id_to_piece(number).replace("▁", " ").encode()


def groups_of(text):
    """Groups of (ids of A, ids of B), None if a text has no tokens."""
    if not text:
        return None
    a, b = BYTES.encode(" " + text, add_special_tokens=False).ids, PIECES.encode(text)
    spelled = [[token_bytes_a(i) for i in a], [token_bytes_b(i) for i in b]]
    if any(b"".join(s) != (" " + text).encode() for s in spelled):
        return None
    ends = []
    for side in spelled:
        at, out = 0, []
        for token in side:
            at += len(token)
            out.append(at)
        ends.append(out)
    shared = sorted(set(ends[0]) & set(ends[1]))
    out, i, j = [], 0, 0
    for end in shared:
        group = ([], [])
        while i < len(a) and ends[0][i] <= end:
            group[0].append(a[i])
            i += 1
        while j < len(b) and ends[1][j] <= end:
            group[1].append(b[j])
            j += 1
        out.append(group)
    return out


def brute(given):
    links, counts = [], Counter()
    for _, text in given:
        found = Counter((x, y) for a, b in groups_of(text) or [] for x in a for y in b)
        links.append(found)
        counts.update(found.keys())
    most = defaultdict(int)
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    out = []
    for (doc_id, text), found in zip(given, links, strict=True):
        groups = groups_of(text)
        digest = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups or [])
        out.append(
            (
                doc_id,
                sum(len(a) for a, _ in groups or []),
                sum(len(b) for _, b in groups or []),
                len(groups or []),
                sum(found.values()),
                sum(n for p, n in found.items() if counts[p] == most[p[0]]),
                sum(n * counts[p] for p, n in found.items()),
                hashlib.sha256(digest.encode()).hexdigest() if groups else "",
            )
        )
    return sorted(out, key=repr)


def coded(texts, space_only):
    data, offsets = words.buffers(pa.array(texts, pa.string()))
    if space_only:
        data, offsets = pieces.prefixed(data, offsets)
    found = pieces.cut(data, offsets, space_only)
    coder = pieces.piece_coder(PIECE_PATH) if space_only else pieces.byte_coder(BYTE_PATH, True)
    ids, first = coder.encode(found)
    return [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)]


def check_pieces(texts):
    assert coded(texts, False) == [BYTES.encode(t, add_special_tokens=False).ids for t in texts]
    filled = [t for t in texts if t]
    assert coded(filled, True) == [PIECES.encode(t) for t in filled]
    data, offsets = pieces.prefixed(*words.buffers(pa.array(texts, pa.string())))
    ids, first = pieces.byte_coder(BYTE_PATH, True).encode(pieces.cut(data, offsets, space_only=True))
    assert ids.tolist() == [i for t in texts for i in BYTES.encode(" " + t, add_special_tokens=False).ids]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(GAPS), max_size=12) | st.text(max_size=8), max_size=5))
def test_pieces_give_the_ids_of_whole_texts(texts):
    check_pieces(texts)


def test_odd_pieces():
    check_pieces(ODD)


def test_documents(spark, documents, monkeypatch):
    given = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    expected = brute(given)
    assert rows(alignment.align(documents, BYTE_PATH, PIECE_PATH)) == expected
    # Slices of a few documents each, over several partitions.
    monkeypatch.setattr(alignment, "SLICE_BYTES", 5000)
    assert rows(alignment.align(documents.repartition(5), BYTE_PATH, PIECE_PATH)) == expected


def test_odd_texts(spark):
    df = spark.createDataFrame([(k, t, "en", "a", 0) for k, t in enumerate(ODD)], DOCUMENT)
    assert rows(alignment.align(df, BYTE_PATH, PIECE_PATH)) == brute(list(enumerate(ODD)))


@pytest.mark.parametrize("slice_bytes", [2 << 20, 10])
def test_odd_documents(odd, clashing, monkeypatch, slice_bytes):
    monkeypatch.setattr(alignment, "SLICE_BYTES", slice_bytes)
    expected = brute([(r.doc_id, r.text) for r in odd.collect()])
    for df in (odd, clashing):
        assert rows(alignment.align(df, BYTE_PATH, PIECE_PATH)) == expected
    assert alignment.align(odd.limit(0), BYTE_PATH, PIECE_PATH).collect() == []


def test_a_worker_keeps_a_bounded_number_of_pieces():
    """Pieces that were asked for again stay; the ids do not depend on what was kept."""
    calls = []

    def batch(given):
        calls.append(given)
        return pieces._joined([list(p) for p in given])

    coder = pieces.Coder(batch, 40)

    def ids(texts):
        found = pieces.cut(*words.buffers(pa.array(texts, pa.string())), space_only=True)
        coded, first = coder.encode(found)
        return [bytes(coded[a:b].tolist()).decode() for a, b in zip(first[:-1], first[1:], strict=True)]

    for k in range(12):
        texts = [" common", "".join(f" w{k}x{j}" for j in range(20)), "", " common" * 3]
        assert ids(texts) == texts
        assert len(coder.codes) <= 40 + 21
    assert sum(g.count(b" common") for g in calls) == 1
    # As many pieces as may stay, each asked for twice: none is kept.
    many = ["".join(f" m{j}" for j in range(50))]
    assert ids(many) == ids(many) == many
    assert ids([" one"]) == [" one"]
    assert len(coder.codes) == 1
    calls.clear()
    assert ids([""]) == [""] and not calls


def test_a_call_codes_a_bounded_number_of_pieces(monkeypatch):
    monkeypatch.setattr(pieces, "CALL_PIECES", 3)
    size = []
    coder = pieces.Coder(lambda given: size.append(len(given)) or pieces._joined([list(p) for p in given]), 100)
    text = "".join(f" p{j}" for j in range(10))
    found = pieces.cut(*words.buffers(pa.array([text])), space_only=True)
    assert bytes(coder.encode(found)[0].tolist()).decode() == text
    assert size == [3, 3, 3, 1]


def test_row_groups_of_slices_are_bounded(spark, documents, monkeypatch, tmp_path):
    monkeypatch.setattr(alignment, "SLICE_BYTES", 5000)
    monkeypatch.setattr(alignment, "GROUP_SLICES", 2)
    monkeypatch.setattr("eventide.llm.common.run_dir", lambda spark, name: str(tmp_path / name))
    alignment.align(documents, BYTE_PATH, PIECE_PATH)
    files = list((tmp_path / "alignment").glob("*.parquet"))
    groups = [m.row_group(k).num_rows for m in map(pq.read_metadata, files) for k in range(m.num_row_groups)]
    assert max(groups) == 2
    assert len(groups) > 10
