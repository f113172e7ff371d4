import hashlib
import random

import numpy as np
import pytest

from eventide.llm import phrases
from tests.llm.conftest import rows, words

EMPTY = hashlib.sha256(b"").hexdigest()


def brute(given):
    seen, out = set(), {}
    for doc_id, text in sorted(given):
        w = words(text)
        gone = [False] * len(w)
        for s in range(len(w) - 19):
            if tuple(w[s : s + 20]) in seen:
                gone[s : s + 20] = [True] * 20
            seen.add(tuple(w[s : s + 20]))
        left = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out[doc_id] = (len(w), sum(gone), hashlib.sha256(left.encode()).hexdigest())
    return out


def dedup(df):
    return {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in phrases.dedup(df).collect()}


@pytest.mark.parametrize("cell", [200_000, 300])
def test_equals_brute_force(spark, documents, monkeypatch, cell):
    """Also when families are split over cells, round by round."""
    monkeypatch.setattr(phrases, "CELL_WORDS", cell)
    given = [(r.doc_id, r.text) for r in documents.collect()]
    assert dedup(documents) == brute(given)


@pytest.mark.parametrize("cell", [200_000, 60])
def test_small_alphabets(spark, monkeypatch, cell):
    """Texts of few words repeat in every way: inside themselves, overlapping, in many places."""
    monkeypatch.setattr(phrases, "CELL_WORDS", cell)
    monkeypatch.setattr(phrases, "SHARED", 2)
    rng = random.Random(cell)
    passages = [" ".join(rng.choice("abcdef") for _ in range(rng.randint(15, 45))) for _ in range(6)]
    given = [(k, " ".join(rng.choice(passages) if rng.random() < 0.6 else rng.choice("xyz") for _ in range(rng.randint(1, 6)))) for k in range(70)]
    given += [(200, "a " * 90), (201, "a " * 70), (202, "a b " * 40)]
    df = spark.createDataFrame(given, "doc_id long, text string")
    assert dedup(df) == brute(given)


def test_joined_runs():
    rng = np.random.default_rng(2)
    doc_of = np.array([1, 1, 2, 3])
    owner, begin = rng.integers(0, 4, 60), rng.integers(0, 200, 60)
    end = begin + rng.integers(1, 12, 60)
    covered = {(doc_of[o], k) for o, a, z in zip(owner, begin, end, strict=True) for k in range(a, z)}
    runs = list(zip(*phrases.joined_runs(owner, doc_of, begin, end), strict=True))
    again = [(doc_of[o], k) for o, a, z in runs for k in range(a, z)]
    assert set(again) == covered and len(again) == len(covered)


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(1)
    tokens = rng.integers(0, 9, 400).astype(np.uint64)
    first = np.array([0, 150, 160, 400])
    value, begin, end = phrases.anchors(tokens, first)
    served = {}
    for v, a, z in zip(value.tolist(), begin.tolist(), end.tolist(), strict=True):
        for s in range(a, z + 1):
            assert s not in served
            served[s] = v
    starts = [s for lo, hi in ((0, 150), (160, 400)) for s in range(lo, hi - 19)]
    assert sorted(served) == starts
    by_window = {}
    for s in starts:
        assert by_window.setdefault(tuple(tokens[s : s + 20].tolist()), served[s]) == served[s]


def test_odd_documents(spark, odd, clashing):
    found = rows(phrases.dedup(odd))
    assert found == rows(phrases.dedup(clashing))
    by_id = {}
    for r in found:
        by_id.setdefault(r[0], []).append(r[1:])
    assert by_id[1] == by_id[2] == by_id[3] == [(0, 0, EMPTY)]
    # The later of two equal texts is gone; of its own words the first text repeats some.
    assert by_id[6] == [(40_000, 40_000, EMPTY)] and by_id[5][0][1] < 40_000
    assert len(by_id[7]) == 2 and all(n == 0 for _, n, _ in by_id[7])
    assert phrases.dedup(odd.limit(0)).collect() == []


def test_repeated_rows_and_ties(spark):
    text = " ".join(f"w{k}" for k in range(30))
    given = [(5, text), (5, text), (None, text), (4, "x " + text), (4, text + " y")]
    df = spark.createDataFrame(given, "doc_id long, text string")
    found = sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in phrases.dedup(df).collect())
    assert [f for f in found if f[0] in (0, 5)] == [(0, 30, 30), (5, 30, 30), (5, 30, 30)]
    # Of two documents of one id, one comes first.
    assert sorted(f[2] for f in found if f[0] == 4) == [0, 30]
