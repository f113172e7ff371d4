from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from eventide.llm import jaccard
from tests.llm.conftest import rows, words


def shingle_set(text):
    w = words(text)
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def brute(documents):
    """doc_id -> (class, links) over rows with different ids."""
    sets = {i: shingle_set(t) for i, t in documents}
    up = {i: i for i in sets}

    def find(k):
        while up[k] != k:
            k = up[k]
        return k

    links = Counter()
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            common = len(sets[a] & sets[b])
            if common and common >= 0.8 * (len(sets[a]) + len(sets[b]) - common):
                links[a] += 1
                links[b] += 1
                x, y = sorted((find(a), find(b)))
                up[y] = x
    return {i: (find(i), links[i]) for i in ids}


def near_copies(n, length=60):
    """A chain of texts, each changed a little, so that its ends are not near."""
    rng = np.random.default_rng(5)
    text = [f"w{k}" for k in range(length)]
    out = []
    for k in range(n):
        text = list(text)
        text[int(rng.integers(length))] = f"new{k}"
        out.append((1000 + k, " ".join(text)))
    return out


def test_links_and_classes_equal_brute_force(spark, documents):
    given = [(r.doc_id, r.text) for r in documents.collect()] + near_copies(40)
    df = spark.createDataFrame(given, "doc_id long, text string")
    found = {r.doc_id: (r.class_id, r.n_links) for r in jaccard.join(df).collect()}
    assert found == brute(given)


def test_cells_change_nothing(spark, monkeypatch):
    given = near_copies(60) + [(1, "x y z"), (2, "x y z"), (3, "x y")]
    df = spark.createDataFrame(given, "doc_id long, text string")
    monkeypatch.setattr(jaccard, "SIGNATURES", 7)
    monkeypatch.setattr(jaccard, "SETS", 5)
    monkeypatch.setattr(jaccard, "MATRIX_CELLS", 64)
    found = {r.doc_id: (r.class_id, r.n_links) for r in jaccard.join(df).collect()}
    assert found == brute(given)


def test_odd_documents(odd, clashing):
    columns = ("doc_id", "class_id", "n_links", "n_copies")
    found = rows(jaccard.join(odd), *columns)
    assert found == rows(jaccard.join(clashing), *columns)
    assert (5, 5, 1, 2) in found and (6, 5, 1, 2) in found
    assert found.count((7, 7, 1, 2)) == 2
    assert (1, 1, 0, 1) in found and (2, 2, 0, 1) in found and (None, None, 0, 1) in found
    assert jaccard.join(odd.limit(0)).collect() == []


def test_one_of_each_class_stays(odd, clashing):
    kept = jaccard.keep_one(clashing)
    assert kept.columns == clashing.columns
    assert rows(kept, *odd.columns) == rows(jaccard.keep_one(odd))
    ids = [r.doc_id for r in jaccard.keep_one(odd).collect()]
    assert ids.count(7) == 1 and 5 in ids and 6 not in ids and ids.count(None) == 2 and {1, 2, 3} <= set(ids)
    assert jaccard.keep_one(odd.limit(0)).collect() == []


@pytest.mark.parametrize("compared", [16, 64, 128])
def test_posterior_limit(compared):
    """The limit is the first count whose posterior is not below the tolerance (by integration)."""
    grid = np.linspace(0, 1, 400_001)[1:-1]

    def posterior(m):
        density = np.exp(m * np.log(grid) + (compared - m) * np.log1p(-grid) - _peak(m, compared))
        return density[grid >= jaccard.THRESHOLD].sum() / density.sum()

    m = jaccard.least_matches(compared)
    assert posterior(m) >= jaccard.TOLERANCE * 0.99 and posterior(m - 1) < jaccard.TOLERANCE * 1.01


def _peak(m, n):
    s = min(max(m / n, 1e-9), 1 - 1e-9)
    return m * np.log(s) + (n - m) * np.log1p(-s)


def test_signatures_estimate_similarity():
    a = " ".join(f"w{k}" for k in range(400))
    b = " ".join(f"w{k}" for k in range(40, 440))
    value, _ = jaccard.signatures(pa.array([a, b]))
    true = len(shingle_set(a) & shingle_set(b)) / len(shingle_set(a) | shingle_set(b))
    assert abs((value[0] == value[1]).mean() - true) < 0.12
