import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from eventide.llm import divergence, k2tree, queries
from tests.llm.conftest import CLASHES, DOCUMENT, rows

TERMS = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def brute(given, least, top):
    words, held = defaultdict(Counter), defaultdict(Counter)
    groups = set()
    for text, lang, source in given:
        lang, source = lang or "", source or ""
        found = TERMS.findall((text or "").translate(UPPER))
        groups.add((lang, source))
        words[lang, source].update(found)
        held[lang].update(set(found))
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted(t for t, n in held[lang].items() if n >= least)
        v = len(kept)

        def prices(counts, kept=kept, v=v):
            n = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // (n + 5 * v) for t in kept}

        mine = [s for k, s in groups if k == lang]
        q = prices(sum((words[lang, s] for s in mine), Counter()))
        p = {s: prices(words[lang, s]) for s in mine}
        for s in mine:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in mine if o != s]
            terms = [(p[s][t] - q[t], t) for t in kept if words[lang, s][t] and p[s][t] > q[t]]
            for part, items, limit in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(items, key=lambda x: (-x[0], x[1].encode()))[:limit]
                out += [(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(ranked)]
    return sorted(out, key=repr)


def by_brute(df, least, top):
    return brute([(r.text, r.lang, r.source) for r in df.select("text", "lang", "source").collect()], least, top)


@pytest.mark.parametrize("least", [1, 5, 10_000])
def test_audit(documents, least):
    assert rows(divergence.audit(documents, least)) == by_brute(documents, least, 50)


def test_small_tiles(documents, monkeypatch):
    """Many blocks of terms, some longer than a tile, and slices of a few texts."""
    monkeypatch.setattr(divergence, "BLOCK_TERMS", 5000)
    assert rows(divergence.audit(documents, 1, 3)) == by_brute(documents, 1, 3)


def test_many_sources(spark):
    """More sources than a tile has rows, most of them without the terms of the others."""
    given = [(k, f"common w{chr(97 + k % 26)} w{chr(97 + k % 7)}x " * (k % 5 + 1), "en", f"s{k % 300}", 0) for k in range(900)]
    df = spark.createDataFrame(given, DOCUMENT)
    assert rows(divergence.audit(df, 30)) == by_brute(df, 30, 50)


def test_odd(odd, clashing):
    for df in (odd, clashing):
        assert rows(divergence.audit(df, 1)) == by_brute(odd, 1, 50)
        assert rows(divergence.audit(df, 30)) == by_brute(odd, 30, 50)
    assert divergence.audit(odd.limit(0)).collect() == []
    assert "place" in CLASHES


def test_prices_are_exact():
    counts = np.array([0, 1, 10**12, 7 * 10**14, 3], dtype=np.int64)
    divisor = np.array([5, 7, 10**12 + 5, 9 * 10**15, 0], dtype=np.int64)
    exact = [1 + 10**9 * (int(c) + 5) // int(d) if d else 0 for c, d in zip(counts, divisor, strict=True)]
    assert k2tree.prices(counts, divisor).tolist() == exact


@pytest.mark.parametrize("seed", range(8))
def test_walk_equals_dense(seed):
    """Empty, sparse, clustered and full tiles; any width."""
    random = np.random.default_rng(seed)
    width = int(random.choice([0, 1, 63, 64, 65, 700, k2tree.COLUMNS]))
    tiles = []
    for _ in range(2):
        n_rows = int(random.integers(1, k2tree.ROWS + 1))
        divisor = np.zeros(k2tree.ROWS, np.int64)
        divisor[:n_rows] = random.integers(1000, 10**6, n_rows)
        counts = np.zeros((k2tree.ROWS, k2tree.COLUMNS), np.int64)
        cells = random.random((n_rows, width)) < random.choice([0, 0.001, 0.05, 1])
        counts[:n_rows, :width] = cells * random.integers(1, 50, (n_rows, width))
        if seed % 2:
            counts[:, width // 3 :] = 0
        row, col = np.nonzero(counts)
        price = k2tree.prices(counts, divisor[:, None])[:, :width]
        tiles.append((k2tree.build(row, col, counts[row, col], divisor), price))
    expected = np.abs(tiles[0][1][:, None, :] - tiles[1][1][None, :, :]).sum(axis=2)
    assert np.array_equal(k2tree.distances(tiles[0][0], tiles[1][0], width), expected)


def test_sql(spark, tables, documents):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tables}/documents.parquet'")
    found = con.execute(queries.DIVERGENCE_SQL.replace(">= 30", ">= 5")).fetchall()
    order = ("lang", "source", "part", "item", "value", "rank")
    assert rows(divergence.audit(documents, 5), *order) == sorted(found, key=repr)
