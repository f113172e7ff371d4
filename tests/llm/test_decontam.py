import random
import re

import pytest

from eventide.llm import decontam
from tests.llm.conftest import SF, rows

ITEM = [f"item{k}" for k in range(40)]


def tokens(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def test_planted_passages_are_found_and_others_left(spark, documents):
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    items = {r.item_id: tokens(r.text) for r in benchmark.collect()}
    found = {(r.doc_id, r.item_id) for r in decontam.overlaps(documents, benchmark).collect()}
    expected = set()
    for r in documents.collect():
        text = " ".join(tokens(r.text))
        expected |= {(r.doc_id, i) for i, t in items.items() if f" {' '.join(t)} " in f" {text} "}
    assert expected and found == expected


@pytest.mark.parametrize("changed", [0, 1, 3, 6])
def test_substitutions(spark, changed):
    """Substituted tokens, other case and other punctuation hide no passage of 40 tokens."""
    rng = random.Random(changed)
    docs = []
    for k in range(60):
        passage = list(ITEM)
        for at in rng.sample(range(40), changed):
            passage[at] = f"other{at}"
        text = "before " * rng.randint(0, 30) + ", ".join(passage).upper() + " after" * rng.randint(0, 30)
        docs.append((k, text))
    docs.append((100, " ".join(f"clean{k}" for k in range(200))))
    docs.append((101, " ".join(ITEM[:5]) + " short overlap " + " ".join(ITEM[20:25])))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, " ".join(ITEM))], "item_id long, text string")
    found = {r.doc_id: r for r in decontam.overlaps(df, benchmark).collect()}
    assert set(found) == set(range(60))
    assert all(r.n_equal >= decontam.EQUAL * r.n_tokens and r.n_equal >= decontam.LEAST for r in found.values())
    if changed <= 1:
        assert all(r.n_equal >= 20 for r in found.values())


def brute_longest(doc, item, shift):
    """Most equal tokens of a run on one diagonal that has four of five equal."""
    best = 0
    for a in range(len(item)):
        for b in range(a + 1, len(item) + 1):
            if a + shift >= 0 and b + shift <= len(doc):
                equal = sum(doc[k + shift] == item[k] for k in range(a, b))
                best = max(best, equal) if 5 * equal >= 4 * (b - a) else best
    return best


def test_longest_run_equals_brute_force():
    import numpy as np

    rng = np.random.default_rng(5)
    for _ in range(400):
        n = int(rng.integers(6, 31))
        item = np.arange(n)
        doc = np.concatenate([[-1] * 3, np.where(rng.random(n) < rng.choice([0.1, 0.15, 0.2, 0.4]), -2, item), [-3] * 2])
        shift, need = int(rng.choice([3, 3, 3, 2, n, -n // 2])), int(rng.integers(1, 11))
        if max(0, -shift) >= min(n, len(doc) - shift):
            continue
        a, z, equal = decontam.longest_run(doc, item, shift, need)
        expected = brute_longest(doc, item, shift)
        assert equal == (expected if expected >= need else 0)
        if equal:
            same = doc[a + shift : z + shift + 1] == item[a : z + 1]
            assert same[0] and same[-1] and same.sum() == equal and 5 * equal >= 4 * len(same)


def test_every_run_that_meets_the_rule_is_found(spark):
    """Items of 6 to 30 tokens with 0 to 25 % substituted, against brute force on the rule."""
    rng = random.Random(9)
    docs, items, expected = [(0, "clean words only")], [], {}
    for k in range(1, 700):
        n = rng.randint(6, 30)
        item = [f"i{k}t{t}" for t in range(n)]
        passage = [f"other{k}x{t}" if rng.random() < rng.choice([0, 0.1, 0.15, 0.2, 0.25]) else w for t, w in enumerate(item)]
        if k == 1:
            item = [f"i1t{t}" for t in range(16)]
            passage = [f"other{t}" if t in (4, 8, 12) else w for t, w in enumerate(item)]
        if k <= 13 and k > 1:
            item = [f"i{k}t{t}" for t in range(10)]
            passage = [f"other{t}" if t == k - 2 else w for t, w in enumerate(item)]
        before = rng.randint(0, 4)
        items.append((k, " ".join(item)))
        docs.append((k, " ".join(["before"] * before + passage + ["after"] * rng.randint(0, 4))))
        equal = brute_longest(passage, item, 0)
        if equal >= min(decontam.LEAST, -(-9 * len(item) // 10)):
            expected[k] = equal
    df = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontam.overlaps(df, benchmark).collect()
    assert all(r.doc_id == r.item_id for r in found)
    assert {r.doc_id: r.n_equal for r in found} == expected and 1 in expected


def test_masks_miss_no_run():
    """Of strings of equal (1) and substituted (0) tokens without a seed, none meets the rule at any
    length: the largest total of +1 and -4, per last tokens and number of equal ones."""
    masks = [(len(m), int(m, 2)) for m in decontam.MASKS]
    size = max(n for n, _ in masks)
    start = (0, 0, 0)
    best, todo = {start: 0}, {start}
    for _ in range(1000):
        changed = set()
        for last, n, equal in todo:
            for bit in (0, 1):
                after, m = (last << 1 | bit) & (1 << size) - 1, min(n + 1, size)
                if any(m >= k and after & w == w for k, w in masks):
                    continue
                state = after, m, min(decontam.LEAST, equal + bit)
                total = best[last, n, equal] + (1 if bit else -decontam.SUBSTITUTED)
                if total > best.get(state, -(10**9)):
                    best[state] = total
                    changed.add(state)
        todo = changed
    assert not todo and all(total < 0 for (_, _, equal), total in best.items() if equal == decontam.LEAST)


def test_odd_documents(spark, odd, clashing):
    items = [(1, "the same words stand here twice and more"), (1, "the same words stand here twice and more")]
    items += [(2, None), (3, ""), (4, "too short"), (None, "a row without an id of its own")]
    benchmark = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, seed string")
    found = rows(decontam.overlaps(odd, benchmark), "doc_id", "item_id")
    assert found == sorted([(7, 1), (7, 1), (None, None)], key=repr)
    assert found == rows(decontam.overlaps(clashing, benchmark), "doc_id", "item_id")
    kept = decontam.drop_overlapping(clashing, benchmark)
    assert kept.columns == clashing.columns
    assert {r.doc_id for r in kept.collect()} == {1, 2, 3, 4, 5, 6, 8, 9}
    assert decontam.overlaps(odd, benchmark.limit(0)).collect() == []
    assert decontam.overlaps(odd.limit(0), benchmark).collect() == []
    assert decontam.drop_overlapping(odd, benchmark.limit(0)).count() == odd.count()


def test_a_full_filter_and_ranges_of_seeds_change_nothing(spark, documents):
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    columns = ("doc_id", "item_id", "first_token", "last_token", "n_equal")
    expected = rows(decontam.overlaps(documents, benchmark), *columns)
    seeds = sum(len(r.seeds) for r in decontam.benchmark_seeds(benchmark).collect())
    few = 1 << (seeds * decontam.FEWEST_BITS // 2).bit_length()
    assert decontam.filter_size(seeds, few)[1] == 3
    assert expected and rows(decontam.overlaps(documents, benchmark, few), *columns) == expected
    # The same rows twice are found twice, in whichever range their seeds are.
    twice = rows(decontam.overlaps(documents.unionAll(documents), benchmark, few), *columns)
    assert twice == sorted(expected * 2, key=repr)


def test_a_filter_of_64_bits_changes_nothing(spark, documents, monkeypatch):
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    columns = ("doc_id", "item_id", "first_token", "last_token", "n_equal")
    docs = documents.limit(60)
    expected = rows(decontam.overlaps(docs, benchmark), *columns)
    monkeypatch.setattr(decontam, "filter_size", lambda seeds, most: (64, 1))
    assert expected and rows(decontam.overlaps(docs, benchmark), *columns) == expected


@pytest.mark.parametrize("seeds", [1, 1000, 700_000, 7_000_000, 70_000_000, 2_000_000_000])
def test_a_filter_lets_few_other_seeds_through(seeds):
    """By the formula, and where it is small enough by trial."""
    import numpy as np

    bits, ranges = decontam.filter_size(seeds, decontam.FILTER_BITS)
    assert bits <= decontam.FILTER_BITS and bits & (bits - 1) == 0 and ranges % 2
    held = -(-seeds // ranges)
    assert (1 - np.exp(-decontam.SET * held / bits)) ** decontam.SET < 1e-4
    if seeds <= 1_000_000:
        rng = np.random.default_rng(3)
        own, other = rng.integers(0, 2**63, held, dtype=np.uint64), rng.integers(0, 2**63, 100_000, dtype=np.uint64)
        flags = np.zeros(bits, dtype=bool)
        for k in range(decontam.SET):
            flags[((own & np.uint64(2**32 - 1)) + np.uint64(k) * (own >> np.uint64(32))) & np.uint64(bits - 1)] = True
        packed = np.packbits(flags, bitorder="little")
        assert len(decontam._known(packed, own)) == held
        assert len(decontam._known(packed, other)) < 50
