import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from eventide.llm import mixing
from tests.llm.conftest import DOCUMENT, rows, words

WEIGHTS = (5, 2, 1)


def brute_targets(sizes):
    """Reshare what exceeds three times a source's words until nothing does."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: WEIGHTS[k % 3] for k, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in full)
        free = sum(weight[s] for s in order if s not in full)
        target = {s: 3.0 * sizes[s] if s in full else left * weight[s] / free for s in order}
        over = {s for s in order if s not in full and target[s] > 3 * sizes[s]}
        if not over:
            return target
        full |= over


def check(mixed, given):
    """Sizes, targets, the limit, and each source's miss of at most its largest document."""
    sizes, largest = defaultdict(int), defaultdict(int)
    for source, size in given:
        sizes[source] += size
        largest[source] = max(largest[source], size)
    target = brute_targets(sizes)
    taken = defaultdict(int)
    for r in mixed:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        assert 0 <= r.copies <= 3
        taken[r.source] += r.copies * r.size
    for source, words_taken in taken.items():
        assert abs(words_taken - target[source]) <= largest[source] + 1e-6
    assert len(mixed) == len(given)


def test_mix_meets_targets(documents):
    given = [(r.source, len(words(r.text))) for r in documents.collect()]
    check(mixing.mix(documents, WEIGHTS).collect(), given)


def test_many_levels_and_a_hot_source(spark, monkeypatch):
    monkeypatch.setattr(mixing, "FAN_IN", 4)
    rng = random.Random(4)
    data = [(k, " ".join(["w"] * rng.randint(0, 40)), "en", rng.choice(["a", "a", "a", "b", None, "tiny"]) if k else "tiny", 0) for k in range(900)]
    df = spark.createDataFrame(data, DOCUMENT)
    mixed = mixing.mix(df, WEIGHTS)
    check(mixed.collect(), [(d[3], len(d[1].split())) for d in data])
    again = mixing.mix(df.repartition(5, "text"), WEIGHTS)
    assert rows(mixed) == rows(again)


def test_expected_copies_are_the_share(spark):
    """Over seeds, each document is taken about as often as its source's share says."""
    df = spark.createDataFrame([(k, "w " * (k + 1), "en", "a" if k < 6 else "b", 0) for k in range(12)], DOCUMENT)
    runs = [r for seed in range(25) for r in mixing.mix(df, (1, 3), seed=seed).collect()]
    for k in range(12):
        own = [r for r in runs if r.doc_id == k]
        share = own[0].target / own[0].source_size
        assert abs(sum(r.copies for r in own) / len(own) - share) < 0.4


def test_odd_documents(odd, clashing):
    mixed = mixing.mix(odd, WEIGHTS)
    check(mixed.collect(), [(r.source, len(words(r.text))) for r in odd.collect()])
    assert rows(mixed) == rows(mixing.mix(clashing, WEIGHTS))
    assert mixing.mix(odd.limit(0), WEIGHTS).collect() == []


def test_repeat_takes_each_document_as_often_as_the_mix(odd, clashing):
    mixed = mixing.mix(clashing, WEIGHTS)
    taken = mixing.repeat(clashing, mixed)
    assert taken.columns == clashing.columns
    assert taken.count() == mixed.agg(F.sum("copies")).first()[0]
    counts = {tuple(r)[:1]: r["count"] for r in taken.groupBy("doc_id").count().collect()}
    expected = {tuple(r)[:1]: r.n for r in mixed.groupBy("doc_id").agg(F.sum("copies").alias("n")).collect() if r.n}
    assert counts == expected
    assert mixing.repeat(odd.limit(0), mixing.mix(odd.limit(0), WEIGHTS)).collect() == []
