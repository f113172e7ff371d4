import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import regex

from eventide.llm import crf, langid
from tests.llm.conftest import rows


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    found = langid.identify(docs, langid.train(docs)).collect()
    assert len(found) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    held = [r for r in found if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in found)


def brute_marginals(e, a):
    """Marginals by summing over all label sequences."""
    n, k = e.shape
    out = np.zeros((n, k))
    pairs = np.zeros((k, k))
    for path in itertools.product(range(k), repeat=n):
        p = np.prod([e[t, y] for t, y in enumerate(path)]) * sum(a[s, path[0]] for s in range(k))
        p *= np.prod([a[x, y] for x, y in itertools.pairwise(path)])
        for t, y in enumerate(path):
            out[t, y] += p
    return out / out.sum(axis=1, keepdims=True), pairs


@pytest.mark.parametrize("segment", [2, 3, 100])
def test_marginals_equal_enumeration(monkeypatch, segment):
    """Segments and their transfer matrices give the marginals of the whole chain."""
    monkeypatch.setattr(crf, "SEGMENT", segment)
    rng = np.random.default_rng(3)
    lengths = [1, 6, 0, 3, 7, 2]
    first = np.concatenate([[0], np.cumsum(lengths)])
    e = rng.random((first[-1], 3)).astype(np.float32) + 0.05
    a = rng.random((3, 3)).astype(np.float32) + 0.05
    found = crf.Chain(first).marginals(e, a)
    for lo, hi in itertools.pairwise(first):
        if hi > lo:
            np.testing.assert_allclose(found[lo:hi], brute_marginals(e[lo:hi], a)[0], rtol=2e-3)


def test_code_switched_words():
    """Words of two invented languages, each text with a foreign passage."""
    rng = np.random.default_rng(1)

    def speak(lang, n):
        syllables = [["ka", "to", "ri", "mu"], ["schl", "bro", "gent", "ulf"]][lang]
        return " ".join("".join(rng.choice(syllables, 3)) for _ in range(n))

    labels = np.array([k % 2 for k in range(40)])
    texts = [f"{speak(y, 40)} {speak(1 - y, 10)}" for y in labels]
    model = crf.fit(pa.array(texts), labels, ["a", "b"])
    share = crf.shares(model, pa.array([speak(0, 30), speak(1, 30), speak(0, 20) + " " + speak(1, 20), ""]))
    assert share[0, 0] > 0.9 and share[1, 1] > 0.9 and 0.3 < share[2, 0] < 0.7 and share[3].sum() == 0
    assert model.transitions[0, 0] > model.transitions[0, 1]


def test_odd_documents(documents, odd, clashing):
    model = langid.train(documents)
    found = rows(langid.identify(odd, model))
    assert found == rows(langid.identify(clashing, model))
    by_id = {}
    for r in found:
        by_id.setdefault(r[0], []).append(r[2])
    assert by_id[1] == by_id[2] == by_id[3] == by_id[8] == ["und"]
    assert "und" in by_id[None] and len(by_id[7]) == 2
    assert langid.identify(odd.limit(0), model).collect() == []
    kept = langid.keep_identified(clashing, model, 0.3)
    assert kept.columns == clashing.columns
    assert not {1, 2, 3, 8} & {r.doc_id for r in kept.collect()}


def test_known_words_equal_a_count_of_trigrams(documents):
    model = langid.train(documents)
    texts = ["Die Sonne", "xq zzkv wrmp", "a", "Привет мир", "", None, "12 34"]
    seen = set(np.flatnonzero(np.unpackbits(model.spelled, bitorder="little")).tolist())

    def share(text):
        words = ["^" + w + "$" for w in regex.findall(r"\p{L}+", (text or "").lower())]
        held = 0
        for w in (w.encode() for w in words):
            grams = [w[k] | w[k + 1] << 8 | w[k + 2] << 16 for k in range(len(w) - 2)]
            held += 2 * sum(g in seen for g in grams) >= len(grams)
        return held / max(1, len(words))

    assert crf.known(model, pa.array(texts)).tolist() == [share(t) for t in texts]


@pytest.mark.parametrize("languages", [1, 2, 4])
def test_texts_unlike_the_learned_languages_are_rejected(spark, documents, languages):
    """However few languages there are to choose from; documents of the learned ones all stay."""
    rng = random.Random(languages)
    learned = sorted({r.lang for r in documents.select("lang").distinct().collect()} - {None})[:languages]
    docs = documents.filter(documents["lang"].isin(learned))
    model = langid.train(docs)
    noise = [" ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=8)) for _ in range(50)) for _ in range(20)]
    noise += ["Привет мир это русский текст", "今天天气很好我们去公园"]
    frame = spark.createDataFrame([(10**6 + k, t) for k, t in enumerate(noise)], "doc_id long, text string")
    kept = langid.keep_identified(docs.select("doc_id", "text").unionAll(frame), model, 0.5)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in docs.collect())


def test_nothing_to_learn_from(odd):
    assert langid.train(odd.limit(0)) is None
    assert {r.lang_pred for r in langid.identify(odd, None).collect()} == {"und"}


def test_held_out_documents_are_not_learned_from(documents):
    from pyspark.sql import functions as F

    changed = documents.withColumn("lang", F.when(langid.held_out(), F.lit("zz")).otherwise(F.col("lang")))
    one, two = langid.train(documents), langid.train(changed)
    assert one.labels == two.labels and np.array_equal(one.weights, two.weights)


def invented(lang, n, rng):
    """Words of an invented language: three syllables of its own eight."""
    own = np.random.default_rng(1000 + lang)
    syllables = ["".join(own.choice(list("abcdefghijklmnoprstuvwz"), 3)) for _ in range(8)]
    return " ".join("".join(rng.choice(syllables, 3)) for _ in range(n))


def test_every_language_is_learned(spark):
    """More than 64 languages, and one whose documents are all long."""
    rng = np.random.default_rng(4)
    docs = [(100 * y + k, invented(y, 30, rng), f"l{y:03}") for y in range(80) for k in range(12)]
    docs += [(9000 + k, "1 " * 15_000 + invented(99, 3_000, rng), "long") for k in range(8)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    model = langid.train(df)
    assert model.labels == sorted({lang for *_, lang in docs})
    truth = {i: lang for i, _, lang in docs}
    held = [r for r in langid.identify(df, model).collect() if r.held_out]
    assert len(held) > 150 and sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.98 * len(held)
    assert [r.lang_pred for r in held if r.doc_id >= 9000] == ["long"] * sum(r.doc_id >= 9000 for r in held)


def test_sample_shrinks_with_many_languages_but_no_language_goes():
    assert [langid.sample_docs(k) for k in (0, 1, 64, 128, 100_000)] == [250, 250, 250, 62, langid.FEWEST]


def test_parts_of_texts_change_no_result(monkeypatch):
    rng = np.random.default_rng(6)
    texts = pa.array([invented(y, 40, rng) for y in (0, 1, 2) for _ in range(5)] + ["", None])
    labels = np.array([y for y in (0, 1, 2) for _ in range(5)])
    model = crf.fit(texts.slice(0, 15), labels, ["a", "b", "c"])
    one = crf.shares(model, texts)
    monkeypatch.setattr(crf, "CELLS", 100)
    np.testing.assert_allclose(crf.shares(model, texts), one, rtol=1e-4)
    np.testing.assert_allclose(crf.fit(texts.slice(0, 15), labels, ["a", "b", "c"]).weights, model.weights, atol=1e-3)
