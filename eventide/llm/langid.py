"""Language identification of code-switched text by a conditional random field.

``crf`` labels every word of every whole text; a document's language is the label
with the largest mean marginal over its words, and the score is that mean.

Every language of the labelled documents is learned, however many there are. The
model is fitted on a sample of each: the ``TRAIN_DOCS`` documents first in the order of
their id's hash, among those of at most ``TRAIN_CHARS`` characters. Where these are under
``FEWEST``, passages of so many characters from longer documents make up for them.
Beyond ``MANY`` languages each has fewer documents, so that words times languages do
not grow, but never under ``FEWEST``. Documents that are held out never enter it.

Edge cases: a null text or one without a letter is ``und`` with score 0; a null
doc_id is predicted, but neither held out nor learned from; equal rows get equal
results; with nothing to learn from every document is ``und``; an empty table gives
no rows; other columns are not read.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm import crf
from eventide.llm import words as W
from eventide.llm.common import only, ship, tidy

UNDETERMINED = "und"
TRAIN_DOCS, TRAIN_CHARS, MANY, FEWEST = 250, 20_000, 64, 4
# Of a slice of texts, at up to four languages; with more it is smaller.
SLICE_BYTES = 3 << 20

_LETTER = regex.compile(r"\p{L}")


def held_out(doc_id: str = "doc_id") -> Column:
    """Every fourth document, by the checksum of its id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def sample_docs(languages: int) -> int:
    """Documents that each of so many languages is learned from, at most."""
    return max(FEWEST, min(TRAIN_DOCS, TRAIN_DOCS * MANY**2 // max(1, languages) ** 2))


def train(docs: DataFrame) -> crf.Model | None:
    """Fit a model on a sample of each language of (doc_id, text, lang); None if there is nothing to learn."""
    rows = only(docs, ["doc_id", "text", "lang"]).filter(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out() & F.col("text").rlike(r"\p{L}")
    )
    most = sample_docs(rows.select("lang").distinct().count())
    long = F.length("text") > TRAIN_CHARS
    passage = F.regexp_extract("text", rf"(?s)\p{{L}}.{{0,{TRAIN_CHARS - 1}}}", 0)
    fit = rows.select("lang", "doc_id", long.alias("long"), F.when(long, passage).otherwise(F.col("text")).alias("text"))
    order = Window.partitionBy("lang").orderBy("long", F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"))
    picked = fit.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= most)
    picked = picked.filter(~F.col("long") | (F.col("nth") <= FEWEST))
    sample = picked.select("lang", "nth", "text").orderBy("lang", "nth").collect()
    if not sample:
        return None
    labels = sorted({r.lang for r in sample})
    number = {lang: i for i, lang in enumerate(labels)}
    return crf.fit(pa.array([r.text for r in sample]), np.array([number[r.lang] for r in sample]), labels)


def _predict(model: crf.Model | None):
    slice_bytes = SLICE_BYTES * 4 // max(4, len(model.labels) if model is not None else 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            kept = [batch.column(c) for c in batch.schema.names if c != "text"]
            names = [c for c in batch.schema.names if c != "text"]
            for a, b in W.slices(texts, slice_bytes):
                part = texts.slice(a, b - a)
                known = np.array([t is not None and _LETTER.search(t) is not None for t in part.to_pylist()])
                lang = np.full(b - a, UNDETERMINED, dtype=object)
                score = np.zeros(b - a)
                if model is not None and known.any():
                    share = crf.shares(model, part)
                    best = share.argmax(axis=1)
                    lang[known] = np.array(model.labels, dtype=object)[best[known]]
                    score[known] = np.clip(share[known, best[known]], 0, 1)
                columns = [c.slice(a, b - a) for c in kept]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                    [*names, "lang_pred", "score"],
                )

    return run


def identify(docs: DataFrame, model: crf.Model | None) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document (doc_id, text)."""
    rows = only(docs, ["doc_id", "text"]).select("doc_id", held_out().alias("held_out"), "text")
    return rows.mapInArrow(tidy(_predict(model)), "doc_id long, held_out boolean, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: crf.Model | None, least: float = 0.0) -> DataFrame:
    """Documents with a language, as they are: no ``und``, and at least the share ``least`` of
    words that are spelled like the words learned from (``crf.known``)."""
    columns = docs.columns
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label = _predict(model)
        for batch in batches:
            texts = batch.column(columns.index("text"))
            results = label([pa.RecordBatch.from_arrays([texts], ["text"])])
            lang = [r.column(0).to_numpy(zero_copy_only=False) != UNDETERMINED for r in results]
            keep = np.concatenate(lang or [np.zeros(0, dtype=bool)])
            if model is not None and least > 0:
                spelled = [crf.known(model, texts.slice(a, b - a)) for a, b in W.slices(texts, SLICE_BYTES)]
                keep &= np.concatenate(spelled or [np.zeros(0)]) >= least
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(tidy(run), docs.schema)
