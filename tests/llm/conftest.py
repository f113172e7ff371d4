"""Fixtures of the corpus operators: odd documents, and brute-force helpers."""

import re

import pytest

SF = "/root/testdata/sf0.001"
DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside, as columns of the input.
CLASHES = [
    "row", "t1", "t2", "k1", "k2", "d", "n", "nth", "doc", "size", "copies", "p", "h", "bucket", "rep", "root",
    "cell", "family", "start", "part", "pos", "place", "words", "score", "held_out", "tokens", "spans", "chunk", "q",
]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.fixture(scope="session")
def tables():
    return SF


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows."""
    long_text = " ".join(f"w{k % 977}x{k % 31}" for k in range(40_000))
    rows = [
        (1, None, "en", "a", 0),
        (2, "", "en", None, 0),
        (3, " \t\n ", None, "b", 3),
        (4, "one", "en", "b", 3),
        (5, long_text, "en", "b", len(long_text)),
        (6, long_text, None, None, None),
        (7, "the same words stand here twice and more", "en", "a", 40),
        (7, "the same words stand here twice and more", "en", "a", 40),
        (None, "a row without an id of its own", "de", "a", 30),
        (None, None, None, None, None),
        (8, "1234 5678 !!! ---", "en", "c", 17),
        (9, "é è 日本語 \U0001f600 " * 9, "fr", "c", 90),
    ]
    return spark.createDataFrame(rows, DOCUMENT)


@pytest.fixture(scope="session")
def clashing(odd):
    """The odd documents with columns named like those that operators use inside."""
    from pyspark.sql import functions as F

    return odd.select("*", *[F.lit("x").alias(c) for c in CLASHES])


def rows(df, *columns):
    """Rows in an order that nulls do not disturb."""
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)
