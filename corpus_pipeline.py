"""From documents to token files: the corpus pipeline.

Each stage takes the documents its predecessor kept and returns those it keeps, with
the columns of ``documents``; the last one writes token files and returns a line per
document read back from them. Every stage is stored before the next begins.
"""

from pyspark.sql import DataFrame, SparkSession

from eventide.llm import decontam, jaccard, langid, mixing, queries
from eventide.llm.common import store, table

# A document is rejected when it has no letter, or fewer of its words are spelled like those of the learned languages.
LEAST_KNOWN = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages.

    Null and empty texts, and those without a letter, go; a null doc_id or lang stays; repeated rows
    stay or go together, and nothing is tied; with no labelled document, or none at all, nothing stays.
    No column beside doc_id, text and lang is read, and all are handed on.
    """
    return langid.keep_identified(docs, langid.train(docs), LEAST_KNOWN)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies.

    Documents without words all stay; of a class the smallest doc_id, null last; of rows that repeat an
    id and text one stays; an empty table stays empty. All columns are handed on, whatever their names.
    """
    return jaccard.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no passage with the benchmark.

    Null and empty texts stay; all rows of an id go together, those of a null id too; ties between
    overlaps decide nothing here; an empty table, of documents or items, takes nothing away. A column
    named ``_bad`` is one like any other.
    """
    return decontam.drop_overlapping(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them.

    Null and empty texts have size 0; a null source is a source of its own, the last; equal fractions
    are settled by the hash of the row; repeated rows are mixed one by one; an empty table stays empty.
    All columns are handed on.
    """
    return mixing.repeat(docs, mixing.mix(docs, queries.WEIGHTS, queries.MOST_COPIES))


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix: a line per document taken.

    A null or empty text is the end id alone; a null doc_id comes first; rows of one id are ordered by
    the hash of their text; an empty table writes no ids. No column beside doc_id and text is read.
    """
    return queries.token_digest(spark, docs)


STAGES = [
    ("language_id", identify_language),
    ("jaccard_dedup", remove_near_copies),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("token_files", write_tokens),
]

# The stages fit a classifier, prune by MinHash and run a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder of tables."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
