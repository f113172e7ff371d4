import zlib

import numpy as np
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from eventide.llm import decontam, jaccard, queries
from eventide.llm.common import store
from tests.llm.conftest import DOCUMENT, SF, rows

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_every_operator_is_registered():
    names = contract.queries()
    for number in range(1, 11):
        assert len([n for n in names if n.startswith(f"op{number}_")]) == 1
    assert "pipeline" in names and "op1_topk_search" in contract.oracle_sql()


def test_stages_take_effect(spark, documents):
    docs, counts = documents, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = store(stage(spark, docs, SF), name)
        assert kept.columns == COLUMNS
        counts[name] = (docs.count(), kept.count())
        if name == "jaccard_dedup":
            assert {r.n_links for r in jaccard.join(kept).collect()} == {0}
            classes = {r.class_id for r in jaccard.join(docs).collect()}
            assert {r.doc_id for r in kept.collect()} == classes
        if name == "decontamination":
            benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
            bad = {r.doc_id for r in decontam.overlaps(docs, benchmark).collect()}
            assert {r.doc_id for r in docs.collect()} - {r.doc_id for r in kept.collect()} == bad
        docs = kept
    assert counts["language_id"][0] == counts["language_id"][1]
    assert counts["jaccard_dedup"][1] < counts["jaccard_dedup"][0]
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert len(last) == docs.count()
    assert sorted(r.start for r in last) == np.concatenate([[0], np.cumsum([r.n_tokens for r in sorted(last, key=lambda r: r.start)])])[:-1].tolist()
    assert sorted(rows(corpus_pipeline.run(spark, SF))) == sorted(tuple(r) for r in last)


def test_odd_documents_pass_all_stages(spark, odd):
    docs = odd
    for name, stage in corpus_pipeline.STAGES:
        docs = store(stage(spark, docs, SF), name)
    assert all(zlib.crc32(b"") <= r.ids_crc32 < 2**32 for r in docs.collect())
    empty = spark.createDataFrame([], DOCUMENT)
    for name, stage in corpus_pipeline.STAGES:
        empty = store(stage(spark, empty, SF), name)
    assert empty.collect() == []


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql_twin(spark, name):
    import duckdb

    sf_dir = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    expected = con.execute(contract.oracle_sql()[name])
    names = [d[0] for d in expected.description]
    result = contract.queries()[name](spark, sf_dir)
    assert sorted(result.columns) == sorted(names)
    assert rows(result, *names) == sorted(expected.fetchall(), key=repr)
