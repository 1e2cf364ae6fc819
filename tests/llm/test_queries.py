"""The registered queries and the pipeline on the smallest tables."""

import pytest

import corpus_pipeline
from checks.compare import frame_difference, sql_engine
from tests.llm.conftest import SF_DIR
from tripmetrics.llm.oracle import ORACLE
from tripmetrics.llm.queries import QUERIES
from tripmetrics.sources import store


@pytest.fixture(scope="module")
def engine():
    return sql_engine(SF_DIR)


def test_one_query_an_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_sql(spark, engine, name):
    assert frame_difference(QUERIES[name](spark, SF_DIR), engine, ORACLE[name]) is None


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = store(stage(spark, docs, SF_DIR), name)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
            counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > 100
    assert docs.select("doc_id").distinct().count() == counts[-1]


def test_stages_on_odd_documents(spark, odd_docs):
    docs = odd_docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = store(stage(spark, docs, SF_DIR), name)
        assert docs.columns == odd_docs.columns
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert last.select("doc_id").distinct().count() <= docs.count()


def test_stages_on_no_documents(spark, no_docs):
    docs = no_docs
    for name, stage in corpus_pipeline.STAGES:
        docs = store(stage(spark, docs, SF_DIR), name)
    assert docs.count() == 0
