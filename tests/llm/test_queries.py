"""The registered queries: SQL twins, the pipeline's stages, and one query per operator."""

import os

import pytest

import corpus_pipeline
from catalog.compare import check, connect
from turnstile.llm import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, duck, name):
    assert check(spark, duck, name, queries.QUERIES[name], queries.ORACLES[name], SF) == ""


def test_every_operator_has_one_query():
    assert "pipeline" in queries.QUERIES
    numbers = [n.split("_")[0] for n in queries.QUERIES if n.startswith("op")]
    assert sorted(numbers) == sorted(f"op{k}" for k in range(1, 14))


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, rows = docs.columns, docs.count()
    from turnstile.session import stage
    for number, (name, step) in enumerate(corpus_pipeline.STAGES, 1):
        docs = stage(step(spark, docs, SF), "pipeline-test")
        if number < len(corpus_pipeline.STAGES):
            assert docs.columns == columns, name
            assert 0 < docs.count() <= rows
            rows = docs.count()
    assert docs.groupBy("doc_id").count().count() == rows


def test_pipeline_on_no_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, SF)
        assert docs.collect() == []
