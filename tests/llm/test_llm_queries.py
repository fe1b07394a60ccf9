from __future__ import annotations

import pytest

import corpus_pipeline
from compare import assert_same, duck
from roadpulse.llm import queries, sql

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(sql.all_sql()))
def test_query_equals_its_sql(spark, name):
    found = queries.all_queries()[name](spark, SMALL)
    assert assert_same(found, duck(SMALL), sql.all_sql()[name]) > 0


def test_pipeline(spark):
    """Stage by stage on whole documents: what goes, what stays, and in which columns."""
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    docs, sizes = documents, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL).cache()
        assert docs.columns == documents.columns, name
        sizes.append(docs.count())
    assert documents.count() >= sizes[0] > sizes[1] >= sizes[2]
    encoded = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert encoded.count() == sizes[-1]
    assert corpus_pipeline.run(spark, SMALL).count() == sizes[-1]
