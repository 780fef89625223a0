import os

import pytest
from cases import edge_docs

import __spark_entry__ as entry_points
import corpus_pipeline
from lapwise.llm import jaccard_join, quality_rules, suffix_dedup

FOLDER = "/root/testdata/sf0.001"


def test_stages_hand_on_the_columns_of_documents(spark):
    docs = edge_docs(spark)
    first = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == first.columns and docs.dtypes == first.dtypes
    assert docs.count() > 0


def test_every_stage_takes_an_empty_table(spark):
    docs = edge_docs(spark).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, FOLDER).count() == 0


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
def test_decisions_take_effect(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    good = corpus_pipeline.quality(spark, docs, FOLDER)
    verdict = {r.doc_id for r in quality_rules.score(docs).where("kept").collect()}
    assert {r.doc_id for r in good.collect()} == verdict
    single = corpus_pipeline.near_copies(spark, good, FOLDER)
    groups = jaccard_join.join(good).collect()
    assert sorted(r.doc_id for r in single.collect()) == sorted({r.component_id for r in groups})
    cut = corpus_pipeline.repeats(spark, single, FOLDER)
    removed = suffix_dedup.dedup(single)
    assert cut.count() == single.count()
    sizes = {r.doc_id: r.n_bytes - r.n_removed for r in removed.collect()}
    assert all(len(r.text.encode()) <= sizes[r.doc_id] for r in cut.collect())


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
def test_run_is_the_stages_in_order(spark):
    result = corpus_pipeline.run(spark, FOLDER)
    assert result.count() > 0 and result.where("not restored").count() == 0


def test_entry_points_name_eleven_queries():
    names = set(entry_points.queries())
    assert "pipeline" in names
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert set(entry_points.oracle_sql()) <= names
