"""The corpus pipeline and the registered queries."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from lakeweave.catalog.registry import Query
from lakeweave.llm import queries

from ..oracle import connect, differences
from .tables import ROOT, awkward


def test_queries_are_registered():
    names = entry.queries()
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES} == set(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(names)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_runs_and_equals_its_sql(spark, name):
    problem, count, _ = differences(spark, connect(ROOT), ROOT, Query(queries.QUERIES[name], queries.SQL.get(name)))
    assert problem is None and count > 0


def test_stages_keep_columns_and_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    columns, before = docs.dtypes, docs.count()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, docs, ROOT).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        assert docs.dtypes == columns, name
        assert docs.count() <= before
        before = docs.count()
    assert 0 < before < spark.read.parquet(f"{ROOT}/documents.parquet").count()
    mixed = corpus_pipeline.run(spark, ROOT).collect()
    words = sum(len(r.text.split()) for r in docs.collect())
    assert sum(len(r.text.split()) for r in mixed) == pytest.approx(1.5 * words, rel=0.05)
    assert {r.doc_id for r in mixed} <= {r.doc_id for r in docs.collect()}


def test_stages_of_awkward_rows(spark, tmp_path):
    docs = awkward(spark).select("doc_id", "text", "lang", "source", "n_chars")
    for rows in (docs, docs.where("false")):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, rows, ROOT)
            assert set(rows.columns) <= set(out.columns), name
            out.collect()


def test_near_duplicates_take_what_passages_leave(spark):
    """A copy with scattered edits goes whole; without the stage the edited words would stay behind as a document of scraps."""
    words = [f"word{i}" for i in range(200)]
    edited = [f"other{i}" if i in (60, 140) else word for i, word in enumerate(words)]
    rows = [(1, " ".join(words), "en", "a", 1), (2, " ".join(edited), "en", "a", 1), (3, " ".join(f"far{i}" for i in range(50)), "en", "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.near_duplicate_stage(spark, docs, ROOT)
    assert {r.doc_id for r in corpus_pipeline.passage_stage(spark, kept, ROOT).collect()} == {1, 3}
    assert {r.doc_id for r in corpus_pipeline.passage_stage(spark, docs, ROOT).collect()} == {1, 2, 3}
