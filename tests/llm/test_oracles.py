"""The text queries with SQL against DuckDB, and the registry and pipeline contracts."""

import os

import pytest

import __spark_entry__ as E
import corpus_pipeline
from relaylens.llm import queries
from tools.oracle_check import compare

SF01 = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF01), reason="test data not present")


def test_queries_with_sql_match(spark):
    report = compare(spark, SF01, sorted(queries.ORACLES), verbose=False)
    assert len(report) >= 5 and not {k: v for k, v in report.items() if v.get("ok") is not True}


def test_every_operator_has_its_query():
    names = set(E.queries())
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))
    assert "pipeline" in names and set(E.oracle_sql()) <= names


def test_pipeline_stages(spark):
    """Every stage on what the one before kept: columns, whole results, clean documents stay."""
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    leaks = {r.doc_id for r in queries.op3_decontamination(spark, SF01).collect()}
    groups = queries.op8_simhash(spark, SF01).collect()
    kept = {r.component_id for r in groups} - leaks
    firsts = {r.doc_id for r in groups if r.doc_id == r.component_id}
    got = corpus_pipeline.run(spark, SF01).collect()
    assert {r.doc_id for r in got} == kept & firsts and len(got) == len(kept & firsts)
    assert all(r.round_trip for r in got)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "decontamination", "pii", "sentencepiece"]
    assert docs.count() > len(got)


def test_pipeline_edges(spark, docs, rows, no_docs):
    """Messy rows with clashing extra columns through every stage; empty tables."""
    left = docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, left, SF01)
        if name != "sentencepiece":
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        left = spark.createDataFrame(out.collect(), out.schema)
        assert stage(spark, no_docs, SF01).collect() == []
    lettered = {r[0] for r in rows if any(map(str.isalpha, r[1] or ""))}
    assert {r.doc_id for r in left.collect()} <= lettered


def test_redaction_takes_effect(spark):
    rows = [(1, "write to a.b@c.de now", "en", "s", 21), (2, None, None, "s", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.stage_pii(spark, docs, SF01).collect()}
    assert got == {1: ("write to <EMAIL> now", 20), 2: (None, None)}
