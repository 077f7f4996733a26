"""The registered queries against SQL, and the pipeline on a small table."""

import re

import pytest

import __spark_entry__ as registry
import corpus_pipeline
from checks.compare import connect, differences
from clickloom.llm.oracle import ORACLE_SQL

SF = "/root/testdata/sf0.001"


def test_one_query_per_operator():
    names = [n for n in registry.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in registry.queries()
    assert set(ORACLE_SQL) <= set(names)


@pytest.mark.parametrize("name", [n for n in ORACLE_SQL if n != "op9_sharding"])
def test_query_against_sql(spark, name):
    assert differences(registry.queries()[name](spark, SF), connect(SF), ORACLE_SQL[name]) == []


def test_stages_keep_the_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    n = docs.count()
    for name, stage in corpus_pipeline.STAGES[:2]:
        docs = corpus_pipeline.written(stage(spark, docs, SF), "test")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert 0 < docs.count() < n
        n = docs.count()
    for name, stage in corpus_pipeline.STAGES[2:4]:
        after = corpus_pipeline.written(stage(spark, docs, SF), "test")
        assert after.columns == docs.columns and after.count() == n
        assert after.select("doc_id", "text").exceptAll(docs.select("doc_id", "text")).count() > 0
        docs = after
    pieces = corpus_pipeline.STAGES[4][1](spark, docs, SF)
    assert pieces.select("doc_id").distinct().count() == n


def test_stages_that_change_texts_count_them_anew(docs_of, monkeypatch):
    shorter = lambda docs: docs.withColumn("text", corpus_pipeline.F.lit("é😀"))
    monkeypatch.setattr(corpus_pipeline.suffixes, "remove_repeats", shorter)
    monkeypatch.setattr(corpus_pipeline.private, "redact", shorter)
    docs = docs_of("a longer text")
    for stage in (corpus_pipeline.repeated_passages, corpus_pipeline.personal_data):
        after = stage(docs.sparkSession, docs, "")
        assert after.dtypes == docs.dtypes and after.first()["n_chars"] == 2
