"""The pipeline on a small fixture, stage by stage against brute force."""

from __future__ import annotations

import pytest

import corpus_pipeline
from attesta.llm import decontaminate, jaccard_join, sentencepieces


@pytest.fixture
def folder(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    bench = [(r.item_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    extra = [(9000, None), (9001, "123 456"), (9002, ""), (9003, bench[0][1]), (9004, docs.first().text), (9005, docs.first().text)]
    rows = spark.createDataFrame([(i, t, None, None, 0) for i, t in extra], docs.schema)
    docs.unionByName(rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path), bench


def test_pipeline(spark, folder):
    d, bench = folder
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    kept = {i: t for i, t in rows.items() if t and any(map(str.isalpha, t))}
    last = {}
    for i, t in kept.items():
        last[t] = max(i, last.get(t, i))
    kept = {i: t for t, i in last.items()}
    groups = jaccard_join.brute_force(list(kept.items()))
    kept = {i: t for i, t in kept.items() if groups[i][0] == i}
    dirty = decontaminate.brute_force(list(kept.items()), bench)
    kept = {i: t for i, t in kept.items() if not dirty[i][4]}
    got = {r.doc_id: r.n_tokens for r in corpus_pipeline.run(spark, d).collect()}
    c = sentencepieces.codec(sentencepieces.default_model())
    assert got == {i: len(c.library.encode(t)) + 1 for i, t in kept.items()}
    assert 9000 not in got and 9001 not in got and 9003 not in got


def test_stages_hand_over_the_columns(spark, folder):
    d, _ = folder
    docs = spark.read.parquet(f"{d}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, d).schema.simpleString() == docs.schema.simpleString(), name


def test_stages_take_odd_inputs(spark, folder):
    """Nulls in every column, empty and long texts, repeated rows, extra columns with names that operators use, an empty table."""
    d, bench = folder
    docs = spark.read.parquet(f"{d}/documents.parquet")
    long = " ".join(r.text for r in docs.where("text is not null").limit(40).collect())
    rows = [(None, None, None, None, None), (1, "", "en", None, 0), (2, long, None, "s", None), (2, long, None, "s", None), (None, "some words of a text", "en", "s", 5), (3, "qzx wvk jjq xkz vvw qqx", "en", "s", 9), (4, "a", "en", "s", 1), (5, bench[0][1], "en", "s", 1)]
    odd = spark.createDataFrame(rows, docs.schema)
    clash = {c: "clash" for c in ("id", "key", "doc", "name", "sig", "tk", "node", "spans", "_id", "_key", "_tk", "_sha", "n", "h")}
    wide = odd.selectExpr("*", *(f"'{v}' as {c}" for c, v in clash.items()))
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd.limit(0), d).count() == 0, name
        got = stage(spark, wide, d)
        got.count()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert got.columns == wide.columns, name
            assert stage(spark, wide.where("text = 'some words of a text'"), d).count() == 1, name


def test_language_stage_uses_its_prediction(spark, folder):
    d, _ = folder
    docs = spark.read.parquet(f"{d}/documents.parquet")
    junk = spark.createDataFrame([(9100, "qzxwvkjjqxkzvvwqqxzzkwxqvjz", "en", "s", 0), (9101, docs.where("lang = 'de'").first().text, None, "s", 0)], docs.schema)
    kept = {r.doc_id for r in corpus_pipeline.known_language(spark, docs.unionByName(junk), d).collect()}
    assert 9100 not in kept and 9101 in kept
    clean = {r.doc_id for r in docs.where("lang is not null and length(text) > 40").collect()}
    assert len(clean - kept) == 0
