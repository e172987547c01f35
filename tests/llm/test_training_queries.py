"""Registered queries against their SQL, and the pipeline against its stages."""

from __future__ import annotations

import os
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from newsloom.llm import leaks, near
from newsloom.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    base = duckdb.connect()
    for file in os.listdir(SF_DIR):
        base.sql(f"create view {file.removesuffix('.parquet')} as select * from '{SF_DIR}/{file}'")
    sql = base.sql(ORACLES[name])
    got = QUERIES[name](spark, SF_DIR).select(*sorted(sql.columns))
    assert sorted(map(repr, sql.select(*sorted(sql.columns)).fetchall())) == sorted(repr(tuple(r)) for r in got.collect())


def test_every_operator_has_a_query():
    assert sorted(int(x[2:].split("_")[0]) for x in QUERIES) == list(range(1, 14))


def test_pipeline_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR)
        assert out.columns == docs.columns, name
        before, after = (Counter(tuple(r) for r in x.collect()) for x in (docs, out))
        assert after <= before, name
        docs = out.cache()
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0.5 * sizes[0]
    bench = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    assert leaks.benchmark_hits(docs, bench).isEmpty()
    assert near.near_duplicates(docs, near.Sketching(shingle=5)).filter("doc_id <> component_id").isEmpty()
    ids = sorted(r.doc_id for r in corpus_pipeline.run(spark, SF_DIR).select("doc_id").collect())
    assert ids == sorted(r.doc_id for r in docs.select(F.col("doc_id")).collect())


def test_pipeline_rules_are_fitted_on_documents_dropped_before(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    bad = spark.read.parquet(f"{SF_DIR}/labels.parquet").filter("quality = 0").select("doc_id")
    left = docs.join(bad, "doc_id", "left_anti").select(docs.columns)
    judged = QUERIES["op3_quality_rules"](spark, SF_DIR).join(left.select("doc_id"), "doc_id").collect()
    assert any(not r.kept and not r.base_failed for r in judged)
    got = corpus_pipeline.quality_rules(spark, left, SF_DIR)
    assert sorted(r.doc_id for r in got.collect()) == sorted(r.doc_id for r in judged if r.kept)


def test_stages_take_odd_rows_and_empty_tables(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    some = [tuple(r) for r in docs.limit(30).collect()]
    odd = [(None, None, None, None, None), (None, "", "en", "src1", 0), (900_001, None, "en", "src1", 0), (900_002, "", None, None, 0), (900_003, " \n", "en", "src1", 2)]
    odd += [(900_004, "two texts under one id " * 9, "en", "src1", 9), (900_004, "another text under it " * 9, "en", "src2", 9)]
    odd += [some[0], some[0], (900_005, "very long " * 30_000, "en", "src1", 300_000)]
    frame = spark.createDataFrame(some + odd, docs.schema).repartition(3)
    for name in ("label", "rep", "key", "score", "kept", "item_id", "mark", "part"):
        frame = frame.withColumn(name, F.lit("other"))
    given = Counter(tuple(r) for r in frame.collect())
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, frame, SF_DIR)
        assert out.columns == frame.columns, name
        assert Counter(tuple(r) for r in out.collect()) <= given, name
        assert stage(spark, frame.limit(0), SF_DIR).collect() == [], name
    encoded = corpus_pipeline.encoding(spark, frame, SF_DIR)
    assert encoded.count() == frame.count() and corpus_pipeline.encoding(spark, frame.limit(0), SF_DIR).collect() == []
    assert all(r.round_trip for r in encoded.collect())


def test_held_out_is_never_null(spark):
    from newsloom.llm import classifier

    got = QUERIES["op9_quality_classifier"](spark, SF_DIR)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"] and got.filter("held_out is null").isEmpty()
    assert got.filter("held_out").count() == got.filter(classifier.fold(F.col("doc_id")) == 0).count()
