"""Item rows whose texts are fetched after the deduplication."""

from __future__ import annotations

from datetime import datetime

import pytest

from newsloom.operators import dedupe
from workload import items as built
from workload.queries import QUERIES, whole_items


@pytest.fixture
def tables(spark, tmp_path):
    """Documents with repeated and missing ids and missing texts, also equal rows."""
    texts = [None, "", "one line", " a title \n\n and  a\ttext ", "A TITLE\nand a text", "t\n", "\nonly a rest"]
    documents = [(i, texts[i % 7], "en", f"src{i % 3}", 1) for i in range(40)]
    documents += [(5, "another text\nof the same id", "en", "src1", 1), documents[8], documents[8], (None, "no id", "en", "src0", 1)]
    pages = [(i, f"https://Host{i % 4}.com/p/{i // 2}?b=1&utm_source=x", "") for i in range(10)]
    events = [(i, datetime(2024, 1, 1 + i % 28, i % 24), 1, "x", 0.5, "") for i in range(100)]
    vectors = [(i, [0.5], i % 4) for i in range(12)]
    for name, rows in (("documents", documents), ("pages", pages), ("events", events), ("embeddings", vectors)):
        spark.createDataFrame(rows, built.SCHEMAS[name]).repartition(3).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_texts_fetched_later_are_those_of_the_item(spark, tables):
    whole = dedupe.deduplicate(built.items(spark, tables))
    apart = whole_items(spark, tables)
    assert apart.columns == whole.columns and apart.dtypes == whole.dtypes
    rows = sorted(map(repr, whole.collect()))
    assert sorted(map(repr, apart.collect())) == rows and len(rows) > len(set(rows)) > 5
    every = built.with_texts(spark, tables, built.items_apart(spark, tables)).select(*built.items(spark, tables).columns)
    assert sorted(map(repr, every.collect())) == sorted(map(repr, built.items(spark, tables).collect()))


def test_kept_texts_are_hashed_once(spark, tables):
    """The stored rows bring the hashes: what is left to run neither hashes nor matches white space."""
    plan = QUERIES["deduplicated_items"](spark, tables)._jdf.queryExecution().optimizedPlan().toString()
    assert "sha2" not in plan and "content_hash" in plan
