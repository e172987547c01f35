"""From raw documents to token ids: filters, deduplication, decontamination, encoding.

Every stage reads all that the stage before it kept. Stages are written as Parquet
in the cluster's shared folder and read again, so a lost executor costs a task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.lineage import stored
from newsloom.llm import classifier, leaks, near, pieces, rules
from newsloom.llm.queries import PIECES, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the classifier predicts bad."""
    statistics = classifier.stored_statistics(docs)
    usable = classifier.fold(F.col("doc_id")) != 0
    model = classifier.fit_classifier(statistics, table(spark, sf_dir, "labels"), usable)
    return classifier.good_documents(docs, model)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that fail the fixed limits or the learned verdict.

    The verdict is fitted on all documents: the stage before has taken the bad ones from ``docs``.
    """
    model = rules.fit_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return rules.kept_documents(docs, model)


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates (five-word shingles, similarity 0.8)."""
    return near.first_of_each(docs, near.Sketching(shingle=5))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark item."""
    return leaks.without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode what is left; ``n_lossy`` counts chunks that do not decode to themselves."""
    return pieces.encode_pieces(docs, PIECES)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("near_deduplication", near_deduplication),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

# Trained models, sketches and tokenizers have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
