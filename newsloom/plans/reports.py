"""Questions asked of stored runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.operators.scoring import by_score


def latest_runs(runs: DataFrame, n: int = 5) -> DataFrame:
    """The newest runs and how they ended."""
    return runs.orderBy(F.desc("generated_at"), F.asc("run_id")).limit(n).select("run_id", "status", "generated_at")


def items_per_run(items: DataFrame) -> DataFrame:
    """Number of items per run."""
    return items.groupBy("run_id").agg(F.count("*").alias("item_count"))


def best_topics(topics: DataFrame, n: int = 10) -> DataFrame:
    """The best-scored topics of all runs."""
    best = topics.orderBy(F.desc_nulls_last("narrative_signal_score"), F.asc("run_id"), F.asc("topic_signature")).limit(n)
    return best.select("run_id", "topic_signature", "topic_volume", "narrative_signal_score")


def bucket_summary(buckets: DataFrame) -> DataFrame:
    """Topics and buckets per run.

    Buckets are counted per topic first, so a run with many of them is not
    gathered before it has shrunk to one row per topic.
    """
    per_topic = buckets.groupBy("run_id", "topic_signature").agg(F.count("*").alias("n"))
    return per_topic.groupBy("run_id").agg(
        F.count("*").alias("topic_count"), F.sum("n").alias("bucket_count")
    )


def topic_history(topics: DataFrame, signature: str | Column) -> DataFrame:
    """One topic over all runs, by its signature."""
    return topics.filter(F.col("topic_signature") == signature)


def items_published(items: DataFrame, first: Column, end: Column) -> DataFrame:
    """Items published from ``first`` up to but not including ``end``."""
    return items.filter((F.col("published_at") >= first) & (F.col("published_at") < end))


def items_with(items: DataFrame, column: str, value: str | Column) -> DataFrame:
    """Items by ``content_hash``, ``topic_signature`` or ``canonical_url``."""
    if column not in ("content_hash", "topic_signature", "canonical_url"):
        raise ValueError(f"items are not looked up by {column!r}")
    return items.filter(F.col(column) == value)


def runs_with_status(runs: DataFrame, status: str) -> DataFrame:
    """Runs that are running, completed or failed."""
    return runs.filter(F.col("status") == status)


def buckets_between(buckets: DataFrame, first: Column, end: Column) -> DataFrame:
    """Bucket counts that start from ``first`` up to but not including ``end``."""
    return buckets.filter((F.col("bucket_start") >= first) & (F.col("bucket_start") < end))


def run_summary(topics: DataFrame, n: int = 5, n_keywords: int = 5) -> DataFrame:
    """The best topics of a run in one line each."""
    return (
        by_score(topics)
        .limit(n)
        .select(
            "topic_id",
            F.format_number("narrative_signal_score", 1).alias("score"),
            "topic_volume",
            F.array_join(F.slice("top_keywords", 1, n_keywords), ", ").alias("keywords"),
        )
    )


def run_statistics(deduped: DataFrame, clustered: DataFrame, items: DataFrame) -> DataFrame:
    """One row of run statistics from dedupe statistics, cluster statistics and final items.

    All three inputs are combined as single rows.
    """
    missing = items.agg(
        F.coalesce(F.try_divide(F.count_if(~F.col("has_summary")), F.count("*")), F.lit(0.0)).alias("missing")
    )
    return deduped.select(
        F.col("original_count").alias("fetched_count"),
        F.col("final_count").alias("deduped_count"),
        clustered.select("n_topics").scalar().alias("topic_count"),
        clustered.select("noise_ratio").scalar().alias("noise_ratio"),
        missing.scalar().alias("missing_summary_ratio"),
    )
