"""One run: entries to items, topics, scores and stored tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions import text
from newsloom.lineage import broadcast_if_small, stored
from newsloom.operators.components import numbered
from newsloom.operators import cluster, collect, dedupe, keywords, scoring, topics
from newsloom.plans import reports
from newsloom.schemas import STATS
from newsloom.shipping import add_package
from newsloom.sources.store import RunStore, export_run


@dataclass(frozen=True)
class RunSettings:
    """What shapes a run, with the documented default of each option."""

    lookback_days: int = collect.LOOKBACK_DAYS
    max_items_per_feed: int = collect.MAX_ITEMS_PER_FEED
    top_k_topics: int = 10
    min_items_to_cluster: int = cluster.MIN_ITEMS_TO_CLUSTER
    dedupe_strategy: str = "url_then_hash"
    noise_handling: str = "drop"
    bucket_interval: str = "daily"
    watchlist_keywords: Sequence[str] = ()
    watchlist_tickers: Sequence[str] = ()
    watchlist: DataFrame | None = None
    clustering: cluster.ClusterSettings = field(default_factory=cluster.ClusterSettings)

    def hashed(self, feeds: Sequence[Mapping[str, Any]] = ()) -> Column:
        """Hash of the settings that shape results."""
        return text.config_hash(
            {
                "lookback_days": self.lookback_days,
                "bertopic": asdict(self.clustering),
                "rss_feeds": [dict(feed) for feed in feeds],
                "dedupe_strategy": self.dedupe_strategy,
            }
        )


@dataclass(frozen=True)
class RunResult:
    """Stored results of a run; all fields are DataFrames."""

    items: DataFrame
    topics: DataFrame
    top_topics: DataFrame
    stats: DataFrame


# What an item has besides short columns; it stays behind while items are clustered.
TEXTS = ("title", "summary", "json_payload")
TOPIC_PAYLOAD = ("top_domains", "domain_counts", "score_breakdown")


def mine_topics(
    items: DataFrame, as_of: Column, settings: RunSettings | None = None, vectors: DataFrame | None = None
) -> RunResult:
    """Everything between collected items, which should be stored, and the tables.

    Intermediate tables that several later steps read are written once to the
    shared folder; between them the plan stays lazy. The survivors are written with
    their texts; what clustering adds is a narrow table, which meets the texts for
    the keywords and in the result.
    """
    settings = settings or RunSettings()
    add_package(items.sparkSession)
    survivors = stored(dedupe.survivors(items, settings.dedupe_strategy), "survivors")
    kept = stored(items.join(survivors.select("seq", "pos"), "seq"), "kept")
    clustered, cluster_stats = cluster.cluster_items(
        kept, settings.clustering, settings.min_items_to_cluster, settings.noise_handling, vectors
    )
    counts = None
    if settings.clustering.nr_topics:
        counts = stored(keywords.term_counts(clustered), "term_counts")
        volumes = topics.without_noise(clustered).groupBy("topic_id").agg(F.count("*").alias("volume"))
        merge = keywords.merge_topics if settings.clustering.merging == "repeated" else keywords.reduce_topics
        merged = merge(counts, settings.clustering.nr_topics, volumes)
        moves = stored(renumbered(clustered, merged), "renumbered")
        counts = stored(keywords.moved_counts(counts, moves), "term_counts")
        clustered = (
            clustered.join(broadcast_if_small(moves), "topic_id", "left")
            .withColumn("topic_id", F.coalesce("new_id", "topic_id"))
            .drop("new_id")
        )
        # noise and item counts stay, the topics are fewer
        n_topics = topics.without_noise(clustered).agg(F.count_distinct("topic_id")).scalar()
        cluster_stats = cluster_stats.withColumn("n_topics", n_topics)
    columns = clustered.columns
    clustered = stored(clustered.drop(*TEXTS), "clustered")
    texts = kept.select("seq", *[c for c in TEXTS if c in columns])
    if counts is None:
        labelled = clustered.select("seq", *topics.TOPIC).join(texts, "seq")
        counts = stored(keywords.term_counts(labelled), "term_counts")
    words = keywords.listed_keywords(counts, settings.clustering.top_n_words)
    records = topics.topic_records(clustered, words, settings.bucket_interval, texts)
    scored = scoring.score_topics(
        records, as_of, settings.watchlist_keywords, settings.watchlist_tickers, settings.watchlist
    )
    scored = stored(scored, "topics").withColumn("json_payload", F.struct(*TOPIC_PAYLOAD)).drop(*TOPIC_PAYLOAD)
    return RunResult(
        items=topics.attach_signatures(clustered.join(texts, "seq").select(*columns), scored),
        topics=scored,
        top_topics=scoring.top_topics(scored, settings.top_k_topics),
        stats=reports.run_statistics(dedupe.dedupe_stats(survivors), cluster_stats, clustered),
    )


def renumbered(items: DataFrame, merged: DataFrame) -> DataFrame:
    """``topic_id, new_id`` of merged topics, numbered from the largest on."""
    narrow = topics.without_noise(items).select("topic_id", "pos").join(merged, "topic_id")
    sizes = narrow.groupBy("merged_id").agg(F.count("*").alias("n"), F.min("pos").alias("first_pos"))
    numbers = numbered(sizes, F.desc("n"), F.asc("first_pos"), into="new_id")
    return merged.join(numbers.select("merged_id", F.col("new_id").cast("int").alias("new_id")), "merged_id").select("topic_id", "new_id")


def run_row(
    spark: SparkSession,
    run_id: str,
    as_of: Column,
    settings: RunSettings,
    status: str,
    stats: DataFrame | None = None,
    error: str | None = None,
    feeds: Sequence[Mapping[str, Any]] = (),
) -> DataFrame:
    """The one row that describes a run."""
    base = stats if stats is not None else spark.range(1)
    names = ("fetched_count", "deduped_count", "topic_count", "noise_ratio", "missing_summary_ratio")
    values = [F.col(n) if stats is not None else F.lit(None).alias(n) for n in names]
    return base.select(
        F.lit(run_id).alias("run_id"),
        as_of.alias("generated_at"),
        F.lit(settings.lookback_days).alias("lookback_days"),
        settings.hashed(feeds).alias("config_hash"),
        F.lit(status).alias("status"),
        F.struct(*values, F.lit(error).alias("error")).cast(STATS).alias("stats"),
    )


def run(
    items: DataFrame,
    run_id: str,
    as_of: Column,
    store: RunStore | None = None,
    export_to: str | None = None,
    settings: RunSettings | None = None,
    feeds: Sequence[Mapping[str, Any]] = (),
    vectors: DataFrame | None = None,
) -> RunResult | None:
    """Mine the collected items, export and store the result.

    All surviving items but only the top topics are kept. Without items nothing
    is written and ``None`` returned. When a step fails, the run is stored as
    ``failed`` with the error, and the error is raised again.
    """
    settings = settings or RunSettings()
    spark = items.sparkSession
    try:
        items = stored(items.withColumn("run_id", F.lit(run_id)), "collected")
        if items.isEmpty():
            return None
        result = mine_topics(items, as_of, settings, vectors)
        final_items, top = stored(result.items, "final_items"), stored(result.top_topics, "top_topics")
        result = RunResult(final_items, result.topics, top, stored(result.stats, "stats"))
        if export_to:
            export_run(final_items.drop("seq", "pos"), top.drop("first_pos"), export_to, settings.top_k_topics)
        if store:
            store.save_run(run_row(spark, run_id, as_of, settings, "completed", result.stats, feeds=feeds))
            store.save_items(final_items)
            store.save_topics(top)
        return result
    except Exception as error:
        if store:
            store.save_run(run_row(spark, run_id, as_of, settings, "failed", error=str(error), feeds=feeds))
        raise
