"""Per-topic aggregation: one record per (run, topic)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions import text, times
from newsloom.lineage import broadcast_if_small, stored

# List lengths in a topic record and the label of noise.
NOISE = -1
TOP_DOMAINS = 5
COUNTED_DOMAINS = 10
REPRESENTATIVES = 5
REPRESENTATIVE_SUMMARY = 200
OUTPUT_KEYWORDS = 15

TOPIC = ("run_id", "topic_id")


def without_noise(items: DataFrame) -> DataFrame:
    """Drop the items that belong to no topic."""
    return items.filter(F.col("topic_id") != NOISE)


def check_noise_handling(noise_handling: str) -> None:
    if noise_handling not in ("drop", "keep"):
        raise ValueError(f"unknown noise handling {noise_handling!r}, expected 'drop' or 'keep'")


def handle_noise(items: DataFrame, noise_handling: str) -> DataFrame:
    """``drop`` or ``keep`` the items that belong to no topic."""
    check_noise_handling(noise_handling)
    return without_noise(items) if noise_handling == "drop" else items


def domain_rollup(items: DataFrame) -> DataFrame:
    """Counts and extremes per (run, topic, publisher domain)."""
    return (
        without_noise(items)
        .groupBy(*TOPIC, "publisher_domain")
        .agg(
            F.count("*").alias("n"),
            F.min("pos").alias("first_pos"),
            F.sum("source_weight").alias("weight"),
            F.min("published_at").alias("first_seen_at"),
            F.max("published_at").alias("last_seen_at"),
        )
    )


def topic_stats(items: DataFrame) -> DataFrame:
    """Volume, domains, average weight, duplicate ratio and time span per topic.

    Everything but the distinct contents comes from the domain rollup; those are
    a distinct count of their own, which Spark first groups by (topic, hash), so
    a topic with a third of the items is spread over all tasks.
    """
    totals = (
        domain_rollup(items)
        .groupBy(*TOPIC)
        .agg(
            F.sum("n").alias("topic_volume"),
            F.count("*").alias("unique_domains"),
            (F.sum("weight") / F.sum("n")).alias("avg_source_weight"),
            F.min("first_seen_at").alias("first_seen_at"),
            F.max("last_seen_at").alias("last_seen_at"),
            F.min("first_pos").alias("first_pos"),
        )
    )
    contents = without_noise(items).groupBy(*TOPIC).agg(F.count_distinct("content_hash").alias("n_contents"))
    ratio = 1 - F.col("n_contents") / F.col("topic_volume")
    return totals.join(contents, [*TOPIC]).withColumn("duplicate_ratio", ratio).drop("n_contents")


def bucket_counts(items: DataFrame, interval: str = "daily") -> DataFrame:
    """Items per (run, topic, UTC bucket); empty buckets are not listed."""
    return (
        without_noise(items)
        .groupBy(*TOPIC, times.bucket(F.col("published_at"), interval).alias("bucket_start"))
        .agg(F.count("*").alias("count"))
    )


def ranked_domains(items: DataFrame, n: int = COUNTED_DOMAINS) -> DataFrame:
    """The ``n`` most frequent domains per topic; ties go to the one seen first."""
    order = Window.partitionBy(*TOPIC).orderBy(F.desc("n"), F.asc("first_pos"))
    rollup = domain_rollup(items).select(*TOPIC, "publisher_domain", "n", "first_pos")
    return rollup.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n).drop("first_pos")


def representatives(items: DataFrame, n: int = REPRESENTATIVES, texts: DataFrame | None = None) -> DataFrame:
    """The ``n`` best items per topic: heaviest feed, then newest, then first.

    Spark cuts the ranking to ``n`` rows per topic before the shuffle, so a large
    topic never meets in one task. Items without title and summary find them in
    ``texts`` by ``seq``, once they are ranked: a few rows per topic go to the
    texts, and texts move only where the topics are too many for a broadcast.
    """
    order = Window.partitionBy(*TOPIC).orderBy(F.desc("source_weight"), F.desc("published_at"), F.asc("pos"))
    summary = F.substring("summary", 1, REPRESENTATIVE_SUMMARY).alias("summary")
    shown = ["title", summary] if texts is None else ["seq"]
    ranked = (
        without_noise(items)
        .select(
            *TOPIC, "pos", "source_weight", F.col("canonical_url").alias("url"),
            F.col("publisher_domain").alias("domain"), "published_at", *shown,
        )
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= n)
    )
    if texts is not None:
        chosen = broadcast_if_small(stored(ranked, "representatives"))
        ranked = texts.select("seq", "title", summary).join(chosen, "seq")
    return ranked.select(*TOPIC, "url", "title", "domain", "published_at", "summary", "rank")


def _ranked_list(*fields: str) -> F.Column:
    """The few ranked rows of a group as an array of structs, best first."""
    listed = F.array_sort(F.collect_list(F.struct("rank", *fields)))
    return F.transform(listed, lambda row: F.struct(*[row[field].alias(field) for field in fields]))


def topic_records(
    items: DataFrame, keywords: DataFrame, interval: str = "daily", texts: DataFrame | None = None
) -> DataFrame:
    """One full record per topic.

    ``items`` needs the item columns plus ``topic_id`` and ``pos``; ``keywords``
    has ``run_id, topic_id, keywords``. The parts are all grouped by (run, topic), so
    they are joined where they already lie. Pass ``items`` that are stored (see
    ``newsloom.lineage``): each part reads only its own columns of them. Their titles
    and summaries may stay in ``texts``, a table with the same ``seq``.
    """
    domains = (
        ranked_domains(items)
        .groupBy(*TOPIC)
        .agg(_ranked_list("publisher_domain", "n").alias("ranked"))
        .select(
            *TOPIC,
            F.slice(F.transform("ranked", lambda d: d["publisher_domain"]), 1, TOP_DOMAINS).alias("top_domains"),
            F.map_from_entries("ranked").alias("domain_counts"),
        )
    )
    buckets = (
        bucket_counts(items, interval)
        .groupBy(*TOPIC)
        .agg(F.array_sort(F.collect_list(F.struct("bucket_start", "count"))).alias("counts_by_bucket"))
    )
    chosen = (
        representatives(items, texts=texts)
        .groupBy(*TOPIC)
        .agg(_ranked_list("url", "title", "domain", "published_at", "summary").alias("representative_items"))
    )
    words = keywords.select(*TOPIC, "keywords")
    joined = topic_stats(items).join(domains, [*TOPIC]).join(buckets, [*TOPIC]).join(chosen, [*TOPIC])
    found = F.coalesce("keywords", F.array().cast("array<string>"))
    return (
        joined.join(words, [*TOPIC], "left")
        .withColumn("keywords", found)
        .select(
            *TOPIC,
            text.topic_signature(F.col("keywords"), F.col("top_domains")).alias("topic_signature"),
            F.slice("keywords", 1, OUTPUT_KEYWORDS).alias("top_keywords"),
            "topic_volume", "unique_domains", "avg_source_weight", "duplicate_ratio", "counts_by_bucket",
            "first_seen_at", "last_seen_at", "representative_items", "top_domains", "domain_counts", "first_pos",
        )
    )


def attach_signatures(items: DataFrame, topics: DataFrame) -> DataFrame:
    """Write each topic's signature onto its items; noise keeps ''."""
    found = topics.select(*TOPIC, F.col("topic_signature").alias("_signature"))
    return (
        items.drop("topic_signature")
        .join(found, [*TOPIC], "left")
        .withColumn("topic_signature", F.coalesce("_signature", F.lit("")))
        .drop("_signature")
    )
