"""Table schemas: what a run reads and what it leaves behind."""

from __future__ import annotations

# Column names and types of the stored tables.
FEEDS = "name string, url string, weight double, category string, market string, language string"

PAYLOAD = (
    "struct<publisher_name: string, category: string, market: string, language: string, original_link: string>"
)

ITEMS = f"""
    item_id string, run_id string, canonical_url string, publisher_domain string, published_at timestamp,
    fetched_at timestamp, source_name string, source_weight double, title string, summary string,
    has_summary boolean, text_len int, content_hash string, topic_id int, topic_signature string,
    json_payload {PAYLOAD}
"""

BUCKETS = "array<struct<bucket_start: string, count: bigint>>"
REPRESENTATIVES = (
    "array<struct<url: string, title: string, domain: string, published_at: timestamp, summary: string>>"
)
BREAKDOWN = (
    "struct<volume_score: double, velocity_score: double, source_score: double, watchlist_bonus: double>"
)

TOPICS = f"""
    run_id string, topic_id int, topic_signature string, top_keywords array<string>, topic_volume bigint,
    unique_domains bigint, avg_source_weight double, duplicate_ratio double, counts_by_bucket {BUCKETS},
    first_seen_at timestamp, last_seen_at timestamp, representative_items {REPRESENTATIVES},
    narrative_signal_score double,
    json_payload struct<top_domains: array<string>, domain_counts: map<string, bigint>, score_breakdown: {BREAKDOWN}>
"""

TOPIC_BUCKETS = "run_id string, topic_signature string, bucket_start timestamp, count bigint"

STATS = (
    "struct<fetched_count: bigint, deduped_count: bigint, topic_count: bigint, noise_ratio: double, "
    "missing_summary_ratio: double, error: string>"
)
RUNS = f"run_id string, generated_at timestamp, lookback_days int, config_hash string, status string, stats {STATS}"

TABLES = {"runs": RUNS, "items": ITEMS, "topics": TOPICS, "topic_buckets": TOPIC_BUCKETS}

# The keys of the stored tables and what a repeated key replaces.
KEYS = {
    "runs": ("run_id",),
    "items": ("run_id", "item_id"),
    "topics": ("run_id", "topic_signature"),
    "topic_buckets": ("run_id", "topic_signature", "bucket_start"),
}
REPLACED = {
    "runs": ("status", "stats"),
    "topics": ("topic_volume", "narrative_signal_score"),
    "topic_buckets": ("count",),
}
# What look-ups ask for besides the keys.
INDEXED = {
    "runs": ("status",),
    "items": ("content_hash", "canonical_url", "topic_signature"),
    "topics": ("topic_id",),
    "topic_buckets": (),
}
RUN_STATUSES = ("running", "completed", "failed")
