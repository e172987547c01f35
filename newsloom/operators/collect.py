"""Which feed entries become items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions import text, times, url
from newsloom.lineage import broadcast_if_small, stored
from newsloom.operators.components import summed_before
from newsloom.operators.upsert import one_per_key

# Default limits of one run.
MAX_ITEMS_PER_FEED = 50
LOOKBACK_DAYS = 7


def first_per_feed(
    entries: DataFrame, max_items: int = MAX_ITEMS_PER_FEED, feed: str = "source_name", order: str = "seq"
) -> DataFrame:
    """The first ``max_items`` entries of each feed, before any other filter.

    Spark cuts the ranking to ``max_items`` rows per feed before the shuffle, so
    a feed with a third of all entries never meets in one task.
    """
    rank = F.row_number().over(Window.partitionBy(feed).orderBy(order))
    return entries.withColumn("_rank", rank).filter(F.col("_rank") <= max_items).drop("_rank")


def with_required_fields(entries: DataFrame) -> DataFrame:
    """Drop entries without a title or a link."""
    return entries.filter((F.col("title") != "") & (F.col("link") != ""))


def within_lookback(entries: DataFrame, as_of: Column, days: int = LOOKBACK_DAYS) -> DataFrame:
    """Drop entries published before the lookback; its first instant stays in."""
    return entries.filter(F.col("published_at") >= times.lookback_start(as_of, days))


def items_per_feed(items: DataFrame) -> DataFrame:
    """Number of items per feed."""
    return items.groupBy("source_name").agg(F.count("*").alias("n_items"))


def publisher_name(source_title: Column, author: Column, feed_title: Column, canonical_url: Column) -> Column:
    """Displayed publisher: entry source, author, feed title, else the host."""
    candidates = [F.nullif(c, F.lit("")) for c in (source_title, author, feed_title)]
    return F.coalesce(*candidates, url.netloc(canonical_url))


def placed_in_feed(entries: DataFrame) -> DataFrame:
    """Entries with ``place``, their position in all documents of their feed.

    Documents follow each other by the column ``document``; without it a feed is
    one document. Only one short row per document is summed up, never an entry, and
    the documents of one feed are summed up in ranges.
    """
    if "document" not in entries.columns:
        return entries.withColumn("place", F.col("pos").cast("bigint"))
    sizes = entries.groupBy("feed", "document").agg((F.max("pos") + 1).alias("size"))
    starts = summed_before(sizes, ["feed"], ["document"], "size", into="start").drop("size")
    return entries.join(starts, ["feed", "document"]).withColumn("place", F.col("start") + F.col("pos"))


def unregistered_feeds(entries: DataFrame, feeds: DataFrame) -> DataFrame:
    """Feeds that have entries but are not in the registry, with their number of entries."""
    counts = entries.groupBy("feed").agg(F.count("*").alias("n_entries"))
    return counts.join(feeds.select(F.col("name").alias("feed")), "feed", "left_anti")


def collect_items(
    entries: DataFrame,
    feeds: DataFrame,
    suffixes: DataFrame,
    run_id: str,
    fetched_at: Column,
    as_of: Column,
    max_items: int | None = MAX_ITEMS_PER_FEED,
    lookback_days: int | None = LOOKBACK_DAYS,
) -> DataFrame:
    """Item rows of a run from feed entries (see ``newsloom.sources.feeds``).

    ``feeds`` is the registry: ``feed_order`` plus the columns of
    ``newsloom.schemas.FEEDS``; of a feed listed twice the first row counts, and
    entries of other feeds are left to :func:`unregistered_feeds`. The result has
    ``seq``, the order of feeds in the registry and of entries in their feed, over
    all its documents, besides the item columns. ``max_items`` is a limit per feed.
    """
    registry = feeds.select(
        F.col("name").alias("feed"), "feed_order", F.coalesce("weight", F.lit(1.0)).alias("source_weight"),
        "category", "market", F.coalesce(F.nullif("language", F.lit("")), F.lit("en")).alias("language"),
    )
    registry = one_per_key(registry, ["feed"], F.col("feed_order"))
    # sizes of documents and the items both read the parsed entries
    entries = placed_in_feed(stored(entries, "entries") if "document" in entries.columns else entries)
    if max_items is not None:
        entries = entries.filter(F.col("place") < max_items)
    dated = with_required_fields(entries).withColumn(
        "published_at", F.coalesce(times.parse_feed_date(F.col("published")), fetched_at)
    )
    if lookback_days is not None:
        dated = within_lookback(dated, as_of, lookback_days)
    has_summary = F.col("summary") != ""
    filled = dated.join(broadcast_if_small(registry), "feed").withColumns(
        {
            "canonical_url": url.normalize_url(F.col("link")),
            "has_summary": has_summary,
            "summary": F.when(has_summary, F.col("summary")).otherwise(F.col("title")),
        }
    )
    located = url.with_registered_domain(filled, "canonical_url", suffixes, "publisher_domain")
    feed_title = F.coalesce("feed_title", "feed")
    publisher = publisher_name(F.col("source_title"), F.col("author"), feed_title, F.col("canonical_url"))
    return located.select(
        (F.col("feed_order").cast("bigint") * F.lit(1 << 32) + F.col("place")).alias("seq"),
        text.url_hash(F.col("canonical_url")).alias("item_id"),
        F.lit(run_id).alias("run_id"),
        "canonical_url",
        "publisher_domain",
        "published_at",
        fetched_at.alias("fetched_at"),
        F.col("feed").alias("source_name"),
        "source_weight",
        "title",
        "summary",
        "has_summary",
        text.text_length(F.col("title"), F.col("summary")).alias("text_len"),
        text.content_hash(F.col("title"), F.col("summary")).alias("content_hash"),
        F.lit(-1).alias("topic_id"),
        F.lit("").alias("topic_signature"),
        F.struct(
            publisher.alias("publisher_name"), "category", "market", "language", F.col("link").alias("original_link")
        ).alias("json_payload"),
    )
