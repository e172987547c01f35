"""Every operator as a query over the given tables: ``name -> (spark, sf_dir) -> DataFrame``.

Timestamps are returned as text and doubles rounded, so that two engines can be
compared value by value.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions import text, times, url
from newsloom.lineage import checkpoint_dir, stored
from newsloom.operators import cluster, collect, dedupe, density, hierarchy, keywords, neighbours, scoring, topics, upsert, watchlist, word_vectors
from newsloom.operators.vectors import fuzzy_edges, graph_layout
from newsloom.plans import reports
from newsloom.plans.run import TOPIC_PAYLOAD, RunResult, RunSettings, mine_topics
from newsloom.schemas import KEYS, REPLACED, TOPICS
from newsloom.shipping import add_package
from newsloom.sources import feeds
from newsloom.sources.keyed import KeyedTable
from newsloom.sources.store import RunStore, export_run, export_runs, flat_columns
from newsloom.sources.suffixes import suffix_rules
from workload.items import as_of, entries, items, items_apart, table, with_texts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Some topics have them as keywords, some only in titles, some not at all.
WATCHED_KEYWORDS, WATCHED_TICKERS = ["las", "Und"], ["QUEGA"]
FEED_LIMIT = 20
LOOKBACK_DAYS = 7


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(fn)
    def registered(spark: SparkSession, sf_dir: str) -> DataFrame:
        add_package(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = registered
    return fn


def shown(ts: Column | str) -> Column:
    return times.format_iso8601(F.col(ts) if isinstance(ts, str) else ts)


def whole_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deduplicated items with their texts, which only the items that stay fetch.

    The deduplication reads its rows twice, so they are stored: no text is hashed twice.
    """
    apart = stored(items_apart(spark, sf_dir), "items_apart")
    kept = with_texts(spark, sf_dir, dedupe.deduplicate(apart))
    return kept.select(
        "seq", "source_name", "source_weight", "title", "summary", "link", "published_at", "topic_id", "run_id", "canonical_url",
        "has_summary", "item_id", "text_len", "content_hash", "publisher_domain", "pos",
    )


def kept_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deduplicated items, stored because several parts of a query read them."""
    return stored(whole_items(spark, sf_dir), "items")


def narrow_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deduplicated items without their texts."""
    return dedupe.deduplicate_narrow(items(spark, sf_dir).drop("title", "summary"))


def scored_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = kept_items(spark, sf_dir)
    records = topics.topic_records(kept, keywords.topic_keywords(kept))
    return scoring.score_topics(records, as_of(), WATCHED_KEYWORDS, WATCHED_TICKERS)


# URLs and hashes ------------------------------------------------------------


@query
def canonical_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    canonical = pages.withColumn("canonical_url", url.normalize_url(F.col("url")))
    return canonical.select(
        "page_id",
        "canonical_url",
        url.normalize_url(F.col("url"), remove_params=False).alias("with_params"),
        url.netloc(F.col("canonical_url")).alias("netloc"),
        text.url_hash(F.col("canonical_url")).alias("item_id"),
    )


@query
def publisher_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url.with_registered_domain(pages, "url", suffix_rules(spark), "publisher_domain").drop("url")


@query
def content_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entries(spark, sf_dir).select("seq", text.content_hash(F.col("title"), F.col("summary")).alias("content_hash"))


@query
def feed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    wall = F.col("ts").cast("timestamp_ntz")
    rfc822 = F.concat(F.date_format(wall, "dd MMM yyyy HH:mm:ss"), F.lit(" EST"))
    iso = F.concat(F.date_format(wall, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+08:00"))
    return events.select(
        "event_id",
        shown(times.parse_feed_date(rfc822)).alias("from_rfc822"),
        shown(times.parse_feed_date(iso)).alias("from_iso8601"),
        shown(times.parse_iso8601(iso)).alias("exact"),
        shown(times.to_utc(wall, "Asia/Taipei")).alias("from_taipei"),
        times.parse_feed_date(F.col("event_type")).isNull().alias("unparsed"),
    )


# Items ----------------------------------------------------------------------


@query
def item_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return items(spark, sf_dir).select(
        "seq", "run_id", "item_id", "canonical_url", "publisher_domain", shown("published_at").alias("published_at"),
        "source_name", "source_weight", "title", "summary", "has_summary", "text_len", "content_hash", "topic_id",
    )


@query
def lookback_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = collect.within_lookback(entries(spark, sf_dir), as_of(), LOOKBACK_DAYS)
    return kept.select("seq", "source_name", shown("published_at").alias("published_at"))


@query
def first_items_per_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collect.first_per_feed(entries(spark, sf_dir), FEED_LIMIT).select("seq", "source_name", "title")


@query
def items_per_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collect.items_per_feed(entries(spark, sf_dir))


@query
def deduplicated_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whole_items(spark, sf_dir).select(
        "seq", "pos", "item_id", "canonical_url", "content_hash", "source_weight",
        shown("published_at").alias("published_at"), "title", "summary",
    )


@query
def dedupe_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.dedupe_stats(dedupe.survivors(items(spark, sf_dir)))


# Topics ---------------------------------------------------------------------


@query
def topic_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topics.topic_stats(stored(narrow_items(spark, sf_dir), "items")).select(
        "topic_id", "topic_volume", "unique_domains", F.round("avg_source_weight", 9).alias("avg_source_weight"),
        F.round("duplicate_ratio", 9).alias("duplicate_ratio"), "first_pos",
        shown("first_seen_at").alias("first_seen_at"), shown("last_seen_at").alias("last_seen_at"),
    )


@query
def duplicate_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ratio over items before deduplication, where it is not zero."""
    fetched = items(spark, sf_dir).withColumn("pos", F.col("seq"))
    return topics.topic_stats(fetched).select(
        "topic_id", "topic_volume", F.round("duplicate_ratio", 9).alias("duplicate_ratio")
    )


@query
def daily_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = narrow_items(spark, sf_dir)
    return topics.bucket_counts(kept, "daily").select("topic_id", "bucket_start", F.col("count").alias("n"))


@query
def hourly_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = narrow_items(spark, sf_dir)
    return topics.bucket_counts(kept, "hourly").select("topic_id", "bucket_start", F.col("count").alias("n"))


@query
def top_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered domains are few in the tables, so whole hosts are ranked."""
    kept = narrow_items(spark, sf_dir)
    hosts = kept.withColumn("publisher_domain", url.netloc(F.col("canonical_url")))
    return topics.ranked_domains(hosts).select("topic_id", "publisher_domain", "n", "rank")


@query
def representative_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = whole_items(spark, sf_dir)
    return topics.representatives(kept).select(
        "topic_id", "rank", "url", "title", "domain", shown("published_at").alias("published_at"), "summary"
    )


@query
def term_frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keywords.corpus_terms(keywords.term_counts(items(spark, sf_dir))).select("term", "total")


@query
def topic_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = stored(keywords.term_counts(items(spark, sf_dir)), "term_counts")
    return keywords.ranked_keywords(counts).select("topic_id", "rank", "term", F.round("score", 9).alias("score"))


@query
def reduced_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = stored(keywords.term_counts(items(spark, sf_dir)), "term_counts")
    return keywords.reduce_topics(counts, 4)


@query
def topic_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = kept_items(spark, sf_dir)
    records = topics.topic_records(kept, keywords.topic_keywords(kept))
    counted = F.transform(
        F.array_sort(F.map_entries("domain_counts")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))
    )
    listed = F.transform("counts_by_bucket", lambda b: F.concat(b["bucket_start"], F.lit("="), b["count"].cast("string")))
    return records.select(
        "run_id", "topic_id", "topic_signature", F.array_join("top_keywords", " ").alias("top_keywords"),
        "topic_volume", "unique_domains", F.array_join("top_domains", " ").alias("top_domains"),
        F.array_join(counted, " ").alias("domain_counts"), F.array_join(listed, " ").alias("counts_by_bucket"),
        F.array_join(F.transform("representative_items", lambda r: r["url"]), " ").alias("representative_urls"),
    )


@query
def items_with_signature(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = kept_items(spark, sf_dir)
    records = topics.topic_records(kept, keywords.topic_keywords(kept))
    return topics.attach_signatures(kept, records).select("seq", "item_id", "topic_id", "topic_signature")


@query
def score_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored_topics(spark, sf_dir).select(
        "topic_id", "topic_signature", "narrative_signal_score",
        *[F.round(f"score_breakdown.{part}", 6).alias(part)
          for part in ("volume_score", "velocity_score", "source_score", "watchlist_bonus")],
    )


@query
def top_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole way from items to the best-scored topics."""
    return scoring.top_topics(scored_topics(spark, sf_dir), 5).select(
        "topic_id", "topic_signature", "topic_volume", "narrative_signal_score",
        F.array_join("top_keywords", " ").alias("top_keywords"),
    )


def watched_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A watchlist that grows: every word of the benchmark texts."""
    words = F.explode(F.split(F.col("text"), " "))
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet").select(words.alias("term")).filter("term <> ''")


@query
def watched_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many watched words the title of each item contains, anywhere in it."""
    titles = items(spark, sf_dir).select(F.col("seq").alias("id"), "title")
    found = watchlist.matching_terms(titles, watched_words(spark, sf_dir))
    return found.groupBy(F.col("id").alias("seq")).agg(F.count("*").alias("n_terms"))


@query
def watched_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topics scored with a watchlist table."""
    kept = kept_items(spark, sf_dir)
    records = stored(topics.topic_records(kept, keywords.topic_keywords(kept)), "records")
    words = watched_words(spark, sf_dir)
    flags = watchlist.watched_topics(records, words).select("topic_id", "in_keywords", "in_titles")
    scored = scoring.score_topics(records, as_of(), watchlist=words).join(flags, "topic_id", "left")
    hit = [F.coalesce(c, F.lit(False)).alias(c) for c in ("in_keywords", "in_titles")]
    return scored.select("topic_id", *hit, F.col("score_breakdown.watchlist_bonus").alias("watchlist_bonus"), "narrative_signal_score")


@query
def merged_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topics merged one after another until four are left."""
    found = items(spark, sf_dir)
    counts = stored(keywords.term_counts(found), "term_counts")
    volumes = topics.without_noise(found).groupBy("topic_id").agg(F.count("*").alias("volume"))
    return keywords.merge_topics(counts, 4, volumes, per_round=1)


# Clusters -------------------------------------------------------------------

EPS, MIN_SAMPLES, MIN_CLUSTER_SIZE, DIMS = 0.026, 3, 3, 5
TEXT_EPS = 0.05


def block_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings reduced to five dimensions, the means of 13 values each."""
    values = F.col("embedding").cast("array<double>")

    def mean(i: int) -> Column:
        block = F.slice(values, 13 * i + 1, 13)
        return F.aggregate(block, F.lit(0.0), lambda total, v: total + v) / F.size(block)

    vectors = table(spark, sf_dir, "embeddings")
    return vectors.select(F.col("vec_id").alias("id"), F.array(*[mean(i) for i in range(DIMS)]).alias("vector"))


@query
def density_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = block_means(spark, sf_dir)
    return density.density_clusters(vectors, EPS, MIN_SAMPLES, MIN_CLUSTER_SIZE, DIMS)


@query
def cluster_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = block_means(spark, sf_dir)
    assigned = density.density_clusters(vectors, EPS, MIN_SAMPLES, MIN_CLUSTER_SIZE, DIMS)
    stats = density.cluster_stats(assigned)
    return stats.withColumn("noise_ratio", F.round("noise_ratio", 9))


@query
def text_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topics of the items' texts: TF-IDF vectors, principal components, density."""
    kept = kept_items(spark, sf_dir).drop("topic_id")
    settings = cluster.ClusterSettings(min_topic_size=10, eps=TEXT_EPS)
    clustered, _ = cluster.cluster_items(kept, settings, noise_handling="keep")
    return clustered.select("seq", "item_id", "topic_id")


@query
def word_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often two words of the items stand close together, and what that says."""
    documents = stored(word_vectors.document_tokens(items(spark, sf_dir)), "document_tokens")
    words = word_vectors.word_counts(documents).filter(F.col("n") >= word_vectors.WordSettings().min_count)
    numbers = stored(word_vectors.numbered_words(words), "word_numbers")
    pairs = word_vectors.numbered_cooccurrences(documents, numbers, last=True)
    names = numbers.select(F.col("number").alias("word"), F.col("word").alias("name"))
    weights = word_vectors.positive_information(pairs, None, once=True, names=names)
    return weights.select("a", "b", "n", F.round("weight", 9).alias("weight"))


@query
def learned_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topics of the items' texts by vectors learned from them, at every density."""
    kept = kept_items(spark, sf_dir).drop("topic_id")
    settings = cluster.ClusterSettings(min_topic_size=10, texts="learned")
    clustered, _ = cluster.cluster_items(kept, settings, noise_handling="keep")
    return clustered.select("seq", "item_id", "topic_id")


NEAREST = 10


def embedding_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))


@query
def nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest embeddings of every embedding, all 64 values; exact up to one bucket of points."""
    found = neighbours.neighbours_to_recall(embedding_vectors(spark, sf_dir), NEAREST)
    listed = found.select(F.col("id").alias("vec_id"), "recall", F.posexplode("near").alias("place", "x"))
    return listed.select(
        "vec_id", (F.col("place") + 1).alias("place"), F.col("x.id").alias("other_id"), F.round("x.distance", 6).alias("distance"), "recall"
    )


@query
def reduced_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The embeddings in five dimensions, along the graph of their nearest by angle."""
    near = neighbours.neighbours_to_recall(embedding_vectors(spark, sf_dir), 15, metric="cosine")
    laid_out = graph_layout(fuzzy_edges(near), DIMS)
    return laid_out.select(F.col("id").alias("vec_id"), F.transform("vector", lambda v: F.round(v, 6)).alias("vector"))


@query
def hierarchical_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of the embeddings at every density."""
    return hierarchy.hierarchical_clusters(block_means(spark, sf_dir), MIN_SAMPLES, MIN_CLUSTER_SIZE)


# Wider than EPS: documents that share an embedding fill some cells, others are sparse.
CHAIN = cluster.ClusterSettings(min_topic_size=6, min_cluster_size=4, min_samples=3, eps=0.036, components=DIMS)
REDUCED = 3


def item_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reduced embedding of each document; several documents share one."""
    vectors = block_means(spark, sf_dir)
    documents = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"))
    n = vectors.agg(F.count("*")).scalar()
    # the documents are the larger side, an embedding a short row
    keyed = documents.withColumn("vec_id", F.col("id") % n)
    return keyed.join(vectors.withColumnRenamed("id", "vec_id"), "vec_id").select("id", "vector")


def clustered(spark: SparkSession, sf_dir: str, noise: str) -> DataFrame:
    kept = stored(narrow_items(spark, sf_dir).drop("topic_id"), "items")
    return cluster.cluster_items(kept, CHAIN, noise_handling=noise, vectors=item_vectors(spark, sf_dir))[0]


@query
def clustered_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deduplicated items through clustering, without their noise."""
    return clustered(spark, sf_dir, "drop").select("seq", "item_id", "topic_id")


@query
def clustered_items_with_noise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustered(spark, sf_dir, "keep").select("seq", "item_id", "topic_id")


@query
def degraded_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fewer items than the least number to cluster: one topic, marked so."""
    kept = stored(narrow_items(spark, sf_dir).drop("topic_id"), "items")
    single, stats = cluster.cluster_items(kept, CHAIN, min_items_to_cluster=1 << 40)
    members = single.agg(F.count_distinct("topic_id").alias("n"), F.count_if(F.col("topic_id") == 0).alias("in_topic_0"))
    return stats.withColumns({c: members.select(c).scalar() for c in ("n", "in_topic_0")})


def mined(spark: SparkSession, sf_dir: str) -> RunResult:
    """A whole run over the items, its topics reduced to a few."""
    found = items(spark, sf_dir).drop("topic_id")
    settings = RunSettings(clustering=replace(CHAIN, nr_topics=REDUCED))
    return mine_topics(stored(found, "items"), as_of(), settings, item_vectors(spark, sf_dir))


@query
def reduced_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mined(spark, sf_dir).items.select("seq", "item_id", "topic_id")


@query
def reduced_run_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = mined(spark, sf_dir).stats
    return stats.withColumns({c: F.round(c, 9) for c in ("noise_ratio", "missing_summary_ratio")})


# Feeds ----------------------------------------------------------------------


def feed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One feed document per row of ``documents``, one entry per line of its text.

    Even documents are RSS and odd ones Atom. Of every fifth the end is missing,
    from inside its last entry on.
    """
    documents = table(spark, sf_dir, "documents").hint("merge").join(
        entries(spark, sf_dir).select(F.col("seq").alias("doc_id"), "published_at"), "doc_id"
    )
    wall = times.utc_wall(F.col("published_at"))

    def escaped(value: Column) -> Column:
        for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            value = F.replace(value, F.lit(plain), F.lit(entity))
        return value

    def address(i: Column) -> Column:
        return F.concat(F.lit("HTTPS://www.Example.co.uk/"), "doc_id", F.lit("/"), i, F.lit("?utm_source=x&amp;b=2#top"))

    def rss(line: Column, i: Column) -> Column:
        about = F.when(i % 2 == 0, F.concat(F.lit("<description>line "), i, F.lit("</description>"))).otherwise("")
        return F.concat(
            F.lit("<item><title>"), escaped(line), F.lit("</title><link>"), address(i), F.lit("</link>"), about,
            F.lit("<pubDate>Mon, "), F.date_format(wall, "dd MMM yyyy HH:mm:ss"), F.lit(" GMT</pubDate></item>"),
        )

    def atom(line: Column, i: Column) -> Column:
        return F.concat(
            F.lit('<entry><title type="text">'), escaped(line), F.lit('</title><link rel="alternate" href="'), address(i),
            F.lit('"/><summary>line '), i, F.lit("</summary><updated>"), F.date_format(wall, "yyyy-MM-dd'T'HH:mm:ss"),
            F.lit("Z</updated><author><name>writer "), F.col("doc_id") % 7, F.lit("</name></author></entry>"),
        )

    lines = F.split("text", "\n")
    whole = F.when(
        F.col("doc_id") % 2 == 0,
        F.concat(
            F.lit("<rss><channel><title>"), "source", F.lit("</title>"), F.array_join(F.transform(lines, rss), "\n"),
            F.lit("</channel></rss>"),
        ),
    ).otherwise(
        F.concat(
            F.lit("<feed><title>"), "source", F.lit("</title>"), F.array_join(F.transform(lines, atom), "\n"),
            F.lit("</feed>"),
        )
    )
    cut = F.regexp_replace(whole, r"</(?:item></channel></rss|entry></feed)>$", "")
    value = F.when(F.col("doc_id") % 5 == 0, cut).otherwise(whole)
    return documents.select("doc_id", F.col("source").alias("feed"), value.alias("value"))


def feed_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source of the documents as a feed, in numeric order."""
    return (
        table(spark, sf_dir, "documents")
        .select(F.col("source").alias("name"))
        .distinct()
        .select(
            "name", F.substring("name", 4, 10).cast("int").alias("feed_order"), F.lit(None).cast("double").alias("weight"),
            F.lit("news").alias("category"), F.lit(None).cast("string").alias("market"), F.lit("").alias("language"),
        )
    )


@query
def feed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed documents parsed, broken ones recovered, entries turned into items."""
    documents = stored(feed_documents(spark, sf_dir).withColumnRenamed("doc_id", "document"), "landed")
    registry = feed_registry(spark, sf_dir)
    found = collect.collect_items(
        feeds.feed_entries(documents), registry, suffix_rules(spark), "run-1", as_of(), as_of(), None, None
    )
    return found.select(
        "seq", "item_id", "canonical_url", "publisher_domain", "source_name", "source_weight", "title", "summary",
        "has_summary", "text_len", shown("published_at").alias("published_at"), "json_payload.publisher_name", "json_payload.language",
    )


@query
def collected_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first entries of each feed over all its documents, inside the lookback."""
    documents = feed_documents(spark, sf_dir).withColumnRenamed("doc_id", "document")
    registry = feed_registry(spark, sf_dir).filter("feed_order <> 3")
    entries_ = feeds.feed_entries(documents)
    found = collect.collect_items(
        entries_, registry, suffix_rules(spark), "run-1", as_of(), as_of(), FEED_LIMIT, 4 * LOOKBACK_DAYS
    )
    return found.select("seq", "item_id", "source_name", "title", shown("published_at").alias("published_at"))


@query
def deduplicated_feed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collected feed items go through deduplication one row each."""
    documents = feed_documents(spark, sf_dir).withColumnRenamed("doc_id", "document")
    found = collect.collect_items(
        feeds.feed_entries(documents), feed_registry(spark, sf_dir), suffix_rules(spark), "run-1", as_of(), as_of(), None, None
    )
    return dedupe.deduplicate(stored(found, "feed_items")).select("seq", "pos", "item_id")


@query
def unregistered_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = feed_documents(spark, sf_dir).withColumnRenamed("doc_id", "document")
    registry = feed_registry(spark, sf_dir).filter("feed_order <> 3")
    return collect.unregistered_feeds(feeds.feed_entries(documents), registry)


@query
def unreadable_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed documents from which nothing could be read."""
    landed = stored(feed_documents(spark, sf_dir), "landed")
    return feeds.unreadable_documents(landed).select("doc_id", "feed")


@query
def split_feed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines of the documents as entries of few large feed files, read in byte ranges."""
    lines = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("feed"), F.posexplode(F.split("text", "\n")).alias("i", "line"))
    title = F.col("line")
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        title = F.replace(title, F.lit(plain), F.lit(entity))
    item = F.concat(F.lit("<item><title>"), title, F.lit("</title><link>http://example.com/"), "doc_id", F.lit("/"), "i", F.lit("</link></item>"))
    folder = fresh_folder(spark, "feeds")
    lines.select("feed", item.alias("value")).write.partitionBy("feed").text(folder)
    return feeds.split_feed_entries(spark, folder).select("feed", "link", "title")


# Stored runs ----------------------------------------------------------------

SIGNATURE = text.topic_signature


def run_items(spark: SparkSession, sf_dir: str, narrow: bool = True) -> DataFrame:
    """Kept items, each feed being one run, with a signature per topic label."""
    kept = narrow_items(spark, sf_dir) if narrow else whole_items(spark, sf_dir)
    label = F.concat(F.lit("topic"), "topic_id")
    return kept.withColumns(
        {"run_id": F.col("source_name"), "topic_signature": SIGNATURE(F.array(label), F.array().cast("array<string>"))}
    )


def is_early() -> Column:
    """Published in the first half of the month: what an earlier write brought."""
    return F.col("published_at") < F.lit("2024-01-16T00:00:00+00:00").cast("timestamp")


def runs_of(found: DataFrame, status: str) -> DataFrame:
    settings = {"lookback_days": 7, "dedupe_strategy": "url_then_hash", "output_dir": "ignored"}
    return found.groupBy("run_id").agg(
        F.max("published_at").alias("generated_at"),
        F.lit(7).alias("lookback_days"),
        text.config_hash(settings).alias("config_hash"),
        F.lit(status).alias("status"),
        F.count("*").alias("fetched_count"),
        F.nullif(F.count_if(~F.col("has_summary")), F.lit(0)).alias("without_summary"),
    )


def topics_of(found: DataFrame) -> DataFrame:
    label = F.concat(F.lit("topic"), "topic_id")
    scored = scoring.score_topics(topics.topic_stats(found), as_of())
    signed = scored.withColumn("topic_signature", SIGNATURE(F.array(label), F.array().cast("array<string>")))
    return signed.select(
        "run_id", "topic_signature", "topic_id", "topic_volume", "unique_domains", "narrative_signal_score"
    )


def buckets_of(found: DataFrame) -> DataFrame:
    label = F.concat(F.lit("topic"), "topic_id")
    return topics.bucket_counts(found).select(
        "run_id",
        SIGNATURE(F.array(label), F.array().cast("array<string>")).alias("topic_signature"),
        times.bucket_instant(F.col("bucket_start")).alias("bucket_start"),
        "count",
    )


@query
def upserted_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stored(run_items(spark, sf_dir), "items")
    before, after = runs_of(found.filter(is_early()), "running"), runs_of(found.filter(~is_early()), "completed")
    merged = upsert.merge_upsert(before, after, ["run_id"], ["status", "fetched_count", "without_summary"])
    return merged.withColumn("generated_at", shown("generated_at"))


@query
def inserted_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A write that repeats keys, also inside itself: the first row of a new key stays."""
    found = run_items(spark, sf_dir, narrow=False).select("run_id", "item_id", "title", "published_at")
    found = stored(found.withColumn("seq", F.lit(0)), "items")
    again = found.withColumns({"title": F.concat(F.lit("again: "), "title"), "seq": F.lit(1)})
    late = found.withColumns({"title": F.concat(F.lit("late: "), "title"), "seq": F.lit(2)})
    source = late.unionByName(again)
    merged = upsert.insert_ignore(found.filter(is_early()), source, KEYS["items"], F.col("seq"))
    return merged.select("run_id", "item_id", "title")


@query
def upserted_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stored(run_items(spark, sf_dir), "items")
    before, after = topics_of(found.filter(is_early())), topics_of(found.filter(~is_early()))
    return upsert.merge_upsert(before, after, KEYS["topics"], REPLACED["topics"])


def keyed_table(spark: SparkSession, name: str, frame: DataFrame, indexed: list[str]) -> KeyedTable:
    schema = ", ".join(f"{c} {kind}" for c, kind in frame.dtypes)
    return KeyedTable(spark, fresh_folder(spark, "keyed"), schema, KEYS[name], indexed, rows_per_file=100_000)


@query
def file_upserted_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The upsert of topics as two writes of a keyed table, which replace files that hold their keys."""
    found = stored(run_items(spark, sf_dir), "items")
    before, after = topics_of(found.filter(is_early())), topics_of(found.filter(~is_early()))
    kept = keyed_table(spark, "topics", before, ["topic_signature"])
    kept.upsert(before, REPLACED["topics"])
    kept.upsert(after, REPLACED["topics"])
    return kept.read()


@query
def file_items_by_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items inserted into a keyed table and looked up by their least content hash."""
    found = stored(run_items(spark, sf_dir).select("run_id", "item_id", "content_hash"), "items")
    kept = keyed_table(spark, "items", found, ["content_hash"])
    kept.insert_new(found)
    # the same rows again change nothing
    kept.insert_new(found)
    return kept.look_up("content_hash", [found.agg(F.min("content_hash")).first()[0]])


@query
def upserted_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stored(run_items(spark, sf_dir), "items")
    shifted = found.withColumn("published_at", F.col("published_at") + F.make_dt_interval(F.lit(10)))
    merged = upsert.merge_upsert(buckets_of(found), buckets_of(shifted), KEYS["topic_buckets"], REPLACED["topic_buckets"])
    return merged.select("run_id", "topic_signature", shown("bucket_start").alias("bucket_start"), F.col("count").alias("n"))


@query
def purged_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stored(run_items(spark, sf_dir), "items")
    light = found.filter(F.col("source_weight") < 0.6).select("run_id").distinct()
    return upsert.without_runs(found, light).select("run_id", "item_id", "topic_id")


@query
def orphan_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stored(run_items(spark, sf_dir), "items")
    orphans = upsert.fk_violations(buckets_of(found), topics_of(found.filter(is_early())), KEYS["topics"])
    return orphans.select("run_id", "topic_signature", shown("bucket_start").alias("bucket_start"), F.col("count").alias("n"))


@query
def latest_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = runs_of(run_items(spark, sf_dir), "completed")
    return reports.latest_runs(runs).withColumn("generated_at", shown("generated_at"))


@query
def items_per_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.items_per_run(run_items(spark, sf_dir))


@query
def best_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stored(run_items(spark, sf_dir), "items")
    return reports.best_topics(topics_of(found))


@query
def bucket_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.bucket_summary(buckets_of(run_items(spark, sf_dir)))


@query
def topic_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One signature over all runs."""
    found = stored(run_items(spark, sf_dir), "items")
    one = SIGNATURE(F.array(F.lit("topic3")), F.array().cast("array<string>"))
    return reports.topic_history(topics_of(found), one).select("run_id", "topic_volume", "narrative_signal_score")


@query
def items_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, end = [F.lit(f"2024-01-{day}T00:00:00+00:00").cast("timestamp") for day in ("10", "12")]
    return reports.items_published(run_items(spark, sf_dir), first, end).select("run_id", "item_id", shown("published_at").alias("published_at"))


@query
def run_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    fetched = stored(items(spark, sf_dir).drop("title", "summary"), "items")
    survivors = stored(dedupe.survivors(fetched), "survivors")
    kept = fetched.join(survivors.select("seq"), "seq")
    final = topics.without_noise(kept)
    stats = reports.run_statistics(dedupe.dedupe_stats(survivors), density.cluster_stats(kept), final)
    return stats.withColumns({c: F.round(c, 9) for c in ("noise_ratio", "missing_summary_ratio")})


@query
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.run_summary(scored_topics(spark, sf_dir))


@query
def run_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keywords of the topics of several runs, each weighed inside its run."""
    found = stored(run_items(spark, sf_dir, narrow=False), "items")
    counts = stored(keywords.term_counts(found), "term_counts")
    return keywords.ranked_keywords(counts).select("run_id", "topic_id", "rank", "term", F.round("score", 9).alias("score"))


@query
def run_top_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two best topics of every run."""
    found = stored(run_items(spark, sf_dir), "items")
    best = scoring.top_topics_per_run(scoring.score_topics(topics.topic_stats(found), as_of()), 2)
    return best.select("run_id", "rank", "topic_id", "topic_volume", "narrative_signal_score")


@query
def items_by_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stored(run_items(spark, sf_dir).select("run_id", "item_id", "content_hash"), "items")
    return reports.items_with(found, "content_hash", found.agg(F.min("content_hash")).scalar())


@query
def items_by_signature(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = SIGNATURE(F.array(F.lit("topic5")), F.array().cast("array<string>"))
    return reports.items_with(run_items(spark, sf_dir), "topic_signature", one).select("run_id", "item_id")


@query
def runs_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs with items in the second half of the month are completed."""
    found = stored(run_items(spark, sf_dir), "items")
    before, after = runs_of(found, "running"), runs_of(found.filter(~is_early()), "completed")
    merged = upsert.merge_upsert(before, after, ["run_id"], ["status"])
    return reports.runs_with_status(merged, "completed").select("run_id", "status", "fetched_count")


@query
def buckets_in_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, end = [F.lit(f"2024-01-{day}T00:00:00+00:00").cast("timestamp") for day in ("10", "12")]
    found = reports.buckets_between(buckets_of(run_items(spark, sf_dir)), first, end)
    return found.select("run_id", "topic_signature", shown("bucket_start").alias("bucket_start"), F.col("count").alias("n"))


@query
def orphan_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items whose run is not stored: here the runs of heavy feeds are."""
    found = stored(run_items(spark, sf_dir), "items")
    runs = runs_of(found.filter(F.col("source_weight") >= 0.6), "completed")
    return upsert.fk_violations(found, runs, KEYS["runs"]).select("run_id", "item_id")


@query
def orphan_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stored(run_items(spark, sf_dir), "items")
    runs = runs_of(found.filter(F.col("source_weight") >= 0.6), "completed")
    return upsert.fk_violations(topics_of(found), runs, KEYS["runs"]).select("run_id", "topic_signature", "topic_volume")


# Tables written and read back ------------------------------------------------


def fresh_folder(spark: SparkSession, label: str) -> str:
    return f"{checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"


def storable_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns of the item table; every feed is a run."""
    payload = F.struct(
        F.col("source_name").alias("publisher_name"), F.lit("news").alias("category"), F.lit(None).cast("string").alias("market"),
        F.lit("en").alias("language"), F.col("link").alias("original_link"),
    )
    found = run_items(spark, sf_dir, narrow=False).withColumns({"fetched_at": as_of(), "json_payload": payload})
    return stored(found, "items")


def storable_topics(found: DataFrame) -> DataFrame:
    """All columns of the topic table."""
    records = topics.topic_records(found, keywords.topic_keywords(found))
    scored = scoring.score_topics(records, as_of())
    return stored(scored.withColumn("json_payload", F.struct(*TOPIC_PAYLOAD)).drop(*TOPIC_PAYLOAD), "topics")


def storable_runs(found: DataFrame) -> DataFrame:
    counted = found.groupBy("run_id").agg(F.max("published_at").alias("generated_at"), F.count("*").alias("n"))
    names = ("fetched_count", "deduped_count", "topic_count", "noise_ratio", "missing_summary_ratio", "error")
    stats = F.struct(F.col("n").alias(names[0]), *[F.lit(None).alias(name) for name in names[1:]])
    return counted.select(
        "run_id", "generated_at", F.lit(7).alias("lookback_days"), F.lit("0").alias("config_hash"),
        F.lit("completed").alias("status"), stats.alias("stats"),
    )


def read_back_items(spark: SparkSession, sf_dir: str, fmt: str) -> DataFrame:
    """Items written twice, the second time all of them under other titles; one run read."""
    store = RunStore(spark, fresh_folder(spark, "store"), fmt)
    found = storable_items(spark, sf_dir)
    store.save_items(found.filter(is_early()))
    store.save_items(found.withColumn("title", F.concat(F.lit("again: "), "title")))
    return store.read_items("src3").select(
        "item_id", "run_id", "canonical_url", shown("published_at").alias("published_at"), shown("fetched_at").alias("fetched_at"),
        "source_weight", "title", "summary", "has_summary", "text_len", "content_hash", "topic_id", "topic_signature",
        F.col("json_payload.publisher_name").alias("publisher_name"), F.col("json_payload.market").alias("market"),
    )


@query
def stored_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_back_items(spark, sf_dir, "parquet")


@query
def stored_items_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_back_items(spark, sf_dir, "json")


@query
def stored_items_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_back_items(spark, sf_dir, "files")


@query
def stored_items_by_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All runs' items of the least URL, from the files that may hold it."""
    store = RunStore(spark, fresh_folder(spark, "store"), "files")
    found = storable_items(spark, sf_dir)
    store.save_items(found)
    least = found.agg(F.min("canonical_url")).first()[0]
    return store.look_up("items", "canonical_url", least).select("run_id", "item_id", "canonical_url", "topic_id")


def read_back_topics(spark: SparkSession, sf_dir: str, fmt: str) -> RunStore:
    """Topics written twice; the second write changes volume and domains, of which only the volume counts."""
    store = RunStore(spark, fresh_folder(spark, "store"), fmt)
    found = storable_topics(storable_items(spark, sf_dir))
    store.save_topics(found)
    more = {c: F.col(c) + 1000 for c in ("topic_volume", "unique_domains")}
    store.save_topics(found.filter("topic_volume > 3").withColumns(more))
    return store


def shown_topics(found: DataFrame) -> DataFrame:
    return found.select(
        "run_id", "topic_id", "topic_signature", F.array_join("top_keywords", " ").alias("top_keywords"), "topic_volume",
        "unique_domains", F.round("avg_source_weight", 9).alias("avg_source_weight"), shown("last_seen_at").alias("last_seen_at"),
        F.array_join(F.transform("representative_items", lambda r: r["url"]), " ").alias("representative_urls"),
        F.array_join("json_payload.top_domains", " ").alias("top_domains"), "narrative_signal_score",
    )


@query
def stored_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown_topics(read_back_topics(spark, sf_dir, "parquet").read_topics("src3"))


@query
def stored_topics_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown_topics(read_back_topics(spark, sf_dir, "json").read_topics("src3"))


@query
def stored_topics_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown_topics(read_back_topics(spark, sf_dir, "files").read_topics("src3"))


@query
def stored_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = read_back_topics(spark, sf_dir, "parquet").read("topic_buckets")
    return found.select("run_id", "topic_signature", shown("bucket_start").alias("bucket_start"), F.col("count").alias("n"))


@query
def exported_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run's items as exported JSON lines, their times as the text in the files."""
    found = storable_items(spark, sf_dir).filter("run_id = 'src3'")
    folder = fresh_folder(spark, "export")
    export_run(found.drop("pos", "link"), storable_topics(found), folder)
    lines = spark.read.schema("item_id string, title string, published_at string, topic_id int").json(f"{folder}/items")
    return lines


@query
def exported_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best topics of one run as the exported JSON array."""
    found = storable_items(spark, sf_dir).filter("run_id = 'src3'")
    folder = fresh_folder(spark, "export")
    export_run(found.drop("pos", "link"), storable_topics(found), folder, 3)
    parsed = F.from_json("value", f"array<struct<{TOPICS.replace(' timestamp,', ' string,')}>>")
    array = spark.read.text(f"{folder}/topics").select(F.posexplode(parsed).alias("place", "topic"))
    return array.select(
        "place", "topic.run_id", "topic.topic_id", "topic.topic_signature", "topic.topic_volume",
        "topic.last_seen_at", "topic.narrative_signal_score",
    )


@query
def exported_run_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The items of every run as exported JSON lines."""
    found = storable_items(spark, sf_dir)
    folder = fresh_folder(spark, "export")
    export_runs(found.drop("pos", "link"), storable_topics(found), folder)
    schema = "item_id string, title string, published_at string, topic_id int, run_id string"
    return spark.read.schema(schema).json(f"{folder}/items")


@query
def exported_run_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three best topics of every run as the exported JSON arrays."""
    found = storable_items(spark, sf_dir)
    folder = fresh_folder(spark, "export")
    export_runs(found.drop("pos", "link"), storable_topics(found), folder, 3)
    parsed = F.from_json("value", f"array<struct<{TOPICS.replace(' timestamp,', ' string,')}>>")
    arrays = spark.read.schema("value string, run_id string").text(f"{folder}/topics")
    return arrays.select("run_id", F.posexplode(parsed).alias("place", "topic")).select(
        "place", "run_id", "topic.topic_id", "topic.topic_signature", "topic.topic_volume",
        "topic.last_seen_at", "topic.narrative_signal_score",
    )


def left_after_purge(spark: SparkSession, sf_dir: str, fmt: str) -> DataFrame:
    found = storable_items(spark, sf_dir)
    store = RunStore(spark, fresh_folder(spark, "store"), fmt)
    store.save_run(storable_runs(found))
    store.save_items(found)
    store.save_topics(storable_topics(found))
    store.purge(["src1", "src2"])
    left = [
        store.read(name).groupBy("run_id").agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("stored_in"), "run_id", "n_rows")
        for name in ("runs", "items", "topics", "topic_buckets")
    ]
    return left[0].unionByName(left[1]).unionByName(left[2]).unionByName(left[3])


@query
def purged_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per run left in all four tables after two runs are purged."""
    return left_after_purge(spark, sf_dir, "parquet")


@query
def purged_tables_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return left_after_purge(spark, sf_dir, "files")


@query
def flat_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topics as plain columns, nested values as JSON text, as a database takes them."""
    found = storable_topics(stored(run_items(spark, sf_dir, narrow=False), "items"))
    return flat_columns(found).select("run_id", "topic_signature", "counts_by_bucket")
