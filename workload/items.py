"""Item rows from the given tables.

The tables hold no feeds, so every document becomes one item: its source is the
feed, its first line the title and the rest the summary (whole texts), a page
gives the link, an event the time, and an embedding's label the topic.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions import text, times, url
from newsloom.sources.suffixes import suffix_rules

# The columns of the given tables; naming them saves a look into the files.
SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}
RUN_ID = "run-1"
AS_OF = "2024-01-31T00:00:00+00:00"


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def row_counts(*tables: DataFrame) -> list[int]:
    """Sizes of several tables, from their file footers in one job."""
    counts = [t.agg(F.lit(i).alias("i"), F.count("*").alias("n")) for i, t in enumerate(tables)]
    return [row["n"] for row in sorted(reduce(DataFrame.union, counts).collect())]


def _links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Link, time and topic per document: joined on ids only, without any text."""
    documents, pages = table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages")
    events, vectors = table(spark, sf_dir, "events"), table(spark, sf_dir, "embeddings")
    n_documents, n_pages, n_events, n_vectors = row_counts(documents, pages, events, vectors)
    stride = n_events // n_documents
    keyed = documents.select(
        "doc_id",
        (F.col("doc_id") % n_pages).alias("page_id"),
        (F.col("doc_id") * stride).alias("event_id"),
        (F.col("doc_id") % n_vectors).alias("vec_id"),
        F.floor(F.col("doc_id") / (2 * n_pages)).alias("copy"),
    )
    scheme, host = F.split_part("url", F.lit("/"), F.lit(1)), F.split_part("url", F.lit("/"), F.lit(3))
    rest = F.col("url").substr(F.length(scheme) + F.length(host) + 3, F.length("url"))
    return (
        keyed.join(pages.select("page_id", "url"), "page_id")
        .join(events.select("event_id", "ts"), "event_id")
        .join(vectors.select("vec_id", "label"), "vec_id")
        .select(
            "doc_id",
            F.concat(scheme, F.lit("//"), host, F.lit("/d"), "copy", rest).alias("link"),
            times.from_utc_wall(F.col("ts").cast("timestamp_ntz")).alias("published_at"),
            (F.col("label") - 1).alias("topic_id"),
        )
    )


def _title_and_rest() -> tuple[Column, Column]:
    """The first line of a text and what follows it."""
    line_end = F.instr("text", "\n")
    first = F.when(line_end > 0, F.col("text").substr(F.lit(1), line_end - 1)).otherwise(F.col("text"))
    rest = F.when(line_end > 0, F.col("text").substr(line_end + 1, F.length("text"))).otherwise("")
    return text.strip(first), text.strip(rest)


def _weight() -> Column:
    feed = F.substring("source", 4, 10).cast("int")
    return (feed % 10 * 5 + 50).cast("double") / 100


def _summary_or_title() -> Column:
    return F.when(F.col("summary") != "", F.col("summary")).otherwise(F.col("title"))


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document, as a feed entry joined to its feed.

    Both sides grow with the documents, so they meet in a merge join on the
    unique ``doc_id``; the texts are never broadcast and move once.
    """
    title, summary = _title_and_rest()
    return (
        table(spark, sf_dir, "documents")
        .hint("merge")
        .join(_links(spark, sf_dir), "doc_id")
        .select(
            F.col("doc_id").alias("seq"),
            F.col("source").alias("source_name"),
            _weight().alias("source_weight"),
            title.alias("title"),
            summary.alias("summary"),
            "link",
            "published_at",
            "topic_id",
        )
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item rows: canonical URL, domain, summary fallback, lengths and hashes."""
    raw = entries(spark, sf_dir)
    filled = raw.withColumns(
        {
            "run_id": F.lit(RUN_ID),
            "canonical_url": url.normalize_url(F.col("link")),
            "has_summary": F.col("summary") != "",
            "summary": _summary_or_title(),
        }
    )
    hashed = filled.withColumns(
        {
            "item_id": text.url_hash(F.col("canonical_url")),
            "text_len": text.text_length(F.col("title"), F.col("summary")),
            "content_hash": text.content_hash(F.col("title"), F.col("summary")),
        }
    )
    return url.with_registered_domain(hashed, "canonical_url", suffix_rules(spark), "publisher_domain")


def _placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the file and the row they are read from, which name a document even where ids repeat."""
    return table(spark, sf_dir, "documents").select(
        "*", F.col("_metadata.row_index").alias("_row"), F.col("_metadata.file_path").alias("_file")
    )


def items_apart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`items` without title and summary, for :func:`with_texts`.

    Lengths and hashes are taken where a document is read, so texts are neither moved
    nor kept.
    """
    title, summary = _title_and_rest()
    described = (
        _placed(spark, sf_dir)
        .withColumns({"title": title, "summary": summary})
        .withColumns({"has_summary": F.col("summary") != "", "summary": _summary_or_title()})
        .select(
            "doc_id", "_file", "_row", "source", "has_summary",
            text.text_length(F.col("title"), F.col("summary")).alias("text_len"),
            text.content_hash(F.col("title"), F.col("summary")).alias("content_hash"),
        )
    )
    joined = described.join(_links(spark, sf_dir), "doc_id").select(
        F.col("doc_id").alias("seq"), F.col("source").alias("source_name"), _weight().alias("source_weight"),
        "link", "published_at", "topic_id", F.lit(RUN_ID).alias("run_id"),
        url.normalize_url(F.col("link")).alias("canonical_url"),
        "has_summary", "text_len", "content_hash", "_file", "_row",
    )
    hashed = joined.withColumn("item_id", text.url_hash(F.col("canonical_url")))
    return url.with_registered_domain(hashed, "canonical_url", suffix_rules(spark), "publisher_domain")


def with_texts(spark: SparkSession, sf_dir: str, found: DataFrame) -> DataFrame:
    """Rows of :func:`items_apart` with the title and summary of the document each was made from."""
    title, summary = _title_and_rest()
    texts = _placed(spark, sf_dir).select("_row", "_file", "text")
    joined = found.join(texts, ["_row", "_file"])
    return joined.withColumns({"title": title, "summary": summary}).withColumn("summary", _summary_or_title()).drop("_row", "_file", "text")
