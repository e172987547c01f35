"""Landed RSS and Atom documents as feed entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsloom.functions import text
from newsloom.lineage import broadcast_if_small, stored

# The elements of an RSS item or Atom entry that are read.
ENTRY_FIELDS = (
    "title string, link array<struct<_VALUE string, _href string, _rel string>>,"
    " guid struct<_VALUE string, _isPermaLink string>, description string, summary string, content string,"
    " `content:encoded` string, pubDate string, published string, updated string, `dc:date` string,"
    " author array<struct<_VALUE string, name string, email string>>, `dc:creator` string,"
    " source struct<_VALUE string, _url string, title string>"
)
ENTRY = f"struct<{ENTRY_FIELDS}>"
# RSS 2.0 keeps items in the channel, RSS 1.0 beside it; Atom has entries.
FEED = (
    f"channel struct<title string, item array<{ENTRY}>>, title string, item array<{ENTRY}>,"
    f" entry array<{ENTRY}>, _corrupt_record string"
)
_FRAGMENT = r"(?s)<(?:item|entry)(?:\s[^>]*)?>.*?</(?:item|entry)>"
_HEAD_TITLE = r"(?s)<title[\s>].*?</title>|<title>.*?</title>"


# HTML names that feeds use although XML does not know them.
HTML_NAMES = {"nbsp": "\u00a0", "ndash": "\u2013", "mdash": "\u2014", "hellip": "\u2026", "rsquo": "\u2019", "lsquo": "\u2018",
              "rdquo": "\u201d", "ldquo": "\u201c", "copy": "\u00a9", "reg": "\u00ae", "euro": "\u20ac"}
_BARE_AMPERSAND = r"&(?!(?:#\d+|#[xX][0-9A-Fa-f]+|amp|lt|gt|quot|apos);)"


def read_feed_documents(spark: SparkSession, path: str) -> DataFrame:
    """``feed, document, value``: one row per document under ``path/feed=<name>/``.

    ``document`` is the file's path; documents of a feed follow each other by it.
    """
    files = spark.read.schema("value string, feed string").text(path, wholetext=True)
    return files.select("feed", F.col("_metadata.file_path").alias("document"), "value")


def _repaired(fragment: Column) -> Column:
    """A fragment whose HTML names are characters and whose bare ampersands are escaped.

    Inside CDATA an ampersand stands for itself, so such fragments stay as they are.
    """
    fixed = fragment
    for name, character in HTML_NAMES.items():
        fixed = F.replace(fixed, F.lit(f"&{name};"), F.lit(character))
    fixed = F.regexp_replace(fixed, _BARE_AMPERSAND, "&amp;")
    return F.when(F.contains(fragment, F.lit("<![CDATA[")), fragment).otherwise(fixed)


def _head_title(value: Column) -> Column:
    """The first title before the first entry."""
    head = F.regexp_extract(F.regexp_replace(value, r"(?s)<(?:item|entry)[\s>].*", ""), _HEAD_TITLE, 0)
    return F.from_xml(F.concat(F.lit("<feed>"), head, F.lit("</feed>")), "title string")["title"]


def _parsed(documents: DataFrame) -> DataFrame:
    parsed = documents.withColumn("doc", F.from_xml("value", FEED, {"mode": "PERMISSIVE"}))
    whole = F.coalesce("doc.channel.item", "doc.item", "doc.entry")
    broken = F.col("doc._corrupt_record").isNotNull() | F.col("doc").isNull()
    fragments = F.when(broken, F.regexp_extract_all("value", F.lit(_FRAGMENT), F.lit(0)))
    return parsed.select(
        *documents.columns,
        broken.alias("broken"),
        F.when(broken, _head_title(F.col("value"))).otherwise(F.coalesce("doc.channel.title", "doc.title")).alias("feed_title"),
        F.when(~broken, whole).alias("whole"),
        fragments.alias("fragments"),
    )


def unreadable_documents(documents: DataFrame) -> DataFrame:
    """Broken documents without one complete entry, set aside instead of failing."""
    lost = F.col("broken") & (F.size("fragments") == 0)
    return _parsed(documents).filter(lost).select(*documents.columns)


def unreadable_entries(documents: DataFrame) -> DataFrame:
    """Cut-out entries of broken documents without title and link even after repair, with their text."""
    columns = [c for c in documents.columns if c != "value"]
    cut = _parsed(documents).select(*columns, F.posexplode("fragments").alias("pos", "fragment"))
    read = cut.withColumn("e", F.from_xml(_repaired(F.col("fragment")), ENTRY_FIELDS, {"mode": "PERMISSIVE"}))
    nothing = (F.coalesce("e.title", F.lit("")) == "") & (F.coalesce(_link("e"), F.lit("")) == "")
    return read.filter(nothing).select(*columns, "pos", "fragment")


def _link(entry: str) -> Column:
    """RSS link text, else the alternate Atom link, else a permanent guid."""
    links = F.col(f"{entry}.link")
    alternate = F.filter(links, lambda k: F.coalesce(k["_rel"], F.lit("alternate")) == "alternate")
    guid = F.when(F.coalesce(F.lower(f"{entry}.guid._isPermaLink"), F.lit("true")) == "true", F.col(f"{entry}.guid._VALUE"))
    first = F.get(alternate, F.lit(0))
    return F.coalesce(first["_VALUE"], first["_href"], guid)


def _author(entry: str) -> Column:
    """Name, with the address in brackets when both are given."""
    first = F.get(F.col(f"{entry}.author"), F.lit(0))
    name = F.coalesce(first["name"], first["_VALUE"])
    both = F.when(first["email"].isNotNull(), F.concat(name, F.lit(" ("), first["email"], F.lit(")")))
    return F.coalesce(both, name, first["email"], F.col(f"{entry}.`dc:creator`"))


def feed_entries(documents: DataFrame) -> DataFrame:
    """One row per entry of ``feed, value`` documents, in document order.

    Columns: the other document columns, ``feed_title``, ``pos`` (from 0),
    ``title``, ``summary``, ``link``, ``published`` (text), ``author`` and
    ``source_title``. A document that does not parse as a whole keeps its
    complete entries: they are cut out and parsed one by one.
    """
    columns = [c for c in documents.columns if c != "value"]
    listed = F.coalesce(
        F.transform("whole", lambda e: F.struct(e.alias("entry"), F.lit(None).cast("string").alias("fragment"))),
        F.transform("fragments", lambda f: F.struct(F.lit(None).cast(ENTRY).alias("entry"), f.alias("fragment"))),
    )
    exploded = _parsed(documents).select(*columns, "feed_title", F.posexplode(listed).alias("pos", "raw"))
    recovered = F.from_xml(_repaired(F.col("raw.fragment")), ENTRY_FIELDS, {"mode": "PERMISSIVE"})
    entry = exploded.select(
        *columns, "feed_title", "pos", F.coalesce("raw.entry", F.when(F.col("raw.fragment").isNotNull(), recovered)).alias("e")
    )
    return _entry_rows(entry, [*columns, "feed_title", "pos"])


def _entry_rows(parsed: DataFrame, columns: list[str]) -> DataFrame:
    """The texts of the parsed entries ``e``, after ``columns``."""
    summary = F.coalesce("e.summary", "e.description", "e.content", "e.`content:encoded`", F.lit(""))
    return parsed.select(
        *columns,
        text.strip(F.coalesce("e.title", F.lit(""))).alias("title"),
        text.strip(summary).alias("summary"),
        text.strip(F.coalesce(_link("e"), F.lit(""))).alias("link"),
        F.coalesce("e.published", "e.pubDate", "e.updated", "e.`dc:date`").alias("published"),
        _author("e").alias("author"),
        F.coalesce("e.source.title", "e.source._VALUE").alias("source_title"),
    )


def split_feed_entries(spark: SparkSession, path: str, element: str = "item") -> DataFrame:
    """Entries of feed files of any size under ``path/feed=<name>/``, as ``feed_entries`` returns them.

    A file is read in byte ranges (``spark.sql.files.maxPartitionBytes``) by as many
    tasks; a record ends with the closing tag of ``element``: ``item`` for RSS, ``entry``
    for Atom. So a row is one entry, not one file, and files of one call must be of one
    kind: a file without that tag is a single record. The records are stored once,
    and only one short row per byte range is summed up for the positions.

    The feed title is the first title before the first entry. What a file's end cuts off
    is left out, as are pieces without an opening tag; after such a piece inside a
    file the positions leave a gap. A closing tag spelled out inside CDATA ends an entry.
    """
    if element not in ("item", "entry"):
        raise ValueError("element must be item or entry")
    closing = f"</{element}>"
    records = spark.read.schema("value string, feed string").text(path, lineSep=closing)
    opened = F.regexp_extract("value", rf"(?s)<{element}(?:\s[^>]*)?>.*", 0)
    found = records.select(
        "feed",
        F.col("_metadata.file_path").alias("document"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("file_size"),
        # the rows of a byte range follow each other in one task
        F.monotonically_increasing_id().alias("row"),
        (F.octet_length("value") + len(closing)).alias("n_bytes"),
        F.nullif(opened, F.lit("")).alias("fragment"),
        "value",
    )
    # only a file's first record has its head
    before_entry = F.regexp_extract("value", rf"(?s)^(.*?)(?:<{element}[\s>]|$)", 1)
    found = stored(found.withColumn("head", F.when(F.col("block") == 0, before_entry)).drop("value"), "feed_records")

    blocks = found.groupBy("document", "block").agg(
        F.min("row").alias("first"), F.max("row").alias("last"), F.sum("n_bytes").alias("n_bytes"),
        F.max("file_size").alias("file_size"), F.min_by("head", "row").alias("head"),
    )
    by_file = Window.partitionBy("document")
    before = by_file.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    rows = F.col("last") - F.col("first") + 1
    # a file that ends inside a record has fewer bytes than its records with their closing tags
    cut = F.sum("n_bytes").over(by_file) > F.col("file_size")
    blocks = blocks.select(
        "document",
        "block",
        (F.coalesce(F.sum(rows).over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.when(cut & (F.col("block") == F.max("block").over(by_file)), F.col("last")).alias("cut_row"),
        _head_title(F.min_by("head", "block").over(by_file)).alias("feed_title"),
    )
    placed = found.filter(F.col("fragment").isNotNull()).join(broadcast_if_small(stored(blocks, "feed_blocks")), ["document", "block"])
    whole = placed.filter(F.col("cut_row").isNull() | (F.col("row") != F.col("cut_row")))
    entry = F.from_xml(_repaired(F.concat("fragment", F.lit(closing))), ENTRY_FIELDS, {"mode": "PERMISSIVE"})
    pos = (F.col("row") + F.col("shift")).cast("int")
    return _entry_rows(
        whole.select("feed", "document", "feed_title", pos.alias("pos"), entry.alias("e")), ["feed", "document", "feed_title", "pos"]
    )
