"""Watchlists of any length as tables: which titles and keywords hold which terms.

Keywords equal a term or not, so they are joined. Titles contain a term anywhere in
them; comparing each title with each term would be a nested loop. Instead each term is
filed under the rarest of its short runs of characters, titles under all of theirs, and
only titles and terms that meet there are compared.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions import score
from newsloom.lineage import stored
from newsloom.operators.topics import TOPIC

GRAM = 3


def watched_terms(watchlist: DataFrame) -> DataFrame:
    """The distinct lower-case ``term`` of a watchlist; nulls are none."""
    return watchlist.select(F.lower("term").alias("term")).filter("term is not null").distinct()


def _grams(value: str, n: Column | int) -> Column:
    """The distinct runs of ``n`` characters; the empty run for 0."""
    size = n if isinstance(n, Column) else F.lit(n)
    starts = F.sequence(F.lit(1), F.greatest(F.length(value) - size + 1, F.lit(1)))
    return F.array_distinct(F.transform(starts, lambda at: F.substr(F.col(value), at, size)))


def _title_grams(title: str, n: int) -> Column:
    """The distinct runs of ``n`` characters of a text at least as long, in time that grows with its length.

    Looking a run up by its place would count the characters before it each time.
    """
    letters = F.split(F.col(title), "")
    runs = letters
    for i in range(1, n):
        # past the end of the text a run is null
        runs = F.zip_with(runs, F.slice(letters, F.lit(i + 1), F.size(letters)), lambda run, letter: F.concat(run, letter))
    return F.array_distinct(F.array_compact(runs))


def matching_terms(titles: DataFrame, terms: DataFrame, gram: int = GRAM) -> DataFrame:
    """``id, term`` of every title of ``titles(id, title)`` that contains a term, case ignored.

    Terms shorter than ``gram`` are their own run, an empty one is in every title. The
    join is on runs, however many terms there are; equal titles are compared once. Null
    titles contain nothing.
    """
    named = titles.select("id", F.lower("title").alias("title")).filter("title is not null")
    # copies of a title may be a third of all rows
    distinct = stored(named.groupBy("title").agg(F.count("*").alias("n")).select("title").withColumn("at", F.monotonically_increasing_id()), "titles")
    size = F.least(F.lit(gram), F.length("term"))
    asked = stored(watched_terms(terms).withColumn("n", size).withColumn("gram", F.explode(_grams("term", F.col("n")))), "term_grams")
    # one length per value up to ``gram``
    lengths = sorted(r["n"] for r in asked.select("n").distinct().collect())
    filed = [
        distinct.filter(F.length("title") >= n).select("at", F.lit(n).alias("n"), F.explode(_title_grams("title", n) if n else F.array(F.lit(""))).alias("gram"))
        for n in lengths
    ]
    if not filed:
        return named.select("id", F.lit("").alias("term")).limit(0)
    filed = stored(reduce(DataFrame.union, filed), "title_grams")
    wanted = asked.select("n", "gram").distinct()
    frequency = filed.join(wanted, ["n", "gram"], "left_semi").groupBy("n", "gram").agg(F.count("*").alias("titles"))
    # a run that no title has rules its term out, so the rarest one may have none
    counted = asked.join(frequency, ["n", "gram"], "left").withColumn("titles", F.coalesce("titles", F.lit(0)))
    rarest = counted.groupBy("term").agg(F.min(F.struct("titles", "gram", "n")).alias("x")).filter("x.titles > 0")
    met = filed.join(rarest.select("term", "x.n", "x.gram"), ["n", "gram"]).select("at", "term")
    found = met.join(distinct, "at").filter(F.contains("title", "term")).select("title", "term")
    return named.join(found, "title").select("id", "term")


def watched_topics(topics: DataFrame, watchlist: DataFrame) -> DataFrame:
    """``run_id, topic_id, in_keywords, in_titles`` of the topics that a watchlist hits.

    Keywords have to equal a term, titles of representative items to contain one.
    """
    terms = stored(watched_terms(watchlist), "watched_terms")
    words = topics.select(*TOPIC, F.explode("top_keywords").alias("word")).withColumn("term", F.lower("word"))
    by_keyword = words.join(terms, "term", "left_semi").select(*TOPIC, F.lit(True).alias("in_keywords"), F.lit(False).alias("in_titles"))
    key = F.struct(*TOPIC)
    titles = topics.select(key.alias("id"), F.explode(F.col("representative_items.title")).alias("title"))
    by_title = matching_terms(titles, terms).select("id.*", F.lit(False).alias("in_keywords"), F.lit(True).alias("in_titles"))
    both = by_keyword.unionByName(by_title)
    return both.groupBy(*TOPIC).agg(F.bool_or("in_keywords").alias("in_keywords"), F.bool_or("in_titles").alias("in_titles"))


def with_watchlist_bonus(topics: DataFrame, watchlist: DataFrame) -> DataFrame:
    """Topics with the column ``watchlist_bonus``."""
    hit = watched_topics(topics, watchlist).select(F.col("run_id").alias("_run"), F.col("topic_id").alias("_topic"), F.lit(score.WATCHLIST_POINTS).alias("_bonus"))
    own = topics.join(hit, F.col("run_id").eqNullSafe(F.col("_run")) & (F.col("topic_id") == F.col("_topic")), "left")
    return own.withColumn("watchlist_bonus", F.coalesce("_bonus", F.lit(0.0))).drop("_run", "_topic", "_bonus")
