"""Topic keywords by class-based TF-IDF.

Topics are those of one run: a row is one (run, topic), and totals and averages are
taken inside each run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions import text
from newsloom.lineage import broadcast_if_small, stored
from newsloom.operators.topics import TOPIC, without_noise

# Keywords kept per topic.
KEYWORDS_PER_TOPIC = 15


def term_counts(items: DataFrame) -> DataFrame:
    """How often each term occurs in each topic: ``run_id, topic_id, term, n``.

    Terms are counted inside each map task first, so what is shuffled is at most
    one row per (task, run, topic, term), whatever the size of a topic.
    """
    words = F.explode(text.tokens(text.document_text(F.col("title"), F.col("summary"))))
    found = without_noise(items).select(*TOPIC, words.alias("term"))
    return found.groupBy(*TOPIC, "term").agg(F.count("*").alias("n"))


def corpus_terms(counts: DataFrame) -> DataFrame:
    """How often each term occurs in all topics of a run together: ``run_id, term, total``."""
    return counts.groupBy("run_id", "term").agg(F.sum("n").alias("total"))


def topic_words(counts: DataFrame) -> DataFrame:
    """How many words each topic has: ``run_id, topic_id, words``, stored because weights and scores read it."""
    return stored(counts.groupBy(*TOPIC).agg(F.sum("n").alias("words")), "topic_words")


def weighted_terms(counts: DataFrame, words: DataFrame | None = None) -> DataFrame:
    """``run_id, topic_id, term, n, weight`` with weight = n · ln(1 + A / total).

    ``A`` is the average number of words per topic of the run, rounded down. The
    class-based TF-IDF of a term is this weight over the words in its topic.
    ``words`` is :func:`topic_words` of the same counts.
    """
    # two steps, so that a run is not gathered before it is one row per topic
    words = topic_words(counts) if words is None else words
    averages = words.groupBy("run_id").agg(F.floor(F.sum("words") / F.count("*")).alias("average"))
    # a term is in few rows of a run, at most one per topic: they meet once and take their sum with them
    total = F.sum("n").over(Window.partitionBy("run_id", "term"))
    weighed = counts.withColumn("total", total).join(broadcast_if_small(averages), "run_id")
    return weighed.select(*TOPIC, "term", "n", (F.col("n") * F.log1p(F.col("average") / F.col("total"))).alias("weight"))


def ranked_keywords(counts: DataFrame, top_n: int = KEYWORDS_PER_TOPIC) -> DataFrame:
    """The ``top_n`` terms per topic: ``run_id, topic_id, term, rank, score``.

    ``counts`` is read several times and should be stored. Inside one topic the
    weight orders terms as the score does, so the division by the topic's word
    count waits until only ``top_n`` rows per topic are left.
    """
    order = Window.partitionBy(*TOPIC).orderBy(F.desc("weight"), F.asc("term"))
    words = topic_words(counts)
    best = weighted_terms(counts, words).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top_n)
    return best.join(words, [*TOPIC]).select(*TOPIC, "term", "rank", (F.col("weight") / F.col("words")).alias("score"))


def topic_keywords(items: DataFrame, top_n: int = KEYWORDS_PER_TOPIC) -> DataFrame:
    """``run_id, topic_id, keywords``: the best terms of each topic, best first.

    The counts are stored once, because weights, totals and sizes all read them.
    """
    return listed_keywords(stored(term_counts(items), "term_counts"), top_n)


def moved_counts(counts: DataFrame, moves: DataFrame) -> DataFrame:
    """The counts of :func:`term_counts` after topics got the ids of ``moves(topic_id, new_id)``; the others keep theirs.

    Terms are added up per topic, so the texts are not cut into terms again.
    """
    moved = counts.join(broadcast_if_small(moves), "topic_id", "left").withColumn("topic_id", F.coalesce("new_id", "topic_id"))
    return moved.groupBy(*TOPIC, "term").agg(F.sum("n").alias("n"))


def listed_keywords(counts: DataFrame, top_n: int = KEYWORDS_PER_TOPIC) -> DataFrame:
    """:func:`topic_keywords` from stored counts."""
    ranked = ranked_keywords(counts, top_n)
    listed = F.array_sort(F.collect_list(F.struct("rank", "term")))
    return ranked.groupBy(*TOPIC).agg(F.transform(listed, lambda row: row["term"]).alias("keywords"))


def reduce_topics(counts: DataFrame, nr_topics: int, volumes: DataFrame | None = None) -> DataFrame:
    """Map the topics of one run onto the ``nr_topics`` largest: ``topic_id, merged_id``.

    The topics with the most items stay (``volumes`` has ``topic_id, volume``; without
    it, those with the most words). Every other one joins the staying topic
    with the greatest cosine between their class-based TF-IDF rows (ties go to
    the lower id). Only the terms of the staying topics are paired, at most
    ``nr_topics`` per term. ``counts`` is read several times and should be stored.
    """
    sizes = counts.groupBy("topic_id").agg(F.sum("n").alias("words"))
    ranked = volumes.select("topic_id", F.col("volume").alias("words")) if volumes is not None else sizes
    kept = ranked.orderBy(F.desc("words"), F.asc("topic_id")).limit(nr_topics).select("topic_id")
    weights = stored(weighted_terms(counts).select("topic_id", "term", "weight"), "term_weights")
    norms = weights.groupBy("topic_id").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
    targets = weights.join(kept, "topic_id", "left_semi").select(
        F.col("topic_id").alias("merged_id"), "term", F.col("weight").alias("kept_weight")
    )
    dots = (
        weights.join(kept, "topic_id", "left_anti")
        .join(targets, "term")
        .groupBy("topic_id", "merged_id")
        .agg(F.sum(F.col("weight") * F.col("kept_weight")).alias("dot"))
    )
    cosine = dots.join(norms.withColumnRenamed("topic_id", "merged_id"), "merged_id").select(
        "topic_id", "merged_id", F.round(F.col("dot") / F.col("norm"), 12).alias("closeness")
    )
    nearest = cosine.groupBy("topic_id").agg(
        F.max(F.struct("closeness", (-F.col("merged_id")).alias("low_id"))).alias("best")
    )
    largest = kept.agg(F.min("topic_id")).scalar()
    return (
        sizes.select("topic_id")
        .join(kept.withColumn("stays", F.lit(True)), "topic_id", "left")
        .join(nearest, "topic_id", "left")
        .select(
            "topic_id",
            F.when(F.col("stays"), F.col("topic_id"))
            .otherwise(F.coalesce(-F.col("best.low_id"), largest))
            .alias("merged_id"),
        )
    )


def _nearest_topics(counts: DataFrame, leaving: DataFrame) -> DataFrame:
    """``topic_id, merged_id``: for each leaving topic the most similar of the others."""
    weights = stored(weighted_terms(counts).select("topic_id", "term", "weight"), "term_weights")
    staying = weights.join(leaving, "topic_id", "left_anti")
    norms = staying.groupBy("topic_id").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
    own = weights.join(leaving, "topic_id", "left_semi").select(F.col("topic_id").alias("leaves"), "term", F.col("weight").alias("own"))
    dots = own.join(staying, "term").groupBy("leaves", "topic_id").agg(F.sum(F.col("own") * F.col("weight")).alias("dot"))
    closeness = F.round(F.col("dot") / F.col("norm"), 12)
    best = dots.join(norms, "topic_id").groupBy("leaves").agg(F.max(F.struct(closeness.alias("closeness"), (-F.col("topic_id")).alias("low_id"))).alias("x"))
    return best.select(F.col("leaves").alias("topic_id"), (-F.col("x.low_id")).alias("merged_id"))


def merge_topics(counts: DataFrame, nr_topics: int, volumes: DataFrame, per_round: int = 32) -> DataFrame:
    """Merge the topics of one run until ``nr_topics`` are left: ``topic_id, merged_id``.

    The smallest topics of a round (by ``volumes(topic_id, volume)``, ties: the higher id
    first) each join the staying topic with the greatest cosine between their class-based
    TF-IDF rows (ties: the lower id); one without a shared term joins the largest. Then
    counts are added up, weights taken anew, and the next round looks for the smallest
    again. With ``per_round`` 1 this is one merge after another. A round pairs the terms
    of at most ``per_round`` topics with those of the others.
    """
    if nr_topics < 1 or per_round < 1:
        raise ValueError("nr_topics and per_round must be positive")
    counts = stored(counts.select("run_id", "topic_id", "term", "n"), "term_counts")
    sizes = stored(volumes.select("topic_id", F.col("volume").cast("long").alias("volume")), "volumes")
    merged = sizes.select("topic_id", F.col("topic_id").alias("merged_id"))
    surplus = sizes.count() - nr_topics
    while surplus > 0:
        some = min(surplus, per_round)
        leaving = stored(sizes.orderBy("volume", F.desc("topic_id")).limit(some).select("topic_id"), "leaving")
        largest = sizes.join(leaving, "topic_id", "left_anti").orderBy(F.desc("volume"), "topic_id").limit(1)
        nearest = leaving.join(_nearest_topics(counts, leaving), "topic_id", "left")
        fallback = largest.select(F.col("topic_id").alias("_largest"))
        # at most ``per_round`` rows, and the one largest topic
        step = nearest.join(F.broadcast(fallback)).select(F.col("topic_id").alias("_from"), F.coalesce("merged_id", "_largest").alias("_to"))
        step = F.broadcast(stored(step, "merge_step"))

        def moved(df: DataFrame, column: str, step: DataFrame = step) -> DataFrame:
            return df.join(step, F.col(column) == F.col("_from"), "left").withColumn(column, F.coalesce("_to", column)).drop("_from", "_to")

        counts = stored(moved(counts, "topic_id").groupBy("run_id", "topic_id", "term").agg(F.sum("n").alias("n")), "term_counts")
        sizes = stored(moved(sizes, "topic_id").groupBy("topic_id").agg(F.sum("volume").alias("volume")), "volumes")
        merged = stored(moved(merged, "merged_id"), "merged")
        surplus -= some
    return merged.select("topic_id", "merged_id")
