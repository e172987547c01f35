"""Topic scores and the ranking by score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions import score
from newsloom.operators.watchlist import with_watchlist_bonus


def score_topics(
    topics: DataFrame,
    as_of: Column,
    watchlist_keywords: Sequence[str] | None = None,
    watchlist_tickers: Sequence[str] | None = None,
    watchlist: DataFrame | None = None,
) -> DataFrame:
    """Add ``narrative_signal_score`` (0 to 100) and its ``score_breakdown``.

    Terms come as short lists or, in any number, as a table ``watchlist(term)``.
    """
    terms = score.watchlist_terms(watchlist_keywords, watchlist_tickers)
    bonus = F.lit(0.0)
    if terms:
        titles = F.transform("representative_items", lambda item: item["title"])
        bonus = score.watchlist_bonus(F.col("top_keywords"), titles, terms)
    if watchlist is not None:
        topics = with_watchlist_bonus(topics, watchlist).withColumnRenamed("watchlist_bonus", "_listed")
        bonus = F.greatest(bonus, F.col("_listed"))
    parts = {
        "volume_score": score.volume_score(F.col("topic_volume")),
        "velocity_score": score.velocity_score(F.col("last_seen_at"), as_of),
        "source_score": score.source_score(F.col("avg_source_weight"), F.col("unique_domains")),
        "watchlist_bonus": bonus,
    }
    return topics.withColumns(
        {
            "narrative_signal_score": score.signal_score(parts),
            "score_breakdown": F.struct(*[part.alias(name) for name, part in parts.items()]),
        }
    ).drop("_listed")


def _best_first() -> list[Column]:
    """Best score first, a missing one as 0; ties go to the topic seen first."""
    return [F.desc(F.coalesce("narrative_signal_score", F.lit(0.0))), F.asc("first_pos"), F.asc("topic_id")]


def by_score(topics: DataFrame) -> DataFrame:
    """The topics of one run, best first."""
    return topics.orderBy(*_best_first())


def top_topics(topics: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` best-scored topics."""
    return by_score(topics).limit(k)


def top_topics_per_run(topics: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` best-scored topics of every run, with their ``rank``."""
    order = Window.partitionBy("run_id").orderBy(*_best_first())
    return topics.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
