"""Two-phase deduplication: by canonical URL, then by content hash."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The one strategy there is.
STRATEGIES = ("url_then_hash",)
# What a survivor always carries, after the columns that rank it.
RANKED = ("seq", "content_hash")


def _check(strategy: str) -> None:
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown dedupe strategy {strategy!r}, expected one of {STRATEGIES}")


def _best(order: str, carried: Sequence[str]) -> Column:
    """Greatest weight, then newest, then first in ``order``; carries the rest along."""
    early = (-F.col(order)).alias("early")
    ranked = ("source_weight", "published_at", early, *RANKED)
    return F.max(F.struct(*ranked, *[c for c in carried if c not in (*RANKED, *ranked[:2])])).alias("best")


def survivors(items: DataFrame, strategy: str = "url_then_hash", carried: Sequence[str] = ()) -> DataFrame:
    """Narrow result of the deduplication: one row per item that stays.

    Columns: ``seq`` of the survivor, ``pos`` (its place among the survivors),
    ``n_items`` and ``n_urls`` (how many items and distinct URLs it stands for),
    and the ``carried`` columns of the survivor.

    ``items`` needs ``seq`` (unique, the input order), ``canonical_url``,
    ``content_hash``, ``source_weight`` and ``published_at``. Both phases are
    grouped maxima over short columns, combined before each shuffle, so a URL or
    a text that a third of the items share sends one row per map task.

    A replaced item keeps the place of the first item with its key. The first
    place of a URL therefore decides ties between contents, and the first place
    of a content is the survivor's ``pos``.
    """
    _check(strategy)
    always = ("source_weight", "published_at", *RANKED)
    winner = [f"best.{c}" for c in (*always, *[c for c in carried if c not in always])]
    by_url = items.groupBy("canonical_url").agg(
        _best("seq", carried), F.min("seq").alias("pos"), F.count("*").alias("n_items")
    )
    by_hash = (
        by_url.select(*winner, "pos", "n_items")
        .groupBy("content_hash")
        .agg(
            _best("pos", carried),
            F.min("pos").alias("pos"),
            F.sum("n_items").alias("n_items"),
            F.count("*").alias("n_urls"),
        )
    )
    return by_hash.select("best.seq", "pos", "n_items", "n_urls", *[f"best.{c}" for c in carried])


def deduplicate(items: DataFrame, strategy: str = "url_then_hash") -> DataFrame:
    """The items that stay, with their place ``pos``.

    The winners are found on short columns; titles and summaries move once, to
    meet their winner on the unique ``seq``.
    """
    return items.join(survivors(items, strategy).select("seq", "pos"), "seq")


def deduplicate_narrow(items: DataFrame, strategy: str = "url_then_hash") -> DataFrame:
    """The same for rows without texts: they travel with the maxima, without a join."""
    columns = [c for c in items.columns if c != "seq"]
    return survivors(items, strategy, columns).select("seq", *columns, "pos")


def dedupe_stats(kept: DataFrame) -> DataFrame:
    """One row of counts for the result of :func:`survivors`."""
    return kept.agg(
        F.coalesce(F.sum("n_items"), F.lit(0)).alias("original_count"),
        F.coalesce(F.sum(F.col("n_items") - F.col("n_urls")), F.lit(0)).alias("duplicates_by_url"),
        F.coalesce(F.sum(F.col("n_urls") - 1), F.lit(0)).alias("duplicates_by_hash"),
        F.count("*").alias("final_count"),
    )
