"""Score columns: the four parts of a topic's narrative signal and their sum."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Shapes and weights of the score parts.
VOLUME_SLOPE, VOLUME_BASE = 20.0, 20.0
VELOCITY_DECAY_HOURS = 24.0
SOURCE_WEIGHT_POINTS = 60.0
DIVERSITY_SLOPE, DIVERSITY_BASE, DIVERSITY_MAX = 15.0, 15.0, 40.0
WATCHLIST_POINTS = 80.0
PART_WEIGHTS = {"volume_score": 0.25, "velocity_score": 0.35, "source_score": 0.30, "watchlist_bonus": 0.10}


def _clamp(value: Column, high: float = 100.0) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(high), value))


def volume_score(volume: Column) -> Column:
    """Logarithm of the item count, 0 for an empty topic."""
    curve = F.lit(VOLUME_SLOPE) * F.log10(volume.cast("double") + 1) + VOLUME_BASE
    return F.when(volume > 0, _clamp(curve)).otherwise(F.lit(0.0))


def velocity_score(last_seen: Column, as_of: Column) -> Column:
    """Exponential decay with the age of the newest item, 0 if never seen."""
    hours = (F.unix_micros(as_of) - F.unix_micros(last_seen)) / F.lit(3.6e9)
    decay = _clamp(F.exp(-hours / VELOCITY_DECAY_HOURS) * 100)
    return F.when(last_seen.isNull(), F.lit(0.0)).otherwise(decay)


def source_score(avg_source_weight: Column, unique_domains: Column) -> Column:
    """Average feed weight plus, from two domains on, their logarithm."""
    spread = F.lit(DIVERSITY_SLOPE) * F.log10(unique_domains.cast("double")) + DIVERSITY_BASE
    diversity = F.when(unique_domains > 1, _clamp(spread, DIVERSITY_MAX)).otherwise(F.lit(0.0))
    return _clamp(avg_source_weight * SOURCE_WEIGHT_POINTS + diversity)


def watchlist_terms(*lists: Sequence[str] | None) -> list[str]:
    """Union of the watch lists, lower-cased, without repeats."""
    return sorted({term.lower() for terms in lists for term in terms or ()})


def watchlist_bonus(keywords: Column, titles: Column, terms: Sequence[str]) -> Column:
    """Flat bonus when a keyword equals a term or a title contains one."""
    if not terms:
        return F.lit(0.0)
    watched = F.array(*[F.lit(term) for term in terms])
    in_keywords = F.arrays_overlap(F.transform(keywords, F.lower), watched)
    in_titles = F.exists(
        F.transform(titles, F.lower),
        lambda title: F.exists(watched, lambda term: F.contains(title, term)),
    )
    hit = F.coalesce(in_keywords, F.lit(False)) | F.coalesce(in_titles, F.lit(False))
    return F.when(hit, F.lit(WATCHLIST_POINTS)).otherwise(F.lit(0.0))


def signal_score(parts: dict[str, Column]) -> Column:
    """Weighted sum of the four parts, within 0 to 100, to two decimals."""
    weighted = [parts[name] * weight for name, weight in PART_WEIGHTS.items()]
    total = weighted[0]
    for part in weighted[1:]:
        total = total + part
    return F.round(_clamp(total), 2)
