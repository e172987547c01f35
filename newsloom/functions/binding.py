"""Using a computed column several times while computing it once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def matched_groups(text: Column, pattern: str, n: int) -> Column:
    """All ``n`` groups of a pattern that covers the whole text, from one match.

    The result has one element when the text does not match. Groups must not
    contain line breaks.
    """
    joined = F.regexp_replace(text, pattern, "\n".join(f"${i}" for i in range(1, n + 1)))
    return F.split(joined, "\n")
