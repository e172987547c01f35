"""Keyed writes as joins: upsert, insert-ignore, purge and reference checks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.times import bucket_instant
from newsloom.lineage import broadcast_if_small, stored


def one_per_key(rows: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """The first row of each key in the given order of ascending columns."""
    first = F.min_by(F.struct(*[c for c in rows.columns if c not in keys]), F.struct(*order))
    return rows.groupBy(*keys).agg(first.alias("_row")).select(*keys, "_row.*").select(*rows.columns)


def repeated_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter(F.col("n_rows") > 1)


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], replaced: Sequence[str]) -> DataFrame:
    """Target after the source was written on top of it.

    New keys are added as they are. For a known key only the ``replaced`` columns
    take the source's value, nulls included. Keys must be unique on both sides.
    """
    rest = [c for c in target.columns if c not in keys]
    old = target.select(*keys, F.struct(*rest).alias("_old"))
    new = source.select(*keys, F.struct(*rest).alias("_new"))

    def merged(column: str) -> Column:
        first, second = ("_new", "_old") if column in replaced else ("_old", "_new")
        value = F.when(F.col(first).isNotNull(), F.col(first)[column]).otherwise(F.col(second)[column])
        return value.alias(column)

    values = {c: merged(c) for c in rest}
    return old.join(new, [*keys], "full_outer").select(*[values.get(c, F.col(c)) for c in target.columns])


def new_rows(target: DataFrame, source: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """The first source row, in the given order, of each key the target does not have yet."""
    fresh = source.join(target.select(*keys), [*keys], "left_anti").select(*source.columns)
    return one_per_key(fresh, keys, *order) if order else fresh.dropDuplicates([*keys])


def first_rows(rows: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """The first row of each key of stored rows, as :func:`one_per_key` has it; without ``order`` any one row.

    Keys are counted without the other columns. Rows whose key occurs once, mostly all
    of them, then stay where they are, and only rows of repeated keys are shuffled.
    """
    repeated = stored(repeated_keys(rows.select(*keys), keys).select(*[F.col(k).alias(f"_{k}") for k in keys]), "repeated")
    if repeated.isEmpty():
        return rows
    # keys may be null, and null keys are one key
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    known = broadcast_if_small(repeated)
    several = rows.join(known, same, "left_semi")
    first = one_per_key(several, keys, *order) if order else several.dropDuplicates([*keys])
    return rows.join(known, same, "left_anti").unionByName(first)


def insert_ignore(target: DataFrame, source: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """Target plus the first source row of each new key; known keys stay untouched."""
    return target.unionByName(new_rows(target, source, keys, *order).select(*target.columns))


def without_runs(table: DataFrame, purged: DataFrame) -> DataFrame:
    """A table without the rows of the purged runs (``purged`` has ``run_id``)."""
    return table.join(purged.select("run_id"), "run_id", "left_anti").select(*table.columns)


def fk_violations(child: DataFrame, parent: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Child rows that refer to no parent row."""
    return child.join(parent.select(*keys), [*keys], "left_anti").select(*child.columns)


def flat_buckets(topics: DataFrame) -> DataFrame:
    """Nested bucket counts as rows of the topic bucket table."""
    return topics.select("run_id", "topic_signature", F.inline("counts_by_bucket")).select(
        "run_id", "topic_signature", bucket_instant(F.col("bucket_start")).alias("bucket_start"), "count"
    )
