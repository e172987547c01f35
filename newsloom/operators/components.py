"""Connected components and numbering of large tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsloom.lineage import stored


def _neighbour_minimum(edges: DataFrame) -> DataFrame:
    """Each node with the least of itself and its neighbours."""
    return edges.groupBy("a").agg(F.least("a", F.min("b")).alias("least"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the least of its neighbourhood."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    linked = both.join(_neighbour_minimum(both), "a").filter(F.col("b") > F.col("a"))
    return linked.select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    linked = edges.join(least, "a")
    moved = linked.select(F.col("b").alias("a"), F.col("least").alias("b"))
    own = least.select("a", F.col("least").alias("b"))
    return moved.union(own).filter(F.col("a") > F.col("b")).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of the undirected edges ``a, b``.

    The label is the least node id of the component. Alternating star steps
    (Kiveris et al., "Connected Components in MapReduce and Beyond", 2014) need
    about log² rounds, never more edges than they start with, and move minima
    instead of neighbour lists. Each round is stored. The loop ends when every
    node points at one root and no root points anywhere.
    """
    pairs = edges.filter(F.col("a") != F.col("b"))
    stars = stored(
        pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "component_edges"
    )
    while not _is_star_forest(stars):
        stars = stored(_small_star(_large_star(stars)), "component_edges")
    roots = stars.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("label")).union(roots)


def _is_star_forest(edges: DataFrame) -> bool:
    branching = edges.groupBy("a").count().filter(F.col("count") > 1).select("a")
    roots = edges.select(F.col("b").alias("a"))
    chained = edges.join(roots, "a", "left_semi").select("a")
    return branching.union(chained).isEmpty()


def numbered(df: DataFrame, *order: F.Column, into: str) -> DataFrame:
    """Number all rows from 0 in the given order without gathering them.

    Rows are range-partitioned and sorted; a row's number is its place inside its
    partition plus the sizes of the partitions before it. Only those sizes, one
    per partition, pass through a single task.
    """
    sorted_rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stored(sorted_rows.withColumn("_at", F.monotonically_increasing_id()), "numbered")
    partition = F.shiftrightunsigned("_at", 33)
    before = Window.orderBy("_partition").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(partition.alias("_partition"))
        .agg(F.count("*").alias("_size"))
        .select("_partition", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    )
    place = F.col("_offset") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.withColumn("_partition", partition).join(offsets, "_partition").select(*df.columns, place.alias(into))


def summed_before(df: DataFrame, group: list[str], order: list[str], value: str, into: str) -> DataFrame:
    """Sum of ``value`` over the rows of the same group that come before a row.

    Rows lie in ranges of (group, order), so a group with very many rows is spread
    over many tasks; per range and group one partial sum is added up.
    ``group`` and ``order`` are not null and together unique.
    """
    ranged = df.repartitionByRange(*group, *order).withColumn("_partition", F.spark_partition_id())
    ranged = stored(ranged, "ranges")
    inside = Window.partitionBy("_partition", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(*group).orderBy("_partition").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_partition", *group)
        .agg(F.sum(value).alias("_size"))
        .select("_partition", *group, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    )
    found = ranged.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return found.join(offsets, ["_partition", *group]).select(*df.columns, (F.col("_offset") + F.col("_inside")).alias(into))
