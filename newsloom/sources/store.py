"""Stored runs: four tables in one folder, partitioned by run or kept as indexed files."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, TimestampType, _parse_datatype_string

from newsloom.functions.times import format_stored
from newsloom.lineage import stored, stored_once
from newsloom.operators import upsert
from newsloom.schemas import INDEXED, KEYS, REPLACED, TABLES
from newsloom.sources.keyed import KeyedTable, WriteConflict

FORMATS = ("parquet", "json", "files")
# A write that meets another one starts again from the other's version, this often.
ATTEMPTS = 10
# Up to this many runs in one write become values of the plan, so that only their
# partitions are read; more are looked up by a join.
RUNS_AS_VALUES = 1000


def timestamps_as_text(df: DataFrame) -> DataFrame:
    """Timestamps in the form JSON files hold them, also inside arrays of structs."""

    def shown(value: F.Column, kind: object) -> F.Column:
        if isinstance(kind, TimestampType):
            return format_stored(value)
        if isinstance(kind, ArrayType) and isinstance(kind.elementType, StructType):
            fields = kind.elementType.fields
            return F.transform(value, lambda e: F.struct(*[shown(e[f.name], f.dataType).alias(f.name) for f in fields]))
        return value

    return df.select(*[shown(F.col(f.name), f.dataType).alias(f.name) for f in df.schema.fields])


def _write_json(df: DataFrame, path: str, mode: str) -> None:
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def _best_first() -> list[F.Column]:
    return [F.desc(F.coalesce("narrative_signal_score", F.lit(0.0))), F.asc("topic_id")]


def _topic_array(best: DataFrame) -> F.Column:
    """A group of a few topics, as :func:`timestamps_as_text` shows them, as one JSON array, best first."""
    rendered = F.to_json(F.struct(*best.columns), {"ignoreNullFields": "false"})
    order = -F.coalesce("narrative_signal_score", F.lit(0.0))
    ranked = F.array_sort(F.collect_list(F.struct(order.alias("order"), "topic_id", rendered.alias("topic"))))
    return F.concat(F.lit("["), F.array_join(F.transform(ranked, lambda row: row["topic"]), ", "), F.lit("]"))


def export_run(items: DataFrame, topics: DataFrame, path: str, top_k: int = 10) -> None:
    """One run for people: ``items`` as JSON lines, its ``top_k`` best topics as one JSON array.

    The array is one row of text, so it is cut here and not left to the caller.
    """
    _write_json(timestamps_as_text(items), f"{path}/items", "overwrite")
    best = timestamps_as_text(topics.orderBy(*_best_first()).limit(top_k))
    best.agg(_topic_array(best).alias("value")).write.mode("overwrite").text(f"{path}/topics")


def export_runs(items: DataFrame, topics: DataFrame, path: str, top_k: int = 10) -> None:
    """Many runs for people, each in folders ``run_id=...`` of ``items`` and ``topics``, in one job each.

    Items are dealt by (run, item), so a run is in few files and a run with a third of
    all items in many. Topics are cut to ``top_k`` per run before they meet. A run
    without topics has no array; a null ``run_id`` gets Spark's default folder.
    """
    dealt = timestamps_as_text(items).repartitionByRange("run_id", "item_id")
    dealt.write.mode("overwrite").option("ignoreNullFields", "false").partitionBy("run_id").json(f"{path}/items")
    rank = F.row_number().over(Window.partitionBy("run_id").orderBy(*_best_first()))
    best = timestamps_as_text(topics.withColumn("_rank", rank).filter(F.col("_rank") <= top_k).drop("_rank"))
    arrays = best.groupBy("run_id").agg(_topic_array(best).alias("value"))
    arrays.write.mode("overwrite").partitionBy("run_id").text(f"{path}/topics")


class RunStore:
    """Tables ``runs, items, topics, topic_buckets`` under one folder.

    ``parquet`` is meant for queries, ``json`` (JSON lines) for other readers.
    Every write touches only the partitions of the runs it brings. The merged
    rows are stored beside the table first, so a lost job loses nothing.

    ``files`` keeps the tables as :class:`~newsloom.sources.keyed.KeyedTable`: Parquet
    files with bounds and Bloom filters of keys and looked-up columns. A write replaces
    the files that hold its keys, :meth:`look_up` opens those that may hold the value,
    writers that meet take turns, and small files (a run is one row) are merged.
    ``rows_per_file`` is for this format only.
    """

    def __init__(self, spark: SparkSession, base: str, fmt: str = "parquet", rows_per_file: int = 1_000_000) -> None:
        if fmt not in FORMATS:
            raise ValueError(f"unknown storage format {fmt!r}, expected one of {FORMATS}")
        self.spark, self.base, self.fmt = spark, base.rstrip("/"), fmt
        self.keyed = {
            name: KeyedTable(spark, f"{self.base}/{name}", schema, KEYS[name], INDEXED[name], rows_per_file, rows_per_file // 10)
            for name, schema in TABLES.items()
            if fmt == "files"
        }

    def _path(self, table: str):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.base}/{table}")
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def read(self, table: str) -> DataFrame:
        """A whole table; empty when nothing was written yet."""
        if self.keyed:
            return self.keyed[table].read()
        fs, path = self._path(table)
        if not fs.exists(path):
            return self.spark.createDataFrame([], TABLES[table])
        columns = _parse_datatype_string(TABLES[table]).names
        return self.spark.read.schema(TABLES[table]).format(self.fmt).load(f"{self.base}/{table}").select(*columns)

    def read_items(self, run_id: str) -> DataFrame:
        """Items of one run (only its partition is read)."""
        return self.look_up("items", "run_id", run_id)

    def read_topics(self, run_id: str) -> DataFrame:
        """Topics of one run (only its partition is read)."""
        return self.look_up("topics", "run_id", run_id)

    def look_up(self, table: str, column: str, *values: object) -> DataFrame:
        """The rows with one of a few values of a column.

        With ``files``, keys and the columns of ``newsloom.schemas.INDEXED`` open only
        files that may hold a value; otherwise ``run_id`` reads its partitions and any
        other column the whole table.
        """
        if self.keyed and column in self.keyed[table].indexed:
            return self.keyed[table].look_up(column, values)
        return self.read(table).filter(F.col(column).isin(list(values)))

    @staticmethod
    def _in_turn(write: Callable[..., None], *args: object) -> None:
        """Write again on top of what another writer has just committed."""
        for attempt in range(ATTEMPTS):
            try:
                return write(*args)
            except WriteConflict:
                if attempt + 1 == ATTEMPTS:
                    raise

    def _touched(self, table: str, rows: DataFrame) -> DataFrame:
        """The stored rows of the runs that ``rows`` brings; other partitions are not read."""
        runs = [r[0] for r in rows.select("run_id").distinct().limit(RUNS_AS_VALUES + 1).collect()]
        if len(runs) <= RUNS_AS_VALUES:
            return self.read(table).filter(F.col("run_id").isin(runs))
        return self.read(table).join(rows.select("run_id").distinct(), "run_id", "left_semi")

    def _replace(self, table: str, rows: DataFrame) -> None:
        rows = stored(rows, table)
        if self.fmt == "json":
            rows = timestamps_as_text(rows)
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id")
        if self.fmt == "json":
            writer = writer.option("ignoreNullFields", "false")
        writer.format(self.fmt).save(f"{self.base}/{table}")

    def _upsert(self, table: str, rows: DataFrame) -> None:
        columns = _parse_datatype_string(TABLES[table]).names
        rows = stored(rows.select(*columns), table)
        if rows.isEmpty():
            return
        if self.keyed:
            return self._in_turn(self.keyed[table].upsert, rows, REPLACED[table])
        merged = upsert.merge_upsert(self._touched(table, rows).select(*columns), rows, KEYS[table], REPLACED[table])
        self._replace(table, merged)

    def save_run(self, run: DataFrame) -> None:
        """Add runs; a known run takes the new status and statistics."""
        self._upsert("runs", run)

    def save_items(self, items: DataFrame) -> None:
        """Append the items that are not stored yet."""
        columns = _parse_datatype_string(TABLES["items"]).names
        order = [F.col("seq")] if "seq" in items.columns else []
        if self.keyed:
            return self._in_turn(self.keyed["items"].insert_new, stored_once(items, "items"), *order)
        known = self._touched("items", items.select("run_id"))
        fresh = stored(upsert.new_rows(known, items, KEYS["items"], *order).select(*columns), "items")
        if fresh.isEmpty():
            return
        out = timestamps_as_text(fresh) if self.fmt == "json" else fresh
        writer = out.write.mode("append").partitionBy("run_id").format(self.fmt)
        (writer.option("ignoreNullFields", "false") if self.fmt == "json" else writer).save(f"{self.base}/items")

    def save_topics(self, topics: DataFrame) -> DataFrame:
        """Upsert topics and their buckets; returns the signatures that collided.

        Of several topics with one signature in a run the best-scored one stays.
        """
        topics = stored_once(topics, "topics")
        score = -F.coalesce("narrative_signal_score", F.lit(0.0))
        unique = stored(upsert.one_per_key(topics, KEYS["topics"], score, F.col("topic_id")), "topics")
        self._upsert("topics", unique)
        self._upsert("topic_buckets", upsert.flat_buckets(unique))
        return upsert.repeated_keys(topics, KEYS["topics"])

    def purge(self, run_ids: Iterable[str]) -> None:
        """Drop whole runs from all four tables, partition by partition or file by file."""
        if self.keyed:
            dropped = list(run_ids)
            for table in self.keyed.values():
                self._in_turn(table.delete, "run_id", dropped)
            return
        escape = self.spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
        for run_id in run_ids:
            for table in TABLES:
                # folders carry the id as Spark writes it; Path reads no escapes
                fs, path = self._path(f"{table}/run_id={escape(run_id)}")
                fs.delete(path, True)


def flat_columns(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, for sinks that know plain columns only."""
    nested = (ArrayType, MapType, StructType)
    return df.select(
        *[F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name) for f in df.schema.fields]
    )


def save_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", **properties: str) -> None:
    """Write a table to a database; nested columns become JSON text."""
    flat_columns(df).write.jdbc(url, table, mode=mode, properties=properties)


def load_jdbc(spark: SparkSession, url: str, table: str, **properties: str) -> DataFrame:
    """Read a table of a database."""
    return spark.read.jdbc(url, table, properties=properties)
