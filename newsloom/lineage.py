"""Physical hints: stored intermediate tables and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string

# Lookup tables up to this estimated size are broadcast even where the session
# has switched Spark's own threshold off.
SMALL_BYTES = 16 << 20
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def broadcast_if_small(lookup: DataFrame) -> DataFrame:
    """Mark a lookup table for broadcasting when the planner knows it is small.

    The check costs no job; for files it is the planner's estimate, which starts
    from their compressed size. A table of unknown or larger size is left to the
    planner, which then shuffles it or decides at run time.
    """
    size = lookup._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return F.broadcast(lookup) if int(str(size)) <= SMALL_BYTES else lookup


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; a
    cluster must name one that all its machines share.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="newsloom-"))
    return context.getCheckpointDir()


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Lost executors cannot take the result with them, later readers load only the
    columns they need, and the planner knows the table's true size.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"
    # what was shuffled for the table is of no use once it is written
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    table = spark.read.schema(df.schema).parquet(path)
    table._stored_at = path
    return table


def stored_once(df: DataFrame, label: str) -> DataFrame:
    """``df`` itself where :func:`stored` returned it, so that no table is copied unchanged; else stored."""
    return df if "_stored_at" in vars(df) else stored(df, label)


def empty(spark: SparkSession, schema: str) -> DataFrame:
    """No rows of a schema, known to the planner to be none."""
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in _parse_datatype_string(schema).fields]
    return spark.range(1).filter(F.lit(False)).select(*columns)


def discard(*tables: DataFrame) -> None:
    """Delete tables that :func:`stored` returned and that nothing reads any more."""
    for table in tables:
        jvm = table.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(table._stored_at)
        path.getFileSystem(table.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
