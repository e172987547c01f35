"""Keyed tables whose writes touch files and whose look-ups skip them.

A table is a list of Parquet files, its manifest. Beside each file the manifest holds,
for every indexed column, the least and greatest value and a Bloom filter of all values.

* A look-up asks the manifest first and opens only files that may hold a value.
* An upsert finds the files that do hold one of its keys and writes these anew; all
  others stay as they are, names included. New keys go to new files.
* A write counts from the moment its version is created, in one step that fails if
  somebody else was faster. What a killed write leaves behind no version names.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string

from newsloom.lineage import empty, stored, stored_once
from newsloom.operators import upsert
from newsloom.shipping import add_package

HASHES = 7
BITS_PER_ROW = 10
# Up to this many keys of a write are looked up in the filters first.
FILTERED_KEYS = 10_000
_INDEX = "file string, indexed string, least string, greatest string, bits binary, n_rows long"


class WriteConflict(RuntimeError):
    """Another write has created the next version first."""


def _places(first: np.ndarray, second: np.ndarray, size: int) -> np.ndarray:
    """The bits of values, from two hashes each."""
    steps = np.arange(HASHES, dtype=np.uint64)
    with np.errstate(over="ignore"):
        return (first.view(np.uint64)[:, None] + steps * (second.view(np.uint64) | np.uint64(1))[:, None]) % np.uint64(size)


def _n_bits(n_rows: int) -> int:
    """The size of a filter of so many values, a power of two."""
    return 1 << max(6, (BITS_PER_ROW * n_rows - 1).bit_length())


def _joined_bits(parts: list[np.ndarray], size: int) -> np.ndarray:
    """One filter of at most ``size`` bytes that holds all values of filters of any sizes.

    Sizes are powers of two, so a value's place in a smaller filter is its place in a
    larger one modulo the smaller size.
    """
    longest = max(len(part) for part in parts)
    whole = np.bitwise_or.reduce([np.tile(part, longest // len(part)) for part in parts])
    return np.bitwise_or.reduce(whole.reshape(-1, size), axis=0) if size < longest else whole


def _hashes(column: str) -> tuple[F.Column, F.Column]:
    value = F.col(column).cast("string")
    return F.xxhash64(value), F.xxhash64(value, F.lit(1))


class KeyedTable:
    """A table under ``base`` with unique ``keys``; ``indexed`` columns can be looked up.

    ``rows_per_file`` bounds files and with them the filters. Values are indexed as the
    text that Spark casts them to. Files with fewer than ``merge_below`` rows join the
    next write, so many small writes do not leave many small files.
    """

    def __init__(
        self, spark: SparkSession, base: str, schema: str, keys: Sequence[str], indexed: Sequence[str] = (),
        rows_per_file: int = 1_000_000, merge_below: int = 0,
    ):
        add_package(spark)
        self.spark, self.base, self.schema, self.keys = spark, base.rstrip("/"), schema, list(keys)
        self.columns = _parse_datatype_string(schema).names
        self.indexed, self.rows_per_file = list(dict.fromkeys([*keys, *indexed])), rows_per_file
        self.merge_below = merge_below

    # ---- versions

    def _fs(self):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.base}/versions")
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def version(self) -> int:
        """The number of the last write that counts; 0 before the first."""
        fs, path = self._fs()
        if not fs.exists(path):
            return 0
        return max((int(x.getPath().getName().split("-")[0]) for x in fs.listStatus(path) if not x.getPath().getName().startswith((".", "_"))), default=0)

    def _manifest(self, version: int) -> DataFrame:
        if not version:
            return empty(self.spark, _INDEX)
        fs, path = self._fs()
        jvm = self.spark.sparkContext._jvm
        stream = fs.open(jvm.org.apache.hadoop.fs.Path(path, f"{version:012d}-v"))
        try:
            name = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return self.spark.read.schema(_INDEX).parquet(f"{self.base}/manifests/{name}")

    def _commit(self, manifest: DataFrame, version: int) -> None:
        name = uuid.uuid4().hex
        manifest.write.parquet(f"{self.base}/manifests/{name}")
        fs, path = self._fs()
        fs.mkdirs(path)
        context = self.spark.sparkContext
        hadoop = context._jvm.org.apache.hadoop.fs
        draft, target = hadoop.Path(path, f".{name}"), hadoop.Path(path, f"{version:012d}-v")
        stream = fs.create(draft, False)
        stream.write(bytearray(name.encode()))
        stream.close()
        # a rename that overwrites nothing is the one step that makes a version
        kind = getattr(hadoop, "Options$Rename")
        how = context._gateway.new_array(kind, 1)
        how[0] = kind.NONE
        try:
            hadoop.FileContext.getFileContext(fs.getUri(), context._jsc.hadoopConfiguration()).rename(fs.makeQualified(draft), fs.makeQualified(target), how)
        except Exception as error:
            raise WriteConflict(f"version {version} of {self.base} exists") from error

    # ---- reading

    def files(self, version: int | None = None) -> list[str]:
        """The files of a version, in order."""
        rows = self._manifest(self.version() if version is None else version).select("file").distinct().collect()
        return sorted(r["file"] for r in rows)

    def _open(self, files: list[str]) -> DataFrame:
        if not files:
            return empty(self.spark, self.schema)
        return self.spark.read.schema(self.schema).parquet(*files)

    def read(self, version: int | None = None) -> DataFrame:
        return self._open(self.files(version))

    def files_with(self, column: str, values: Sequence[object], version: int | None = None) -> list[str]:
        """The files that may hold one of a few values of an indexed column."""
        if column not in self.indexed:
            raise ValueError(f"{column} is not indexed")
        texts = sorted({str(v) for v in values if v is not None})
        if not texts:
            return []
        asked = self.spark.createDataFrame([(t,) for t in texts], "value string")
        asked = asked.select("value", *[x.alias(k) for k, x in zip("ab", _hashes("value"), strict=True)]).toArrow()
        names, first, second = asked.column("value").to_pylist(), asked.column("a").to_numpy(), asked.column("b").to_numpy()

        def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            places: dict[int, np.ndarray] = {}
            for batch in batches:
                found = []
                for file, low, high, bits in zip(*(batch.column(c).to_pylist() for c in ("file", "least", "greatest", "bits")), strict=True):
                    own = np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little")
                    if len(own) not in places:
                        places[len(own)] = _places(first, second, len(own))
                    hit = own[places[len(own)]].all(axis=1)
                    if any(h and low <= name <= high for h, name in zip(hit.tolist(), names, strict=True)):
                        found.append(file)
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], ["file"])

        index = self._manifest(self.version() if version is None else version).filter((F.col("indexed") == column) & F.col("least").isNotNull())
        return sorted(r["file"] for r in index.mapInArrow(held, "file string").collect())

    def look_up(self, column: str, values: Sequence[object]) -> DataFrame:
        """The rows with one of a few values; files without them are not opened."""
        return self._open(self.files_with(column, values)).filter(F.col(column).isin(list(values)))

    # ---- writing

    def _written(self, rows: DataFrame) -> DataFrame:
        """Write rows to new files, neighbouring keys together; return their manifest rows."""
        folder = f"{self.base}/data/{uuid.uuid4().hex}"
        ordered = rows.select(*self.columns).repartitionByRange(*self.keys).sortWithinPartitions(*self.keys)
        ordered.write.option("maxRecordsPerFile", self.rows_per_file).parquet(folder)
        indexed = self.indexed
        hashed = [x.alias(f"{c}_{k}") for c in indexed for k, x in zip("ab", _hashes(c), strict=True)]
        texts = [F.col(c).cast("string").alias(f"{c}_t") for c in indexed]
        read = self.spark.read.schema(self.schema).parquet(folder).select(F.col("_metadata.file_path").alias("file"), *texts, *hashed)

        def described(file: str, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            held = pa.Table.from_batches(parts)
            rows = []
            for c in indexed:
                known = held.filter(held.column(f"{c}_t").is_valid())
                ends = pc.min_max(known.column(f"{c}_t")).as_py()
                # other tasks may have read more of the file
                bits = np.zeros(_n_bits(4 * held.num_rows), np.uint8)
                bits[_places(*(known.column(f"{c}_{k}").to_numpy() for k in "ab"), len(bits)).ravel()] = 1
                rows.append((file, c, ends["min"], ends["max"], np.packbits(bits, bitorder="little").tobytes(), held.num_rows))
            kinds = [pa.string(), pa.string(), pa.string(), pa.string(), pa.binary(), pa.int64()]
            columns = [pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            return pa.RecordBatch.from_arrays(columns, ["file", "indexed", "least", "greatest", "bits", "n_rows"])

        def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            # a task reads one file after the other and holds what is indexed of one
            current, parts = None, []
            for batch in batches:
                for file in batch.column("file").unique().to_pylist():
                    if file != current and parts:
                        yield described(current, parts)
                        parts = []
                    current = file
                    parts.append(batch.filter(pc.equal(batch.column("file"), file)))
            if parts:
                yield described(current, parts)

        def joined(group: pa.Table) -> pa.Table:
            # a large file may have been read in a few parts
            n_rows = sum(group.column("n_rows").to_pylist())
            bits = _joined_bits([np.frombuffer(x, np.uint8) for x in group.column("bits").to_pylist()], _n_bits(n_rows) // 8)
            low, high = ([v for v in group.column(c).to_pylist() if v is not None] for c in ("least", "greatest"))
            return pa.table({
                "file": group.column("file")[:1], "indexed": group.column("indexed")[:1],
                "least": pa.array([min(low, default=None)], pa.string()), "greatest": pa.array([max(high, default=None)], pa.string()),
                "bits": pa.array([bits.tobytes()], pa.binary()), "n_rows": pa.array([n_rows], pa.int64()),
            })

        return read.mapInArrow(index, _INDEX).groupBy("file", "indexed").applyInArrow(joined, _INDEX)

    def _holding(self, rows: DataFrame, version: int) -> list[str]:
        """The files of a version that hold a key of ``rows``; of the others at most key columns are read."""
        files = self.files(version)
        if not files:
            return []
        if len(rows.select(self.keys[0]).limit(FILTERED_KEYS + 1).collect()) <= FILTERED_KEYS:
            for key in self.keys:
                values = [r[0] for r in rows.select(F.col(key).cast("string")).distinct().collect()]
                files = sorted(set(files) & set(self.files_with(key, values, version)))
        if not files:
            return []
        held = self._open(files).select(*self.keys, F.col("_metadata.file_path").alias("_file"))
        found = held.join(rows.select(*self.keys).distinct(), self.keys, "left_semi").select("_file").distinct().collect()
        return sorted(r["_file"] for r in found)

    def _small(self, version: int) -> list[str]:
        """The files that are to join the next write."""
        if not (self.merge_below and version):
            return []
        small = (F.col("indexed") == self.keys[0]) & (F.col("n_rows") < self.merge_below)
        return sorted(r["file"] for r in self._manifest(version).filter(small).select("file").collect())

    def _replace(self, version: int, files: Sequence[str], rows: DataFrame) -> None:
        """The next version: ``rows`` in new files instead of ``files``."""
        kept = self._manifest(version).filter(~F.col("file").isin(list(files)))
        self._commit(kept.unionByName(self._written(rows)), version + 1)

    def upsert(self, rows: DataFrame, replaced: Sequence[str]) -> None:
        """Add rows; of known keys only the ``replaced`` columns change. Keys are unique and not null."""
        version = self.version()
        rows = stored_once(rows, "upsert").select(*self.columns)
        touched = sorted({*self._holding(rows, version), *self._small(version)})
        merged = upsert.merge_upsert(self._open(touched).select(*self.columns), rows, self.keys, replaced)
        self._replace(version, touched, stored(merged, "upserted"))

    def insert_new(self, rows: DataFrame, *order: F.Column) -> None:
        """Append the first row of each key that is not there yet; only small files are written anew.

        Whole rows are copied only where some of them are known.
        """
        version = self.version()
        rows = stored_once(rows, "insert")
        held = self._holding(rows, version)
        if held:
            rows = stored(rows.join(self._open(held).select(*self.keys), self.keys, "left_anti").select(*rows.columns), "unknown")
        fresh = upsert.first_rows(rows, self.keys, *order).select(*self.columns)
        if not rows.isEmpty():
            small = self._small(version)
            self._replace(version, small, fresh.unionByName(self._open(small).select(*self.columns)))

    def delete(self, column: str, values: Sequence[object]) -> None:
        """Drop the rows with one of a few values of an indexed column; files without them stay."""
        version = self.version()
        held = F.coalesce(F.col(column).isin(list(values)), F.lit(False))
        found = self._open(self.files_with(column, values, version)).filter(held) if version else None
        if found is None or found.isEmpty():
            return
        touched = sorted(r[0] for r in found.select(F.col("_metadata.file_path")).distinct().collect())
        self._replace(version, touched, self._open(touched).filter(~held).select(*self.columns))
