"""Token ids in patched frame-of-reference blocks.

Layout of a file, integers little-endian:

* blocks: minimum (u32), bit width (u8), exceptions (u16), packed differences,
  then exception places (u16) and values (u32);
* documents: id (i64), null flag (u8), number of ids (u64), each as one array;
* index: the start of each block (u64);
* end: number of documents, of ids, of blocks (u64), block size (u32), magic.

What is only known at the end stands there, so blocks are written as they are made.

A block subtracts its minimum and packs the differences at the width that most of
them need; the others are stored whole in the exception list.
"""

from __future__ import annotations

import math
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from newsloom.lineage import stored
from newsloom.llm.files import NewFile, Ranges, shared_folder
from newsloom.llm.words import slices, words_of

MAGIC = b"PFORTOK2"
_END = "<QQQI8s"
_BLOCK = "<IBH"


@dataclass(frozen=True)
class PackedBlocks:
    """Ids per block (at most 65,535), the percentile that sets a block's width, and about how
    many bytes of text go into one file."""

    block: int = 1024
    percentile: float = 90.0
    file_bytes: int = 128 << 20


def encode_blocks(ids: np.ndarray, how: PackedBlocks) -> list[bytes]:
    """One byte string per block of ids."""
    out: list[bytes] = []
    for at in range(0, len(ids), how.block):
        part = ids[at : at + how.block].astype(np.int64)
        least = int(part.min())
        rest = part - least
        # frexp gives the bit length of whole numbers
        lengths = np.frexp(rest)[1]
        rank = max(math.ceil(len(part) * how.percentile / 100), 1) - 1
        width = int(np.partition(lengths, rank)[rank])
        over = np.flatnonzero(lengths > width)
        low = rest.astype("<u4")
        low[over] = 0
        bits = np.unpackbits(low.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :width]
        packed = np.packbits(bits, axis=None, bitorder="little").tobytes()
        exceptions = over.astype("<u2").tobytes() + rest[over].astype("<u4").tobytes()
        out.append(struct.pack(_BLOCK, least, width, len(over)) + packed + exceptions)
    return out


def decode_block(data: bytes, n: int) -> np.ndarray:
    """The ``n`` ids of one block."""
    least, width, n_over = struct.unpack_from(_BLOCK, data)
    at = struct.calcsize(_BLOCK)
    size = (n * width + 7) // 8
    bits = np.zeros((n, 32), np.uint8)
    bits[:, :width] = np.unpackbits(np.frombuffer(data, np.uint8, size, at), bitorder="little")[: n * width].reshape(n, width)
    values = np.packbits(bits, axis=1, bitorder="little").view("<u4").ravel().astype(np.int64)
    at += size
    places = np.frombuffer(data, "<u2", n_over, at)
    values[places] = np.frombuffer(data, "<u4", n_over, at + 2 * n_over)
    return values + least


# Lower-case words that normalisation and splitting leave as they are.
_SETTLED = re.compile("[a-zß-öø-ÿ]+")


_AT_ONCE = 8192


class WordIds:
    """Ids of whole texts from the ids of their distinct parts.

    For tokenizers that fold case, drop white space and split at it and between
    letters and other characters: the ids of a text are then those of its parts one
    after another. Each distinct part is encoded by the library once while its ids
    are held; parts of plain lower-case letters skip the normaliser, which would
    leave them alone.
    """

    def __init__(self, path: str, most: int = 3_000_000):
        self._tokenizer, self._most = Tokenizer.from_file(path), most
        self._settled = Tokenizer(self._tokenizer.model)
        self._settled.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        specials = [x.content for x in self._tokenizer.get_added_tokens_decoder().values()]
        self._specials = pc.ascii_lower(pa.array(specials, pa.string())).to_pylist()
        self._clear()

    def _clear(self) -> None:
        self._hashes = np.zeros(0, np.uint64)
        self._starts, self._lengths = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self._ids = np.zeros(0, np.int32)

    def _add(self, hashes: np.ndarray, parts: list[str]) -> None:
        settled = np.fromiter((_SETTLED.fullmatch(p) is not None for p in parts), bool, len(parts))
        order = np.argsort(~settled, kind="stable")
        n = int(settled.sum())
        ids: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        for tokenizer, some in ((self._settled, order[:n]), (self._tokenizer, order[n:])):
            # the library's results are large while they last
            for at in range(0, len(some), _AT_ONCE):
                batch = [parts[i] for i in some[at : at + _AT_ONCE]]
                encoded = [x.ids for x in tokenizer.encode_batch_fast(batch, add_special_tokens=False)]
                sizes.append(np.fromiter(map(len, encoded), np.int64, len(encoded)))
                ids.append(np.fromiter(chain.from_iterable(encoded), np.int32, int(sizes[-1].sum())))
        lengths = np.concatenate(sizes)
        starts = len(self._ids) + np.cumsum(lengths) - lengths
        self._ids = np.concatenate([self._ids, *ids])
        merged = np.concatenate([self._hashes, hashes[order]])
        by_hash = np.argsort(merged, kind="stable")
        self._hashes = merged[by_hash]
        self._starts = np.concatenate([self._starts, starts])[by_hash]
        self._lengths = np.concatenate([self._lengths, lengths])[by_hash]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the number of ids of each text."""
        if len(self._hashes) > self._most:
            self._clear()
        # special tokens are matched before case is folded, and folding must not make new ones
        lower = pc.ascii_lower(texts)
        plain = not any(pc.any(pc.match_substring(lower, x)).as_py() for x in self._specials)
        words = words_of(texts, fold=plain, cut_stops=plain)
        hashes, firsts, inverse = np.unique(words.hashes, return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self._hashes, hashes), max(len(self._hashes) - 1, 0))
        known = self._hashes[at] == hashes if len(self._hashes) else np.zeros(len(hashes), bool)
        fresh = np.flatnonzero(~known)
        if len(fresh):
            self._add(hashes[fresh], [words.text(firsts[i]) for i in fresh])
        places = np.searchsorted(self._hashes, hashes)[inverse]
        first, lengths = self._starts[places], self._lengths[places]
        total = np.cumsum(lengths)
        ids = self._ids[np.repeat(first - total + lengths, lengths) + np.arange(total[-1] if len(total) else 0)]
        return ids, np.bincount(words.docs, lengths, minlength=words.n_docs).astype(np.int64)


@lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    """One encoder per Python worker: what it holds serves the worker's later tasks too."""
    return WordIds(path)


def with_end(ids: np.ndarray, counts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Append the end id to every text."""
    return np.insert(ids, np.cumsum(counts), end), counts + 1


def write_token_files(documents: DataFrame, tokenizer: str, end: int, how: PackedBlocks | None = None) -> DataFrame:
    """Write the ids of all documents in ascending id order; return the manifest.

    A row of the manifest is one file: ``first, file, n_docs, n_tokens, base``, with
    ``base`` the ids in all files before it. Documents are range-partitioned by id
    and sorted into as many files as their texts' bytes need, each task writes one file as
    it goes, and only sizes of files are summed in one task. Null ids come first; rows that repeat an id are ordered by text.
    """
    how = how or PackedBlocks()
    spark = documents.sparkSession
    folder = shared_folder(spark, "tokens")
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / how.file_bytes))
    ordered = rows.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_ids(tokenizer)
        names: list[pa.Array] = []
        sizes: list[np.ndarray] = []
        starts: list[int] = []
        left = np.zeros(0, np.int32)
        file = None
        for batch in batches:
            for part in slices(batch, most_bytes=3 << 20):
                if file is None:
                    file = NewFile(folder, f"part-{TaskContext.get().partitionId():05d}", ".tok")
                ids, counts = with_end(*encode.encode(part.column("text")), end)
                names.append(part.column("doc_id"))
                sizes.append(counts)
                left = np.concatenate([left, ids])
                whole = len(left) // how.block * how.block
                starts += map(file.append, encode_blocks(left[:whole], how))
                left = left[whole:]
        if file is None:
            return
        starts += map(file.append, encode_blocks(left, how))
        keys, counts = pa.concat_arrays(names), np.concatenate(sizes)
        n_ids = int(counts.sum())
        file.append(np.asarray(keys.fill_null(0)).astype("<i8").tobytes())
        file.append(np.asarray(keys.is_null().cast(pa.uint8())).tobytes())
        file.append(counts.astype("<u8").tobytes())
        file.append(np.asarray(starts, "<u8").tobytes())
        file.append(struct.pack(_END, len(keys), n_ids, len(starts), how.block, MAGIC))
        file.close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([file.uri]), pa.array([file.size]), pa.array([len(keys)]), pa.array([n_ids])],
            ["part", "file", "file_bytes", "n_docs", "n_tokens"],
        )

    manifest = stored(ordered.mapInArrow(write, "part long, file string, file_bytes long, n_docs long, n_tokens long"), "token-files")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def _dealt_files(manifest: DataFrame) -> DataFrame:
    n = max(int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")), manifest.count())
    return manifest.select("file", "file_bytes", "base").repartition(n, "file")


def _stretches(batches: Iterator[pa.RecordBatch], group: int) -> Iterator[pa.RecordBatch]:
    ranges = Ranges()
    for batch in batches:
        for row in batch.to_pylist():
            yield from _documents(ranges, row["file"], row["file_bytes"], row["base"], group)
    ranges.close()


def read_token_files(manifest: DataFrame, group: int = 256) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document, from the files alone.

    Blocks are found by the index and read ``group`` at a time.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _stretches(batches, group)

    return _dealt_files(manifest).mapInArrow(read, "doc_id long, start long, n_tokens long, ids array<int>")


def read_digests(manifest: DataFrame, group: int = 256) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32``: as ``read_token_files``, with the crc32 of the ids in their place."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return (ids_crc32(part) for part in _stretches(batches, group))

    return _dealt_files(manifest).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def ids_crc32(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Replace ``ids`` by the unsigned crc32 of the ids as little-endian 32-bit integers."""
    lists = batch.column("ids")
    values = np.asarray(lists.flatten()).astype("<u4")
    ends = np.cumsum(np.asarray(lists.value_lengths().fill_null(0)))
    sums = [zlib.crc32(x.tobytes()) for x in np.split(values, ends[:-1])] if batch.num_rows else []
    kept = [c for c in batch.schema.names if c != "ids"]
    return pa.RecordBatch.from_arrays([*map(batch.column, kept), pa.array(sums, pa.int64())], [*kept, "ids_crc32"])


def _documents(ranges: Ranges, uri: str, size: int, base: int, group: int) -> Iterator[pa.RecordBatch]:
    tail = struct.calcsize(_END)
    n_docs, n_ids, n_blocks, block, magic = struct.unpack(_END, ranges.read(uri, size - tail, tail))
    if magic != MAGIC:
        raise ValueError(f"{uri} is not a token file")
    length = 17 * n_docs + 8 * n_blocks
    tables = ranges.read(uri, size - tail - length, length)
    keys, nulls = np.frombuffer(tables, "<i8", n_docs), np.frombuffer(tables, np.uint8, n_docs, 8 * n_docs).astype(bool)
    counts = np.frombuffer(tables, "<u8", n_docs, 9 * n_docs).astype(np.int64)
    starts = np.append(np.frombuffer(tables, "<u8", n_blocks, 17 * n_docs), size - tail - length).astype(np.int64)
    ends = np.cumsum(counts)
    left, at, doc = np.zeros(0, np.int64), 0, 0
    for first in range(0, n_blocks, group):
        last = min(first + group, n_blocks)
        data = ranges.read(uri, int(starts[first]), int(starts[last] - starts[first]))
        parts = [left]
        for k in range(first, last):
            own = data[starts[k] - starts[first] : starts[k + 1] - starts[first]]
            parts.append(decode_block(own, min(block, n_ids - k * block)))
        left = np.concatenate(parts)
        done = int(np.searchsorted(ends, at + len(left), side="right"))
        if done > doc:
            taken = int(ends[done - 1]) - at
            offsets = np.concatenate([[0], np.cumsum(counts[doc:done])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(left[:taken].astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[doc:done], mask=nulls[doc:done]), pa.array(base + at + offsets[:-1].astype(np.int64)), pa.array(counts[doc:done]), lists],
                ["doc_id", "start", "n_tokens", "ids"],
            )
            left, at, doc = left[taken:], at + taken, done
