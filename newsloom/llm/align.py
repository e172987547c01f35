"""Alignment of the tokens of two tokenizers over the same bytes.

Both sides tile the bytes of a text. For each token start of one side ``merge_asof``
finds the token of the other side that covers it; both directions together are all
overlapping pairs, since of two overlapping tokens the later start lies in the other
one. Byte offsets where tokens of both sides end cut a text into groups.

Neither tokenizer joins bytes across a blank that follows a visible character, so a
text is cut there and its alignment is that of its chunks one after another. Each
distinct chunk is encoded and aligned once while a worker holds it.

Corpus-wide counts of linked id pairs are a Spark aggregate over the distinct pairs of
blocks of documents; a block's own pairs meet their counts in a shuffle join. What the
documents of a block hold stays in a file of the shared folder meanwhile.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from newsloom.lineage import broadcast_if_small, stored
from newsloom.llm.files import NewFile, Ranges, shared_folder
from newsloom.llm.words import slices

# At a blank that follows a visible character; both tokenizers begin a token there.
_CUT = re.compile(r"(?<=\S)(?= )")
_AT_ONCE = 8192


@dataclass(frozen=True)
class AlignedBlocks:
    """Bytes of text per block, and distinct chunks a worker holds at most."""

    block_bytes: int = 16 << 20
    chunks: int = 400_000


def covering(tokens: pd.DataFrame, others: pd.DataFrame, name: str) -> pd.DataFrame:
    """For every token start the number of the other side's token that covers it.

    Both frames hold ``doc, start`` and the token's number, sorted by ``start``, which
    counts on over the documents of a batch.
    """
    return pd.merge_asof(tokens, others[["doc", "start", name]], on="start", by="doc")


def linked(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
    """All pairs of overlapping tokens, each once: ``doc, start, a, b``, by start.

    ``a`` holds ``doc, start, a`` and ``b`` holds ``doc, start, b``; ``start`` of a link
    is the later one of its tokens.
    """
    both = pd.concat([covering(a, b, "b"), covering(b, a, "a")], ignore_index=True)
    return both.drop_duplicates(["doc", "start"]).sort_values("start", ignore_index=True)


class _Bytes:
    """The bytes of every id of a vocabulary."""

    def __init__(self, entries: list[bytes]):
        self.sizes = np.fromiter(map(len, entries), np.int64, len(entries))
        self._starts = np.cumsum(self.sizes) - self.sizes
        self._data = np.frombuffer(b"".join(entries) or b"\0", np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        sizes = self.sizes[ids]
        total = np.cumsum(sizes)
        return self._data[np.repeat(self._starts[ids] - total + sizes, sizes) + np.arange(total[-1] if len(total) else 0)]


def _byte_level(vocabulary: dict[str, int]) -> list[bytes]:
    """Bytes of the entries of a byte-level vocabulary."""
    # the 256 letters of the byte-level alphabet stand for the bytes: printable ones for
    # themselves, the others in order for the code points from 256 on
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    letters = {chr(b): b for b in own}
    letters |= {chr(256 + k): b for k, b in enumerate(sorted(set(range(256)) - set(own)))}
    assert set(letters) == set(pre_tokenizers.ByteLevel.alphabet())
    entries = [b""] * (max(vocabulary.values()) + 1)
    for entry, i in vocabulary.items():
        # added tokens are not spelled in the alphabet
        entries[i] = bytes(letters[x] for x in entry) if all(x in letters for x in entry) else entry.encode()
    return entries


def _pieces(model: sentencepiece.SentencePieceProcessor) -> list[bytes]:
    return [
        bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode()
        for i in range(model.get_piece_size())
    ]


@dataclass
class ChunkAlignment:
    """Tokens, group ends and links of a batch of chunks; numbers count over the batch."""

    a_ids: np.ndarray
    b_ids: np.ndarray
    a_docs: np.ndarray
    b_docs: np.ndarray
    a_ends: np.ndarray
    b_ends: np.ndarray
    group_ends: np.ndarray
    link_docs: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray
    good: np.ndarray
    """Whether the tokens of both sides join to the bytes of the chunk."""


class Aligner:
    """Encodes with both tokenizers and aligns; holds what it knows of distinct chunks."""

    def __init__(self, path_a: str, path_b: str, most: int):
        self._a = Tokenizer.from_file(path_a)
        self._a.encode_special_tokens = True
        self._b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self._mark = self._b.piece_to_id("▁")
        self.bytes_a, self.bytes_b = _Bytes(_byte_level(self._a.get_vocab(with_added_tokens=True))), _Bytes(_pieces(self._b))
        self.n_b = len(self.bytes_b.sizes)
        self.n_pairs = len(self.bytes_a.sizes) * self.n_b
        names = [np.array([f"{i}{end}" for i in range(max(self.n_b, len(self.bytes_a.sizes)))], object) for end in (",", "|", ";", "\n")]
        self._comma, self._bar, self._semicolon, self._line = names
        self._most = most
        self.clear()

    def clear(self) -> None:
        self._places: dict[str, int] = {}
        self.groups: list[str] = []
        # per chunk: tokens of a, tokens of b, groups, links, whether it is good
        self.numbers = np.zeros((0, 5), np.int64)
        self.starts, self.pairs = np.zeros(1, np.int64), np.zeros(0, np.int64)

    def tokens(self, chunks: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both sides; every chunk begins with the blank that both put first."""
        a = [x.ids for x in self._a.encode_batch_fast(chunks, add_special_tokens=False)]
        b = self._b.encode([x[1:] for x in chunks], num_threads=1)
        return a, [y or [self._mark] for y in b]

    def align(self, chunks: list[str]) -> ChunkAlignment:
        """Align chunks, one "document" of ``merge_asof`` each."""
        texts = [x.encode() for x in chunks]
        sides = self.tokens(chunks)
        counts = [np.fromiter(map(len, x), np.int64, len(x)) for x in sides]
        ids = [np.fromiter(chain.from_iterable(x), np.int64, int(n.sum())) for x, n in zip(sides, counts, strict=True)]
        docs = [np.repeat(np.arange(len(chunks)), n) for n in counts]
        tables = (self.bytes_a, self.bytes_b)
        good = np.ones(len(chunks), bool)
        whole = np.frombuffer(b"".join(texts), np.uint8)
        if not all(np.array_equal(t.joined(i), whole) for t, i in zip(tables, ids, strict=True)):
            for k, (text, a, b) in enumerate(zip(texts, *sides, strict=True)):
                good[k] = all(t.joined(np.array(i, np.int64)).tobytes() == text for t, i in zip(tables, (a, b), strict=True))
            ids = [i[good[d]] for i, d in zip(ids, docs, strict=True)]
            docs = [d[good[d]] for d in docs]
        ends = [np.cumsum(t.sizes[i]) for t, i in zip(tables, ids, strict=True)]
        frames = [
            pd.DataFrame({"doc": d, "start": e - t.sizes[i], name: np.arange(len(i))})
            for t, i, d, e, name in zip(tables, ids, docs, ends, "ab", strict=True)
        ]
        links = linked(*frames)
        group_ends = np.intersect1d(*ends, assume_unique=True)
        return ChunkAlignment(*ids, *docs, *ends, group_ends, *(links[c].to_numpy(np.int64) for c in ("doc", "a", "b")), good)

    def spelled(self, x: ChunkAlignment, n: int) -> list[str]:
        """``a1,a2|b1;a3|b2`` of every one of ``n`` chunks."""
        group_a, group_b = np.searchsorted(x.group_ends, x.a_ends), np.searchsorted(x.group_ends, x.b_ends)
        last_a = np.append(group_a[1:] != group_a[:-1], True)
        last_b = np.append(group_b[1:] != group_b[:-1], True)
        over = np.append(x.b_docs[1:] != x.b_docs[:-1], True)
        names_a = np.where(last_a, self._bar[x.a_ids], self._comma[x.a_ids])
        names_b = np.where(over, self._line[x.b_ids], np.where(last_b, self._semicolon[x.b_ids], self._comma[x.b_ids]))
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        found = "".join(np.concatenate([names_a, names_b])[order].tolist()).split("\n")[:-1]
        result = [""] * n
        for k, text in zip(np.unique(x.b_docs).tolist(), found, strict=True):
            result[k] = text
        return result

    def _learn(self, chunks: list[str]) -> None:
        numbers, pairs = [self.numbers], [self.pairs]
        for at in range(0, len(chunks), _AT_ONCE):
            some = chunks[at : at + _AT_ONCE]
            x, n = self.align(some), len(some)
            firsts = np.searchsorted(x.group_ends, x.b_ends)
            closing = np.append(firsts[1:] != firsts[:-1], True)[: len(firsts)]
            counts = [np.bincount(d, minlength=n) for d in (x.a_docs, x.b_docs, x.b_docs[closing], x.link_docs)]
            numbers.append(np.stack([*counts, x.good], axis=1).astype(np.int64))
            pairs.append(x.a_ids[x.link_a] * self.n_b + x.b_ids[x.link_b])
            self.groups += self.spelled(x, n)
        first = len(self._places)
        self._places.update(zip(chunks, range(first, first + len(chunks)), strict=True))
        self.numbers, self.pairs = np.concatenate(numbers), np.concatenate(pairs)
        self.starts = np.concatenate([[0], np.cumsum(self.numbers[:, 3])])

    def places(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The chunk numbers of all texts, and how many each has."""
        if len(self._places) > self._most:
            self.clear()
        cut = [_CUT.split(" " + x) if x else [] for x in texts]
        fresh = [c for c in set(chain.from_iterable(cut)) if c not in self._places]
        if fresh:
            self._learn(fresh)
        sizes = np.fromiter(map(len, cut), np.int64, len(cut))
        return np.fromiter(map(self._places.__getitem__, chain.from_iterable(cut)), np.int64, int(sizes.sum())), sizes


@lru_cache(maxsize=1)
def aligner(path_a: str, path_b: str, most: int) -> Aligner:
    """One per Python worker: what it holds serves the worker's later tasks too."""
    return Aligner(path_a, path_b, most)


def alignments(documents: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Tokens, groups and links of every document, in whole.

    ``a_ids, a_ends, b_ids, b_ends`` are the tokens with the byte offsets of their ends,
    ``group_ends`` the offsets where groups end, ``link_a, link_b`` the positions of
    linked tokens. Null and empty texts, and texts whose tokens of either side do not
    join to a blank and the text, have empty lists; null ids stay null; a repeated row
    is a document of its own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Aligner(path_a, path_b, 0)
        kind = pa.list_(pa.int64())
        for batch in batches:
            for part in slices(batch):
                rows: list[list] = []
                for text in part.column("text").to_pylist():
                    x = held.align(_CUT.split(" " + text)) if text else None
                    if x is None or not x.good.all():
                        rows.append([[] for _ in range(7)])
                    else:
                        rows.append([v.tolist() for v in (x.a_ids, x.a_ends, x.b_ids, x.b_ends, x.group_ends, x.link_a, x.link_b)])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(list(c), kind) for c in zip(*rows, strict=True))],
                    ["doc_id", *_LISTS],
                )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, " + ", ".join(f"{c} array<long>" for c in _LISTS))


_LISTS = ("a_ids", "a_ends", "b_ids", "b_ends", "group_ends", "link_a", "link_b")
_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def _squeezed(values: np.ndarray) -> bytes:
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _restored(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def _pairs_of(held: Aligner, places: np.ndarray, docs: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of each document in order, how often each occurs, and pairs per document."""
    keys, times = np.unique(docs * len(held.numbers) + places, return_counts=True)
    owners, chunks = keys // max(len(held.numbers), 1), keys % max(len(held.numbers), 1)
    sizes = held.numbers[chunks, 3]
    total = np.cumsum(sizes)
    at = np.repeat(held.starts[chunks] - total + sizes, sizes) + np.arange(total[-1] if len(total) else 0)
    keys, inverse = np.unique(np.repeat(owners, sizes) * held.n_pairs + held.pairs[at], return_inverse=True)
    counts = np.bincount(inverse, np.repeat(times, sizes), minlength=len(keys)).astype(np.int64)
    return keys % held.n_pairs, counts, np.bincount(keys // held.n_pairs, minlength=n_docs)


class _Block:
    """What the documents of a block hold, until it is closed."""

    def __init__(self):
        self.size, self.rows = 0, []
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.per_doc: list[np.ndarray] = []

    def add(self, held: Aligner, part: pa.RecordBatch) -> None:
        places, sizes = held.places(part.column("text").to_pylist())
        n = part.num_rows
        docs = np.repeat(np.arange(n), sizes)
        whole = np.bincount(docs, held.numbers[places, 4] == 0, minlength=n) == 0
        numbers = np.stack([np.bincount(docs, held.numbers[places, k], minlength=n) for k in range(4)], axis=1).astype(np.int64)
        numbers[~whole] = 0
        ends = np.cumsum(sizes)
        spelled = held.groups
        hashes = [
            hashlib.sha256(";".join([spelled[p] for p in places[e - s : e].tolist()]).encode()).hexdigest() if s and ok else ""
            for s, e, ok in zip(sizes.tolist(), ends.tolist(), whole.tolist(), strict=True)
        ]
        kept = whole[docs]
        pairs, times, per_doc = _pairs_of(held, places[kept], docs[kept], n)
        self.rows.append((part.column("doc_id"), numbers, hashes))
        self.pairs.append(pairs)
        self.times.append(times)
        self.per_doc.append(per_doc)
        self.size += part.column("text").nbytes

    def closed(self, number: int, file: NewFile) -> Iterator[pa.RecordBatch]:
        """One row per document, and one per 65,536 distinct pairs of the block."""
        distinct, places = np.unique(np.concatenate(self.pairs), return_inverse=True)
        per_doc = np.concatenate(self.per_doc)
        data = [_squeezed(x) for x in (np.diff(places, prepend=0), np.concatenate(self.times), per_doc)]
        start = file.append(b"".join(data))
        ids = pa.concat_arrays([r[0] for r in self.rows])
        numbers = np.concatenate([r[1] for r in self.rows])
        n = len(ids)
        yield _padded({
            "block": pa.array(np.full(n, number)),
            "nth": pa.array(np.arange(n)),
            "doc_id": ids,
            **{c: pa.array(numbers[:, k]) for k, c in enumerate(_COUNTS)},
            "groups_sha256": pa.array(list(chain.from_iterable(r[2] for r in self.rows)), pa.string()),
            "file": pa.array([file.uri] * n),
            "start": pa.array(np.full(n, start)),
            "sizes": pa.array([[len(x) for x in data]] * n, pa.list_(pa.int64())),
        })
        holders = np.bincount(places, minlength=len(distinct))
        for at in range(0, len(distinct), 1 << 16):
            some = slice(at, at + (1 << 16))
            lists = [pa.array([x[some].tolist()], pa.list_(pa.int64())) for x in (distinct, holders)]
            yield _padded({"block": pa.array([number]), "nth": pa.array([at]), "pairs": lists[0], "holders": lists[1]})


_STORED = {
    "block": "long", "nth": "long", "doc_id": "long", **dict.fromkeys(_COUNTS, "long"), "groups_sha256": "string",
    "file": "string", "start": "long", "sizes": "array<long>", "pairs": "array<long>", "holders": "array<long>",
}
_ARROW = {"long": pa.int64(), "string": pa.string(), "array<long>": pa.list_(pa.int64())}


def _padded(columns: dict[str, pa.Array]) -> pa.RecordBatch:
    n = len(columns["block"])
    return pa.RecordBatch.from_arrays(
        [columns[c] if c in columns else pa.nulls(n, _ARROW[kind]) for c, kind in _STORED.items()], list(_STORED)
    )


def aligned_counts(documents: DataFrame, path_a: str, path_b: str, how: AlignedBlocks | None = None) -> DataFrame:
    """Numbers of each document's alignment, and how usual its links are in the corpus.

    Per row of ``documents``: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256``. The count of an id pair is the number of documents that hold it
    linked; ``count_sum`` adds it up over the document's links and ``n_best`` counts the
    links whose pair has the highest count of all pairs with its id on side a. Null and
    empty texts and texts that either side does not reproduce give zeros and an empty
    string and count for no pair; null ids stay null; a repeated row is a document of
    its own. Other columns are not read.
    """
    how = how or AlignedBlocks()
    folder = shared_folder(documents.sparkSession, "alignment")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = aligner(path_a, path_b, how.chunks)
        task, k, block, file = TaskContext.get().partitionId(), 0, _Block(), None
        for batch in batches:
            for part in slices(batch):
                file = file or NewFile(folder, f"part-{task:05d}", ".links")
                block.add(held, part)
                if block.size >= how.block_bytes:
                    yield from block.closed(task << 24 | k, file)
                    k, block = k + 1, _Block()
        if block.rows:
            yield from block.closed(task << 24 | k, file)
        if file is not None:
            file.close()

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = stored(rows.mapInArrow(run, ", ".join(f"{c} {kind}" for c, kind in _STORED.items())), "aligned")
    held = found.filter("pairs is not null").select("block", "nth", F.posexplode(F.arrays_zip("pairs", "holders")).alias("at", "x"))
    held = held.select("block", (F.col("nth") + F.col("at")).alias("at"), F.col("x.pairs").alias("pair"), F.col("x.holders").alias("n"))
    totals = stored(held.groupBy("pair").agg(F.sum("n").alias("n_docs")), "linked_pairs")
    n_b = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    own = F.floor(F.col("pair") / F.lit(n_b))
    # no more rows than side a has ids
    best = broadcast_if_small(stored(totals.groupBy(own.alias("a")).agg(F.max("n_docs").alias("most")), "best_links"))
    marked = totals.join(best, own == F.col("a")).select("pair", "n_docs", (F.col("n_docs") == F.col("most")).alias("is_best"))
    known = held.select(F.col("block").alias("owner"), "at", "pair").join(marked, "pair").select("owner", "at", "n_docs", "is_best")
    rows = found.filter("pairs is null").drop("pairs", "holders")

    def summed(docs: pa.Table, counts: pa.Table) -> pa.Table:
        docs = docs.sort_by("nth")
        if not len(docs):
            return pa.table({c: pa.array([], _ARROW[k]) for c, k in _RESULT.items()})
        uri, start, sizes = (docs.column(c)[0].as_py() for c in ("file", "start", "sizes"))
        ranges = Ranges()
        data = ranges.read(uri, start, sum(sizes))
        ranges.close()
        cuts = np.cumsum([0, *sizes])
        steps, times, per_doc = (_restored(data[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True))
        # differences were stored modulo 2**32
        places = np.cumsum(steps.astype(np.uint32), dtype=np.uint32).astype(np.int64)
        n_docs, is_best = np.zeros(len(counts), np.int64), np.zeros(len(counts), bool)
        at = counts.column("at").to_numpy()
        n_docs[at], is_best[at] = counts.column("n_docs").to_numpy(), counts.column("is_best").to_numpy()
        owners = np.repeat(np.arange(len(docs)), per_doc)
        n_best, count_sum = np.zeros(len(docs), np.int64), np.zeros(len(docs), np.int64)
        np.add.at(n_best, owners, times * is_best[places])
        np.add.at(count_sum, owners, times * n_docs[places])
        values = {c: docs.column(c) for c in ("doc_id", *_COUNTS, "groups_sha256")}
        return pa.table(values | {"n_best": pa.array(n_best), "count_sum": pa.array(count_sum)}).select(list(_RESULT))

    schema = ", ".join(f"{c} {kind}" for c, kind in _RESULT.items())
    return rows.groupBy("block").cogroup(known.groupBy("owner")).applyInArrow(summed, schema)


_RESULT = {"doc_id": "long", **dict.fromkeys(_COUNTS, "long"), "n_best": "long", "count_sum": "long", "groups_sha256": "string"}
