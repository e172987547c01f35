"""Stupid-backoff scores of documents against all other documents.

Every block of documents is exploded into its distinct word n-grams with their
counts, and these are partitioned by hash. Each partition is a piece of the count
table: it adds up its n-grams over all blocks and joins the totals back onto the
n-grams of each block. Per document the scores of its words are then summed.

A word is scored by its longest n-gram that occurs outside its own document:
``count(n-gram) / count(history)``, times ``alpha`` for every order that was given
up (Brants et al., "Large Language Models in Machine Translation", 2007). Leaving
the own document out keeps rare n-grams from vouching for themselves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.words import Words, mixed, words_of


@dataclass(frozen=True)
class BackoffModel:
    """Longest n-gram, back-off factor, bytes of text per block and per piece of the table."""

    order: int = 2
    alpha: float = 0.4
    block_bytes: int = 8 << 20
    part_bytes: int = 4 << 20


# Stands for the number of all words.
_ALL = np.uint64(1)


def _ending_grams(words: Words, order: int) -> list[np.ndarray]:
    """For n = 1 .. order the hash of the n-gram that ends at each word; 0 where a text is too short."""
    grams = []
    for n in range(1, order + 1):
        held = np.zeros(len(words.hashes), np.uint64)
        if len(held) >= n:
            last = len(held) - n + 1
            value = words.hashes[:last]
            for k in range(1, n):
                value = mixed(value * np.uint64(0x9E3779B97F4A7C15) + words.hashes[k : last + k])
            # 0 and 1 are taken
            value = np.maximum(mixed(value + np.uint64(n)), np.uint64(2))
            held[n - 1 :] = np.where(words.docs[:last] == words.docs[n - 1 :], value, np.uint64(0))
        grams.append(held)
    return grams


def _distinct(words: Words, order: int) -> tuple[np.ndarray, np.ndarray]:
    grams, counts = np.unique(np.concatenate(_ending_grams(words, order)), return_counts=True)
    real = grams > _ALL
    return (
        np.concatenate([[_ALL], grams[real]]),
        np.concatenate([[len(words.hashes)], counts[real]]).astype(np.int64),
    )


def _borders(parts: int) -> np.ndarray:
    return np.array([(i << 64) // parts for i in range(1, parts)], dtype=np.uint64)


def _packed_hashes(hashes: np.ndarray) -> bytes:
    """Differences of sorted hashes, six bytes each where they fit."""
    steps = np.diff(hashes, prepend=np.uint64(0))
    wide = 6 if len(steps) > 1 and int(steps[1:].max()) < 1 << 48 else 8
    body = steps[1:].view(np.uint8).reshape(-1, 8)[:, :wide]
    return bytes([wide]) + steps[:1].tobytes() + body.tobytes()


def _unpacked_hashes(data: bytes) -> np.ndarray:
    wide = data[0]
    body = np.frombuffer(data, np.uint8, offset=9).reshape(-1, wide)
    steps = np.zeros((len(body) + 1, 8), np.uint8)
    steps[1:, :wide] = body
    values = steps.view(np.uint64).ravel()
    values[0] = np.frombuffer(data, np.uint64, 1, 1)[0]
    return np.cumsum(values, dtype=np.uint64)


def _squeezed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes())


def _restored(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel().astype(np.int64)


def backoff_scores(documents: DataFrame, how: BackoffModel | None = None) -> DataFrame:
    """``doc_id, n_words, n_backed_off, score_micro`` of every document.

    ``score_micro`` is the sum over words of log10 of their score in millionths,
    each rounded, so sums are exact. A word seen nowhere else counts as once in one
    word more than there are. ``n_backed_off`` are words not scored at the longest
    order their place allows. Null and empty texts have no words and score 0; null
    ids stay null; a repeated row is a document of its own.
    """
    how = how or BackoffModel()
    size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks, n_parts = max(1, math.ceil(size / how.block_bytes)), max(4, math.ceil(size / how.part_bytes))
    rows = documents.select(
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_blocks)).alias("block"), F.col("doc_id").cast("long").alias("doc_id"), "text"
    )
    n = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = rows.repartition(max(n, n_blocks), "block")

    def explode(group: pa.Table) -> pa.Table:
        grams, counts = _distinct(words_of(group.column("text")), how.order)
        cuts = np.concatenate([[0], np.searchsorted(grams, _borders(n_parts)), [len(grams)]])
        parts = [p for p in range(n_parts) if cuts[p + 1] > cuts[p]]
        block = group.column("block")[0].as_py()
        return pa.table({
            "part": pa.array(parts, pa.int32()),
            "block": pa.array([block] * len(parts), pa.int64()),
            "grams": pa.array([_packed_hashes(grams[cuts[p] : cuts[p + 1]]) for p in parts], pa.binary()),
            "counts": pa.array([_squeezed(counts[cuts[p] : cuts[p + 1]]) for p in parts], pa.binary()),
        })

    def total(group: pa.Table) -> pa.Table:
        grams = [_unpacked_hashes(x.as_py()) for x in group.column("grams")]
        counts = np.concatenate([_restored(x.as_py()) for x in group.column("counts")])
        keys, places = np.unique(np.concatenate(grams), return_inverse=True)
        totals = np.bincount(places, counts, minlength=len(keys)).astype(np.int64)[places]
        ends = np.cumsum([len(g) for g in grams])
        sums = np.split(totals, ends[:-1])
        return pa.table({
            "block": group.column("block"),
            "part": group.column("part"),
            "totals": pa.array([_squeezed(x) for x in sums], pa.binary()),
        })

    def score(texts: pa.Table, tables: pa.Table) -> pa.Table:
        order = np.argsort(np.asarray(tables.column("part")), kind="stable")
        totals = np.concatenate([_restored(tables.column("totals")[int(i)].as_py()) for i in order])
        words = words_of(texts.column("text"))
        ending = _ending_grams(words, how.order)
        distinct = np.unique(np.concatenate(ending))
        grams = np.concatenate([[_ALL], distinct[distinct > _ALL]])
        outside = [_outside(e, words.docs, grams, totals) for e in ending]
        n_words = words.per_doc()
        base = (totals[0] - n_words)[words.docs]
        value, factor = np.zeros(len(words.hashes)), np.zeros(len(words.hashes), np.int64)
        possible = sum((e > 0).astype(np.int64) for e in ending)
        found = np.zeros(len(words.hashes), np.int64)
        for k in range(how.order, 0, -1):
            history = np.concatenate([[0], outside[k - 2][:-1]]) if k > 1 else base
            hit = (found == 0) & (outside[k - 1] > 0) & (history > 0)
            value[hit] = outside[k - 1][hit] / history[hit]
            factor[hit] = possible[hit] - k
            found[hit] = k
        rest = found == 0
        value[rest] = 1.0 / (base[rest] + 1)
        factor[rest] = possible[rest] - 1
        logs = np.rint(1e6 * (np.log10(value) + factor * math.log10(how.alpha)))
        n_docs = words.n_docs
        return pa.table({
            "doc_id": texts.column("doc_id"),
            "n_words": pa.array(n_words.astype(np.int64)),
            "n_backed_off": pa.array(np.bincount(words.docs[found < possible], minlength=n_docs).astype(np.int64)),
            "score_micro": pa.array(np.bincount(words.docs, logs, minlength=n_docs).astype(np.int64)),
        })

    exploded = blocks.groupBy("block").applyInArrow(explode, "part int, block long, grams binary, counts binary")
    totals = exploded.groupBy("part").applyInArrow(total, "block long, part int, totals binary")
    schema = "doc_id long, n_words long, n_backed_off long, score_micro long"
    return blocks.groupBy("block").cogroup(totals.groupBy("block")).applyInArrow(score, schema)


def _outside(ending: np.ndarray, docs: np.ndarray, grams: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Occurrences of each word's n-gram outside the word's own document."""
    result = np.zeros(len(ending), np.int64)
    real = np.flatnonzero(ending)
    if len(real):
        places = np.searchsorted(grams, ending[real])
        pairs = docs[real].astype(np.int64) * np.int64(len(grams)) + places
        _, inverse, own = np.unique(pairs, return_inverse=True, return_counts=True)
        result[real] = totals[places] - own[inverse]
    return result
