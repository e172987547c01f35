"""Benchmark decontamination by pigeonhole edit matching.

An item with an error budget of ``k`` edits is cut into ``k + 1`` pieces: a passage
within the budget keeps at least one piece whole. Exact piece hits are found with
one automaton per block of items, and the places they point at are verified with
Myers' bit-parallel edit distance. Case and runs of white space do not count.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.lineage import stored
from newsloom.llm.files import opened


@dataclass(frozen=True)
class EditBudget:
    """Edits allowed per character of an item, and the size of a block of items."""

    rate: float = 0.08
    block_chars: int = 1 << 20

    def of(self, item: str) -> int:
        return int(len(item) * self.rate)


def plain(text: str | None) -> str:
    """Lower-cased, every run of white space one blank."""
    return " ".join((text or "").lower().split())


def pieces_of(item: str, budget: int) -> list[tuple[int, str]]:
    """``budget + 1`` pieces of nearly equal length with their places."""
    n = budget + 1
    cuts = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if b > a]


def best_match(pattern: str, text: str, budget: int) -> tuple[int, int] | None:
    """Least edit distance of ``pattern`` to any part of ``text`` and where that part ends.

    Myers, "A fast bit-vector algorithm for approximate string matching", 1999.
    None if the distance is over the budget.
    """
    at = text.find(pattern)
    if at >= 0:
        return 0, at + len(pattern)
    m = len(pattern)
    mask, top = (1 << m) - 1, 1 << (m - 1)
    places: dict[str, int] = {}
    for i, c in enumerate(pattern):
        places[c] = places.get(c, 0) | 1 << i
    plus, minus, distance = mask, 0, m
    best: tuple[int, int] | None = None
    for j, c in enumerate(text, 1):
        equal = places.get(c, 0)
        vertical = equal | minus
        horizontal = (((equal & plus) + plus) ^ plus) | equal
        up = minus | (~(horizontal | plus) & mask)
        down = plus & horizontal
        if up & top:
            distance += 1
        elif down & top:
            distance -= 1
        up, down = (up << 1) & mask, (down << 1) & mask
        plus, minus = down | (~(vertical | up) & mask), up & vertical
        if distance <= budget and (best is None or distance < best[0]):
            best = distance, j
    return best


class ItemMatcher:
    """All items of a block; finds those within their budget in a text."""

    def __init__(self, items: list[tuple[int, str]], how: EditBudget):
        self._items = [(key, text, how.of(text)) for key, text in items]
        at: dict[str, list[tuple[int, int]]] = {}
        for i, (_, text, budget) in enumerate(self._items):
            for place, piece in pieces_of(text, budget):
                at.setdefault(piece, []).append((i, place))
        self._automaton = ahocorasick.Automaton()
        for piece, targets in at.items():
            self._automaton.add_word(piece, (len(piece), targets))
        if at:
            self._automaton.make_automaton()
        self._any = bool(at)

    def matches(self, text: str | None) -> Iterator[tuple[int, int, int]]:
        """``item key, distance, end`` of the best place of each item found."""
        if not self._any:
            return
        flat = plain(text)
        starts: dict[int, set[int]] = {}
        for end, (size, targets) in self._automaton.iter(flat):
            for i, place in targets:
                starts.setdefault(i, set()).add(end + 1 - size - place)
        for i, found in starts.items():
            key, item, budget = self._items[i]
            best: tuple[int, int] | None = None
            for low, high in _runs(sorted(found), 2 * budget + 1):
                first = max(0, low - budget)
                hit = best_match(item, flat[first : high + len(item) + budget], budget)
                if hit and (best is None or hit[0] < best[0]):
                    best = hit[0], hit[1] + first
            if best:
                yield key, *best


def _runs(starts: list[int], gap: int) -> Iterator[tuple[int, int]]:
    low = high = starts[0]
    for s in starts[1:]:
        if s - high > gap:
            yield low, high
            low = s
        high = s
    yield low, high


def stored_blocks(benchmark: DataFrame, how: EditBudget) -> list[str]:
    """Items with text, dealt out evenly into files of about ``block_chars`` characters in the shared folder.

    Only the names of the files reach the driver.
    """
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("text is not null")
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    return sorted(stored(rows.repartition(max(1, math.ceil(chars / how.block_chars))), "benchmark-items").inputFiles())


@lru_cache(maxsize=1)
def _matcher(uri: str, how: EditBudget) -> ItemMatcher:
    """The matcher of one block of items; a worker holds one at a time."""
    with opened(uri) as file:
        rows = pq.read_table(file, columns=["item_id", "text"]).to_pydict()
    found = zip(rows["item_id"], map(plain, rows["text"]), strict=True)
    return ItemMatcher([(key, item) for key, item in found if item], how)


# Bytes of documents that meet one block after the other where there are several.
_AT_ONCE = 32 << 20


def _gathered(batches: Iterator[pa.RecordBatch], n_blocks: int) -> Iterator[list[pa.RecordBatch]]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if n_blocks == 1 or sum(x.nbytes for x in held) >= _AT_ONCE:
            yield held
            held = []
    if held:
        yield held


def benchmark_hits(documents: DataFrame, benchmark: DataFrame, how: EditBudget | None = None) -> DataFrame:
    """``doc_id, item_id, distance, match_end``: every item found in every document.

    Documents are read once; each task takes the blocks of items one after the other.
    ``match_end`` counts characters of the text after folding case and white space.
    Items without text match nothing; null texts hold nothing; null ids stay null; a
    repeated row or item is reported each time. An item matches inside words too, and
    one of a few letters wherever these stand.
    """
    how = how or EditBudget()
    files = stored_blocks(benchmark, how)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _gathered(batches, len(files)):
            for uri in files:
                matcher = _matcher(uri, how)
                for batch in held:
                    found = [
                        (key, *hit)
                        for key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True)
                        for hit in matcher.matches(text.as_py())
                    ]
                    columns = zip(*found, strict=True) if found else ((), (), (), ())
                    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, kind) for x, kind in zip(columns, kinds, strict=True)],
                        ["doc_id", "item_id", "distance", "match_end"],
                    )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(find, "doc_id long, item_id long, distance int, match_end long")


def without_benchmark(documents: DataFrame, benchmark: DataFrame, how: EditBudget | None = None) -> DataFrame:
    """The documents that hold no item, with all their columns; nothing is shuffled."""
    how = how or EditBudget()
    files = stored_blocks(benchmark, how)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _gathered(batches, len(files)):
            for uri in files:
                matcher = _matcher(uri, how)
                clean = [[next(matcher.matches(x.as_py()), None) is None for x in batch.column("text")] for batch in held]
                held = [batch.filter(pa.array(mask, pa.bool_())) for batch, mask in zip(held, clean, strict=True)]
            yield from held

    return documents.mapInArrow(keep, documents.schema)
