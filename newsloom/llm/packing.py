"""Packing of documents into as few token sequences of one length as can be found.

Documents are cut into pieces only where they are longer than a sequence. What decides
is the histogram of piece lengths, which has no more entries than a sequence has
tokens, so the packing is planned on it alone, on the driver, at any number of rows:

* the configuration linear program asks for the least number of sequences whose
  patterns (how many pieces of each length) cover the histogram;
* it is solved by multiplicative weights: a length weighs less the better it is
  covered, a knapsack dynamic program prices the pieces by these weights and gives, for
  every length, the most valuable pattern that holds it;
* the fractions are rounded, down and then up while pieces last, and what is left is
  packed by largest piece and the fullest rest (the same dynamic program on lengths).

Spark then numbers the pieces of each length and looks up which place in which sequence
has that number.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsloom.lineage import broadcast_if_small, stored
from newsloom.llm.packed import with_end, word_ids
from newsloom.llm.words import slices


@dataclass(frozen=True)
class Packing:
    """Tokens per sequence; rounds, step and tolerance of the linear program.

    ``rounds`` rounds cover a length by at most its share of ``1 / rounds`` each; a
    pattern takes part if its value is within ``tolerance`` of the best one's.
    """

    longest: int = 2048
    rounds: int = 16
    step: float = 4.0
    tolerance: float = 0.02


# A pattern: pairs of a length and how many pieces have it, longest first.
Pattern = tuple[tuple[int, int], ...]


class Knapsack:
    """Most valuable contents of every capacity from pieces that are there in given numbers.

    Numbers are split into powers of two, so a length takes part as a few items.
    """

    def __init__(self, lengths: np.ndarray, counts: np.ndarray, capacity: int):
        self.lengths, self.capacity = lengths, capacity
        items: list[tuple[int, int]] = []
        for k, (length, n) in enumerate(zip(lengths.tolist(), counts.tolist(), strict=True)):
            left, power = min(n, capacity // length), 1
            while left:
                items.append((k, min(power, left)))
                left -= items[-1][1]
                power *= 2
        self._of = np.array([k for k, _ in items], np.int64)
        self._times = np.array([t for _, t in items], np.int64)
        self._sizes = lengths[self._of] * self._times if items else np.zeros(0, np.int64)

    def solve(self, prices: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best value per capacity, and which items are taken at which capacity."""
        best = np.zeros(self.capacity + 1)
        taken = np.zeros((len(self._of), self.capacity + 1), bool)
        values = prices[self._of] * self._times
        for j, (size, value) in enumerate(zip(self._sizes.tolist(), values.tolist(), strict=True)):
            other = best[: self.capacity + 1 - size] + value
            better = other > best[size:]
            taken[j, size:] = better
            np.copyto(best[size:], other, where=better)
        return best, taken

    def contents(self, taken: np.ndarray, capacities: np.ndarray) -> list[Counter]:
        """What the best contents of each capacity are."""
        left = capacities.copy()
        found = [Counter() for _ in capacities]
        for j in range(len(self._of) - 1, -1, -1):
            hit = np.flatnonzero(taken[j, left])
            if len(hit):
                left[hit] -= self._sizes[j]
                length, times = int(self.lengths[self._of[j]]), int(self._times[j])
                for i in hit.tolist():
                    found[i][length] += times
        return found


def configuration_program(lengths: np.ndarray, counts: np.ndarray, how: Packing) -> dict[Pattern, float]:
    """Patterns and how often each is used, in fractions, never more pieces than there are."""
    knapsack = Knapsack(lengths, counts, how.longest)
    cover = np.zeros(len(lengths))
    used: dict[Pattern, float] = {}
    at = {length: k for k, length in enumerate(lengths.tolist())}
    for _ in range(how.rounds):
        # a length as long as another is worth as much until one is covered better
        prices = lengths * np.exp(-how.step * (cover - cover.min()))
        best, taken = knapsack.solve(prices)
        held = prices + best[how.longest - lengths]
        wanted = np.flatnonzero(held >= (1 - how.tolerance) * held.max())
        allowed = counts / how.rounds
        for k, rest in zip(wanted.tolist(), knapsack.contents(taken, how.longest - lengths[wanted]), strict=True):
            rest[int(lengths[k])] += 1
            if any(n > counts[at[x]] for x, n in rest.items()):
                continue
            times = min(allowed[at[x]] / n for x, n in rest.items())
            if times > 0:
                pattern = tuple(sorted(rest.items(), reverse=True))
                used[pattern] = used.get(pattern, 0.0) + times
                for x, n in pattern:
                    allowed[at[x]] -= n * times
                    cover[at[x]] += n * times / counts[at[x]]
    return used


def _fullest(left: dict[int, int], room: int) -> Counter:
    """Contents of at most ``room`` tokens with the largest sum; sums are the bits of whole numbers."""
    mask = (1 << (room + 1)) - 1
    sums, steps = 1, []
    for length in sorted((x for x in left if x <= room), reverse=True):
        n, power = min(left[length], room // length), 1
        while n:
            times = min(power, n)
            steps.append((length, times, sums))
            sums |= (sums << (length * times)) & mask
            n -= times
            power *= 2
        if sums >> room:
            break
    at, found = sums.bit_length() - 1, Counter()
    for length, times, before in reversed(steps):
        if not before >> at & 1:
            found[length] += times
            at -= length * times
    return found


def plan_sequences(histogram: dict[int, int], how: Packing | None = None) -> list[tuple[Pattern, int]]:
    """Patterns and how often each is used; together exactly the pieces of the histogram."""
    how = how or Packing()
    left = {x: n for x, n in histogram.items() if n}
    plan: Counter[Pattern] = Counter()
    if left.get(how.longest):
        plan[((how.longest, 1),)] += left.pop(how.longest)

    def take(pattern: Pattern, times: int) -> None:
        plan[pattern] += times
        for x, n in pattern:
            left[x] -= n * times
            if not left[x]:
                del left[x]

    def most(pattern: Pattern) -> int:
        return min(left.get(x, 0) // n for x, n in pattern)

    if left:
        lengths = np.array(sorted(left, reverse=True), np.int64)
        used = configuration_program(lengths, np.array([left[x] for x in lengths.tolist()], np.int64), how)
        for pattern, times in used.items():
            if whole := min(int(times), most(pattern)):
                take(pattern, whole)
        for pattern, _ in sorted(used.items(), key=lambda x: (int(x[1]) - x[1], x[0])):
            if most(pattern):
                take(pattern, 1)
    while left:
        largest = max(left)
        own = left | {largest: left[largest] - 1}
        pattern = _fullest(own, how.longest - largest)
        pattern[largest] += 1
        kept = tuple(sorted(pattern.items(), reverse=True))
        take(kept, most(kept))
    return sorted(plan.items(), reverse=True)


class _Places:
    """Where the n-th piece of a length goes.

    Has an entry for each length of each pattern: at most 63 per pattern (that many
    distinct lengths fill 2,048 tokens), and at most ``longest * (rounds + 2)`` patterns
    of the program, whatever the number of documents.
    """

    def __init__(self, plan: list[tuple[Pattern, int]], longest: int):
        entries: list[tuple[int, int, int, int, int]] = []
        base = 0
        for pattern, times in plan:
            offset = 0
            for length, n in pattern:
                entries.append((length, n, base, offset, n * times))
                offset += n * length
            base += times
        table = np.array(entries, np.int64).reshape(-1, 5)
        table = table[np.argsort(table[:, 0], kind="stable")]
        self._length, self._n, self._base, self._offset, slots = table.T.copy()
        self._first = np.cumsum(slots) - slots
        self._start = np.zeros(longest + 2, np.int64)
        # slots of all shorter lengths
        per_length = np.bincount(self._length, slots, minlength=longest + 2).astype(np.int64)
        self._start[1:] = np.cumsum(per_length)[:-1]

    def find(self, lengths: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        slots = self._start[lengths] + numbers
        at = np.searchsorted(self._first, slots, side="right") - 1
        within = slots - self._first[at]
        return self._base[at] + within // self._n[at], self._offset[at] + within % self._n[at] * lengths


class _Ranks:
    """Numbers values from 0 within equal ones, on and on over batches."""

    def __init__(self, longest: int):
        self._seen = np.zeros(longest + 1, np.int64)

    def of(self, lengths: np.ndarray) -> np.ndarray:
        order = np.argsort(lengths, kind="stable")
        values, firsts, counts = np.unique(lengths[order], return_index=True, return_counts=True)
        ranks = np.empty(len(lengths), np.int64)
        ranks[order] = np.arange(len(lengths)) - np.repeat(firsts - self._seen[values], counts)
        self._seen[values] += counts
        return ranks


_PIECES = "doc_id long, piece int, start long, length long"


def cut_documents(documents: DataFrame, tokenizer: str, end: int, longest: int, digest: bool = False) -> DataFrame:
    """``doc_id, piece, start, length`` and the ``ids`` of every piece, or their ``ids_crc32``.

    A document's ids end with ``end``; null and empty texts have that one id. Documents
    of more than ``longest`` ids are cut into pieces of that length, the last one
    shorter. ``part`` and ``nth`` number the pieces of equal length in a task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, ranks, part = word_ids(tokenizer), _Ranks(longest), TaskContext.get().partitionId()
        for batch in batches:
            for rows in slices(batch, most_bytes=3 << 20):
                ids, counts = with_end(*encode.encode(rows.column("text")), end)
                n = -(-counts // longest)
                owner = np.repeat(np.arange(len(counts)), n)
                piece = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
                start = piece * longest
                length = np.minimum(counts[owner] - start, longest)
                cuts = np.cumsum(length)
                if digest:
                    data = memoryview(ids.astype("<u4").tobytes())
                    sums = [zlib.crc32(data[4 * (b - a) : 4 * b]) for a, b in zip(length.tolist(), cuts.tolist(), strict=True)]
                    held, name = pa.array(sums, pa.int64()), "ids_crc32"
                else:
                    offsets = pa.array(np.concatenate([[0], cuts]).astype(np.int32))
                    held, name = pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32))), "ids"
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id").take(pa.array(owner)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length),
                     held, pa.array(np.full(len(owner), part)), pa.array(ranks.of(length))],
                    ["doc_id", "piece", "start", "length", name, "part", "nth"],
                )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, f"{_PIECES}, {'ids_crc32 long' if digest else 'ids array<int>'}, part long, nth long")


def pack_documents(documents: DataFrame, tokenizer: str, end: int, how: Packing | None = None, digest: bool = False) -> DataFrame:
    """The pieces of ``cut_documents`` with ``sequence_id`` and ``offset``.

    Pieces of a sequence follow each other without gaps from offset 0. A row that
    repeats an id is a document of its own; null ids stay null; an empty table gives no
    rows. Other columns are not read.
    """
    how = how or Packing()
    pieces = stored(cut_documents(documents, tokenizer, end, how.longest, digest), "pieces")
    per_part = stored(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "piece_lengths")
    # no more rows than a sequence has tokens
    histogram = {r.length: r.n for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = pieces.sparkSession.sparkContext.broadcast(_Places(plan_sequences(histogram, how), how.longest))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_part.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    numbered = pieces.join(broadcast_if_small(bases), ["part", "length"])
    held = "ids_crc32" if digest else "ids"
    kept = ["doc_id", "piece", "start", "length", held]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, number = np.asarray(batch.column("length")), np.asarray(batch.column("number"))
            found = places.value.find(lengths, number)
            yield pa.RecordBatch.from_arrays([*map(batch.column, kept), *map(pa.array, found)], [*kept, "sequence_id", "offset"])

    schema = f"{_PIECES}, {'ids_crc32 long' if digest else 'ids array<int>'}, sequence_id long, offset long"
    return numbered.select(*kept, (F.col("base") + F.col("nth")).alias("number")).mapInArrow(run, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids, doc_ids, starts`` of every sequence, from pieces with ``ids``.

    ``starts`` are the offsets at which the pieces of ``doc_ids`` begin; a sequence holds
    at most its fixed number of ids.
    """
    rows = F.sort_array(F.collect_list(F.struct("offset", "piece", "doc_id", "ids")))
    return packed.groupBy("sequence_id").agg(rows.alias("x")).select(
        "sequence_id", F.flatten("x.ids").alias("ids"), F.col("x.doc_id").alias("doc_ids"), F.col("x.offset").alias("starts")
    )
