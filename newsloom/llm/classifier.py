"""Quality classifier on document statistics.

Random Fourier features approximate a Gaussian kernel over a few statistics of
each text (Rahimi and Recht, "Random Features for Large-Scale Kernel Machines",
2007). A ridge regression is fitted from normal equations that partitions sum, and
isotonic regression turns its output into a probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.lineage import stored
from newsloom.llm.rules import repeated_lines, repeated_words
from newsloom.llm.words import slices, words_of


@dataclass(frozen=True)
class KernelRidge:
    """Number of features, kernel width, ridge, calibration bins, decision limit."""

    features: int = 256
    width: float = 3.0
    ridge: float = 1e-3
    bins: int = 400
    threshold: float = 0.3
    seed: int = 9


STATISTICS = (
    "log_words", "word_length", "long_words", "upper", "digits", "symbols", "bangs", "stops", "bars", "others",
    "line_words", "repeated_lines", "repeated_words", "distinct_words", "top_word", "marked_words",
)


def _class(characters: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[np.frombuffer(characters, np.uint8)] = True
    return table


_CLASSES = {
    "upper": _class(bytes(range(65, 91))),
    "digits": _class(b"0123456789"),
    "symbols": _class(b"#*$%&<>@^~=+_{}[]\\"),
    "bangs": _class(b"!?"),
    "stops": _class(b".,;:"),
    "bars": _class(b"|/-"),
    "others": _class(bytes(range(128, 256))),
}


def statistics(texts: pa.Array) -> np.ndarray:
    """A row of statistics for each text; null and empty texts have all zeros."""
    words = words_of(texts)
    n, n_words = words.n_docs, words.per_doc()
    at_least_one = np.maximum(n_words, 1)
    size = np.maximum(np.diff(words.offsets), 1)
    columns = {"log_words": np.log1p(n_words)}
    lengths = words.ends - words.starts
    columns["word_length"] = np.bincount(words.docs, lengths, minlength=n) / at_least_one
    columns["long_words"] = np.bincount(words.docs, lengths > 12, minlength=n) / at_least_one
    for name, table in _CLASSES.items():
        sums = np.concatenate([[0], np.cumsum(table[words.data])])
        columns[name] = (sums[words.offsets[1:]] - sums[words.offsets[:-1]]) / size
    texts_ = texts.to_pylist()
    n_lines = np.fromiter(((x or "").count("\n") + 1 for x in texts_), np.int64, n)
    columns["line_words"] = np.log1p(n_words / n_lines)
    columns["repeated_lines"] = np.fromiter(map(repeated_lines, texts_), np.int64, n) / n_lines
    columns["repeated_words"] = repeated_words(words, 8) / at_least_one
    order = np.lexsort((words.hashes, words.docs))
    docs, hashes = words.docs[order], words.hashes[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (docs[1:] != docs[:-1]) | (hashes[1:] != hashes[:-1])
    columns["distinct_words"] = np.bincount(docs[new], minlength=n) / at_least_one
    runs = np.diff(np.append(np.flatnonzero(new), len(order)))
    top = np.zeros(n)
    np.maximum.at(top, docs[new], runs)
    columns["top_word"] = top / at_least_one
    last = words.data[words.ends - 1]
    columns["marked_words"] = np.bincount(words.docs, _class(b"#*$%&|<>!")[last], minlength=n) / at_least_one
    return np.column_stack([columns[name] for name in STATISTICS])


def statistics_table(documents: DataFrame) -> DataFrame:
    """``doc_id, statistics`` of every document: the only step that reads texts."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                values = pa.array(statistics(part.column("text")).ravel())
                offsets = pa.array(np.arange(part.num_rows + 1, dtype=np.int32) * len(STATISTICS))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.ListArray.from_arrays(offsets, values)], ["doc_id", "statistics"]
                )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(measure, "doc_id long, statistics array<double>")


def stored_statistics(documents: DataFrame) -> DataFrame:
    """The statistics as a stored table, so that texts are read once."""
    return stored(statistics_table(documents), "statistics")


@dataclass(frozen=True)
class KernelModel:
    """Standardisation, random features, ridge weights, and the calibration curve."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def features(self, values: np.ndarray) -> np.ndarray:
        standard = np.clip((values - self.mean) / self.scale, -6, 6)
        waves = np.cos(standard @ self.directions + self.phases) * np.sqrt(2 / len(self.phases))
        return np.column_stack([waves, np.ones(len(values))])

    def raw(self, values: np.ndarray) -> np.ndarray:
        return self.features(values) @ self.weights

    def score(self, values: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(values), self.knots, self.levels)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.asarray(batch.column("statistics").flatten(), dtype=float).reshape(batch.num_rows, len(STATISTICS))


def _summed(rows: DataFrame, sums: object, size: int) -> np.ndarray:
    """The sum over all rows of vectors of a fixed size.

    Each partition sums its own rows; 16 tasks add those sums as they arrive, holding one
    vector each, so the driver gets 16 vectors whatever the number of rows or partitions.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, least = np.zeros(size), None
        for batch in batches:
            if batch.num_rows:
                total += sums(batch)
                least = hash(batch.column(0)[0].as_py()) % 16 if least is None else least
        if least is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([least], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["slot", "total"]
            )

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(size), 0
        for batch in batches:
            n += batch.num_rows
            for x in batch.column("total"):
                total += np.frombuffer(x.as_py())
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["total"])

    partials = rows.mapInArrow(partial, "slot int, total binary")
    parts = partials.repartition(16, "slot").select("total").mapInArrow(combine, "total binary").collect()
    return sum((np.frombuffer(x["total"]) for x in parts), np.zeros(size))


def _pooled(counts: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Pool adjacent violators: the best non-decreasing level of each bin."""
    pools: list[list[float]] = []
    for n, s in zip(counts, sums, strict=True):
        pools.append([n, s, 1])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            n_last, s_last, width = pools.pop()
            pools[-1] = [pools[-1][0] + n_last, pools[-1][1] + s_last, pools[-1][2] + width]
    return np.concatenate([np.full(int(width), s / n) for n, s, width in pools])


def fit_classifier(table: DataFrame, labels: DataFrame, usable: Column, how: KernelRidge | None = None) -> KernelModel:
    """Fit on the labelled rows where ``usable`` holds, all of them.

    ``usable`` is a condition on ``doc_id``. A third of those rows only calibrates.
    A label that is given again counts once; an id with both labels counts as a row of
    each; rows that repeat an id are learned from each. Without labels every score is 1.
    """
    how = how or KernelRidge()
    known = labels.filter(usable & F.col("quality").isin(0, 1)).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("label")
    ).distinct()
    rows = stored(table.join(known, "doc_id"), "classifier-rows")
    calibrates = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
    d = len(STATISTICS)

    def moments(batch: pa.RecordBatch) -> np.ndarray:
        x = _matrix(batch)
        return np.concatenate([[len(x)], x.sum(0), (x**2).sum(0)])

    n, first, second = np.split(_summed(rows, moments, 2 * d + 1), [1, d + 1])
    count = max(float(n[0]), 1.0)
    mean = first / count
    scale = np.sqrt(np.maximum(second / count - mean**2, 0)) + 1e-6
    random = np.random.default_rng(how.seed)
    directions = random.normal(size=(d, how.features)) / how.width
    phases = random.uniform(0, 2 * np.pi, how.features)
    size = how.features + 1
    blank = KernelModel(mean, scale, directions, phases, np.zeros(size), np.array([0.0]), np.array([1.0]))
    if not n[0]:
        return blank

    def equations(batch: pa.RecordBatch) -> np.ndarray:
        z, y = blank.features(_matrix(batch)), np.asarray(batch.column("label"))
        weight = np.where(y > 0, 1.0, 4.0)[:, None]
        return np.concatenate([(z.T @ (z * weight)).ravel(), z.T @ (y * weight[:, 0])])

    total = _summed(rows.filter(~calibrates), equations, size * size + size)
    left, right = total[: size * size].reshape(size, size), total[size * size :]
    penalty = how.ridge * max(float(np.trace(left)) / size, 1.0) * np.eye(size)
    penalty[-1, -1] = 0.0 if left[-1, -1] else 1.0
    weights = np.linalg.solve(left + penalty, right)
    fitted = KernelModel(mean, scale, directions, phases, weights, np.array([0.0]), np.array([1.0]))

    def histogram(batch: pa.RecordBatch) -> np.ndarray:
        bins = np.clip((fitted.raw(_matrix(batch)) + 0.5) / 2 * how.bins, 0, how.bins - 1).astype(int)
        y = np.asarray(batch.column("label"))
        return np.concatenate([np.bincount(bins, minlength=how.bins), np.bincount(bins, y, minlength=how.bins)])

    counts, sums = np.split(_summed(rows.filter(calibrates), histogram, 2 * how.bins), 2)
    filled = np.flatnonzero(counts)
    if not len(filled):
        knots, levels = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    else:
        knots = (filled + 0.5) / how.bins * 2 - 0.5
        levels = np.clip(_pooled(counts[filled], sums[filled]), 0.0, 1.0)
    return KernelModel(mean, scale, directions, phases, weights, knots, levels)


def classify(table: DataFrame, model: KernelModel, how: KernelRidge | None = None) -> DataFrame:
    """``doc_id, score, predicted`` of every row of ``statistics_table``.

    Empty and null texts are scored like any other; null ids stay null; repeated
    rows are scored alike.
    """
    how = how or KernelRidge()
    shared = table.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = shared.value.score(_matrix(batch))
            predicted = (scores >= how.threshold).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores), pa.array(predicted)], ["doc_id", "score", "predicted"]
            )

    return table.mapInArrow(score, "doc_id long, score double, predicted int")


def good_documents(documents: DataFrame, model: KernelModel, how: KernelRidge | None = None) -> DataFrame:
    """The documents predicted good, with all their columns; nothing is shuffled."""
    how = how or KernelRidge()
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                good = shared.value.score(statistics(part.column("text"))) >= how.threshold
                yield part.filter(pa.array(good, pa.bool_()))

    return documents.mapInArrow(keep, documents.schema)


def fold(doc_id: Column) -> Column:
    """crc32 of the id's decimal text, modulo 5."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5))
