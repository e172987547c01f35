"""Quality rules: fixed limits on word counts, and a learned verdict.

The verdict is a logistic regression on hashed word and character n-grams, fitted
on labelled quality rows and calibrated to probabilities; documents are scored in
Arrow batches against a fixed threshold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.lineage import stored
from newsloom.llm.words import Words, mixed, slices, utf8, words_of

_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[np.frombuffer(b"#*$%&|<>", np.uint8)] = True
_BLANKS = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class QualityRules:
    """Limits of the fixed rules, and the shape of the learned one.

    ``sample_per_class`` bounds the labelled rows of each class that the fit
    reads (of the ids that the documents have, those with the least hash); everything else sees all rows.
    """

    least_words: int = 20
    window: int = 8
    most_repeated_percent: int = 30
    hash_bits: int = 16
    word_orders: tuple[int, ...] = (1, 2)
    char_orders: tuple[int, ...] = (1, 3)
    sample_per_class: int = 1000
    rounds: int = 200
    ridge: float = 1e-6
    threshold: float = 0.3


def repeated_words(words: Words, window: int) -> np.ndarray:
    """Words of each text inside a window of ``window`` words that its text holds twice or more."""
    total = len(words.hashes)
    if total < window:
        return np.zeros(words.n_docs, np.int64)
    last = total - window + 1
    grams = words.hashes[:last].copy()
    for k in range(1, window):
        grams = mixed(grams * np.uint64(0x9E3779B97F4A7C15) + words.hashes[k : last + k])
    grams = mixed(grams + words.docs[:last].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    inside = np.flatnonzero(words.docs[:last] == words.docs[window - 1 :])
    order = inside[np.argsort(grams[inside], kind="stable")]
    same = grams[order[1:]] == grams[order[:-1]]
    twice = np.zeros(len(order), dtype=bool)
    twice[1:] |= same
    twice[:-1] |= same
    edges = np.zeros(total + 1, np.int64)
    np.add.at(edges, order[twice], 1)
    np.add.at(edges, order[twice] + window, -1)
    covered = np.cumsum(edges[:-1]) > 0
    return np.bincount(words.docs[covered], minlength=words.n_docs)


def repeated_lines(text: str | None) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in (text or "").split("\n") if line.strip(_BLANKS)]
    return len(lines) - len(set(lines))


def _features(texts: pa.Array, words: Words, how: QualityRules) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Slot and text number of every n-gram, one kind after the other."""
    slots = np.uint64((1 << how.hash_bits) - 1)
    for n in how.word_orders:
        grams, docs = words.ngrams(n)
        yield (mixed(grams + np.uint64(n)) & slots).astype(np.int64), docs
    data, offsets = utf8(texts)
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    points = np.zeros(len(lead), np.uint64)
    ends = np.append(lead[1:], len(data))
    for k in range(4):
        has = lead + k < ends
        points[has] = (points[has] << np.uint64(8)) | data[lead[has] + k]
    owners = np.searchsorted(offsets, lead, side="right") - 1
    for n in how.char_orders:
        if len(points) < n:
            yield np.zeros(0, np.int64), np.zeros(0, np.int64)
            continue
        last = len(points) - n + 1
        grams = points[:last] + np.uint64(n << 40)
        for k in range(1, n):
            grams = grams * np.uint64(0x9E3779B97F4A7C15) + points[k : last + k]
        inside = owners[:last] == owners[n - 1 :]
        yield (mixed(grams[inside]) & slots).astype(np.int64), owners[:last][inside]


def _labelled(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, label, n`` of the labelled ids that ``n`` rows of the documents have; an id with both labels counts as bad."""
    known = labels.filter("doc_id is not null and quality in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    there = documents.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.count(F.lit(1)).alias("n"))
    return stored(there.join(known.agg(F.min("quality").cast("int").alias("label")), "doc_id"), "quality-labels")


def _sample(documents: DataFrame, labelled: DataFrame, how: QualityRules) -> DataFrame:
    """``doc_id, label, text, calibrates`` of the bounded labelled sample."""
    picked = [
        labelled.filter(F.col("label") == side).select("doc_id", "label").orderBy(F.xxhash64("doc_id"), "doc_id").limit(how.sample_per_class)
        for side in (0, 1)
    ]
    # at most 2 * sample_per_class short rows
    ids = F.broadcast(picked[0].union(picked[1]))
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(ids, "doc_id").select(
        "doc_id", "label", "text", (F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0).alias("calibrates")
    )


def _fitted(slot: np.ndarray, row: np.ndarray, value: np.ndarray, y: np.ndarray, weights: np.ndarray, how: QualityRules) -> np.ndarray:
    """Accelerated gradient descent on the weighted log loss; the last weight is the intercept.

    ``value`` is the share of slot ``slot`` in the n-grams of text ``row``.
    """
    size = (1 << how.hash_bits) + 1
    norm = np.bincount(row, value**2, minlength=len(y)).max(initial=0.0) + 1.0
    step = 4.0 / norm
    w = past = np.zeros(size)
    for k in range(how.rounds):
        ahead = w + (k - 1) / (k + 2) * (w - past)
        margin = np.bincount(row, value * ahead[slot], minlength=len(y)) + ahead[-1]
        error = weights * (1 / (1 + np.exp(-margin)) - y)
        gradient = np.bincount(slot, value * error[row], minlength=size)
        gradient[-1] += error.sum()
        past, w = w, ahead - step * (gradient + how.ridge * ahead)
    return w


def _calibrated(margin: np.ndarray, y: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Platt's sigmoid of the margin, by Newton steps with smoothed targets."""
    n1, n0 = (weights * y).sum(), (weights * (1 - y)).sum()
    target = np.where(y == 1, (n1 + 1 / len(y)) / (n1 + 2 / len(y)), (1 / len(y)) / (n0 + 2 / len(y)))
    scale = max(float(np.abs(margin).max(initial=0.0)), 1e-12)
    m, a, b = margin / scale, 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * m + b, -40, 40)))
        g = weights * (p - target)
        h = weights * p * (1 - p) + 1e-12
        grad = np.array([(g * m).sum() + 1e-4 * a, g.sum()])
        hess = np.array([[(h * m * m).sum() + 1e-4, (h * m).sum()], [(h * m).sum(), h.sum()]])
        move = np.linalg.solve(hess, grad)
        a, b = a - np.clip(move[0], -5, 5), b - np.clip(move[1], -5, 5)
    return float(a / scale), float(b)


@dataclass(frozen=True)
class QualityModel:
    """Slot weights with the intercept last, and the sigmoid over their margin."""

    weights: np.ndarray
    slope: float
    shift: float

    def probability(self, texts: pa.Array, words: Words, how: QualityRules) -> np.ndarray:
        total, n = np.zeros(words.n_docs), np.zeros(words.n_docs)
        for slot, docs in _features(texts, words, how):
            total += np.bincount(docs, self.weights[slot], minlength=words.n_docs)
            n += np.bincount(docs, minlength=words.n_docs)
        margin = total / np.maximum(n, 1) + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -40, 40)))


def fit_quality(documents: DataFrame, labels: DataFrame, how: QualityRules | None = None) -> QualityModel:
    """Fit on the bounded sample, in one task; a quarter of it calibrates.

    Only labels of ids among ``documents`` count, so these are all documents, also
    where the model is applied to some of them. Without both classes every probability is the share of good labels, or 1
    without labels at all.
    """
    how = how or QualityRules()
    known = _labelled(documents, labels)
    shares = {int(r[0]): int(r[1]) for r in known.groupBy("label").agg(F.sum("n")).collect()}

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots: list[np.ndarray] = []
        owners: list[np.ndarray] = []
        labelled: list[np.ndarray] = []
        held: list[np.ndarray] = []
        shares_in_text: list[np.ndarray] = []
        size = (1 << how.hash_bits) + 1
        seen = 0
        for batch in batches:
            for part in slices(batch):
                texts = part.column("text")
                kinds = [docs * np.int64(size) + slot for slot, docs in _features(texts, words_of(texts), how)]
                pairs, counts = np.unique(np.concatenate(kinds), return_counts=True)
                slots.append((pairs % size).astype(np.int32))
                owners.append((pairs // size + seen).astype(np.int32))
                shares_in_text.append(counts.astype(np.float32))
                labelled.append(np.asarray(part.column("label")))
                held.append(np.asarray(part.column("calibrates").cast(pa.int8())).astype(bool))
                seen += part.num_rows
        y = np.concatenate(labelled).astype(float) if labelled else np.zeros(0)
        weights, slope, shift = np.zeros(size), 1.0, 0.0
        if 0 < y.sum() < len(y):
            calibrates = np.concatenate(held)
            if not 0 < y[calibrates].sum() < calibrates.sum() or not 0 < y[~calibrates].sum() < (~calibrates).sum():
                calibrates = np.ones(len(y), dtype=bool)
            fits = ~calibrates if not calibrates.all() else calibrates
            balance = np.where(y == 1, 0.5 / max(y[fits].sum(), 1), 0.5 / max((1 - y)[fits].sum(), 1)) * fits
            slot, row, value = np.concatenate(slots), np.concatenate(owners), np.concatenate(shares_in_text)
            value /= np.maximum(np.bincount(row, value, minlength=len(y)), 1)[row].astype(np.float32)
            weights = _fitted(slot, row, value, y, balance, how)
            margin = np.bincount(row, value * weights[slot], minlength=len(y)) + weights[-1]
            natural = np.where(y == 1, shares.get(1, 1) / y[calibrates].sum(), shares.get(0, 1) / (1 - y)[calibrates].sum())
            natural = natural / natural[calibrates].sum() * calibrates.sum()
            slope, shift = _calibrated(margin[calibrates], y[calibrates], natural[calibrates])
        elif len(y):
            shift = 40.0 if y.all() else -40.0
        else:
            shift = 40.0
        yield pa.RecordBatch.from_arrays(
            [pa.array([weights.astype(np.float32).tobytes()], pa.binary()), pa.array([slope]), pa.array([shift])],
            ["weights", "slope", "shift"],
        )

    # all tasks look for the sample, and only the sample moves; sorted, as sums depend on the order
    sample = _sample(documents, known, how).repartition(1).sortWithinPartitions("doc_id", "text")
    row = sample.mapInArrow(fit, "weights binary, slope double, shift double").first()
    if row is None:
        return QualityModel(np.zeros((1 << how.hash_bits) + 1), 1.0, 40.0)
    return QualityModel(np.frombuffer(row["weights"], np.float32).astype(float), row["slope"], row["shift"])


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _judged(part: pa.RecordBatch, model: QualityModel, how: QualityRules) -> list[np.ndarray]:
    """The five counts, ``base_failed``, ``probability`` and ``kept`` of each row."""
    texts = part.column("text")
    words = words_of(texts)
    n_words = words.per_doc()
    points = np.concatenate([[0], np.cumsum((words.data & 0xC0) != 0x80)])
    chars = np.bincount(words.docs, points[words.ends] - points[words.starts], minlength=words.n_docs)
    symbols = np.concatenate([[0], np.cumsum(_SYMBOLS[words.data])])
    n_symbols = symbols[words.offsets[1:]] - symbols[words.offsets[:-1]]
    lines = np.fromiter((repeated_lines(x) for x in texts.to_pylist()), np.int64, len(texts))
    repeats = repeated_words(words, how.window)
    failed = (n_words < how.least_words) | (100 * repeats > how.most_repeated_percent * n_words)
    probability = model.probability(texts, words, how)
    counts = [x.astype(np.int64) for x in (n_words, chars, n_symbols, lines, repeats)]
    return [*counts, failed, probability, ~failed & (probability >= how.threshold)]


def quality_rules(documents: DataFrame, model: QualityModel, how: QualityRules | None = None) -> DataFrame:
    """One row per document: word statistics, ``base_failed``, ``kept``, ``probability``.

    A null text has no words and fails; null ids stay null; repeated rows are
    judged alike; other columns of ``documents`` are not read.
    """
    how = how or QualityRules()
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *map(pa.array, _judged(part, shared.value, how))],
                    ["doc_id", *_COUNTS, "base_failed", "probability", "kept"],
                )

    counts = ", ".join(f"{x} long" for x in _COUNTS)
    schema = f"doc_id long, {counts}, base_failed boolean, probability double, kept boolean"
    judged = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(judge, schema)
    return judged.select("doc_id", *_COUNTS, "base_failed", "kept", "probability")


def kept_documents(documents: DataFrame, model: QualityModel, how: QualityRules | None = None) -> DataFrame:
    """The documents that ``quality_rules`` keeps, with all their columns; nothing is shuffled."""
    how = how or QualityRules()
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield part.filter(pa.array(_judged(part, shared.value, how)[-1], pa.bool_()))

    return documents.mapInArrow(keep, documents.schema)
