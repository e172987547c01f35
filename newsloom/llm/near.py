"""Near duplicates by SetSketch registers.

A document is the set of its distinct word shingles. Its sketch has ``m``
registers: the least of exponentially distributed element values, on a scale of
powers of ``base``, truncated to small integers (Ertl, "SetSketch: Filling the
Gap between MinHash and HyperLogLog", 2021). Registers merge by maximum and agree
more often the more two sets share, so bands of registers are bucket keys.

Work is split so that no group is gathered and no pair list is made:

* Documents with equal sets are one class, and only classes go on.
* In each bucket every member is compared with the bucket's first class: estimated
  from both sketches by maximum likelihood, then verified on full sets.
* What a bucket still holds under different labels is compared with the bucket's
  most frequent label, in blocks of sets, so that no link is lost. Only links
  leave such a block.

With 64 bands of 7 registers a pair at similarity 0.8 shares no bucket with a
probability of 2e-7.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.lineage import stored
from newsloom.llm.words import mixed, slices, words_of
from newsloom.operators.components import connected_components, numbered


@dataclass(frozen=True)
class Sketching:
    """Shingle length, sketch shape, bands, and the similarity in percent."""

    shingle: int = 2
    bands: int = 64
    rows: int = 7
    base: float = 1.02
    rate: float = 20.0
    highest: int = 4000
    percent: int = 80
    # Pairs are verified unless the estimate is this many standard errors too low.
    slack: float = 6.0

    @property
    def registers(self) -> int:
        return self.bands * self.rows


def _multipliers(n: int) -> np.ndarray:
    return mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def shingle_sets(texts: pa.Array, how: Sketching) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, and the offsets of each text's part.

    A text with fewer words than a shingle has its whole word sequence as its one
    shingle; a text without words, or null, has none.
    """
    words = words_of(texts, fold=True)
    grams, docs = words.ngrams(how.shingle)
    counts = words.per_doc()
    for n in range(1, how.shingle):
        short = counts == n
        if short.any():
            whole, owner = words.ngrams(n)
            keep = short[owner]
            # another constant per length: "a" alone is not the pair "a", ""
            grams = np.concatenate([grams, mixed(whole[keep] + np.uint64(n))])
            docs = np.concatenate([docs, owner[keep]])
    order = np.lexsort((grams, docs))
    grams, docs = grams[order], docs[order]
    new = np.ones(len(grams), dtype=bool)
    new[1:] = (grams[1:] != grams[:-1]) | (docs[1:] != docs[:-1])
    grams, docs = grams[new], docs[new]
    return grams, np.searchsorted(docs, np.arange(words.n_docs + 1))


def sketches(sets: np.ndarray, offsets: np.ndarray, how: Sketching) -> np.ndarray:
    """Registers of each set, one row per set; empty sets have all zeros."""
    sizes = np.diff(offsets)
    full = np.flatnonzero(sizes)
    least = np.full((len(sizes), how.registers), np.iinfo(np.uint64).max, dtype=np.uint64)
    if len(full):
        factors, chunk, at = _multipliers(how.registers), 1 << 15, 0
        while at < len(full):
            end = at + max(1, int(np.searchsorted(offsets[full[at:] + 1], offsets[full[at]] + chunk, side="right")))
            some = full[at:end]
            first, part = offsets[some[0]], sets[offsets[some[0]] : offsets[some[-1] + 1]]
            for k, factor in enumerate(factors):
                values = part * factor
                values ^= values >> np.uint64(32)
                least[some, k] = np.minimum.reduceat(values * factor, offsets[some] - first)
            at = end
    exponential = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64 * (1 - 1e-16)) / how.rate
    values = np.floor(1.0 - np.log(np.maximum(exponential, 1e-300)) / math.log(how.base))
    registers = np.clip(values, 0, how.highest).astype(np.uint16)
    registers[sizes == 0] = 0
    return registers


def band_keys(registers: np.ndarray, how: Sketching) -> np.ndarray:
    """A 64-bit key of each band; equal keys mean equal registers of that band."""
    shaped = registers.reshape(len(registers), how.bands, how.rows).astype(np.uint64)
    keys = np.broadcast_to(np.arange(1, how.bands + 1, dtype=np.uint64), shaped.shape[:2])
    for k in range(how.rows):
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + shaped[:, :, k])
    return keys


def joint_estimate(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int, how: Sketching) -> float:
    """Maximum-likelihood Jaccard similarity of two sketches of known set sizes.

    The counts of greater, smaller and equal registers are jointly multinomial
    with probabilities that depend on the similarity; the likelihood is unimodal
    and is maximised by golden-section search.
    """
    up, down = int((a > b).sum()), int((a < b).sum())
    equal = len(a) - up - down
    share_a, share_b = n_a / (n_a + n_b), n_b / (n_a + n_b)

    def p(x: float) -> float:
        return -math.log1p(-max(x, 0.0) * (how.base - 1) / how.base) / math.log(how.base)

    def likelihood(j: float) -> float:
        more, less = p(share_a - share_b * j), p(share_b - share_a * j)
        terms = ((up, more), (down, less), (equal, 1 - more - less))
        return sum(n * math.log(max(q, 1e-12)) for n, q in terms if n)

    low, high = 0.0, min(n_a, n_b) / max(n_a, n_b)
    ratio = (math.sqrt(5) - 1) / 2
    for _ in range(24):
        left, right = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (left, high) if likelihood(left) < likelihood(right) else (low, right)
    return (low + high) / 2


def _similar(shared: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, how: Sketching) -> np.ndarray:
    return 100 * shared >= how.percent * (n_a + n_b - shared)


def sketch_table(documents: DataFrame, how: Sketching) -> DataFrame:
    """``doc_id, mark, n_shingles, set_a, set_b, keys``: hash of the text, set size, 128-bit hash of the set, band keys."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                sets, offsets = shingle_sets(part.column("text"), how)
                keys = band_keys(sketches(sets, offsets, how), how)
                sizes = np.diff(offsets)
                sums = [np.concatenate([[np.uint64(0)], np.cumsum(x)]) for x in (sets, mixed(sets * np.uint64(3)))]
                whole = [(x[offsets[1:]] - x[offsets[:-1]]).astype(np.int64) for x in sums]
                kept = np.where(sizes > 0, how.bands, 0)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(kept)]), pa.int32()), pa.array(keys[sizes > 0].view(np.int64).ravel())
                )
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("mark"), pa.array(sizes.astype(np.int64)), *map(pa.array, whole), lists],
                    ["doc_id", "mark", "n_shingles", "set_a", "set_b", "keys"],
                )

    schema = "doc_id long, mark long, n_shingles long, set_a long, set_b long, keys array<long>"
    return _marked(documents).mapInArrow(sketch, schema)


def _marked(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("mark"))


def set_table(documents: DataFrame, how: Sketching) -> DataFrame:
    """``rep, shingles, registers`` of the texts of some classes, as packed bytes."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                sets, offsets = shingle_sets(part.column("text"), how)
                packed = [sets[offsets[i] : offsets[i + 1]].tobytes() for i in range(part.num_rows)]
                registers = [x.tobytes() for x in sketches(sets, offsets, how)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("rep"), pa.array(packed, pa.binary()), pa.array(registers, pa.binary())],
                    ["rep", "shingles", "registers"],
                )

    return documents.mapInArrow(pack, "rep long, shingles binary, registers binary")


def _verified(pairs: DataFrame, sets: DataFrame, how: Sketching) -> DataFrame:
    """The pairs ``a, b`` whose sets are similar: estimated first, then intersected."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        floor = how.percent / 100 - how.slack * math.sqrt(0.25 / how.registers)
        for batch in batches:
            rows = batch.to_pydict()
            good: list[tuple[int, int]] = []
            for a, b, xs, ys, xr, yr in zip(*(rows[c] for c in ("a", "b", "xs", "ys", "xr", "yr")), strict=True):
                x, y = np.frombuffer(xs, np.uint64), np.frombuffer(ys, np.uint64)
                if 100 * min(len(x), len(y)) < how.percent * max(len(x), len(y)):
                    continue
                sketch_x, sketch_y = np.frombuffer(xr, np.uint16), np.frombuffer(yr, np.uint16)
                if joint_estimate(sketch_x, sketch_y, len(x), len(y), how) < floor:
                    continue
                shared = len(np.intersect1d(x, y, assume_unique=True))
                if _similar(shared, len(x), len(y), how):
                    good.append((a, b))
            a, b = zip(*good, strict=True) if good else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    left = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("xs"), F.col("registers").alias("xr"))
    right = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("ys"), F.col("registers").alias("yr"))
    return pairs.join(left, "a").join(right, "b").mapInArrow(verify, "a long, b long")


def _block_links(family: pa.Table, how: Sketching) -> pa.Table:
    """Links between the minor sets of a block pair and all sets of the other block."""
    minor = np.asarray(family.column("minor"))
    reps, labels = np.asarray(family.column("rep")), np.asarray(family.column("label"))
    sets = [np.frombuffer(x, np.uint64) for x in family.column("shingles").to_pylist()]
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    others = np.flatnonzero(~minor)
    if not len(others):
        return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
    hashes = np.concatenate([sets[i] for i in others])
    owners = np.repeat(others, sizes[others])
    order = np.argsort(hashes, kind="stable")
    hashes, owners = hashes[order], owners[order]
    links: list[tuple[int, int]] = []
    for i in np.flatnonzero(minor):
        low = np.searchsorted(hashes, sets[i], side="left")
        high = np.searchsorted(hashes, sets[i], side="right")
        counts = high - low
        places = np.repeat(low - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
        shared = np.bincount(owners[places], minlength=len(sets))
        good = _similar(shared, sizes[i], sizes, how) & (labels != labels[i]) & ~minor & (shared > 0)
        # one link per label is enough
        _, firsts = np.unique(labels[good], return_index=True)
        links += [(int(reps[i]), int(reps[j])) for j in np.flatnonzero(good)[firsts]]
    a, b = zip(*links, strict=True) if links else ((), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _remaining_links(members: DataFrame, labels: DataFrame, sets: DataFrame, how: Sketching, block: int) -> DataFrame:
    """Links between sets that share a bucket but not yet a label.

    Each such bucket belongs to its most frequent label; the bucket's other sets
    are minor there. The sets of that label and its minor sets are dealt out in
    blocks, and every minor block meets every block once.
    """
    tagged = members.join(labels, "rep", "left").select("key", "rep", F.coalesce("label", "rep").alias("label"))
    by_label = tagged.groupBy("key", "label").agg(F.count("*").alias("n"))
    main = (
        by_label.groupBy("key")
        .agg(F.max_by("label", F.struct("n", -F.col("label"))).alias("main"), F.count("*").alias("n_labels"))
        .filter("n_labels > 1")
        .select("key", "main")
    )
    minors = tagged.join(main, "key").filter("label <> main").select("main", "rep", "label").distinct()
    minors = stored(minors, "near-minors")
    own = labels.select(F.col("label").alias("main"), "rep", "label")
    alone = minors.select("main").distinct().select("main", F.col("main").alias("rep"), F.col("main").alias("label"))
    everyone = (
        minors.union(own.join(minors.select("main").distinct(), "main", "left_semi")).union(alone).distinct()
    )
    sizes = everyone.groupBy("main").agg(F.count("*").alias("n"))
    minor_sizes = minors.groupBy("main").agg(F.count("*").alias("n_minor"))
    n_blocks = F.ceil(F.col("n") / block).cast("int")
    n_minor_blocks = F.ceil(F.col("n_minor") / block).cast("int")
    counts = sizes.join(minor_sizes, "main").select("main", n_blocks.alias("n_blocks"), n_minor_blocks.alias("n_minor_blocks"))
    place = F.xxhash64("rep")

    def dealt(side: DataFrame, own: str, other: str, minor: bool) -> DataFrame:
        placed = side.join(counts, "main").withColumn("own", F.pmod(place, F.col(own)).cast("int"))
        spread = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        first, second = ("own", "other") if minor else ("other", "own")
        return spread.select(
            "main", F.col(first).alias("i"), F.col(second).alias("j"), "rep", "label", F.lit(minor).alias("minor")
        )

    units = dealt(minors, "n_minor_blocks", "n_blocks", True).union(dealt(everyone, "n_blocks", "n_minor_blocks", False))
    filled = units.join(sets.select("rep", "shingles"), "rep")

    def link(family: pa.Table) -> pa.Table:
        return _block_links(family, how)

    return filled.groupBy("main", "i", "j").applyInArrow(link, "a long, b long")


def _classes(table: DataFrame) -> DataFrame:
    """``rep, head, set_a, set_b, n_shingles, keys``: distinct sets, numbered in the order of their least ids.

    A set and not an id is what others are similar to: an id that comes with several
    texts has a class for each. ``head`` is the least id of the set and the least hash
    of its texts.
    """
    real = table.filter("n_shingles > 0 and doc_id is not null")
    distinct = real.groupBy("set_a", "set_b", "n_shingles").agg(
        F.min(F.struct("doc_id", "mark")).alias("head"), F.min_by("keys", F.struct("doc_id", "mark")).alias("keys")
    )
    return numbered(distinct, "head", "set_a", "set_b", into="rep")


def _grouped(documents: DataFrame, how: Sketching, block: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The sketch table, the classes, and ``rep, component`` of linked classes.

    The number of a component is the least of its classes, whose head has its least id.
    """
    table = stored(sketch_table(documents, how), "near-sketches")
    classes = _classes(table)
    rows = classes.select(F.explode("keys").alias("key"), "rep")
    buckets = rows.groupBy("key").agg(F.min("rep").alias("center"), F.count("*").alias("n")).filter("n > 1")
    members = stored(rows.join(buckets.select("key", "center"), "key"), "near-buckets")
    ids = members.select("rep").distinct()
    heads = classes.select("rep", "head.doc_id", "head.mark").join(ids, "rep", "left_semi")
    texts = _marked(documents).join(heads, ["doc_id", "mark"]).select("rep", "text")
    sets = stored(set_table(texts, how).dropDuplicates(["rep"]), "near-sets")
    star = members.filter("rep <> center").select(F.col("rep").alias("a"), F.col("center").alias("b")).distinct()
    links = stored(_verified(star, sets, how), "near-links")
    labels = stored(connected_components(links).select(F.col("node").alias("rep"), "label"), "near-labels")
    more = stored(_remaining_links(members, labels, sets, how, block), "near-links")
    merged = labels.select(F.col("rep").alias("a"), F.col("label").alias("b")).filter("a <> b")
    final = connected_components(merged.union(more)).select(F.col("node").alias("rep"), F.col("label").alias("component"))
    return table, classes, final


def near_duplicates(documents: DataFrame, how: Sketching | None = None, block: int = 1024) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``documents``.

    ``component_id`` is the least id reachable over links between texts. Null ids are
    kept, stand alone and have a null component; null and empty texts have no shingle
    and are linked with nothing. Rows that repeat an id and its text get the same
    answer; an id with several texts is one document per text, each with the component
    of that text. Other columns of ``documents`` are not read.
    """
    table, classes, final = _grouped(documents, how or Sketching(), block)
    names = classes.select(F.col("rep").alias("component"), F.col("head.doc_id").alias("component_id"))
    own = classes.select("rep", "set_a", "set_b", "n_shingles").join(final, "rep", "left")
    by_set = own.withColumn("component", F.coalesce("component", "rep")).join(names, "component")
    # empty sets and null ids match no class and stand alone
    found = table.drop("keys").join(by_set.select("set_a", "set_b", "n_shingles", "component_id"), ["set_a", "set_b", "n_shingles"], "left")
    linked = F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)
    return found.select("doc_id", "n_shingles", F.when(linked, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def first_of_each(documents: DataFrame, how: Sketching | None = None) -> DataFrame:
    """One document of each group of near duplicates: the one with the least id.

    Where that id has several texts of the group, the one with the least hash stays.
    Texts without shingles are in no group. Rows that repeat an id and a text are reduced
    to one, the least by all columns; documents without an id all stay.
    """
    table, classes, final = _grouped(documents, how or Sketching(), 1024)
    moved = final.filter("component <> rep").select("rep")
    heads = classes.select("rep", "head.doc_id", "head.mark").join(moved, "rep", "left_anti").drop("rep")
    alone = table.filter("n_shingles = 0 and doc_id is not null").select("doc_id", "mark").distinct()
    counts = table.filter("doc_id is not null").groupBy("doc_id", "mark").agg(F.count("*").alias("n"))
    chosen = heads.union(alone).join(counts, ["doc_id", "mark"]).select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), F.col("n").alias("_n"))
    named = documents.filter("doc_id is not null").withColumn("_own", F.xxhash64("text"))
    met = named.join(chosen, (F.col("doc_id").cast("long") == F.col("_id")) & (F.col("_own") == F.col("_mark")))
    repeated = met.filter("_n > 1").groupBy("_id", "_mark").agg(F.min(F.struct(*documents.columns)).alias("_row"))
    single = met.filter("_n = 1").select(documents.columns)
    return single.unionByName(repeated.select("_row.*")).unionByName(documents.filter("doc_id is null"))
