"""Operators on documents against plain Python, with nulls, empty, long and repeated texts."""

from __future__ import annotations

import math
import random
import re
import struct
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark import AccumulatorParam, TaskContext
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from newsloom.llm import classifier, counts, leaks, lm, near, packed, pieces, rules
from newsloom.llm.queries import END_ID, PIECES, WORDS
from newsloom.llm.words import words_of

WORD = re.compile(r"[^\x20\t-\r]+")


@pytest.fixture(scope="module")
def texts() -> list[tuple[int | None, str | None]]:
    """Near copies, exact copies, nulls, empties, one-word, exotic and very long texts."""
    random.seed(4)
    stock = ["alpha", "beta", "Gamma", "delta,", "épée", "zeta.", "eta", "ñu", "iota!", "kappa", "日本", "😀", "don't", "x\x0by"]
    rows: list[tuple[int | None, str | None]] = []
    for i in range(60):
        rows.append((i, " ".join(random.choices(stock, k=random.randint(15, 60)))))
    base = random.choices([f"w{k}" for k in range(400)], k=120)
    for i in range(60, 100):
        copy = list(base)
        for _ in range(random.randint(0, 9)):
            copy[random.randrange(len(copy))] = f"n{random.randrange(10**6)}"
        rows.append((i, random.choice([" ", "\n"]).join(copy)))
    rows += [(100, None), (101, ""), (102, " \n\t "), (103, "one"), (104, "ONE"), (105, "one two"), (106, "a b c\u0085d")]
    rows += [(107, " ".join(base).upper()), (108, " ".join(base).lower()), (None, "no id at all"), (109, "long " * 30000)]
    rows += [(110, "<|startoftext|> x"), (111, "▁ mark"), (112, "  two  blanks  "), (5, rows[5][1])]
    return rows


@pytest.fixture(scope="module")
def documents(spark, texts):
    frame = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    # columns whose names the operators use themselves
    for name in ("rep", "label", "key", "block", "kept", "n_words", "ids", "component_id"):
        frame = frame.withColumn(name, F.lit("other"))
    return frame


@pytest.fixture(scope="module")
def empty(documents):
    return documents.limit(0)


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def test_words_match_the_pattern(texts):
    found = words_of(pa.array([t for _, t in texts]))
    assert [found.text(i) for i in range(len(found.starts))] == [w for _, t in texts for w in words(t)]
    assert found.per_doc().tolist() == [len(words(t)) for _, t in texts]
    by_hash: dict[int, str] = {}
    for i, h in enumerate(found.hashes.tolist()):
        assert by_hash.setdefault(h, found.text(i)) == found.text(i)


def shingles(text: str | None, n: int = 2) -> frozenset:
    own = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not own:
        return frozenset()
    return frozenset(zip(*(own[k:] for k in range(n)), strict=False)) if len(own) >= n else frozenset([tuple(own)])


@pytest.mark.parametrize("n", [2, 5])
def test_near_duplicates_equal_brute_force(documents, texts, n):
    sets = [(d, shingles(t, n)) for d, t in texts]
    parent = {d: d for d, _ in sets if d is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if a is not None and b is not None and x and y and 100 * len(x & y) >= 80 * len(x | y):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    expected = Counter((d, len(s), None if d is None else root(d)) for d, s in sets)
    got = near.near_duplicates(documents, near.Sketching(shingle=n), block=8).collect()
    assert Counter(tuple(r) for r in got) == expected


def test_near_duplicates_of_nothing(empty):
    assert near.near_duplicates(empty).collect() == []


def test_first_of_each_keeps_one_row_per_group(documents):
    kept = near.first_of_each(documents)
    assert kept.columns == documents.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert len(ids) == len(set(ids)) and None in ids and 108 not in ids


def test_ids_with_several_texts_lose_no_link_and_no_text(spark):
    base = " ".join(f"w{i}" for i in range(200))
    other = " ".join(f"v{i}" for i in range(200))
    rows = [(1, other), (1, base), (9, base + " more"), (9, other.upper()), (9, other), (7, ""), (7, " "), (3, base), (3, base)]
    frame = spark.createDataFrame([(d, t, i) for i, (d, t) in enumerate(rows)], "doc_id long, text string, place int").repartition(3)
    got = Counter(tuple(r) for r in near.near_duplicates(frame).collect())
    assert got == Counter({(1, 199, 1): 2, (9, 200, 1): 1, (9, 199, 1): 2, (7, 0, 7): 2, (3, 199, 1): 2})
    kept = sorted((r.doc_id, r.text) for r in near.first_of_each(frame).collect())
    # one row per group of texts, both under id 1, and the texts without words
    assert kept == [(1, other), (1, base), (7, ""), (7, " ")]
    again = near.first_of_each(spark.createDataFrame([(5, base, 2), (5, base, 1), (5, base, 3)], frame.schema)).collect()
    assert [tuple(r) for r in again] == [(5, base, 1)]


def test_recall_of_five_word_shingles_on_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    sets = [(d, shingles(t, 5)) for d, t in rows]
    holders = {}
    for d, s in sets:
        for x in s:
            holders.setdefault(x, []).append(d)
    own, pairs = dict(sets), set()
    for d, s in sets:
        shared = Counter(e for x in s for e in holders[x] if e < d)
        pairs |= {(e, d) for e, n in shared.items() if 100 * n >= 80 * (len(s) + len(own[e]) - n)}
    found = near.near_duplicates(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), near.Sketching(shingle=5))
    component = {r.doc_id: r.component_id for r in found.collect()}
    linked = sum(component[a] == component[b] for a, b in pairs)
    assert len(pairs) > 20 and linked == len(pairs)
    assert sum(d != c for d, c in component.items()) <= len(pairs)


def test_sketch_estimates_similarity():
    how = near.Sketching()
    random_ = np.random.default_rng(1)
    shared = random_.integers(0, 2**63, 800, dtype=np.uint64)
    sides = [np.sort(np.concatenate([shared, random_.integers(0, 2**63, 100, dtype=np.uint64)])) for _ in range(2)]
    registers = near.sketches(np.concatenate(sides), np.array([0, 900, 1800]), how)
    assert abs(near.joint_estimate(*registers, 900, 900, how) - 0.8) < 0.08
    union = np.unique(np.concatenate(sides))
    merged = near.sketches(union, np.array([0, len(union)]), how)[0]
    assert (merged == np.maximum(*registers)).all()


def brute_scores(rows, order, alpha):
    grams = Counter()
    own = []
    for _, t in rows:
        w = words(t)
        c = Counter(tuple(w[i - n + 1 : i + 1]) for n in range(1, order + 1) for i in range(n - 1, len(w)))
        own.append(c)
        grams += c
    everything = sum(len(words(t)) for _, t in rows)
    for (d, t), c in zip(rows, own, strict=True):
        w, total, back = words(t), 0, 0
        rest = everything - len(w)
        for i in range(len(w)):
            possible = min(order, i + 1)
            for n in range(possible, 0, -1):
                g = tuple(w[i - n + 1 : i + 1])
                up, down = grams[g] - c[g], rest if n == 1 else grams[g[:-1]] - c[g[:-1]]
                if up > 0 and down > 0:
                    score, used = up / down, n
                    break
            else:
                score, used, n = 1 / (rest + 1), 0, 1
            total += round(1e6 * (math.log10(score) + (possible - n) * math.log10(alpha)))
            back += used < possible
        yield d, len(w), back, total


@pytest.mark.parametrize("order", [1, 2, 3])
def test_backoff_scores_equal_brute_force(documents, texts, order):
    how = lm.BackoffModel(order=order, block_bytes=20_000, part_bytes=10_000)
    got = Counter(tuple(r) for r in lm.backoff_scores(documents, how).collect())
    assert got == Counter(brute_scores(texts, order, how.alpha))


def test_backoff_scores_of_nothing(empty):
    assert lm.backoff_scores(empty).collect() == []


def best_count(token: str, vocabulary: counts.UnigramScores) -> int:
    best = [(0.0, 0)]
    for end in range(1, len(token) + 1):
        options = []
        for start in range(end):
            if token[start:end] in vocabulary.scores:
                options.append((best[start][0] + vocabulary.scores[token[start:end]], -start, best[start][1] + 1))
        last = token[end - 1]
        if last not in vocabulary.scores:
            options.append((best[end - 1][0] + vocabulary.unknown, -end, best[end - 1][1] + len(last.encode())))
        top = max(options)
        best.append((top[0], top[2]))
    return best[-1][1]


def test_token_counts_equal_plain_dynamic_programming(documents, texts):
    vocabulary = counts.UnigramScores.of(pieces.load_model(PIECES))
    known = {w: best_count("▁" + w, vocabulary) for _, t in texts for w in set(words(t))}
    expected = Counter((d, len(words(t)), len(set(words(t))), sum(known[w] for w in words(t))) for d, t in texts)
    assert Counter(tuple(r) for r in counts.token_counts(documents, PIECES).collect()) == expected


def unigram_library(model: pieces.PieceModel) -> Tokenizer:
    """The library's Unigram with the scores that the trie uses."""
    scores = counts.UnigramScores.of(model).scores
    same = tuple(scores.get(p, min(scores.values())) for p in model.pieces)
    return pieces.build_tokenizer(pieces.PieceModel(**(vars(model) | {"model_type": pieces.UNIGRAM, "scores": same})))


def test_token_counts_agree_with_the_unigram_library():
    model = pieces.load_model(PIECES)
    unigram = unigram_library(model)
    trie = counts.ForwardTrie(counts.UnigramScores.of(model))
    for token in sorted(["information", "informative", "infos", "日本x", "😀", "a,b", "zzzzzz", "Straße"]):
        assert trie.count("▁" + token) == len(unigram.encode(token, add_special_tokens=False).ids)


def test_token_counts_of_whole_texts_equal_the_unigram_library(spark):
    unigram = unigram_library(pieces.load_model(PIECES))
    rows = [(r.doc_id, " ".join(words(r.text))) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    got = counts.token_counts(spark.createDataFrame(rows, "doc_id long, text string"), PIECES).collect()
    assert {r.doc_id: r.n_tokens for r in got} == {d: len(unigram.encode(t, add_special_tokens=False).ids) if t else 0 for d, t in rows}


def test_merge_order_gives_log_probabilities():
    vocabulary = counts.UnigramScores.of(pieces.load_model(PIECES))
    assert math.isclose(sum(map(math.exp, vocabulary.scores.values())), 1.0, rel_tol=1e-9)
    trie = counts.ForwardTrie(vocabulary)
    assert [trie.count("▁" + w) for w in ("about", "government", "understanding")] == [1, 1, 1]
    unigram = pieces.PieceModel(("<unk>", "a", "b"), (0.0, -1.5, -0.5), (2, 1, 1), pieces.UNIGRAM, False, b"", True, False)
    assert counts.UnigramScores.of(unigram).scores == {"a": -1.5, "b": -0.5}


def test_piece_ids_equal_the_original_library(documents, texts):
    original = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = pieces.encode_pieces(documents, PIECES)
    rows = got.collect()
    expected = Counter((d, tuple(original.encode(t or ""))) for d, t in texts)
    assert Counter((r.doc_id, tuple(r.ids)) for r in rows) == expected
    assert all(r.n_tokens == len(r.ids) and r.n_unlike == 0 for r in rows)
    decoded = {(r.doc_id, r.text) for r in pieces.decode_pieces(got, PIECES).collect()}
    assert decoded == {(d, (t or "").replace("▁", " ")) for d, t in texts}
    assert [r.doc_id for r in rows if r.n_lossy] == [111]


def test_whole_documents_decode_to_themselves(documents, texts):
    encoded = pieces.encode_pieces(documents, PIECES).persist()
    # only the text that holds a mark is not what its ids say
    assert [r.doc_id for r in encoded.collect() if not r.round_trip] == [111]
    decoded = Counter((r.doc_id, r.text) for r in pieces.decode_pieces(encoded, PIECES).collect())
    assert decoded == Counter((d, (t or "").replace("▁", " ")) for d, t in texts)
    encoded.unpersist()
    encoder = pieces.PieceEncoder(PIECES)
    ids, counts, _, _ = encoder.encode(["one two", "three"])
    assert encoder.round_trips(["one two", "three"], ids, counts) == [True, True]
    assert encoder.round_trips(["one twO", None], ids, counts) == [False, False]


def test_parity_is_unknown_where_texts_are_not_compared(monkeypatch):
    encoder = pieces.PieceEncoder(PIECES)
    assert encoder.verified
    monkeypatch.setattr(encoder, "model", pieces.PieceModel(**(vars(encoder.model) | {"squeeze": True})))
    assert not encoder.verified


def test_runs_of_blanks_and_unigram_models_have_parity(tmp_path):
    original = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    whole = pieces.build_tokenizer(pieces.load_model(PIECES))
    for n in range(40):
        text = "q" + " " * n + "w"
        assert whole.encode(text, add_special_tokens=False).ids == original.encode(text)
    model = pieces.load_model(PIECES)
    assert model.kinds[model.unknown] == pieces.UNKNOWN and model.byte_fallback and model.dummy_prefix


def test_token_files_round_trip(documents, texts, spark):
    tokenizer = Tokenizer.from_file(WORDS)
    rows = sorted(texts, key=lambda r: (-1 if r[0] is None else r[0], r[1] or ""))
    expected, at = [], 0
    for d, t in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, END_ID]
        expected.append((d, at, len(ids), ids))
        at += len(ids)
    manifest = packed.write_token_files(documents, WORDS, END_ID, packed.PackedBlocks(block=64))
    got = packed.read_token_files(manifest, group=3).collect()
    assert sorted((tuple(r) for r in got), key=lambda r: r[1]) == expected
    sums = {(r.start, r.ids_crc32) for r in packed.read_digests(manifest).collect()}
    assert sums == {(s, zlib.crc32(struct.pack(f"<{n}I", *ids))) for _, s, n, ids in expected}


def test_number_of_token_files_follows_the_bytes(spark):
    rows = [(i, f"document number {i} " * (i % 50)) for i in range(300)]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    size = sum(len(t) for _, t in rows)
    few = packed.write_token_files(documents, WORDS, END_ID)
    many = packed.write_token_files(documents, WORDS, END_ID, packed.PackedBlocks(file_bytes=size // 40))
    assert few.count() <= 4 and 30 <= many.count() <= 41
    assert sorted(packed.read_digests(few).collect()) == sorted(packed.read_digests(many).collect())


@pytest.mark.parametrize("text", ["a <|EndOfText|> b", "x<|STARTOFTEXT|>y", "<|endoftext|> <|EndOfText|>", "Plain, WORDS."])
def test_word_ids_equal_whole_texts_around_special_tokens(text):
    tokenizer = Tokenizer.from_file(WORDS)
    encoder = packed.WordIds(WORDS)
    # what is held from one slice must not change the next
    for some in ([text], ["<|endoftext|>", text], ["Plain, WORDS.", text], [text, None]):
        ids, sizes = encoder.encode(pa.array(some, pa.string()))
        expected = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in some]
        assert sizes.tolist() == [len(x) for x in expected]
        assert ids.tolist() == [i for x in expected for i in x]


def test_token_files_of_nothing(empty):
    assert packed.read_token_files(packed.write_token_files(empty, WORDS, END_ID)).collect() == []


@pytest.mark.parametrize("ids", [[7], [0] * 200, [5, 2**31, 6, 7] * 50, list(range(3000)), [2**32 - 1, 0]])
def test_blocks_hold_any_ids(ids):
    how = packed.PackedBlocks(block=128)
    blocks = packed.encode_blocks(np.array(ids, np.int64), how)
    back = [packed.decode_block(b, min(128, len(ids) - k * 128)) for k, b in enumerate(blocks)]
    assert np.concatenate(back).tolist() == ids


def rule_counts(text: str | None) -> tuple:
    w = words(text)
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {i + k for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for k in range(8)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), failed


def labelled(spark, n=240):
    random.seed(8)
    good = ["the", "river", "was", "calm", "and", "people", "walked", "along", "its", "bank"]
    rows = []
    for i in range(n):
        if i % 4:
            rows.append((i, " ".join(random.choices(good, k=60)) + ".", 1))
        else:
            rows.append((i, " ".join(f"{random.choice(good).upper()}$$${i}" for _ in range(60)), 0))
    frame = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    return frame.select("doc_id", "text"), frame.select("doc_id", "quality"), {i: q for i, _, q in rows}


def test_rule_counts_equal_plain_python(documents, texts, spark):
    train, labels, _ = labelled(spark)
    model = rules.fit_quality(train, labels)
    got = rules.quality_rules(documents, model).collect()
    assert Counter(tuple(r)[:7] for r in got) == Counter((d, *rule_counts(t)) for d, t in texts)
    assert all(r.kept == (not r.base_failed and r.probability >= 0.3) and 0 <= r.probability <= 1 for r in got)
    kept = rules.kept_documents(documents, model)
    assert kept.columns == documents.columns and kept.count() == sum(r.kept for r in got)


def test_learned_verdict_separates_held_back_rows(spark):
    docs, labels, truth = labelled(spark)
    model = rules.fit_quality(docs, labels.filter("doc_id % 3 > 0"))
    held = [r for r in rules.quality_rules(docs, model).collect() if r.doc_id % 3 == 0]
    assert sum((r.probability >= 0.3) == bool(truth[r.doc_id]) for r in held) >= 0.95 * len(held)


def test_rules_without_labels_or_rows(documents, empty, spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = rules.fit_quality(documents, none)
    got = rules.quality_rules(documents, model).collect()
    assert all(r.kept == (not r.base_failed) for r in got)
    assert rules.quality_rules(empty, rules.fit_quality(empty, none)).collect() == []


def test_labels_of_missing_documents_take_no_place_in_the_fit(spark):
    docs, labels, truth = labelled(spark)
    missing = spark.range(10_000, 15_000).selectExpr("id as doc_id", "cast(id % 2 as int) as quality")
    how = rules.QualityRules(sample_per_class=50)
    want = rules.fit_quality(docs, labels, how)
    got = rules.fit_quality(docs, labels.select("doc_id", "quality").unionByName(missing), how)
    np.testing.assert_allclose(got.weights, want.weights, rtol=1e-4, atol=1e-6)
    assert (got.slope, got.shift) == pytest.approx((want.slope, want.shift), rel=1e-4)


class Lists(AccumulatorParam):
    def zero(self, value):
        return []

    def addInPlace(self, value1, value2):
        return value1 + value2


def test_no_single_task_reads_all_documents_for_the_fit(spark):
    docs, labels, _ = labelled(spark)
    seen = spark.sparkContext.accumulator([], Lists())

    def read(batches):
        context = TaskContext.get()
        seen.add([(context.stageId(), context.partitionId())])
        yield from batches

    rules.fit_quality(docs.repartition(5).mapInArrow(read, docs.schema), labels)
    stages = {s for s, _ in seen.value}
    assert stages and all({p for s, p in seen.value if s == stage} == set(range(5)) for stage in stages)


def test_classifier_on_held_out_rows(spark, documents, texts):
    docs, labels, truth = labelled(spark, 600)
    table = classifier.stored_statistics(docs)
    model = classifier.fit_classifier(table, labels, classifier.fold(F.col("doc_id")) != 0)
    held = [r for r in classifier.classify(table, model).collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(held) > 50 and sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    everything = classifier.classify(classifier.statistics_table(documents), model).collect()
    assert len(everything) == len(texts) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in everything)
    kept = classifier.good_documents(documents, model)
    assert kept.columns == documents.columns and kept.count() == sum(r.predicted for r in everything)


def test_classifier_without_labels(empty, documents, spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    for frame in (empty, documents):
        table = classifier.stored_statistics(frame)
        model = classifier.fit_classifier(table, none, F.lit(True))
        assert all(r.score == 1 for r in classifier.classify(table, model).collect())


def test_pooled_levels_never_fall():
    levels = classifier._pooled(np.array([1.0, 2, 1, 4]), np.array([1.0, 0, 1, 2]))
    assert np.allclose(levels, [1 / 3, 1 / 3, 3 / 5, 3 / 5])


def test_pooled_levels_equal_the_minimax_formula():
    rng = np.random.default_rng(3)
    for _ in range(40):
        n = int(rng.integers(1, 12))
        counts = rng.integers(1, 6, n).astype(float)
        sums = np.floor(rng.random(n) * (counts + 1))
        means = [[sums[a : b + 1].sum() / counts[a : b + 1].sum() if b >= a else 0.0 for b in range(n)] for a in range(n)]
        want = [max(min(means[a][b] for b in range(i, n)) for a in range(i + 1)) for i in range(n)]
        assert np.allclose(classifier._pooled(counts, sums), want)


def test_ridge_weights_equal_numpy(spark):
    how = classifier.KernelRidge(features=24, bins=50)
    rng = np.random.default_rng(8)
    n = 400
    x = rng.normal(size=(n, len(classifier.STATISTICS))) * np.arange(1, len(classifier.STATISTICS) + 1)
    y = (x[:, 0] + x[:, 1] / 2 + rng.normal(size=n) > 0).astype(int)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "doc_id long, statistics array<double>").repartition(5)
    labels = spark.createDataFrame([(i, int(v)) for i, v in enumerate(y)] + [(7_000, 1), (None, 0), (3, None)], "doc_id long, quality int")
    model = classifier.fit_classifier(table, labels, classifier.fold(F.col("doc_id")) != 0, how)
    folds = spark.range(n).select("id", classifier.fold(F.col("id")).alias("fold"), F.pmod(F.xxhash64("id"), F.lit(3)).alias("third")).collect()
    used = np.array([r.id for r in folds if r.fold != 0])
    fits = np.array([r.id for r in folds if r.fold != 0 and r.third != 0])
    assert np.allclose(model.mean, x[used].mean(axis=0)) and np.allclose(model.scale, x[used].std(axis=0) + 1e-6)
    z = model.features(x[fits])
    weight = np.where(y[fits] > 0, 1.0, 4.0)
    left = z.T @ (z * weight[:, None])
    penalty = how.ridge * max(np.trace(left) / left.shape[0], 1.0) * np.eye(len(left))
    penalty[-1, -1] = 0
    assert np.allclose(model.weights, np.linalg.solve(left + penalty, z.T @ (y[fits] * weight)), atol=1e-8)
    rest = np.setdiff1d(used, fits)
    bins = np.clip((model.raw(x[rest]) + 0.5) / 2 * how.bins, 0, how.bins - 1).astype(int)
    filled = np.unique(bins)
    counts = np.array([(bins == b).sum() for b in filled], float)
    assert np.allclose(model.levels, classifier._pooled(counts, np.array([y[rest][bins == b].sum() for b in filled], float)))


def test_repeated_labels_count_once_and_both_labels_as_two_rows(spark):
    how = classifier.KernelRidge(features=8, bins=20)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(60, len(classifier.STATISTICS)))
    schema = "doc_id long, statistics array<double>"
    pairs = [(i, int(x[i, 0] > 0)) for i in range(60)]

    def fitted(rows, labels):
        return classifier.fit_classifier(
            spark.createDataFrame(rows, schema), spark.createDataFrame(labels, "doc_id long, quality int"), F.lit(True), how
        )

    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    plain, again = fitted(rows, pairs), fitted(rows, pairs + pairs[:30] + pairs[:5])
    assert np.allclose(plain.weights, again.weights) and np.allclose(plain.levels, again.levels)
    # ids 0 and 1 with both labels: as if their rows were there twice, once with each
    both = fitted(rows, pairs + [(i, 1 - pairs[i][1]) for i in (0, 1)])
    weights = np.concatenate([x, x[:2]])
    assert np.allclose(both.mean, weights.mean(axis=0)) and np.allclose(both.scale, weights.std(axis=0) + 1e-6)


def edit_distance_to_part(pattern: str, text: str) -> int:
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        last, row = row, [i]
        for j, c in enumerate(text, 1):
            row.append(min(last[j - 1] + (p != c), last[j] + 1, row[-1] + 1))
    return min(row)


def test_blocks_of_items_are_taken_one_after_the_other(spark):
    items = [(i, f"item number {i} of the benchmark " + "abc" * (i % 7)) for i in range(60)] + [(60, None), (61, ""), (3, "item number 3 of the benchmark abcabcabc")]
    docs = [(i, f"before {items[i][1]} after" if i < 60 and i % 2 else f"clean {i}") for i in range(70)] + [(None, items[5][1]), (70, None), (71, items[7][1] + " x" * 40_000)]
    bench = spark.createDataFrame(items, "item_id long, text string").repartition(2)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    few, one = leaks.EditBudget(block_chars=300), leaks.EditBudget()
    assert len(leaks.stored_blocks(bench, few)) > 5 and len(leaks.stored_blocks(bench, one)) == 1
    assert Counter(leaks.benchmark_hits(frame, bench, few).collect()) == Counter(leaks.benchmark_hits(frame, bench, one).collect())
    assert Counter(leaks.without_benchmark(frame, bench, few).collect()) == Counter(leaks.without_benchmark(frame, bench, one).collect())
    assert leaks.without_benchmark(frame, bench.limit(0), few).count() == len(docs)


def test_benchmark_hits_equal_brute_force(spark):
    random.seed(3)
    stock = ["sun", "moon", "star", "cloud", "rain", "wind", "snow", "hail", "mist", "frost"]
    items = [(i, " ".join(random.choices(stock, k=20))) for i in range(12)] + [(12, None), (13, ""), (3, "sun moon")]
    docs: list[tuple[int | None, str | None]] = []
    for d in range(60):
        text = " ".join(random.choices(stock, k=30))
        if d % 2:
            passage = list(random.choice(items[:12])[1])
            for _ in range(random.randint(0, 12)):
                at = random.randrange(len(passage))
                random.choice([lambda: passage.pop(at), lambda: passage.insert(at, "q"), lambda: passage.__setitem__(at, "z")])()
            text += " " + "".join(passage).upper().replace(" ", "\n", 3) + " " + text
        docs.append((d, text))
    docs += [(100, None), (101, ""), (None, items[0][1]), (1, docs[1][1])]
    how = leaks.EditBudget(block_chars=300)
    expected = Counter()
    for d, t in docs:
        for i, item in items:
            flat = leaks.plain(item)
            if flat and t:
                distance = edit_distance_to_part(flat, leaks.plain(t))
                if distance <= how.of(flat):
                    expected[d, i, distance] += 1
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("x"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = leaks.benchmark_hits(frame, bench, how).collect()
    assert Counter((r.doc_id, r.item_id, r.distance) for r in got) == expected
    found = {d for d, _, _ in expected}
    clean = leaks.without_benchmark(frame, bench, how)
    assert clean.columns == frame.columns
    assert Counter(r.doc_id for r in clean.collect()) == Counter(d for d, _ in docs if d not in found)
    assert leaks.benchmark_hits(frame, bench.limit(0)).collect() == []
    assert leaks.benchmark_hits(frame.limit(0), bench).collect() == []
