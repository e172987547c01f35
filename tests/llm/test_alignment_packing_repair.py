"""Token alignment, packing and conversation repair against plain Python."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations_with_replacement

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from newsloom.llm import align, packing, repair
from newsloom.llm.queries import BYTES, PIECES, QUERIES, WORDS

SF_DIR = "/root/testdata/sf0.001"
ODD_TEXTS = [
    (None, "hello world"), (-1, None), (-2, ""), (-3, " a  b "), (-4, "x▁y z"), (-5, "日本語 a"), (-5, "日本語 a"), (-6, " "),
    (-7, "<|endoftext|> </s> <0x41>"), (-8, "a b\x85 c  d\x1c e\n f\x00"), (-9, "word " * 30_000), (-10, "x" * 40_000),
]


@pytest.fixture(scope="module")
def documents(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()] + ODD_TEXTS


def rows_of(df):
    return sorted(map(repr, df.collect()))


# ---- alignment


def token_bytes():
    a, b = Tokenizer.from_file(BYTES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    a.encode_special_tokens = True
    entries = align._byte_level(a.get_vocab(with_added_tokens=True))
    pieces = [b.id_to_piece(i) for i in range(b.get_piece_size())]
    pieces = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x..>", p) else p.replace("▁", " ").encode() for p in pieces]
    return a, b, entries, pieces


def plain_alignment(text, tools):
    """Ids of both sides, groups and links, by two pointers."""
    a, b, entries, pieces = tools
    if not text:
        return None
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    whole = (" " + text).encode()
    if b"".join(entries[i] for i in ids_a) != whole or b"".join(pieces[i] for i in ids_b) != whole:
        return None
    i = j = end_a = end_b = 0
    groups, links, group = [], [], ([], [])
    end_a, end_b = len(entries[ids_a[0]]), len(pieces[ids_b[0]])
    while i < len(ids_a):
        links.append((i, j))
        step_a, step_b = end_a <= end_b, end_b <= end_a
        if step_a:
            group[0].append(ids_a[i])
        if step_b:
            group[1].append(ids_b[j])
        if step_a and step_b:
            groups.append(group)
            group = ([], [])
        if step_a:
            i += 1
            end_a += len(entries[ids_a[i]]) if i < len(ids_a) else 0
        if step_b:
            j += 1
            end_b += len(pieces[ids_b[j]]) if j < len(ids_b) else 0
    return ids_a, ids_b, groups, links


def test_alignment_equals_two_pointers(spark, documents):
    tools = token_bytes()
    found = [(doc, plain_alignment(text, tools)) for doc, text in documents]
    counts = Counter()
    for _, x in found:
        if x:
            counts.update({(x[0][i], x[1][j]) for i, j in x[3]})
    best = defaultdict(int)
    for (i, _), n in counts.items():
        best[i] = max(best[i], n)
    expected = []
    for doc, x in found:
        if x is None:
            expected.append((doc, 0, 0, 0, 0, 0, 0, ""))
            continue
        pairs = [(x[0][i], x[1][j]) for i, j in x[3]]
        spelled = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in x[2])
        expected.append((
            doc, len(x[0]), len(x[1]), len(x[2]), len(pairs), sum(counts[p] == best[p[0]] for p in pairs),
            sum(counts[p] for p in pairs), hashlib.sha256(spelled.encode()).hexdigest(),
        ))
    df = spark.createDataFrame(documents, "doc_id long, text string").selectExpr("*", "1 as n_a", "2 as block", "3 as pair")
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    small = align.AlignedBlocks(block_bytes=100_000, chunks=3000)
    for how in (None, small):
        got = align.aligned_counts(df.repartition(3), BYTES, PIECES, how).select(columns)
        assert sorted(repr(tuple(r)) for r in got.collect()) == sorted(map(repr, expected))


def test_alignments_hold_all_links(spark, documents):
    tools = token_bytes()
    some = documents[:40] + ODD_TEXTS
    got = align.alignments(spark.createDataFrame(some, "doc_id long, text string").coalesce(1), BYTES, PIECES).collect()
    for (doc, text), r in zip(some, got, strict=True):
        x = plain_alignment(text, tools)
        assert r.doc_id == doc
        if x is None:
            assert r.a_ids == r.b_ids == r.group_ends == r.link_a == []
        else:
            assert (r.a_ids, r.b_ids, list(zip(r.link_a, r.link_b, strict=True))) == (x[0], x[1], x[3])
            assert r.group_ends == sorted(set(r.a_ends) & set(r.b_ends)) and len(r.group_ends) == len(x[2])


def test_chunks_encode_as_whole_texts():
    a, b, _, _ = token_bytes()
    held = align.Aligner(BYTES, PIECES, 1000)
    rng = random.Random(5)
    parts = [" ", "  ", "\n", "\t", "a", "'s", "the", "É", "日本", "🙂", " ", "　", "<|endoftext|>", "<s>", "<0x41>", "12", "!", "\r\n", "\x1c", "\x85", "​", " word"]
    for _ in range(2000):
        text = "".join(rng.choices(parts, k=rng.randint(1, 25)))
        got_a, got_b = held.tokens(align._CUT.split(" " + text))
        assert [i for x in got_a for i in x] == a.encode(" " + text, add_special_tokens=False).ids, text
        assert [i for x in got_b for i in x] == b.encode(text), text


def test_alignment_of_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert align.aligned_counts(empty, BYTES, PIECES).collect() == [] == align.alignments(empty, BYTES, PIECES).collect()


# ---- packing


def plain_pieces(documents, longest):
    tokenizer = Tokenizer.from_file(WORDS)
    out = []
    for doc, text in documents:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), longest)):
            out.append((doc, k, at, ids[at : at + longest]))
    return out


def test_packing_holds_every_piece_once(spark, documents):
    df = spark.createDataFrame(documents, "doc_id long, text string").selectExpr("*", "1 as piece", "2 as length")
    how = packing.Packing(longest=2048)
    packed = packing.pack_documents(df.repartition(3), WORDS, 0, how).collect()
    expected = plain_pieces(documents, 2048)
    assert sorted(repr((r.doc_id, r.piece, r.start, r.ids)) for r in packed) == sorted(map(repr, expected))
    room = defaultdict(list)
    for r in packed:
        room[r.sequence_id].append((r.offset, r.length))
        assert r.length == len(r.ids)
    for spans in room.values():
        ends = np.cumsum([n for _, n in sorted(spans)])
        assert [a for a, _ in sorted(spans)] == [0, *ends[:-1]] and ends[-1] <= 2048
    bound = -(-sum(len(x[3]) for x in expected) // 2048)
    assert bound <= len(room) <= bound + 1
    digests = packing.pack_documents(df, WORDS, 0, how, digest=True).collect()
    assert sorted(repr((r.doc_id, r.piece, r.ids_crc32)) for r in digests) == sorted(
        repr((d, k, zlib.crc32(np.array(ids, "<u4").tobytes()))) for d, k, _, ids in expected
    )


def test_sequences_are_their_pieces(spark, documents):
    df = spark.createDataFrame(documents, "doc_id long, text string")
    packed = packing.pack_documents(df, WORDS, 0)
    pieces = defaultdict(list)
    packed = packed.persist()
    for r in packed.collect():
        pieces[r.sequence_id].append((r.offset, r.ids))
    for r in packing.sequences(packed).collect():
        own = sorted(pieces.pop(r.sequence_id))
        assert r.ids == [i for _, ids in own for i in ids] and r.starts == [a for a, _ in own]
    assert not pieces
    packed.unpersist()


def test_packing_of_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack_documents(empty, WORDS, 0).collect() == []


def least_bins(pieces, room):
    """The least number of bins, by trying all."""
    pieces = sorted(pieces, reverse=True)

    def fits(n):
        def place(at, bins):
            if at == len(pieces):
                return True
            return any(place(at + 1, tuple(sorted(bins[:k] + (bins[k] + pieces[at],) + bins[k + 1 :])))
                       for k in range(n) if bins[k] + pieces[at] <= room and (k == 0 or bins[k] != bins[k - 1]))

        return place(0, (0,) * n)

    return next(n for n in range(len(pieces) + 1) if fits(n))


def test_plan_is_close_to_the_least_number():
    rng = random.Random(2)
    more = 0
    for _ in range(60):
        pieces = [rng.randint(1, 20) for _ in range(rng.randint(0, 9))]
        plan = packing.plan_sequences(Counter(pieces), packing.Packing(longest=20))
        held = Counter()
        for pattern, times in plan:
            assert sum(x * n for x, n in pattern) <= 20
            held.update({x: n * times for x, n in pattern})
        assert held == Counter(pieces)
        more += sum(n for _, n in plan) - least_bins(pieces, 20)
    assert more <= 2


def test_program_beats_first_fit_where_pairs_must_match():
    # thirds that only fill a sequence in the right combination
    histogram = {1000: 300, 700: 300, 348: 300, 1024: 40, 512: 80}
    plan = packing.plan_sequences(histogram)
    assert sum(n for _, n in plan) == -(-sum(x * n for x, n in histogram.items()) // 2048)


def test_knapsack_equals_trying_all():
    rng = random.Random(4)
    for _ in range(50):
        lengths = np.array(sorted(rng.sample(range(1, 12), 4), reverse=True))
        counts = np.array([rng.randint(1, 3) for _ in lengths])
        prices = np.array([rng.random() for _ in lengths])
        knapsack = packing.Knapsack(lengths, counts, 15)
        best, taken = knapsack.solve(prices)
        every = [Counter(c) for n in range(13) for c in combinations_with_replacement(range(4), n)]
        every = [c for c in every if all(c[k] <= counts[k] for k in range(4))]
        for room in range(16):
            most = max(sum(prices[k] * n for k, n in c.items()) for c in every if sum(lengths[k] * n for k, n in c.items()) <= room)
            assert best[room] == pytest.approx(most)
            held = knapsack.contents(taken, np.array([room]))[0]
            assert sum(prices[list(lengths).index(x)] * n for x, n in held.items()) == pytest.approx(most)


# ---- repair

BLANKS = " \t\n\x0b\x0c\r"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def plain_repair(rows):
    """Totals, audit and repaired rows: least cost, then least audit, first out of a heap."""
    rows = sorted(rows, key=lambda r: ((r[1] is not None, r[1] or 0), r[2], r[3]))
    faults, seen = [], set()
    for _, _, role, text in rows:
        shown = text.strip(BLANKS)
        faults.append(1 if not shown else 2 if (role, text) in seen else 3 if shown[-1] not in ".!?" else 0)
        seen.add((role, text))
    heap, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, last, out = heapq.heappop(heap)
        if (i, last) in done:
            continue
        done.add((i, last))
        if i == len(rows) and last in ("", "a"):
            break
        need, name = ("a", "assistant") if last == "u" else ("u", "user")
        heapq.heappush(heap, (cost + 2, audit + "I", i, need, (*out, (name, ""))))
        if i < len(rows):
            _, _, role, text = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, last, out))
            if faults[i] in (0, 3):
                more = int(faults[i] == 3)
                heapq.heappush(heap, (cost + more + 2, audit + "R", i + 1, need, (*out, (name, text))))
                if role[:1] == need or (last == "" and role[:1] == "s"):
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, role[0], (*out, (role, text))))
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(x[2][:1] + y[2][:1] not in ("su", "ua", "au") for x, y in zip(rows, rows[1:], strict=False))
    return (gaps, *map(faults.count, (1, 2, 3)), illegal, cost, audit), out


ODD_TURNS = [
    (rng.choice([c, c, None]) if c < 3 else c, rng.choice([None, 1, 2, 3, 4, 9]),
     rng.choice(["system", "user", "assistant", "assistant", "user", "tool", "", None, "s"]),
     rng.choice(["a.", "b?", "c", " ", "", "x y", "\t", "a.", None, "é!  \n", "。", "long " * 5000 + "."]))
    for rng in [random.Random(3)] for c in range(300) for _ in range(rng.randint(1, 9))
]
LONG_TURNS = [
    (1, rng.randint(0, 700), rng.choice(["user", "assistant", "system"]), rng.choice(["a.", "b", "c."]) + str(rng.randint(0, 90)) + rng.choice([".", ""]))
    for rng in [random.Random(4)] for _ in range(700)
] + [(1, 5, "user", "hi.")] * 200


@pytest.mark.parametrize(("name", "bits"), [("tables", 10), ("odd", 10), ("odd", 1), ("long", 3)])
def test_repair_equals_trying_all(spark, monkeypatch, name, bits):
    monkeypatch.setattr(repair, "_CHUNK_BITS", bits)
    table = spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text")
    rows = {"tables": lambda: [tuple(r) for r in table.collect()], "odd": lambda: ODD_TURNS, "long": lambda: LONG_TURNS}[name]()
    df = spark.createDataFrame(rows, table.schema).selectExpr("*", "1 as at", "2 as chunk", "3 as copies").repartition(4)
    left = defaultdict(list)
    for r in plain_damage(rows):
        left[r[0]].append(r)
    expected, turns = [], []
    for conv in {r[0] for r in rows}:
        totals, out = plain_repair(left[conv]) if left[conv] else ((0,) * 6 + ("",), ())
        expected.append((conv, *totals, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()))
        turns += [(conv, k, *x) for k, x in enumerate(out)]
    broken = repair.damaged(df)
    got = repair.repair_conversations(broken, df)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted(repr(tuple(r)) for r in got.collect()) == sorted(map(repr, expected))
    if bits > 1:
        assert sorted(repr(tuple(r)) for r in repair.repaired_turns(broken).collect()) == sorted(map(repr, turns))


def test_repair_of_empty_table(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair.repair_conversations(repair.damaged(empty), empty).collect() == []
    assert repair.repaired_turns(empty).collect() == []
    some = spark.createDataFrame([(7, 0, "user", "a.")], empty.schema)
    (row,) = repair.repair_conversations(empty, some).collect()
    assert tuple(row) == (7, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_queries_cover_their_tables(spark):
    n_docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    assert QUERIES["op11_token_alignment"](spark, SF_DIR).count() == n_docs
    packed = QUERIES["op12_best_fit_packing"](spark, SF_DIR)
    assert packed.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert packed.select("doc_id").distinct().count() == n_docs
    convs = spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id").distinct()
    assert QUERIES["op13_conversation_repair"](spark, SF_DIR).count() == convs.count()
