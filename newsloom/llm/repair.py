"""Least-cost repair of the turn structure of conversations.

A repaired conversation reads ``(system? (user assistant)+)?`` by role initials. Rows
are kept (K, free), given another role (R, 2) or deleted (D, 3; blank and duplicate rows
must be), turns without text are inserted (I, 2), and a truncated row that stays costs 1
more. Of the cheapest repairs the one whose edits, as a string, come first is taken.

The states between rows are: nothing yet, a system turn, a user turn, an assistant turn.
Conversations are cut into chunks of rows, so that even an endless one is worked on by
many tasks:

* each chunk's least costs from any state to any other one (a 4 x 4 table) and,
  conversation by conversation, from these the costs still to come after each chunk;
* with them the optimal arcs of a chunk's nodes (row, state). Nodes are ranked by the
  first 1, 2, 4, ... letters of their least audit: the ranks for twice the length are
  those of the pairs (own rank, rank where the pointer leads), pointers are doubled
  along, and the least path from each state is read off the doubled pointers;
* a last pass streams each conversation in order, picks the path of the state it is in,
  and hashes what is left. SHA-256 has no other way; no rows are held there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.lineage import stored

# Fixed values of the contract: costs, and the characters that count as blank.
RETITLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
_BLANKS = "\t\n\x0b\x0c\r "
# From each state the state that the next user or assistant turn leads to, and its initial.
_NEXT = np.array([2, 2, 3, 2])
_SYSTEM, _USER, _ASSISTANT = 1, 2, 3
_NEEDS = np.array([_USER, _USER, _ASSISTANT, _USER])
_ROLES = {_USER: "user", _ASSISTANT: "assistant"}
# What ends a conversation from each state: how many turns must still be inserted.
_MISSING = np.array([0, 2, 1, 0])
_FAR = 1 << 40
_CHUNK_BITS = 10


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` after the damage that crc32 of ``conv_id:turn`` modulo 20 names.

    0 drops a row, 1 empties its text, 2 takes out ``[.!?]``, 3 repeats it, 4 makes its
    role ``user``. Null roles and texts, and nulls inside the key, count as one blank.
    """
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
        F.pmod(F.crc32(F.encode(key, "UTF-8")), F.lit(20)).alias("_kind"),
    ).filter("_kind <> 0")
    text = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("_kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("_copy")).drop("_copy")


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """Distinct rows with their number of ``copies``, their place ``at``, ``chunk`` and ``fault``.

    Rows of a conversation are ordered by turn (nulls first), then role and text; equal
    rows follow each other, so they are one row here, however many there are. ``fault``
    is 1 (blank), 2 (duplicate), 3 (truncated) or 0; further copies of a row are blank if
    it is and duplicates otherwise.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
    )
    order = ["conv_id", "turn", "role", "text"]
    distinct = rows.groupBy(*order).agg(F.count("*").alias("copies"))
    n = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = distinct.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    shown = F.rtrim("text", F.lit(_BLANKS))
    state = F.when(shown == "", 1).when(F.substring(shown, -1, 1).isin(".", "!", "?"), 0).otherwise(3)
    initial = F.substring("role", 1, 1)
    codes = F.when(initial == "s", _SYSTEM).when(initial == "u", _USER).when(initial == "a", _ASSISTANT).otherwise(0)
    turns = stored(
        placed.withColumns({
            "chunk": F.shiftright("at", _CHUNK_BITS), "state": state, "initial": codes, "digest": F.unhex(F.sha2("text", 256)),
        }),
        "turns",
    )
    # many equal texts of a conversation meet as one minimum per task
    firsts = turns.filter("state <> 1").groupBy("conv_id", "role", "digest").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("first"))
    fault = F.when(F.col("state") == 1, 1).when(F.col("first").isNull(), 2).otherwise(F.col("state"))
    return turns.join(firsts, "at", "left").select(*order, "copies", "at", "chunk", "initial", fault.alias("fault"))


def _changes(table: pa.Table) -> np.ndarray:
    """Where rows of another ``conv_id`` or ``chunk`` begin."""
    new = np.ones(len(table), bool)
    if len(table):
        ids = table.column("conv_id").combine_chunks()
        keys = (np.asarray(ids.fill_null(0)), np.asarray(ids.is_null().cast(pa.int8())), np.asarray(table.column("chunk")))
        new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return new


def _whole_chunks(batches: Iterator[pa.RecordBatch], most: int = 1 << 15) -> Iterator[pa.Table]:
    """Tables of whole chunks, about ``most`` rows each."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(x.num_rows for x in held) >= most:
            table = pa.Table.from_batches(held)
            cut = int(np.flatnonzero(_changes(table))[-1])
            if cut:
                yield table.slice(0, cut)
            held = table.slice(cut).combine_chunks().to_batches()
    if held and (table := pa.Table.from_batches(held)).num_rows:
        yield table


class _Chunks:
    """Rows of several chunks, with the costs of their edits."""

    def __init__(self, table: pa.Table):
        self.starts = np.flatnonzero(_changes(table))
        self.ends = np.append(self.starts[1:], len(table))
        self.initial, self.fault, self.copies = (np.asarray(table.column(c)).astype(np.int64) for c in ("initial", "fault", "copies"))
        self.owner = np.repeat(np.arange(len(self.starts)), self.ends - self.starts)
        late = np.where(self.fault == 3, TRUNCATED, 0)
        stays = np.where((self.fault == 1) | (self.fault == 2), _FAR, late)
        fits = self.initial[:, None] == _NEEDS
        self.turn = stays[:, None] + np.where(fits, 0, RETITLE)
        self.system = np.where(self.initial == _SYSTEM, stays, _FAR)
        self.more = DELETE * (self.copies - 1)

    def costs(self, last: np.ndarray) -> np.ndarray:
        """Least costs of each chunk's layers, given those after its last row.

        ``last`` has the axes chunk, state, goal; the result has layer, state, goal,
        with a layer before each row and one after a chunk's last row.
        """
        n = self.ends - self.starts
        out = np.empty((len(self.owner) + len(n), *last.shape[1:]), np.int64)
        ahead = last.copy()
        out[self.ends + np.arange(len(n))] = ahead
        order = np.argsort(-n, kind="stable")
        reach = len(n) - np.searchsorted(n[order][::-1], np.arange(int(n.max(initial=0))), side="right")
        for back, active in enumerate(reach.tolist()):
            some = order[:active]
            rows = self.ends[some] - 1 - back
            then = ahead[some]
            now = np.minimum(DELETE + then, self.turn[rows][..., None] + then[:, _NEXT])
            now[:, 0] = np.minimum(now[:, 0], self.system[rows][:, None] + then[:, 1])
            now += self.more[rows][:, None, None]
            now[:, 2:] = np.minimum(now[:, 2:], INSERT + now[:, :1:-1])
            now[:, :2] = np.minimum(now[:, :2], INSERT + now[:, 2:3])
            ahead[some] = np.minimum(now, _FAR)
            out[rows + some] = ahead[some]
        return out

    def least_paths(self, last: np.ndarray) -> tuple[list[list[str]], np.ndarray]:
        """For each chunk and state before it the least audit through it, and the state after it."""
        costs = self.costs(last[..., None])[..., 0]
        n_rows, n_chunks = len(self.owner), len(self.starts)
        layer = np.arange(n_rows) + self.owner
        states = np.arange(4)
        here, then = costs[layer], costs[layer + 1]
        # the arcs of a node differ in their letters, so the least letter leads on
        letters = np.full((n_rows, 4), 4, np.int64)
        goals = np.zeros((n_rows, 4), np.int64)
        keeps = self.initial[:, None] == _NEEDS
        more = self.more[:, None]
        ahead = 4 * (layer[:, None] + 1)
        options = [
            (3, ~keeps & (self.turn + more + then[:, _NEXT] == here), ahead + _NEXT),
            (2, keeps & (self.turn + more + then[:, _NEXT] == here), ahead + _NEXT),
            (2, (states == 0) & ((self.system + self.more + then[:, 1])[:, None] == here), ahead + 1),
            (1, INSERT + here[:, _NEXT] == here, 4 * layer[:, None] + _NEXT),
            (0, DELETE + more + then == here, ahead + states),
        ]
        for letter, tight, goal in options:
            letters[tight] = letter
            goals = np.where(tight, np.broadcast_to(goal, tight.shape), goals)
        n_nodes = 4 * (n_rows + n_chunks)
        nodes = (4 * layer[:, None] + states).ravel()
        pointer, rank, letter_of = np.arange(n_nodes), np.zeros(n_nodes, np.int64), np.zeros(n_nodes, np.int64)
        # nodes after a chunk's last row point at themselves and rank first
        pointer[nodes], rank[nodes], letter_of[nodes] = goals.ravel(), letters.ravel() + 1, letters.ravel()
        steps = (rank > 0).astype(np.int64)
        doubled = [pointer]
        while np.any(pointer[pointer] != pointer):
            # ranks by twice as many letters
            rank = np.unique(rank * (n_nodes + 1) + rank[pointer], return_inverse=True)[1]
            steps = steps + steps[pointer]
            pointer = pointer[pointer]
            doubled.append(pointer)
        first = (4 * (self.starts + np.arange(n_chunks))[:, None] + states).ravel()
        lengths = steps[first]
        at = np.repeat(first, lengths)
        nth = np.arange(len(at)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        for k, jump in enumerate(doubled):
            far = (nth >> k & 1).astype(bool)
            at[far] = jump[at[far]]
        row = at // 4 - np.repeat(np.repeat(np.arange(n_chunks), 4), lengths)
        taken = letter_of[at]
        repeats = np.stack([np.ones(len(at), np.int64), np.where(taken == 1, 0, self.copies[row] - 1)], axis=1).ravel()
        spelled = np.repeat(np.stack([np.frombuffer(b"DIKR", np.uint8)[taken], np.full(len(at), ord("D"), np.uint8)], axis=1).ravel(), repeats)
        sizes = np.bincount(np.repeat(np.arange(len(first)), lengths), repeats.reshape(-1, 2).sum(axis=1), minlength=len(first)).astype(np.int64)
        whole, ends = spelled.tobytes().decode(), np.cumsum(sizes).tolist()
        audits = [whole[b - a : b] for a, b in zip(sizes.tolist(), ends, strict=True)]
        return [audits[4 * c : 4 * c + 4] for c in range(n_chunks)], pointer[first].reshape(-1, 4) % 4


_SUMS = ("blank", "duplicate", "truncated", "illegal", "turns")
_SUMMARY = "conv_id long, chunk long, table array<long>, " + ", ".join(f"{c} long" for c in _SUMS) + ", first_initial long, last_initial long, first_turn long, last_turn long"
_LEGAL = ((_SYSTEM, _USER), (_USER, _ASSISTANT), (_ASSISTANT, _USER))


def _legal(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.any([(a == x) & (b == y) for x, y in _LEGAL], axis=0)


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The cost table of each chunk, and what its conversation adds up."""
    for table in _whole_chunks(batches):
        x = _Chunks(table)
        n = len(x.starts)
        last = np.full((n, 4, 4), _FAR, np.int64)
        last[:, range(4), range(4)] = 0
        first_layers = x.costs(last)[x.starts + np.arange(n)]
        turns = table.column("turn").combine_chunks()
        known = np.asarray(turns.is_valid())
        value = np.asarray(turns.fill_null(0))
        again = np.zeros(len(table), bool)
        again[1:] = (x.owner[1:] == x.owner[:-1]) & known[:-1] & (value[1:] == value[:-1])
        inside = x.owner[1:] == x.owner[:-1]
        broken = (x.copies - 1).astype(np.int64)
        broken[1:] += inside & ~_legal(x.initial[:-1], x.initial[1:])
        extra = x.copies - 1
        columns = {
            "blank": np.where(x.fault == 1, x.copies, 0),
            "duplicate": np.where(x.fault == 2, x.copies, np.where(x.fault == 1, 0, extra)),
            "truncated": x.fault == 3, "illegal": broken, "turns": known & ~again,
        }
        sums = [pa.array(np.add.reduceat(np.asarray(columns[c], np.int64), x.starts)) for c in _SUMS]
        # null turns come first: the first known turn of a chunk
        at = np.minimum.reduceat(np.where(known, np.arange(len(table)), len(table)), x.starts)
        first_turn = pa.array(value[np.minimum(at, len(table) - 1)], mask=at == len(table))
        last_turn = turns.take(pa.array(x.ends - 1))
        heads = pa.array(x.starts)
        yield pa.RecordBatch.from_arrays(
            [
                pc.take(table.column("conv_id"), heads).combine_chunks(), pc.take(table.column("chunk"), heads).combine_chunks(),
                pa.array(first_layers.reshape(n, 16).tolist(), pa.list_(pa.int64())), *sums,
                pa.array(x.initial[x.starts]), pa.array(x.initial[x.ends - 1]), first_turn, last_turn,
            ],
            ["conv_id", "chunk", "table", *_SUMS, "first_initial", "last_initial", "first_turn", "last_turn"],
        )


_FOLDED = "conv_id long, chunk long, ends array<long>, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
_TOTALS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of conversations, last one first: costs to come after each, totals with the first chunk."""
    state: dict | None = None

    def row(conv: int | None, chunk: int | None, ends: list[int] | None, totals: list[int] | None) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([conv], pa.int64()), pa.array([chunk], pa.int64()), pa.array([ends], pa.list_(pa.int64())),
             *(pa.array([v], pa.int64()) for v in totals or [None] * 6)],
            ["conv_id", "chunk", "ends", *_TOTALS],
        )

    def totals(s: dict) -> pa.RecordBatch:
        gaps = s["high"] - s["low"] + 1 - s["turns"] if s["high"] is not None else 0
        return row(s["conv"], None, None, [gaps, s["blank"], s["duplicate"], s["truncated"], s["illegal"], int(s["ahead"][0])])

    for batch in batches:
        done: list[pa.RecordBatch] = []
        for r in batch.to_pylist():
            if state is None or state["conv"] != r["conv_id"]:
                if state is not None:
                    done.append(totals(state))
                state = dict.fromkeys(_SUMS, 0) | {"conv": r["conv_id"], "ahead": INSERT * _MISSING, "high": None, "low": None, "next": None}
            done.append(row(r["conv_id"], r["chunk"], state["ahead"].tolist(), None))
            state["ahead"] = (np.array(r["table"], np.int64).reshape(4, 4) + state["ahead"]).min(axis=1)
            for c in _SUMS:
                state[c] += r[c]
            if state["next"] is not None:
                state["illegal"] += int((r["last_initial"], state["next"]) not in _LEGAL)
            state["next"] = r["first_initial"]
            if r["last_turn"] is not None:
                # a turn number that goes on in the next chunk counts once
                state["turns"] -= int(state["low"] == r["last_turn"])
                state["high"] = r["last_turn"] if state["high"] is None else state["high"]
                state["low"] = r["first_turn"]
        yield from pa.Table.from_batches(done).combine_chunks().to_batches() if done else []
    if state is not None:
        yield totals(state)


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in _whole_chunks(batches):
        x = _Chunks(table)
        heads = pa.array(x.starts)
        last = np.array(pc.take(table.column("ends"), heads).to_pylist(), np.int64).reshape(-1, 4)
        audits, _ = x.least_paths(last)
        yield pa.RecordBatch.from_arrays(
            [pc.take(table.column("conv_id"), heads).combine_chunks(), pc.take(table.column("chunk"), heads).combine_chunks(),
             pa.array(audits, pa.list_(pa.string()))],
            ["conv_id", "chunk", "audits"],
        )


class _Repaired:
    """Applies audits to the rows of conversations, in order."""

    def __init__(self):
        self.state, self.audit, self._at, self._parts = 0, "", 0, []

    def open(self, audits: list[str]) -> None:
        """Begin the next chunk."""
        self.audit, self._at = audits[self.state], 0
        self._parts.append(self.audit)

    def _insert(self) -> tuple[str, str]:
        self.state = int(_NEXT[self.state])
        return _ROLES[self.state], ""

    def row(self, role: str, text: str, copies: int) -> Iterator[tuple[str, str]]:
        while self.audit[self._at] == "I":
            self._at += 1
            yield self._insert()
        letter = self.audit[self._at]
        self._at += copies
        if letter == "K" and self.state == 0 and role.startswith("s"):
            self.state = 1
            yield role, text
        elif letter != "D":
            self.state = int(_NEXT[self.state])
            yield role if letter == "K" else _ROLES[self.state], text

    def close(self) -> Iterator[tuple[str, str]]:
        for _ in range(int(_MISSING[self.state])):
            self._parts.append("I")
            yield self._insert()

    def whole_audit(self) -> str:
        return "".join(self._parts)


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, list[tuple[str, str]], _Repaired | None]]:
    """``conv_id``, repaired rows, and at its end the conversation."""
    conv, state = None, None
    for batch in batches:
        for i in range(batch.num_rows):
            own, audits, role, text, copies = (batch.column(c)[i].as_py() for c in ("conv_id", "audits", "role", "text", "copies"))
            if state is None or own != conv:
                if state is not None:
                    yield conv, list(state.close()), state
                conv, state = own, _Repaired()
            if audits is not None:
                state.open(audits)
            else:
                yield conv, list(state.row(role, text, copies)), None
    if state is not None:
        yield conv, list(state.close()), state


def _solved(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Totals of each conversation, and its rows between the least paths of their chunks, in order."""
    n = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    narrow = turns.select("conv_id", "chunk", "at", "turn", "initial", "fault", "copies")
    by_chunk = narrow.repartition(n, "conv_id", "chunk").sortWithinPartitions("conv_id", "chunk", "at")
    summaries = stored(by_chunk.mapInArrow(_summaries, _SUMMARY), "chunk_costs")
    last_first = summaries.repartition(n, "conv_id").sortWithinPartitions(F.asc("conv_id"), F.desc("chunk"))
    folded = stored(last_first.mapInArrow(_folded, _FOLDED), "chunk_ends")
    ends = folded.filter("chunk is not null").select(F.col("conv_id").alias("_conv"), F.col("chunk").alias("_chunk"), "ends")
    met = narrow.join(ends, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("chunk") == F.col("_chunk"))).drop("_conv", "_chunk")
    dealt = met.repartition(n, "conv_id", "chunk").sortWithinPartitions("conv_id", "chunk", "at")
    paths = dealt.mapInArrow(_paths, "conv_id long, chunk long, audits array<string>")
    rows = turns.select("conv_id", "chunk", "at", F.lit(None).cast("array<string>").alias("audits"), "role", "text", "copies")
    both = rows.unionByName(paths.withColumn("at", F.lit(-1).cast("long")), allowMissingColumns=True)
    in_order = both.repartition(n, "conv_id").sortWithinPartitions("conv_id", "chunk", "at").select("conv_id", "audits", "role", "text", "copies")
    return folded.filter("chunk is null").select("conv_id", *_TOTALS), in_order


def repaired_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, place, role, text`` of the repaired conversations, places from 0.

    Null roles and texts count as one blank, null ids are one conversation; a role
    without a legal initial can't be kept. Conversations that lose all rows have none.
    """
    _, in_order = _solved(stored(ordered_turns(conversations), "ordered_turns"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = 0
        for conv, turns, over in _streamed(batches):
            if turns:
                roles, texts = zip(*turns, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([conv] * len(turns), pa.int64()), pa.array(np.arange(place, place + len(turns))), pa.array(roles), pa.array(texts)],
                    ["conv_id", "place", "role", "text"],
                )
                place += len(turns)
            if over is not None:
                place = 0

    return in_order.mapInArrow(run, "conv_id long, place long, role string, text string")


def repair_conversations(conversations: DataFrame, expected: DataFrame) -> DataFrame:
    """What each conversation of ``expected`` lacks, and its cheapest repair.

    ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256``, one row per distinct id in ``expected``. Handling of odd rows is
    that of ``repaired_turns``; ids without rows have zeros, an empty audit and the hash
    of an empty string. Other columns are not read.
    """
    totals, in_order = _solved(stored(ordered_turns(conversations), "ordered_turns"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, lead = hashlib.sha256(), ""
        for conv, turns, over in _streamed(batches):
            for role, text in turns:
                digest.update(f"{lead}{role}:{text}".encode())
                lead = "\n"
            if over is not None:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([conv], pa.int64()), pa.array([over.whole_audit()]), pa.array([digest.hexdigest()])],
                    ["conv_id", "audit", "repaired_sha256"],
                )
                digest, lead = hashlib.sha256(), ""

    audits = in_order.mapInArrow(run, "_audited long, audit string, repaired_sha256 string")
    ids = expected.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    totals = totals.withColumnRenamed("conv_id", "_total")
    found = ids.join(totals, F.col("conv_id").eqNullSafe(F.col("_total")) & F.col("cost").isNotNull(), "left")
    found = found.join(audits, F.col("conv_id").eqNullSafe(F.col("_audited")) & F.col("audit").isNotNull(), "left")
    return found.select(
        "conv_id", *(F.coalesce(c, F.lit(0)).alias(c) for c in _TOTALS), F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
