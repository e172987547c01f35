"""Chat formatting with offset-aligned loss masks.

A turn is rendered ``<|turn|>role<|text|>text<|end|>``. Inside roles and texts a
backslash is doubled and ``<|`` becomes ``<\\|``, so no text can form a marker and
the rendering is reversible. Markers are single tokens of their own; a whole
conversation is encoded once, and its sorted turn spans are intersected with the
sorted token spans by binary search.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import AddedToken, Tokenizer, processors

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(re.escape(TURN) + "(.*?)" + re.escape(TEXT) + "(.*?)" + re.escape(END), re.DOTALL)
LEARNED_ROLE = "assistant"


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


@lru_cache(maxsize=1)
def chat_tokenizer(path: str) -> Tokenizer:
    """The byte-level tokenizer with the markers added; offsets cover blanks too."""
    tokenizer = Tokenizer.from_file(path)
    tokenizer.add_special_tokens([AddedToken(x, special=True, normalized=False) for x in (TURN, TEXT, END)])
    tokenizer.post_processor = processors.ByteLevel(trim_offsets=False)
    return tokenizer


def render(turns: list[tuple[str, str]]) -> tuple[str, np.ndarray]:
    """The text of a conversation and the spans of its learned texts, in order."""
    parts: list[str] = []
    spans: list[tuple[int, int]] = []
    size = 0
    for role, text in turns:
        head, body = f"{TURN}{escape(role)}{TEXT}", escape(text)
        if role == LEARNED_ROLE and body:
            spans.append((size + len(head), size + len(head) + len(body)))
        parts += [head, body, END]
        size += len(head) + len(body) + len(END)
    return "".join(parts), np.array(spans, np.int64).reshape(-1, 2)


def mask_tokens(offsets: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """Whether each token lies in one of the sorted spans."""
    if not len(spans):
        return np.zeros(len(offsets), bool)
    at = np.searchsorted(spans[:, 0], offsets[:, 0], side="right") - 1
    return (at >= 0) & (offsets[:, 1] <= spans[np.maximum(at, 0), 1]) & (offsets[:, 1] > offsets[:, 0])


def format_conversations(conversations: DataFrame, tokenizer: str, turns_per_segment: int = 256, most_chars: int = 4 << 20) -> DataFrame:
    """``conv_id, segment, piece, text, ids, starts, ends, loss`` of every conversation.

    Up to ``turns_per_segment`` turn numbers (and ``most_chars`` characters) of a
    conversation make one row, so ordinary conversations are rows of their own and
    an endless one is dealt out; markers split exactly where rows do, so ids do not
    depend on it. Turns are ordered by number, then role and text; null roles and
    texts count as empty, null turn numbers come first, null ids are one
    conversation. Other columns are not read.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.floor(F.col("turn") / turns_per_segment).cast("long").alias("segment"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    n = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(n, "conv_id", "segment").sortWithinPartitions("conv_id", "segment", "turn", "role", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = chat_tokenizer(tokenizer)
        key, piece, turns, size = None, 0, [], 0
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "segment", "role", "text")]
            for conv, segment, role, text in zip(*columns, strict=True):
                if turns and ((conv, segment) != key or size > most_chars):
                    yield _encoded(encoder, key, piece, turns)
                    piece = piece + 1 if (conv, segment) == key else 0
                    turns, size = [], 0
                key = (conv, segment)
                turns.append((role, text))
                size += len(text)
        if turns:
            yield _encoded(encoder, key, piece, turns)

    schema = "conv_id long, segment long, piece long, text string, ids array<int>, starts array<int>, ends array<int>, loss array<boolean>"
    return dealt.mapInArrow(encode, schema)


def _encoded(encoder: Tokenizer, key: tuple[int | None, int | None], piece: int, turns: list[tuple[str, str]]) -> pa.RecordBatch:
    text, spans = render(turns)
    encoding = encoder.encode(text, add_special_tokens=False)
    offsets = np.array(encoding.offsets, np.int64).reshape(-1, 2)
    loss = mask_tokens(offsets, spans)
    lists = [encoding.ids, offsets[:, 0].tolist(), offsets[:, 1].tolist()]
    return pa.RecordBatch.from_arrays(
        [
            *(pa.array([x], pa.int64()) for x in (*key, piece)),
            pa.array([text]),
            *(pa.array([x], pa.list_(pa.int32())) for x in lists),
            pa.array([loss.tolist()], pa.list_(pa.bool_())),
        ],
        ["conv_id", "segment", "piece", "text", "ids", "starts", "ends", "loss"],
    )


def parsed_turns(text: str) -> list[tuple[str, str]]:
    """Role and text of every turn of a rendered conversation."""
    return [(unescape(role), unescape(body)) for role, body in _TURN.findall(text)]


def learned_text(text: str, starts: np.ndarray, ends: np.ndarray, loss: np.ndarray) -> str:
    """What the masked tokens cover, each character once, unescaped."""
    starts, ends = starts[loss], ends[loss]
    if not len(starts):
        return ""
    # tokens that share a character have the same or overlapping spans
    reached = np.maximum.accumulate(np.concatenate([[0], ends[:-1]]))
    first = np.maximum(starts, reached)
    parts: list[str] = []
    run = [int(first[0]), int(ends[0])]
    for a, b in zip(first[1:].tolist(), ends[1:].tolist(), strict=True):
        if a == run[1]:
            run[1] = max(run[1], b)
        elif b > a:
            parts.append(unescape(text[run[0] : run[1]]))
            run = [a, b]
    parts.append(unescape(text[run[0] : run[1]]))
    return "".join(parts)


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``, read from the output.

    Rows of a conversation stream through running hashes in order; none is gathered.
    """
    n = int(formatted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    needed = formatted.select("conv_id", "segment", "piece", "text", "starts", "ends", "loss")
    ordered = needed.repartition(n, "conv_id").sortWithinPartitions("conv_id", "segment", "piece")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: list | None = None

        def result() -> pa.RecordBatch:
            conv, n_turns, turns, n_loss, loss, chars = state
            values = (conv, n_turns, turns.hexdigest(), n_loss, loss.hexdigest(), chars)
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names)

        for batch in batches:
            for i in range(batch.num_rows):
                conv, text = batch.column("conv_id")[i].as_py(), batch.column("text")[i].as_py()
                if state is None or state[0] != conv:
                    if state is not None:
                        yield result()
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, body in parsed_turns(text):
                    state[1] += 1
                    state[2].update(f"{role}\n{body}\n".encode("utf-8", "surrogatepass"))
                arrays = (np.asarray(batch.column(c)[i].values.to_numpy(zero_copy_only=False)) for c in ("starts", "ends", "loss"))
                learned = learned_text(text, *arrays)
                state[3] += len(learned)
                state[4].update(learned.encode("utf-8", "surrogatepass"))
                state[5] += len(text)
        if state is not None:
            yield result()

    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return ordered.mapInArrow(digest, schema)
