"""SentencePiece models on the tokenizers library.

The model file is a protobuf message; its wire format is read here, so neither the
protobuf package nor the original library is needed to encode. What is rebuilt:
the normaliser, the metaspace marker, the pieces with their scores (unigram
scores, or for BPE models the merge order they stand for), and byte fallback.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer, decoders, models, normalizers

from newsloom.llm.words import slices

MARK = "▁"
# Field numbers and enumerations of the public message format.
_PIECE, _TRAINER, _NORMALIZER = 1, 2, 3
_PIECE_TEXT, _PIECE_SCORE, _PIECE_KIND = 1, 2, 3
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
_MODEL_TYPE, _BYTE_FALLBACK, UNIGRAM, BPE = 3, 35, 1, 2
_CHARSMAP, _DUMMY_PREFIX, _SQUEEZE = 2, 3, 4


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes | float]]:
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        key = varint()
        field, wire = key >> 3, key & 7
        if wire == 0:
            yield field, varint()
        elif wire == 2:
            size = varint()
            yield field, message[at : at + size]
            at += size
        elif wire == 5:
            yield field, struct.unpack_from("<f", message, at)[0]
            at += 4
        elif wire == 1:
            yield field, message[at : at + 8]
            at += 8
        else:
            raise ValueError(f"unknown wire type {wire}")


@dataclass(frozen=True)
class PieceModel:
    """What a model file holds."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    kinds: tuple[int, ...]
    model_type: int
    byte_fallback: bool
    charsmap: bytes
    dummy_prefix: bool
    squeeze: bool

    @property
    def unknown(self) -> int:
        return self.kinds.index(UNKNOWN)


def parse_model(data: bytes) -> PieceModel:
    pieces: list[str] = []
    scores: list[float] = []
    kinds: list[int] = []
    trainer: dict[int, object] = {}
    normalizer: dict[int, object] = {}
    for field, value in _fields(data):
        if field == _PIECE:
            piece = dict(_fields(value))
            pieces.append(piece[_PIECE_TEXT].decode())
            scores.append(float(piece.get(_PIECE_SCORE, 0.0)))
            kinds.append(int(piece.get(_PIECE_KIND, NORMAL)))
        elif field == _TRAINER:
            trainer = dict(_fields(value))
        elif field == _NORMALIZER:
            normalizer = dict(_fields(value))
    return PieceModel(
        tuple(pieces), tuple(scores), tuple(kinds), int(trainer.get(_MODEL_TYPE, UNIGRAM)),
        bool(trainer.get(_BYTE_FALLBACK, 0)), bytes(normalizer.get(_CHARSMAP, b"")),
        bool(normalizer.get(_DUMMY_PREFIX, 1)), bool(normalizer.get(_SQUEEZE, 1)),
    )


@lru_cache(maxsize=4)
def load_model(path: str) -> PieceModel:
    with open(path, "rb") as file:
        return parse_model(file.read())


def _merges(model: PieceModel) -> list[tuple[str, str]]:
    """Merge rules in the order the scores give: every split of a piece into two pieces."""
    known = {p: i for i, p in enumerate(model.pieces) if model.kinds[i] in (NORMAL, USER, UNUSED)}
    rules: list[tuple[float, int, int, tuple[str, str]]] = []
    for piece, i in known.items():
        if model.kinds[i] == NORMAL:
            for cut in range(1, len(piece)):
                if piece[:cut] in known and piece[cut:] in known:
                    rules.append((-model.scores[i], i, cut, (piece[:cut], piece[cut:])))
    return [x[-1] for x in sorted(rules)]


def normalizer_of(model: PieceModel) -> normalizers.Normalizer:
    """From raw text to text with metaspace marks."""
    steps: list[normalizers.Normalizer] = []
    if model.charsmap:
        steps.append(normalizers.Precompiled(model.charsmap))
    if model.squeeze:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(MARK))
    steps.append(normalizers.Replace(" ", MARK))
    return normalizers.Sequence(steps)


def build_tokenizer(model: PieceModel, normalize: bool = True) -> Tokenizer:
    """The tokenizers backend; without ``normalize`` it takes text that has its marks."""
    if model.model_type == UNIGRAM:
        vocabulary = list(zip(model.pieces, model.scores, strict=True))
        core = models.Unigram(vocabulary, unk_id=model.unknown, byte_fallback=model.byte_fallback)
    elif model.model_type == BPE:
        core = models.BPE(
            {p: i for i, p in enumerate(model.pieces)}, _merges(model), unk_token=model.pieces[model.unknown],
            fuse_unk=True, byte_fallback=model.byte_fallback,
        )
    else:
        raise ValueError("only unigram and BPE models can be rebuilt")
    tokenizer = Tokenizer(core)
    if normalize:
        tokenizer.normalizer = normalizer_of(model)
    steps = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    if model.dummy_prefix:
        steps.append(decoders.Strip(" ", 1, 0))
    tokenizer.decoder = decoders.Sequence(steps)
    return tokenizer


class PieceBytes:
    """Decoding of many ids at once: pieces as bytes, marks as blanks."""

    def __init__(self, model: PieceModel):
        whole = [
            bytes([int(p[3:5], 16)]) if k == BYTE else p.replace(MARK, " ").encode() for p, k in zip(model.pieces, model.kinds, strict=True)
        ]
        self._sizes = np.fromiter(map(len, whole), np.int64, len(whole))
        self._starts = np.cumsum(self._sizes) - self._sizes
        self._data = np.frombuffer(b"".join(whole), np.uint8)

    def joined(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The bytes of each of some lists of ids that follow each other in ``ids``."""
        sizes = self._sizes[ids]
        total = np.concatenate([[0], np.cumsum(sizes)])
        data = self._data[np.repeat(self._starts[ids] - total[:-1], sizes) + np.arange(total[-1])].tobytes()
        ends = total[np.cumsum(counts)].tolist()
        return [data[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


_AT_ONCE = 8192
_CHUNK = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


class PieceEncoder:
    """Encodes whole texts from their distinct chunks.

    A chunk is a run of marks and what follows up to the next mark. No piece of the
    supported models reaches from inside a chunk over its end (checked when the
    model is loaded), so ids of a text are those of its chunks. Each distinct chunk
    is encoded once while it is held, in multithreaded batches, and compared with the
    original library. What the assembled ids of a text decode to is compared with it.
    """

    def __init__(self, path: str, most: int = 500_000, verify: bool = True):
        self.model = load_model(path)
        if any(MARK in p.lstrip(MARK) for p, k in zip(self.model.pieces, self.model.kinds, strict=True) if k == NORMAL):
            raise ValueError("a piece holds a mark inside; texts cannot be cut at marks")
        self._normalizer = normalizer_of(self.model)
        self._bare = build_tokenizer(self.model, normalize=False)
        self._bytes = PieceBytes(self.model)
        self._original = sentencepiece.SentencePieceProcessor(model_file=path) if verify else None
        self._most = most
        self._clear()

    @property
    def verified(self) -> bool:
        """Whether chunks are compared with the original, which normalises whole texts only."""
        return self._original is not None and not self.model.charsmap and not self.model.squeeze and self.model.dummy_prefix

    def round_trips(self, texts: list[str | None], ids: np.ndarray, counts: np.ndarray) -> list[bool]:
        """Whether the ids of each text decode to the text."""
        lead = " " if self.model.dummy_prefix else ""
        return [data == (lead + (x or "")).encode() if x else not data for data, x in zip(self._bytes.joined(ids, counts), texts, strict=True)]

    def _clear(self) -> None:
        self._places: dict[str, int] = {}
        self._ids, self._starts = np.zeros(0, np.int32), np.zeros(1, np.int64)
        self._unlike, self._lossy = bytearray(), bytearray()
        self._new_ids: list[np.ndarray] = []
        self._new_lengths: list[np.ndarray] = []

    def _add(self, fresh: list[str]) -> None:
        # results of the libraries are large while they last
        for at in range(0, len(fresh), _AT_ONCE):
            self._add_some(fresh[at : at + _AT_ONCE])
        merged = np.concatenate([self._ids, *self._new_ids])
        starts = np.concatenate([self._starts[-1:], *self._new_lengths]).cumsum()
        self._ids, self._starts = merged, np.concatenate([self._starts, starts[1:]])
        self._new_ids, self._new_lengths = [], []

    def _add_some(self, fresh: list[str]) -> None:
        encoded = [x.ids for x in self._bare.encode_batch_fast(fresh, add_special_tokens=False)]
        lengths = np.fromiter(map(len, encoded), np.int64, len(encoded))
        ids = np.fromiter(chain.from_iterable(encoded), np.int32, int(lengths.sum()))
        plain = [c.replace(MARK, " ") for c in fresh]
        self._lossy.extend(a != b.encode() for a, b in zip(self._bytes.joined(ids, lengths), plain, strict=True))
        unlike = bytearray(len(fresh))
        if self.verified:
            # the original adds a leading blank itself
            bare = [c[1:] if c.startswith(" ") else c for c in plain]
            asked = [k for k, (c, b) in enumerate(zip(plain, bare, strict=True)) if b and c.startswith(" ")]
            for k, theirs in zip(asked, self._original.encode([bare[k] for k in asked], num_threads=1), strict=True):
                unlike[k] = theirs != encoded[k]
        self._unlike.extend(unlike)
        n = len(self._places)
        self._places.update(zip(fresh, range(n, n + len(fresh)), strict=True))
        self._new_lengths.append(lengths)
        self._new_ids.append(ids)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All ids, ids per text, chunks per text unlike the original library's, chunks per text lost in decoding."""
        if len(self._places) > self._most:
            self._clear()
        if self.model.charsmap or self.model.squeeze:
            marked = [self._normalizer.normalize_str(x) if x else "" for x in texts]
        else:
            lead = MARK if self.model.dummy_prefix else ""
            marked = [lead + x.replace(" ", MARK) if x else "" for x in texts]
        chunks = [_CHUNK.findall(x) for x in marked]
        fresh = [c for c in dict.fromkeys(c for p in chunks for c in p) if c not in self._places]
        if fresh:
            self._add(fresh)
        n_chunks = np.fromiter(map(len, chunks), np.int64, len(chunks))
        places = np.fromiter((self._places[c] for p in chunks for c in p), np.int64, int(n_chunks.sum()))
        owners = np.repeat(np.arange(len(texts)), n_chunks)
        lengths = self._starts[places + 1] - self._starts[places]
        total = np.concatenate([[0], np.cumsum(lengths)])
        ids = self._ids[np.repeat(self._starts[places] - total[:-1], lengths) + np.arange(total[-1])]
        counts = np.bincount(owners, lengths, minlength=len(texts)).astype(np.int64)
        unlike = np.bincount(owners, np.frombuffer(self._unlike, np.uint8)[places], minlength=len(texts)).astype(np.int64)
        lossy = np.bincount(owners, np.frombuffer(self._lossy, np.uint8)[places], minlength=len(texts)).astype(np.int64)
        # a mark that stood in the text decodes to a blank
        lossy += np.fromiter((x.count(MARK) if x else 0 for x in texts), np.int64, len(texts))
        return ids, counts, unlike, lossy


@lru_cache(maxsize=1)
def piece_encoder(path: str) -> PieceEncoder:
    """One encoder per Python worker: its chunks serve the worker's later tasks too."""
    return PieceEncoder(path)


def encode_pieces(documents: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids, n_tokens, n_unlike, n_lossy, round_trip`` of every document.

    ``n_unlike`` counts chunks whose ids differ from the original library's (null for
    models whose texts are not compared: those with a character map or that squeeze
    blanks) and ``n_lossy`` what does not decode to itself: chunks, and marks that stood
    in the text and decode to blanks. ``round_trip`` says whether the assembled ids of
    the whole text decode to it. Null and empty texts have no ids; null ids stay null.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = piece_encoder(path)
        for batch in batches:
            for part in slices(batch, most_bytes=4 << 20):
                texts = part.column("text").to_pylist()
                ids, counts, unlike, lossy = encoder.encode(texts)
                offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
                compared = pa.array(unlike) if encoder.verified else pa.nulls(len(unlike), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.ListArray.from_arrays(offsets, pa.array(ids)), pa.array(counts), compared, pa.array(lossy),
                     pa.array(encoder.round_trips(texts, ids, counts), pa.bool_())],
                    ["doc_id", "ids", "n_tokens", "n_unlike", "n_lossy", "round_trip"],
                )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(encode, "doc_id long, ids array<int>, n_tokens long, n_unlike long, n_lossy long, round_trip boolean")


def decode_pieces(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, text`` from ids, in whole texts; null lists decode to empty texts."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = build_tokenizer(load_model(path))
        for batch in batches:
            texts = tokenizer.decode_batch([x or [] for x in batch.column("ids").to_pylist()], skip_special_tokens=False)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(decode, "doc_id long, text string")
