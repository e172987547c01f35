"""Words and word n-grams of whole Arrow string columns, as numpy arrays.

A word is a run of bytes other than U+0009-000D and U+0020. Texts are read as the
UTF-8 bytes Arrow already holds, so no Python string is made per word. Hashes are
64 bits wide and depend on the word alone, so they agree between tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SEPARATORS = np.zeros(256, dtype=bool)
SEPARATORS[[9, 10, 11, 12, 13, 32]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_LETTERS = np.zeros(256, dtype=bool)
_LETTERS[65:91] = _LETTERS[97:123] = True
_STOPS = np.zeros(256, dtype=bool)
_STOPS[np.frombuffer(b".,;:!?", np.uint8)] = True
_PRIME = np.uint64(0x100000001B3)
_SEED = np.uint64(0xCBF29CE484222325)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_STEP = np.uint64(0x9E3779B97F4A7C15)
# Longer words are hashed one by one.
_LONG = 64


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    values = (values ^ (values >> np.uint64(32))) * _MIX
    return values ^ (values >> np.uint64(29))


def utf8(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the ``n + 1`` offsets of the texts in them; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = texts.buffers()[2]
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return held[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str = "text", most_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with few bytes of text, one row at least."""
    _, offsets = utf8(batch.column(column))
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[start] + most_bytes, side="right")) - 1
        end = min(max(end, start + 1), batch.num_rows)
        yield batch.slice(start, end - start)
        start = end


@dataclass
class Words:
    """All words of some texts in order; ``docs`` numbers the texts from 0."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    docs: np.ndarray
    hashes: np.ndarray

    @property
    def n_docs(self) -> int:
        return len(self.offsets) - 1

    def per_doc(self) -> np.ndarray:
        """Number of words of each text."""
        return np.bincount(self.docs, minlength=self.n_docs)

    def text(self, i: int) -> str:
        return self.data[self.starts[i] : self.ends[i]].tobytes().decode()

    def ngrams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash and text number of every run of ``n`` words inside one text."""
        if len(self.hashes) < n:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        last = len(self.hashes) - n + 1
        grams = self.hashes[:last]
        for k in range(1, n):
            grams = mixed(grams * _STEP + self.hashes[k : last + k])
        inside = self.docs[:last] == self.docs[n - 1 :]
        return grams[inside], self.docs[:last][inside]


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span."""
    lengths = ends - starts
    # longest first: the spans that still have a byte at ``at`` are always a prefix
    order = np.argsort(-np.minimum(lengths, _LONG + 1).astype(np.int16), kind="stable")
    longer = len(lengths) - np.searchsorted(np.minimum(lengths[order], _LONG + 1)[::-1], np.arange(_LONG), side="right")
    places = starts[order]
    hashes = np.full(len(starts), _SEED)
    for at in range(_LONG):
        n = longer[at]
        if not n:
            break
        hashes[:n] = (hashes[:n] ^ data[places[:n] + at]) * _PRIME
    result = np.empty_like(hashes)
    result[order] = hashes
    for i in np.flatnonzero(lengths > _LONG):
        result[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]].tobytes())
    return mixed(result)


def words_of(texts: pa.Array | pa.ChunkedArray, fold: bool = False, cut_stops: bool = False) -> Words:
    """The words of all texts.

    ``fold`` lower-cases A-Z first; ``cut_stops`` also ends a word between an ASCII
    letter and one of ``.,;:!?``.
    """
    data, offsets = utf8(texts)
    if fold:
        data = _FOLD[data]
    inner = ~SEPARATORS[data]
    first = np.zeros(len(data) + 1, dtype=bool)
    first[offsets] = True
    if cut_stops and len(data):
        first[1:-1] |= _LETTERS[data[:-1]] & _STOPS[data[1:]]
    begins, stops = inner.copy(), inner.copy()
    if len(data):
        begins[1:] &= ~inner[:-1] | first[1:-1]
        stops[:-1] &= ~inner[1:] | first[1:-1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    docs = np.searchsorted(offsets, starts, side="right") - 1
    return Words(data, offsets, starts, ends, docs, hash_spans(data, starts, ends))
