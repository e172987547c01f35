"""Token counts of a unigram vocabulary, by dynamic programming shared in a trie.

The best segmentation of a pre-token maximises the sum of piece scores. The best
score of a prefix does not depend on what follows, so distinct pre-tokens are
inserted in a trie whose nodes hold the forward score of their path and the number
of tokens that reach it: common prefixes are computed once, and the count of a
pre-token is what its last node stores.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.pieces import MARK, NORMAL, UNIGRAM, USER, PieceModel, load_model
from newsloom.llm.words import slices, words_of


# The usual shift of the Zipf-Mandelbrot law for words.
ZIPF_SHIFT = 2.7


@dataclass(frozen=True)
class UnigramScores:
    """Piece scores by text, the longest piece, and the score of a character outside the vocabulary."""

    scores: dict[str, float]
    longest: int
    unknown: float

    @classmethod
    def of(cls, model: PieceModel) -> UnigramScores:
        kept = {p: s for p, s, k in zip(model.pieces, model.scores, model.kinds, strict=True) if k in (NORMAL, USER)}
        if model.model_type != UNIGRAM:
            ranked = sorted(kept, key=lambda p: -kept[p])
            shares = [1.0 / (rank + ZIPF_SHIFT) for rank in range(1, len(ranked) + 1)]
            whole = math.log(math.fsum(shares))
            kept = {p: math.log(share) - whole for p, share in zip(ranked, shares, strict=True)}
        return cls(kept, max(map(len, kept)), min(kept.values()) - 10.0)


class ForwardTrie:
    """Forward scores and token counts of inserted pre-tokens.

    Characters outside the vocabulary cost one token per byte (byte fallback). Of
    segmentations with equal scores the one with the longest last piece stands, as
    in the usual forward pass. Pre-tokens come in sorted order, so the path of the
    last one is all of the trie that is still needed; finished branches only leave
    their terminal counts.
    """

    def __init__(self, vocabulary: UnigramScores):
        self._scores, self._longest, self._unknown = vocabulary.scores, vocabulary.longest, vocabulary.unknown
        self._path, self._best, self._count = "", [0.0], [0]
        self.nodes = 0

    def count(self, token: str) -> int:
        """Insert a pre-token; return the tokens of its best segmentation."""
        best, count, scores = self._best, self._count, self._scores
        shared, limit = 0, min(len(token), len(self._path))
        while shared < limit and token[shared] == self._path[shared]:
            shared += 1
        del best[shared + 1 :], count[shared + 1 :]
        for end in range(shared + 1, len(token) + 1):
            top, n = -1e300, 0
            for start in range(max(0, end - self._longest), end):
                score = scores.get(token[start:end])
                if score is not None and best[start] + score > top:
                    top, n = best[start] + score, count[start] + 1
            last = token[end - 1]
            if last not in scores and best[end - 1] + self._unknown > top:
                top, n = best[end - 1] + self._unknown, count[end - 1] + len(last.encode("utf-8", "surrogatepass"))
            best.append(top)
            count.append(n)
        self.nodes += len(token) - shared
        self._path = token
        return count[-1]


def token_counts(documents: DataFrame, path: str, most: int = 400_000) -> DataFrame:
    """``doc_id, n_words, n_distinct, n_tokens`` of every document.

    A pre-token is a word with the metaspace mark before it. Distinct pre-tokens of
    a slice of rows go through the trie in sorted order; at most ``most`` of their
    counts are kept for later rows. Null and empty texts have no tokens; null ids
    stay null; repeated rows are counted alike.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = UnigramScores.of(load_model(path))
        known_hashes, known_counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            for part in slices(batch, most_bytes=16 << 20):
                words = words_of(part.column("text"))
                hashes, firsts, inverse = np.unique(words.hashes, return_index=True, return_inverse=True)
                counts = np.zeros(len(hashes), np.int64)
                at = np.minimum(np.searchsorted(known_hashes, hashes), max(len(known_hashes) - 1, 0))
                seen = known_hashes[at] == hashes if len(known_hashes) else np.zeros(len(hashes), bool)
                counts[seen] = known_counts[at[seen]]
                fresh = np.flatnonzero(~seen)
                tokens = sorted((MARK + words.text(firsts[i]), i) for i in fresh)
                trie = ForwardTrie(vocabulary)
                for token, i in tokens:
                    counts[i] = trie.count(token)
                if len(known_hashes) > most:
                    known_hashes, known_counts = hashes, counts
                else:
                    merged = np.concatenate([known_hashes, hashes[fresh]])
                    order = np.argsort(merged, kind="stable")
                    known_hashes = merged[order]
                    known_counts = np.concatenate([known_counts, counts[fresh]])[order]
                n = words.n_docs
                pairs = np.unique(words.docs.astype(np.int64) * np.int64(len(hashes) + 1) + inverse)
                distinct = np.bincount(pairs // (len(hashes) + 1), minlength=n)
                tokens_per_doc = np.bincount(words.docs, counts[inverse], minlength=n)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(x.astype(np.int64)) for x in (words.per_doc(), distinct, tokens_per_doc))],
                    ["doc_id", "n_words", "n_distinct", "n_tokens"],
                )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(count, "doc_id long, n_words long, n_distinct long, n_tokens long")
