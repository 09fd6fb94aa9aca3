"""Byte-level BPE by monoid tree reduction.

A text is split in halves down to leaves; each leaf is cut into pieces by the vocabulary's pattern and each piece
encoded by itself. Two neighbours are joined by cutting again from the last piece of the left one that provably
stays, until the cut meets a piece boundary of the right one: from there on the pattern sees the same text. Inside a
long piece the halves' tokens are joined likewise: a window around the seam is encoded again and grows until the
tokens at its edges and those outside are compatible, that is, until encoding the two together gives the same two
tokens. A row of tokens in which all neighbours are compatible is the encoding, so nothing outside can change.
Decoding concatenates the tokens' bytes up the same tree.

Defined cases: a null or empty text has no tokens and decodes to nothing; equal rows are encoded alike; special tokens'
strings are ordinary text; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Memory, id_and_text

#: Characters of a leaf of the tree over a text, and the most bytes of one over a piece.
LEAF_CHARS, LEAF_BYTES = 8192, 8
#: The pattern's choice at a piece depends on no more characters than these beyond its end.
LOOKAHEAD = 2
#: Distinct pieces that a worker remembers.
REMEMBERED = 400_000


class Vocabulary:
    """Ranks of byte strings and the pattern that cuts texts into pieces."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.cut: Callable = regex.compile(pattern).finditer
        self.find_all: Callable = regex.compile(pattern).findall
        self.known = Memory(REMEMBERED, lambda pieces: [np.array(self.encode_piece(p.encode()), "<i4").tobytes() for p in pieces])
        self.merge = lru_cache(300_000)(self._merge)
        self.compatible = lru_cache(200_000)(self._compatible)

    # --- inside a piece

    def _merge(self, piece: bytes) -> list[int]:
        """The tokens of a short piece (not to be changed: they are remembered): the neighbours of the lowest rank are joined, the leftmost first."""
        if (found := self.ranks.get(piece)) is not None:
            return [found]
        parts = [piece[i : i + 1] for i in range(len(piece))]
        none = 1 << 60
        pair = [self.ranks.get(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
        while pair and (least := min(pair)) < none:
            i = pair.index(least)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pair[i]
            if i < len(pair):
                pair[i] = self.ranks.get(parts[i] + parts[i + 1], none)
            if i:
                pair[i - 1] = self.ranks.get(parts[i - 1] + parts[i], none)
        return [self.ranks[p] for p in parts]

    def _compatible(self, a: int, b: int) -> bool:
        return self.merge(self.bytes_of[a] + self.bytes_of[b]) == [a, b]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The tokens of two neighbouring parts of a piece together."""
        if not left or not right or self.compatible(left[-1], right[0]):
            return left + right
        i, j = len(left) - 1, 1
        while True:
            window = self.merge(b"".join(map(self.bytes_of.__getitem__, left[i:] + right[:j])))
            left_ok = i == 0 or self.compatible(left[i - 1], window[0])
            right_ok = j == len(right) or self.compatible(window[-1], right[j])
            if left_ok and right_ok:
                return left[:i] + window + right[j:]
            i, j = i if left_ok else i - 1, j if right_ok else j + 1

    def encode_piece(self, piece: bytes) -> list[int]:
        """The tokens of a piece of any length, joined up a tree whose leaves are single tokens: the longest that match."""
        ranks, at, n = self.ranks, 0, len(piece)
        if (found := ranks.get(piece)) is not None:
            return [found]
        level = []
        while at < n:
            end = min(n, at + LEAF_BYTES)
            while (found := ranks.get(piece[at:end])) is None:
                end -= 1
            level.append([found])
            at = end
        while len(level) > 1:
            level = [self.join(level[i], level[i + 1]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
        return level[0] if level else []

    # --- over a text

    def pieces(self, text: str) -> list[str]:
        """The pattern's matches in ``text``, by halves."""
        if len(text) <= LEAF_CHARS:
            return self.find_all(text)
        half = len(text) // 2
        return self.join_pieces(text, half, self.pieces(text[:half]), self.pieces(text[half:]))

    def join_pieces(self, text: str, half: int, left: list[str], right: list[str]) -> list[str]:
        """The matches in ``text`` from those of its two parts."""
        end = half
        while left and end > half - LOOKAHEAD:
            end -= len(left.pop())
        bound, k, between = half, 0, []
        for m in self.cut(text, end):
            while bound < m.start() and k < len(right):
                bound += len(right[k])
                k += 1
            if m.start() == bound:
                return left + between + right[k:]
            between.append(m.group())
        return left + between

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """The ids (int32) of each text."""
        found = [list(map(self.known.__getitem__, self.pieces(t))) for t in texts]
        self.known.settle()
        return [np.frombuffer(b"".join(f), "<i4") for f in found]

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of ``ids``, concatenated up the tree."""
        if len(ids) <= 1024:
            return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))
        return self.decode(ids[: len(ids) // 2]) + self.decode(ids[len(ids) // 2 :])


@lru_cache(4)
def vocabulary(path: str, pattern: str) -> Vocabulary:
    """Read once by each worker."""
    with open(path, "rb") as f:
        return Vocabulary({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}, pattern)


def encoded(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids (array<int>), decoded (binary) for each document; the vocabulary at ``path`` is on every executor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path, pattern)
        for b in batches:
            for k in range(0, b.num_rows, 256):
                part = b.slice(k, 256)
                ids = v.encode_all(part.column(1).to_pylist())
                texts = list(map(v.decode, ids))
                ends = np.cumsum([0, *map(len, ids)])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids), pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), lists, pa.array(texts, pa.binary())], names=["doc_id", "ids", "decoded"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, ids array<int>, decoded binary")


def op4_bpe(docs: DataFrame) -> DataFrame:
    """The contract's columns."""
    import public_tokenizers

    d = encoded(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    joined = F.array_join(F.col("ids").cast("array<string>"), " ")
    return d.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.encode(joined, "UTF-8"), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
