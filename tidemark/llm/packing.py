"""Packing of tokenised documents into windows by the sum-of-squares rule.

Each document ends with an end id and is cut into full windows and a rest. A rest is placed online into the fill level
that makes the sum of squared counts of partially filled windows least, tracked in an array over the levels, which are
``STEP`` ids apart; a window that lacks less than that is topped up with the head of the next rest. So a few windows are
open at any time. At its input's end a packer pours what is left in these into full ones, and cuts the remainder into
powers of two.

Every input partition is packed by itself and in its own order, so nothing is shuffled, a lost task gives the same
rows again, and padding doesn't grow with the number of documents.

Defined cases: a null or empty text is one end id; equal rows are packed one by one; other columns are ignored; an
empty table gives no pieces.
"""

from __future__ import annotations

import re
import sys
import unicodedata
import zlib
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tidemark.llm.common import Memory, id_and_text

WINDOW, END_ID = 2048, 1
#: Ids between two fill levels. With fewer levels fewer windows are open at the end, and more rests are cut once.
STEP = 32
#: Distinct words, and parts of words, whose ids a worker remembers.
REMEMBERED = 300_000
#: Sequence ids are the partition's number times this, plus a running number.
SEQUENCES = 1 << 40
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


#: Kept by a Python worker from task to task.
_KNOWN: dict[str, Memory] = {}


_PLAIN = re.compile(r"([^\W\d_]+)([!-&(-/:-@\[-`{-~]*)")
#: How the vocabulary spells bytes: printable ones of Latin-1 as themselves, the others from 256 on.
_OWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_SHOWN = {b: 256 + i for i, b in enumerate(sorted({*range(256)} - {*_OWN}))}


def _packed(ids: list[int]) -> bytes:
    found = array("I", ids)
    if sys.byteorder == "big":
        found.byteswap()
    return found.tobytes()


class WordIds:
    """Token ids of texts as little-endian unsigned 32-bit bytes.

    The vocabulary's normaliser and pattern never join or look across white space, so each run without ASCII white
    space is encoded once and remembered. ``str.split`` on the six ASCII spaces only: other white space stays inside a
    run and is left to the tokenizer.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.part = lru_cache(REMEMBERED)(self.tokens)
        self.known = _KNOWN.setdefault(path, Memory(REMEMBERED, self.encode))

    def tokens(self, part: str) -> bytes:
        """Ids of letters in lower case or of ASCII marks by the vocabulary's merges alone."""
        return _packed([t.id for t in self.model.tokenize(part.encode().decode("latin-1").translate(_SHOWN))])

    def encode(self, words: list[bytes]) -> Iterator[bytes]:
        """Letters with ASCII marks behind them are two of the pattern's parts at most; other words take the whole way."""
        hard: list[str] = []
        out: list[bytes | None] = []
        for w in words:
            word = w.decode()
            m = _PLAIN.fullmatch(word)
            if m and m[1].isalpha() and (w.isascii() or unicodedata.is_normalized("NFC", word)):
                low = word[: m.end(1)]
                low = low.lower() if w.isascii() else "".join(map(str.lower, low))
                out.append(self.part(low) + (self.part(m[2]) if m[2] else b"") if low.isalpha() else None)
            else:
                out.append(None)
            if out[-1] is None:
                hard.append(word)
        rest = iter(self.tokenizer.encode_batch_fast(hard, add_special_tokens=False)) if hard else iter(())
        for ids in out:
            yield _packed(next(rest).ids) if ids is None else ids

    def many(self, texts: list[bytes]) -> Iterator[bytes]:
        """The ids of each text, in order."""
        for i in range(0, len(texts), 256):
            found = [list(map(self.known.__getitem__, t.split())) for t in texts[i : i + 256]]
            self.known.settle()
            yield from map(b"".join, found)


class Packer:
    """Sum-of-squares packing of byte strings of 4-byte ids into windows of ``window`` ids.

    Levels are ``step`` ids apart. A window that lacks less than a step is topped up with the head of the next rest.
    """

    def __init__(self, window: int, first: int, step: int = 1):
        self.window, self.next, self.step = window, first, step
        self.full = self.level(window)
        self.counts = np.zeros(self.full + 1, np.int64)  # open windows at each level
        self.fills = np.full(self.full + 1, window + 1, np.int64)  # ids in the last one of each level
        self.open: dict[int, list[tuple[int, list[tuple]]]] = {}  # by level: fill and pieces of each window
        self.short: tuple[int, list[tuple]] | None = None  # the window to be topped up

    def level(self, fill):
        return -(-fill // self.step)

    def level_for(self, size: int) -> int:
        """The level to add ``size`` ids to, 0 for a new window: of the least sum of squares, then the fullest."""
        counts, last = self.counts, self.level(self.window - size)
        levels = np.flatnonzero(self.fills[1 : last + 1] + size <= self.window) + 1
        own = self.level(size)
        alone = 0 if own == self.full else 2 * int(counts[own]) + 1  # a new window
        if not len(levels):
            return 0
        after = self.level(self.fills[levels] + size)
        # A window that moves up leaves one level and joins another; a full one is closed and counts no more.
        change = np.where(after == self.full, 1 - 2 * counts[levels], np.where(after == levels, 0, 2 * (counts[after] - counts[levels]) + 2))
        best = int(change.min())
        return 0 if alone < best else int(levels[np.flatnonzero(change == best)[-1]])

    def place(self, doc: int | None, start: int, ids: bytes, total: int) -> Iterator[tuple]:
        """Places a rest; yields the rows of windows that it fills."""
        if self.short:
            (fill, window), self.short = self.short, None
            room = 4 * (self.window - fill)
            window.append((doc, start, ids[:room], total))
            if len(ids) < room:
                self.short = fill + len(ids) // 4, window
                return
            yield from self.close(window)
            start, ids = start + room // 4, ids[room:]
            if not ids:
                return
        size = len(ids) // 4
        level = self.level_for(size)
        fill, window = self.taken(level) if level else (0, [])
        window.append((doc, start, ids, total))
        fill += size
        level = self.level(fill)
        if fill == self.window:
            yield from self.close(window)
        elif level == self.full:
            self.short = fill, window
        else:
            self.open.setdefault(level, []).append((fill, window))
            self.counts[level] += 1
            self.fills[level] = fill

    def taken(self, level: int) -> tuple[int, list[tuple]]:
        """The last window of a level, no longer open."""
        at = self.open[level]
        found = at.pop()
        self.counts[level] -= 1
        self.fills[level] = at[-1][0] if at else self.window + 1
        if not at:
            del self.open[level]
        return found

    def close(self, window: list[tuple]) -> Iterator[tuple]:
        offset = 0
        for doc, start, ids, total in window:
            yield doc, start, len(ids) // 4, zlib.crc32(ids), total, self.next, offset
            offset += len(ids) // 4
        self.next += 1

    def finish(self) -> Iterator[tuple]:
        """Pours the open windows together: full windows, then the remainder in windows of powers of two."""
        pieces = [*(self.short[1] if self.short else ()), *(p for level in sorted(self.open, reverse=True) for _, w in self.open[level] for p in w)]
        left = sum(len(p[2]) for p in pieces) // 4
        self.open, self.short, pieces = {}, None, pieces[::-1]
        while left:
            size = self.window if left >= self.window else 1 << (left.bit_length() - 1)
            left -= size
            window = []
            while size:
                doc, start, ids, total = pieces.pop()
                n = len(ids) // 4
                if n > size:
                    pieces.append((doc, start + size, ids[4 * size :], total))
                    ids, n = ids[: 4 * size], size
                window.append((doc, start, ids, total))
                size -= n
            yield from self.close(window)


def pack(batches: Iterable[tuple[list, list[bytes]]], path: str, part: int, window: int = WINDOW, end_id: int = END_ID) -> Iterator[list[tuple]]:
    """Rows of ``SCHEMA`` for batches of (doc_ids, texts), a list for each batch and one for the end."""
    words, packer = WordIds(path), Packer(window, part * SEQUENCES, STEP)
    end = np.array([end_id], "<u4").tobytes()
    for ids, texts in batches:
        rows: list[tuple] = []
        for doc, x in zip(ids, words.many(texts), strict=True):
            x += end
            n = len(x) // 4
            for start in range(0, n - window + 1, window):
                rows += packer.close([(doc, start, x[4 * start : 4 * (start + window)], n)])
            if n % window:
                start = n - n % window
                rows += packer.place(doc, start, x[4 * start :], n)
        yield rows
    yield list(packer.finish())


def packed(docs: DataFrame, path: str) -> DataFrame:
    """The pieces of all documents, with the vocabulary at ``path`` (a file that every executor has)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        columns = [c.split() for c in SCHEMA.split(", ")]
        given = ((b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()) for b in batches)
        for rows in pack(given, path, part):
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=[c for c, _ in columns])

    return id_and_text(docs).mapInArrow(run, SCHEMA)


def read_back(pieces: pd.DataFrame, ids: dict[int, bytes]) -> bool:
    """Whether ``pieces`` hold each id of ``ids`` (doc_id to bytes) exactly once and fill their windows without gaps."""
    for doc, rows in pieces.sort_values("start").groupby("doc_id"):
        at = 0
        for r in rows.itertuples():
            if r.start != at or zlib.crc32(ids[doc][4 * at : 4 * (at + r.length)]) != r.ids_crc32 or r.doc_tokens != len(ids[doc]) // 4:
                return False
            at += r.length
        if at != len(ids[doc]) // 4:
            return False
    for _, rows in pieces.sort_values("offset").groupby("sequence_id"):
        if (rows["offset"] != rows["length"].cumsum().shift(fill_value=0)).any() or rows["length"].sum() > WINDOW:
            return False
    return True


def op9_packing(docs: DataFrame) -> DataFrame:
    """The contract's columns."""
    import public_tokenizers

    return packed(docs, public_tokenizers.path("word_bpe_49k.json"))
