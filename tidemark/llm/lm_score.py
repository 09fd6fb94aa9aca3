"""Language-model scores by stupid backoff, with n-gram counts over the whole table.

A word's score is the share of its n-gram among those of its context; an n-gram that the corpus has fewer than
``MIN_COUNT`` times is left for the next shorter one at a price of ``BACKOFF``; a single word's share is of all words.
Logarithms are summed for each document.

Documents are dealt to blocks by a hash. A block sends its distinct n-grams (64-bit hashes, sorted, packed) with counts
to the count tables, which are partitioned by hash; each table partition adds the counts up and answers every block
that asked, in the block's order. Block and answers meet again in a cogroup that reuses the block's shuffle. So each
n-gram is exchanged once for a block and never by itself, and no word is hot: a block asks for it once.

Defined cases: a null or empty text has no words and no score (null); equal rows are counted and scored each; words
differ by letter case only outside A-Z; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import id_and_text, written
from tidemark.llm.minhash import _chunks, mixed, word_hashes

ORDER, BACKOFF, MIN_COUNT = 3, 0.4, 2
#: Bytes of text in a block, on average.
BLOCK_BYTES = 12_000_000


def _planes(x: np.ndarray) -> bytes:
    """The bytes of sorted or small numbers, those of equal weight together (what repeats stands together), compressed."""
    return zlib.compress(x.view(np.uint8).reshape(len(x), -1).T.tobytes(), 1)


def _from_planes(b: bytes, dtype: type) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(b), np.uint8).reshape(width, -1).T).view(dtype).ravel()


def _sorted_planes(keys: np.ndarray) -> bytes:
    """Sorted keys as the planes of their gaps: these are small, so the planes of most weight are zero."""
    return _planes(np.diff(keys, prepend=np.uint64(0)))


def _short(texts: pa.Array) -> pa.Array:
    return pa.array([zlib.compress(t, 3) for t in texts.cast(pa.binary()).to_pylist()], pa.binary())


def ngrams(texts: pa.ChunkedArray, order: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Words of each (compressed) text, the place of each word in its text, and for each order the hash of the n-gram that ends there."""
    sizes, hashes = [], []
    for chunk in texts.chunks:
        for _, _, data, ends in _chunks(pa.array(map(zlib.decompress, chunk.to_pylist()), pa.large_binary())):
            h, bounds = word_hashes(data, ends)
            hashes.append(h)
            sizes.append(np.diff(bounds))
    n = np.concatenate([np.zeros(0, np.int64), *sizes]).astype(np.int64)
    h = np.concatenate([np.zeros(0, np.uint64), *hashes])
    place = np.arange(len(h)) - np.repeat(np.cumsum(n) - n, n)
    grams = [h]
    for _ in range(1, order):
        before = np.concatenate([np.zeros(1, np.uint64), grams[-1][:-1]]) if len(h) else h
        grams.append(mixed(before * np.uint64(0x9FB21C651E98DF25) + h))
    return n, place, grams


def counted(docs: DataFrame, blocks: int, parts: int, order: int) -> DataFrame:
    """block, ord, part and ``counts``: for each block's distinct n-grams, in the order of their hashes, the corpus count."""

    def ask(block: pa.Table) -> pa.Table:
        number = block.column("block")[0].as_py()
        _, place, grams = ngrams(block.column("text"), order)
        rows = []
        for k, g in enumerate(grams):
            keys, n = np.unique(g[place >= k], return_counts=True)
            at = (keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
            cuts = np.searchsorted(at, np.arange(parts + 1, dtype=np.uint64))
            rows += [(number, k, p, _sorted_planes(keys[a:b]), _planes(n[a:b].astype(np.uint32))) for p, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
        cols = list(zip(*rows, strict=True)) or [()] * 5
        return pa.table({"block": pa.array(cols[0], pa.int64()), "ord": pa.array(cols[1], pa.int32()), "part": pa.array(cols[2], pa.int32()), "keys": pa.array(cols[3], pa.binary()), "n": pa.array(cols[4], pa.binary())})

    def answer(asked: pa.Table) -> pa.Table:
        keys = [np.cumsum(_from_planes(b, np.uint64), dtype=np.uint64) for b in asked.column("keys").to_pylist()]
        n = np.concatenate([_from_planes(b, np.uint32) for b in asked.column("n").to_pylist()])
        _, back = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(back, n).astype(np.uint64)[back]
        ends = np.cumsum([0, *map(len, keys)])
        counts = [_planes(total[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        return asked.drop_columns(["keys", "n"]).append_column("counts", pa.array(counts, pa.binary()))

    asked = docs.groupBy("block").applyInArrow(ask, "block long, ord int, part int, keys binary, n binary")
    return asked.groupBy("ord", "part").applyInArrow(answer, "block long, ord int, part int, counts binary")


def scored(docs: DataFrame, order: int = ORDER, backoff: float = BACKOFF, least: int = MIN_COUNT) -> DataFrame:
    """doc_id, n_words, level_1 .. level_<order> (words scored by n-grams of that length) and log_score.

    ``log_score`` still lacks the number of all words: take its logarithm off once for each word of level 1.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    d = id_and_text(docs)
    size = d.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    blocks = max(1, math.ceil(size / BLOCK_BYTES))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), _short(b.column(1)), b.column(2)], names=["doc_id", "text", "block"])

    d = d.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("long"))
    dealt = d.mapInArrow(packed, "doc_id long, text binary, block long").repartition(parts, "block")
    levels = [f"level_{k}" for k in range(1, order + 1)]

    def score(block: pa.Table, answers: pa.Table) -> pa.Table:
        n, place, grams = ngrams(block.column("text"), order)
        answers = answers.sort_by([("ord", "ascending"), ("part", "ascending")]) if len(answers) else answers
        which = answers.column("ord").to_numpy()
        lists = answers.column("counts").to_pylist()
        context = value = level = None
        for k in range(order):
            here = place >= k
            _, back = np.unique(grams[k][here], return_inverse=True)
            grams[k] = None  # not needed any more
            counts = np.concatenate([np.zeros(0, np.uint64), *(_from_planes(lists[i], np.uint64) for i in np.flatnonzero(which == k))])
            seen = np.ones(len(place))
            seen[here] = counts[back]
            if k == 0:
                value, level = np.log(seen), np.ones(len(place), np.int8)
            else:
                hit = np.flatnonzero(here & (seen >= least))
                value[hit] = np.log(seen[hit]) - np.log(context[hit - 1])
                level[hit] = k + 1
            context = seen
        value += math.log(backoff) * (np.minimum(place + 1, order) - level)
        owner = np.repeat(np.arange(len(n)), n)
        out = {"doc_id": block.column("doc_id").combine_chunks(), "n_words": pa.array(n, pa.int64())}
        for k, name in enumerate(levels, 1):
            out[name] = pa.array(np.bincount(owner[level == k], minlength=len(n)), pa.int64())
        return pa.table(out | {"log_score": pa.array(np.bincount(owner, value, len(n)), pa.float64())})

    answers = counted(dealt, blocks, 2 * blocks, order)  # as many table partitions as the size asks for, whatever the session
    schema = ", ".join(["doc_id long", "n_words long", *(f"{x} long" for x in levels), "log_score double"])
    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(score, schema)


def op5_lm_score(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, the words scored at each level, and ``score``: the mean logarithm of a word's score, rounded."""
    d = written(scored(docs))
    total = d.agg(F.sum("n_words").alias("n")).first()["n"] or 1
    mean = (F.col("log_score") - F.col("level_1") * math.log(max(total, 1))) / F.nullif("n_words", F.lit(0))
    return d.select("doc_id", "n_words", "level_1", "level_2", "level_3", F.round(mean, 6).alias("score"))
