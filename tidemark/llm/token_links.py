"""Alignment of two tokenisers: groups of tokens between common byte ends, and counts of the links inside.

A byte-level BPE (A) and a piece model (B) cut the same bytes. Groups end where tokens of both end; two tokens are
linked where their bytes overlap. A group of one token each with equal bytes is the common case: an array from A's ids
to B's ids of the same bytes, made once, tells it, and its link is counted in a vector as long as A's vocabulary. Only
links of irregular groups become pairs, counted inside a block of documents before they are shuffled. The counts of
all pairs then answer the blocks: a block asks once for each of its distinct irregular pairs, and gets the answers as
one list in the order of its own pairs, so that a frequent pair is a row for each block, never for each occurrence.

Defined cases: a text that is null or empty, or whose tokens of A or B don't join to its bytes after a space (a model
that rewrites characters), has no tokens: zeros, and an empty digest; special tokens' strings are ordinary text;
repeated rows are counted and returned each; other columns are ignored; an empty table gives an empty result. A text
is tokenised as a whole, so a task holds the tokens of its longest text.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import id_and_text, temporary, written

#: Bytes of text after which a block of documents ends.
BLOCK = 3 << 20
#: A row group for each block: Spark decodes arrays of up to 4,096 rows of a row group at once, so a task that reads
#: blocks would hold all of a file, and the more the larger the part of the input that made it.
GROUPS = {"parquet.block.row.count.limit": 1}
_LOW = (1 << 32) - 1


class Aligner:
    """The two tokenisers, the bytes of their ids and the ids of B with the bytes of A's."""

    def __init__(self, ranks_path: str, pattern: str, piece_path: str):
        import sentencepiece
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.a = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        self.bytes_a = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.bytes_a[i] = token
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else b"" if self.b.is_control(i) or self.b.is_unknown(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.len_a, self.len_b = (np.array(list(map(len, t)), np.int64) for t in (self.bytes_a, self.bytes_b))
        ids = sorted((i for i, t in enumerate(self.bytes_b) if t), key=lambda i: (not self.b.is_byte(i), -i))
        same = {self.bytes_b[i]: i for i in ids}  # whole pieces before single bytes, then the least id
        self.same = np.array([same.get(t, -1) if t else -1 for t in self.bytes_a], np.int64)
        # Strings of an id and what follows it: inside a group, at the end of its A half (A) or of the group (B).
        self.text = np.array([f"{i}{end}" for ids, ends in ((self.bytes_a, ",|"), (self.bytes_b, ",;")) for i in range(len(ids)) for end in ends], object)

    def tokens(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of both, or none. A's tokens always join to the text; B's model may have changed characters."""
        if text:
            b = self.b.EncodeAsIds(text)
            if b"".join(map(self.bytes_b.__getitem__, b)) == (" " + text).encode():
                return self.a.encode_to_numpy(" " + text, disallowed_special=()).astype(np.int64), np.array(b, np.int64)
        return np.zeros(0, np.int64), np.zeros(0, np.int64)

    def digests(self, keys: np.ndarray, sizes: np.ndarray) -> list[str]:
        """The hash of each document's groups as text, from its tokens' places in ``text``."""
        out, to = [], 0
        for n in sizes.tolist():
            own = "".join(self.text[keys[to : to + n]].tolist())
            out.append(hashlib.sha256(own[:-1].encode()).hexdigest() if n else "")
            to += n
        return out

    def block(self, texts: list[str]) -> tuple[dict, np.ndarray]:
        """Columns of a block's row, and the one-to-one links by A's id."""
        both = [self.tokens(t) for t in texts]
        n_a, n_b = (np.array([len(t[k]) for t in both]) for k in (0, 1))
        a, b = (np.concatenate([t[k] for t in both]) for k in (0, 1))
        ends_a, ends_b = np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b])
        # Overlaps are the stretches between neighbouring ends of either; a stable sort merges the two ascending rows.
        ends = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")
        ends = ends[np.diff(ends, prepend=0) > 0]
        i, j = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        both_end = (ends_a[i] == ends) & (ends_b[j] == ends)
        last_a, last_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
        last_a[i[both_end]] = last_b[j[both_end]] = True
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        la, lb = a[i], b[j]
        single = (np.bincount(group_a) == 1) & (np.bincount(group_b) == 1) if len(a) else np.zeros(0, bool)
        identity = single[group_a[i]] & (self.same[la] == lb)
        vector = np.bincount(la[identity], minlength=len(self.bytes_a))
        pairs, at, n = np.unique((la << 32 | lb)[~identity], return_inverse=True, return_counts=True)
        ref = -1 - la  # of one-to-one links A's id, of the others the place among the block's pairs
        ref[~identity] = at
        text_of = np.repeat(np.arange(len(texts)), n_a)
        of = text_of[i]
        known, times = np.unique((of << 32) + (ref + (1 << 31)), return_counts=True)
        per = np.bincount(known >> 32, minlength=len(texts))
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        keys = np.concatenate([2 * a + last_a, 2 * (b + len(self.bytes_a)) + last_b])[order]
        groups = np.bincount(text_of[last_a], minlength=len(texts))
        return {"n_a": n_a, "n_b": n_b, "n_groups": groups, "n_links": np.bincount(of, minlength=len(texts)), "digest": self.digests(keys, n_a + n_b), "refs_of": per, "refs": (known & _LOW) - (1 << 31), "times": times, "pairs": pairs, "n": n}, vector


@lru_cache(2)
def aligner(ranks_path: str, pattern: str, piece_path: str) -> Aligner:
    """Read once by each worker."""
    return Aligner(ranks_path, pattern, piece_path)


_LONGS = ("doc_id", "n_a", "n_b", "n_groups", "n_links")
_BLOCK = pa.schema([("block", pa.int64()), *[(c, pa.list_(pa.int64())) for c in _LONGS], ("digest", pa.list_(pa.string())), ("refs_of", pa.list_(pa.int32())), ("refs", pa.list_(pa.int32())), ("times", pa.list_(pa.int32())), ("pairs", pa.list_(pa.int64())), ("n", pa.list_(pa.int64()))])
_BLOCK_DDL = "block long, " + ", ".join(f"{c} array<long>" for c in _LONGS) + ", digest array<string>, refs_of array<int>, refs array<int>, times array<int>, pairs array<long>, n array<long>"


def blocks(docs: DataFrame, ranks_path: str, pattern: str, piece_path: str) -> DataFrame:
    """A row for each block of documents, and at each partition's end one without documents: its one-to-one links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        al = aligner(ranks_path, pattern, piece_path)
        total = np.zeros(len(al.bytes_a), np.int64)
        number, ids, texts, size = TaskContext.get().partitionId() << 32, [], [], 0

        def ready() -> pa.RecordBatch:
            row, vector = al.block(texts)
            np.add(total, vector, out=total)
            return pa.RecordBatch.from_pylist([], schema=_BLOCK) if not ids else pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *[pa.array([(ids if f.name == "doc_id" else row[f.name])], f.type) for f in list(_BLOCK)[1:]]], schema=_BLOCK)

        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    ids.append(i)
                    texts.append(t)
                    size += len(t)
                    if size >= BLOCK:
                        yield ready()
                        number, ids, texts, size = number + 1, [], [], 0
        if ids:
            yield ready()
        a = np.flatnonzero(total)
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.nulls(1, f.type) for f in list(_BLOCK)[:-2]] + [pa.array([a << 32 | al.same[a]], _BLOCK.field("pairs").type), pa.array([total[a]], _BLOCK.field("n").type)], schema=_BLOCK)

    return id_and_text(docs).mapInArrow(run, _BLOCK_DDL)


def pair_counts(found: DataFrame) -> DataFrame:
    """pair (A's id in the upper half, B's in the lower), n, best: how many links of all texts, and whether no pair of its B id has more.

    What is broadcast has a row for each id of B at most.
    """
    n = found.select(F.inline(F.arrays_zip("pairs", "n"))).groupBy(F.col("pairs").alias("pair")).agg(F.sum("n").alias("n"))
    most = n.groupBy(F.col("pair").bitwiseAND(F.lit(_LOW)).alias("b")).agg(F.max("n").alias("most"))
    return n.join(F.broadcast(most), F.col("pair").bitwiseAND(F.lit(_LOW)) == F.col("b")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def aligned(docs: DataFrame, ranks_path: str, pattern: str, piece_path: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for each document."""
    spark = docs.sparkSession
    al = aligner(ranks_path, pattern, piece_path)
    with temporary(spark):
        found = written(blocks(docs, ranks_path, pattern, piece_path), options=GROUPS)
        counts = written(pair_counts(found))
        a = np.flatnonzero(al.same >= 0)
        ids = spark.createDataFrame(pa.table({"pair": a << 32 | al.same[a]}))  # no more than A's vocabulary
        known = counts.join(F.broadcast(ids), "pair", "left_semi").toArrow()
        of_a = np.asarray(known["pair"]) >> 32
        count_a, best_a = np.zeros(len(al.same), np.int64), np.zeros(len(al.same), np.int64)
        count_a[of_a], best_a[of_a] = known["n"], np.asarray(known["best"])
        own = found.where("doc_id is not null")
        asked = own.select("block", F.posexplode("pairs").alias("at", "pair"))
        told = asked.join(counts, "pair").groupBy("block").agg(F.array_sort(F.collect_list(F.struct("at", "n", "best"))).alias("told"))
        told = told.select("block", F.col("told.n").alias("counts"), F.col("told.best").alias("bests"))
        joined = own.select("block", *_LONGS, "digest", "refs_of", "refs", "times").join(told, "block", "left").drop("block")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in range(batch.num_rows):
                    r = {c: batch.column(c)[k].values for c in batch.schema.names}
                    whole = lambda x: np.zeros(0, np.int64) if x is None else np.asarray(x).astype(np.int64)
                    refs, times = whole(r["refs"]), whole(r["times"])
                    count, best = (np.concatenate([whole(r[c]), v[::-1]])[refs] for c, v in (("counts", count_a), ("bests", best_a)))
                    ends = np.concatenate([[0], np.cumsum(whole(r["refs_of"]))])
                    sums = [np.diff(np.concatenate([[0], np.cumsum(times * x)])[ends]) for x in (best, count)]
                    yield pa.RecordBatch.from_arrays([*(r[c] for c in _LONGS), *map(pa.array, sums), r["digest"]], names=[*_LONGS, "n_best", "count_sum", "groups_sha256"])

        out = joined.mapInArrow(run, ", ".join(f"{c} long" for c in (*_LONGS, "n_best", "count_sum")) + ", groups_sha256 string")
        return written(out, outer=True)


def op12_token_links(docs: DataFrame) -> DataFrame:
    """The contract's columns."""
    import public_tokenizers as public

    return aligned(docs, public.path("byte_bpe_50k.tiktoken"), public.PATTERN, public.path("piece_bpe_32k.model"))
