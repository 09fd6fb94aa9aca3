"""Near-duplicates by SuperMinHash signatures, banding, verification on full sets and union-find.

Union-find runs as hooking and jumping: each round hooks a node's root below the least root next to it, then every node
takes its parent's parent.

A document's set holds its distinct word shingles. Documents with equal sets form a class; signatures, candidates and
links are between classes, so copies are never paired. In SuperMinHash each element has one random permutation of the
signature's places and takes place ``j`` of it with rank ``j`` plus a random fraction; elements of a set stop together
once every place holds a rank that no later one can lower. All elements of a batch advance rank by rank in numpy.

Bands of the signature give buckets. A bucket's centre, the member that shares most buckets with others, is compared
with every other on full sets. Members that are then still in different components are compared with each other if
they can be linked at all, by their differences from the centre (``open_pairs``); no other pairs are made.
With 32 bands of 4, a pair at similarity 0.85 misses all buckets with a chance below 1e-10, at 0.8 below 1e-7.

Defined cases: a text without words has an empty set and no links; equal rows are in one class; rows that share a
doc_id count as one document; rows without a doc_id have no component and are kept; other columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import id_and_text, temporary, written

PLACES, BANDS = 128, 32
#: Bytes of text that are worked on at once; a longer text is worked on alone.
CHUNK = 2_000_000
_BASE = 0x9E3779B97F4A7C13
_TABLE = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_TABLE[[32, *range(9, 14)]] = 0


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the splitmix finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class _Powers:
    """Powers of the base and of its inverse modulo 2^64, as far as asked for so far."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            inverse = pow(_BASE, -1, 2**64)
            size = max(n, CHUNK)
            cls.up, cls.down = (np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)]), dtype=np.uint64) for b in (_BASE, inverse))
        return cls.up[:n], cls.down[:n]


def word_hashes(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word (A-Z as a-z) of the texts in ``data``, and the number of words before each text's end."""
    n = len(data)
    low = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    up, down = _Powers.upto(n)
    values = _TABLE[low]
    inside = values != 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begins = ends[:-1][ends[:-1] < n]
    first[begins] = inside[begins]
    at = np.flatnonzero(first)
    h = mixed(np.add.reduceat(values * up, at) * down[at]) if len(at) else np.zeros(0, np.uint64)
    return h, np.searchsorted(at, ends)


def shingles(data: np.ndarray, ends: np.ndarray, words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; text i is ``data[ends[i]:ends[i + 1]]``, bytes of UTF-8."""
    h, bounds = word_hashes(data, ends)
    if not len(h):
        return [np.zeros(0, np.uint64)] * (len(ends) - 1)
    grams = h.copy()
    for k in range(1, words):
        grams = mixed(grams * np.uint64(0x9FB21C651E98DF25) + np.uint64(k))
        grams[: max(len(h) - k, 0)] += h[k:]
    grams = mixed(grams)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= words:
            out.append(np.unique(grams[a : b - words + 1]))
        elif b > a:
            whole = np.full(1, b - a, np.uint64)
            for v in h[a:b]:
                whole = mixed(whole * np.uint64(0xC2B2AE3D27D4EB4F) + v)
            out.append(whole)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def superminhash(sets: list[np.ndarray], places: int = PLACES) -> np.ndarray:
    """The signatures (sets x places) of non-empty sets; a value is the rank in its high and the fraction in its low 32 bits."""
    m = places
    sig = np.full(len(sets) * m, np.iinfo(np.uint64).max, np.uint64)
    values = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    perm = None
    for j in range(m):
        x = mixed(values + np.uint64((j + 1) * 0x9E3779B97F4A7C15 % 2**64))
        k = j + ((x & np.uint64(0xFFFFFFFF)) * np.uint64(m - j) >> np.uint64(32)).astype(np.int64)
        if j == 0:
            place = k
        else:
            rows = np.arange(len(values))
            place = perm[rows, k].copy()
            perm[rows, k] = perm[:, j]
            perm[:, j] = place
        np.minimum.at(sig, owner * m + place, (x >> np.uint64(32)) | np.uint64(j << 32))
        if j == m - 1:
            break
        going = (sig.reshape(-1, m) >= np.uint64((j + 1) << 32)).any(axis=1)
        stay = going[owner]
        if not stay.any():
            break
        if j == 0:
            perm = np.tile(np.arange(m, dtype=np.uint8 if m <= 256 else np.int64), (int(stay.sum()), 1))
            rows, k = np.arange(len(perm)), k[stay]
            perm[rows, 0], perm[rows, k] = perm[rows, k].copy(), 0
        else:
            perm = perm[stay]
        values, owner = values[stay], owner[stay]
    return sig.reshape(-1, m)


def _chunks(column: pa.Array, size: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, ends) for runs of texts of about ``size`` bytes."""
    column = column.cast(pa.large_binary())
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] else np.zeros(0, np.uint8)
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(ends, ends[a] + size, side="right")) - 1)
        yield a, b, data[ends[a] : ends[b]], ends[a : b + 1] - ends[a]
        a = b


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n_shingles, set_a and set_b (a 128-bit hash of the set) and bands (array<long>, empty for an empty set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, ends in _chunks(batch.column(1)):
                sets = shingles(data, ends, words)
                size = np.array([len(s) for s in sets])
                full = np.flatnonzero(size)
                sig = superminhash([sets[i] for i in full])
                key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (len(full), BANDS)).copy()
                for part in range(PLACES // BANDS):
                    key = mixed(key * np.uint64(0xC2B2AE3D27D4EB4F) + sig[:, part :: PLACES // BANDS])
                bands: list = [[] for _ in sets]
                for i, row in zip(full.tolist(), key.view(np.int64), strict=True):
                    bands[i] = row
                whole = [[int((mixed(s + np.uint64(c))).sum(dtype=np.uint64).view(np.int64)) for s in sets] for c in (1, 0x5851F42D4C957F2D)]
                columns = [batch.column(0).slice(a, b - a), pa.array(size, pa.int64()), *(pa.array(w, pa.int64()) for w in whole), pa.array(bands, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_shingles", "set_a", "set_b", "bands"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>")


def full_sets(docs: DataFrame, words: int) -> DataFrame:
    """node and ``items``: the sorted hashes of its shingles, 8 bytes each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, ends in _chunks(batch.column(1)):
                items = [s.tobytes() for s in shingles(data, ends, words)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(items, pa.binary())], names=["node", "items"])

    return docs.select("doc_id", "text").mapInArrow(run, "node long, items binary")


def _with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (a, b) with both sets, of_a and of_b."""
    with_b = pairs.hint("merge").join(sets.select(F.col("node").alias("b"), F.col("items").alias("of_b")), "b")
    return with_b.hint("merge").join(sets.select(F.col("node").alias("a"), F.col("items").alias("of_a")), "a").select("a", "b", "of_a", "of_b")


def differences(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """For pairs (a, b): the sizes n_a and n_b, and ``items`` that one has and the other lacks (odd: a has it), ``size`` of them.

    An item is a hash but for its first bit; two hashes that differ in that alone could only make a pair be compared.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = np.uint64(1)
        for batch in batches:
            rows = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                u, v = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                d = np.concatenate([np.setdiff1d(u, v, True) << one | one, np.setdiff1d(v, u, True) << one])
                rows.append((len(u), len(v), len(d), d.astype(np.int64)))
            n_a, n_b, size, items = zip(*rows, strict=True) if rows else ((),) * 4
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, pa.int64()) for c in (n_a, n_b, size)), pa.array(items, pa.list_(pa.int64()))], names=["a", "b", "n_a", "n_b", "size", "items"])

    return _with_sets(pairs, sets).mapInArrow(run, "a long, b long, n_a long, n_b long, size long, items array<long>")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (a, b) with ``shared`` and ``either``, the sizes of their sets' intersection and union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, kept = None, None
        for batch in batches:
            shared, either = [], []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                if (packed := x.as_py()) != last:
                    last, kept = packed, np.frombuffer(packed, np.uint64)
                other = np.frombuffer(y.as_py(), np.uint64)
                both = np.concatenate([kept, other])
                both.sort()
                s = int((both[1:] == both[:-1]).sum())
                shared.append(s)
                either.append(len(both) - s)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(shared, pa.int64()), pa.array(either, pa.int64())], names=["a", "b", "shared", "either"])

    return _with_sets(pairs, sets).mapInArrow(run, "a long, b long, shared long, either long")


def components(edges: DataFrame) -> DataFrame:
    """node and ``component``, the least node that it is connected with, for all nodes of ``edges`` (a, b).

    Each round every node takes the least label of its neighbours and then its label's label; rounds end when no label
    changes. Only that count comes to the driver.
    """
    with temporary(edges.sparkSession):
        both = written(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct())
        labels = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select("node", F.least("node", "least").alias("component")))
        while True:
            near = both.join(labels.select(F.col("node").alias("b"), "component"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
            step = labels.join(near, "node").select("node", F.col("component").alias("was"), F.least("component", "near").alias("mid"))
            step = written(step)
            jump = step.select(F.col("node").alias("mid"), F.col("mid").alias("far"))
            new = written(step.join(jump, "mid", "left").select("node", F.least("mid", F.coalesce("far", "mid")).alias("component"), "was"))
            labels = new.select("node", "component")
            if not new.where("component <> was").limit(1).count():
                return written(labels, outer=True)


def open_pairs(compared: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) still to compare: members of one star in different components that can be linked.

    A star is a centre with all that was compared with it. Take two members as their differences from the centre. If
    they share none, they are no more alike than the one that isn't linked to the centre is to it. To be linked they
    must share so many differences that, with rare ones first, their first few have one in common (prefix filter). Only
    differences that members of two components have count as shared.
    """
    t = percent / 100
    label = lambda c: labels.select(F.col("node").alias(c), F.col("component").alias(f"{c}_c"))
    # Merge joins by ``a``: Spark splits the partition of a star that is much larger than others.
    stars = compared.select("a", "b").join(label("a").hint("merge"), "a", "left").join(label("b").hint("merge"), "b", "left")
    stars = written(stars.withColumns({"a_c": F.coalesce("a_c", "a"), "b_c": F.coalesce("b_c", "b")}))
    moving = written(stars.where("a_c <> b_c").select("a").distinct())
    stars = written(stars.join(moving.hint("merge"), "a", "left_semi"))
    own = written(differences(stars.select("a", "b"), sets)).join(stars, ["a", "b"])
    slack = (1 - t) / t
    far = F.col("size") - slack * F.col("n_b")  # what it shares at least with any partner
    with_far = (F.col("size") + (1 - t) * F.col("n_a") - slack * F.col("n_b")) / 2  # ... with one that isn't linked to the centre
    at_least = F.greatest(F.lit(1.0), F.ceil(F.when(F.col("a_c") == F.col("b_c"), F.greatest(far, with_far)).otherwise(far) - 1e-6))
    own = own.withColumn("first", F.col("size") - at_least + 1).select("a", "b", "b_c", "n_b", "size", "first", (F.col("a_c") == F.col("b_c")).alias("near"), F.explode("items").alias("item"))
    own = written(own)
    # Items of one component only aren't shared by any pair that is sought; a cluster alike in itself has no others, whatever its size.
    common = written(own.groupBy("a", "item").agg(F.count("*").alias("f"), F.min("b_c").alias("least"), F.max("b_c").alias("most")).where("least < most").drop("least", "most"))
    held = own.join(common.hint("merge"), ["a", "item"])
    by_member = Window.partitionBy("a", "b")
    held = held.withColumn("rank", F.row_number().over(by_member.orderBy("f", "item"))).withColumn("alone", F.col("size") - F.count("*").over(by_member))
    held = written(held.where(F.col("rank") + F.col("alone") <= F.col("first")).select("a", "item", "b", "b_c", "n_b", "near", "size", (F.col("size") - F.col("alone")).alias("shared")))
    x, y = (held.select("a", "item", *[F.col(c).alias(f"{p}_{c}") for c in ("b", "b_c", "n_b", "near", "size", "shared")]) for p in ("x", "y"))
    fit = (F.col("x_b") < F.col("y_b")) & (F.col("x_b_c") != F.col("y_b_c")) & ~(F.col("x_near") & F.col("y_near")) & (100 * F.least("x_n_b", "y_n_b") >= percent * F.greatest("x_n_b", "y_n_b"))
    # Twice the differences that both must share, against those that either shares with any other member.
    fit &= F.col("x_size") + F.col("y_size") - slack * F.least("x_n_b", "y_n_b") <= 2 * F.least("x_shared", "y_shared") + 1e-6
    return x.join(y, ["a", "item"]).where(fit).select(F.col("x_b").alias("a"), F.col("y_b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept; linked are sets with 100 * intersection >= percent * union.

    ``words`` is the shingles' length. ``component_id`` is the least doc_id that a document is connected with.
    """
    d = id_and_text(docs)
    sig = written(signatures(d, words))
    with temporary(docs.sparkSession):
        classes = written(sig.where("n_shingles > 0 and doc_id is not null").groupBy("set_a", "set_b").agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")))
        banded = classes.select("node", "n", F.explode("bands").alias("bucket"))
        shared = written(banded.join(written(banded.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")), "bucket"))
        popular = shared.groupBy("node").agg(F.sum("members").alias("popular"))
        centres = written(shared.join(popular, "node").groupBy("bucket").agg(F.max(F.struct("popular", (-F.col("node")).alias("low"))).alias("c")).select("bucket", (-F.col("c.low")).alias("a")))
        pairs = written(shared.join(centres, "bucket").select("a", F.col("node").alias("b")).where("a <> b").distinct())
        needed = pairs.select(F.col("a").alias("doc_id")).union(pairs.select(F.col("b").alias("doc_id"))).distinct()
        sets = written(full_sets(d.join(needed.hint("merge"), "doc_id", "left_semi"), words).dropDuplicates(["node"]))
        compared = written(verified(pairs, sets))
        linked = f"100 * shared >= {percent} * either"
        edges = compared.where(linked).select("a", "b")
        labels = components(edges)
        rest = written(open_pairs(compared, labels, sets, percent))
        more = written(verified(rest, sets).where(linked).select("a", "b"))
        if more.limit(1).count():
            labels = components(edges.union(more))
        found = written(classes.join(labels, "node", "left").select("set_a", "set_b", F.coalesce("component", "node").alias("component_id")), outer=True)
    out = sig.join(found, ["set_a", "set_b"], "left").withColumn("component_id", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, with all their columns, that stand for their group; of rows equal in doc_id and text one."""
    kept = near_duplicates(docs, words, percent).where("kept").select(F.col("doc_id").alias("__id")).distinct()
    rows = docs.join(kept.hint("merge"), docs["doc_id"].cast("long").eqNullSafe(kept["__id"]), "left_semi")
    return rows.dropDuplicates(["doc_id", "text"])


def op7_minhash(docs: DataFrame) -> DataFrame:
    """The contract's columns: shingles of three words, linked at 0.85."""
    return near_duplicates(docs, words=3, percent=85)
