"""Nearest neighbours by multi-index hashing of learned binary codes.

A sample of the vectors gives principal directions and rotations that bring them close to the corners of a cube
(iterative quantisation); a vector's code is the signs of its rotated coordinates. Vectors are dealt to blocks; a block
cuts its codes into 16-bit substrings and keeps a direct-address table for each. A query probes all substring values
within r bits of its own: by the pigeonhole principle this finds every code within Hamming radius m(r + 1) - 1 of m
substrings. What is new is held against the code's radius, then ranked by exact distances. r grows until the radius
covers the place where a neighbour nearer than the k-th found could lie; how far codes of a distance are apart is
measured on the sample (a quantile, so recall is below 1 by that much only). Queries pass through the blocks in
batches, so a block is the most that a task holds.

Defined cases: vectors that are null, zero, or hold null or non-finite components, those of a length other than the
table's most frequent one (of equally frequent ones the greatest), and rows with a null ``vec_id`` take no part;
repeated rows count once; a vec_id with several vectors is as near as its nearest one, and asks with its least one;
ties go to the smaller vec_id; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows that the codes are learned from, the least by a hash of the id.
SAMPLE = 4096
#: Bits of a code and of a substring.
BITS, SUB = 128, 16
#: Part of the pairs of a distance whose codes are within the radius for it.
COVERED = 0.985
#: Rows of a block: at least and at most; in between there is a block for each shuffle partition.
SMALLEST, LARGEST = 1_024, 131_072


@dataclass
class Model:
    mean: np.ndarray
    planes: np.ndarray
    #: Radius of codes by distance: for pairs up to ``reach[i]`` apart, ``radius[i]`` bits.
    reach: np.ndarray
    radius: np.ndarray

    def codes(self, x: np.ndarray) -> np.ndarray:
        """A row of 16-bit substrings for each vector."""
        parts = [np.packbits((x[k : k + 16_384] - self.mean) @ self.planes > 0, axis=1) for k in range(0, len(x), 16_384)]
        return np.concatenate(parts).view(np.uint16)

    def radius_of(self, distance: float) -> int:
        i = int(np.searchsorted(self.reach, distance))
        return int(self.radius[i]) if i < len(self.radius) else BITS


_ONES = np.array([bin(v).count("1") for v in range(1 << 8)], np.uint8)


def hamming(codes: np.ndarray, code: np.ndarray) -> np.ndarray:
    return _ONES[(codes ^ code).view(np.uint8)].sum(axis=-1, dtype=np.int32)


def distances(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Euclidean, in double precision."""
    gap = x.astype(np.float64) - q
    return np.sqrt(np.einsum("ij,ij->i", gap, gap))


def fit(sample: np.ndarray, rounds: int = 30, seed: int = 7) -> Model:
    """Codes and radii from a sample (rows of doubles)."""
    r = np.random.default_rng(seed)
    mean = sample.mean(axis=0)
    x = sample - mean
    _, _, axes = np.linalg.svd(x, full_matrices=False)
    axes = axes[:64].T
    v, width = x @ axes, axes.shape[1]
    planes = []
    while sum(p.shape[1] for p in planes) < BITS:
        turn = np.linalg.qr(r.normal(size=(width, width)))[0]
        for _ in range(rounds):
            a, _, b = np.linalg.svd(v.T @ np.where(v @ turn > 0, 1.0, -1.0))
            turn = a @ b
        planes.append(axes @ turn)
    m = Model(mean, np.concatenate(planes, axis=1)[:, :BITS], np.zeros(0), np.zeros(0))
    codes = m.codes(sample)
    apart, bits = [], []
    for i in range(min(len(sample), 1024)):
        d, h = distances(sample, sample[i]), hamming(codes, codes[i])
        near = np.argsort(d, kind="stable")[1:25]
        chosen = np.concatenate([near, r.integers(0, len(sample), 24)])
        apart.append(d[chosen])
        bits.append(h[chosen])
    d, h = np.concatenate(apart), np.concatenate(bits)
    parts = [p for p in np.array_split(np.argsort(d, kind="stable"), 48) if len(p) >= 100]
    if parts:
        m.reach = np.array([d[p].max() for p in parts])
        m.radius = np.maximum.accumulate([int(np.ceil(np.quantile(h[p], COVERED))) for p in parts])
    return m


@lru_cache(1)
def _masks() -> list[np.ndarray]:
    """The 16-bit values by their number of ones."""
    return [np.array([sum(1 << i for i in c) for c in combinations(range(SUB), w)], np.uint16) for w in range(SUB + 1)]


class Block:
    """The vectors of one block with a table of places for each substring."""

    def __init__(self, model: Model, ids: np.ndarray, vectors: np.ndarray, k: int):
        rows = np.ascontiguousarray(np.concatenate([ids[:, None].astype(">i8").view(np.uint8), vectors.view(np.uint8).reshape(len(ids), -1)], axis=1))
        once = np.unique(rows.view(f"V{rows.shape[1]}").ravel(), return_index=True)[1]
        ids, vectors = ids[once], vectors[once]
        # Of equal vectors only the k + 1 of the least ids can be among k results (one may be the query's own).
        same = np.unique(np.ascontiguousarray(vectors).view(np.uint8).reshape(len(ids), -1).view(f"V{vectors.shape[1] * vectors.itemsize}").ravel(), return_inverse=True)[1]
        order = np.lexsort((ids, same))
        first = np.flatnonzero(np.diff(same[order], prepend=-1))
        place = np.arange(len(ids)) - np.repeat(first, np.diff(first, append=len(ids)))
        keep = np.sort(order[place <= k])
        self.model, self.k, self.ids, self.vectors = model, k, ids[keep], vectors[keep]
        self.codes = model.codes(self.vectors)
        self.places = [np.argsort(c, kind="stable").astype(np.int32) for c in self.codes.T]
        self.starts = [np.concatenate([[0], np.cumsum(np.bincount(c, minlength=1 << SUB))]).astype(np.int32) for c in self.codes.T]

    def reached(self, code: np.ndarray, limit: Callable[[], int]) -> Iterator[np.ndarray]:
        """Places of the codes within ``limit()`` bits of ``code``, each once, in steps; the limit may shrink from step to step."""
        m = self.codes.shape[1]
        seen = np.zeros(len(self.ids), bool)
        for r in range(SUB + 1):
            most = limit()
            if m * r - 1 >= most:
                return
            hit = np.zeros(len(self.ids), bool)
            # Of codes within the limit, the first (limit mod m) + 1 substrings may need limit // m bits, the others one less.
            for j in range(m if r < most // m else most % m + 1):
                at = code[j] ^ _masks()[r]
                first, size = self.starts[j][at], self.starts[j][at.astype(np.int32) + 1] - self.starts[j][at]
                first, size = first[size > 0], size[size > 0]
                ends = np.cumsum(size)
                if len(ends):
                    hit[self.places[j][np.repeat(first - ends + size, size) + np.arange(ends[-1])]] = True
            hit &= ~seen
            seen |= hit
            found = np.flatnonzero(hit)
            yield found[hamming(self.codes[found], code) <= most]

    def search(self, own: int, query: np.ndarray, bound: float) -> tuple[np.ndarray, np.ndarray]:
        """ids and distances of the k nearest but ``own``; ``bound`` is no less than the k-th distance over all blocks.

        Until k are found the radius is unbounded, so a block gives k wherever it has them.
        """
        near, far = np.zeros(0, np.int64), np.zeros(0)
        q = query.astype(np.float64)
        for found in self.reached(self.model.codes(query[None])[0], lambda: self.model.radius_of(min([bound, *far[-1:]])) if len(far) == self.k else BITS):
            found = found[self.ids[found] != own]
            for k in range(0, len(found), 8192):  # bounds the memory of exact distances
                part = found[k : k + 8192]
                near, far = np.concatenate([near, self.ids[part]]), np.concatenate([far, distances(self.vectors[part], q)])
                order = np.lexsort((near, far))
                order = order[np.sort(np.unique(near[order], return_index=True)[1])][: self.k]
                near, far = near[order], far[order]
        return near, far


def valid(rows: DataFrame) -> DataFrame:
    """vec_id, v (array<float> or array<double>) of the rows that take part, whatever their length."""
    kind = "array<float>" if rows.schema["embedding"].dataType.simpleString() == "array<float>" else "array<double>"
    d = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("v")).where("vec_id is not null and v is not null")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return d.where(F.coalesce(finite, F.lit(False))).where(F.exists("v", lambda x: x != 0))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def search(rows: DataFrame, queries: DataFrame, k: int = 10, partitions: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows of each query but those of its own id; both have vec_id and embedding."""
    spark = rows.sparkSession
    base, asked = valid(rows), valid(queries)
    length = base.groupBy(F.size("v").alias("len")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("len")).first()
    if length is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    base, asked = base.where(F.size("v") == length["len"]), asked.where(F.size("v") == length["len"])
    of_queries = asked.groupBy(F.col("vec_id")).agg(F.min("v").alias("v"))
    place = F.xxhash64("vec_id")
    least = -(1 << 63) + min((1 << 64) - 1, (2 * SAMPLE << 64) // length["n"])  # twice the sample's rows, so that few are ordered
    sample = base.where(place <= least).orderBy(place, "v").limit(SAMPLE).toArrow().combine_chunks()
    sample_ids, sample_rows = sample["vec_id"].to_numpy(), _matrix(sample["v"].combine_chunks()).astype(np.float64)
    model = fit(sample_rows)
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(-(-length["n"] // LARGEST), min(parts, -(-length["n"] // SMALLEST)))

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The k-th distance in the sample: no less than that among all rows."""
        for b in batches:
            out = []
            for own, q in zip(b.column(0).to_numpy(), _matrix(b.column(1)), strict=True):
                d, i = (x[sample_ids != own] for x in (distances(sample_rows, q), sample_ids))
                _, first = np.unique(i[(o := np.argsort(d, kind="stable"))], return_index=True)
                d = np.sort(d[o][first])
                out.append(d[k - 1] if len(d) >= k else np.inf)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.float64())], names=["vec_id", "v", "bound"])

    kind = dict(base.dtypes)["v"]
    of_queries = of_queries.mapInArrow(bounds, f"vec_id long, v {kind}, bound double")
    everywhere = of_queries.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "bound", "vec_id", "v")
    indexed = base.select(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"), F.lit(None).cast("double").alias("bound"), "vec_id", "v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each block its rows (no bound), then its queries."""
        number, held, block = None, [], None
        for b in batches:
            of = b.column(0).to_numpy()
            asks = np.asarray(b.column(1).is_valid())
            cuts = np.flatnonzero((np.diff(of) != 0) | (asks[1:] != asks[:-1])) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(of)], strict=True):
                if of[lo] != number:
                    number, held, block = of[lo], [], None
                ids, vectors = b.column(2).slice(lo, hi - lo).to_numpy(), _matrix(b.column(3).slice(lo, hi - lo))
                if not asks[lo]:
                    held.append((ids, vectors.copy()))
                    continue
                if block is None:
                    if not held:
                        continue
                    block, held = Block(model, np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]), k), []
                found = [(own, *block.search(own, q, bound)) for own, q, bound in zip(ids, vectors, b.column(1).slice(lo, hi - lo).to_numpy(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat([f[0] for f in found], [len(f[1]) for f in found]).astype(np.int64)), pa.array(np.concatenate([f[1] for f in found])), pa.array(np.concatenate([f[2] for f in found]))], names=["query_id", "vec_id", "score"])

    tasks = min(blocks, parts)
    ordered = indexed.union(everywhere).repartitionById(tasks, F.col("block") % tasks).sortWithinPartitions("block", F.col("bound").isNotNull())
    found = ordered.mapInArrow(run, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op11_hamming_index(embeddings: DataFrame) -> DataFrame:
    """The contract's columns: each vec_id divisible by 100 asks for its 10 nearest."""
    return search(embeddings, embeddings.where(F.col("vec_id") % 100 == 0))
