"""Quality classifier: a generalised additive model with pairwise interactions.

Every feature is cut into bins at quantiles of the training rows. Cyclic boosting visits the features in turn and adds
to the visited one's lookup table a shallow tree fitted to the current residuals; then the pairs of features that
reduce the residuals most get tables over both features' bins. A score is the sum of the tables' entries at a
document's bins, looked up for a whole batch at once.

The model is fitted on the driver to at most ``TRAINING_ROWS`` labelled documents, the first by a hash of doc_id, none
of them held out. Features come from the whole text only; labels, lang, source and doc_id are no inputs.

Defined cases: a null or empty text gets the score of all-zero features; where no labelled row exists, every score is
0.5; equal rows are scored alike; of several texts with one labelled doc_id the model learns from that of the least
features; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import id_and_text

TRAINING_ROWS = 12_000
BINS, ROUNDS, RATE, SPLITS, PAIRS, PAIR_ROUNDS = 24, 120, 0.15, 3, 6, 40
FOLDS, CUTOFF = 5, 0.3

_UPPER, _LOWER, _DIGIT = re.compile(r"[A-ZÀ-ÖØ-Þ]+"), re.compile(r"[a-zß-öø-ÿ]+"), re.compile(r"[0-9]+")
_SIGN, _MARK = re.compile(r"[#*$%&|<>]"), re.compile(r"[.,;:!?]")
NAMES = ("log_words", "word_length", "longest_word", "signs", "marks", "exclamations", "upper", "lower", "digits", "same_lines", "line_words", "repeats", "distinct", "top_word", "top_three", "short_words", "shouted", "ends")


def features(text: str) -> list[float]:
    """The measurements named in ``NAMES``, from the whole text."""
    words = text.split()
    n, size = len(words), max(len(text), 1)
    if not n:
        return [0.0] * len(NAMES)
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    threes = Counter(zip(words, words[1:], words[2:], strict=False))
    top = counts.most_common(3)
    lengths = list(map(len, words))
    part = lambda p: sum(map(len, p.findall(text))) / size
    return [
        np.log1p(n),
        sum(lengths) / n,
        float(max(lengths)),
        len(_SIGN.findall(text)) / n,
        len(_MARK.findall(text)) / n,
        text.count("!") / n,
        part(_UPPER),
        part(_LOWER),
        part(_DIGIT),
        1 - len(set(lines)) / max(len(lines), 1),
        n / max(len(lines), 1),
        1 - len(threes) / max(n - 2, 1) if n > 2 else 0.0,
        len(counts) / n,
        top[0][1] / n,
        sum(c for _, c in top) / n,
        sum(x <= 3 for x in lengths) / n,
        sum(w.isupper() for w in counts) / len(counts),
        sum(x[-1:] in ".!?" for x in lines) / max(len(lines), 1),
    ]


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and ``x`` (array<double>) for each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [features(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.list_(pa.float64()))], names=["doc_id", "x"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, x array<double>")


@dataclass
class Model:
    edges: list[np.ndarray]
    bias: float
    tables: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]]

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(self.edges)], axis=1)

    def margin(self, b: np.ndarray) -> np.ndarray:
        out = np.full(len(b), self.bias)
        for k, t in enumerate(self.tables):
            out += t[b[:, k]]
        for i, j, t in self.pairs:
            out += t[b[:, i], b[:, j]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(self.bins(x)), -30, 30)))


def _tree(bins: np.ndarray, grad: np.ndarray, hess: np.ndarray, n: int) -> np.ndarray:
    """A table of ``n`` values from at most ``SPLITS`` greedy splits of the bins' order: Newton steps of its leaves."""
    g, h = np.bincount(bins, grad, n), np.bincount(bins, hess, n)
    leaves = [(0, n)]
    gain_of = lambda a, b: a * a / (b + 1.0)
    for _ in range(SPLITS):
        best = (1e-6, None, None)
        for a, b in leaves:
            if b - a < 2:
                continue
            gl, hl = np.cumsum(g[a:b])[:-1], np.cumsum(h[a:b])[:-1]
            gs, hs = g[a:b].sum(), h[a:b].sum()
            gains = gain_of(gl, hl) + gain_of(gs - gl, hs - hl) - gain_of(gs, hs)
            k = int(gains.argmax())
            if gains[k] > best[0]:
                best = (gains[k], (a, b), a + k + 1)
        if best[1] is None:
            break
        leaves.remove(best[1])
        leaves += [(best[1][0], best[2]), (best[2], best[1][1])]
    out = np.zeros(n)
    for a, b in leaves:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + 1.0)
    return out


def _pair_table(bi: np.ndarray, bj: np.ndarray, grad: np.ndarray, hess: np.ndarray, n: int, m: int) -> tuple[np.ndarray, float]:
    """A depth-two tree over two features: one cut of the first, then one of the second on either side. The table and its gain."""
    g, h = np.zeros((n, m)), np.zeros((n, m))
    np.add.at(g, (bi, bj), grad)
    np.add.at(h, (bi, bj), hess)
    gain_of = lambda a, b: a * a / (b + 1.0)
    cg, ch = np.cumsum(np.cumsum(g, 0), 1), np.cumsum(np.cumsum(h, 0), 1)
    best, table = 0.0, np.zeros((n, m))
    for a in range(n - 1):
        parts, total = [], 0.0
        for lo, hi in ((None, a), (a, n - 1)):
            rg = cg[hi] - (cg[lo] if lo is not None else 0)
            rh = ch[hi] - (ch[lo] if lo is not None else 0)
            gains = gain_of(rg, rh) + gain_of(rg[-1] - rg, rh[-1] - rh)
            k = int(gains[:-1].argmax()) if m > 1 else 0
            total += gains[k]
            parts.append(((lo + 1 if lo is not None else 0), hi + 1, k + 1, rg[k] / (rh[k] + 1.0), (rg[-1] - rg[k]) / (rh[-1] - rh[k] + 1.0)))
        if total > best:
            best, table = total, np.zeros((n, m))
            for lo, hi, k, u, v in parts:
                table[lo:hi, :k], table[lo:hi, k:] = u, v
    return table, best


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Cyclic boosting of the features' tables, then of the tables of the strongest pairs."""
    k = len(NAMES)
    if not len(y):
        return Model([np.zeros(0)] * k, 0.0, [np.zeros(1)] * k, [])
    edges = [np.unique(np.quantile(x[:, i], np.linspace(0, 1, BINS + 1)[1:-1])) for i in range(k)]
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model = Model(edges, float(np.log(mean / (1 - mean))), [np.zeros(len(e) + 1) for e in edges], [])
    b = model.bins(x)
    f = np.full(len(y), model.bias)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-f))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for i in range(k):
            step = RATE * _tree(b[:, i], *slopes(), len(model.tables[i]))
            model.tables[i] += step
            f += step[b[:, i]]
    grad, hess = slopes()
    size = [len(t) for t in model.tables]
    ranked = sorted(((_pair_table(b[:, i], b[:, j], grad, hess, size[i], size[j])[1], i, j) for i in range(k) for j in range(i + 1, k)), reverse=True)[:PAIRS]
    tables = {(i, j): np.zeros((size[i], size[j])) for _, i, j in ranked}
    for _ in range(PAIR_ROUNDS):
        for (i, j), t in tables.items():
            step = RATE * _pair_table(b[:, i], b[:, j], *slopes(), size[i], size[j])[0]
            t += step
            f += step[b[:, i], b[:, j]]
    model.pairs = [(i, j, t) for (i, j), t in tables.items()]
    return model


def held_out(doc_id: str = "doc_id"):
    """Whether crc32 of the id as text leaves no remainder by ``FOLDS``; a null id is not held out."""
    return F.coalesce(F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8")) % FOLDS == 0, F.lit(False))


def fitted(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> Model:
    """A model of ``quality`` from at most ``rows`` labelled documents that are not held out."""
    chosen = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where("doc_id is not null and quality is not null").where(~held_out())
    chosen = chosen.groupBy("doc_id").agg(F.max("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    labelled = {r["doc_id"]: r["quality"] for r in chosen.collect()}  # bounded by ``rows``
    some = id_and_text(docs).join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_semi")  # as bounded
    found = {r["doc_id"]: r["x"] for r in measured(some).groupBy("doc_id").agg(F.min("x").alias("x")).collect()}
    ids = sorted(found)
    return fit(np.array([found[i] for i in ids]).reshape(-1, len(NAMES)), np.array([labelled[i] for i in ids], float))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and ``score`` for each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([features(t) for t in b.column(1).to_pylist()]).reshape(-1, len(NAMES))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(x))], names=["doc_id", "score"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, score double")


def op8_quality_gam(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's columns."""
    d = scored(docs, fitted(docs, labels))
    return d.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= CUTOFF).cast("int").alias("predicted"))
