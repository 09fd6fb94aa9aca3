"""Removal of repeated byte strings with suffix arrays.

A byte goes if a string of ``span`` bytes that covers it starts anywhere else too. Only parts of the corpus that can
hold such a string are sorted:

1. Of the ``span - GRAM + 1`` grams of ``GRAM`` bytes in each string of ``span`` bytes, the one of the least hash (the
   rightmost among equals) is its anchor. Neighbouring strings with one anchor make a segment. Equal strings have
   equal anchors, so a segment whose anchor gram is unique in the corpus holds no repeated string and is left out.
2. Equal segments become one, with the number of its places.
3. Segments are dealt to shards by anchor gram, so equal strings meet in one shard. A shard's segments are sorted in
   runs of bounded size: a suffix array by Larsson-Sadakane refinement (each round sorts only unresolved groups, by the
   rank that many bytes further on), common prefixes of neighbours by Kasai's rule, all segments stepping together.
4. A gram with very many different segments is dealt out to several shards. These also give each of their strings'
   fingerprints in sorted runs; the runs are merged by range and strings of several shards found by binary search.
5. What is covered goes back to the segments' places and is cut from the texts.

Removal takes strings of ``span`` bytes only. ``shared_places`` tells of shorter passages that documents share, by the
same anchors with other widths: each passage of ``WINDOW`` bytes that two documents have in common has a place there.

Defined cases: a null text is empty; texts shorter than ``span`` bytes keep all; an equal second row makes a long text
repeat itself, so both rows lose it; other columns, whatever their names, are kept by ``without_repeats`` and ignored
by ``op3_suffix_dedup``; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import temporary, written
from tidemark.llm.minhash import _chunks, _Powers, mixed

SPAN, GRAM = 400, 48
#: Of shared passages: bytes of a window and of a gram. A gram is longer than the common lines of a page.
WINDOW, WINDOW_GRAM = 250, 100
#: Bytes of segments that are sorted together. A gram is dealt out beyond ``HOT`` different segments, or beyond twice
#: a partition's even share of them where that is less (``COOL`` at least).
RUN_BYTES, HOT, COOL = 1_500_000, 2_000, 200
#: Bytes of text whose anchors are found together.
TEXT_BYTES = 1_000_000
#: No byte of UTF-8; ends each segment.
END = 0xFF
_VALUES = np.random.default_rng(11).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)


def _prefix_sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums s and factors f: (s[j] - s[i]) * f[i] is a hash of data[i:j], the same at every place."""
    up, down = _Powers.upto(len(data) + 1)
    s = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUES[data] * up[: len(data)], dtype=np.uint64, out=s[1:])
    return s, down


def _chosen(s: np.ndarray, f: np.ndarray, ends: np.ndarray, span: int, gram: int) -> tuple[np.ndarray, ...]:
    """The text of each string of ``span`` bytes, whether it is whole, its anchor's place, and the hashes of all grams."""
    n, width = len(s) - 1, span - gram + 1
    grams = mixed((s[gram:] - s[:-gram]) * f[: n - gram + 1])
    bits = np.uint64(max(1, int(n).bit_length()))
    mask = (np.uint64(1) << bits) - np.uint64(1)
    keys = (grams >> bits << bits) | (mask - np.arange(len(grams), dtype=np.uint64))
    rows = -(-len(keys) // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(keys)] = keys
    grid = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(grid, axis=1).ravel()
    least = np.minimum(ahead[: n - span + 1], behind[width - 1 : width - 1 + n - span + 1])
    owner = np.repeat(np.arange(len(ends) - 1), np.diff(ends))[: n - span + 1]
    whole = np.arange(n - span + 1) + span <= ends[owner + 1]
    return owner, whole, (mask - (least & mask)).astype(np.int64), grams


def anchors(data: np.ndarray, ends: np.ndarray, span: int = SPAN) -> tuple[np.ndarray, ...]:
    """text, first start, number of starts, gram hash and segment hash of each segment of the texts in ``data``."""
    none = np.zeros(0, np.int64)
    if len(data) < span:
        return none, none, none, none, none
    s, f = _prefix_sums(data)
    owner, whole, chosen, grams = _chosen(s, f, ends, span, GRAM)
    new = whole.copy()
    new[1:] &= ~whole[:-1] | (chosen[1:] != chosen[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    if not len(first):
        return none, none, none, none, none
    count = np.add.reduceat(whole, first).astype(np.int64)
    until = first + count - 1 + span
    segment = mixed(((s[until] - s[first]) * f[first]) ^ mixed(count.astype(np.uint64)))
    text = owner[first]
    return text, first - ends[text], count, grams[chosen[first]].view(np.int64), segment.view(np.int64)


def window_grams(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """text and gram hash of the anchors of all windows of ``WINDOW`` bytes, each gram once a text."""
    if len(data) < WINDOW:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    s, f = _prefix_sums(data)
    owner, whole, chosen, grams = _chosen(s, f, ends, WINDOW, WINDOW_GRAM)
    chosen, owner = chosen[whole], owner[whole]
    new = np.ones(len(chosen), bool)
    new[1:] = chosen[1:] != chosen[:-1]
    text, found = owner[new], grams[chosen[new]].view(np.int64)
    order = np.lexsort((found, text))
    text, found = text[order], found[order]
    first = np.ones(len(text), bool)
    first[1:] = (text[1:] != text[:-1]) | (found[1:] != found[:-1])
    return text[first], found[first]


def suffix_array(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The suffix array of ``data``, the ranks, and the first 8 bytes of each suffix as a number (padded with END)."""
    n = len(data)
    padded = np.concatenate([data, np.full(8, END, np.uint8)]).astype(np.uint64)
    heads = np.zeros(n, np.uint64)
    for k in range(8):
        heads = (heads << np.uint64(8)) | padded[k : n + k]
    sa = np.argsort(heads, kind="stable")
    sorted_heads = heads[sa]
    new = np.ones(n, bool)
    new[1:] = sorted_heads[1:] != sorted_heads[:-1]
    start = np.flatnonzero(new)
    group = np.repeat(start, np.diff(np.append(start, n)))  # a group's rank is the place of its first member
    rank = np.empty(n, np.int64)
    rank[sa] = group
    size = np.diff(np.append(start, n))
    open_ = np.flatnonzero(np.repeat(size > 1, size))
    h = 8
    while len(open_):
        at = sa[open_]
        ahead = at + h
        second = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        key = (rank[at] << 32) | second
        order = np.argsort(key, kind="stable")
        key, at = key[order], at[order]
        sa[open_] = at
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        start = np.flatnonzero(new)
        size = np.diff(np.append(start, len(key)))
        rank[at] = np.repeat(open_[start], size)
        open_ = open_[np.repeat(size > 1, size)]
        h *= 2
    return sa, rank, heads


def repeated_starts(data: np.ndarray, first: np.ndarray, count: np.ndarray, span: int = SPAN) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose string of ``span`` bytes is repeated in ``data``, as a mask, and the suffix array.

    Segment i has ``count[i]`` strings, from ``first[i]`` on. By Kasai's rule a position's common prefix with its
    neighbour in the array is at least its left neighbour's less one; it is counted up to ``span``.
    """
    sa, rank, heads = suffix_array(data)
    n = len(data)
    heads = np.concatenate([heads, np.full(span + 16, np.iinfo(np.uint64).max, np.uint64)])
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    marked = np.zeros(n, bool)
    order = np.argsort(-count, kind="stable")
    first, count = first[order], count[order]
    common = np.zeros(len(first), np.int64)
    for t in range(int(count.max(initial=0))):
        lanes = int(np.searchsorted(-count, -t, side="left"))
        p = first[:lanes] + t
        q = before[p]
        l = np.where(q >= 0, np.maximum(common[:lanes] - 1, 0), 0)  # noqa: E741
        live = np.flatnonzero(q >= 0)
        while len(live):
            x = heads[p[live] + l[live]] ^ heads[q[live] + l[live]]
            same = x == 0
            ends = ~same
            l[live[ends]] += sum((x[ends] < np.uint64(1 << b)).astype(np.int64) for b in range(8, 64, 8))
            live = live[same]
            l[live] += 8
            live = live[l[live] < span]
        l = np.minimum(l, span)  # noqa: E741
        common[:lanes] = l
        hit = l >= span
        marked[p[hit]] = True
        marked[q[hit]] = True
    return marked, sa


def _runs_of(mask: np.ndarray, first: np.ndarray, count: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(segment, lo, hi) of the runs of true values in each segment's starts; hi is the last."""
    lane = np.repeat(np.arange(len(first)), count)
    offset = np.arange(len(lane)) - np.repeat(np.cumsum(count) - count, count)
    on = mask[first[lane] + offset]
    begin = on.copy()
    begin[1:] &= ~on[:-1] | (lane[1:] != lane[:-1])
    finish = on.copy()
    finish[:-1] &= ~on[1:] | (lane[1:] != lane[:-1])
    yield from zip(lane[begin].tolist(), offset[begin].tolist(), offset[finish].tolist(), strict=True)


def sorted_run(rows: list[tuple[int, int, int, int, bool, bytes]], span: int = SPAN) -> Iterator[tuple]:
    """For segments (gram, segment, places, starts, hot, bytes): rows (gram, segment, lo, hi, fingerprint).

    Without a fingerprint, the strings from lo to hi are repeated. With one, the string at lo of a dealt-out gram is
    the first of its kind here; hi is -1 if it is known to be repeated and lo otherwise.
    """
    parts = [np.frombuffer(r[5] + bytes([END]), np.uint8) for r in rows]
    data = np.concatenate(parts)
    first = np.cumsum([0, *map(len, parts)])[:-1]
    count = np.array([r[3] for r in rows], np.int64)
    marked, sa = repeated_starts(data, first, count, span)
    for i in np.flatnonzero(np.array([r[2] for r in rows]) > 1).tolist():
        marked[first[i] : first[i] + count[i]] = True
    for i, lo, hi in _runs_of(marked, first, count):
        yield rows[i][0], rows[i][1], lo, hi, None
    hot = [i for i, r in enumerate(rows) if r[4]]
    if hot:
        s, f = _prefix_sums(data)
        for i in hot:
            p = first[i] + np.arange(count[i])
            prints = mixed((s[p + span] - s[p]) * f[p]).view(np.int64)
            for k, v in enumerate(prints.tolist()):
                yield rows[i][0], rows[i][1], k, -1 if marked[p[k]] else k, v


def _sorted_runs(batches: Iterator[pa.RecordBatch], span: int) -> Iterator[pa.RecordBatch]:
    names = ["gram", "segment", "lo", "hi", "print"]
    rows: list[tuple] = []
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        out = list(sorted_run(rows, span))
        for k in range(0, len(out), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out[k : k + 50_000], strict=True)], names=names)

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if size >= RUN_BYTES and (row[4] or row[0] != rows[-1][0]):
                yield from flush()
                rows, size = [], 0
            rows.append(row)
            size += len(row[5])
    if rows:
        yield from flush()


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a run sorted by fingerprint: the strings not known to be repeated whose fingerprint is there again."""
    held: list[np.ndarray] = [np.zeros(0, np.int64)] * 4

    def found(cols: list[np.ndarray]) -> pa.RecordBatch:
        prints = cols[3]
        many = np.searchsorted(prints, prints, side="right") - np.searchsorted(prints, prints, side="left") > 1
        keep = many & (cols[2] >= 0)
        return pa.RecordBatch.from_arrays([pa.array(cols[0][keep]), pa.array(cols[1][keep]), pa.array(cols[2][keep]), pa.array(cols[2][keep])], names=["gram", "segment", "lo", "hi"])

    for batch in batches:
        cols = [np.concatenate([h, c.to_numpy(zero_copy_only=False)]) for h, c in zip(held, batch.columns, strict=True)]
        cut = int(np.searchsorted(cols[3], cols[3][-1], side="left"))
        same = [c[cut:] for c in cols]  # may go on in the next batch
        if len(same[0]) > 3:  # two of one kind stand for all of it
            new = np.flatnonzero(same[2] >= 0)
            yield found(same) if len(new) else found([c[:0] for c in same])
            same = [np.where(np.arange(2) >= 0, c[:2], 0) for c in same]
            same[2] = np.full(2, -1, np.int64)
        yield found([c[:cut] for c in cols])
        held = same
    if len(held[0]):
        yield found(held)


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` as a struct, and key columns: rows with equal keys have equal texts, and so lose the same bytes."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.select(row.alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("__id"), F.xxhash64(text).alias("__hash"), text.alias("__text"))


def repeated_spans(keyed: DataFrame, span: int = SPAN) -> DataFrame:
    """__id, __hash and ``__spans``: byte intervals (lo, hi; hi exclusive, unmerged) to remove, for texts that have any."""

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            for a, b, data, ends in _chunks(batch.column(2), TEXT_BYTES):
                text, start, count, gram, segment = anchors(data, ends, span)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (ids[a:b][text], hashes[a:b][text], start.astype(np.int64), count, gram, segment)], names=["__id", "__hash", "start", "count", "gram", "segment"])

    texts = keyed.select("__id", "__hash", "__text")
    with temporary(keyed.sparkSession):
        places = written(texts.where(F.octet_length("__text") >= span).mapInArrow(segments, "__id long, __hash long, start long, count long, gram long, segment long"))
        twice = written(places.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram"))
        places = written(places.join(twice, "gram"), outer=True)
        kinds = written(places.groupBy("gram", "segment").agg(F.count("*").alias("places"), F.min(F.struct("__id", "__hash", "start", "count")).alias("at")))
        parts = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        most = min(HOT, max(COOL, 2 * kinds.count() // parts))
        hot = written(kinds.groupBy("gram").agg(F.count("*").alias("n")).where(F.col("n") > most).select("gram", F.lit(True).alias("hot")))
        wanted = kinds.join(hot, "gram", "left").select(F.col("at.__id").alias("__id"), F.col("at.__hash").alias("__hash"), F.struct("gram", "segment", "places", F.col("at.count").alias("count"), F.coalesce("hot", F.lit(False)).alias("hot"), F.col("at.start").alias("start")).alias("s"))
        wanted = wanted.groupBy("__id", "__hash").agg(F.collect_list("s").alias("s"))
        cut = F.transform("s", lambda s: F.struct(s["gram"].alias("gram"), s["segment"].alias("segment"), s["places"].alias("places"), s["count"].alias("count"), s["hot"].alias("hot"), F.substring(F.col("__text").cast("binary"), (s["start"] + 1).cast("int"), (s["count"] + (span - 1)).cast("int")).alias("bytes")))
        cuts = texts.join(wanted, ["__id", "__hash"]).select(F.explode(cut).alias("c")).select("c.*")
        dealt = cuts.repartition(parts, F.xxhash64("gram", F.when(F.col("hot"), F.col("segment")))).sortWithinPartitions("hot", "gram", "segment")
        runs = written(dealt.mapInArrow(lambda batches: _sorted_runs(batches, span), "gram long, segment long, lo long, hi long, print long"))
        across = runs.where("print is not null").select("gram", "segment", "hi", F.xxhash64("print", "gram").alias("print")).repartition(parts, "print").sortWithinPartitions("print")
        across = across.mapInArrow(_merged, "gram long, segment long, lo long, hi long")
        covered = runs.where("print is null").select("gram", "segment", "lo", "hi").union(across)
        covered = written(covered.groupBy("gram", "segment").agg(F.collect_list(F.struct("lo", "hi")).alias("runs")), outer=True)
    back = places.join(covered, ["gram", "segment"]).select("__id", "__hash", F.transform("runs", lambda r: F.struct((F.col("start") + r["lo"]).alias("lo"), (F.col("start") + r["hi"] + span).alias("hi"))).alias("runs"))
    return back.groupBy("__id", "__hash").agg(F.flatten(F.collect_list("runs")).alias("__spans"))


def shared_places(keyed: DataFrame) -> DataFrame:
    """__id, __hash and ``n_shared_places``: grams of windows' anchors that another document holds too, where there are any.

    Documents are others if their ids or texts differ. A gram stands once for a text, so only copies repeat it.
    """

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            for a, b, data, ends in _chunks(batch.column(2), TEXT_BYTES):
                text, gram = window_grams(data, ends)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (ids[a:b][text], hashes[a:b][text], gram)], names=["__id", "__hash", "gram"])

    long = keyed.select("__id", "__hash", "__text").where(F.octet_length("__text") >= WINDOW)
    found = written(long.mapInArrow(places, "__id long, __hash long, gram long"))
    key = F.struct("__id", "__hash")
    of_many = found.groupBy("gram").agg(F.min(key).alias("least"), F.max(key).alias("most")).where("least <> most").select("gram")
    return found.join(of_many.hint("merge"), "gram", "left_semi").groupBy("__id", "__hash").agg(F.count("*").alias("n_shared_places"))


def _joined(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Disjoint intervals in order; those that touch become one."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted((s["lo"], s["hi"]) for s in spans or ()):
        if out and lo <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], hi)
        else:
            out.append((lo, hi))
    return out


def _kept(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    return b"".join(text[a:b] for a, b in zip([0, *(hi for _, hi in spans)], [*(lo for lo, _ in spans), len(text)], strict=True))


def without_repeats(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """``docs`` with the repeated bytes cut from ``text``; what a cut leaves of a character goes too."""
    keyed = _keyed(docs)
    marked = keyed.join(repeated_spans(keyed, span), ["__id", "__hash"], "left").select("row", "__spans")
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            given = b.column(0).field(at)
            texts = [_kept(given[i].as_py().encode(), _joined(s)).decode(errors="ignore") if s else None for i, s in enumerate(b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["row", "cut"])

    kept = marked.mapInArrow(run, T.StructType([marked.schema["row"], T.StructField("cut", T.StringType())]))
    return kept.select(*[(F.coalesce("cut", F.col("row")[c]).alias(c) if c == "text" else F.col("row")[c].alias(c)) for c in docs.columns])


def op3_suffix_dedup(docs: DataFrame) -> DataFrame:
    """The contract's columns, and ``n_shared_places`` of passages too short to be removed (``shared_places``)."""
    keyed = _keyed(docs.select("doc_id", "text"))
    marked = keyed.join(repeated_spans(keyed), ["__id", "__hash"], "left").join(shared_places(keyed), ["__id", "__hash"], "left")
    marked = marked.select(F.col("row.doc_id").cast("long").alias("doc_id"), F.coalesce("n_shared_places", F.lit(0)).alias("n_shared_places"), "__text", "__spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text, spans in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                data, gone = text.encode(), _joined(spans)
                rows.append((len(data), sum(hi - lo for lo, hi in gone), len(gone), hashlib.sha256(_kept(data, gone)).hexdigest()))
            n, removed, spans_, sha = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x, pa.int64()) for x in (n, removed, spans_)), pa.array(sha, pa.string()), b.column(1)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_shared_places"])

    return marked.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_shared_places long")
