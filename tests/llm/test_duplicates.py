"""Near-duplicates and repeated passages against brute force, and the pipeline."""

import hashlib
import os
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from tidemark.llm import common, minhash, suffix_dedup

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def shingle_set(text, n):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in SPACE.split(low) if x]
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def plain_components(rows, n, percent):
    sets = [(d, shingle_set(t, n)) for d, t in rows]
    parent = {d: d for d, _ in rows}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                u, v = sorted((top(a), top(b)))
                parent[v] = u
    return {d: (len(s), top(d)) for d, s in sets}


def edited(text, share, seed):
    r = random.Random(seed)
    return " ".join("zz" + str(r.randint(0, 10**9)) if r.random() < share else w for w in text.split())


@pytest.mark.parametrize(("n", "percent"), [(3, 85), (5, 80)])
def test_components(frame, words, n, percent):
    base = [words(150, i) for i in range(4)]
    rows = [(i, None) for i in range(2)] + [(2, ""), (3, "A b"), (4, "a B"), (5, "a"), (6, base[0].upper()), (7, base[0])]
    rows += [(100 + 40 * k + i, edited(b, 0.002 * i, i)) for k, b in enumerate(base) for i in range(40)]
    rows += [(900, words(9000, 77)), (901, edited(words(9000, 77), 0.01, 3)), (7, base[0])]
    want = plain_components(list(dict(rows).items()), n, percent)
    for r in minhash.near_duplicates(frame(rows), n, percent).collect():
        assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]]
        assert r["kept"] == (r["doc_id"] == r["component_id"])


def test_sets_are_compared_in_full(spark):
    """Hashes that agree in their low 40 bits alone are different shingles."""
    low = np.arange(1, 101, dtype=np.uint64)
    high = low + np.uint64(1 << 40)
    sets = spark.createDataFrame([(1, low.tobytes()), (2, high.tobytes()), (3, np.concatenate([low[:50], high[:50]]).tobytes())], "node long, items binary")
    pairs = spark.createDataFrame([(1, 2), (1, 3)], "a long, b long")
    assert {(r["b"], r["shared"], r["either"]) for r in minhash.verified(pairs, sets).collect()} == {(2, 0, 200), (3, 50, 150)}
    assert {(r["b"], r["size"], len(set(r["items"]))) for r in minhash.differences(pairs, sets).collect()} == {(2, 200, 200), (3, 100, 100)}


def test_copies_are_removed_at_the_end(spark):
    d = spark.range(5)
    with common.temporary(spark):
        kept = common.written(d)
        with common.temporary(spark):
            outer, inner = common.written(d, outer=True), common.written(d)
            gone = inner.inputFiles()
        assert kept.count() == outer.count() == 5 and gone and not any(os.path.exists(f.removeprefix("file://")) for f in gone)
        files = [x for t in (kept, outer) for x in t.inputFiles()]
    assert files and not any(os.path.exists(f.removeprefix("file://")) for f in files)


def test_signature_is_superminhash():
    """Values equal those of the sequential algorithm with early stopping, and the places that agree estimate similarity."""
    r = np.random.default_rng(5)
    sets = [np.unique(r.integers(0, 2**63, n).astype(np.uint64)) for n in (1, 2, 7, 60, 900)]
    m = 32
    got = minhash.superminhash(sets, m)
    for s, row in zip(sets, got, strict=True):
        h = [1 << 63] * m
        for v in s:
            p = list(range(m))
            for j in range(m):
                x = int(minhash.mixed(np.array([v], np.uint64) + np.uint64((j + 1) * 0x9E3779B97F4A7C15 % 2**64))[0])
                k = j + ((x & 0xFFFFFFFF) * (m - j) >> 32)
                p[j], p[k] = p[k], p[j]
                h[p[j]] = min(h[p[j]], (j << 32) | (x >> 32))
        assert h == row.tolist()
    a = r.integers(0, 2**63, 1000).astype(np.uint64)
    x, y = minhash.superminhash([np.unique(a[:800]), np.unique(a[200:])], 256)
    assert abs((x == y).mean() - 0.6) < 0.12


def test_words_hash_like_words(words):
    texts = [words(50, 1), "", "A b\tC", "a B c", words(3000, 2), "é\n\n\x0bx"]
    out = [s for _, _, data, ends in minhash._chunks(pa.array(texts), 100) for s in minhash.shingles(data, ends, 3)]
    assert [len(s) for s in out] == [len(shingle_set(t, 3)) for t in texts] and out[2].tolist() == out[3].tolist()


def plain_repeats(rows, span=suffix_dedup.SPAN):
    data = [(d, (t or "").encode()) for d, t in rows]
    n = Counter(b[i : i + span] for _, b in data for i in range(len(b) - span + 1))
    for d, b in data:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - span + 1):
            if n[b[i : i + span]] > 1:
                gone[i : i + span] = True
        kept = bytes(x for x, g in zip(b, gone, strict=False) if not g)
        yield d, len(b), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum() + gone[0]) if len(b) else 0, hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize(("hot", "run"), [(2_000, 1_500_000), (5, 20_000)])  # the second deals grams out
def test_repeats(frame, words, monkeypatch, hot, run):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "COOL", 5)
    monkeypatch.setattr(suffix_dedup, "RUN_BYTES", run)
    base, other = words(600, 1), words(400, 2)
    rows = [(0, base), (1, words(50, 5) + base[200:900] + words(60, 6)), (2, base[100:499]), (3, base[100:500]), (4, None), (5, ""), (6, "x" * 2000), (7, "ab" * 900 + "é" * 500), (8, other), (8, other)]
    rows += [(20 + i, words(80, 100 + i) + " " + base[300:380] + " " + words(80, 200 + i)) for i in range(30)]
    rows += [(60 + i, words(30, 300 + i) + " " + base[1000:1450] + " " + words(30, 400 + i)) for i in range(12)]
    got = sorted(tuple(r)[:5] for r in suffix_dedup.op3_suffix_dedup(frame(rows).repartition(3)).collect())
    assert got == sorted(plain_repeats(rows))


def test_repeats_of_other_length(frame, words):
    shared = words(60, 1)[:230]
    rows = [(i, words(40, 10 + i) + " " + shared + " " + words(40, 50 + i)) for i in range(4)] + [(9, words(90, 99)), (10, None)]
    d = frame(rows)
    got = {r["doc_id"]: r["text"] for r in suffix_dedup.without_repeats(d, span=200).collect()}
    for doc, text in rows:
        kept = [k for k in plain_repeats(rows, 200) if k[0] == doc][0]
        assert hashlib.sha256((got[doc] or "").encode()).hexdigest() == kept[4] and (got[doc] is None) == (text is None)
    assert all(r["text"] == dict(rows)[r["doc_id"]] for r in suffix_dedup.without_repeats(d).collect())


def test_shared_places(frame, words):
    """Each passage of a window's length that two documents share has a place; what one document repeats alone has none."""
    shared, own = words(120, 1)[: suffix_dedup.WINDOW], words(120, 2)[:300]
    rows = [(1, words(50, 3) + " " + shared + " " + words(50, 4)), (2, words(20, 5) + " " + shared), (3, own + " " + own), (4, words(200, 6)), (5, shared[:90]), (6, None)]
    got = {r["doc_id"]: r["n_shared_places"] for r in suffix_dedup.op3_suffix_dedup(frame(rows)).collect()}
    assert got[1] > 0 and got[2] > 0 and [got[k] for k in (3, 4, 5, 6)] == [0, 0, 0, 0]


def test_suffix_names_and_empty_tables(frame, spark):
    d = spark.createDataFrame([(1, "a" * 900, 1, 2, 3, 4, 5)], "doc_id long, text string, __id int, __hash int, __text int, __spans int, row int")
    assert [tuple(r) for r in suffix_dedup.without_repeats(d).collect()] == [(1, "", 1, 2, 3, 4, 5)] and suffix_dedup.without_repeats(d).columns == d.columns
    kept = minhash.one_of_each(d.withColumn("component_id", d["row"]))
    assert kept.columns == [*d.columns, "component_id"] and kept.count() == 1
    none = frame([(1, "a")]).where("doc_id > 1")
    assert suffix_dedup.op3_suffix_dedup(none).collect() == suffix_dedup.without_repeats(none).collect() == []
    assert minhash.op7_minhash(none).collect() == minhash.one_of_each(none).collect() == []


def test_suffix_array():
    r = np.random.default_rng(1)
    for n in (0, 1, 5, 800):
        data = np.append(r.integers(97, 99, n), suffix_dedup.END).astype(np.uint8)
        text = data.tobytes()
        assert suffix_dedup.suffix_array(data)[0].tolist() == sorted(range(n + 1), key=lambda i: text[i:])


def test_rows_without_repeats(frame, words):
    shared = words(200, 9)
    d = frame([(1, "é " + shared + " own"), (2, shared), (3, None)])
    got = {r["doc_id"]: r for r in suffix_dedup.without_repeats(d).collect()}
    assert got[2]["text"] == "" and got[1]["text"] == "é  own" and got[3]["text"] is None and got[1]["words"] == "x"
    assert suffix_dedup.without_repeats(d).columns == d.columns


def test_stages_without_documents(spark, frame):
    none = frame([(1, "a")]).where("doc_id > 1")
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, none, "")
        assert got.collect() == [] and (name == corpus_pipeline.STAGES[-1][0] or got.columns == none.columns)


def test_one_document_of_each_group(frame, words):
    base = words(100, 3)
    rows = [(1, base), (1, base), (2, base + " more"), (3, words(100, 4)), (None, "n"), (None, "m")]
    got = Counter((r["doc_id"], r["text"]) for r in minhash.one_of_each(frame(rows)).collect())
    assert got == Counter([(1, base), (3, rows[3][1]), (None, "n"), (None, "m")])


def test_pipeline_by_stage(spark, words, tmp_path):
    """Each stage against plain Python on its own input, and the whole run."""
    base, passage = words(200, 1), words(120, 2)
    texts = {1: base, 2: base + " more", 3: "too short", 4: words(90, 3) + " " + passage + " " + words(90, 4), 5: words(70, 5) + " " + passage + " " + words(80, 6), 6: words(80, 7) + " write ann@mail.example.com now", 7: None, 8: "a b c " * 60}
    d = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in texts.items()], "doc_id long, text string, lang string, source string, n_chars long")
    d.write.parquet(f"{tmp_path}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "repeated_passages", "personal_data", "packing"]
    quality, near, repeats, private, packing = (f for _, f in corpus_pipeline.STAGES)
    d1 = quality(spark, d, "")
    assert {r["doc_id"] for r in d1.collect()} == {1, 2, 4, 5, 6}
    d2 = near(spark, d1, "")
    assert {r["doc_id"] for r in d2.collect()} == {1, 4, 5, 6} and d2.columns == d.columns
    kept = {r["doc_id"]: r["text"] for r in repeats(spark, d2, "").collect()}
    want = {i: s for i, _, _, _, s in plain_repeats([(r["doc_id"], r["text"]) for r in d2.collect()])}
    assert {i: hashlib.sha256(t.encode()).hexdigest() for i, t in kept.items()} == want and passage not in kept[4]
    d4 = private(spark, repeats(spark, d2, ""), "")
    assert "write [email] now" in {r["doc_id"]: r["text"] for r in d4.collect()}[6] and d4.columns == d.columns
    pieces = corpus_pipeline.run(spark, str(tmp_path))
    assert {r["doc_id"] for r in pieces.collect()} == {1, 4, 5, 6}
