"""Alignment of tokenisers, spelling variants and nearest neighbours, each against brute force."""

import hashlib
import random
import re
import string
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest

from tidemark.llm import common, hamming_index, spelling, token_links

# --- alignment


@pytest.fixture(scope="module")
def tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def byte_table():
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def plain_alignment(rows, tokenizers):
    """Links by comparing all ranges of a text, by the library's own files."""
    a, b = tokenizers
    table = byte_table()
    out, links = [], []
    for i, text in rows:
        want = (" " + (text or "")).encode()
        ia = a.encode(" " + (text or ""), add_special_tokens=False).ids
        ib = b.encode(text or "")
        ta = [bytes(table[c] for c in a.id_to_token(x)) for x in ia]
        tb = [bytes([int(p[3:5], 16)]) if b.is_byte(x) else p.replace("▁", " ").encode() for x in ib for p in [b.id_to_piece(x)]]
        if not text or b"".join(ta) != want or b"".join(tb) != want:
            out.append([i, 0, 0, 0, [], ""])
            continue
        spans = lambda ts: [(sum(map(len, ts[:k])), sum(map(len, ts[: k + 1]))) for k in range(len(ts))]
        sa, sb = spans(ta), spans(tb)
        common = sorted({e for _, e in sa} & {e for _, e in sb})
        groups, start = [], 0
        for end in common:
            groups.append(",".join(str(x) for x, (s, e) in zip(ia, sa, strict=True) if start < e <= end) + "|" + ",".join(str(x) for x, (s, e) in zip(ib, sb, strict=True) if start < e <= end))
            start = end
        own = [(x, y) for x, (s, e) in zip(ia, sa, strict=True) for y, (t, f) in zip(ib, sb, strict=True) if s < f and t < e]
        links += own
        out.append([i, len(ia), len(ib), len(groups), own, hashlib.sha256(";".join(groups).encode()).hexdigest()])
    n = Counter(links)
    top = Counter()
    for (x, y), c in n.items():
        top[y] = max(top[y], c)
    return sorted((i, na, nb, g, len(own), sum(n[p] == top[p[1]] for p in own), sum(n[p] for p in own), h) for i, na, nb, g, own, h in out)


ALIGNED = ["Plain words and 12345 numbers, repeated words.", "naïve café 東京 <|endoftext|> <s> don't", None, "", " ", "  two  spaces\n\nlines\ttabs", "aaaa aaaa aaaaaaa", "ﬁ rewritten ligature", "a ▁ block", "x" * 3000, "😀 emoji 😀", "<0x41> A"]


def test_alignment_against_brute_force(frame, tokenizers, monkeypatch):
    r = random.Random(5)
    rows = list(enumerate(ALIGNED)) + [(100 + k, " ".join("".join(r.choice("aeinrstlou") for _ in range(r.randint(1, 9))) for _ in range(60))) for k in range(12)] + [(0, ALIGNED[0])]
    d = token_links.op12_token_links(frame(rows).repartition(3))
    got = sorted(tuple(x) for x in d.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect())
    assert got == plain_alignment(rows, tokenizers)
    assert token_links.op12_token_links(frame([])).count() == 0


def test_blocks_of_alignment(tokenizers):
    """Blocks of any size give the same columns, and one-to-one links are only counted in the vector."""
    al = token_links.aligner(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, public_tokenizers.path("piece_bpe_32k.model"))
    texts = [t or "" for t in ALIGNED]
    row, vector = al.block(texts)
    parts = [al.block([t]) for t in texts]
    for c in ("n_a", "n_b", "n_groups", "n_links"):
        assert list(row[c]) == [int(p[0][c][0]) for p in parts]
    assert row["digest"] == [p[0]["digest"][0] for p in parts] and (vector == sum(p[1] for p in parts)).all()
    assert vector.sum() + row["n"].sum() == row["n_links"].sum() and vector.sum() > 0 < row["n"].sum()
    a = tokenizers[0]
    table = byte_table()
    assert all(al.bytes_a[i] == bytes(table[c] for c in t) for t, i in a.get_vocab().items() if t != "<|endoftext|>")


def test_a_block_is_a_row_group(frame, tokenizers, monkeypatch):
    """Arrays of a row group's rows are decoded together, so a task that reads blocks must not hold those of a whole file."""
    kept = []

    def written(*a, **b):
        d = common.written(*a, **b)
        if "refs" in d.columns:
            metas = [pq.ParquetFile(f.removeprefix("file:")).metadata for f in d.inputFiles()]
            kept.extend([m.row_group(k).num_rows for k in range(m.num_row_groups)] for m in metas)
        return d

    monkeypatch.setattr(token_links, "BLOCK", 40)
    monkeypatch.setattr(token_links, "written", written)
    rows = [(k, f"{t or ''} and some more words {k}") for k, t in enumerate(ALIGNED)]
    d = token_links.op12_token_links(frame(rows).coalesce(1))
    got = sorted(tuple(x) for x in d.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect())
    assert got == plain_alignment(rows, tokenizers)
    assert max(map(len, kept)) > 3 and all(n == 1 for groups in kept for n in groups)


# --- spelling variants


def plain_variants(rows):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate({65 + k: 97 + k for k in range(26)})
            h = zlib.crc32(f"{i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    out = {}
    for w in n:
        others = [x for x in n if near(w, x)]
        best = min(others, key=lambda x: (-n[x], x), default=None)
        out[w] = (len(others), best if best and n[best] >= 10 * n[w] else None)

    def root(w):
        while out[w][1]:
            w = out[w][1]
        return w

    return sorted((w, out[w][1], root(w), n[w], out[w][0], n.get(out[w][1])) for w in n)


def test_variants_against_brute_force(frame):
    r = random.Random(3)
    base = ["".join(r.choice("abcé") for _ in range(r.randint(7, 10))) for _ in range(12)] + ["straße" + "n" * 3, "Équation", "aaaaaaa", "aaaaaaaa"]
    rows = []
    for k in range(400):
        words = []
        for _ in range(40):
            w = r.choice(base[: 1 + int(len(base) * r.random() ** 2)])
            if r.random() < 0.25:
                at = r.randrange(len(w))
                w = r.choice([w[:at] + w[at + 1 :], w[:at] + r.choice("abcé") + w[at:], w[:at] + r.choice("abcé") + w[at + 1 :]])
            words.append(w.upper() if r.random() < 0.1 else w)
        rows.append((k, r.choice([" ", "-", "1"]).join(words)))
    rows += [(1, None), (2, ""), (3, rows[3][1])]
    got = sorted(tuple(x) for x in spelling.op13_spelling(frame(rows)).select("word", "form", "root", "n", "n_near", "form_n").collect())
    assert got == plain_variants(rows) and sum(x[1] is not None for x in got) > 20 and any(x[2] != x[1] for x in got if x[1])
    assert spelling.op13_spelling(frame([])).count() == 0


def test_near_pairs_lose_none(spark):
    """Every kind of edit at every place, repeated letters included."""
    words = {"abcdefgh", "aabbccdd", "zzzzzzzz"}
    for w in list(words):
        words |= {w[:k] + c + w[k:] for k in range(len(w) + 1) for c in "az"} | {w[:k] + w[k + 1 :] for k in range(len(w))} | {w[:k] + c + w[k + 1 :] for k in range(len(w)) for c in "ab"}
    got = {(x.word, x.near) for x in spelling.near_pairs(spark.createDataFrame([(w, 2) for w in sorted(words)], "word string, n long")).collect()}

    def edits(w):
        letters = string.ascii_lowercase
        return {w[:k] + w[k + 1 :] for k in range(len(w))} | {w[:k] + c + w[k:] for k in range(len(w) + 1) for c in letters} | {w[:k] + c + w[k + 1 :] for k in range(len(w)) for c in letters}

    assert got == {(w, x) for w in words for x in edits(w) & words if x != w}


def test_roots_follow_long_chains(spark):
    chain = spark.createDataFrame([(f"w{k:02d}", f"w{k + 1:02d}") for k in range(18)], "word string, form string")
    assert {x.root for x in spelling.roots(chain).collect()} == {"w18"}


# --- nearest neighbours


def plain_neighbours(rows, k=10):
    rows = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    out = {}
    for q, v in rows:
        if q % 100 == 0:
            out[q] = sorted((float(np.sqrt(((x - v) ** 2).sum())), i) for i, x in rows if i != q)[:k]
    return out


def as_lists(found):
    out = {}
    for x in sorted(found, key=lambda x: (x["query_id"], x["rank"])):
        out.setdefault(x["query_id"], []).append((x["score"], x["vec_id"]))
    return out


def test_recall_and_scores_against_brute_force(spark):
    r = np.random.default_rng(1)
    x = r.normal(size=(3000, 24))
    x[1000:2000] = x[5] + 0.05 * r.normal(size=(1000, 24))  # a third are near copies of one
    x[2000:2300] = x[7]  # exact copies, one of them asks
    rows = [(i, v.tolist()) for i, v in enumerate(x.astype(np.float32))]
    odd = [(100_000, None), (100_100, [0.0] * 24), (100_200, [float("nan")] * 24), (100_300, [1.0] * 23 + [None]), (100_400, [1.0, 2.0]), (None, [1.0] * 24), rows[300]]
    d = spark.createDataFrame([(i, v, 1, "x") for i, v in rows + odd], "vec_id long, embedding array<float>, label int, block string")
    found = as_lists(hamming_index.op11_hamming_index(d).collect())
    want = plain_neighbours(rows)
    assert set(found) == set(want) and all(len(v) == 10 and v == sorted(v) for v in found.values())
    exact = {i: dict((b, a) for a, b in plain_neighbours(rows, 4000)[i]) for i in list(want)[:5]}
    assert all(exact[q][i] == pytest.approx(s, rel=1e-12) for q in exact for s, i in found[q])
    assert np.mean([len({i for _, i in found[q]} & {i for _, i in want[q]}) / 10 for q in want]) >= 0.9
    assert [i for _, i in found[2000]] == [7, *range(2001, 2010)]  # ties go to the smaller id


def test_few_and_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    few = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.5]), (0, [1.0, 0.0])]
    found = as_lists(hamming_index.op11_hamming_index(spark.createDataFrame(few, schema)).collect())
    assert found == {0: [(0.5, 2), (pytest.approx(2**0.5), 1)]}
    assert hamming_index.op11_hamming_index(spark.createDataFrame([], schema)).count() == 0
    assert hamming_index.op11_hamming_index(spark.createDataFrame([(0, [1.0])], schema)).count() == 0


def test_probing_finds_every_code_within_the_radius():
    """Candidates against a comparison with all codes, for a fixed radius."""
    r = np.random.default_rng(2)
    x = r.normal(size=(800, 16)).astype(np.float32)
    model = hamming_index.fit(x.astype(float))
    for limit in (0, 7, 8, 21, 33, 50, 128):
        block = hamming_index.Block(model, np.arange(800), x, 800)
        code = model.codes(x[3:4])[0]
        found = np.concatenate(list(block.reached(code, lambda n=limit: n)))
        assert sorted(found.tolist()) == np.flatnonzero(hamming_index.hamming(block.codes, code) <= limit).tolist()
