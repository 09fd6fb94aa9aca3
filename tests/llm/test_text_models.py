"""Personal data, byte BPE, language-model scores, the quality model and packing."""

import hashlib
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import bpe, lm_score, packing, pii_crf, quality_gam

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")


@settings(max_examples=300, deadline=None)
@given(st.text("a1.@ -+25(é", max_size=40))
def test_fast_patterns_equal_plain_ones(text):
    assert [(s, e) for k, s, e in pii_crf.base_spans(text) if k == "email"] == [m.span() for m in EMAIL.finditer(text)]
    assert [m.span() for m in pii_crf._IP.finditer(text)] == [m.span() for m in IP.finditer(text)]


PRIVATE = ["é mail ann.lee@mail.example.com or +1 (243) 555-5526.", "4111 1111 1111 1111 and 4111111111111112 at 10.0.0.256 10.1.2.3", None, "", "x" * 50_000 + " bob@b.org"]


def test_base_digest(frame):
    rows = list(enumerate(PRIVATE)) + [(0, PRIVATE[0])]
    got = pii_crf.op1_pii(frame(rows)).orderBy("doc_id").collect()
    assert [(r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) for r in got] == [(1, 0, 0, 1)] * 2 + [(0, 1, 1, 0), (0, 0, 0, 0), (0, 0, 0, 0), (1, 0, 0, 0)]
    start = PRIVATE[0].index("ann")
    phone = PRIVATE[0].index("+1")
    base = f"email:{start}:{start + 24},phone:{phone}:{phone + 17}"
    assert got[0]["base_sha256"] == hashlib.sha256(base.encode()).hexdigest() and set(base.split(",")) <= set(got[0]["spans"].split(","))
    assert all(r["n_spans"] == len(r["spans"].split(",")) * bool(r["spans"]) == r["n_added"] + r["n_email"] + r["n_ip"] + r["n_card"] + r["n_phone"] for r in got)


CARD, PHONE = re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def passes_luhn(found):
    digits = [int(c) for c in found if c.isdigit()]
    return 16 <= len(digits) <= 19 and sum(d if k % 2 == 0 else d // 5 + 2 * d % 10 for k, d in enumerate(digits[::-1])) % 10 == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["4111", " ", "-", "1111 1111 1111", "4111111111111111", "+", "+1 ", "(243)", "5", "555-", "0", "9", ".", "x", "é"]), max_size=30).map("".join))
def test_cards_and_phones_against_patterns(text):
    found = pii_crf.base_spans(text)
    assert [(s, e) for k, s, e in found if k == "card"] == [m.span() for m in CARD.finditer(text) if passes_luhn(m[0])]
    assert [(s, e) for k, s, e in found if k == "phone"] == [m.span() for m in PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]


def test_long_texts_of_digits_take_little_memory():
    """A text that is one stretch: what is held a character is a few numbers, not its candidates."""
    text = "12 345 6 " * 1_500 + "call +1 (243) 555-5526 "
    w = pii_crf.fit([f"some words call +1 ({k}) 555-5526 and {k} more" for k in range(100, 160)])
    pii_crf.all_spans(text[-200:], w)
    tracemalloc.start()
    found = pii_crf.all_spans(text, w)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert ("phone", "+1 (243) 555-5526", True) in [(k, text[s:e], base) for k, s, e, base in found] and most < 200 * len(text)


def test_recall_and_precision_of_spellings():
    """Mail addresses and phones spelt otherwise, planted in other prose than the sample's: found whole, with little else."""
    r = random.Random(7)
    name = lambda: "".join(r.choices("abcdefghijk", k=r.randint(3, 8)))
    prose = lambda n: " ".join(name() for _ in range(n))
    texts = [f"{prose(20)} {name()}@{name()}.example.com {prose(15)} +1 ({r.randint(100, 999)}) 555-{r.randint(1000, 9999)} {prose(20)} {r.randint(1, 2030)} {prose(3)}" for _ in range(120)]
    w = pii_crf.fit(texts)
    planted = right = added = 0
    for k in range(200):
        at, dot = r.choice([(" at ", " dot "), (" (at) ", "."), (" [at] ", " [dot] "), ("(at)", ".")])
        spelt = f"{name()}{at}{name()}{dot}example{dot}com" if k % 2 else f"({r.randint(100, 999)}) 555-{r.randint(1000, 9999)}"
        text = f"{prose(30)} {spelt}, {prose(30)} {r.randint(1, 2030)} {prose(5)}"
        found = [text[s:e] for _, s, e, base in pii_crf.all_spans(text, w) if not base]
        planted, right, added = planted + 1, right + (spelt in found), added + len(found)
    assert right >= 0.9 * planted and right >= 0.9 * added


def test_prose_with_web_addresses_is_left_alone():
    """A plain ``at`` before a name with dots is prose, also near numbers; with a spelt dot it is an address."""
    r = random.Random(9)
    texts = [f"some words write to {''.join(r.choices('abcdef', k=5))}@{r.choice(['mail', 'post'])}.example.com or call +1 ({r.randint(100, 999)}) 555-{r.randint(1000, 9999)} and {r.randint(10, 99)} more" for _ in range(120)]
    w = pii_crf.fit(texts)
    found = lambda text: [text[s:e] for _, s, e, _ in pii_crf.all_spans(text, w)]
    verbs, hosts, ends = ("look", "met", "looked", "arrived 12", "in room 7", "sold 3"), ("www.example.com", "openai.example", "example.org", "news.site.example.net"), ("", " in 2019", " today", " for more, 15 in all")
    cases = [f"please {v} at {h}{e}" for v in verbs for h in hosts for e in ends]
    assert [c for c in cases if found(c)] == []
    right = sum("ann lee at mail dot example"[4:] in found(f"please write to ann lee at mail dot example{e}") for e in ends)
    assert right == len(ends)


def test_scores_are_sums_of_table_entries():
    """A score is the sum of one entry of each table, chosen by counting the edges that a value reaches."""
    r = np.random.default_rng(6)
    x = r.normal(size=(600, len(quality_gam.NAMES)))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    m = quality_gam.fit(x, y)
    assert m.pairs
    for row, got in zip(x[:100].tolist(), m.score(x[:100]), strict=True):
        at = [sum(v >= e for e in edges) for v, edges in zip(row, m.edges, strict=True)]
        total = m.bias + sum(t[k] for t, k in zip(m.tables, at, strict=True)) + sum(t[at[i]][at[j]] for i, j, t in m.pairs)
        assert math.isclose(got, 1 / (1 + math.exp(-total)), rel_tol=1e-9)


def test_no_documents(frame):
    none = frame([(1, "a")]).where("doc_id > 1")
    assert pii_crf.op1_pii(none).collect() == pii_crf.redacted(none).collect() == []
    assert bpe.op4_bpe(none).collect() == packing.op9_packing(none).collect() == []
    assert quality_gam.op8_quality_gam(none, none.selectExpr("doc_id", "1 AS quality")).collect() == []


def test_field_learns_other_spellings():
    r = random.Random(1)
    texts = [f"some words call +1 ({r.randint(100, 999)}) 555-{r.randint(1000, 9999)} or {r.choice(['ann', 'bob.k', 'c_d'])}{r.randint(1, 99)}@mail.example.com and {r.randint(10**15, 10**16 - 1)} more" for _ in range(60)]
    w = pii_crf.fit(texts)
    found = pii_crf.all_spans("please ring (555) 123-4567 today", w)
    assert [(k, "please ring (555) 123-4567 today"[s:e]) for k, s, e, _ in found] == [("phone", "(555) 123-4567")]
    assert pii_crf.all_spans("just 12 apples and 7 pears", w) == []


def test_spelt_addresses_without_digits_are_found():
    r = random.Random(2)
    texts = [f"some words write to {''.join(r.choices('abcdef', k=5))}@{r.choice(['mail', 'post'])}.example.com or call +1 ({r.randint(100, 999)}) 555-{r.randint(1000, 9999)} and {r.randint(10, 99)} more" for _ in range(60)]
    w = pii_crf.fit(texts)
    for address in ("ann at mail dot example dot com", "ann [AT] mail [dot] example", "ann (At) mail.example.com", "ann dot lee at mail dot example", f"{'x' * 60}(at)mail.example.com"):
        text = f"please write to {address}, or look at the house"
        assert [(k, text[s:e]) for k, s, e, _ in pii_crf.all_spans(text, w)] == [("email", address)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["ann", " ", " at ", " dot ", ".", "é", "abcé", "12", "@", "(at)", "[AT]", "\n", "é" * 50]), max_size=120).map("".join))
def test_stretches_hold_every_candidate(text):
    every = pii_crf.Lattice(text, 0, len(text))
    parts = [pii_crf.Lattice(text, a, b) for a, b in pii_crf.stretches(text)]
    spans = lambda x: [(x.ends[i], x.ends[j]) for i, j in x.segments]
    assert [s for p in parts for s in spans(p)] == spans(every)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["ann", " ", " at ", " dot ", " At", "\tdot\n", ".", "é", "²", "١", "12", "10.0.0.1", "4111 1111 1111 1111", "+1 (243)", "-", "@", "(at)", "(at]", "[AT]", "[dot)", "%", "#", "\ud800", "İ"]), max_size=40).map("".join), st.integers(0, 3), st.integers(0, 3))
def test_features_of_many_equal_those_of_one(text, before, after):
    """Counted features are those of each segment by itself, for every segment of stretches inside a text."""
    a, b = min(before, len(text)), max(min(before, len(text)), len(text) - after)
    ends = pii_crf.token_ends(text, a, b)
    pairs = [(i, j) for i in range(len(ends)) for j in range(i + 1, min(len(ends), i + 13))]
    if pairs:
        got = pii_crf.Shape(text, ends).features(*np.array(pairs).T)
        assert (got == np.array([pii_crf.features(text, ends[i], ends[j], j - i) for i, j in pairs])).all()


def test_fit_uses_the_whole_sample():
    """Documents full of dates before those with base spans, and base spans in long stretches, don't stop the fit from learning."""
    r = random.Random(3)
    dates = [" ".join(f"on 2024-{r.randint(10, 12)}-{r.randint(10, 28)} {'the usual report came in as it always does and nobody was surprised by that at all, since all had read it before and said so twice'}" for _ in range(12)) for _ in range(40)]
    calls = [f"some words call +1 ({r.randint(100, 999)}) 555-{r.randint(1000, 9999)} or c_d{r.randint(1, 99)}@mail.example.com today" for _ in range(60)]
    text = "please ring (555) 123-4567 today"
    for texts in (dates + calls, [" ".join(calls)]):
        assert [(k, text[s:e]) for k, s, e, _ in pii_crf.all_spans(text, pii_crf.fit(texts))] == [("phone", "(555) 123-4567")]


def test_sample_holds_base_spans(frame, monkeypatch):
    """The sample has passages with base spans wherever there are any, far into long texts too, and equal ones once."""
    seen = []
    monkeypatch.setattr(pii_crf, "fit", lambda texts: seen.extend(texts))
    numbers = [(i, f"number {i} of many") for i in range(700)]
    pii_crf.fitted(frame([*numbers, *[(i, "mail ann@b.org") for i in range(700, 1500)], (1500, "x " * 30_000 + "mail bob@b.org" + " y" * 30_000), (1501, "no trigger"), (1502, None)]))
    assert len(seen) == pii_crf.OTHERS + 2 and sum("ann@b.org" in t for t in seen) == 1 and sum("bob@b.org" in t for t in seen) == 1 and max(map(len, seen)) <= pii_crf.PASSAGE


def test_field_is_a_distribution():
    """The best segmentation and the marginals agree with trying every segmentation."""
    text = "a +1 23 b"
    lattice = pii_crf.Lattice(text, 0, len(text))
    w = np.random.default_rng(3).normal(size=(len(pii_crf.KINDS), len(pii_crf.FEATURES)))
    scores = lattice.x @ w.T

    def every(i):
        if i == lattice.n:
            yield (), 0.0
            return
        for rest, v in every(i + 1):
            yield rest, v
        for k, (a, b) in enumerate(lattice.segments):
            if a == i:
                for kind in range(len(pii_crf.KINDS)):
                    for rest, v in every(b):
                        yield ((k, kind), *rest), v + scores[k, kind]

    ways = list(every(0))
    best = max(ways, key=lambda x: x[1])[0]
    assert lattice.best(w) == [(pii_crf.KINDS[kind], lattice.ends[lattice.segments[k][0]], lattice.ends[lattice.segments[k][1]]) for k, kind in best]
    total = np.logaddexp.reduce([v for _, v in ways])
    p = lattice.marginals(w)
    for k, kind in ((0, 0), (1, 3)):
        assert math.isclose(p[k, kind], sum(math.exp(v - total) for way, v in ways if (k, kind) in way), rel_tol=1e-9)


def test_redaction_keeps_columns(frame):
    d = frame([(1, PRIVATE[0]), (2, None)])
    got = {r["doc_id"]: r for r in pii_crf.redacted(d, np.zeros((4, len(pii_crf.FEATURES)))).collect()}
    assert got[1]["text"] == "é mail [email] or [phone]." and got[1]["words"] == "x" and got[2]["text"] is None


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@pytest.mark.parametrize("leaf", [5, 8192])
def test_bpe_equals_the_library(vocabulary, leaf, monkeypatch):
    import tiktoken

    monkeypatch.setattr(bpe, "LEAF_CHARS", leaf)
    theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})
    r = random.Random(leaf)
    texts = ["", "a", "'re", "<|endoftext|>", "x" * 3000, " \n\t " * 300] + ["".join(r.choice("abcde the \n\t'srevdml12.,!é漢😀 ") for _ in range(r.randint(0, 80))) for _ in range(1500)]
    for text, ids in zip(texts, vocabulary.encode_all(texts), strict=True):
        assert ids.tolist() == theirs.encode_ordinary(text) and vocabulary.decode(ids) == text.encode()


def test_bpe_query(frame):
    rows = [(1, "Hello  world"), (2, None), (3, "é" * 5000), (1, "Hello  world")]
    got = bpe.op4_bpe(frame(rows)).orderBy("doc_id").collect()
    assert got[2]["n_tokens"] == 0 and got[2]["ids_sha256"] == hashlib.sha256(b"").hexdigest()
    assert [r["decoded_sha256"] for r in got] == [hashlib.sha256((t or "").encode()).hexdigest() for _, t in sorted(rows, key=lambda x: x[0])]


def test_lm_scores_against_plain_python(frame, words):
    rows = [(1, words(200, 1)), (2, words(200, 1) + " Q"), (3, None), (4, "a"), (5, words(50, 2)), (4, "a"), (6, "b A a B b a")]
    texts = [[x.lower() for x in (t or "").split()] for _, t in rows]
    n = [Counter(tuple(w[i : i + k]) for w in texts for i in range(len(w) - k + 1)) for k in (1, 2, 3)]
    total = sum(n[0].values())

    def score(w, i):
        for k in (3, 2):
            if i >= k - 1 and (c := n[k - 1][tuple(w[i - k + 1 : i + 1])]) >= 2:
                return math.log(c / n[k - 2][tuple(w[i - k + 1 : i])]) + math.log(0.4) * (min(i + 1, 3) - k)
        return math.log(n[0][(w[i],)] / total) + math.log(0.4) * (min(i + 1, 3) - 1)

    want = sorted((d, len(w), None if not w else round(sum(score(w, i) for i in range(len(w))) / len(w), 5)) for (d, _), w in zip(rows, texts, strict=True))
    got = sorted((r["doc_id"], r["n_words"], None if r["score"] is None else round(r["score"], 5)) for r in lm_score.op5_lm_score(frame(rows)).collect())
    assert got == want
    assert lm_score.op5_lm_score(frame([(1, "")]).limit(0)).count() == 0


def test_quality_model(spark, frame, words):
    good = [(i, words(120, i)) for i in range(150)]
    bad = [(1000 + i, " ".join(f"{w}%%%" for w in words(120, i).split())) for i in range(150)]
    labels = spark.createDataFrame([(i, int(i < 1000)) for i, _ in good + bad], "doc_id long, quality int")
    got = {r["doc_id"]: r for r in quality_gam.op8_quality_gam(frame([*good, *bad, (5000, None), (None, "x")]), labels).collect()}
    held = [r for r in got.values() if r["held_out"] and r["doc_id"] != 5000]
    assert held and all(r["predicted"] == int(r["doc_id"] < 1000) for r in held)
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in got.items() if d is not None) and 0 <= got[5000]["score"] <= 1
    none = quality_gam.op8_quality_gam(frame([(1, "a")]), labels.limit(0)).first()
    assert none["score"] == 0.5


def test_quality_pairs():
    """A pair table learns what single tables can't."""
    r = np.random.default_rng(1)
    x = np.zeros((2000, len(quality_gam.NAMES)))
    x[:, :2] = r.random((2000, 2))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    assert ((quality_gam.fit(x, y).score(x) > 0.5) == y).mean() > 0.95


def test_packing(frame, words):
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = [(i, words(n, i)) for i, n in enumerate((5, 300, 1200, 4000, 700, 650, 1, 900))] + [(50, None), (51, "")]
    pieces = packing.packed(frame(texts).coalesce(1), path).toPandas()
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    ids = {i: np.array([*t.encode(x or "", add_special_tokens=False).ids, 1], "<u4").tobytes() for i, x in texts}
    assert packing.read_back(pieces, ids)
    fill = pieces.groupby("sequence_id")["length"].sum()
    assert ((fill & (fill - 1)) == 0).all()  # full windows and powers of two: no padding
    assert packing.packed(frame(texts).limit(0), path).count() == 0


def test_sum_of_squares_choice():
    """The chosen level is the one that leaves the least sum of squares."""
    r = random.Random(2)
    p = packing.Packer(16, 0)
    for i in range(400):
        size = r.randint(1, 15)

        def after(level):
            c = p.counts.copy()
            if level:
                c[level] -= 1
            if level + size < 16:
                c[level + size] += 1
            return int((c[1:16] ** 2).sum())

        open_levels = [0, *(h for h in range(1, 17 - size) if p.counts[h])]
        assert after(p.level_for(size)) == min(map(after, open_levels))
        list(p.place(i, 0, b"\0" * 4 * size, size))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 63), max_size=120), st.sampled_from([1, 4, 7, 16, 64]))
def test_levels_of_any_width_keep_every_id(sizes, step):
    """With levels of any width each id lies in one piece, windows are full until the end, and the counts are those of the open windows."""
    p = packing.Packer(64, 0, step)
    rows, ids = [], {}
    for doc, size in enumerate(sizes):
        ids[doc] = np.arange(doc * 100, doc * 100 + size, dtype="<u4").tobytes()
        rows += p.place(doc, 0, ids[doc], size)
        assert {k: len(v) for k, v in p.open.items()} == {k: int(n) for k, n in enumerate(p.counts) if n}
        assert all(p.fills[k] == v[-1][0] == sum(len(x[2]) // 4 for x in v[-1][1]) for k, v in p.open.items())
    full = pd.DataFrame(rows, columns=[c.split()[0] for c in packing.SCHEMA.split(", ")])
    assert (full.groupby("sequence_id")["length"].sum() == 64).all()
    every = pd.DataFrame([*rows, *p.finish()], columns=full.columns)
    fill = every.groupby("sequence_id")["length"].sum()
    assert packing.read_back(every, ids) and every["length"].sum() == sum(sizes) and ((fill & (fill - 1)) == 0).all()


def test_most_is_placed_by_the_rule():
    """A small input leaves few ids to be poured together at its end."""
    r = random.Random(8)
    p = packing.Packer(2048, 0, packing.STEP)
    sizes = [r.choice([r.randint(1, 700), r.randint(1, 2047)]) for _ in range(1000)]
    placed = sum(row[2] for k, size in enumerate(sizes) for row in p.place(k, 0, bytes(4 * size), size))
    assert placed > 0.9 * sum(sizes)


def test_word_ids_equal_the_library():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    r = random.Random(4)
    texts = ["".join(r.choice("abcÉéßΣσİſK.,!?*$-_;:'s12½ \n\x0b\x85　가각́") for _ in range(r.randint(0, 30))) for _ in range(3000)] + ["<|endoftext|> x"]
    for text, got in zip(texts, packing.WordIds(path).many([x.encode() for x in texts]), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == t.encode(text, add_special_tokens=False).ids
