"""Quality rules, winnowing and host verdicts."""

import hashlib
import random
import re
from collections import Counter
from concurrent.futures import ThreadPoolExecutor
from threading import Event

import numpy as np
import pytest

from tidemark.llm import link_graph as G
from tidemark.llm import quality_rules as Q
from tidemark.llm import winnowing as W
from tidemark.llm.common import temporary, written

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def plain(text):
    w = [x for x in SPACE.split(text or "") if x]
    lines = [x for x in (text or "").split("\n") if SPACE.sub("", x)]
    three = list(zip(w, w[1:], w[2:]))
    n = Counter(three)
    covered = {j for i, t in enumerate(three) if n[t] > 1 for j in (i, i + 1, i + 2)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_rules_against_plain_python(frame, words):
    texts = [None, "", " \n\t", "a", "a b", "a b c a b c", "a a a a a", "x\ny\nx\n\nx ", words(60), words(60) + "\n" + words(60), "😀 # * é é <b>", words(2000, 1) + " " + words(2000, 1)]
    rows = [*enumerate(texts), (3, "a")]
    got = sorted((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in Q.op6_quality_rules(frame(rows)).collect())
    assert got == sorted((i, *plain(t)) for i, t in rows)


def test_ledger_policies_and_ablation(frame, words):
    d = frame([(0, words(80)), (1, "abcd efgh"), (2, "# " * 100), (3, words(80, 2))])
    entries = Q.ledger(d)
    kept = {r["doc_id"] for r in Q.apply_policy(entries, Q.POLICIES["v1"]).where("kept").collect()}
    assert kept == {0, 3} == {r["doc_id"] for r in Q.passing(d, Q.POLICIES["v1"]).collect()}
    assert Q.passing(d, Q.POLICIES["v1"]).columns == d.columns
    rules = {r["rule"]: (r["n_failed"], r["n_failed_alone"], r["n_kept_without"]) for r in Q.ablation(entries, Q.POLICIES["v1"]).collect()}
    assert rules["few_words"] == (1, 1, 3) and rules["symbols"][0] == 1


def test_empty_tables(frame):
    none = frame([]).limit(0)
    assert Q.op6_quality_rules(none).count() == 0 and W.op2_winnowing(none).count() == 0


def test_winnowing(frame, words):
    texts = {5: words(300, 1), 4: words(300, 1), 9: words(40, 2), 2: None, 1: "", 7: "x" * 900, 12: words(20_000, 3)}
    got = {r["doc_id"]: r for r in W.op2_winnowing(frame(texts.items())).collect()}
    order = sorted(texts, reverse=True)
    for i, d in enumerate(order):
        t, after = texts[d] or "", texts[order[(i + 1) % len(order)]] or ""
        cut = len(t) // 3
        edited = t[: len(t) - cut] + after[:cut]
        assert (got[d]["n_chars"], got[d]["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
    assert got[5]["fingerprint"] == got[4]["fingerprint"] != "" and got[5]["near_next"] == 1.0
    assert 0.4 < got[12]["near_edited"] < 1 and 0 < got[7]["near_edited"] < 1 and got[9]["near_next"] < 0.1


def test_winnowing_minima(spark, words):
    """Every window of hashes has its least one chosen, the rightmost among equals."""
    text = words(200, 4) + " a" * 40
    d = spark.createDataFrame([(text,)], "text string")
    grams = [int(x) for x in W.with_fingerprint(d, "text", "f", w=1).first()["f"]]
    chosen = W.with_fingerprint(d, "text", "f").first()["f"]
    assert chosen == list(dict.fromkeys(min(grams[i : i + W.W]) for i in range(len(grams) - W.W + 1)))
    assert len({x & (2**32 - 1) for x in chosen}) == len(chosen)


def test_next_document_over_many_ranges(frame):
    r = random.Random(9)
    ids = [r.randint(-50, 400) for _ in range(120)]
    rows = [(i, f"t{k}") for k, i in enumerate(ids)] + [(None, "n1"), (None, "n2")]
    for buckets in (1, 2, 7, 60):
        got = W.with_next(W.id_and_text(frame(rows)).repartition(5), ["doc_id", "text"], buckets).collect()
        assert sorted(x["text"] for x in got) == sorted(t for _, t in rows) == sorted(x["next_text"] for x in got)
        order = sorted({i for i in ids}, reverse=True) + [None]
        after = dict(zip(order, [*order[1:], order[0]], strict=True))
        assert all(x["next_doc_id"] in (x["doc_id"], after[x["doc_id"]]) for x in got)


def test_likeness_against_plain_python(frame):
    """near_edited and near_next are Jaccard similarities of the chosen hashes of texts that plain Python edits."""
    r = random.Random(4)
    word = lambda: "".join(r.choices("abcdef", k=5))
    texts = [" ".join(word() for _ in range(n)) for n in (60, 40, 3, 0, 80)]
    rows = list(enumerate([*texts, texts[0] + " more", None]))
    text = {i: t or "" for i, t in rows}
    edited = {i: t[: len(t) - len(t) // 3] + text[(i - 1) % len(rows)][: len(t) // 3] for i, t in text.items()}
    marks = lambda s: {x.split(":")[0] for x in s.split(",") if x}
    like = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    got = {x["doc_id"]: x for x in W.op2_winnowing(frame(rows)).collect()}
    again = {x["doc_id"]: x["fingerprint"] for x in W.op2_winnowing(frame(list(edited.items()))).collect()}
    for i in text:
        assert got[i]["edited_fingerprint"] == again[i]
        assert got[i]["near_edited"] == like(marks(got[i]["fingerprint"]), marks(again[i]))
        assert got[i]["near_next"] == like(marks(got[i]["fingerprint"]), marks(got[(i - 1) % len(rows)]["fingerprint"]))


def test_repeated_ids_follow_each_other(frame):
    rows = [(1, "a"), (1, "b"), (1, "b"), (None, "n"), (3, "c")]
    assert W.with_next(W.id_and_text(frame(rows)), ["text"], 4).count() == 5


def test_only_null_ids_follow_each_other(frame):
    got = W.with_next(W.id_and_text(frame([(None, "a"), (None, "b"), (None, "c")])), ["text"], 4).collect()
    assert sorted(x["next_text"] for x in got) == ["a", "b", "c"]


def test_scopes_of_threads_are_apart(frame):
    """Two threads' scopes, ended in the order in which they began: each deletes its own copies only."""
    d, first, second = frame([(1, "a")]), Event(), Event()

    def early():
        with temporary(d.sparkSession):
            copy = written(d)
            first.set()
            second.wait(60)
        return copy

    def late():
        first.wait(60)
        with temporary(d.sparkSession):
            copy = written(d)
            second.set()
            gone.result(60)
            return copy.count()

    with ThreadPoolExecutor(2) as pool:
        gone = pool.submit(early)
        assert pool.submit(late).result(120) == 1
    with pytest.raises(Exception, match="(?i)not.?exist|not.?found|no such"):
        gone.result().collect()


URLS = {1: "http://a.com/x", 2: "https://B.example.COM/en/1?q", 3: "http://www.example.com/en/2", 4: "http://x.net/es/", 5: "http://x.net", 6: None, 7: "nothing", 8: "http://com/", 9: "http://acom/", 10: "http://q.org/a#b"}


def test_rules_of_urls(spark):
    d = spark.createDataFrame([(i, u, "<a href='http://x.net/es/1'>", 0) for i, u in URLS.items()], "page_id long, url string, html string, host int")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in G.op10_link_graph(d).collect()}
    assert got[1] == ("a.com", "/x", "com/", "allow") and got[2] == ("b.example.com", "/en/1", "example.com/en/", "block")
    assert got[3][2:] == ("www.example.com/en/", "allow") and got[4][2:] == ("net/es/", "block")
    assert got[5][:3] == ("x.net", "", None) and got[6] == ("", "", None, "allow") == got[7]
    assert got[8][2] == "com/" and got[9][2] is None and got[10][:2] == ("q.org", "/a")


def test_rank_against_plain_python(spark):
    edges = [("a", "b", 1.0), ("a", "c", 0.0), ("b", "c", 1.0), ("c", "a", 0.5), ("c", "d", 0.5)]
    e = spark.createDataFrame([("t", *x) for x in edges], "kind string, src string, dst string, share double")
    s = spark.createDataFrame([("t", "a", 1.0)], "kind string, host string, seed double")
    rank = {"a": 0.15}
    for _ in range(5):
        new = {"a": 0.15}
        for u, v, w in edges:
            new[v] = new.get(v, 0) + 0.85 * rank.get(u, 0) * w
        rank = new
    got = {r["host"]: r["rank"] for r in G.propagate(e, s, rounds=5).collect()}
    assert all(abs(got[h] - rank[h]) < 1e-12 for h in rank if rank[h])


def test_rank_reaches_its_fixed_point(spark):
    """A chain longer than a cut's rounds, closed to a ring: ranks solve their equation, and every host has one."""
    n = 20
    e = spark.createDataFrame([("t", f"h{k}", f"h{(k + 1) % n}", 1.0) for k in range(n)], "kind string, src string, dst string, share double")
    s = spark.createDataFrame([("t", "h0", 1.0)], "kind string, host string, seed double")
    got = {r["host"]: r["rank"] for r in G.propagate(e, s).collect()}
    assert all(abs(got[f"h{k}"] - 0.15 * 0.85**k / (1 - 0.85**n)) < 1e-5 for k in range(n)) and len(got) == n


def test_order_of_ranks_is_that_of_a_dense_solve(spark):
    """It may end long before the ranks settle, but no host's larger rank is then the smaller one."""
    r = np.random.default_rng(3)
    n = 40
    links = [(u, v) for u in range(n) for v in r.choice(n, 3, replace=False).tolist() if u != v]
    kinds = {"trust": links, "distrust": [(v, u) for u, v in links]}
    seeds = {"trust": [0, 1, 2], "distrust": [3, 4]}
    edges, want = [], {}
    for kind, own in kinds.items():
        a = np.zeros((n, n))
        for u, v in own:
            a[v, u] += 1
        a /= np.maximum(a.sum(axis=0), 1)
        edges += [(kind, f"h{u}", f"h{v}", float(a[v, u])) for v in range(n) for u in range(n) if a[v, u]]
        start = np.zeros(n)
        start[seeds[kind]] = 0.15 / len(seeds[kind])
        want[kind] = np.linalg.solve(np.eye(n) - 0.85 * a, start)
    e = spark.createDataFrame(edges, "kind string, src string, dst string, share double")
    s = spark.createDataFrame([(k, f"h{h}", 1 / len(hs)) for k, hs in seeds.items() for h in hs], "kind string, host string, seed double")
    got = {(x["kind"], x["host"]): x["rank"] for x in G.propagate(e, s, order=True).collect()}
    for h in range(n):
        gap = want["distrust"][h] - want["trust"][h]
        assert abs(gap) < 1e-12 or (got.get(("distrust", f"h{h}"), 0) > got.get(("trust", f"h{h}"), 0)) == (gap > 0), h


LINK = re.compile(r"""(?i)\b(?:href|src)\s*=\s*["']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)""")


def plain_verdicts(pages):
    """The whole query in plain Python: rules, edges of links and parents, both ranks by many rounds."""
    low = lambda h: "".join(c.lower() if "A" <= c <= "Z" else c for c in h)

    def parts(url):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = re.match(r"[^/?#]*", rest)[0]
        return low(host), re.match(r"[^?#]*", rest[len(host) :])[0]

    def rule(host, path):
        fits = [(len(t), t, v) for v, t in G.RULES for h, p in [t.split("/", 1)] if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
        return max(fits)[1:] if fits else (None, None)

    edges, by_host = {}, {}
    for _, url, html in pages:
        host, path = parts(url)
        if host:
            by_host.setdefault(host, []).append(rule(host, path)[1])
            for m in LINK.finditer(html or ""):
                if (to := low(m[1])) != host:
                    edges[host, to] = edges.get((host, to), 0) + 1
    steps = set()
    for h in {*by_host, *(b for _, b in edges)}:
        labels = h.split(".")
        steps |= {(".".join(labels[i:]), ".".join(labels[i + 1 :])) for i in range(len(labels) - 2)}
    for a, b in steps:
        for k in ((a, b), (b, a)):
            edges[k] = edges.get(k, 0) + 1

    def rank(edges, seeds):
        out = {}
        for (a, _), w in edges.items():
            out[a] = out.get(a, 0) + w
        start = {h: 0.15 / len(seeds) for h in seeds}
        r = dict(start)
        for _ in range(300):
            new = dict(start)
            for (a, b), w in edges.items():
                if a in r:
                    new[b] = new.get(b, 0) + 0.85 * r[a] * w / out[a]
            r = new
        return r

    trust = rank(edges, [h for h, v in by_host.items() if 2 * v.count("allow") >= len(v)])
    distrust = rank({(b, a): w for (a, b), w in edges.items()}, [h for h, v in by_host.items() if 2 * v.count("block") >= len(v)])
    for page, url, _ in pages:
        host, path = parts(url)
        text, said = rule(host, path)
        yield page, host, path, text, said or ("block" if host and distrust.get(host, 0) > trust.get(host, 0) else "allow")


def test_whole_query_against_plain_python(spark):
    r = random.Random(5)
    hosts = [f"{a}{b}.{c}" for a in ("", "w.", "e.f.") for b in ("p", "q", "r") for c in ("com", "net", "org", "de")] + ["www.example.com", "x.example.com"]
    host = lambda i: r.choice(hosts).upper() if i % 7 == 0 else r.choice(hosts)
    pages = [(i, f"http://{host(i)}{r.choice(['', '/', '/en/a', '/es/b?x', '/fr/#y', '?q'])}", " ".join(f"<a href={r.choice(['http:', ''])}//{r.choice(hosts)}/x>" for _ in range(r.randint(0, 3)))) for i in range(120)]
    pages += [(200, None, None), (201, "no", ""), (202, "http://", "")]
    got = G.op10_link_graph(spark.createDataFrame(pages, "page_id long, url string, html string"))
    assert sorted(map(str, (tuple(x)[:5] for x in got.collect()))) == sorted(map(str, plain_verdicts(pages)))


def test_no_pages(spark):
    assert G.op10_link_graph(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_distrust_flows_back(spark):
    pages = [(1, "http://bad.net/es/1", ""), (2, "http://fan.org/1", '<a href="http://bad.net/x">'), (3, "http://good.com/1", '<a href="http://friend.org/">'), (4, "http://friend.org/1", "")]
    got = {r["page_id"]: r["verdict"] for r in G.op10_link_graph(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got == {1: "block", 2: "block", 3: "allow", 4: "allow"}
