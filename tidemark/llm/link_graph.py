"""URL verdicts from prefix rules and from trust that flows over the graph of hosts.

Hosts that no rule settles are judged by two personalised PageRanks: trust starts at hosts that are mostly allowed
by rules and follows the edges, distrust starts at mostly blocked hosts and follows them reversed. Edges are the
links of the pages' html that name a host, with a scheme or without, and, both ways, each host and its parent domain.
Ranks are passed on until they have settled, so every host that a seed reaches is judged.

Defined cases: a null url, or one without ``://``, has an empty host and path and no rule, and is allowed; a null html
has no links; equal rows are judged alike; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written

#: (verdict, host and path); the longest that fits wins.
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
DAMPING = 0.85
#: Ranks are looked at after so many rounds. They have settled when all together change by less than ``TOLERANCE``
#: meanwhile; where only their order is asked for, what no host can still change by more than (``TIE``) is a tie.
CUT_EVERY, TOLERANCE, TIE = 6, 1e-6, 1e-12
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def with_host(pages: DataFrame) -> DataFrame:
    """``pages`` with host and path as strings, both empty where the url has no ``://``."""
    at = F.instr("url", "://")
    rest = F.when(at > 0, F.substring("url", at + 3, F.length("url"))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest) + 1), r"^[^?#]*", 0)
    return pages.withColumns({"host": F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit("")), "path": F.coalesce(path, F.lit(""))})


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str], ...] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none does. A few rules only: they become one expression."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, text in sorted(rules, key=lambda r: len(r[1])):
        h, p = text.split("/", 1)
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(f"/{p}")
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def host_edges(pages: DataFrame) -> DataFrame:
    """src, dst, weight: links between different hosts, counted, and parent domains of two labels or more, both ways."""
    links = F.regexp_extract_all("html", F.lit(r"""(?i)\b(?:href|src)\s*=\s*["']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""), F.lit(1))
    linked = with_host(pages.select("url", "html")).select(F.col("host").alias("src"), F.explode(links).alias("dst")).withColumn("dst", F.translate("dst", _UPPER, _LOWER))
    linked = linked.where((F.col("src") != "") & (F.col("src") != F.col("dst"))).groupBy("src", "dst").agg(F.count("*").cast("double").alias("weight"))
    linked = written(linked)  # used twice; the pages' html is searched once
    names = with_host(pages.select("url")).select("host").union(linked.select("dst")).where("host <> ''").distinct()
    labels = F.split("host", r"\.")
    chain = F.transform(F.sequence(F.lit(1), F.size(labels) - 1), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    steps = names.where(F.size(labels) >= 3).select(F.explode(F.transform(F.slice(chain, 1, F.size(chain) - 1), lambda c, i: F.struct(c.alias("src"), F.get(chain, i + 1).alias("dst")))).alias("e")).select("e.*").distinct()
    up = steps.select("src", "dst", F.lit(1.0).alias("weight"))
    down = steps.select(F.col("dst").alias("src"), F.col("src").alias("dst"), F.lit(1.0).alias("weight"))
    return linked.union(up).union(down).groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def propagate(edges: DataFrame, seeds: DataFrame, rounds: int | None = None, damping: float = DAMPING, order: bool = False) -> DataFrame:
    """Personalised PageRank for each ``kind``: edges (kind, src, dst, share), seeds (kind, host, seed) -> (kind, host, rank).

    ``share`` is an edge's part of its source's weight. All kinds take one pass a round; the ranks are cut from their
    lineage every few rounds, when they are also held against those of the last cut. The change shrinks by ``damping``
    a round at least, which bounds what any one host's rank can still change by. It ends when no new host is reached and
    the ranks have settled; with ``order``, when every host's ranks of two kinds are further apart than both can still
    change, so that the larger one stays the larger, however many hosts there are. Rank that reaches a host without
    edges is not passed on. ``rounds``: so many, settled or not.
    """
    ranks = seeds.select("kind", "host", (F.col("seed") * (1 - damping)).alias("rank"))
    start = last = ranks
    i = -1
    while rounds is None or i + 1 < rounds:
        i += 1
        sent = ranks.withColumnRenamed("host", "src").join(edges, ["kind", "src"]).select("kind", F.col("dst").alias("host"), (F.col("rank") * F.col("share") * damping).alias("rank"))
        ranks = sent.union(start).groupBy("kind", "host").agg(F.sum("rank").alias("rank"))
        if i % CUT_EVERY == CUT_EVERY - 1:
            ranks = written(ranks)
            if rounds is None:
                both = ranks.join(last.withColumnRenamed("rank", "was"), ["kind", "host"], "left")
                moved = both.agg(F.sum(F.abs(F.col("rank") - F.coalesce("was", F.lit(0.0)))).alias("change"), F.count_if(F.col("was").isNull()).alias("new")).first()
                change, shrunk = moved["change"] or 0.0, damping**CUT_EVERY
                left = change * shrunk / (1 - shrunk)  # all that is still to come
                gaps = ranks.groupBy("host").agg((2 * F.max("rank") - F.sum("rank")).alias("gap"))
                if not moved["new"] and (left < TIE or not gaps.where(F.col("gap") <= left).limit(1).count() if order else change < TOLERANCE):
                    break
                last = ranks
    return ranks


def host_verdicts(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, margin: float = 0.0) -> DataFrame:
    """host, trust, distrust, verdict for every host of ``pages``: block if distrust exceeds trust by more than ``margin``.

    Seeds are hosts of whose pages at least half are allowed, or blocked, by rules; each kind's seeds share a mass of 1.
    """
    d = with_host(pages.select("url"))
    _, said = rule_of(F.col("host"), F.col("path"), rules)
    hosts = d.select("host", said.alias("said")).where("host <> ''").groupBy("host").agg(F.count("*").alias("n"), F.count_if(F.col("said") == "allow").alias("n_allow"), F.count_if(F.col("said") == "block").alias("n_block"))
    hosts = written(hosts)
    seeds = hosts.select("host", F.inline(F.array(F.struct(F.lit("trust").alias("kind"), (F.col("n_allow") * 2 >= F.col("n")).alias("is")), F.struct(F.lit("distrust").alias("kind"), (F.col("n_block") * 2 >= F.col("n")).alias("is"))))).where("is")
    mass = seeds.groupBy("kind").agg(F.count("*").alias("of"))
    seeds = written(seeds.join(mass, "kind").select("kind", "host", (1.0 / F.col("of")).alias("seed")))
    e = host_edges(pages)
    both = e.select(F.lit("trust").alias("kind"), "src", "dst", "weight").union(e.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "weight"))
    both = written(both)
    out = both.groupBy("kind", "src").agg(F.sum("weight").alias("all"))
    shares = written(both.join(out, ["kind", "src"]).select("kind", "src", "dst", (F.col("weight") / F.col("all")).alias("share")))
    ranks = propagate(shares, seeds, order=margin == 0).groupBy("host").agg(F.sum(F.when(F.col("kind") == "trust", F.col("rank"))).alias("trust"), F.sum(F.when(F.col("kind") == "distrust", F.col("rank"))).alias("distrust"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0)).alias(c)
    judged = hosts.join(ranks, "host", "left").select("host", zero("trust"), zero("distrust"))
    return judged.withColumn("verdict", F.when(F.col("distrust") - F.col("trust") > margin, "block").otherwise("allow"))


def op10_link_graph(pages: DataFrame) -> DataFrame:
    """The contract's columns, with the host's trust and distrust besides."""
    hosts = written(host_verdicts(pages)).withColumnRenamed("verdict", "host_verdict")
    d = with_host(pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url")))
    rule, said = rule_of(F.col("host"), F.col("path"))
    d = d.select("page_id", "host", "path", rule.alias("rule"), said.alias("said"))
    return d.join(hosts, "host", "left").select("page_id", "host", "path", "rule", F.coalesce("said", "host_verdict", F.lit("allow")).alias("verdict"), F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
