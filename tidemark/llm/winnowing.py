"""Document fingerprints by winnowing, in DataFrame functions only.

Tokens are the words of the lower-cased text, cut after ``PIECE`` characters so that a text without white space has
tokens too. Each run of ``k`` tokens gets a rolling polynomial hash; of each ``w`` neighbouring hashes the least is
chosen, the rightmost among equals, and kept with its token position. Two texts that share ``k + w - 1`` tokens in a
row therefore share a chosen hash.

Defined cases: a null or empty text has the empty fingerprint; a text of fewer than ``k`` tokens has one hash, of all
its tokens; two empty fingerprints are alike with 1.0; equal texts have equal fingerprints; other columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import id_and_text

K, W, PIECE = 5, 8, 16
#: Ranges of ids for each shuffle partition: several small ones fill a partition more evenly than one.
RANGES = 8
_P = 2**31 - 1
_BASE = 1_000_003
_LOW = 2**32 - 1


def _least_of_two(values: str, step: int):
    return lambda x, i: F.least(x, F.get(values, i + step))


def with_fingerprint(df: DataFrame, text: str, out: str, k: int = K, w: int = W) -> DataFrame:
    """``df`` with array<long> ``out``: the chosen hashes, each as ``hash << 32 | (2^32 - 1 - position)``.

    Packed so, the least value of a window is the least hash at its rightmost position.
    """
    t, g, m = f"{out}__t", f"{out}__g", f"{out}__m"
    df = df.withColumn(t, F.transform(F.regexp_extract_all(F.lower(text), F.lit(r"([^\x20\x09-\x0D]{1,%d})" % PIECE), F.lit(1)), lambda x: F.pmod(F.xxhash64(x), F.lit(_P).cast("long"))))
    n = F.size(t)
    starts = F.slice(t, 1, F.greatest(n - (k - 1), F.least(n, F.lit(1))))

    def gram(h: Column, i: Column) -> Column:
        for j in range(1, k):
            h = (h * _BASE + F.coalesce(F.get(t, i + j), F.lit(0).cast("long"))) % _P
        return F.shiftleft(h, 32).bitwiseOR(F.lit(_LOW).cast("long") - i)

    df = df.withColumn(g, F.transform(starts, gram)).withColumn(m, F.col(g))
    span = 1
    while span < w:  # the least of a window from the least of two shorter ones
        step = min(span, w - span)
        df = df.withColumn(m, F.transform(m, _least_of_two(m, step)))
        span += step
    windows = F.greatest(F.size(g) - (w - 1), F.least(F.size(g), F.lit(1)))
    return df.withColumn(out, F.array_distinct(F.slice(m, 1, windows))).drop(t, g, m)


def hashes(fingerprint: Column) -> Column:
    return F.array_distinct(F.transform(fingerprint, lambda x: F.shiftright(x, 32)))


def as_text(fingerprint: Column) -> Column:
    """``hash:position`` of each chosen hash (hash in hex), comma-joined."""
    return F.array_join(F.transform(fingerprint, lambda x: F.concat(F.hex(F.shiftright(x, 32)), F.lit(":"), (F.lit(_LOW).cast("long") - x.bitwiseAND(F.lit(_LOW).cast("long"))).cast("string"))), ",")


def likeness(a: str, b: str) -> Column:
    """Jaccard similarity of two arrays of distinct hashes."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, F.lit(1.0)).otherwise(both / F.when(either == 0, 1).otherwise(either))


def with_next(df: DataFrame, columns: list[str], buckets: int) -> DataFrame:
    """``df`` (doc_id, text, ...) with ``next_<c>`` of the row that follows by descending doc_id; the first follows the last.

    The rows are dealt by ranges of doc_id whose bounds are ids of the table, so that a range's follower is the row at
    the bound below it, which is dealt to both ranges. Only the bounds, at most ``buckets``, come to the driver; each
    list of them is one value of the plan, however many there are. A row finds its range in two steps, among every so
    many bounds and then between two of these. Ties of doc_id are ordered by a hash of the text, then the text; null
    ids come last.
    """
    shares = F.lit(np.arange(1, buckets + 1) / buckets)
    found = df.agg(F.percentile_approx("doc_id", shares, 10 * buckets).alias("q"), F.max("doc_id").alias("top")).first()
    bounds = sorted({*(found["q"] or []), *([] if found["top"] is None else [found["top"]])})
    if bounds:
        step = math.isqrt(len(bounds)) + 1
        every, firsts = (F.lit(np.array(x, np.int64)) for x in (bounds, bounds[::step]))
        doc = F.coalesce("doc_id", F.lit(bounds[0]))
        below = lambda v: F.size(F.filter(v, lambda b: b < doc))
        group = F.greatest(below(firsts) - 1, F.lit(0))
        own = group * step + below(F.slice(every, group * step + 1, step))
        at = F.coalesce(F.get(every, own) == F.col("doc_id"), F.lit(False))
        after = F.pmod(own + 1, F.lit(len(bounds)))
    else:
        own, at, after = F.lit(0), F.lit(True), F.lit(0)
    place = lambda b, t: F.struct(b.alias("bucket"), F.lit(t).alias("twin"))
    dealt = df.withColumn("place__", F.explode(F.when(at, F.array(place(own, False), place(after, True))).otherwise(F.array(place(own, False)))))
    w = Window.partitionBy("place__.bucket").orderBy(F.col("place__.twin"), F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), "text")
    return dealt.select("*", *[F.lead(c).over(w).alias(f"next_{c}") for c in columns]).where(~F.col("place__.twin")).drop("place__")


def op2_winnowing(docs: DataFrame) -> DataFrame:
    """The contract's columns: the fingerprints of each text and of its edited text, and their likeness."""
    spark = docs.sparkSession
    buckets = RANGES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    d = with_fingerprint(id_and_text(docs), "text", "fp")
    d = with_next(d, ["text", "fp"], buckets)
    n = F.length("text")
    cut = F.floor(n / 3).cast("int")
    d = d.select("doc_id", n.cast("long").alias("n_chars"), "fp", "next_fp", F.concat(F.substring("text", F.lit(1), n - cut), F.substring("next_text", F.lit(1), cut)).alias("edited"))
    d = with_fingerprint(d, "edited", "efp")
    d = d.withColumns({"h": hashes(F.col("fp")), "eh": hashes(F.col("efp")), "nh": hashes(F.col("next_fp"))})
    return d.select(
        "doc_id",
        "n_chars",
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        as_text(F.col("fp")).alias("fingerprint"),
        as_text(F.col("efp")).alias("edited_fingerprint"),
        likeness("h", "eh").alias("near_edited"),
        likeness("h", "nh").alias("near_next"),
    )
