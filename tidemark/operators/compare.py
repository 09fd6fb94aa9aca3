"""Comparison of counts, key sets and multisets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def compare_counts(observed: DataFrame, expected: DataFrame, key: str = "metric", value: str = "n") -> DataFrame:
    """Full outer comparison: key, observed, expected, delta (a missing side counts as 0) and match."""
    a = observed.select(F.col(key).alias("key"), F.col(value).cast("long").alias("observed"))
    b = expected.select(F.col(key).alias("key"), F.col(value).cast("long").alias("expected"))
    j = a.join(b, "key", "full_outer")
    delta = F.coalesce("observed", F.lit(0).cast("long")) - F.coalesce("expected", F.lit(0).cast("long"))
    return j.select("key", "observed", "expected", delta.alias("delta"), F.col("observed").eqNullSafe(F.col("expected")).alias("match"))


def status(compared: DataFrame) -> DataFrame:
    """One row: pass if every key matches."""
    bad = F.count_if(~F.col("match"))
    return compared.agg(F.count(F.lit(1)).alias("checks"), bad.alias("mismatches"), F.when(bad == 0, "pass").otherwise("fail").alias("status"))


def extra_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys of ``a`` that ``b`` lacks."""
    return a.select(key).distinct().join(b.select(key), key, "left_anti")


def key_union(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.select(key).union(b.select(key)).distinct().orderBy(key)


def multiset_compare(expected: DataFrame, actual: DataFrame, group: str, keys: list[str]) -> DataFrame:
    """By ``group``: rows of the multisets of ``keys`` that match, are missing and are extra; nulls equal nulls."""
    cols = [group, *keys]
    packed = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})
    count = lambda d, n: d.select(*cols).groupBy(F.col(group), packed.alias("row")).agg(F.count(F.lit(1)).alias(n))
    j = count(expected, "e").join(count(actual, "a"), [group, "row"], "full_outer")
    e, a = F.coalesce("e", F.lit(0).cast("long")), F.coalesce("a", F.lit(0).cast("long"))
    return j.groupBy(group).agg(F.sum(F.least(e, a)).alias("matched"), F.sum(F.greatest(e - a, F.lit(0).cast("long"))).alias("missing"), F.sum(F.greatest(a - e, F.lit(0).cast("long"))).alias("extra"))


def deduped_union(first: DataFrame, *others: DataFrame, key: str) -> DataFrame:
    """Rows of the first frame, then of each other one those whose key isn't there yet."""
    out = first.dropDuplicates([key])
    for o in others:
        out = out.unionByName(o.dropDuplicates([key]).join(out.select(key), key, "left_anti").select(*first.columns))
    return out
