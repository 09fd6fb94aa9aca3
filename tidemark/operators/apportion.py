"""Quotas of strata by ranks and sums over the strata; no stratum comes to the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Levels that one pass over the strata tries.
TRIED = 64


def _level(strata: DataFrame, height: Column, units: int) -> tuple[int, int]:
    """The least level that leaves at most ``units`` above it over all strata, and how many of them are then still to be given.

    Each pass over the strata sums what stands above ``TRIED`` levels, so a few passes find it for heights of any size.
    """
    top = strata.agg(F.coalesce(F.max(height), F.lit(0)).alias("top")).first()["top"]
    low, high = 0, max(0, top)  # the level is in low..high
    while True:
        step = max(1, -(-(high - low) // TRIED))
        levels = list(range(low, high + 1, step))
        above = strata.agg(*[F.coalesce(F.sum(F.greatest(height - F.lit(v), F.lit(0))), F.lit(0)).alias(f"v{k}") for k, v in enumerate(levels)]).first()
        fits = [k for k in range(len(levels)) if above[k] <= units]
        if fits and step == 1:
            return levels[fits[0]], units - above[fits[0]]
        if fits:
            low, high = (levels[fits[0] - 1] + 1 if fits[0] else low), levels[fits[0]]
        else:
            low = levels[-1] + 1


def _moved(strata: DataFrame, height: Column, units: int) -> DataFrame:
    """``strata`` with ``moved``: how many of ``units`` each gives if the highest gives one at a time, of equal ones the last by name."""
    level, rest = _level(strata, height, units)
    last = strata.where((height >= level) & (height > 0)).orderBy(F.desc("stratum")).limit(rest).select(F.col("stratum").alias("s"), F.lit(1).alias("more"))
    joined = strata.join(last, strata["stratum"].eqNullSafe(last["s"]), "left").drop("s")
    return joined.withColumn("moved", F.greatest(height - F.lit(level), F.lit(0)) + F.coalesce("more", F.lit(0))).drop("more")


def quotas(strata: DataFrame, n: int) -> DataFrame:
    """stratum, quota of ``strata`` (stratum, count): its share of ``n`` rounded half to even, 1 at least, then changed until they make ``n``.

    Too many: the largest quota gives one up, again and again. Too few: the stratum with most members left gets one. Ties
    by name. Both are read off a level: what stands above it moves, and of those that reach it the last by name.
    """
    total = strata.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("n")).first()["n"]
    share = F.bround(F.lit(n) * F.col("count").cast("double") / F.lit(float(max(total, 1))), 0).cast("long")
    d = strata.select("stratum", "count", F.least("count", F.greatest(F.lit(1).cast("long"), share)).alias("quota"))
    have = d.agg(F.coalesce(F.sum("quota"), F.lit(0)).alias("n")).first()["n"]
    if have > n:
        d = _moved(d, F.col("quota"), have - n).withColumn("quota", F.col("quota") - F.col("moved"))
    elif have < n:
        d = _moved(d, F.col("count") - F.col("quota"), min(n, total) - have).withColumn("quota", F.col("quota") + F.col("moved"))
    return d.select("stratum", "quota")
