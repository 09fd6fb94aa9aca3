"""Tables laid out for the way they are read: sorted with filters for lookups, in buckets for joins."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.commit import staging

#: Bytes of a row group: a lookup reads whole row groups.
GROUP = 8 << 20


def write_sorted(df: DataFrame, path: str, key: str, others: tuple[str, ...] = (), group: int = GROUP) -> None:
    """Parquet in ranges of ``key``, sorted by it, with bloom filters on ``key`` and ``others``.

    A condition on ``key`` leaves, by the row groups' least and greatest values, one file's row group or a few; one on a
    column of ``others`` leaves those whose filter may hold the value. Ranges are of ``key`` and ``others`` together, so a
    very frequent key is spread over several tasks where the others differ.
    """
    w = df.repartitionByRange(key, *others).sortWithinPartitions(key, *others).write.options(compression="zstd", **{"parquet.block.size": group})
    for c in (key, *others):
        w = w.option(f"parquet.bloom.filter.enabled#{c}", "true").option(f"parquet.bloom.filter.adaptive.enabled#{c}", "true")
    with staging(df.sparkSession, path) as staged:
        w.parquet(staged)


def bucketed(df: DataFrame, path: str, *keys: str, buckets: int | None = None, name: str | None = None) -> DataFrame:
    """``df`` as a table at ``path`` in buckets of ``keys``, one file each: a later join or grouping on ``keys`` needs no exchange of it."""
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = name or f"bucketed_{uuid.uuid4().hex}"
    df.repartition(n, *keys).write.mode("overwrite").options(path=path, compression="zstd").bucketBy(n, *keys).sortBy(*keys).saveAsTable(name)
    return spark.table(name)


#: Keys with more than one in so many rows are frequent; their rows are dealt to so many salts.
SHARE, SALTS = 1_000, 64


def frequent(df: DataFrame, *keys: str) -> DataFrame:
    """The keys that more than one in ``SHARE`` rows have: fewer than ``SHARE`` of them, so they may be broadcast."""
    least = df.count() / SHARE
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > F.greatest(F.lit(least), F.lit(float(SALTS)))).drop("n")


def salted(df: DataFrame, hot: DataFrame, *keys: str) -> DataFrame:
    """``df`` with ``salt``: for rows of frequent keys one of ``SALTS`` by their hash, else 0. In buckets of keys and salt no bucket holds a frequent key whole."""
    salt = F.when(F.col("frequent"), F.pmod(F.xxhash64(*df.columns), F.lit(SALTS))).otherwise(0).cast("int")
    return df.join(F.broadcast(hot.withColumn("frequent", F.lit(True))), list(keys), "left").select(*df.columns, salt.alias("salt"))


def copied(df: DataFrame, hot: DataFrame, *keys: str) -> DataFrame:
    """The other side of a join with ``salted`` rows: rows of frequent keys once for each salt, others once."""
    salts = F.when(F.col("frequent"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return df.join(F.broadcast(hot.withColumn("frequent", F.lit(True))), list(keys), "left").select(*df.columns, F.explode(salts).alias("salt"))


def rows_read(df: DataFrame) -> int:
    """Runs ``df`` and returns how many rows its scans gave, after row groups and pages were left out."""
    df.collect()
    todo, n = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        p = todo.pop()
        if p.nodeName().startswith("AdaptiveSparkPlan"):
            todo.append(p.executedPlan())
        elif "QueryStage" in p.nodeName():
            todo.append(p.plan())
        elif p.nodeName().startswith("Scan "):
            n += p.metrics().apply("numOutputRows").value()
        else:
            todo += [p.children().apply(i) for i in range(p.children().size())]
    return n

