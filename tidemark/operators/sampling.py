"""Manifests and deterministic samples. Order is by md5 of the id and a seed, so a sample doesn't depend on partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import stable_id
from tidemark.operators.apportion import quotas


def hash_order(key: str, seed: int | str) -> Column:
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))


def _checked(df: DataFrame, n: int) -> None:
    if n <= 0 or n > df.count():
        raise ValueError(f"a sample of {n} can't be drawn")


def random_sample(df: DataFrame, key: str, n: int, seed: int | str, checked: bool = True) -> DataFrame:
    """``n`` rows without replacement; an error where ``n`` is no size of a sample of ``df``."""
    if checked:
        _checked(df, n)
    return df.orderBy(hash_order(key, seed), key).limit(n)


def sample_with_all(files: DataFrame, unit: str, n: int, seed: int | str) -> DataFrame:
    """``n`` units (directories) by hash, and all their rows of ``files``. The chosen units are at most ``n`` rows."""
    chosen = random_sample(files.select(unit).distinct(), unit, n, seed, checked=False)
    return files.join(chosen, unit, "left_semi")


def with_abnormal(sampled: DataFrame, abnormal: DataFrame, key: str, seed: int | str, n: int | None = None) -> DataFrame:
    """``sampled`` and the abnormal rows (all, or ``n`` by hash) that aren't in it."""
    more = abnormal if n is None else random_sample(abnormal, key, n, seed, checked=False)
    return sampled.unionByName(more.select(*sampled.columns).join(sampled.select(key), key, "left_anti"))


def largest(files: DataFrame, unit: str, size: str, n: int, seed: int | str) -> DataFrame:
    """Of a pool of max(5 n, 5000) units by hash, the ``n`` with the most bytes; ties by name, the later first."""
    pool = files.groupBy(unit).agg(F.sum(size).alias("bytes"))
    pool = random_sample(pool, unit, max(5 * n, 5000), seed, checked=False)
    return pool.orderBy(F.desc("bytes"), F.desc(unit)).limit(n)


def stratified(df: DataFrame, key: str, stratum: Column, n: int, seed: int | str) -> DataFrame:
    """``n`` rows in proportion to the strata, of which there may be any number (``apportion.quotas``).

    A stratum's rows lie in 256 ranges of their hashes, whose sizes tell which ranges its quota reaches into; only rows of
    these are exchanged and ordered, each range by itself, so no task orders a whole stratum.
    """
    d = df.withColumn("stratum", stratum).withColumn("order", hash_order(key, seed))
    q = quotas(d.groupBy("stratum").agg(F.count(F.lit(1)).alias("count")), n)
    d = d.withColumn("part", F.substring("order", 1, 2))  # the first of 256 ranges of the hash's order
    sizes = d.groupBy("stratum", "part").agg(F.count(F.lit(1)).alias("size"))
    before = F.coalesce(F.sum("size").over(Window.partitionBy("stratum").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = sizes.join(q, sizes["stratum"].eqNullSafe(q["stratum"])).select(sizes["stratum"].alias("s"), "part", "quota", "size").withColumn("stratum", F.col("s"))
    ranges = ranges.withColumn("left", F.col("quota") - before).where("left > 0").select("s", F.col("part").alias("p"), "left")
    own = d.join(ranges, d["stratum"].eqNullSafe(ranges["s"]) & (d["part"] == ranges["p"])).drop("s", "p")
    rn = F.row_number().over(Window.partitionBy("stratum", "part").orderBy("order", key))
    return own.withColumn("rn", rn).where((F.col("rn") <= n) & (F.col("rn") <= F.col("left"))).drop("rn", "stratum", "part", "order", "left")


def mixed(files: DataFrame, unit: str, size: str, n: int, seed: int | str) -> DataFrame:
    """int(0.7 n) stratified units, int(0.2 n) large ones, the others by hash; no unit twice."""
    units = files.select(unit).distinct()
    a = stratified(units, unit, F.substring(unit, 1, 3), int(0.7 * n), seed).select(unit)
    b = largest(files.join(a, unit, "left_anti"), unit, size, int(0.2 * n), seed).select(unit)
    left = units.join(a, unit, "left_anti").join(b, unit, "left_anti")
    return a.union(b).union(random_sample(left, unit, n - int(0.7 * n) - int(0.2 * n), seed, checked=False))


def bounded_examples(df: DataFrame, group: str, order: list[str], k: int = 50) -> DataFrame:
    """At most ``k`` rows a group."""
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k).drop("rn")


def row_ids(df: DataFrame, key: str) -> DataFrame:
    """``df`` with 0-based ``row_id`` in the order of the distinct ``key``, without one task sorting all.

    Rows are dealt to ranges whose bounds are a bounded sample of the keys (20 a partition, the first by md5); a range's
    offset comes from the ranges' sizes, one row each.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    some = sorted(r[0] for r in df.select(key).where(F.col(key).isNotNull()).orderBy(F.md5(F.col(key).cast("string"))).limit(20 * parts).collect())
    limits = F.array(*[F.lit(b) for b in some[:: max(1, len(some) // parts)]]) if some else F.array().cast("array<string>")
    keyed = df.withColumn("bucket", F.size(F.filter(limits, lambda b: b <= F.col(key))))
    sizes = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"))
    before = sizes.withColumn("before", F.coalesce(F.sum("size").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("size")
    w = Window.partitionBy("bucket").orderBy(key)
    return keyed.withColumn("rn", F.row_number().over(w)).join(F.broadcast(before), "bucket").withColumn("row_id", (F.col("before") + F.col("rn") - 1).cast("long")).drop("rn", "before", "bucket")


def directory_manifest(directories: DataFrame, snapshot: str, root: str = "") -> DataFrame:
    """The sorted distinct directories below ``root`` with their row number and id."""
    d = row_ids(directories.select("directory_accession").distinct(), "directory_accession")
    return d.select(F.lit(snapshot).alias("source_snapshot_id"), F.col("row_id").alias("manifest_row_id"), stable_id(F.lit(snapshot), "directory_accession").alias("directory_id"), "directory_accession", F.substring("directory_accession", 1, 3).alias("directory_prefix"), F.col("directory_accession").alias("relative_directory_path"), F.concat(F.lit(f"{root}/"), "directory_accession").alias("absolute_directory_path"))


def chunk_manifest(manifest: DataFrame, size: int) -> DataFrame:
    """Runs of ``size`` manifest rows."""
    g = manifest.groupBy(F.floor(F.col("manifest_row_id") / size).alias("c")).agg(F.min("manifest_row_id").alias("manifest_row_id_start"), F.max("manifest_row_id").alias("manifest_row_id_end"), F.count(F.lit(1)).alias("row_count"))
    name = F.format_string("chunk_%08d_%08d", "manifest_row_id_start", "manifest_row_id_end")
    return g.select(name.alias("chunk_id"), F.col("manifest_row_id_start").alias("start_row"), "row_count", "manifest_row_id_start", "manifest_row_id_end", F.col("row_count").alias("expected_directory_count"))


def pending(chunks: DataFrame, done: DataFrame) -> DataFrame:
    """Chunks of the plan that no ledger row calls done."""
    return chunks.join(done.where("exit_code = 0").select("chunk_id"), "chunk_id", "left_anti")


def completeness(chunks: DataFrame, done: DataFrame) -> DataFrame:
    missing = pending(chunks, done).agg(F.count(F.lit(1)).alias("missing_chunks"))
    return missing.withColumn("status", F.when(F.col("missing_chunks") == 0, "pass").otherwise("fail"))


def listed_directories(listed: DataFrame, existing: DataFrame) -> DataFrame:
    """Trimmed, distinct, sorted names of a list; an error if one isn't among the existing directories."""
    names = listed.select(F.trim("directory_accession").alias("directory_accession")).where("directory_accession <> ''").distinct()
    if (lost := names.join(existing, "directory_accession", "left_anti").limit(1).collect()):
        raise ValueError(f"no such directory: {lost[0][0]}")
    return names.orderBy("directory_accession")


def select_directories(files: DataFrame, how: str, n: int = 0, seed: int | str = 0, listed: DataFrame | None = None) -> DataFrame:
    """The directories of a subset: targeted, deterministic_random, prefix_stratified, stress_mixed or full."""
    unit = "directory_accession"
    every = files.select(unit).distinct()
    if how == "targeted":
        return listed_directories(listed, every)
    if how == "deterministic_random":
        return random_sample(every, unit, n, seed)
    if how == "prefix_stratified":
        return stratified(every, unit, F.substring(unit, 1, 3), n, seed)
    if how == "stress_mixed":
        return mixed(files, unit, "file_size", n, seed)
    if how == "full":
        return every
    raise ValueError(f"unknown subset: {how}")
