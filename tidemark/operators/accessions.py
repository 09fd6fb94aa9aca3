"""Profiles and filters of the flat accession table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.contract import ACCESSION_COLUMNS
from tidemark.functions.scalars import metric_key, non_missing, prefix_class, try_bigint

PRESENCE = ("Experiment", "Sample", "Study", "Loaded", "BioSample", "BioProject")
#: (metric, source type, reference column, target type) of the dangling reference counts.
REFERENCES = (
    ("run_experiment", "RUN", "Experiment", "EXPERIMENT"),
    ("run_sample", "RUN", "Sample", "SAMPLE"),
    ("run_study", "RUN", "Study", "STUDY"),
    ("experiment_sample", "EXPERIMENT", "Sample", "SAMPLE"),
    ("experiment_study", "EXPERIMENT", "Study", "STUDY"),
    ("sample_study", "SAMPLE", "Study", "STUDY"),
)


def live_public(acc: DataFrame, kind: str | None = None, *columns: str) -> DataFrame:
    """Live and public rows, of one type if given; the plain conditions reach the scan."""
    d = acc.where((F.col("Status") == "live") & (F.col("Visibility") == "public"))
    d = d if kind is None else d.where(F.col("Type") == kind)
    return d.select(*columns) if columns else d


def runs_nonzero_raw(acc: DataFrame) -> DataFrame:
    """Live public runs whose Spots and Bases are, as text, neither ``0`` nor ``-``; '' passes."""
    return live_public(acc, "RUN").where(~F.col("Spots").isin("0", "-") & ~F.col("Bases").isin("0", "-"))


def runs_nonzero_typed(acc: DataFrame) -> DataFrame:
    """Live public runs whose Spots and Bases are whole numbers above 0, with both as long: the downloadable runs."""
    d = live_public(acc, "RUN").withColumns({"Spots_i64": try_bigint("Spots"), "Bases_i64": try_bigint("Bases")})
    return d.where((F.col("Spots_i64") > 0) & (F.col("Bases_i64") > 0))


def in_order(acc: DataFrame) -> DataFrame:
    return acc.select(*ACCESSION_COLUMNS)


def total_rows(acc: DataFrame) -> DataFrame:
    """Rows, and lines of the file with its header."""
    return acc.agg(F.count(F.lit(1)).alias("rows"), (F.count(F.lit(1)) + 1).alias("lines"))


def counts(acc: DataFrame, *by: str) -> DataFrame:
    """Rows by columns (missing values as given); ``prefix`` stands for the prefix class of Accession."""
    return acc.groupBy(*[prefix_class("Accession").alias("prefix") if c == "prefix" else F.col(c) for c in by]).agg(F.count(F.lit(1)).alias("n"))


GROUPS = ((), ("prefix",), ("Type",), ("Status",), ("Visibility",), ("prefix", "Type"), ("Type", "Status"), ("Type", "Visibility"), ("Type", "Status", "Visibility"))


def all_counts(acc: DataFrame) -> DataFrame:
    """All count families in one pass: metric key (``group|value|...``) and n.

    The four columns are grouped together first, map-side; the families are then sums over few rows.
    """
    names = ("prefix", "Type", "Status", "Visibility")
    base = counts(acc, *names)
    key = lambda g: metric_key(F.lit("+".join(g).lower() or "total"), *[F.coalesce(F.col(c), F.lit("-")) for c in g])
    return base.select(F.explode(F.array(*[key(g) for g in GROUPS])).alias("metric"), "n").groupBy("metric").agg(F.sum("n").alias("n"))


def grouping_set_counts(acc: DataFrame) -> DataFrame:
    """The same families as a grouping-sets cube with ``grouping_id``."""
    names = ["prefix", "Type", "Status", "Visibility"]
    d = acc.select(prefix_class("Accession").alias("prefix"), "Type", "Status", "Visibility")
    sets = [[F.col(c) for c in g] for g in GROUPS]
    return d.groupingSets(sets, *names).agg(F.grouping_id(*names).cast("long").alias("gid"), F.count(F.lit(1)).alias("n")).select("gid", *names, "n")


def _long(one: DataFrame, name: str = "metric", value: str = "value") -> DataFrame:
    """A row's columns as (name, value) rows."""
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias(name), F.col(c).cast("long").alias(value)) for c in one.columns])).alias("r")).select("r.*")


def presence_counts(acc: DataFrame) -> DataFrame:
    """Non-missing values of the reference columns, as (metric, value)."""
    return _long(acc.agg(*[F.count_if(non_missing(c)).alias(c) for c in PRESENCE]))


def run_numeric_quality(acc: DataFrame) -> DataFrame:
    """Zero, missing and non-numeric Spots and Bases of all runs, as (metric, value)."""
    aggs: list[Column] = []
    for c in ("Spots", "Bases"):
        aggs += [
            F.count_if(F.col(c) == "0").alias(f"run_{c.lower()}_zero"),
            F.count_if(~non_missing(c)).alias(f"run_{c.lower()}_missing"),
            F.count_if(non_missing(c) & try_bigint(c).isNull()).alias(f"run_{c.lower()}_non_numeric"),
        ]
    return _long(acc.where(F.col("Type") == "RUN").agg(*aggs))


def run_live_public_metrics(acc: DataFrame) -> DataFrame:
    """Thirteen counts over live public runs, as (metric, value), in one pass."""
    present = [F.count_if(non_missing(c)).alias(f"{c.lower()}_non_missing") for c in ("Experiment", "Sample", "Study", "BioSample", "BioProject", "Loaded")]
    missing = [F.count_if(~non_missing(c)).alias(f"{c.lower()}_missing") for c in ("Spots", "Bases")]
    zero = [F.count_if(F.col(c) == "0").alias(f"{c.lower()}_zero") for c in ("Spots", "Bases")]
    both = F.count_if((try_bigint("Spots") > 0) & (try_bigint("Bases") > 0)).alias("spots_gt0_bases_gt0")
    return _long(live_public(acc, "RUN").agg(F.count(F.lit(1)).alias("total"), *present, *missing, *zero, both, F.count_if(non_missing("ReplacedBy")).alias("replacedby_non_missing")))


def dangling(acc: DataFrame, kind: str, column: str, target: str) -> DataFrame:
    """Live public rows of ``kind`` whose reference names no live public ``target``."""
    keys = live_public(acc, target).select(F.col("Accession").alias(column))
    return live_public(acc, kind).where(non_missing(column)).join(keys, column, "left_anti")


def dangling_counts(acc: DataFrame) -> DataFrame:
    """(metric, value) of the six references; each is pre-aggregated by its key before the anti join, so no key is hot."""
    parts = []
    for name, kind, column, target in REFERENCES:
        keys = live_public(acc, target).select(F.col("Accession").alias("key"))
        refs = live_public(acc, kind).where(non_missing(column)).groupBy(F.col(column).alias("key")).agg(F.count(F.lit(1)).alias("n"))
        parts.append(refs.join(keys, "key", "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("value")).select(F.lit(f"{name}_not_found").alias("metric"), "value"))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def relation_metrics(acc: DataFrame) -> DataFrame:
    """The dangling counts and the number of live public experiments."""
    total = live_public(acc, "EXPERIMENT").agg(F.count(F.lit(1)).alias("value")).select(F.lit("experiment_total").alias("metric"), "value")
    return dangling_counts(acc).union(total)


def merged_counters(*partials: DataFrame) -> DataFrame:
    """Stored partial counts (metric, n) added up."""
    out = partials[0]
    for p in partials[1:]:
        out = out.unionByName(p)
    return out.groupBy("metric").agg(F.sum("n").alias("n"))


def distinct_keys(acc: DataFrame, kind: str) -> DataFrame:
    return live_public(acc, kind).select("Accession").distinct()


def sorted_counts(acc: DataFrame, by: str) -> DataFrame:
    """Counts, the largest first, ties by value."""
    return counts(acc, by).orderBy(F.desc("n"), by)
