"""Checks of schemas, values, counts and sources. Each returns rows; gates raise."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import contract as C
from tidemark.functions.scalars import bool_text, safe_ratio
from tidemark.operators.compare import multiset_compare

THRESHOLDS = {"core": 0.999, "edges": 0.999, "ids": 0.995}


def schema_errors(spark: SparkSession, tables: dict[str, DataFrame], expected: list[str]) -> DataFrame:
    """(table, column, error): missing tables and columns, other types, unexpected columns, nulls in required columns."""
    rows, checks = [], None
    for name in expected:
        if name not in tables:
            rows.append((name, None, "missing table"))
            continue
        have, want = {f.name: f.dataType for f in tables[name].schema}, C.schema(name)
        for f in want:
            if f.name not in have:
                rows.append((name, f.name, "missing column"))
            elif have[f.name] != f.dataType:
                rows.append((name, f.name, f"type {have[f.name].simpleString()} instead of {f.dataType.simpleString()}"))
        rows += [(name, c, "unexpected column") for c in have if c not in want.names]
        required = [f.name for f in want if not f.nullable and f.name in have]
        if required:
            nulls = tables[name].agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
            found = nulls.select(F.explode(F.array(*[F.struct(F.lit(name).alias("table"), F.lit(c).alias("column"), F.col(c).alias("n")) for c in required])).alias("r")).select("r.table", "r.column", F.lit("null in required column").alias("error"), "r.n").where("n > 0").drop("n")
            checks = found if checks is None else checks.unionByName(found)
    out = spark.createDataFrame(rows, "table string, column string, error string")
    return out if checks is None else out.unionByName(checks)


def enum_errors(table: DataFrame, name: str) -> DataFrame:
    """(table, column, value) of values outside their enumeration."""
    out = None
    for (t, c), allowed in C.ENUMS.items():
        if t == name and c in table.columns:
            d = table.select(F.lit(t).alias("table"), F.lit(c).alias("column"), F.col(c).alias("value")).where(F.col("value").isNotNull() & ~F.col("value").isin(*allowed)).distinct()
            out = d if out is None else out.union(d)
    return out


def all_enum_errors(tables: dict[str, DataFrame]) -> DataFrame:
    """``enum_errors`` of every table that has enumerations."""
    out = None
    for name in dict.fromkeys(t for t, _ in C.ENUMS if t in tables):
        d = enum_errors(tables[name], name)
        out = d if out is None or d is None else out.union(d)
    return out


def field_check(expected: DataFrame, actual: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """By column: checks, matches, and rows that are missing, extra or of another value. Null equals ''."""
    text = lambda c: F.coalesce(bool_text(c), F.lit(""))
    pack = lambda d, n: d.select(*keys, F.struct(*[text(c).alias(c) for c in columns]).alias(n))
    j = pack(expected, "e").join(pack(actual, "a"), keys, "full_outer")
    what = lambda c: F.when(F.col("a").isNull(), "missing_row").when(F.col("e").isNull(), "extra_row").when(F.col(f"e.{c}") == F.col(f"a.{c}"), "match").otherwise("mismatch")
    long = j.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), what(c).alias("what")) for c in columns])).alias("r")).select("r.*")
    n = lambda w: F.count_if(F.col("what") == w)
    return long.groupBy("column").agg(F.count(F.lit(1)).alias("checks"), n("match").alias("matches"), n("missing_row").alias("missing_rows"), n("extra_row").alias("extra_rows"), n("mismatch").alias("mismatches"))


def edge_check(expected: DataFrame, actual: DataFrame) -> DataFrame:
    return multiset_compare(expected, actual, "file_id", ["src_accession", "src_type", "relation_type", "dst_accession", "dst_type"])


def attribute_check(expected: DataFrame, actual: DataFrame) -> DataFrame:
    return multiset_compare(expected, actual, "file_id", ["sample_accession", "bio_sample_id", "tag", "value", "attribute_ordinal", "value_truncated"])


def absent_where_abnormal(abnormal: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """(table, rows) that come from abnormal files; all should be 0."""
    out = None
    for name, t in tables.items():
        d = t.join(abnormal.select("file_id"), "file_id", "left_semi").agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        out = d if out is None else out.union(d)
    return out


def within_thresholds(measured: DataFrame, thresholds: dict[str, float] = THRESHOLDS) -> DataFrame:
    """``measured`` (metric, accuracy) with the metric's threshold and pass or fail; no accuracy fails."""
    limit = F.create_map(*[x for k, v in thresholds.items() for x in (F.lit(k), F.lit(v))])[F.col("metric")]
    return measured.withColumn("threshold", limit).withColumn("status", F.when(F.col("accuracy") >= F.col("threshold"), "pass").otherwise("fail"))


def reconciled(totals: DataFrame, found: DataFrame) -> DataFrame:
    """Rows counted in the parts against rows of the whole, by table."""
    j = totals.select("table", F.col("n").alias("expected")).join(found.select("table", F.col("n").alias("actual")), "table", "full_outer")
    return j.withColumn("match", F.col("expected").eqNullSafe(F.col("actual")))


def row_totals(status: DataFrame) -> DataFrame:
    """Rows by table over chunks that ended well; ``row_counts`` is a map of table to rows."""
    return status.where("exit_code = 0").select(F.explode("row_counts").alias("table", "n")).groupBy("table").agg(F.sum("n").alias("n"))
