"""One validation of an index: files drawn from it are read again, held against all its tables, measured and judged."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import backcheck as B
from tidemark.operators import index as I
from tidemark.operators import sampling as S
from tidemark.operators import validate as V

#: Fields of core tables that are ids given by others; the rest of a core table's fields are its core.
IDS = ("bio_sample_id", "bioproject_id", "taxon_id")
_IDS_OF = ("source_snapshot_id", "entity_record_id", "file_id")


def drawn(file_index: DataFrame, n: int, seed: int | str, abnormal: int | None = None) -> DataFrame:
    """file_id of ``n`` well parsed files by hash and the abnormal ones (all, or ``abnormal`` by hash)."""
    good = file_index.where((F.col("parse_status") == "ok") & (F.col("xml_kind_consistency_status") == "consistent"))
    return S.with_abnormal(S.random_sample(good, "file_id", n, seed, checked=False).select("file_id"), I.abnormal_files(file_index), "file_id", seed, abnormal)


def _own(table: DataFrame, files: DataFrame) -> DataFrame:
    """Rows of the drawn files; there are as many as were drawn, so their ids may be broadcast."""
    return table.join(F.broadcast(files), "file_id", "left_semi")


def fields(second: dict[str, DataFrame], cores: dict[str, DataFrame], files: DataFrame) -> DataFrame:
    """table, column, metric, checks, matches, missing_rows, extra_rows, mismatches of every field that both readings have."""
    out = None
    for kind, entities in second.items():
        name = f"{kind.lower()}_core"
        if name not in cores:
            continue
        again = B.core(entities, kind)
        columns = [c for c in cores[name].columns if c in again.columns and c not in _IDS_OF]
        d = V.field_check(again, _own(cores[name], files), ["entity_record_id"], columns)
        metric = F.when(F.col("column").isin(*IDS), "ids").otherwise("core").alias("metric")
        d = d.select(F.lit(name).alias("table"), "column", metric, "checks", "matches", "missing_rows", "extra_rows", "mismatches")
        out = d if out is None else out.union(d)
    return out


def _multiset(found: DataFrame, name: str, metric: str) -> DataFrame:
    """A comparison of multisets by file in the columns of ``fields``."""
    n = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return found.agg(n(F.col("matched") + F.col("missing") + F.col("extra")).alias("checks"), n("matched").alias("matches"), n("missing").alias("missing_rows"), n("extra").alias("extra_rows")).select(F.lit(name).alias("table"), F.lit(None).cast("string").alias("column"), F.lit(metric).alias("metric"), "checks", "matches", "missing_rows", "extra_rows", F.lit(0).cast("long").alias("mismatches"))


def compared(files: DataFrame, file_index: DataFrame, tables: dict[str, DataFrame] | Callable[[DataFrame], dict[str, DataFrame]], snapshot: str, work: str, n: int = 1_000, seed: int | str = 42, abnormal: int | None = None) -> DataFrame:
    """The rows of ``fields`` for all core tables, and one for the edges and one for the attributes.

    ``files`` has path and content, ``tables`` core tables, relation_index and sample_attribute_core by name, or makes
    them of the drawn files (file_id), so that tables that are no files needn't be made whole. The drawn files are
    written below ``work`` once, then read by kind.
    """
    spark = files.sparkSession
    drawn(file_index, n, seed, abnormal).distinct().write.parquet(f"{work}/drawn")
    chosen = spark.read.parquet(f"{work}/drawn")
    _own(files.select("path", "content", B.file_id(snapshot)), chosen).write.parquet(f"{work}/files")
    own = spark.read.parquet(f"{work}/files")
    tables = tables(chosen) if callable(tables) else tables
    again = {k: B.reread(own, snapshot, k) for k in B.KINDS}
    edges = reduce(DataFrame.union, [B.edges(again[k], k) for k in B.KINDS if k in B.EDGES])
    out = fields(again, tables, chosen)
    out = out.union(_multiset(V.edge_check(edges, _own(tables["relation_index"], chosen)), "relation_index", "edges"))
    return out.union(_multiset(V.attribute_check(B.attributes(again["SAMPLE"]), _own(tables["sample_attribute_core"], chosen)), "sample_attribute_core", "attributes"))


def measured(found: DataFrame) -> DataFrame:
    """metric, checks, matches, mismatches (missing and extra rows too) and accuracy."""
    g = found.groupBy("metric").agg(F.sum("checks").alias("checks"), F.sum("matches").alias("matches"))
    return g.withColumns({"mismatches": F.col("checks") - F.col("matches"), "accuracy": V.safe_ratio("matches", "checks")})


def judged(found: DataFrame, thresholds: dict[str, float] | None = None) -> DataFrame:
    """``measured`` with threshold and status; metrics without a threshold are only told."""
    status: Column = F.when(F.col("threshold").isNull(), "report_only").otherwise(F.col("status"))
    return V.within_thresholds(measured(found), thresholds or V.THRESHOLDS).withColumn("status", status)
