"""Readers and writers of flat tables and index tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import contract as C
from tidemark.sources.commit import staging

#: Columns of an assembly summary that this library reads, in the file's order of 38.
ASSEMBLY_FIELDS = (
    "assembly_accession", "bioproject", "biosample", "wgs_master", "refseq_category", "taxid", "species_taxid", "organism_name", "infraspecific_name", "isolate",
    "version_status", "assembly_level", "release_type", "genome_rep", "seq_rel_date", "asm_name", "asm_submitter", "gbrs_paired_asm", "paired_asm_comp", "ftp_path",
    "excluded_from_refseq", "relation_to_type_material", "asm_not_live_date", "assembly_type", "group", "genome_size", "genome_size_ungapped", "gc_percent", "replicon_count", "scaffold_count",
    "contig_count", "annotation_provider", "annotation_name", "annotation_date", "total_gene_count", "protein_coding_gene_count", "non_coding_gene_count", "pubmed_id",
)


def read_tsv(spark: SparkSession, path: str, schema: T.StructType = C.ACCESSION_SCHEMA) -> DataFrame:
    """Tab-separated text with a header that must match; no quotes or escapes, all columns strings, empty stays ''."""
    raw = spark.read.schema(schema).options(sep="\t", header=True, quote="", escape="", mode="FAILFAST", enforceSchema=False).csv(path)
    return raw.select(*[F.coalesce(c, F.lit("")).alias(c) for c in raw.columns])


def tsv_shape(spark: SparkSession, path: str, columns: int = len(C.ACCESSION_COLUMNS)) -> DataFrame:
    """Lines by number of fields, and whether it is right; blank lines are left out, a trailing CR is dropped."""
    lines = spark.read.text(path).select(F.regexp_replace("value", "\r$", "").alias("v")).where("v <> ''")
    return lines.groupBy(F.size(F.split("v", "\t")).alias("fields")).agg(F.count(F.lit(1)).alias("n")).withColumn("ok", F.col("fields") == columns)


def tsv_faults(spark: SparkSession, path: str, columns: tuple[str, ...] = C.ACCESSION_COLUMNS) -> DataFrame:
    """The malformed lines below ``path``: file, line (from 1), offset (bytes), fields, fault, record.

    A fault is ``header`` (a file's first line isn't the columns' names), ``blank``, ``carriage_return`` (at the line's
    end), ``short`` or ``long`` (fields). Lines are read in parts of files, as Spark cuts them; a task counts lines and
    bytes of its parts and keeps only faulty lines, and the sums of the parts before give their place in the file.
    """
    raw = spark.read.option("lineSep", "\n").text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    tab, head = len(columns) - 1, "\t".join(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, line, offset = None, 0, 0
        for b in batches:
            files, blocks = b.column(1).to_pylist(), b.column(2).to_pylist()
            cuts = [k for k in range(1, len(files)) if (files[k], blocks[k]) != (files[k - 1], blocks[k - 1])]
            for lo, hi in zip([0, *cuts], [*cuts, len(files)], strict=True):
                if (files[lo], blocks[lo]) != at:
                    at, line, offset = (files[lo], blocks[lo]), 0, 0
                v = b.column(0).slice(lo, hi - lo)
                tabs, cr, size = pc.count_substring(v, "\t").to_numpy(), pc.ends_with(v, "\r").to_numpy(zero_copy_only=False), pc.binary_length(v).to_numpy().astype(np.int64)
                blank = size - cr == 0
                first = np.zeros(hi - lo, bool)
                first[0] = blocks[lo] == 0 and line == 0
                wrong = np.array([first[0] and v[0].as_py().removesuffix("\r") != head] + [False] * (hi - lo - 1))
                starts = offset + np.cumsum(size + 1) - size - 1
                kind = np.select([wrong, blank, cr, ~first & (tabs < tab), ~first & (tabs > tab)], ["header", "blank", "carriage_return", "short", "long"], "")
                if len(bad := np.flatnonzero(kind != "")):
                    yield pa.RecordBatch.from_arrays([pa.array([at[0]] * len(bad)), pa.array([at[1]] * len(bad), pa.int64()), pa.array(bad + line), pa.array(starts[bad]), pa.array(tabs[bad] + 1).cast(pa.int64()), pa.array(kind[bad].tolist()), v.take(pa.array(bad))], names=["file", "block", "line", "offset", "fields", "fault", "record"])
                line, offset = line + hi - lo, int(starts[-1] + size[-1] + 1)

    found = raw.mapInArrow(run, "file string, block long, line long, offset long, fields long, fault string, record string")
    parts = raw.groupBy("file", "block").agg(F.count(F.lit(1)).alias("lines"), F.sum(F.octet_length("value") + 1).alias("bytes"))
    before = lambda c: F.coalesce(F.sum(c).over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = found.join(parts.select("file", "block", before("lines").alias("l"), before("bytes").alias("o")), ["file", "block"])
    return placed.select("file", (F.col("line") + F.col("l") + 1).alias("line"), (F.col("offset") + F.col("o")).alias("offset"), "fields", "fault", "record")


def read_partition(spark: SparkSession, root: str, kind: str | None = None) -> DataFrame:
    """A table written by ``write_by_type``, or one type of it by partition pruning."""
    d = spark.read.parquet(root)
    return d if kind is None else d.where(F.col("Type") == kind)


def read_assemblies(spark: SparkSession, path: str) -> DataFrame:
    """An assembly summary: comment lines start with ``#``, all 38 fields as strings, empty ones ''."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ASSEMBLY_FIELDS])
    raw = spark.read.schema(schema).options(sep="\t", comment="#", quote="", escape="").csv(path)
    return raw.select(*[F.coalesce(f"`{c}`", F.lit("")).alias(c) for c in raw.columns])


def open_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The table at the contract's path, ``<root>/<name>.parquet`` or ``<root>/<name>/data.parquet``, with the contract's columns."""
    jvm = spark._jvm.org.apache.hadoop.fs.Path
    for path in (f"{root}/{C.path(name)}", f"{root}/{name}.parquet", f"{root}/{name}/data.parquet"):
        p = jvm(path)
        if p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
            return spark.read.schema(C.schema(name)).parquet(path)
    raise FileNotFoundError(f"{root}: {name}")


def read_parts(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """All parts of a table; Spark fails if a path is missing."""
    return spark.read.schema(schema).parquet(*paths)


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def write_by_type(acc: DataFrame, path: str) -> None:
    """Zstandard Parquet, a folder for each Type."""
    acc.write.mode("overwrite").options(compression="zstd", **{"parquet.compression.codec.zstd.level": "3"}).partitionBy("Type").parquet(path)


def write_counted(df: DataFrame, path: str) -> int:
    """Writes Parquet and returns the number of rows, counted on the way."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").option("compression", "zstd").parquet(path)
    return seen.get["n"]


def write_pilot(acc: DataFrame, path: str, n: int = 1_000_000) -> int:
    """The first ``n`` rows, by partition and place in it; an error unless min(n, all) were written.

    Partitions are counted, and each then writes its own share, so no task reads the rows of all. A number a partition
    comes to the driver.
    """
    at = acc.withColumn("_at", F.monotonically_increasing_id())
    sizes = {r["p"]: r["rows"] for r in at.groupBy(F.shiftright("_at", 33).alias("p")).agg(F.count(F.lit(1)).alias("rows")).collect()}
    want = min(n, sum(sizes.values()))
    last, left = -1, want  # the partition that the n-th row is in, and how many of its rows are among the first n
    for p in sorted(sizes):
        if left <= 0:
            break
        last, taken = p, min(left, sizes[p])
        left -= taken
    end = (last << 33) + taken if last >= 0 else 0
    found = write_counted(at.where(F.col("_at") < end).drop("_at"), path)
    if found != want:
        raise ValueError(f"{found} rows written, {want} expected")
    return found


def write_tsv(df: DataFrame, path: str, one: bool = True) -> None:
    """A small table as one tab-separated file with a header, even without rows; not ``one``: a file for each partition."""
    (df.coalesce(1) if one else df).write.mode("overwrite").options(sep="\t", header=True, emptyValue="", quote="\u0000").csv(path)


def write_summary(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").json(path)


def to_contract(df: DataFrame, name: str) -> DataFrame:
    """The contract's columns in order and type; a null in a required column fails the job."""
    checked = lambda f: F.col(f.name) if f.nullable else F.when(F.col(f.name).isNull(), F.raise_error(F.lit(f"{name}.{f.name} is null"))).otherwise(F.col(f.name))
    return df.select(*[checked(f).cast(f.dataType).alias(f.name) for f in C.schema(name)])


def write_contract(df: DataFrame, path: str, name: str) -> int:
    """Writes a contract table beside ``path``, reads it back, compares names, types and rows, and only then puts it in place.

    After an error the former table is as it was, and may be what ``df`` reads.
    """
    with staging(df.sparkSession, path) as staged:
        n = write_counted(to_contract(df, name), staged)
        back = df.sparkSession.read.parquet(staged)
        if [(f.name, f.dataType) for f in back.schema] != [(f.name, f.dataType) for f in C.schema(name)] or back.count() != n:
            raise ValueError(f"{name}: written table differs")
    return n


def write_empty(spark: SparkSession, root: str, names: list[str] | None = None) -> None:
    """Tables of the contract without rows."""
    for name in names or C.TABLES:
        spark.createDataFrame([], C.schema(name)).write.mode("overwrite").parquet(f"{root}/{C.path(name)}")
