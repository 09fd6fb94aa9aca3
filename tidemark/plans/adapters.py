"""The driver's tables in the shapes that the operators work on. The SQL runs in Spark and, for the oracles, in DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.contract import ACCESSION_COLUMNS

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages")
_PREFIX = "CASE {k} % 3 WHEN 0 THEN 'SRA' WHEN 1 THEN 'ERA' ELSE 'DRA' END"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _part(source: str, **columns: str) -> str:
    return "SELECT " + ", ".join(f"{columns.get(c, "'-'")} AS {c}" for c in ACCESSION_COLUMNS) + f" FROM {source}"


_Q = "cast(l_quantity AS bigint)"
ACC_SQL = " UNION ALL ".join([
    _part("{lineitem}", Accession="concat('SRR', l_orderkey, '_', l_linenumber)", Submission=f"concat({_PREFIX.format(k='l_suppkey')}, l_suppkey)",
          Status="CASE WHEN l_linestatus = 'O' OR l_returnflag = 'A' THEN 'live' WHEN l_returnflag = 'R' THEN 'suppressed' ELSE 'unpublished' END", Type="'RUN'",
          Visibility="CASE WHEN l_partkey % 10 = 0 THEN 'controlled_access' ELSE 'public' END", Experiment="CASE l_orderkey % 11 WHEN 0 THEN '-' WHEN 1 THEN '' ELSE concat('SRX', l_orderkey) END",
          Sample="concat('SRS', l_suppkey)", Study="concat('SRP', l_suppkey % 30)", BioSample="concat('SAMN', l_partkey)", BioProject="CASE WHEN l_suppkey % 5 = 0 THEN '-' ELSE concat('PRJNA', l_suppkey % 30) END",
          Spots=f"CASE {_Q} WHEN 1 THEN '-' WHEN 2 THEN '0' WHEN 3 THEN '' WHEN 4 THEN 'n/a' ELSE concat('', {_Q}) END", Bases=f"CASE {_Q} WHEN 1 THEN '-' WHEN 5 THEN '0' WHEN 6 THEN '' ELSE concat('', {_Q} * 100) END"),
    _part("{orders}", Accession="concat('SRX', o_orderkey)", Submission="concat('SRA', o_custkey)", Status="CASE WHEN o_orderstatus = 'P' THEN 'suppressed' ELSE 'live' END", Type="'EXPERIMENT'",
          Visibility="CASE WHEN o_custkey % 10 = 0 THEN 'controlled_access' ELSE 'public' END", Sample="concat('SRS', o_custkey)", Study="concat('SRP', o_custkey % 30)"),
    _part("{customer}", Accession="concat('SRS', c_custkey)", Submission="concat('ERA', c_custkey)", Status="CASE WHEN c_acctbal < 0 THEN 'unpublished' ELSE 'live' END", Type="'SAMPLE'", Visibility="'public'",
          Study="concat('SRP', c_nationkey)", BioSample="concat('SAMN', c_custkey)"),
    _part("{nation}", Accession="concat('SRP', n_nationkey)", Status="CASE WHEN n_regionkey = 0 THEN 'withdrawn' ELSE 'live' END", Type="'STUDY'", Visibility="'public'", BioProject="concat('PRJNA', n_nationkey)"),
    _part("{supplier}", Accession=f"concat({_PREFIX.format(k='s_suppkey')}, s_suppkey)", Status="'live'", Type="'SUBMISSION'", Visibility="'public'"),
    _part("{part}", Accession="concat('SRZ', p_partkey)", Status="'live'", Type="'ANALYSIS'", Visibility="'public'"),
])


def in_spark(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    return spark.sql(sql, **{t: table(spark, sf_dir, t) for t in TABLES if f"{{{t}}}" in sql})


def in_duckdb(sql: str) -> str:
    return sql.format(**{t: t for t in TABLES})


def accessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The accession table from lineitem, orders, customer, nation, supplier and part."""
    return in_spark(spark, sf_dir, ACC_SQL)


def with_acc(sql: str) -> str:
    """A DuckDB query over ``acc``."""
    return f"WITH acc AS ({in_duckdb(ACC_SQL)}) {sql}"


ASM_SQL = """SELECT concat('GCF_', p_partkey) AS assembly_accession,
  CASE WHEN p_partkey % 4 = 0 THEN 'na' ELSE concat('SAMN', p_partkey) END AS biosample,
  CASE WHEN p_partkey % 7 = 0 THEN '' ELSE concat('PRJNA', p_partkey % 30) END AS bioproject,
  concat('', p_size) AS taxid, concat('', p_size % 10) AS species_taxid, p_name AS organism_name,
  CASE WHEN p_partkey % 3 = 0 THEN 'na' ELSE p_brand END AS infraspecific_name, CASE WHEN p_partkey % 5 = 0 THEN '' ELSE p_type END AS isolate,
  CASE WHEN p_partkey % 9 = 0 THEN 'replaced' ELSE 'latest' END AS version_status,
  CASE p_partkey % 4 WHEN 0 THEN 'Complete Genome' WHEN 1 THEN 'Chromosome' WHEN 2 THEN 'Scaffold' ELSE 'Contig' END AS assembly_level FROM {part}"""


def assemblies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_spark(spark, sf_dir, ASM_SQL)


# --- XML files -------------------------------------------------------------------------------------------------


def _xml(c: str):
    v = F.col(c).cast("string")
    if not c.endswith(("key", "number")):  # numbers hold nothing to escape
        for sign, name in (("&", "&amp;"), ("<", "&lt;"), ('"', "&quot;")):
            v = F.replace(v, F.lit(sign), F.lit(name))
    return F.coalesce(v, F.lit(""))


#: Elements of files that a task makes: with more rows there are more tasks, so what a task and its Python hold doesn't grow.
ELEMENTS = 100_000


def _files(rows: DataFrame, kind: str, directory, order: list[str], body, *others: str, n: int) -> DataFrame:
    """One XML file a directory: its rows' elements in order. Shaped like Spark's binaryFile source.

    The columns of ``body``, those of ``order`` and ``others``, are exchanged, and text is made of them where the file is.
    ``n``: number of elements.
    """
    n = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // ELEMENTS))
    dealt = rows.select(directory.alias("dir"), *order, *others).repartition(n, "dir")
    d = dealt.select("dir", F.struct(*order, body.alias("xml")).alias("e")).groupBy("dir").agg(F.sort_array(F.collect_list("e")).alias("e"))
    root = kind.upper() + "_SET"
    text = F.concat(F.lit(f'<?xml version="1.0"?><{root}>'), F.array_join(F.col("e.xml"), ""), F.lit(f"</{root}>"))
    return d.select(F.concat(F.lit("/x/"), "dir", F.lit("/"), "dir", F.lit(f".{kind}.xml")).alias("path"), F.lit("2026-05-16 00:00:00").cast("timestamp").alias("modificationTime"), F.encode(text, "UTF-8").alias("content")).withColumn("length", F.length("content").cast("long"))


def _bucket(key: str, size: int):
    """The part of a directory's name that keeps its files small: a nation's rows are dealt to ranges of ``size`` keys."""
    return F.concat(F.floor(F.col(key) / size).cast("string"), F.lit("x"))


def xml_files(spark: SparkSession, sf_dir: str, *kinds: str) -> DataFrame:
    """Files path, modificationTime, content, length of the given kinds: run, experiment, sample, study, broken."""
    s = lambda *p: F.concat(*[x if not isinstance(x, str) else F.lit(x) for x in p])
    out = None
    for kind in kinds:
        if kind == "sample":
            c = table(spark, sf_dir, "customer")
            body = s('<SAMPLE accession="SRS', _xml("c_custkey"), '" alias="', _xml("c_name"), '"><IDENTIFIERS><PRIMARY_ID>SRS', _xml("c_custkey"), '</PRIMARY_ID><EXTERNAL_ID namespace="BioSample">SAMN', _xml("c_custkey"), "</EXTERNAL_ID></IDENTIFIERS><SAMPLE_NAME><TAXON_ID>", _xml("c_nationkey"), "</TAXON_ID><SCIENTIFIC_NAME>species ", _xml("c_nationkey"), "</SCIENTIFIC_NAME></SAMPLE_NAME><SAMPLE_ATTRIBUTES><SAMPLE_ATTRIBUTE><TAG>segment</TAG><VALUE>", _xml("c_mktsegment"), "</VALUE></SAMPLE_ATTRIBUTE><SAMPLE_ATTRIBUTE><TAG>empty</TAG></SAMPLE_ATTRIBUTE></SAMPLE_ATTRIBUTES></SAMPLE>")
            f = _files(c, kind, s("D", _bucket("c_custkey", 5_000), F.col("c_nationkey").cast("string")), ["c_custkey"], body, "c_name", "c_nationkey", "c_mktsegment", n=c.count())
        elif kind == "study":
            n = table(spark, sf_dir, "nation")
            body = s('<STUDY accession="SRP', _xml("n_nationkey"), '"><IDENTIFIERS><EXTERNAL_ID namespace="BioProject">PRJNA', _xml("n_nationkey"), '</EXTERNAL_ID></IDENTIFIERS><DESCRIPTOR><STUDY_TITLE>', _xml("n_name"), '</STUDY_TITLE><STUDY_TYPE existing_study_type="Other"/></DESCRIPTOR></STUDY>')
            f = _files(n, kind, s("D", F.col("n_nationkey").cast("string")), ["n_nationkey"], body, "n_name", n=n.count())
        elif kind == "experiment":
            o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
            platform = F.when(F.col("o_orderstatus") == "F", "ILLUMINA").when(F.col("o_orderstatus") == "O", "PACBIO_SMRT").otherwise("OXFORD_NANOPORE")
            body = s('<EXPERIMENT accession="SRX', _xml("o_orderkey"), '"><STUDY_REF accession="SRP', (F.col("o_custkey") % 30).cast("string"), '"/><DESIGN><SAMPLE_DESCRIPTOR accession="SRS', _xml("o_custkey"), '"/><LIBRARY_DESCRIPTOR><LIBRARY_STRATEGY>', _xml("o_orderpriority"), "</LIBRARY_STRATEGY><LIBRARY_LAYOUT><PAIRED/></LIBRARY_LAYOUT></LIBRARY_DESCRIPTOR></DESIGN><PLATFORM><", platform, "><INSTRUMENT_MODEL>model ", _xml("o_orderstatus"), "</INSTRUMENT_MODEL></", platform, "></PLATFORM></EXPERIMENT>")
            f = _files(o, kind, s("D", _bucket("o_orderkey", 20_000), F.col("c_nationkey").cast("string")), ["o_orderkey"], body, "o_custkey", "o_orderstatus", "o_orderpriority", n=table(spark, sf_dir, "orders").count())
        elif kind == "run":
            r = table(spark, sf_dir, "lineitem")
            body = s('<RUN accession="SRR', _xml("l_orderkey"), "_", _xml("l_linenumber"), '" alias="p', _xml("l_partkey"), '"><EXPERIMENT_REF accession="SRX', _xml("l_orderkey"), '"/></RUN>')
            f = _files(r, kind, s("L", F.col("l_suppkey").cast("string")), ["l_orderkey", "l_linenumber", "l_partkey"], body, n=r.count())
        else:
            p = table(spark, sf_dir, "pages")
            text = F.coalesce(F.col("html"), F.lit(""))
            f = p.select(s("/x/P", F.col("page_id").cast("string"), "/P", F.col("page_id").cast("string"), ".run.xml").alias("path"), F.lit("2026-05-16 00:00:00").cast("timestamp").alias("modificationTime"), F.encode(F.when(F.col("page_id") % 10 == 0, "").when(F.col("page_id") % 10 == 1, "<OTHER_SET><RUN accession='R1'/></OTHER_SET>").otherwise(text), "UTF-8").alias("content")).withColumn("length", F.length("content").cast("long"))
        out = f if out is None else out.unionByName(f)
    return out
