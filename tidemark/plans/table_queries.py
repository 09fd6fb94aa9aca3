"""Queries that read, write and sample tables, and link assemblies with runs."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import contract as C
from tidemark.functions import scalars as X
from tidemark.operators import accessions as A
from tidemark.operators import compare as K
from tidemark.operators import linkage as L
from tidemark.operators import sampling as S
from tidemark.operators import validate as V
from tidemark.plans.adapters import ASM_SQL, accessions, assemblies, in_duckdb, in_spark, table, with_acc
from tidemark.sources import tables as R
from tidemark.sources import trees as T
from tidemark.sources.commit import delete


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder that all executors share: below ``spark.checkpoint.dir``; where that is unset, a temporary one, on one machine only.

    Temporary folders go when the process ends; those below ``spark.checkpoint.dir`` when the application does.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir names no folder that all executors share")
        root = tempfile.mkdtemp(prefix="spark-scratch-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
    path = f"{root.rstrip('/')}/{uuid.uuid4().hex}"
    if spark.sparkContext.applicationId not in _MADE:
        atexit.register(_forget, spark, _MADE.setdefault(spark.sparkContext.applicationId, []))
    _MADE[spark.sparkContext.applicationId].append(path)
    return f"{path}/{name}"


_MADE: dict[str, list[str]] = {}


def _forget(spark: SparkSession, paths: list[str]) -> None:
    """Deletes scratch folders where the application still runs at the end of the process."""
    if spark.sparkContext._jsc is not None:
        for path in paths:
            delete(spark, path)


def _by_type(d: DataFrame) -> DataFrame:
    return d.groupBy("Type", "Status").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("Accession").alias("accessions"))


_BY_TYPE = "SELECT Type, Status, count(*) AS n, count(DISTINCT Accession) AS accessions FROM acc {w} GROUP BY ALL"


def _tsv(spark: SparkSession, sf: str) -> str:
    path = scratch(spark, "acc.tsv")
    accessions(spark, sf).write.options(sep="\t", header=True, quote="\u0000", emptyValue="").csv(path)
    return path


def _directory():
    return F.concat(F.substring(F.upper("source"), 1, 3), F.lpad(F.regexp_extract("source", "[0-9]+", 0), 3, "0"))


def _tree(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as files of directories: source is the directory."""
    d = table(spark, sf, "documents")
    return d.select(_directory().alias("directory_accession"), F.concat(F.lit("f"), F.col("doc_id").cast("string")).alias("file_id"), F.octet_length("text").cast("long").alias("file_size"), "lang", F.when(F.col("doc_id") % 10 == 0, "empty_file").otherwise("ok").alias("parse_status"), F.when(F.col("doc_id") % 7 == 0, "mismatch").otherwise("consistent").alias("xml_kind_consistency_status"), F.lit(0).cast("long").alias("parser_warning_count"))


_TREE = "SELECT upper(substr(source, 1, 3)) || lpad(regexp_extract(source, '[0-9]+'), 3, '0') AS directory_accession, 'f' || doc_id AS file_id, strlen(text)::BIGINT AS file_size, lang, CASE WHEN doc_id % 10 = 0 THEN 'empty_file' ELSE 'ok' END AS parse_status, CASE WHEN doc_id % 7 = 0 THEN 'mismatch' ELSE 'consistent' END AS xml_kind_consistency_status FROM documents"


def _listing(spark: SparkSession, sf: str) -> DataFrame:
    """A listing of a written tree: a file for each document, and an empty directory for each nation."""
    text = F.coalesce(F.encode("text", "UTF-8"), F.lit("").cast("binary")).alias("content")
    files = table(spark, sf, "documents").select(F.concat(_directory(), F.lit("/f"), F.col("doc_id").cast("string"), F.lit(".sample.xml")).alias("name"), text)
    none = table(spark, sf, "nation").select(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("name"), F.lit(None).cast("binary").alias("content"))
    T.write_files(files.union(none), root := scratch(spark, "tree"))
    return T.listed(spark, root)


def _hash(key: str, seed: object = 42) -> str:
    return f"md5({key} || ':{seed}'), {key}"


def register(add) -> None:
    def s1(spark, sf):
        return _by_type(R.read_tsv(spark, _tsv(spark, sf)))

    add("s1_tsv_scan", s1, with_acc(_BY_TYPE.format(w="")))
    names = C.ACCESSION_COLUMNS
    row = "concat('DRA', s_suppkey" + "".join(f", chr(9), '{'live' if c == 'Status' else '-'}'" for c in names[1:])
    cut = f"concat('DRA', s_suppkey, chr(9), 'live')"  # noqa: F541
    lines = f"SELECT s_nationkey AS f, s_suppkey AS k, 0 AS o, CASE s_suppkey % 4 WHEN 0 THEN {cut} WHEN 1 THEN {row}, chr(9), 'more') WHEN 2 THEN {row}, chr(13)) ELSE {row}) END AS text FROM {{supplier}} UNION ALL SELECT s_nationkey, s_suppkey, 1, '' FROM {{supplier}} WHERE s_suppkey % 3 = 0 UNION ALL SELECT n_nationkey, -1, 0, CASE WHEN n_nationkey % 5 = 0 THEN concat('No', '{chr(9)}', 'header') ELSE '{chr(9).join(names)}' END FROM {{nation}}"

    def faults(spark, sf):
        """Files of suppliers' rows, one for each nation, with planted faults."""
        rows = in_spark(spark, sf, lines)
        text = F.concat(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "o", "text"))), lambda x: x["text"]), "\n"), F.lit("\n"))
        files = rows.groupBy("f").agg(text.alias("text")).select(F.concat(F.lit("t/"), F.col("f").cast("string"), F.lit(".tsv")).alias("name"), F.encode("text", "UTF-8").alias("content"))
        T.write_files(files, root := scratch(spark, "tsv"))
        return R.tsv_faults(spark, f"{root}/t").select(F.element_at(F.split("file", "/"), -1).alias("file"), "line", "offset", "fields", "fault")

    placed = f"SELECT f, text, row_number() OVER w AS line, (coalesce(sum(strlen(text) + 1) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS o, (len(text) - len(replace(text, chr(9), '')) + 1)::BIGINT AS fields FROM ({in_duckdb(lines)}) WINDOW w AS (PARTITION BY f ORDER BY k, o)"
    add("s2_tsv_shape_check", faults, f"SELECT f || '.tsv' AS file, line, o AS \"offset\", fields, fault FROM (SELECT *, CASE WHEN line = 1 THEN CASE WHEN text LIKE 'No%' THEN 'header' END WHEN text = '' THEN 'blank' WHEN ends_with(text, chr(13)) THEN 'carriage_return' WHEN fields < 20 THEN 'short' WHEN fields > 20 THEN 'long' END AS fault FROM ({placed})) WHERE fault IS NOT NULL")

    def by_type(spark, sf):
        path = scratch(spark, "acc")
        R.write_by_type(accessions(spark, sf), path)
        return path

    add("s3_partition_scan", lambda spark, sf: _by_type(R.read_partition(spark, by_type(spark, sf), "RUN")), with_acc(_BY_TYPE.format(w="WHERE Type = 'RUN'")))
    add("k1_partitioned_write", lambda spark, sf: _by_type(R.read_partition(spark, by_type(spark, sf))), with_acc(_BY_TYPE.format(w="")))

    def k2(spark, sf):
        path = scratch(spark, "runs")
        R.write_counted(A.runs_nonzero_typed(accessions(spark, sf)), path)
        return spark.read.parquet(path).groupBy("Study").agg(F.sum("Spots_i64").alias("spots"), F.count(F.lit(1)).alias("n"))

    typed = "FROM acc WHERE Status = 'live' AND Visibility = 'public' AND Type = 'RUN' AND TRY_CAST(NULLIF(Spots, '-') AS BIGINT) > 0 AND TRY_CAST(NULLIF(Bases, '-') AS BIGINT) > 0"
    add("k2_derived_write", k2, with_acc(f"SELECT Study, sum(TRY_CAST(Spots AS BIGINT))::BIGINT AS spots, count(*) AS n {typed} GROUP BY 1"))

    def k3(spark, sf):
        acc = accessions(spark, sf)
        n = R.write_pilot(acc, path := scratch(spark, "pilot"))
        return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n"), (F.count(F.lit(1)) == n).alias("as_written"))

    add("k3_pilot_write", k3, with_acc("SELECT least(count(*), 1000000)::BIGINT AS n, true AS as_written FROM acc"))

    def k4(spark, sf):
        R.write_tsv(A.counts(accessions(spark, sf), "Type").select("Type", "n"), path := scratch(spark, "m.tsv"))
        return spark.read.schema("Type string, n long").options(sep="\t", header=True).csv(path)

    add("k4_tsv_write", k4, with_acc("SELECT Type, count(*) AS n FROM acc GROUP BY 1"))

    def k5(spark, sf):
        one = A.total_rows(accessions(spark, sf)).select(F.struct("rows", "lines").alias("totals"))
        R.write_summary(one, path := scratch(spark, "s.json"))
        return R.read_json(spark, path, "totals struct<rows: long, lines: long>").select("totals.rows", "totals.lines")

    add("k5_json_write", k5, with_acc("SELECT count(*) AS rows, count(*) + 1 AS lines FROM acc"))

    def s10(spark, sf):  # partial counts stored as JSON lines
        path, acc = scratch(spark, "audit"), accessions(spark, sf)
        A.all_counts(acc).write.json(path)
        return spark.read.schema("metric string, n long").json(path).where("metric like 'type|%'")

    add("s10_json_partials", s10, with_acc("SELECT 'type|' || Type AS metric, count(*) AS n FROM acc GROUP BY 1"))

    def parts(spark, sf):
        acc, root = A.in_order(accessions(spark, sf)), scratch(spark, "parts")
        kinds = ("RUN", "SAMPLE", "STUDY")
        for k in kinds:
            acc.where(F.col("Type") == k).write.parquet(f"{root}/{k}")
        return R.read_parts(spark, [f"{root}/{k}" for k in kinds], C.ACCESSION_SCHEMA)

    some = _BY_TYPE.format(w="WHERE Type IN ('RUN', 'SAMPLE', 'STUDY')")
    add("s9_multi_part_scan", lambda spark, sf: _by_type(parts(spark, sf)), with_acc(some))
    add("u1_union_all_parts", lambda spark, sf: A.counts(parts(spark, sf), "Type"), with_acc("SELECT Type, count(*) AS n FROM acc WHERE Type IN ('RUN', 'SAMPLE', 'STUDY') GROUP BY 1"))

    def s7(spark, sf):
        path = scratch(spark, "asm.txt")
        d = assemblies(spark, sf)
        full = d.select(*[F.col(c) if c in d.columns else F.lit("na").alias(c) for c in R.ASSEMBLY_FIELDS])
        full.select(F.concat_ws("\t", *[F.col(f"`{c}`") for c in full.columns]).alias("value")).union(spark.sql("SELECT '## comment line'")).write.text(path)
        return R.read_assemblies(spark, path).groupBy("assembly_level", "version_status").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("isolate") == "").alias("no_isolate"))

    asm = in_duckdb(ASM_SQL)
    add("s7_assembly_scan", s7, f"SELECT assembly_level, version_status, count(*) AS n, count(*) FILTER (WHERE isolate = '') AS no_isolate FROM ({asm}) GROUP BY ALL")

    # --- directories, manifests, samples

    dirs = f"SELECT DISTINCT directory_accession FROM ({_TREE})"
    empty = "SELECT 'N' || n_nationkey AS directory_accession"
    add("s4_dir_listing", lambda spark, sf: _listing(spark, sf).select("directory_accession").distinct(), f"{dirs} UNION ALL {empty} FROM nation")
    add("s5_file_listing", lambda spark, sf: T.file_counts(_listing(spark, sf)), f"SELECT directory_accession, count(*) AS files, coalesce(sum(file_size), 0)::BIGINT AS bytes, count(*) FILTER (WHERE coalesce(file_size, 0) = 0) AS empty_files FROM ({_TREE}) GROUP BY 1 UNION ALL {empty}, 0, 0, 0 FROM nation")
    add("s6_dir_list_tsv", lambda spark, sf: S.listed_directories(_tree(spark, sf).where("lang = 'de'").select(F.concat(F.lit(" "), "directory_accession", F.lit(" ")).alias("directory_accession")), _tree(spark, sf).select("directory_accession").distinct()), f"SELECT DISTINCT directory_accession FROM ({_TREE}) WHERE lang = 'de'")
    unit = "'D' || lpad(c_custkey::VARCHAR, 8, '0')"
    customers = lambda spark, sf: table(spark, sf, "customer").select(F.concat(F.lit("D"), F.lpad(F.col("c_custkey").cast("string"), 8, "0")).alias("directory_accession"))
    manifest = f"SELECT '2026-05-16' AS source_snapshot_id, row_number() OVER (ORDER BY d) - 1 AS manifest_row_id, sha1('2026-05-16' || chr(31) || d) AS directory_id, d AS directory_accession, substr(d, 1, 3) AS directory_prefix, d AS relative_directory_path, '/x/' || d AS absolute_directory_path FROM (SELECT DISTINCT {unit} AS d FROM customer)"
    add("w2_manifest_row_id", lambda spark, sf: S.directory_manifest(customers(spark, sf), "2026-05-16", "/x"), manifest)
    chunks = f"SELECT 'chunk_' || lpad(min(manifest_row_id)::VARCHAR, 8, '0') || '_' || lpad(max(manifest_row_id)::VARCHAR, 8, '0') AS chunk_id, min(manifest_row_id) AS start_row, count(*) AS row_count, min(manifest_row_id) AS manifest_row_id_start, max(manifest_row_id) AS manifest_row_id_end, count(*) AS expected_directory_count FROM ({manifest}) GROUP BY manifest_row_id // 40"
    plan = lambda spark, sf: S.chunk_manifest(S.directory_manifest(customers(spark, sf), "2026-05-16"), 40)
    add("w3_chunk_plan", plan, chunks)
    ledger = lambda d: d.select("chunk_id", F.when(F.col("start_row") % 80 == 0, 0).otherwise(1).alias("exit_code"), F.create_map(F.lit("file_index"), F.col("row_count") * 2, F.lit("run_core"), F.col("row_count")).alias("row_counts"))
    add("i2_resume_by_ledger", lambda spark, sf: S.pending(plan(spark, sf), ledger(plan(spark, sf))), f"SELECT * FROM ({chunks}) WHERE start_row % 80 <> 0")
    add("v15_completeness", lambda spark, sf: S.completeness(plan(spark, sf), ledger(plan(spark, sf))), f"SELECT count(*) AS missing_chunks, CASE WHEN count(*) = 0 THEN 'pass' ELSE 'fail' END AS status FROM ({chunks}) WHERE start_row % 80 <> 0")
    totals = f"SELECT 'file_index' AS \"table\", sum(row_count * 2)::BIGINT AS n FROM ({chunks}) WHERE start_row % 80 = 0 UNION ALL SELECT 'run_core', sum(row_count)::BIGINT FROM ({chunks}) WHERE start_row % 80 = 0"
    add("a27_chunk_row_totals", lambda spark, sf: V.row_totals(ledger(plan(spark, sf))), totals)
    add("v4_count_reconcile", lambda spark, sf: V.reconciled(V.row_totals(ledger(plan(spark, sf))), V.row_totals(ledger(plan(spark, sf))).where("table = 'run_core'")), f"SELECT \"table\", n AS expected, CASE WHEN \"table\" = 'run_core' THEN n END AS actual, \"table\" = 'run_core' AS match FROM ({totals})")

    ok = f"SELECT * FROM ({_TREE}) WHERE parse_status = 'ok'"
    good = lambda spark, sf: _tree(spark, sf).where("parse_status = 'ok'")
    add("t3_hash_sample_files", lambda spark, sf: S.random_sample(good(spark, sf), "file_id", 40, 42).select("file_id"), f"SELECT file_id FROM ({ok}) ORDER BY {_hash('file_id')} LIMIT 40")
    picked = f"SELECT directory_accession FROM (SELECT DISTINCT directory_accession FROM ({ok})) ORDER BY {_hash('directory_accession')} LIMIT 5"
    add("t4_hash_sample_dirs", lambda spark, sf: S.sample_with_all(good(spark, sf), "directory_accession", 5, 42).select("directory_accession", "file_id"), f"SELECT directory_accession, file_id FROM ({ok}) WHERE directory_accession IN ({picked})")
    add("j6_dir_sample_join", lambda spark, sf: S.sample_with_all(good(spark, sf), "directory_accession", 5, 42).groupBy("directory_accession").agg(F.count(F.lit(1)).alias("n")), f"SELECT directory_accession, count(*) AS n FROM ({ok}) WHERE directory_accession IN ({picked}) GROUP BY 1")
    odd = f"SELECT * FROM ({_TREE}) WHERE parse_status <> 'ok' OR xml_kind_consistency_status <> 'consistent'"

    def abnormal(spark, sf):
        from tidemark.operators.index import abnormal_files

        return abnormal_files(_tree(spark, sf))

    add("f15_abnormal_files", lambda spark, sf: abnormal(spark, sf).select("file_id", "parse_status", "xml_kind_consistency_status"), f"SELECT file_id, parse_status, xml_kind_consistency_status FROM ({odd})")
    sample = f"SELECT file_id FROM ({ok}) ORDER BY {_hash('file_id')} LIMIT 40"
    more = f"SELECT file_id FROM ({odd}) ORDER BY {_hash('file_id')} LIMIT 25"
    add("t5_abnormal_add", lambda spark, sf: S.with_abnormal(S.random_sample(good(spark, sf), "file_id", 40, 42).select("file_id"), abnormal(spark, sf), "file_id", 42, 25), f"(SELECT file_id FROM ({sample})) UNION (SELECT file_id FROM ({more}))")
    add("j7_file_semi_join", lambda spark, sf: _tree(spark, sf).join(S.random_sample(good(spark, sf), "file_id", 40, 42).select("file_id"), "file_id", "left_semi").select("file_id", "lang"), f"SELECT file_id, lang FROM ({_TREE}) WHERE file_id IN ({sample})")
    pool = f"SELECT * FROM (SELECT directory_accession, sum(file_size)::BIGINT AS bytes FROM ({_TREE}) GROUP BY 1) ORDER BY {_hash('directory_accession')} LIMIT 5000"
    add("t6_largest_dirs", lambda spark, sf: S.largest(_tree(spark, sf), "directory_accession", "file_size", 4, 42), f"SELECT * FROM ({pool}) ORDER BY bytes DESC, directory_accession DESC LIMIT 4")
    add("t7_random_sample", lambda spark, sf: S.random_sample(customers(spark, sf), "directory_accession", 10, 7), f"SELECT d AS directory_accession FROM (SELECT {unit} AS d FROM customer) ORDER BY {_hash('d', 7)} LIMIT 10")

    def t8(spark, sf):
        d = _tree(spark, sf)
        out = S.stratified(d, "file_id", F.col("lang"), 60, 42)
        return out.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min("file_id").alias("least"))

    # Each step of the recursion changes one quota by one, until they make 60 or no stratum has rows left.
    t8_sql = f"""WITH RECURSIVE f AS ({_TREE}), c AS (SELECT lang AS k, count(*) AS c FROM f GROUP BY 1),
        q AS (SELECT 0 AS step, k, c, least(c, greatest(1, round_even(60.0 * c / (SELECT sum(c) FROM c), 0)::BIGINT)) AS q FROM c
          UNION ALL SELECT step + 1, k, c, q + CASE WHEN place = 1 THEN sign(60 - s)::BIGINT ELSE 0 END
          FROM (SELECT *, row_number() OVER (ORDER BY CASE WHEN s > 60 THEN q ELSE c - q END DESC, k DESC) AS place FROM (SELECT *, sum(q) OVER () AS s, sum(c) OVER () AS total FROM q)) WHERE s > 60 OR s < least(60, total)),
        z AS (SELECT k, q FROM q WHERE step = (SELECT max(step) FROM q)),
        r AS (SELECT lang, file_id, q, row_number() OVER (PARTITION BY lang ORDER BY {_hash('file_id')}) AS rn FROM f JOIN z ON lang = k)
        SELECT lang, count(*) AS n, min(file_id) AS least FROM r WHERE rn <= q GROUP BY 1"""
    add("t8_prefix_stratified", t8, t8_sql)
    # All directories are of one prefix here, so the strata's part is the first seven by hash.
    t9_sql = f"""WITH u AS (SELECT directory_accession, sum(file_size) AS bytes FROM ({_TREE}) GROUP BY 1), a AS (SELECT directory_accession FROM u ORDER BY {_hash('directory_accession')} LIMIT 7),
        p AS (SELECT * FROM u WHERE directory_accession NOT IN (FROM a) ORDER BY {_hash('directory_accession')} LIMIT 5000), b AS (SELECT directory_accession FROM p ORDER BY bytes DESC, directory_accession DESC LIMIT 2),
        r AS (SELECT directory_accession FROM u WHERE directory_accession NOT IN (FROM a) AND directory_accession NOT IN (FROM b) ORDER BY {_hash('directory_accession')} LIMIT 1) FROM a UNION ALL FROM b UNION ALL FROM r"""
    add("t9_stress_mixed", lambda spark, sf: S.mixed(_tree(spark, sf), "directory_accession", "file_size", 10, 42), t9_sql)
    add("t12_subset_dispatch", lambda spark, sf: S.select_directories(_tree(spark, sf), "deterministic_random", 6, 42), f"SELECT directory_accession FROM ({dirs}) ORDER BY {_hash('directory_accession')} LIMIT 6")
    add("t10_bounded_examples", lambda spark, sf: S.bounded_examples(_tree(spark, sf), "lang", ["file_size", "file_id"], 3).select("lang", "file_id"), f"SELECT lang, file_id FROM ({_TREE}) QUALIFY row_number() OVER (PARTITION BY lang ORDER BY file_size, file_id) <= 3")
    add("t2_sorted_output", lambda spark, sf: _tree(spark, sf).groupBy("directory_accession").agg(F.max("file_size").alias("largest")).orderBy("directory_accession"), f"SELECT directory_accession, max(file_size) AS largest FROM ({_TREE}) GROUP BY 1 ORDER BY 1")
    add("t11_limit", lambda spark, sf: _tree(spark, sf).orderBy("file_id").limit(25).select("file_id", "lang"), f"SELECT file_id, lang FROM ({_TREE}) ORDER BY file_id LIMIT 25")
    add("x9_kind_from_filename", lambda spark, sf: _tree(spark, sf).select(X.kind_from_filename(F.concat("file_id", F.lit("."), F.element_at(F.array(*[F.lit(k) for k in (*X.KINDS, "other")]), (F.length("file_id") % 7 + 1).cast("int")), F.lit(".xml"))).alias("kind")).groupBy("kind").agg(F.count(F.lit(1)).alias("n")), f"SELECT CASE length(file_id) % 7 WHEN 6 THEN 'unknown' ELSE ['run', 'experiment', 'sample', 'study', 'submission', 'analysis'][(length(file_id) % 7)::INT + 1] END AS kind, count(*) AS n FROM ({_TREE}) GROUP BY 1")
    add("x8_local_name", lambda spark, sf: _tree(spark, sf).groupBy(X.local_name(F.concat(F.lit("{urn:x}"), "lang")).alias("name")).agg(F.count(F.lit(1)).alias("n")), f"SELECT lang AS name, count(*) AS n FROM ({_TREE}) GROUP BY 1")

    # --- assemblies and runs

    nn = lambda c: f"CASE WHEN lower(trim({c})) NOT IN ('', 'na', 'n/a', '-') THEN {c} END"
    core = f"SELECT assembly_accession, {nn('biosample')} AS biosample, {nn('bioproject')} AS bioproject, taxid, species_taxid, organism_name, version_status, assembly_level, coalesce({nn('infraspecific_name')}, {nn('isolate')}) AS strain_or_isolate FROM ({asm})"
    core_of = lambda spark, sf: L.assembly_core(assemblies(spark, sf))
    add("x21_null_normalise", lambda spark, sf: core_of(spark, sf).select("assembly_accession", "biosample", "bioproject"), f"SELECT assembly_accession, biosample, bioproject FROM ({core})")
    add("x22_strain_or_isolate", lambda spark, sf: core_of(spark, sf).select("assembly_accession", "strain_or_isolate"), f"SELECT assembly_accession, strain_or_isolate FROM ({core})")
    run_sql = "SELECT Accession AS run, CASE WHEN substr(Accession, length(Accession), 1) = '1' THEN '-' ELSE BioSample END AS biosample, BioProject AS bioproject, (length(Accession) * 3)::VARCHAR AS taxid FROM acc WHERE Type = 'RUN' AND Status = 'live' AND Visibility = 'public'"

    def linked(spark, sf):
        runs = A.live_public(accessions(spark, sf), "RUN").select(F.col("Accession").alias("run"), F.when(F.col("Accession").endswith("1"), "-").otherwise(F.col("BioSample")).alias("biosample"), F.col("BioProject").alias("bioproject"), (F.length("Accession") * 3).cast("string").alias("taxid"))
        return L.link_runs(runs, core_of(spark, sf).where("version_status = 'latest' and assembly_level = 'Chromosome'"))

    links = f"r AS ({run_sql}), a AS (SELECT * FROM ({core}) WHERE version_status = 'latest' AND assembly_level = 'Chromosome'), t1 AS (SELECT run, assembly_accession, 1 AS tier FROM r JOIN a USING (biosample)), r2 AS (SELECT * FROM r WHERE biosample NOT IN (SELECT biosample FROM a WHERE biosample IS NOT NULL)), t2 AS (SELECT run, assembly_accession, 2 AS tier FROM r2 JOIN a USING (bioproject) WHERE r2.bioproject NOT IN ('', '-')), r3 AS (SELECT * FROM r2 WHERE bioproject NOT IN (SELECT bioproject FROM a WHERE bioproject IS NOT NULL)), t3 AS (SELECT run, assembly_accession, 3 AS tier FROM r3 JOIN a USING (taxid)), l AS (SELECT * FROM t1 UNION ALL SELECT * FROM t2 UNION ALL SELECT * FROM t3)"
    with_links = lambda sql: with_acc("").rstrip() + f", {links} {sql}"
    add("j9_assembly_run_link", lambda spark, sf: linked(spark, sf).groupBy("run", "tier").agg(F.sum("n").alias("n"), F.min("least").alias("least")), with_links("SELECT run, tier, count(*) AS n, min(assembly_accession) AS least FROM l GROUP BY ALL"))

    def members(spark, sf):
        """Every link of the runs: a run's row of its best tier with the assemblies that share the key."""
        own = core_of(spark, sf).where("version_status = 'latest' and assembly_level = 'Chromosome'")
        return linked(spark, sf).select("tier", "value").distinct().join(L.tier_members(own), ["tier", "value"])

    add("j9_tier_members", members, with_links("SELECT DISTINCT 1 AS tier, biosample AS value, assembly_accession FROM r JOIN a USING (biosample) UNION SELECT 2, bioproject, assembly_accession FROM r2 JOIN a USING (bioproject) WHERE bioproject NOT IN ('', '-') UNION SELECT 3, taxid, assembly_accession FROM r3 JOIN a USING (taxid)"))

    def k7(spark, sf):
        R.write_tsv(L.selected_runs(linked(spark, sf), 2).select("run", "tier", "assembly_accession"), path := scratch(spark, "selected.tsv"), one=False)
        return spark.read.schema("run string, tier int, assembly_accession string").options(sep="\t", header=True).csv(path)

    add("k7_selected_runs", k7, with_links("SELECT run, min(tier) AS tier, min(assembly_accession) AS assembly_accession FROM l WHERE tier <= 2 GROUP BY 1"))
    add("j8_tree_compare", lambda spark, sf: K.compare_counts(_tree(spark, sf).groupBy(F.col("lang").alias("metric")).agg(F.count(F.lit(1)).alias("n")), good(spark, sf).groupBy(F.col("lang").alias("metric")).agg(F.count(F.lit(1)).alias("n"))), f"SELECT lang AS key, count(*) AS observed, count(*) FILTER (WHERE parse_status = 'ok') AS expected, count(*) - count(*) FILTER (WHERE parse_status = 'ok') AS delta, count(*) = count(*) FILTER (WHERE parse_status = 'ok') AS match FROM ({_TREE}) GROUP BY 1")
