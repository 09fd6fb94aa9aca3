"""Queries over the accession table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import scalars as X
from tidemark.operators import accessions as A
from tidemark.operators import compare as K
from tidemark.plans.adapters import accessions, with_acc

_MISSING = "({c} IS NULL OR {c} IN ('', '-'))"
_PREFIX = "CASE WHEN substr(Accession, 1, 3) IN ('SRA', 'ERA', 'DRA') THEN substr(Accession, 1, 3) ELSE 'OTHER' END"
_LP = "Status = 'live' AND Visibility = 'public'"
_INT = "TRY_CAST(NULLIF({c}, '-') AS BIGINT)"


def _missing(c: str) -> str:
    return _MISSING.format(c=c)


def _rows(select: list[tuple[str, str]], source: str) -> str:
    """(metric, value) rows of aggregates over one source."""
    return " UNION ALL ".join(f"SELECT '{m}' AS metric, (count(*) FILTER (WHERE {c}))::BIGINT AS value FROM {source}" for m, c in select)


def _count(*by: str) -> str:
    cols = ", ".join(f"{_PREFIX} AS prefix" if c == "prefix" else c for c in by)
    return f"SELECT {cols}, count(*) AS n FROM acc GROUP BY ALL"


def _anti(kind: str, column: str, target: str, select: str) -> str:
    return f"SELECT {select} FROM acc r WHERE {_LP} AND Type = '{kind}' AND NOT {_missing('r.' + column)} AND r.{column} NOT IN (SELECT Accession FROM acc WHERE {_LP} AND Type = '{target}')"


def _all_counts_sql() -> str:
    parts = []
    for g in A.GROUPS:
        key = " || ".join([f"'{'+'.join(g).lower() or 'total'}'", *(f"'|' || {_PREFIX if c == 'prefix' else c}" for c in g)])
        parts.append(f"SELECT {key} AS metric, count(*) AS n FROM acc GROUP BY 1")
    return " UNION ALL ".join(parts)


_QUALITY = [(f"run_{c.lower()}_{k}", cond.format(c=c, i=_INT.format(c=c), m=_missing(c))) for c in ("Spots", "Bases") for k, cond in (("zero", "{c} = '0'"), ("missing", "{m}"), ("non_numeric", "NOT {m} AND {i} IS NULL"))]
_LP_METRICS = [
    ("total", "true"),
    *[(f"{c.lower()}_non_missing", f"NOT {_missing(c)}") for c in ("Experiment", "Sample", "Study", "BioSample", "BioProject", "Loaded")],
    *[(f"{c.lower()}_missing", _missing(c)) for c in ("Spots", "Bases")],
    *[(f"{c.lower()}_zero", f"{c} = '0'") for c in ("Spots", "Bases")],
    ("spots_gt0_bases_gt0", f"{_INT.format(c='Spots')} > 0 AND {_INT.format(c='Bases')} > 0"),
    ("replacedby_non_missing", f"NOT {_missing('ReplacedBy')}"),
]
_DANGLING = " UNION ALL ".join(_anti(k, c, t, f"'{n}_not_found' AS metric, count(*) AS value") for n, k, c, t in A.REFERENCES)
#: A copy of the table with planted changes: rows left out, statuses changed.
_CHANGED = "SELECT CASE WHEN Type = 'STUDY' THEN 'changed' ELSE Status END AS Status FROM acc WHERE Type <> 'ANALYSIS' AND Accession NOT LIKE '%7'"


def _changed(d):
    return d.where((F.col("Type") != "ANALYSIS") & ~F.col("Accession").like("%7")).withColumn("Status", F.when(F.col("Type") == "STUDY", "changed").otherwise(F.col("Status")))


def flagship(acc):
    """Live public runs whose experiment isn't live and public, counted by type, status and visibility of the run."""
    return A.counts(A.dangling(acc, "RUN", "Experiment", "EXPERIMENT"), "Type", "Status", "Visibility")


def register(add) -> None:
    def on(name, f, sql):
        add(name, lambda spark, sf: f(accessions(spark, sf)), with_acc(sql))

    counted = lambda d: d.agg(F.count(F.lit(1)).alias("n"))
    on("flagship", flagship, f"SELECT Type, Status, Visibility, count(*) AS n FROM ({_anti('RUN', 'Experiment', 'EXPERIMENT', 'r.*')}) GROUP BY ALL")
    on("f1_non_missing", lambda d: d.where(X.non_missing("Experiment")).groupBy("Type").agg(F.count(F.lit(1)).alias("n")), f"SELECT Type, count(*) AS n FROM acc WHERE NOT {_missing('Experiment')} GROUP BY ALL")
    on("f2_live_public", lambda d: A.live_public(d, "EXPERIMENT", "Accession", "Sample", "Study"), f"SELECT Accession, Sample, Study FROM acc WHERE {_LP} AND Type = 'EXPERIMENT'")
    raw = f"FROM acc WHERE {_LP} AND Type = 'RUN' AND Spots NOT IN ('0', '-') AND Bases NOT IN ('0', '-')"
    typed = f"FROM acc WHERE {_LP} AND Type = 'RUN' AND {_INT.format(c='Spots')} > 0 AND {_INT.format(c='Bases')} > 0"
    on("f3_run_nonzero_raw", lambda d: A.runs_nonzero_raw(d).select("Accession", "Spots", "Bases"), f"SELECT Accession, Spots, Bases {raw}")
    typed_columns = f"Accession, {_INT.format(c='Spots')} AS Spots_i64, {_INT.format(c='Bases')} AS Bases_i64"
    on("f4_run_nonzero_typed", lambda d: A.runs_nonzero_typed(d).select("Accession", "Spots_i64", "Bases_i64"), f"SELECT {typed_columns} {typed}")
    on("f5_projection", lambda d: A.in_order(d.where("Type = 'STUDY'")), "SELECT * FROM acc WHERE Type = 'STUDY'")
    on("f16_downloadable_runs", lambda d: A.runs_nonzero_typed(d).groupBy("Study").agg(F.count(F.lit(1)).alias("n"), F.sum("Bases_i64").alias("bases")), f"SELECT Study, count(*) AS n, sum({_INT.format(c='Bases')})::BIGINT AS bases {typed} GROUP BY ALL")
    on("a1_total_rows", A.total_rows, "SELECT count(*) AS rows, count(*) + 1 AS lines FROM acc")
    for name, by in (("a2_type_counts", ["Type"]), ("a3_status_counts", ["Status"]), ("a4_visibility_counts", ["Visibility"]), ("a5_type_status_visibility", ["Type", "Status", "Visibility"]), ("a6_prefix_counts", ["prefix"]), ("a7_prefix_type_matrix", ["prefix", "Type"]), ("a8_type_status", ["Type", "Status"]), ("a9_type_visibility", ["Type", "Visibility"])):
        on(name, lambda d, by=by: A.counts(d, *by), _count(*by))
    on("a10_all_counts_one_pass", A.all_counts, _all_counts_sql())
    sets = ", ".join("(" + ", ".join(g) + ")" for g in A.GROUPS)
    on("a10_grouping_sets", A.grouping_set_counts, f"SELECT grouping(prefix, Type, Status, Visibility)::BIGINT AS gid, prefix, Type, Status, Visibility, count(*) AS n FROM (SELECT *, {_PREFIX} AS prefix FROM acc) GROUP BY GROUPING SETS ({sets})")
    on("a11_presence_counts", A.presence_counts, _rows([(c, f"NOT {_missing(c)}") for c in A.PRESENCE], "acc"))
    on("a12_run_numeric_quality", A.run_numeric_quality, _rows(_QUALITY, "(SELECT * FROM acc WHERE Type = 'RUN')"))
    on("a13_run_lp_metrics", A.run_live_public_metrics, _rows(_LP_METRICS, f"(SELECT * FROM acc WHERE {_LP} AND Type = 'RUN')"))
    on("j2_dangling_refs", A.dangling_counts, _DANGLING)
    on("a14_relation_metrics", A.relation_metrics, f"{_DANGLING} UNION ALL SELECT 'experiment_total', count(*) FROM acc WHERE {_LP} AND Type = 'EXPERIMENT'")
    third = lambda d, i: A.all_counts(d.where(F.pmod(F.xxhash64("Accession"), F.lit(3)) == i))
    on("a15_counter_merge", lambda d: A.merged_counters(*[third(d, i) for i in range(3)]), _all_counts_sql())
    on("a16_distinct_keys", lambda d: A.distinct_keys(d, "RUN"), f"SELECT DISTINCT Accession FROM acc WHERE {_LP} AND Type = 'RUN'")
    on("t1_count_desc", lambda d: A.sorted_counts(d, "Submission").limit(50), "SELECT Submission, count(*) AS n FROM acc GROUP BY 1 ORDER BY n DESC, Submission LIMIT 50")
    on("x1_prefix_class", lambda d: counted(d.groupBy(X.prefix_class("Submission").alias("prefix"), X.prefix3("Accession").alias("head"))), f"SELECT {_PREFIX.replace('Accession', 'Submission')} AS prefix, substr(Accession, 1, 3) AS head, count(*) AS n FROM acc GROUP BY ALL")
    on("x2_missing_to_dash", lambda d: d.groupBy(X.missing_to_dash("Bases").alias("bases")).agg(F.count(F.lit(1)).alias("n")), f"SELECT CASE WHEN {_missing('Bases')} THEN '-' ELSE Bases END AS bases, count(*) AS n FROM acc GROUP BY 1")
    on("x3_try_bigint", lambda d: d.groupBy(X.try_bigint("Spots").alias("spots")).agg(F.count(F.lit(1)).alias("n")), f"SELECT {_INT.format(c='Spots')} AS spots, count(*) AS n FROM acc GROUP BY 1")
    on("x13_prefix3", lambda d: d.groupBy(X.prefix3("Accession").alias("head")).agg(F.count(F.lit(1)).alias("n")), "SELECT substr(Accession, 1, 3) AS head, count(*) AS n FROM acc GROUP BY 1")
    on("x17_metric_key", lambda d: d.groupBy(X.metric_key(F.lit("type"), "Type", "Status").alias("metric")).agg(F.count(F.lit(1)).alias("n")), "SELECT 'type|' || Type || '|' || Status AS metric, count(*) AS n FROM acc GROUP BY 1")
    ratio = "count(*) FILTER (WHERE Status = 'live')::DOUBLE / NULLIF(count(*) FILTER (WHERE Visibility = 'controlled_access'), 0)"
    on("x16_safe_ratio", lambda d: d.groupBy("Type").agg(F.round(X.safe_ratio(F.count_if(F.col("Status") == "live"), F.count_if(F.col("Visibility") == "controlled_access")), 6).alias("ratio")), f"SELECT Type, round({ratio}, 6) AS ratio FROM acc GROUP BY 1")
    on("x15_first_non_empty", lambda d: d.select("Type", X.first_non_empty("Experiment", "Sample").alias("v")).groupBy("Type").agg(F.count("v").alias("n"), F.min("v").alias("least")), "SELECT Type, count(v) AS n, min(v) AS least FROM (SELECT Type, coalesce(nullif(Experiment, ''), nullif(Sample, '')) AS v FROM acc) GROUP BY 1")
    on("x4_clean_ws", lambda d: d.select(X.clean_ws(F.concat(F.lit(" \t"), "Status", F.lit(" \n x "), "Type")).alias("v")).groupBy("v").agg(F.count(F.lit(1)).alias("n")), "SELECT Status || ' x ' || Type AS v, count(*) AS n FROM acc GROUP BY 1")
    on("x5_truncate_flag", lambda d: d.select(X.truncated("Accession", 6)[0].alias("text"), X.truncated("Accession", 6)[1].alias("cut")).groupBy("text", "cut").agg(F.count(F.lit(1)).alias("n")), "SELECT substr(Accession, 1, 6) AS text, length(Accession) > 6 AS cut, count(*) AS n FROM acc GROUP BY ALL")
    on("x6_stable_id", lambda d: d.where("Type = 'SAMPLE'").select("Accession", X.stable_id("Type", "Accession", "Study").alias("id")), "SELECT Accession, sha1(Type || chr(31) || Accession || chr(31) || Study) AS id FROM acc WHERE Type = 'SAMPLE'")
    on("x7_sha256", lambda d: d.where("Type = 'SAMPLE'").select("Accession", X.sha256_text("Accession").alias("digest")), "SELECT Accession, sha256(Accession) AS digest FROM acc WHERE Type = 'SAMPLE'")
    on("x23_bool_text", lambda d: d.groupBy(X.bool_text(F.col("Status") == "live").alias("live")).agg(F.count(F.lit(1)).alias("n")), "SELECT (Status = 'live')::VARCHAR AS live, count(*) AS n FROM acc GROUP BY 1")
    on("x18_json_text", lambda d: d.groupBy("Type").agg(F.count(F.lit(1)).alias("n")).select(X.json_text(F.create_map(F.lit("type"), "Type", F.lit("n"), F.col("n").cast("string"))).alias("text")), """SELECT '{"n":"' || count(*) || '","type":"' || Type || '"}' AS text FROM acc GROUP BY Type""")
    on("x19_utc_timestamps", lambda d: d.where("Type = 'STUDY'").select("Accession", X.utc_timestamp(F.concat(F.lit("2026-05-16T12:00:0"), F.length("Accession").cast("string"), F.lit("+02:00"))).alias("at")), "SELECT Accession, TIMESTAMP '2026-05-16 10:00:00' + to_seconds(length(Accession)) AS at FROM acc WHERE Type = 'STUDY'")

    named = lambda d: d.groupBy(F.col("Status").alias("metric")).agg(F.count(F.lit(1)).alias("n"))
    full = f"SELECT coalesce(a.k, b.k) AS key, a.n AS observed, b.n AS expected, coalesce(a.n, 0) - coalesce(b.n, 0) AS delta, (a.n IS NOT DISTINCT FROM b.n) AS match FROM (SELECT Status AS k, count(*) AS n FROM acc GROUP BY 1) a FULL JOIN (SELECT Status AS k, count(*) AS n FROM ({_CHANGED}) GROUP BY 1) b ON a.k = b.k"
    on("j8_count_compare", lambda d: K.compare_counts(named(d), named(_changed(d))), full)
    on("v5_expected_counts", lambda d: K.status(K.compare_counts(named(d), named(_changed(d)))), f"SELECT count(*) AS checks, count(*) FILTER (WHERE NOT match) AS mismatches, CASE WHEN bool_and(match) THEN 'pass' ELSE 'fail' END AS status FROM ({full})")
    on("v6_source_vs_table", lambda d: K.status(K.compare_counts(A.all_counts(d), A.merged_counters(*[third(d, i) for i in range(3)]))), f"SELECT count(*) AS checks, 0::BIGINT AS mismatches, 'pass' AS status FROM ({_all_counts_sql()})")
    on("u4_extra_keys", lambda d: K.extra_keys(d, _changed(d), "Accession"), f"SELECT DISTINCT Accession FROM acc WHERE Accession NOT IN (SELECT Accession FROM acc WHERE Type <> 'ANALYSIS' AND Accession NOT LIKE '%7')")
    on("u5_key_union", lambda d: K.key_union(d.where("Type = 'RUN'"), d.where("Type = 'STUDY'"), "Study"), "SELECT DISTINCT Study FROM acc WHERE Type IN ('RUN', 'STUDY')")
    on("u2_dedupe_union", lambda d: K.deduped_union(*[d.where(F.col("Type") == t).select("Study", F.col("Type").alias("kind")) for t in ("STUDY", "SAMPLE", "RUN")], key="Study"), "SELECT Study, CASE WHEN min(o) = 0 THEN 'STUDY' WHEN min(o) = 1 THEN 'SAMPLE' ELSE 'RUN' END AS kind FROM (SELECT Study, CASE Type WHEN 'STUDY' THEN 0 WHEN 'SAMPLE' THEN 1 ELSE 2 END AS o FROM acc WHERE Type IN ('STUDY', 'SAMPLE', 'RUN')) GROUP BY 1")
    on("u3_multiset_compare", lambda d: K.multiset_compare(d, _changed(d), "Type", ["Status", "Visibility", "Study"]), "SELECT Type, sum(least(e, a))::BIGINT AS matched, sum(greatest(e - a, 0))::BIGINT AS missing, sum(greatest(a - e, 0))::BIGINT AS extra FROM (SELECT coalesce(x.Type, y.Type) AS Type, coalesce(x.n, 0) AS e, coalesce(y.n, 0) AS a FROM (SELECT Type, Status, Visibility, Study, count(*) AS n FROM acc GROUP BY ALL) x FULL JOIN (SELECT Type, CASE WHEN Type = 'STUDY' THEN 'changed' ELSE Status END AS Status, Visibility, Study, count(*) AS n FROM acc WHERE Type <> 'ANALYSIS' AND Accession NOT LIKE '%7' GROUP BY ALL) y ON x.Type = y.Type AND x.Status = y.Status AND x.Visibility = y.Visibility AND x.Study = y.Study) GROUP BY 1")
    on("a18_dup_key_check", lambda d: d.where("Type = 'RUN'").groupBy("Accession").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "SELECT Accession, count(*) AS n FROM acc WHERE Type = 'RUN' GROUP BY 1 HAVING count(*) > 1")
