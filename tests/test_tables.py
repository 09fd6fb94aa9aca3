"""Readers, writers, samples and comparisons on small tables."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions import contract as C
from tidemark.operators import compare as K
from tidemark.operators import index as I
from tidemark.operators import linkage as L
from tidemark.operators import sampling as S
from tidemark.operators.apportion import quotas
from tidemark.sources import lookup as Y
from tidemark.sources import tables as R

HEAD = "\t".join(C.ACCESSION_COLUMNS)
ROW = "\t".join(["SRR1", "", '"', *["-"] * 17])


def write(path, *lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_tsv(spark, tmp_path):
    r = R.read_tsv(spark, write(tmp_path / "a.tsv", HEAD, ROW)).first()
    assert (r["Accession"], r["Submission"], r["Status"]) == ("SRR1", "", '"')
    for bad in ([HEAD, ROW + "\tx"], [HEAD, "SRR1\t-"], [HEAD.replace("Status", "State"), ROW]):
        with pytest.raises(Exception):
            R.read_tsv(spark, write(tmp_path / "b.tsv", *bad)).collect()
    shape = R.tsv_shape(spark, write(tmp_path / "c.tsv", HEAD + "\r", "", ROW, "x\ty")).collect()
    assert {(r["fields"], r["n"], r["ok"]) for r in shape} == {(20, 2, True), (2, 1, False)}


def test_pilot_and_contract(spark, tmp_path):
    d = spark.range(5).select(F.col("id").cast("string").alias("Accession"))
    assert R.write_pilot(d, str(tmp_path / "p"), 3) == 3 and R.write_pilot(d, str(tmp_path / "q"), 9) == 5
    with pytest.raises(Exception):
        R.write_contract(spark.createDataFrame([], C.schema("run_core")).drop("file_id").withColumn("file_id", F.lit(None)).union(spark.sql("select 's', 'e', 'r', 'a', 'x', null")), str(tmp_path / "r"), "run_core")
    R.write_tsv(d.limit(0), str(tmp_path / "t"))
    assert any(f.name.startswith("part-") for f in (tmp_path / "t").iterdir())


def test_samples(spark):
    d = spark.createDataFrame([(f"k{i:03d}", "abc"[min(i // 45, 2)], i % 7) for i in range(100)], "key string, g string, size int")
    for n in (0, 101):
        with pytest.raises(ValueError):
            S.random_sample(d, "key", n, 1)
    assert S.random_sample(d, "key", 10, 1).collect() == S.random_sample(d.repartition(7), "key", 10, 1).collect()
    assert S.stratified(d, "key", F.col("g"), 21, 5).count() == 21
    got = [tuple(r) for r in S.row_ids(d.select("key").repartition(5), "key").orderBy("row_id").collect()]
    assert got == [(f"k{i:03d}", i) for i in range(100)]
    assert [r["bytes"] for r in S.largest(d, "g", "size", 2, 1).collect()] == sorted((r["s"] for r in d.groupBy("g").agg(F.sum("size").alias("s")).collect()), reverse=True)[:2]


def plain_quotas(counts, n):
    """One change at a time."""
    total = sum(counts.values())
    out = {k: min(c, max(1, round(n * c / total))) for k, c in counts.items()}
    while (over := sum(out.values()) - n) != 0:
        if over > 0:
            out[max(out, key=lambda k: (out[k], k))] -= 1
        else:
            k = max(out, key=lambda k: (counts[k] - out[k], k))
            if counts[k] == out[k]:
                break
            out[k] += 1
    return out


def test_quotas_equal_single_changes(spark):
    r = random.Random(4)
    cases = [({"a": 45, "b": 45, "c": 10}, 21), ({"a": 1, "b": 999}, 10), ({"a": 5}, 9), ({f"k{i}": 1 for i in range(30)}, 7), ({"a": 3, "b": 3, "c": 3}, 4)]
    cases += [({f"k{i:02d}": int(10 ** (3 * r.random())) for i in range(r.randint(1, 40))}, r.randint(1, 300)) for _ in range(12)]
    for counts, n in cases:
        strata = spark.createDataFrame(list(counts.items()), "stratum string, count long")
        assert {x["stratum"]: x["quota"] for x in quotas(strata, n).collect()} == plain_quotas(counts, n), (counts, n)
    assert quotas(spark.createDataFrame([], "stratum string, count long"), 5).count() == 0


def test_very_many_strata(spark):
    d = spark.range(130_000).select(F.concat(F.lit("k"), F.col("id")).alias("key"), F.when(F.col("id") < 30_000, F.lit(-1)).otherwise(F.col("id")).alias("g"))
    got = S.stratified(d, "key", F.col("g"), 90_000, 3)
    n, of_large = got.agg(F.count(F.lit(1)), F.count_if(F.col("g") == -1)).first()
    # 100,000 strata of one row and one of 30,000: its share of 20,769 goes down to 1, then the last strata by name give theirs up.
    assert (n, of_large) == (90_000, 1)


def test_strata_are_first_by_hash(spark):
    d = spark.createDataFrame([(f"k{i:04d}", "abc"[min(i // 450, 2)]) for i in range(1000)], "key string, g string")
    got = {r["key"] for r in S.stratified(d.repartition(5), "key", F.col("g"), 100, 5).collect()}
    q = plain_quotas({"a": 450, "b": 450, "c": 100}, 100)
    by = {}
    for r in d.collect():
        by.setdefault(r["g"], []).append((hashlib.md5(f"{r['key']}:5".encode()).hexdigest(), r["key"]))
    assert got == {k for g, rows in by.items() for _, k in sorted(rows)[: q[g]]}


@pytest.mark.parametrize("size", [1 << 20, 37])
def test_faults_of_tsv_files(spark, tmp_path, size):
    """Places in files, whether these are read whole or in parts of a few lines."""
    cols = ("A", "B", "C")
    bodies = {"good": "A\tB\tC\n" + "1\t2\t3\n" * 20, "bad": "A\tX\tC\n1\t2\t3\r\n\n1\t2\n" + "é\t\t\n" * 15 + "1\t2\t3\t4\n\r\n9", "empty": "", "crlf": "A\tB\tC\r\n", "names": "A\tB\n"}
    for name, body in bodies.items():
        (tmp_path / f"{name}.tsv").write_bytes(body.encode())
    want = []
    for name, body in bodies.items():
        at = 0
        for k, line in enumerate(body.encode().split(b"\n")[: None if body and not body.endswith("\n") else -1]):
            bare = line.removesuffix(b"\r")
            n = bare.count(b"\t") + 1
            fault = "header" if k == 0 and bare != b"A\tB\tC" else "blank" if not bare else "carriage_return" if line != bare else "short" if n < 3 and k else "long" if n > 3 and k else None
            if fault:
                want.append((f"{name}.tsv", k + 1, at, n, fault, line.decode()))
            at += len(line) + 1
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        got = R.tsv_faults(spark, str(tmp_path), cols).withColumn("file", F.element_at(F.split("file", "/"), -1)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(map(tuple, got)) == sorted(want) and len(want) == 9


def test_lookups_read_few_rows(spark, tmp_path):
    d = spark.range(200_000).select(F.concat(F.lit("R"), F.col("id")).alias("run"), F.concat(F.lit("S"), (F.col("id") * 7919) % 200_003).alias("sample"), F.sha2(F.col("id").cast("string"), 256).alias("more"))
    Y.write_sorted(d, str(tmp_path / "t"), "run", ("sample",), group=1 << 20)
    t = spark.read.parquet(str(tmp_path / "t"))
    for c, v in (("run", "R77"), ("sample", f"S{77 * 7919 % 200_003}")):
        hit = I.lookup(t, c, v)
        assert [r["run"] for r in hit.collect()] == ["R77"] and f"EqualTo({c},{v})" in hit._jdf.queryExecution().toString()
        assert 0 < Y.rows_read(hit) < 40_000
    assert Y.rows_read(t) == 200_000 and Y.rows_read(I.lookup(t, "sample", "none")) < 40_000


def test_chains_over_buckets_dont_exchange_runs(spark, tmp_path):
    runs = spark.range(3000).select(F.concat(F.lit("R"), F.col("id")).alias("run_accession"), F.concat(F.lit("X"), F.col("id") % 500).alias("experiment_accession"))
    of = lambda n, *cols: spark.range(n).select(*[F.concat(F.lit(c[0].upper()), F.col("id")).alias(c) for c in cols])
    e = of(400, "xexperiment").select(F.col("xexperiment").alias("experiment_accession"), F.lit("S1").alias("sample_accession"), F.lit("P1").alias("study_accession"), F.lit("p").alias("platform"), F.lit("l").alias("library_strategy"))
    s = of(5, "sample_accession").select("sample_accession", *[F.lit("v").alias(c) for c in ("bio_sample_id", "taxon_id", "scientific_name")])
    st = of(5, "pstudy").select(F.col("pstudy").alias("study_accession"), F.lit("b").alias("bioproject_id"), F.lit("t").alias("study_title"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        table = Y.bucketed(runs, str(tmp_path / "runs"), "experiment_accession", buckets=6)
        chained, plain = I.chain(table, e, s, st), I.chain(runs, e, s, st)
        exchanges = lambda d: [x for x in d._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange hashpartitioning(experiment_accession" in x]
        assert len(exchanges(chained)) == 1 and len(exchanges(plain)) == 2  # the experiments' side alone
        assert sorted(map(str, chained.collect())) == sorted(map(str, plain.collect()))
        # A third of the runs belong to one experiment: they are dealt to many buckets, and nothing else changes.
        skewed = runs.union(spark.range(5000, 6500).select(F.concat(F.lit("R"), F.col("id")), F.lit("X7")))
        hot = Y.frequent(skewed, "experiment_accession")
        spread = Y.bucketed(Y.salted(skewed, hot, "experiment_accession"), str(tmp_path / "skewed"), "experiment_accession", "salt", buckets=6)
        assert [r[0] for r in hot.collect()] == ["X7"] and spread.where("experiment_accession = 'X7'").select("salt").distinct().count() == Y.SALTS
        most = spread.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
        assert most < 1200 < 4500 / 3
        again = I.chain(spread, e, s, st, hot)
        assert len([x for x in exchanges(again) if "salt" in x]) == 1
        assert sorted(map(str, again.select(plain.columns).collect())) == sorted(map(str, I.chain(skewed, e, s, st).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_compare(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "metric string, n long")
    b = spark.createDataFrame([("y", 2), ("z", 3)], "metric string, n long")
    got = {r["key"]: (r["delta"], r["match"]) for r in K.compare_counts(a, b).collect()}
    assert got == {"x": (1, False), "y": (0, True), "z": (-3, False)}
    rows = spark.createDataFrame([("f", "p", None), ("f", "p", None), ("f", "q", "1")], "g string, a string, b string")
    r = K.multiset_compare(rows, rows.limit(1).union(rows.where("a = 'q'")).union(spark.sql("select 'f', 'w', 'w'")), "g", ["a", "b"]).first()
    assert (r["matched"], r["missing"], r["extra"]) == (2, 1, 1)


def test_linkage(spark):
    runs = spark.createDataFrame([("r1", "S1", "P1", "9"), ("r2", "-", "P1", "9"), ("r3", None, "", "9"), ("r4", None, None, None)], "run string, biosample string, bioproject string, taxid string")
    asm = spark.createDataFrame([("G1", "S1", "P1", "9"), ("G2", None, "P1", "9")], "assembly_accession string, biosample string, bioproject string, taxid string")
    linked = L.link_runs(runs, asm)
    assert {(r["run"], r["tier"], r["n"], r["least"]) for r in linked.collect()} == {("r1", 1, 1, "G1"), ("r2", 2, 2, "G1"), ("r3", 3, 2, "G1")}
    pairs = linked.join(L.tier_members(asm), ["tier", "value"]).select("run", "assembly_accession", "tier")
    assert {tuple(r) for r in pairs.collect()} == {("r1", "G1", 1), ("r2", "G1", 2), ("r2", "G2", 2), ("r3", "G1", 3), ("r3", "G2", 3)}


def test_mixed_sample(spark):
    """Strata, then the largest, then others by hash; no unit twice, the same whatever the partitions."""
    d = spark.createDataFrame([(f"{'abc'[i % 3]}a{i:03d}", i % 11) for i in range(60)], "unit string, size int")
    got = sorted(r["unit"] for r in S.mixed(d, "unit", "size", 20, 3).collect())
    assert len(got) == len(set(got)) == 20 and got == sorted(r["unit"] for r in S.mixed(d.repartition(5), "unit", "size", 20, 3).collect())
    strata = {r["unit"] for r in S.stratified(d.select("unit"), "unit", F.substring("unit", 1, 3), 14, 3).collect()}
    left = {r["unit"]: r["size"] for r in d.collect() if r["unit"] not in strata}
    largest = sorted(left, key=lambda u: (left[u], u))[-4:]
    assert strata | set(largest) <= set(got)


def test_strata_are_limited_before_the_shuffle(spark):
    d = spark.range(1000).withColumn("g", F.when(F.col("id") < 900, "a").otherwise("b"))
    got = S.stratified(d, "id", F.col("g"), 50, 42)
    assert {r["g"]: r["count"] for r in got.groupBy("g").count().collect()} == {"a": 45, "b": 5}
    assert "WindowGroupLimit" in got._jdf.queryExecution().executedPlan().toString()
