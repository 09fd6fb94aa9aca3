import os
import shutil
import uuid

import pytest
from pyspark.sql import functions as F

from tidemark.functions import contract as C
from tidemark.operators import backcheck as B
from tidemark.operators import build as U
from tidemark.operators import chunks as K
from tidemark.operators import index as I
from tidemark.operators import validate as V
from tidemark.operators import validation as W
from tidemark.sources import commit as M
from tidemark.sources import tables as R
from tidemark.sources import trees as T
from tidemark.sources import xml_files as P
from tidemark.streaming import ingest as I1

SNAPSHOT = "2026-01-01"
FILES = {
    "A1/A1.run.xml": '<?xml version="1.0"?><RUN_SET><RUN accession="R1" alias="a"><EXPERIMENT_REF accession="X1"/></RUN><RUN accession="R2"><EXPERIMENT_REF accession="X1"/></RUN></RUN_SET>',
    "A1/A1.experiment.xml": '<EXPERIMENT_SET><EXPERIMENT accession="X1"><STUDY_REF accession="P1"/><DESIGN><SAMPLE_DESCRIPTOR accession="S1"/><LIBRARY_DESCRIPTOR><LIBRARY_STRATEGY>WGS</LIBRARY_STRATEGY></LIBRARY_DESCRIPTOR></DESIGN><PLATFORM><ILLUMINA><INSTRUMENT_MODEL>m</INSTRUMENT_MODEL></ILLUMINA></PLATFORM></EXPERIMENT></EXPERIMENT_SET>',
    "A2/A2.sample.xml": '<SAMPLE_SET><SAMPLE accession="S1"><IDENTIFIERS><EXTERNAL_ID namespace="other">z</EXTERNAL_ID><EXTERNAL_ID namespace="BioSample">B1</EXTERNAL_ID></IDENTIFIERS><SAMPLE_NAME><TAXON_ID>9</TAXON_ID><SCIENTIFIC_NAME>x y</SCIENTIFIC_NAME></SAMPLE_NAME><SAMPLE_ATTRIBUTES><SAMPLE_ATTRIBUTE><TAG>t</TAG><VALUE>v &amp; w</VALUE></SAMPLE_ATTRIBUTE><SAMPLE_ATTRIBUTE><TAG>e</TAG></SAMPLE_ATTRIBUTE></SAMPLE_ATTRIBUTES></SAMPLE></SAMPLE_SET>',
    "A2/A2.study.xml": '<STUDY_SET><STUDY accession="P1"><IDENTIFIERS><EXTERNAL_ID namespace="BioProject">J1</EXTERNAL_ID></IDENTIFIERS><DESCRIPTOR><STUDY_TITLE>title</STUDY_TITLE><STUDY_TYPE existing_study_type="Other"/></DESCRIPTOR></STUDY></STUDY_SET>',
    "A3/A3.study.xml": "",
}


@pytest.fixture(scope="module")
def files(spark):
    rows = [(f"/root/{p}", x.encode(), len(x)) for p, x in FILES.items()]
    return spark.createDataFrame(rows, "path string, content binary, length long").withColumn("modificationTime", F.lit("2026-01-01").cast("timestamp"))


def test_whole_build(spark, files, tmp_path):
    got = {r["table"]: r["rows"] for r in U.build(files, str(tmp_path / "out"), str(tmp_path / "work"), SNAPSHOT, chunk_size=2).collect()}
    assert list(got) == list(C.TABLES) and len(got) == 26
    assert got["file_index"] == 5 and got["entity_record_index"] == 5 and got["relation_index"] == 7 and got["chunk_manifest"] == 2 and got["directory_index"] == 3
    table = lambda t: R.open_table(spark, str(tmp_path / "out"), t)
    status = {r["chunk_id"]: (r["error_count"], r["row_counts_by_table"]) for r in table("chunk_status_summary").collect()}
    assert status["chunk_00000000_00000001"] == (0, '{"entity_record_index":5,"experiment_core":1,"external_accession_index":3,"file_index":4,"relation_index":7,"run_core":2,"sample_attribute_core":2,"sample_core":1,"study_core":1}')
    assert status["chunk_00000002_00000002"] == (1, '{"file_index":1}')
    built = table("build_manifest").first()
    assert built["source_root"] == "/root" and built["manifest_row_count"] == 3 and built["build_status"] == "succeeded"
    assert {r["closure_status"] for r in table("relation_index").collect()} == {"closed", "external_reference"}
    broken = table("parse_qc_summary").withColumn("severity", F.lit("odd"))
    assert [tuple(r) for r in V.all_enum_errors({"parse_qc_summary": broken, "entity_qc_summary": table("entity_qc_summary")}).collect()] == [("parse_qc_summary", "severity", "odd")]


def contents_of(spark, root, at_rest=("started_at", "finished_at", "attempts", "mtime", "source_root", "output_root")):
    """The rows of all tables, without times and places."""
    tables = {t: R.open_table(spark, root, t) for t in C.TABLES}
    return {t: sorted(str(tuple(r)) for r in d.select(*[c for c in d.columns if c not in at_rest]).collect()) for t, d in tables.items()}


def test_a_stopped_build_goes_on(spark, tmp_path):
    """Chunks that failed are parsed by the next call, and only these; the tables are those of a build in one go."""
    tree, out, work = str(tmp_path / "tree"), str(tmp_path / "out"), str(tmp_path / "work")
    more = FILES | {f"B{k}/B{k}.study.xml": f'<STUDY_SET><STUDY accession="Q{k}"/></STUDY_SET>' for k in range(5)}
    T.write_files(spark.createDataFrame([(p, x.encode()) for p, x in more.items()] + [("C0", None)], "name string, content binary"), tree)
    listing = T.listed(spark, tree)
    # A directory that can't be listed stays in the plan: its file's path leads nowhere.
    gone = F.when(F.col("path").endswith("B1.study.xml"), F.concat("path", F.lit(".gone"))).otherwise(F.col("path"))
    with pytest.raises(K.Incomplete, match="chunk_00000004_00000005"):
        U.build(listing.withColumn("path", gone), out, work, SNAPSHOT, chunk_size=2, at_once=3)
    first = {r["chunk_id"]: r for r in K.ledger(spark, work).collect()}
    assert len(first) == 5 and [c for c, r in first.items() if r["exit_code"]] == ["chunk_00000004_00000005"]
    assert first["chunk_00000004_00000005"]["attempts"] == 2 and not os.path.exists(out)
    for p in ("A1", "A2", "A3", "B0"):  # what is done isn't read again
        shutil.move(f"{tree}/{p}", f"{tree}-{p}")
    U.build(listing_as(spark, more, tree), out, work, SNAPSHOT, chunk_size=2, at_once=3)
    second = {r["chunk_id"]: r for r in K.ledger(spark, work).collect()}
    assert all(r == first[c] for c, r in second.items() if c != "chunk_00000004_00000005") and all(r["exit_code"] == 0 for r in second.values())
    for p in ("A1", "A2", "A3", "B0"):
        shutil.move(f"{tree}-{p}", f"{tree}/{p}")
    U.build(T.listed(spark, tree), f"{out}2", f"{work}2", SNAPSHOT, chunk_size=2)
    assert contents_of(spark, out) == contents_of(spark, f"{out}2")
    empty = R.open_table(spark, out, "directory_index").where("directory_accession = 'C0'").first()
    assert empty["file_count"] == 0 and R.open_table(spark, out, "chunk_status_summary").count() == 5
    with pytest.raises(ValueError, match="other directories"):
        U.build(T.listed(spark, tree).where("directory_accession <> 'B3'"), out, work, SNAPSHOT, chunk_size=2)


def listing_as(spark, files, root):
    """The listing of the tree as it was before directories went."""
    rows = [(p.split("/")[0], f"file://{root}/{p}", len(x)) for p, x in files.items()] + [("C0", None, None)]
    return spark.createDataFrame(rows, "directory_accession string, path string, length long").withColumn("modificationTime", F.current_timestamp())


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    row = {"source_snapshot_id": "s", "xml_kind": "run", "file_count": 1, "parse_success_count": 1, "parse_failed_count": 0, "severity": "report_only"}
    good = spark.createDataFrame([row], ", ".join(f"{c} {'long' if c.endswith('count') else 'string'}" for c in row))
    R.write_contract(good, path, "parse_qc_summary")
    many = spark.range(0, 4000, 1, 8).select(*[F.lit(v).alias(c) for c, v in row.items() if c != "severity"], F.when(F.col("id") < 3900, "warning").alias("severity"))
    with pytest.raises(Exception, match="severity is null"):
        R.write_contract(many, path, "parse_qc_summary")
    assert spark.read.parquet(path).collect()[0].asDict() == row and os.listdir(tmp_path) == ["t.parquet"]
    R.write_contract(spark.read.parquet(path).union(good), path, "parse_qc_summary")  # a table may be made from itself
    assert spark.read.parquet(path).count() == 2


def test_a_commit_that_was_killed(spark, tmp_path):
    for name in ("_former-t", "_staged-1-t"):
        (tmp_path / name).mkdir()
    M.recover(spark, str(tmp_path / "t"))
    assert sorted(os.listdir(tmp_path)) == ["_staged-1-t", "t"]
    M.commit(spark, str(tmp_path / "_staged-1-t"), str(tmp_path / "t"))
    assert os.listdir(tmp_path) == ["t"]
    with pytest.raises(Exception, match="_staged-"), M.staging(spark, str(tmp_path / "t")):  # nothing was written
        pass
    assert os.listdir(tmp_path) == ["t"]


def test_a_tree_of_many_directories(spark, tmp_path):
    """Listed by tasks, equal to the manifest that made it; empty directories and files included."""
    rows = spark.range(2000).select(F.concat(F.lit("D"), F.col("id").cast("string")).alias("d"), F.col("id"))
    some = rows.where("id % 7 <> 0")
    files = some.select(F.concat("d", F.lit("/"), "d", F.lit(".run.xml")).alias("name"), F.encode(F.repeat(F.lit("x"), (F.col("id") % 5).cast("int")), "UTF-8").alias("content"))
    more = some.where("id % 3 = 0").select(F.concat("d", F.lit("/notes.txt")).alias("name"), F.encode(F.lit("left out"), "UTF-8").alias("content"))
    assert T.write_files(files.union(more).union(rows.where("id % 7 = 0").select("d", F.lit(None).cast("binary"))), str(tmp_path / "t"))[0] == files.count() + more.count()
    want = {f"D{i}": (int(i % 7 > 0), i % 5 if i % 7 else 0, int(i % 7 > 0 and i % 5 == 0)) for i in range(2000)}
    listing = T.listed(spark, str(tmp_path / "t"))
    assert {r[0]: tuple(r[1:]) for r in T.file_counts(listing).collect()} == want
    read = T.contents(listing).select("length", F.length("content").alias("n"), "modificationTime").collect()
    assert len(read) == files.count() and all(r["n"] == r["length"] and r["modificationTime"] for r in read)
    assert T.directories(spark, str(tmp_path / "t")).count() == 2000


def test_a_build_without_files(files, tmp_path):
    got = {r["table"]: r["rows"] for r in U.build(files.where("length < 0"), str(tmp_path / "o"), str(tmp_path / "w"), SNAPSHOT).collect()}
    assert {t for t, n in got.items() if n} == {"build_manifest"}


def test_lots_equal_one_build(spark, tmp_path):
    """Files that come in lots, the target of an edge after the edge, give the tables of one build, whether by stream or by listing."""
    tree, out = str(tmp_path / "tree"), str(tmp_path / "out")
    lots = [["A1/A1.run.xml", "A3/A3.study.xml"], ["A2/A2.study.xml", "A1/A1.experiment.xml"], [], ["A2/A2.sample.xml", "A4/A4.run.xml"]]
    texts = FILES | {"A4/A4.run.xml": FILES["A1/A1.run.xml"].replace('alias="a"', 'alias="b"')}
    states = []
    for lot in lots:
        if lot:
            T.write_files(spark.createDataFrame([(p, texts[p].encode()) for p in lot], "name string, content binary"), tree)
        I1.ingest_listed(spark, tree, out, SNAPSHOT, buckets=4)
        I1.ingest(spark, tree, f"{out}-stream", str(tmp_path / "log"), SNAPSHOT, buckets=4)
        states.append({(r["src_accession"], r["relation_type"]): r["closure_status"] for r in I1.relation_index(spark, out).collect()})
    assert states[0] == {("R1", "RUN_TO_EXPERIMENT"): "missing_dst_entity", ("R2", "RUN_TO_EXPERIMENT"): "missing_dst_entity"}
    assert states[1][("R1", "RUN_TO_EXPERIMENT")] == "closed" and states[1][("X1", "EXPERIMENT_TO_SAMPLE")] == "missing_dst_entity" and states[3][("X1", "EXPERIMENT_TO_SAMPLE")] == "closed"
    U.build(T.listed(spark, tree), str(tmp_path / "whole"), str(tmp_path / "work"), SNAPSHOT)
    whole = {t: R.open_table(spark, str(tmp_path / "whole"), t) for t in C.TABLES}
    for root in (out, f"{out}-stream"):
        got = {"entity_index": I1.entity_index(spark, root), "relation_index": I1.relation_index(spark, root), "xml_path_inventory": I1.inventory(spark, root)}
        got |= {t: spark.read.parquet(f"{root}/{t}") for t in ("run_core", "experiment_core", "sample_core", "study_core", "sample_attribute_core", "external_accession_index", "entity_record_index", "file_index")}
        for name, d in got.items():
            want = whole[name].where("file_size > 0") if name == "file_index" and root != out else whole[name]
            columns = [c for c in want.columns if c not in ("mtime", "absolute_file_path")]
            assert sorted(map(str, d.select(*columns).collect())) == sorted(map(str, want.select(*columns).collect())), (root, name)
    assert {r["batch"] for r in spark.read.parquet(f"{out}/file_index").select("batch").distinct().collect()} == {0, 1, 2}


def test_second_reading_finds_extraction_errors(files):
    def checks(wrong=lambda k, v: v):
        r = P.entity_records(P.parsed(files, SNAPSHOT)).withColumn("fields", F.transform_values("fields", wrong))
        samples = B.reread(files, SNAPSHOT, "SAMPLE")
        fields = {c["column"]: c["matches"] for c in V.field_check(B.core(samples, "SAMPLE"), P.core(r, "SAMPLE"), ["file_id", "sample_accession"], ["bio_sample_id", "taxon_id", "scientific_name"]).collect()}
        edges = [B.edges(B.reread(files, SNAPSHOT, k), k) for k in ("RUN", "EXPERIMENT", "SAMPLE", "STUDY")]
        e = V.edge_check(edges[0].union(edges[1]).union(edges[2]).union(edges[3]), I.relations(r))
        a = V.attribute_check(B.attributes(samples), P.sample_attributes(r))
        return fields, *[tuple(x.agg(F.sum("matched"), F.sum("missing"), F.sum("extra")).first()) for x in (e, a)]

    assert checks() == ({"bio_sample_id": 1, "taxon_id": 1, "scientific_name": 1}, (7, 0, 0), (2, 0, 0))
    wrong = lambda k, v: F.when(k == "taxon_id", "8").when(k == "experiment_accession", "X9").otherwise(v)
    fields, edges, _ = checks(wrong)
    assert fields == {"bio_sample_id": 1, "taxon_id": 0, "scientific_name": 1} and edges == (4, 3, 3)


MORE = {
    "A4/A4.submission.xml": '<SUBMISSION_SET><SUBMISSION accession="U1" alias="u" center_name="c" lab_name="l"/></SUBMISSION_SET>',
    "A4/A4.analysis.xml": '<ANALYSIS_SET><ANALYSIS accession="Z1" alias="z" center_name="c"><TITLE>t</TITLE></ANALYSIS></ANALYSIS_SET>',
    "A5/A5.study.xml": '<STUDY_SET><STUDY><IDENTIFIERS><PRIMARY_ID>P2</PRIMARY_ID></IDENTIFIERS><STUDY_LINKS><STUDY_LINK><XREF_LINK><DB>bioproject</DB><ID>7</ID><LABEL>J2</LABEL></XREF_LINK></STUDY_LINK></STUDY_LINKS><DESCRIPTOR><STUDY_TYPE>Own</STUDY_TYPE></DESCRIPTOR></STUDY></STUDY_SET>',
    "A5/A5.experiment.xml": '<EXPERIMENT_SET><EXPERIMENT accession="X2"><DESIGN><LIBRARY_DESCRIPTOR><LIBRARY_SOURCE>s</LIBRARY_SOURCE><LIBRARY_SELECTION>e</LIBRARY_SELECTION></LIBRARY_DESCRIPTOR></DESIGN><PLATFORM><PACBIO_SMRT instrument_model="own"><INSTRUMENT_MODEL>other</INSTRUMENT_MODEL></PACBIO_SMRT></PLATFORM></EXPERIMENT></EXPERIMENT_SET>',
}


def test_validation_of_all_kinds_and_fields(spark, tmp_path):
    rows = [(f"/root/{p}", x.encode(), len(x)) for p, x in (FILES | MORE).items()]
    files = spark.createDataFrame(rows, "path string, content binary, length long").withColumn("modificationTime", F.lit("2026-01-01").cast("timestamp"))
    parsed = P.parsed(files, SNAPSHOT)

    def found(wrong=lambda k, v: v, n=100):
        r = P.entity_records(parsed).withColumn("fields", F.transform_values("fields", wrong))
        tables = {f"{k.lower()}_core": P.core(r, k) for k in B.KINDS} | {"relation_index": I.relations(r), "sample_attribute_core": P.sample_attributes(r)}
        return W.compared(files, P.file_index(parsed), tables, SNAPSHOT, str(tmp_path / uuid.uuid4().hex), n)

    whole = found().collect()
    assert [x for x in whole if x["checks"] != x["matches"]] == []
    assert {(x["table"], x["column"]) for x in whole} == {(f"{k.lower()}_core", c) for k, (key, cs) in P._CORE.items() for c in (key, *cs)} | {("relation_index", None), ("sample_attribute_core", None)}
    assert {x["metric"]: x["status"] for x in W.judged(found()).collect()} == {"core": "pass", "ids": "pass", "edges": "pass", "attributes": "report_only"}
    for field, metric in (("instrument_model", "core"), ("taxon_id", "ids"), ("lab_name", "core"), ("library_selection", "core")):
        worse = {x["metric"]: x["status"] for x in W.judged(found(_changed(field))).collect()}
        assert worse[metric] == "fail", field
    assert sum(x["checks"] for x in found(n=1).collect()) < sum(x["checks"] for x in whole)


def _changed(field):
    return lambda k, v: F.when(k == field, "wrong").otherwise(v)
