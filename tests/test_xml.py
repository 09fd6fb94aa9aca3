"""XML extraction on hand-made files, odd ones included."""

import re
import xml.etree.ElementTree as ET

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import index as I
from tidemark.sources import xml_files as P

FILES = {
    "D1/D1.sample.xml": '<SAMPLE_SET xmlns="urn:x"><SAMPLE accession="S1" alias="a"><IDENTIFIERS><PRIMARY_ID>P1</PRIMARY_ID><EXTERNAL_ID namespace="BioSample"> SAMN1 </EXTERNAL_ID></IDENTIFIERS>'
    '<SAMPLE_NAME><TAXON_ID>9</TAXON_ID></SAMPLE_NAME><SAMPLE_LINKS><SAMPLE_LINK><XREF_LINK><DB>bioproject</DB><ID>7</ID><LABEL>PRJ7</LABEL></XREF_LINK></SAMPLE_LINK></SAMPLE_LINKS>'
    f'<SAMPLE_ATTRIBUTES><SAMPLE_ATTRIBUTE><TAG>t</TAG><VALUE>{"v" * 2001}</VALUE></SAMPLE_ATTRIBUTE><SAMPLE_ATTRIBUTE><TAG>u</TAG></SAMPLE_ATTRIBUTE></SAMPLE_ATTRIBUTES></SAMPLE>'
    "<SAMPLE><IDENTIFIERS><PRIMARY_ID>S2</PRIMARY_ID></IDENTIFIERS></SAMPLE><SAMPLE/></SAMPLE_SET>",
    "D1/D1.run.xml": '<RUN_SET><RUN accession="R1"><EXPERIMENT_REF accession="X1"/></RUN><RUN accession="R2"><EXPERIMENT_REF accession="X9"/></RUN></RUN_SET>',
    "D2/D2.run.xml": '<RUN_SET><RUN accession="R1"><EXPERIMENT_REF accession="X1"/></RUN></RUN_SET>',
    "D2/D2.experiment.xml": '<EXPERIMENT_SET><EXPERIMENT accession="X1"><STUDY_REF accession="T1"/><PLATFORM><ILLUMINA><INSTRUMENT_MODEL>m</INSTRUMENT_MODEL></ILLUMINA></PLATFORM></EXPERIMENT></EXPERIMENT_SET>',
    "D3/D3.run.xml": "",
    "D3/D3.study.xml": "<STUDY_SET><STUDY",
    "D3/D3.submission.xml": '<SUBMISSION accession="A1"/>',
    "D4/D4.run.xml": '<SAMPLE_SET><SAMPLE accession="S9"/></SAMPLE_SET>',
}


@pytest.fixture(scope="module")
def parsed(spark):
    rows = [(f"/x/{p}", "2026-05-16 01:02:03", len(t), bytearray(t.encode())) for p, t in FILES.items()]
    d = spark.createDataFrame(rows, "path string, t string, length long, content binary").selectExpr("path", "cast(t as timestamp) as modificationTime", "length", "content")
    return P.parsed(d, "s", with_nodes=True).persist()


def test_file_index(parsed):
    got = {r["relative_file_path"]: (r["parse_status"], r["xml_kind"], r["xml_kind_consistency_status"], r["entity_count"]) for r in P.file_index(parsed).collect()}
    assert got["D1/D1.sample.xml"] == ("ok", "sample", "consistent", 3)
    assert got["D3/D3.run.xml"] == ("empty_file", "run", "unknown", 0)
    assert got["D3/D3.study.xml"] == ("xml_parse_error", "study", "unknown", 0)
    assert got["D3/D3.submission.xml"] == ("unsupported_root", "submission", "unknown", 1)
    assert got["D4/D4.run.xml"] == ("ok", "sample", "mismatch", 1)


def test_records_and_core(parsed):
    r = P.entity_records(parsed)
    samples = {x["sample_accession"]: x for x in P.core(r, "SAMPLE").collect()}
    assert samples["S1"]["bio_sample_id"] == "SAMN1" and samples["S1"]["taxon_id"] == "9" and samples["S2"]["taxon_id"] is None and "" in samples
    assert {(x["accession_source_path"], x["parse_status"]) for x in r.where("entity_type = 'SAMPLE'").collect()} == {("@accession", "ok"), ("PRIMARY_ID", "ok"), (None, "missing_accession")}
    attrs = [(x["tag"], x["attribute_ordinal"], x["value_truncated"], len(x["value"] or "")) for x in P.sample_attributes(r).orderBy("attribute_ordinal").collect()]
    assert attrs == [("t", 1, True, 2000), ("u", 2, False, 0)]
    assert P.core(r, "EXPERIMENT").first()["platform"] == "ILLUMINA"


def test_entities_and_closure(parsed):
    r = P.entity_records(parsed)
    e = I.entity_index(r)
    run = e.where("entity_accession = 'R1'").first()
    assert (run["record_count"], run["file_count"], run["directory_count"]) == (2, 2, 2)
    assert run["canonical_entity_record_id"] == I.canonical_records(r).where("entity_accession = 'R1'").first()["entity_record_id"]
    c = I.closed_relations(I.relations(r), e)
    states = {(x["src_accession"], x["relation_type"]): x["closure_status"] for x in c.collect()}
    assert states[("R1", "RUN_TO_EXPERIMENT")] == "closed" and states[("R2", "RUN_TO_EXPERIMENT")] == "missing_dst_entity" and states[("S1", "SAMPLE_TO_TAXON")] == "external_reference"
    qc = {x["relation_type"]: (x["closure_rate"], x["severity"]) for x in I.closure_qc(c).collect()}
    assert qc["EXPERIMENT_TO_STUDY"] == (0.0, "hard_fail") and qc["SAMPLE_TO_TAXON"] == (None, "report_only")
    with pytest.raises(ValueError):
        I.closure_gate(I.closure_qc(c))
    with pytest.raises(ValueError):
        I.key_gate(r, "entity_accession")


def test_inventory(parsed):
    inv = {(x["path_abs"], x["entity_type"]): x for x in I.path_inventory(P.xml_nodes(parsed)).collect()}
    tag = inv[("/SAMPLE_SET/SAMPLE/SAMPLE_ATTRIBUTES/SAMPLE_ATTRIBUTE/TAG", "SAMPLE")]
    assert (tag["node_occurrence_count"], tag["entity_coverage_count"], tag["path_entity_relative"]) == (2, 1, "/SAMPLE_ATTRIBUTES/SAMPLE_ATTRIBUTE/TAG")
    value = inv[("/SAMPLE_SET/SAMPLE/SAMPLE_ATTRIBUTES/SAMPLE_ATTRIBUTE/VALUE", "SAMPLE")]
    assert (value["max_value_length"], len(value["example_value"]), value["example_value_truncated"]) == (2001, 500, True)


def test_large_files_are_parsed(spark):
    text = F.concat(F.lit("<RUN_SET>"), F.repeat(F.concat(F.lit('<RUN accession="R1"/>'), F.repeat(F.lit(" "), 1 << 20)), 66), F.lit("</RUN_SET>"))
    files = spark.range(1).select(F.lit("/x/D/D.run.xml").alias("path"), F.current_timestamp().alias("modificationTime"), F.encode(text, "UTF-8").alias("content")).withColumn("length", F.length("content").cast("long"))
    got = P.parsed(files, "s").select("file_size", "parse_status", "entity_count").first()
    assert got["file_size"] > 64 << 20 and (got["parse_status"], got["entity_count"]) == ("ok", 66)


def test_streamed_entities_equal_the_trees():
    inner = '<a:RUN xmlns:a="u" accession="R2"><EXPERIMENT_REF accession="X1"/></a:RUN>'
    for body in ("", "<RUN_SET/>", f"<RUN_SET>t{inner}t<G><H>{inner}</H><TITLE/></G>{inner}</RUN_SET>", f'<SUBMISSION accession="A"><TITLE>b {inner} c</TITLE>{inner}</SUBMISSION>', f"<RUN_SET>{inner}", "<RUN_SET></RUN>"):
        try:
            tree = ET.fromstring(body)
        except ET.ParseError as e:
            with pytest.raises(ET.ParseError, match=re.escape(str(e))):
                P._streamed(body.encode())
        else:
            for paths in (None, P._Paths()):
                root, entities = P._streamed(body.encode(), paths)
                assert (root.tag, entities) == (tree.tag, P._entities(tree))
            counts = P._Paths()
            for n in P._nodes(tree):
                counts.add(n["entity_type"], n["accession"], n["path"], n["is_attribute"], n["value"], len(n["value"]))
            assert paths.of == counts.of


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", " ", "\n b ", "<G>", "</G>", "<G/>", "<RUN accession='R1'>", "</RUN>", "<RUN/>", "<SAMPLE accession='S'>x", "</SAMPLE>", "é" * 300, "<H k=' v  w '/>"]), max_size=14).map("".join))
def test_counts_of_paths_are_those_of_the_nodes(inner):
    body = f"<RUN_SET>{inner}</RUN_SET>"
    try:
        tree = ET.fromstring(body)
    except ET.ParseError:
        return
    counts, paths = P._Paths(), P._Paths()
    for n in P._nodes(tree):
        counts.add(n["entity_type"], n["accession"], n["path"], n["is_attribute"], n["value"], len(n["value"]))
    P._streamed(body.encode(), paths)
    assert paths.of == counts.of


def test_path_counts_equal_parts_of_nodes(spark):
    rows = [(f"/x/{p}", len(t), bytearray(t.encode())) for p, t in FILES.items()]
    d = spark.createDataFrame(rows, "path string, length long, content binary").withColumn("modificationTime", F.current_timestamp())
    flat = lambda x: sorted(str(r) for r in x.withColumn("entities", F.array_sort("entities")).select(sorted(x.columns)).collect())
    got = flat(P.path_counts(P.parsed(d, "s", with_paths=True)))
    assert got == flat(I.path_parts(P.xml_nodes(P.parsed(d, "s", with_nodes=True)))) and len(got) > 30
