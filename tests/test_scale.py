"""What must not grow with the input: batches in Python, exchanged and stored columns, jobs that read all files again."""

import os

from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.operators import chunks as K
from tidemark.operators import index as I
from tidemark.plans import adapters
from tidemark.plans import index_queries as Q
from tidemark.plans.adapters import xml_files
from tidemark.sources import tables as R
from tidemark.sources import xml_files as P

DATA = "/root/testdata/sf0.001"


def test_slices_are_bounded_by_bytes():
    """Python holds the entities of so many bytes of files at once, however many files a task has."""
    half = P.SLICE // 2
    assert list(P._slices([half] * 5)) == [(0, 2), (2, 2), (4, 1)]
    assert list(P._slices([9 * half, 1, 1])) == [(0, 1), (1, 2)]


def test_text_is_made_after_the_exchange(spark):
    plan = xml_files(spark, DATA, "run")._jdf.queryExecution().optimizedPlan().toString()
    assert "EXPERIMENT_REF" not in plan[plan.index("RepartitionByExpression") :]


def test_kept_records_are_whole_again(spark):
    records = P.entity_records(P.parsed(xml_files(spark, DATA, "sample", "study"), "s"))
    kept = P.stripped(records)
    assert not {"entity_record_id", "entity_path"} & set(kept.columns)
    rows = lambda d: sorted(str(r) for r in d.collect())
    assert P.restored(kept).columns == records.columns and rows(P.restored(kept)) == rows(records)


def test_counted_entities_equal_those_taken_out(spark):
    files = xml_files(spark, DATA, "sample", "broken")
    rows = lambda d: sorted(str(r) for r in P.file_index(d).collect())
    assert rows(P.parsed(files, "s", with_entities=False)) == rows(P.parsed(files, "s"))


def test_files_on_both_sides_of_the_tree_limit(spark):
    files = xml_files(spark, DATA, "sample", "experiment").limit(4).toPandas()
    for content in files["content"]:
        content = bytes(content)
        tree, paths = P.ET.fromstring(content), P._Paths()
        paths.tree(tree)
        streamed = P._Paths()
        root, entities = P._streamed(content, streamed)
        assert entities == P._entities(tree) and streamed.of == paths.of


def test_edges_are_kept_without_ids(spark):
    from __spark_entry__ import queries

    queries()["a31_hard_fail_count"](spark, DATA).collect()
    root = Q._STORES[(spark.sparkContext.applicationId, DATA)]
    kept = spark.read.parquet(f"{root}/relations_in_buckets_of_source_snapshot_id_dst_type_dst_accession")
    assert not [c for c in kept.columns if c.endswith("_id") and c != "source_snapshot_id"]
    names = {f for _, _, found in os.walk(root) for f in found if f.endswith(".parquet")}
    assert names and all(".zstd" in f for f in names)


def test_tasks_grow_with_the_elements(spark, monkeypatch):
    monkeypatch.setattr(adapters, "ELEMENTS", 100)
    orders = adapters.table(spark, DATA, "orders").count()
    assert orders > 400 and xml_files(spark, DATA, "experiment").rdd.getNumPartitions() == -(-orders // 100)


def test_pilot_rows_come_from_the_tasks_that_have_them(spark, tmp_path):
    assert R.write_pilot(spark.range(0, 80, 1, 8), str(tmp_path / "p"), 25) == 25
    d = spark.read.parquet(str(tmp_path / "p"))
    assert sorted(r[0] for r in d.collect()) == list(range(25)) and d.select(F.input_file_name()).distinct().count() == 3


def test_records_are_exchanged_once_for_the_entity_index(spark):
    records = P.entity_records(P.parsed(xml_files(spark, DATA, "sample", "study"), "s")).localCheckpoint()
    rows = lambda d: sorted(str(r) for r in d.collect())
    both = I.entity_index(P.stripped(records)), I.merged_entities(I.entity_parts(records))
    assert both[0]._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1  # the plan before it runs
    assert rows(both[0]) == rows(both[1])


def test_conflicts_are_found_before_columns_become_rows(spark):
    rows = [("s", "r1", "f1", "A", "x", "1"), ("s", "r2", "f2", "A", "y", None), ("s", "r3", "f1", "B", None, "2"), ("s", "r4", "f0", "A", "x", None)]
    found = I.core_conflicts(spark.createDataFrame(rows, "source_snapshot_id string, entity_record_id string, file_id string, k0 string, p string, q string"), "RUN", "k0")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.rindex("Generate ") < plan.rindex("Aggregate ")
    got = {r["field_name"]: (r["entity_count"], r["conflicted_entity_count"], r["example_entity_accession"], r["example_values"], r["example_file_ids"]) for r in found.collect()}
    assert got == {"p": (1, 1, "A", "x;y", "f0;f2"), "q": (2, 0, None, None, None)}


def test_only_nodes_of_the_names_are_taken_out(spark):
    files, names = xml_files(spark, DATA, "sample", "study"), ("TAXON_ID", "STUDY_TYPE", "@namespace")
    rows = lambda d: sorted(str(r) for r in d.collect())
    few, every = (P.xml_nodes(P.parsed(files, "s", with_nodes=w)) for w in (names, True))
    assert rows(P.selected_fields(few, list(names))) == rows(P.selected_fields(every, list(names)))
    assert {r[0].rpartition("/")[2] for r in few.select("path").collect()} == {"TAXON_ID", "@namespace"}


def test_files_of_a_build_are_made_once(spark, tmp_path):
    """Every job of a build reads its own files, however many jobs there are."""
    made = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    files = xml_files(spark, DATA, "sample", "study")
    files = files.mapInArrow(counted, files.schema)
    parsed = K.run(files.where("content is not null"), str(tmp_path), "s", chunk_size=5, at_once=1)
    jobs, rows = K.ledger(spark, str(tmp_path)).count(), parsed.count()
    assert jobs > 5 and rows == xml_files(spark, DATA, "sample", "study").count() and made.value < 5 * rows


def test_ingested_edges_are_kept_without_ids(spark, tmp_path):
    files = xml_files(spark, DATA, "sample", "study")
    Q.E.take(files, str(tmp_path), 0, "s", buckets=2)
    kept = spark.read.parquet(f"{tmp_path}/edges")
    assert {c for c in kept.columns if c.endswith("_id")} == {"source_snapshot_id", "file_id"}
    want = I.closed_relations(I.relations(r := P.entity_records(P.parsed(files, "s"))), I.entity_index(r))
    rows = lambda d: sorted(str(x) for x in d.select(*want.columns).collect())
    assert rows(Q.E.relation_index(spark, str(tmp_path))) == rows(want)
    assert all(".zstd" in f for _, _, found in os.walk(tmp_path) for f in found if f.endswith(".parquet"))


def test_inventory_exchanges_entities_once_for_all_their_paths(spark):
    """An entity in several files, by other paths there, counts once a path; files are parsed once."""
    body = lambda *inner: bytearray(f"<SAMPLE_SET>{''.join(inner)}</SAMPLE_SET>".encode())
    a, b, more = '<SAMPLE accession="A"><TITLE>t</TITLE></SAMPLE>', '<SAMPLE accession="B"/>', '<SAMPLE accession="A"><TITLE/><X y="1"/></SAMPLE>'
    rows = [(f"/x/{d}/{d}.sample.xml", c, len(c)) for d, c in (("D1", body(a, b)), ("D2", body(more)), ("D3", body(a, more)), ("D4", body()), ("D5", bytearray()))]
    files = spark.createDataFrame(rows, "path string, content binary, length long").withColumn("modificationTime", F.current_timestamp())
    files = files.unionByName(xml_files(spark, DATA, "sample", "experiment", "broken"))
    sets = P.path_sets(P.parsed(files, "s", with_paths=True)).localCheckpoint()
    text = lambda d: sorted(str(r) for r in d.collect())
    got = I.inventory_of_sets(sets, P.path_counts(sets))
    assert text(got) == text(I.merged_inventory(P.path_counts(sets)))
    covered = {r["path_abs"]: r["entity_coverage_count"] for r in got.where("root_tag = 'SAMPLE_SET'").collect()}
    assert covered["/SAMPLE_SET/SAMPLE/X"] == 1 and covered["/SAMPLE_SET/SAMPLE/TITLE"] == 1
    samples = sets.where("xml_kind = 'sample' and size(entities) > 100").selectExpr("file_id", "size(paths) as n").collect()
    assert all(r["n"] > 5 for r in samples) and len({r["file_id"] for r in samples}) == len(samples)


def test_inventory_parses_files_once(spark):
    from __spark_entry__ import queries

    plan = queries()["a26_path_inventory"](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" not in plan


def test_one_parse_gives_records_and_files(spark):
    parsed = P.parsed(xml_files(spark, DATA, "sample", "study", "broken"), "s").localCheckpoint()
    both = P.stripped(P.records_with_files(parsed)).localCheckpoint()
    rows = lambda d: sorted(str(r) for r in d.collect())
    assert rows(P.files_of(both)) == rows(P.file_index(parsed)) and P.files_of(both).columns == P.file_index(parsed).columns
    assert parsed.where("entity_count = 0").count() > 0
    records = P.restored(P.only_records(both))
    assert records.columns == P.entity_records(parsed).columns and rows(records) == rows(P.entity_records(parsed))


def test_validation_makes_tables_of_drawn_files_only(spark, monkeypatch):
    """A kind is parsed once for records and files, and edges are made of the drawn files' records."""
    from __spark_entry__ import queries

    monkeypatch.setattr(Q, "_STORES", {})
    parsed, edges, parse, relations = [], [], Q._parsed, I.relations
    monkeypatch.setattr(Q, "_parsed", lambda s, d, *kinds, **more: parsed.extend(kinds) or parse(s, d, *kinds, **more))
    monkeypatch.setattr(Q, "_file_index", lambda s, d, *kinds: parsed.extend(kinds) or P.file_index(parse(s, d, *kinds)))
    monkeypatch.setattr(Q.I, "relations", lambda r: edges.append(r.select("file_id").distinct().count()) or relations(r))
    assert queries()["a29_accuracy_metrics"](spark, DATA).count() == 4
    assert sorted(parsed) == sorted(Q.ALL) and edges == [40]


def test_entities_become_columns_without_dictionaries():
    """An entity is one tuple and its names come from its kind: a parse makes no dictionary for each of them."""
    root = P.ET.fromstring('<S><a:RUN xmlns:a="u" accession="R"><EXPERIMENT_REF accession=" X "/></a:RUN><ANALYSIS lab_name="l"><PRIMARY_ID>A</PRIMARY_ID></ANALYSIS></S>')
    found = P._entities(root)
    assert found == [("RUN", 1, "R", "@accession", "", "", "", ("X",), ()), ("ANALYSIS", 1, "A", "PRIMARY_ID", "", "A", "", ("", "l", ""), ())]
    names = [P._FIELDS.get(e[0], P._OTHER) for e in found]
    assert [len(n) for n in names] == [len(e[7]) for e in found]


def test_entities_of_a_large_file_become_columns_piece_by_piece(spark, monkeypatch):
    """Python's objects are of so many entities at most, however many a file has; rows and numbers are those of its tree."""
    monkeypatch.setattr(P, "HELD", 7)
    held, make = [], P._entity_struct
    monkeypatch.setattr(P, "_entity_struct", lambda found, of: held.append(len(found)) or make(found, of))
    kind = to_arrow_schema(spark.createDataFrame([], f"e {P.ENTITY}").schema).field("e").type
    for content in xml_files(spark, DATA, "sample", "study", "experiment").limit(6).toPandas()["content"]:
        tree = P._entities(P.ET.fromstring(bytes(content)))
        held.clear()
        root, pieces, count = P._in_columns(P.pa.py_buffer(content), None, kind.value_type)
        entities = P.pa.concat_arrays(pieces)
        assert max(held) <= 7 and sum(held) == count == len(tree) and root.tag == P.ET.fromstring(bytes(content)).tag
        assert P._entity_lists([entities], kind).to_pylist() == P._entity_lists([tree], kind).to_pylist()
        assert P._entity_lists([entities, tree[:2]], kind).to_pylist() == P._entity_lists([tree, tree[:2]], kind).to_pylist()
        assert P._in_columns(bytes(content), None, None)[1:] == ([], count)


def test_jobs_of_a_build_overlap(spark, tmp_path):
    """What the driver does for a job must not keep the tasks of all others waiting."""
    files = xml_files(spark, DATA, "sample", "run")
    got = K.run(files, str(tmp_path), "s", chunk_size=2, at_once=3)
    assert got.count() == files.count()
    rows = K.ledger(spark, str(tmp_path)).collect()
    times = sorted({(r["started_at"], r["finished_at"]) for r in rows})
    assert all(r["exit_code"] == 0 and r["attempts"] == 1 for r in rows) and len(times) > 2
    assert any(later[0] < former[1] for former, later in zip(times, times[1:]))
    assert not any(p.name.startswith("_") for p in tmp_path.iterdir())


def test_a_build_exchanges_edges_without_ids(spark, tmp_path):
    """The ids are made after the join, and equal those made before it."""
    records = P.entity_records(P.parsed(xml_files(spark, DATA, "sample", "study", "experiment", "run"), "s"))
    entities = I.entity_index(P.stripped(records))
    bare = I.closed_relations(I.bare_relations(records), entities)
    assert not {"relation_id", "src_entity_record_id", "directory_id"} & set(bare.columns)
    whole, plain = I.whole_relations(bare), I.closed_relations(I.relations(records), entities)
    rows = lambda d: sorted(str(r) for r in d.select(*sorted(plain.columns)).collect())
    assert sorted(whole.columns) == sorted(plain.columns) and rows(whole) == rows(plain)


def test_ingested_entities_are_exchanged_once(spark, tmp_path):
    """By bucket and part, without ids that follow from others; edges are kept so too, and are whole when they are read."""
    files = xml_files(spark, DATA, "sample", "study", "experiment")
    Q.E.take(files, str(tmp_path), 0, "s", buckets=2)
    merged = Q.E._merged(spark.read.parquet(f"{tmp_path}/entity_parts"), 2)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[-1].count("Exchange hashpartitioning") == 1
    want = I.entity_index(records := P.entity_records(P.parsed(files, "s")))
    rows = lambda d, of: sorted(str(x) for x in d.select(*of.columns).collect())
    assert rows(Q.E.entity_index(spark, str(tmp_path)), want) == rows(want, want)
    closed = I.closed_relations(I.relations(records), want)
    assert rows(Q.E.relation_index(spark, str(tmp_path)), closed) == rows(closed, closed)
    assert not {"relation_id", "src_entity_record_id"} & set(spark.read.parquet(f"{tmp_path}/closed_relations").columns)
