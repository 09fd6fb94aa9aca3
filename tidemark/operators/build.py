"""One build: from XML files, by chunks that can be resumed, to all tables of the contract, with the checks that gate it."""

from __future__ import annotations

import hashlib
from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import contract as C
from tidemark.operators import chunks as K
from tidemark.operators import index as I
from tidemark.operators import sampling as S
from tidemark.operators import validate as V
from tidemark.sources import tables as R
from tidemark.sources import xml_files as P
from tidemark.sources.commit import staging

VERSION = "1"


def build(files: DataFrame, out: str, work: str, snapshot: str, subset: str = "full", chunk_size: int = 5_000, label: str = "build", at_once: int = 8) -> DataFrame:
    """Writes the contract's tables below ``out`` and returns (table, rows), tables in the contract's order.

    ``files`` has path, modificationTime, length, and content or none (a listing: tasks read the files). They are parsed
    once, by chunks, to a table below ``work`` (``chunks.run``: a call after a failure goes on where the last one ended);
    all others come from that one and from each other. The tables are written beside ``out``, checked, and put in its
    place together. Raises where an entity has two rows, a core relation closes nowhere, or a written table breaks the
    contract; ``out`` is then as it was.
    """
    with staging(files.sparkSession, out) as staged:
        return _tables(files, staged, out, work, snapshot, subset, chunk_size, label, at_once)


def _tables(files: DataFrame, out: str, final: str, work: str, snapshot: str, subset: str, chunk_size: int, label: str, at_once: int) -> DataFrame:
    spark, began = files.sparkSession, datetime.now(UTC).replace(tzinfo=None)
    rows: dict[str, int] = {}

    def put(name: str, df: DataFrame) -> DataFrame:
        rows[name] = R.write_contract(df, f"{out}/{C.path(name)}", name)
        return R.open_table(spark, out, name)

    parsed = K.run(files, work, snapshot, chunk_size, at_once)
    P.stripped(P.entity_records(parsed)).write.mode("overwrite").option("compression", "zstd").parquet(f"{work}/records")
    kept = spark.read.parquet(f"{work}/records")
    records = P.restored(kept)

    found = put("file_index", P.file_index(parsed))
    top = F.regexp_replace("absolute_file_path", r"/[^/]*/[^/]*$", "")
    root = found.agg(F.coalesce(F.min(top), F.lit("")).alias("root")).first()["root"]
    manifest = put("directory_manifest", S.directory_manifest(spark.read.parquet(f"{work}/plan"), snapshot, root))
    chunks = put("chunk_manifest", S.chunk_manifest(manifest, chunk_size))
    directories = put("directory_index", I.directory_index(found, manifest))
    put("entity_record_index", records)
    entities = I.key_gate(put("entity_index", I.entity_index(kept)), *C.KEYS["entity_index"])  # of the written table: the index is made once
    externals = put("external_accession_index", I.external_ids(records))
    relations = put("relation_index", I.whole_relations(I.closed_relations(I.bare_relations(records), entities)))
    for kind in ("run", "experiment", "sample", "study"):
        raw = put(f"{kind}_core_raw", P.core(records, kind.upper()))
        put(f"{kind}_core", raw)
    attributes = put("sample_attribute_core", P.sample_attributes(records))
    put("xml_path_inventory", I.inventory_of_sets(P.path_sets(parsed), P.path_counts(parsed).drop("entities")))
    put("parse_qc_summary", I.parse_qc(found))
    put("entity_qc_summary", I.entity_qc(records))
    put("relation_closure_qc", I.closure_gate(I.closure_qc(relations)))
    cores = {f"{k}_core": (k.upper(), R.open_table(spark, out, f"{k}_core")) for k in ("run", "experiment", "sample", "study")}
    missing, conflicts = None, None
    for name, (kind, table) in cores.items():
        m, c = I.core_missingness(table, name), I.core_conflicts(table, kind, f"{kind.lower()}_accession")
        missing, conflicts = (m, c) if missing is None else (missing.unionByName(m), conflicts.unionByName(c))
    put("core_missingness_qc", missing)
    put("core_conflict_qc", conflicts)
    put("directory_file_consistency_qc", I.directory_file_consistency(directories))

    ended = datetime.now(UTC).replace(tzinfo=None)
    schema_hash = hashlib.sha256("\n".join(f"{t} {d}" for t, d in C.TABLES.items()).encode()).hexdigest()
    config_hash = hashlib.sha256(f"{snapshot}|{subset}|{chunk_size}|{VERSION}".encode()).hexdigest()
    manifest_hash, chunk_hash = K.digest(manifest, "manifest_row_id", "directory_accession"), K.digest(chunks, "chunk_id", "row_count")
    by_directory = {"file_index": found, "entity_record_index": records, "external_accession_index": externals, "relation_index": relations}
    by_file = {"sample_attribute_core": attributes, **{n: t for n, (_, t) in cores.items()}}
    put("chunk_status_summary", I.chunk_status(chunks, manifest, chunk_size, found, by_directory, by_file).join(K.ledger(spark, work), "chunk_id").withColumns({"input_manifest_hash": F.lit(manifest_hash), "parser_version": F.lit(VERSION), "schema_version": F.lit("v1")}))
    put("build_manifest", spark.range(1).select(
        F.lit(snapshot).alias("source_snapshot_id"), F.lit(subset).alias("build_scope"), F.lit(label).alias("build_label"), F.lit(subset).alias("manifest_subset_type"), F.lit(rows["directory_manifest"]).alias("manifest_row_count"),
        F.lit(root).alias("source_root"), F.lit(final).alias("output_root"), F.lit("v1").alias("schema_version"), F.lit(VERSION).alias("parser_version"), F.lit("").alias("parser_git_commit"), F.lit("succeeded").alias("build_status"),
        F.lit(began).alias("started_at"), F.lit(ended).alias("finished_at"), F.lit(spark.sparkContext.defaultParallelism).alias("thread_count"), F.lit(False).alias("enable_selected_field_long"),
        F.lit(manifest_hash).alias("manifest_hash"), F.lit(chunk_hash).alias("chunk_manifest_hash"), F.lit(schema_hash).alias("schema_contract_hash"), F.lit(config_hash).alias("parser_config_hash"),
    ))
    tables = {t: R.open_table(spark, out, t) for t in C.TABLES}
    bad = V.schema_errors(spark, tables, list(C.TABLES)).limit(20).collect() + V.all_enum_errors(tables).limit(20).collect()
    if bad:
        raise ValueError(f"the build breaks the contract: {bad}")
    return spark.createDataFrame([(t, rows[t]) for t in C.TABLES], "table string, rows long")
