"""Index tables over entity records: entities, external ids, edges and their closure, inventory, quality counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import scalars as X
from tidemark.sources import lookup as Y

CORE_RELATIONS = ("RUN_TO_EXPERIMENT", "EXPERIMENT_TO_SAMPLE", "EXPERIMENT_TO_STUDY")
#: (source type, relation, field, target type, internal), in the order in which a record's edges are numbered.
RELATIONS = (
    ("RUN", "RUN_TO_EXPERIMENT", "experiment_accession", "EXPERIMENT", True),
    ("EXPERIMENT", "EXPERIMENT_TO_SAMPLE", "sample_accession", "SAMPLE", True),
    ("EXPERIMENT", "EXPERIMENT_TO_STUDY", "study_accession", "STUDY", True),
    ("SAMPLE", "SAMPLE_TO_BIOSAMPLE", "bio_sample_id", "BioSample", False),
    ("SAMPLE", "SAMPLE_XREF_bioproject", "bioproject_id", "BioProject", False),
    ("SAMPLE", "SAMPLE_TO_TAXON", "taxon_id", "Taxon", False),
    ("STUDY", "STUDY_TO_BIOPROJECT", "bioproject_id", "BioProject", False),
)
#: (entity type, namespace, field, id type or null for the field bioproject_by, source path)
EXTERNALS = (
    ("SAMPLE", "BioSample", "bio_sample_id", "EXTERNAL_ID", "SAMPLE/IDENTIFIERS/EXTERNAL_ID"),
    ("SAMPLE", "BioProject", "bioproject_id", "XREF_LINK", "SAMPLE/SAMPLE_LINKS/XREF_LINK"),
    ("SAMPLE", "Taxon", "taxon_id", "TAXON_ID", "SAMPLE/SAMPLE_NAME/TAXON_ID"),
    ("STUDY", "BioProject", "bioproject_id", None, "STUDY/IDENTIFIERS/EXTERNAL_ID"),
)
ENTITY = ("source_snapshot_id", "entity_accession", "entity_type")


def with_accession(records: DataFrame) -> DataFrame:
    return records.where(F.coalesce(F.col("entity_accession") != "", F.lit(False)))


def _order():
    first = F.when((F.col("occurrence_role") == "primary") & (F.col("parse_status") == "ok"), 0).otherwise(1)
    return (first, F.col("directory_accession"), F.col("file_id"), F.col("entity_ordinal"), F.col("entity_record_id"))


def canonical_records(records: DataFrame) -> DataFrame:
    """The first record of each entity: primary and parsed ones first, then by directory, file, place and id."""
    w = Window.partitionBy(*ENTITY).orderBy(*_order())
    return with_accession(records).withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")


def entity_parts(records: DataFrame) -> DataFrame:
    """Counts by entity and file, and the file's best record: parts of different files add up to the entity index."""
    d = with_accession(records)
    primary = (F.col("occurrence_role") == "primary") & (F.col("parse_status") == "ok")
    ids = [c for c in ("entity_record_id", "directory_id") if c in d.columns]
    order = _order() if "entity_record_id" in ids else _order()[:-1]  # a file's records of a type have different ordinals
    best = F.min(F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], *ids)).alias("best")
    return d.groupBy(*ENTITY, "file_id", "directory_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(primary).alias("n_primary"), best)


def entity_index(records: DataFrame) -> DataFrame:
    """One row for each entity; the canonical record is a minimum, so no record is sorted.

    Records are exchanged once, by entity, and then counted by entity and file, so that a file is one row; directories
    are the only distinct count, which needs no expanded rows. Records without ``entity_record_id`` are those of
    ``xml_files.stripped``: the id of the canonical one is made after the exchange.
    """
    d = with_accession(records)
    own = [*ENTITY, "file_id", "directory_id", "directory_accession", "entity_ordinal", "occurrence_role", "parse_status", "entity_record_id"]
    return merged_entities(entity_parts(d.select(*[c for c in own if c in d.columns]).repartition(*ENTITY)))


def merged_entities(parts: DataFrame, *others: str) -> DataFrame:
    """The entity index from ``entity_parts``, and ``others``, columns that follow from the entity, by which ``parts`` are exchanged already."""
    g = parts.groupBy(*ENTITY, *others).agg(F.sum("n").alias("record_count"), F.sum("n_primary").alias("primary_record_count"), F.count("file_id").alias("file_count"), F.count_distinct("directory_id").alias("directory_count"), F.min("best").alias("best"))
    has = F.col("primary_record_count") > 0
    record = F.col("best.entity_record_id") if "entity_record_id" in parts.schema["best"].dataType.names else X.stable_id("source_snapshot_id", F.col("best.o2"), F.col("entity_type"), F.col("best.o3"), F.col("entity_accession"))
    return g.select(
        *ENTITY,
        "record_count",
        "primary_record_count",
        (F.col("record_count") - F.col("primary_record_count")).alias("reference_record_count"),
        has.alias("has_primary_record"),
        (F.col("record_count") > F.col("primary_record_count")).alias("has_reference_record"),
        F.when(has, "primary_present").otherwise("reference_only").alias("entity_presence_status"),
        "file_count",
        "directory_count",
        F.when(has, record).alias("canonical_entity_record_id"),
        F.when(has, F.col("best.o2")).alias("canonical_file_id"),
        F.when(has, F.col("best.directory_id")).alias("canonical_directory_id"),
        F.when(has, "first_primary_by_manifest_order").otherwise("none_reference_only").alias("canonical_rule"),
        F.lit(False).alias("has_conflict"),
        F.lit(None).cast("string").alias("conflict_type"),
        F.lit(0).cast("long").alias("conflict_field_count"),
        *others,
    )


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def key_gate(df: DataFrame, *keys: str) -> DataFrame:
    """``df``, or an error if keys repeat; checked when it is called."""
    if duplicate_keys(df, *keys).limit(1).count():
        raise ValueError(f"duplicate keys: {', '.join(keys)}")
    return df


def external_ids(records: DataFrame) -> DataFrame:
    """BioSample, BioProject and Taxon ids of samples and studies that have an accession."""
    d = with_accession(records)
    rows = []
    for kind, space, field, by, path in EXTERNALS:
        v = F.nullif(F.element_at("fields", field), F.lit(""))
        rows.append(F.when((F.col("entity_type") == kind) & v.isNotNull(), F.struct(F.lit(space).alias("namespace"), v.alias("external_accession"), (F.lit(by) if by else F.element_at("fields", F.lit("bioproject_by"))).alias("external_id_type"), F.lit(path).alias("source_path"))))
    e = d.select("source_snapshot_id", "entity_record_id", "entity_accession", "entity_type", "directory_id", "directory_accession", "file_id", F.explode(F.array_compact(F.array(*rows))).alias("x"))
    return e.select("source_snapshot_id", X.stable_id("source_snapshot_id", "entity_record_id", "x.namespace", "x.external_accession", "x.source_path").alias("external_record_id"), "entity_record_id", "entity_accession", "entity_type", "x.namespace", "x.external_accession", "x.external_id_type", F.col("x.external_accession").alias("raw_value"), "x.source_path", "directory_id", "directory_accession", "file_id")


def relations(records: DataFrame) -> DataFrame:
    """Edges whose both ends are given, numbered inside their source record; not closed yet."""
    d = with_accession(records)
    rows = []
    for kind, name, field, target, internal in RELATIONS:
        v = F.nullif(F.element_at("fields", field), F.lit(""))
        rows.append(F.when((F.col("entity_type") == kind) & v.isNotNull(), F.struct(F.lit(name).alias("relation_type"), v.alias("dst_accession"), F.lit(target).alias("dst_type"), F.lit(internal).alias("internal"))))
    e = d.select("source_snapshot_id", F.col("entity_record_id").alias("src_entity_record_id"), F.col("entity_accession").alias("src_accession"), F.col("entity_type").alias("src_type"), "directory_id", "directory_accession", "file_id", F.posexplode(F.array_compact(F.array(*rows))).alias("at", "r"))
    ordinal = (F.col("at") + 1).cast("long")
    return e.select(
        "source_snapshot_id",
        X.stable_id("source_snapshot_id", "src_entity_record_id", "r.relation_type", "r.dst_accession", ordinal).alias("relation_id"),
        "src_entity_record_id",
        "src_accession",
        "src_type",
        "r.relation_type",
        "r.dst_accession",
        "r.dst_type",
        F.when(~F.col("r.internal"), F.col("r.dst_type")).alias("dst_namespace"),
        F.col("r.internal").alias("dst_is_internal_entity"),
        F.col("r.dst_accession").alias("dst_raw_value"),
        F.col("r.relation_type").alias("relation_source_path"),
        ordinal.alias("relation_ordinal"),
        "directory_id",
        "directory_accession",
        "file_id",
    )


#: Columns of edges that follow from others; ids are 40 digits each that don't compress, so edges are kept and exchanged without them.
_DERIVED = {
    "src_entity_record_id": lambda: X.stable_id("source_snapshot_id", "file_id", "src_type", "src_ordinal", "src_accession"),
    "directory_id": lambda: X.stable_id("source_snapshot_id", "directory_accession"),
    "dst_raw_value": lambda: F.col("dst_accession"),
    "relation_source_path": lambda: F.col("relation_type"),
    "relation_id": lambda: X.stable_id("source_snapshot_id", "src_entity_record_id", "relation_type", "dst_accession", "relation_ordinal"),
}


def bare_relations(records: DataFrame) -> DataFrame:
    """``relations`` without the columns of ``_DERIVED``, with their source's place in its file; ``whole_relations`` makes them again."""
    placed = records.withColumn("entity_record_id", F.col("entity_ordinal"))
    return relations(placed).withColumnRenamed("src_entity_record_id", "src_ordinal").drop(*_DERIVED)


def whole_relations(edges: DataFrame) -> DataFrame:
    for name, made in _DERIVED.items():
        edges = edges.withColumn(name, made())
    return edges.drop("src_ordinal")


def closed_relations(edges: DataFrame, entities: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Edges with their target looked up among entities that have a primary record; external edges pass through.

    ``hot``: the frequent targets (as source_snapshot_id, dst_type, dst_accession) by which ``edges`` have a salt.
    """
    target = entities.where("has_primary_record").select("source_snapshot_id", F.col("entity_type").alias("dst_type"), F.col("entity_accession").alias("dst_accession"), F.col("canonical_entity_record_id").alias("dst_entity_record_id"))
    keys = ["source_snapshot_id", "dst_type", "dst_accession"]
    j = edges.join(target, keys, "left") if hot is None else edges.join(Y.copied(target, hot, *keys), [*keys, "salt"], "left").drop("salt")
    edges = edges.drop("salt") if hot is not None else edges
    hit, internal = F.col("dst_entity_record_id").isNotNull(), F.col("dst_is_internal_entity")
    return j.select(
        *edges.columns,
        F.when(internal, F.col("dst_entity_record_id")).alias("dst_entity_record_id"),
        (internal & hit).alias("dst_primary_exists"),
        F.when(~internal, "external_reference").when(hit, "primary_present").otherwise("missing").alias("dst_entity_index_status"),
        F.when(~internal, "external_reference").when(hit, "closed").otherwise("missing_dst_entity").alias("closure_status"),
    )


def closure_qc(closed: DataFrame) -> DataFrame:
    """Per relation: internal and closed edges, rate, and hard_fail where a core relation closes nowhere."""
    internal = F.count_if("dst_is_internal_entity").alias("internal_relation_count")
    done = F.count_if(F.col("dst_is_internal_entity") & (F.col("closure_status") == "closed")).alias("closed_count")
    g = closed.groupBy("source_snapshot_id", "relation_type", "src_type", "dst_type").agg(internal, done)
    bad = F.col("relation_type").isin(*CORE_RELATIONS) & (F.col("internal_relation_count") > 0) & (F.col("closed_count") == 0)
    return g.withColumns({"closure_rate": X.safe_ratio("closed_count", "internal_relation_count"), "severity": F.when(bad, "hard_fail").otherwise("report_only")})


def hard_fails(qc: DataFrame) -> DataFrame:
    return qc.agg(F.count_if(F.col("severity") == "hard_fail").alias("hard_fail_count"))


def closure_gate(qc: DataFrame) -> DataFrame:
    if qc.where("severity = 'hard_fail'").limit(1).count():
        raise ValueError("a core relation closes nowhere")
    return qc


_PATH = ("source_snapshot_id", "xml_kind", "root_tag", "entity_type", "path", "path_entity_relative", "is_attribute")


def path_parts(nodes: DataFrame) -> DataFrame:
    """Per path and file: nodes, non-empty ones, the longest value, a first example and the entities that have the path.

    A file's nodes lie together, so this is done before anything is exchanged; the set holds entities of one file only.
    """
    filled = F.col("value") != ""
    example = F.min(F.when(filled, F.struct("file_id", "accession", F.substring("value", 1, X.EXAMPLE_LIMIT).alias("value"), (F.length("value") > X.EXAMPLE_LIMIT).alias("cut")))).alias("example")
    return nodes.groupBy(*_PATH, "file_id").agg(F.count(F.lit(1)).alias("nodes"), F.count_if(filled).alias("filled"), F.max(F.length("value")).cast("long").alias("longest"), example, F.collect_set("accession").alias("entities"))


def merged_inventory(parts: DataFrame) -> DataFrame:
    """The inventory from ``path_parts``, of one lot of files or of several: a file is one row of a path.

    Files are rows, so they are counted, not compared; entities are made distinct by path first, then counted. No row
    is copied for a second distinct count.
    """
    entity = parts.select(*_PATH, F.explode("entities").alias("accession")).groupBy(*_PATH, "accession").agg(F.lit(1).alias("one"))
    return _inventory(parts, entity.groupBy(*_PATH).agg(F.count(F.lit(1)).alias("entities")))


def inventory_of_sets(sets: DataFrame, parts: DataFrame) -> DataFrame:
    """``merged_inventory`` of ``xml_files.path_sets`` and their ``path_counts``; ``sets`` are read several times, so they should be kept.

    An entity is exchanged once for each set of a file that it is in, with the id of the set's paths, and not once a
    path. Entities with the same ids are then counted together, and only these counts meet the paths.
    """
    key = _PATH[:3]
    paths = F.transform("paths", lambda p: F.struct(p["entity_type"].alias("entity_type"), p["path"].alias("path"), p["is_attribute"].alias("is_attribute")))
    of = sets.where(F.size("entities") > 0).select(*key, F.array_sort(paths).alias("paths"), "entities").withColumn("id", F.md5(F.to_json(F.struct(*key, "paths"))))
    of_id = of.select("id", *key, "paths").groupBy("id").agg(*[F.first(c).alias(c) for c in (*key, "paths")])
    each = of.select("id", F.explode("entities").alias("accession")).repartition("accession").groupBy("accession").agg(F.array_sort(F.collect_set("id")).alias("ids"))
    alike = each.groupBy("ids").agg(F.count(F.lit(1)).alias("n"))
    found = alike.select("ids", "n", F.explode("ids").alias("id")).join(of_id, "id").select("ids", "n", *key, F.explode("paths").alias("p")).select("ids", "n", *key, "p.*").distinct()
    covered = found.withColumn("path_entity_relative", X.relative_path("path", "entity_type")).groupBy(*_PATH).agg(F.sum("n").alias("entities"))
    return _inventory(parts, covered)


def _inventory(parts: DataFrame, covered: DataFrame) -> DataFrame:
    """The inventory from ``path_parts`` and the number of ``entities`` by path."""
    own = parts.groupBy(*_PATH).agg(F.sum("nodes").alias("node_occurrence_count"), F.sum("filled").alias("non_empty_occurrence_count"), F.count(F.lit(1)).alias("file_coverage_count"), F.max("longest").alias("max_value_length"), F.min("example").alias("x"))
    covered = covered.select(*[F.col(c).alias(f"k_{c}") for c in _PATH], "entities")
    g = own.join(covered, [F.col(c).eqNullSafe(F.col(f"k_{c}")) for c in _PATH], "left")  # a row for each path
    return g.select(*_PATH[:4], F.col("path").alias("path_abs"), *_PATH[5:], "node_occurrence_count", "non_empty_occurrence_count", F.coalesce("entities", F.lit(0)).alias("entity_coverage_count"), "file_coverage_count", "max_value_length", F.col("x.value").alias("example_value"), F.coalesce("x.cut", F.lit(False)).alias("example_value_truncated"), F.col("x.file_id").alias("example_file_id"), F.col("x.accession").alias("example_entity_accession"))


def path_inventory(nodes: DataFrame) -> DataFrame:
    """Per path: nodes, non-empty ones, distinct entities and files, the longest value and a first example."""
    return merged_inventory(path_parts(nodes))


def parse_qc(files: DataFrame) -> DataFrame:
    g = files.groupBy("source_snapshot_id", "xml_kind").agg(F.count(F.lit(1)).alias("file_count"), F.count_if(F.col("parse_status") == "ok").alias("parse_success_count"))
    failed = F.col("file_count") - F.col("parse_success_count")
    return g.withColumns({"parse_failed_count": failed, "severity": F.when(failed > 0, "warning").otherwise("report_only")})


def entity_qc(records: DataFrame) -> DataFrame:
    missing = F.count_if(~X.non_missing("entity_accession"))
    return records.groupBy("source_snapshot_id", "entity_type").agg(F.count(F.lit(1)).alias("entity_record_count"), F.count_distinct("entity_accession").alias("unique_entity_accession_count"), missing.alias("missing_accession_count"), F.when(missing > 0, "warning").otherwise("report_only").alias("severity"))


def core_missingness(table: DataFrame, name: str) -> DataFrame:
    """Missing (null or '') values of each column of a core table, id columns left out; no rows for an empty table."""
    columns = [c for c in table.columns if c not in ("source_snapshot_id", "entity_record_id", "file_id")]
    one = table.groupBy("source_snapshot_id").agg(F.count(F.lit(1)).alias("total_count"), *[F.count_if(F.coalesce(F.col(c), F.lit("")) == "").alias(f"m_{c}") for c in columns])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("field_name"), F.col(f"m_{c}").alias("missing_count")) for c in columns])).alias("r")
    return one.select("source_snapshot_id", F.lit(name).alias("table_name"), "total_count", rows).select("source_snapshot_id", "table_name", "r.field_name", "r.missing_count", "total_count", X.safe_ratio("r.missing_count", "total_count").alias("missing_rate"), F.lit("report_only").alias("severity"))


def core_conflicts(table: DataFrame, entity_type: str, key: str) -> DataFrame:
    """Per column of a core table: entities with more than one distinct value, and one example with its least and greatest value."""
    columns = [c for c in table.columns if c not in ("source_snapshot_id", "entity_record_id", "file_id", key)]
    # The least and the greatest value of each column by entity: one row an entity is exchanged, not one a column, and no file ids.
    ends = table.groupBy("source_snapshot_id", F.col(key).alias("k")).agg(*[f(c).alias(f"{f.__name__}_{c}") for c in columns for f in (F.min, F.max)])
    of = []
    for c in columns:
        differ = F.col(f"min_{c}") != F.col(f"max_{c}")
        of += [F.count(f"min_{c}").alias(f"n_{c}"), F.count_if(differ).alias(f"bad_{c}"), F.min(F.when(differ, F.col("k"))).alias(f"k_{c}")]
    one = ends.groupBy("source_snapshot_id").agg(*of)
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("field_name"), F.col(f"n_{c}").alias("n"), F.col(f"bad_{c}").alias("bad"), F.col(f"k_{c}").alias("k")) for c in columns])).alias("r")
    g = one.select("source_snapshot_id", rows).select("source_snapshot_id", "r.*").where("n > 0")
    # The examples' values and files: rows of one entity a column, found by a second look at the table.
    chosen = F.broadcast(g.select("source_snapshot_id", "field_name", "k").where("k is not null"))
    value = F.coalesce(*[F.when(F.col("field_name") == c, F.col(c)) for c in columns])
    examples = table.withColumnRenamed(key, "k").join(chosen, ["source_snapshot_id", "k"]).select("source_snapshot_id", "field_name", "file_id", value.alias("v")).where("v is not null")
    x = examples.groupBy("source_snapshot_id", "field_name").agg(F.min(F.struct("v", "file_id")).alias("a"), F.max(F.struct("v", "file_id")).alias("b"))
    both = lambda c: F.when(F.col("k").isNotNull(), F.concat_ws(";", f"a.{c}", f"b.{c}")).alias(f"example_{'values' if c == 'v' else 'file_ids'}")
    return g.join(x, ["source_snapshot_id", "field_name"], "left").select("source_snapshot_id", F.lit(entity_type).alias("entity_type"), "field_name", F.col("n").alias("entity_count"), F.col("bad").alias("conflicted_entity_count"), X.safe_ratio("bad", "n").alias("conflict_rate"), F.col("k").alias("example_entity_accession"), both("v"), both("file_id"), F.lit("report_only").alias("severity"))


def directory_index(files: DataFrame, manifest: DataFrame | None = None) -> DataFrame:
    """Per directory: files by kind, parsed and failed; with a manifest, directories without files too."""
    keys = ["source_snapshot_id", "directory_id", "directory_accession"]
    ok = F.count_if(F.col("parse_status") == "ok").alias("parse_success_file_count")
    kinds = [F.count_if(F.col("xml_kind") == k).alias(f"{k}_xml_count") for k in X.KINDS]
    other = F.count_if(~F.col("xml_kind").isin(*X.KINDS)).alias("other_xml_count")
    counts = [F.count(F.lit(1)).alias("file_count"), *kinds, other, ok, F.count_if(F.col("parse_status") != "ok").alias("parse_failed_file_count")]
    place = [F.substring("directory_accession", 1, 3).alias("directory_prefix"), F.col("directory_accession").alias("relative_directory_path"), "absolute_directory_path"]
    if manifest is None:
        g = files.groupBy(*keys).agg(*counts, F.regexp_replace(F.min("absolute_file_path"), "/[^/]*$", "").alias("absolute_directory_path")).select("*", *place[:2])
    else:
        g = manifest.select(*keys, *place).join(files.groupBy(*keys[:2]).agg(*counts), keys[:2], "left").na.fill(0)
    return g.withColumn("scan_status", F.when(F.col("parse_failed_file_count") == 0, "ok").otherwise("partial"))


def directory_file_consistency(directories: DataFrame) -> DataFrame:
    return directories.select("source_snapshot_id", "directory_id", "directory_accession", F.col("file_count").alias("observed_xml_count"), F.lit("report_only").alias("xml_kind_consistency_status"), F.lit("report_only").alias("severity"))


def chunk_status(chunks: DataFrame, manifest: DataFrame, size: int, files: DataFrame, by_directory: dict[str, DataFrame], by_file: dict[str, DataFrame]) -> DataFrame:
    """Per chunk of the plan: the tables' rows as JSON, warnings and failed files. Chunks have ``size`` rows; tables go by directory_id or file_id.

    Rows are counted by directory or file before anything is joined; a chunk then gathers a row for each table.
    """
    number = lambda c: F.floor(F.col(c) / size).alias("number")
    of_chunk = manifest.select("directory_id", number("manifest_row_id")).join(chunks.select("chunk_id", number("start_row")), "number").select("directory_id", "chunk_id")
    of_file = files.select("file_id", "directory_id")
    n = None
    for name, t in [*by_directory.items(), *((k, v.groupBy("file_id").agg(F.count(F.lit(1)).alias("n")).join(of_file, "file_id")) for k, v in by_file.items())]:
        own = t.groupBy("directory_id").agg((F.sum("n") if "n" in t.columns else F.count(F.lit(1))).alias("n")).select("directory_id", F.lit(name).alias("table"), "n")
        n = own if n is None else n.union(own)
    per = n.join(of_chunk, "directory_id").groupBy("chunk_id", "table").agg(F.sum("n").alias("n")).groupBy("chunk_id").agg(F.array_sort(F.collect_list(F.struct("table", "n"))).alias("t"))
    ends = files.join(of_chunk, "directory_id").groupBy("chunk_id").agg(F.sum("parser_warning_count").alias("warning_count"), F.count_if(F.col("parse_status") != "ok").alias("error_count"))
    tables = F.coalesce("t", F.array().cast("array<struct<table: string, n: bigint>>"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return chunks.join(per, "chunk_id", "left").join(ends, "chunk_id", "left").select("chunk_id", "start_row", "row_count", F.to_json(F.transform(tables, lambda x: x["table"])).alias("output_tables"), F.to_json(F.map_from_entries(tables)).alias("row_counts_by_table"), zero("warning_count"), zero("error_count"))


# --- reading ---------------------------------------------------------------------------------------------------


def lookup(table: DataFrame, column: str, value: str) -> DataFrame:
    """Rows whose column equals a value; the condition reaches the scan."""
    return table.where(F.col(column) == F.lit(value))


def attribute_search(attributes: DataFrame, tag: str, value: str, limit: int = 100) -> DataFrame:
    hit = F.contains(F.lower("tag"), F.lit(tag)) | F.contains(F.lower("value"), F.lit(value))
    return attributes.where(F.coalesce(hit, F.lit(False))).select("sample_accession", "bio_sample_id", "tag", "value").orderBy("sample_accession", "tag", "value").limit(limit)


def platform_filter(experiments: DataFrame, platform: str, strategy: str, limit: int = 100) -> DataFrame:
    d = experiments.where((F.col("platform") == platform) & (F.col("library_strategy") == strategy))
    return d.select("experiment_accession", "study_accession", "sample_accession", "library_strategy", "library_source", "library_selection", "platform", "instrument_model").orderBy("experiment_accession").limit(limit)


def inventory_browse(inventory: DataFrame, entity_type: str, limit: int = 100) -> DataFrame:
    return inventory.where(F.col("entity_type") == entity_type).select("xml_kind", "entity_type", "path_abs", "is_attribute", "node_occurrence_count", "non_empty_occurrence_count").orderBy(F.desc("node_occurrence_count"), "path_abs").limit(limit)


def field_search(fields: DataFrame, name: str, part: str, limit: int = 100) -> DataFrame:
    return fields.where((F.col("field_name") == name) & F.contains(F.lower("value"), F.lit(part))).orderBy("entity_accession", "field_path", "value").limit(limit)


def abnormal_files(files: DataFrame) -> DataFrame:
    return files.where((F.col("parse_status") != "ok") | (F.col("xml_kind_consistency_status") != "consistent") | (F.col("parser_warning_count") > 0))


def chain(runs: DataFrame, experiments: DataFrame, samples: DataFrame, studies: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Runs with their experiment, sample and study, whether found or not.

    Experiments meet samples and studies first, so the runs, by far the most rows, are joined once; where both are in
    buckets of the experiment's accession, they aren't exchanged at all. ``hot``: the experiments of very many runs, by
    which ``runs`` have a salt.
    """
    e = experiments.select("experiment_accession", "sample_accession", "study_accession", "platform", "library_strategy")
    s = samples.select("sample_accession", "bio_sample_id", "taxon_id", "scientific_name")
    st = studies.select("study_accession", "bioproject_id", "study_title")
    whole = e.join(s, "sample_accession", "left").join(st, "study_accession", "left")
    if hot is None:
        return runs.select("run_accession", "experiment_accession").join(whole, "experiment_accession", "left")
    return runs.select("run_accession", "experiment_accession", "salt").join(Y.copied(whole, hot, "experiment_accession"), ["experiment_accession", "salt"], "left").drop("salt")


def back_to_source(table: DataFrame, files: DataFrame) -> DataFrame:
    return table.join(files.select("file_id", "relative_file_path", "xml_kind", "parse_status"), "file_id", "left")
