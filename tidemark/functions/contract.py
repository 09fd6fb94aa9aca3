"""The index tables' contract: column names, types, required columns and enumerations (fixed values)."""

from __future__ import annotations

from pyspark.sql import types as T

#: Columns of the flat accession table, all strings.
ACCESSION_COLUMNS = (
    "Accession", "Submission", "Status", "Updated", "Published", "Received", "Type", "Center", "Visibility", "Alias",
    "Experiment", "Sample", "Study", "Loaded", "Spots", "Bases", "Md5sum", "BioSample", "BioProject", "ReplacedBy",
)
ACCESSION_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ACCESSION_COLUMNS])

_RUN = "source_snapshot_id STRING NOT NULL, entity_record_id STRING NOT NULL, file_id STRING NOT NULL, run_accession STRING NOT NULL, alias STRING, experiment_accession STRING"
_EXPERIMENT = "source_snapshot_id STRING NOT NULL, entity_record_id STRING NOT NULL, file_id STRING NOT NULL, experiment_accession STRING NOT NULL, sample_accession STRING, study_accession STRING, library_strategy STRING, library_source STRING, library_selection STRING, platform STRING, instrument_model STRING"
_SAMPLE = "source_snapshot_id STRING NOT NULL, entity_record_id STRING NOT NULL, file_id STRING NOT NULL, sample_accession STRING NOT NULL, bio_sample_id STRING, taxon_id STRING, scientific_name STRING"
_STUDY = "source_snapshot_id STRING NOT NULL, entity_record_id STRING NOT NULL, file_id STRING NOT NULL, study_accession STRING NOT NULL, bioproject_id STRING, study_type STRING, study_title STRING"

#: The columns of each table in order, as Spark's DDL.
TABLES = {
    "build_manifest": "source_snapshot_id STRING NOT NULL, build_scope STRING NOT NULL, build_label STRING NOT NULL, manifest_subset_type STRING NOT NULL, manifest_row_count BIGINT NOT NULL, source_root STRING NOT NULL, output_root STRING NOT NULL, schema_version STRING NOT NULL, parser_version STRING NOT NULL, parser_git_commit STRING NOT NULL, build_status STRING NOT NULL, started_at TIMESTAMP_NTZ NOT NULL, finished_at TIMESTAMP_NTZ, thread_count BIGINT NOT NULL, enable_selected_field_long BOOLEAN NOT NULL, manifest_hash STRING NOT NULL, chunk_manifest_hash STRING NOT NULL, schema_contract_hash STRING NOT NULL, parser_config_hash STRING NOT NULL",
    "directory_manifest": "source_snapshot_id STRING NOT NULL, manifest_row_id BIGINT NOT NULL, directory_id STRING NOT NULL, directory_accession STRING NOT NULL, directory_prefix STRING NOT NULL, relative_directory_path STRING NOT NULL, absolute_directory_path STRING NOT NULL",
    "chunk_manifest": "chunk_id STRING NOT NULL, start_row BIGINT NOT NULL, row_count BIGINT NOT NULL, manifest_row_id_start BIGINT NOT NULL, manifest_row_id_end BIGINT NOT NULL, expected_directory_count BIGINT NOT NULL",
    "chunk_status_summary": "chunk_id STRING NOT NULL, start_row BIGINT NOT NULL, row_count BIGINT NOT NULL, started_at TIMESTAMP_NTZ NOT NULL, finished_at TIMESTAMP_NTZ, exit_code BIGINT NOT NULL, parser_version STRING NOT NULL, schema_version STRING NOT NULL, input_manifest_hash STRING NOT NULL, output_tables STRING NOT NULL, row_counts_by_table STRING NOT NULL, warning_count BIGINT NOT NULL, error_count BIGINT NOT NULL",
    "directory_index": "source_snapshot_id STRING NOT NULL, directory_id STRING NOT NULL, directory_accession STRING NOT NULL, directory_prefix STRING NOT NULL, relative_directory_path STRING NOT NULL, absolute_directory_path STRING NOT NULL, file_count BIGINT NOT NULL, run_xml_count BIGINT NOT NULL, experiment_xml_count BIGINT NOT NULL, sample_xml_count BIGINT NOT NULL, study_xml_count BIGINT NOT NULL, submission_xml_count BIGINT NOT NULL, analysis_xml_count BIGINT NOT NULL, other_xml_count BIGINT NOT NULL, parse_success_file_count BIGINT NOT NULL, parse_failed_file_count BIGINT NOT NULL, scan_status STRING NOT NULL",
    "file_index": "source_snapshot_id STRING NOT NULL, file_id STRING NOT NULL, directory_id STRING NOT NULL, directory_accession STRING NOT NULL, xml_kind STRING NOT NULL, xml_kind_from_filename STRING NOT NULL, xml_kind_from_root_tag STRING NOT NULL, xml_kind_consistency_status STRING NOT NULL, file_name STRING NOT NULL, relative_file_path STRING NOT NULL, absolute_file_path STRING NOT NULL, file_size BIGINT NOT NULL, mtime TIMESTAMP_NTZ NOT NULL, parse_status STRING NOT NULL, root_tag STRING NOT NULL, root_entity_set_type STRING NOT NULL, entity_count BIGINT NOT NULL, error_type STRING NOT NULL, error_message STRING, parser_warning_count BIGINT NOT NULL",
    "entity_record_index": "source_snapshot_id STRING NOT NULL, entity_record_id STRING NOT NULL, entity_accession STRING, entity_type STRING NOT NULL, occurrence_role STRING NOT NULL, directory_id STRING NOT NULL, directory_accession STRING NOT NULL, file_id STRING NOT NULL, xml_kind STRING NOT NULL, root_tag STRING NOT NULL, entity_path STRING NOT NULL, entity_ordinal BIGINT NOT NULL, accession_source_path STRING, alias STRING, primary_id STRING, submitter_id STRING, parse_status STRING NOT NULL",
    "entity_index": "source_snapshot_id STRING NOT NULL, entity_accession STRING NOT NULL, entity_type STRING NOT NULL, record_count BIGINT NOT NULL, primary_record_count BIGINT NOT NULL, reference_record_count BIGINT NOT NULL, has_primary_record BOOLEAN NOT NULL, has_reference_record BOOLEAN NOT NULL, entity_presence_status STRING NOT NULL, file_count BIGINT NOT NULL, directory_count BIGINT NOT NULL, canonical_entity_record_id STRING, canonical_file_id STRING, canonical_directory_id STRING, canonical_rule STRING NOT NULL, has_conflict BOOLEAN NOT NULL, conflict_type STRING, conflict_field_count BIGINT NOT NULL",
    "external_accession_index": "source_snapshot_id STRING NOT NULL, external_record_id STRING NOT NULL, entity_record_id STRING NOT NULL, entity_accession STRING, entity_type STRING NOT NULL, namespace STRING NOT NULL, external_accession STRING NOT NULL, external_id_type STRING NOT NULL, raw_value STRING NOT NULL, source_path STRING NOT NULL, directory_id STRING NOT NULL, directory_accession STRING NOT NULL, file_id STRING NOT NULL",
    "relation_index": "source_snapshot_id STRING NOT NULL, relation_id STRING NOT NULL, src_entity_record_id STRING NOT NULL, src_accession STRING, src_type STRING NOT NULL, relation_type STRING NOT NULL, dst_accession STRING NOT NULL, dst_type STRING NOT NULL, dst_namespace STRING, dst_is_internal_entity BOOLEAN NOT NULL, dst_entity_record_id STRING, dst_primary_exists BOOLEAN NOT NULL, dst_entity_index_status STRING NOT NULL, dst_raw_value STRING NOT NULL, relation_source_path STRING NOT NULL, relation_ordinal BIGINT NOT NULL, directory_id STRING NOT NULL, directory_accession STRING NOT NULL, file_id STRING NOT NULL, closure_status STRING NOT NULL",
    "run_core_raw": _RUN,
    "experiment_core_raw": _EXPERIMENT,
    "sample_core_raw": _SAMPLE,
    "study_core_raw": _STUDY,
    "run_core": _RUN,
    "experiment_core": _EXPERIMENT,
    "sample_core": _SAMPLE,
    "study_core": _STUDY,
    "sample_attribute_core": "source_snapshot_id STRING NOT NULL, entity_record_id STRING NOT NULL, file_id STRING NOT NULL, sample_accession STRING, bio_sample_id STRING, tag STRING NOT NULL, value STRING, attribute_ordinal BIGINT NOT NULL, value_truncated BOOLEAN NOT NULL",
    "xml_path_inventory": "source_snapshot_id STRING NOT NULL, xml_kind STRING NOT NULL, root_tag STRING NOT NULL, entity_type STRING, path_abs STRING NOT NULL, path_entity_relative STRING, is_attribute BOOLEAN NOT NULL, node_occurrence_count BIGINT NOT NULL, non_empty_occurrence_count BIGINT NOT NULL, entity_coverage_count BIGINT NOT NULL, file_coverage_count BIGINT NOT NULL, max_value_length BIGINT NOT NULL, example_value STRING, example_value_truncated BOOLEAN NOT NULL, example_file_id STRING, example_entity_accession STRING",
    "parse_qc_summary": "source_snapshot_id STRING NOT NULL, xml_kind STRING NOT NULL, file_count BIGINT NOT NULL, parse_success_count BIGINT NOT NULL, parse_failed_count BIGINT NOT NULL, severity STRING NOT NULL",
    "entity_qc_summary": "source_snapshot_id STRING NOT NULL, entity_type STRING NOT NULL, entity_record_count BIGINT NOT NULL, unique_entity_accession_count BIGINT NOT NULL, missing_accession_count BIGINT NOT NULL, severity STRING NOT NULL",
    "relation_closure_qc": "source_snapshot_id STRING NOT NULL, relation_type STRING NOT NULL, src_type STRING NOT NULL, dst_type STRING NOT NULL, internal_relation_count BIGINT NOT NULL, closed_count BIGINT NOT NULL, closure_rate DOUBLE, severity STRING NOT NULL",
    "core_missingness_qc": "source_snapshot_id STRING NOT NULL, table_name STRING NOT NULL, field_name STRING NOT NULL, missing_count BIGINT NOT NULL, total_count BIGINT NOT NULL, missing_rate DOUBLE, severity STRING NOT NULL",
    "core_conflict_qc": "source_snapshot_id STRING NOT NULL, entity_type STRING NOT NULL, field_name STRING NOT NULL, entity_count BIGINT NOT NULL, conflicted_entity_count BIGINT NOT NULL, conflict_rate DOUBLE, example_entity_accession STRING, example_values STRING, example_file_ids STRING, severity STRING NOT NULL",
    "directory_file_consistency_qc": "source_snapshot_id STRING NOT NULL, directory_id STRING NOT NULL, directory_accession STRING NOT NULL, observed_xml_count BIGINT NOT NULL, xml_kind_consistency_status STRING NOT NULL, severity STRING NOT NULL",
}
#: Folders of the tables that don't lie at the root.
FOLDERS = {
    "manifest": ("directory_manifest", "chunk_manifest"),
    "core": ("run_core_raw", "experiment_core_raw", "sample_core_raw", "study_core_raw", "run_core", "experiment_core", "sample_core", "study_core", "sample_attribute_core"),
    "inventory": ("xml_path_inventory",),
    "qc": ("parse_qc_summary", "entity_qc_summary", "relation_closure_qc", "core_missingness_qc", "core_conflict_qc", "directory_file_consistency_qc"),
}
_SEVERITY = ("hard_fail", "warning", "report_only")
ENUMS = {
    ("build_manifest", "manifest_subset_type"): ("targeted", "deterministic_random", "prefix_stratified", "stress_mixed", "full"),
    ("build_manifest", "build_status"): ("running", "succeeded", "failed"),
    ("file_index", "parse_status"): ("ok", "empty_file", "xml_parse_error", "unsupported_root", "oversized_xml", "io_error", "partial"),
    ("file_index", "error_type"): ("none", "xml_syntax", "encoding", "missing_required_accession", "oversized_xml", "io", "unexpected_root", "unknown"),
    ("entity_record_index", "parse_status"): ("ok", "missing_accession", "invalid_accession", "partial"),
    ("entity_index", "entity_presence_status"): ("primary_present", "reference_only", "conflicted"),
    ("relation_index", "closure_status"): ("closed", "reference_only", "missing_dst_entity", "external_reference", "not_checked"),
    **{(table, "severity"): _SEVERITY for table in FOLDERS["qc"]},
}
KEYS = {"entity_index": ("source_snapshot_id", "entity_type", "entity_accession")}
ENTITY_TYPES = ("RUN", "EXPERIMENT", "SAMPLE", "STUDY", "SUBMISSION", "ANALYSIS")


def schema(table: str) -> T.StructType:
    """The contract of ``table``; nullable says whether a column may hold nulls."""
    return T.StructType.fromDDL(TABLES[table])


def path(table: str) -> str:
    """Where ``table`` lies below the root of a build."""
    return "/".join([*(f for f, names in FOLDERS.items() if table in names), f"{table}.parquet"])
