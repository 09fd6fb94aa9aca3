"""A second reading of the XML files, by Spark's own XML parser, to hold against the index tables.

It shares no code with the first one, so an error of either shows as a difference.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalars as X

_LINK = "struct<XREF_LINK: struct<DB: string, ID: string, LABEL: string>>"
_IDS = "IDENTIFIERS: struct<PRIMARY_ID: string, EXTERNAL_ID: array<struct<_VALUE: string, _namespace: string>>>"
#: What is read of each kind's entities, in Spark's notation of XML: attributes begin with an underscore.
_SHAPES = {
    "RUN": "struct<_accession: string, _alias: string, IDENTIFIERS: struct<PRIMARY_ID: string>, EXPERIMENT_REF: struct<_accession: string>>",
    "EXPERIMENT": "struct<_accession: string, IDENTIFIERS: struct<PRIMARY_ID: string>, STUDY_REF: struct<_accession: string>, DESIGN: struct<SAMPLE_DESCRIPTOR: struct<_accession: string>, LIBRARY_DESCRIPTOR: struct<LIBRARY_STRATEGY: string, LIBRARY_SOURCE: string, LIBRARY_SELECTION: string>>, PLATFORM: string>",
    "SAMPLE": f"struct<_accession: string, {_IDS}, SAMPLE_NAME: struct<TAXON_ID: string, SCIENTIFIC_NAME: string>, SAMPLE_ATTRIBUTES: struct<SAMPLE_ATTRIBUTE: array<struct<TAG: string, VALUE: string>>>>",
    "STUDY": f"struct<_accession: string, {_IDS}, STUDY_LINKS: struct<STUDY_LINK: array<{_LINK}>>, DESCRIPTOR: struct<STUDY_TITLE: string, STUDY_TYPE: struct<_VALUE: string, _existing_study_type: string>>>",
    "SUBMISSION": "struct<_accession: string, _alias: string, _center_name: string, _lab_name: string, IDENTIFIERS: struct<PRIMARY_ID: string>>",
    "ANALYSIS": "struct<_accession: string, _alias: string, _center_name: string, IDENTIFIERS: struct<PRIMARY_ID: string>, TITLE: string>",
}
KINDS = tuple(_SHAPES)


def _external(namespace: str) -> Column:
    return F.get(F.filter("e.IDENTIFIERS.EXTERNAL_ID", lambda i: i["_namespace"] == namespace), 0)["_VALUE"]


def _given(*choices: Column) -> Column:
    """The first that isn't empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in choices])


def _linked() -> Column:
    """The BioProject that a study links to."""
    link = F.get(F.filter("e.STUDY_LINKS.STUDY_LINK", lambda x: x["XREF_LINK"]["DB"] == "bioproject"), 0)["XREF_LINK"]
    return _given(link["LABEL"], link["ID"])


def _columns(kind: str) -> dict[str, Column]:
    """The core table's columns of a kind."""
    e = F.col
    accession = F.coalesce(_given(e("e._accession"), e("e.IDENTIFIERS.PRIMARY_ID")), F.lit(""))
    if kind == "RUN":
        return {"run_accession": accession, "alias": e("e._alias"), "experiment_accession": e("e.EXPERIMENT_REF._accession")}
    if kind == "EXPERIMENT":
        # The platform is the name of the one element inside, so it is read as text.
        found = lambda pattern: F.regexp_extract("e.PLATFORM", pattern, 1)
        library = {c.lower(): e(f"e.DESIGN.LIBRARY_DESCRIPTOR.{c}") for c in ("LIBRARY_STRATEGY", "LIBRARY_SOURCE", "LIBRARY_SELECTION")}
        return {"experiment_accession": accession, "sample_accession": e("e.DESIGN.SAMPLE_DESCRIPTOR._accession"), "study_accession": e("e.STUDY_REF._accession"), **library, "platform": found(r"<(?:\w+:)?(\w+)"), "instrument_model": _given(found(r"""\sinstrument_model\s*=\s*["']([^"']*)"""), found("<INSTRUMENT_MODEL>([^<]*)<"))}
    if kind == "SAMPLE":
        return {"sample_accession": accession, "bio_sample_id": _external("BioSample"), "taxon_id": e("e.SAMPLE_NAME.TAXON_ID"), "scientific_name": e("e.SAMPLE_NAME.SCIENTIFIC_NAME")}
    if kind == "STUDY":
        return {"study_accession": accession, "bioproject_id": _given(_external("BioProject"), _linked()), "study_type": _given(e("e.DESCRIPTOR.STUDY_TYPE._VALUE"), e("e.DESCRIPTOR.STUDY_TYPE._existing_study_type")), "study_title": e("e.DESCRIPTOR.STUDY_TITLE")}
    if kind == "SUBMISSION":
        return {"submission_accession": accession, "alias": e("e._alias"), "center_name": e("e._center_name"), "lab_name": e("e._lab_name")}
    return {"analysis_accession": accession, "alias": e("e._alias"), "center_name": e("e._center_name"), "title": e("e.TITLE")}


def file_id(snapshot: str) -> Column:
    """The id of the file at ``path``."""
    parts = F.split("path", "/")
    return X.stable_id(F.lit(snapshot), F.concat_ws("/", F.element_at(parts, -2), F.element_at(parts, -1))).alias("file_id")


def reread(files: DataFrame, snapshot: str, kind: str) -> DataFrame:
    """file_id, entity_record_id and ``e``, the entity, for each entity of ``kind`` in ``files`` (path, content) of that kind."""
    own = files.where(F.col("path").endswith(f".{kind.lower()}.xml"))
    tree = F.from_xml(F.decode("content", "UTF-8"), f"{kind} array<{_SHAPES[kind]}>", {"attributePrefix": "_", "valueTag": "_VALUE"})
    d = own.select(file_id(snapshot), F.posexplode(tree[kind]).alias("at", "e"))
    accession = F.coalesce(_given(F.col("e._accession"), F.col("e.IDENTIFIERS.PRIMARY_ID")), F.lit("missing"))
    return d.select("file_id", X.stable_id(F.lit(snapshot), "file_id", F.lit(kind), F.col("at") + 1, accession).alias("entity_record_id"), "e")


def core(entities: DataFrame, kind: str) -> DataFrame:
    """file_id, entity_record_id and the columns of the core table."""
    return entities.select("file_id", "entity_record_id", *[c.alias(n) for n, c in _columns(kind).items()])


#: The edges of a kind: relation, type of the target, column of the core table.
EDGES = {
    "RUN": (("RUN_TO_EXPERIMENT", "EXPERIMENT", "experiment_accession"),),
    "EXPERIMENT": (("EXPERIMENT_TO_SAMPLE", "SAMPLE", "sample_accession"), ("EXPERIMENT_TO_STUDY", "STUDY", "study_accession")),
    "SAMPLE": (("SAMPLE_TO_BIOSAMPLE", "BioSample", "bio_sample_id"), ("SAMPLE_TO_TAXON", "Taxon", "taxon_id")),
    "STUDY": (("STUDY_TO_BIOPROJECT", "BioProject", "bioproject_id"),),
}


def edges(entities: DataFrame, kind: str) -> DataFrame:
    """file_id, src_accession, src_type, relation_type, dst_accession, dst_type of the edges of a kind."""
    c = _columns(kind)
    rows = F.array(*[F.struct(F.lit(r).alias("relation_type"), c[column].alias("dst_accession"), F.lit(t).alias("dst_type")) for r, t, column in EDGES[kind]])
    return entities.select("file_id", c[f"{kind.lower()}_accession"].alias("src_accession"), F.lit(kind).alias("src_type"), F.explode(rows).alias("r")).select("file_id", "src_accession", "src_type", "r.*").where("src_accession <> '' and dst_accession <> ''")


def attributes(samples: DataFrame) -> DataFrame:
    """file_id and the columns of the attribute table, for samples read by ``reread``."""
    a = samples.select("file_id", F.col("e._accession").alias("sample_accession"), _external("BioSample").alias("bio_sample_id"), F.posexplode("e.SAMPLE_ATTRIBUTES.SAMPLE_ATTRIBUTE").alias("at", "a"))
    text, cut = X.truncated(F.coalesce("a.VALUE", F.lit("")))
    return a.select("file_id", "sample_accession", "bio_sample_id", F.col("a.TAG").alias("tag"), F.nullif(text, F.lit("")).alias("value"), (F.col("at") + 1).cast("long").alias("attribute_ordinal"), cut.alias("value_truncated"))
