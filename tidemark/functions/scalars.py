"""Scalar expressions: missing values, prefixes, ids, text clean-up. All stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Archive prefixes, file kinds and their XML root tags.
PREFIXES = ("SRA", "ERA", "DRA")
KINDS = ("run", "experiment", "sample", "study", "submission", "analysis")
ROOT_OF_KIND = {k: f"{k.upper()}_SET" for k in KINDS}
TEXT_LIMIT, EXAMPLE_LIMIT = 2000, 500
#: What assembly tables write for no value.
PLACEHOLDERS = ("", "na", "n/a", "-")


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def non_missing(c: Column | str) -> Column:
    """Neither null nor empty nor ``-``; never null."""
    return F.coalesce(~_c(c).isin("", "-"), F.lit(False))


def prefix_class(c: Column | str) -> Column:
    """The archive prefix of an accession, or OTHER."""
    head = F.substring(_c(c), 1, 3)
    return F.when(head.isin(*PREFIXES), head).otherwise(F.lit("OTHER"))


def missing_to_dash(c: Column | str) -> Column:
    return F.when(non_missing(c), _c(c)).otherwise(F.lit("-"))


def try_bigint(c: Column | str) -> Column:
    """Whole numbers as long; ``-`` and all other text null."""
    return F.nullif(_c(c), F.lit("-")).try_cast("bigint")


def clean_ws(c: Column | str) -> Column:
    """White space of any alphabet collapsed to one blank, trimmed; null gives ''."""
    return F.coalesce(F.trim(F.regexp_replace(_c(c), r"(?U)\s+", " ")), F.lit(""))


def truncated(c: Column | str, limit: int = TEXT_LIMIT) -> tuple[Column, Column]:
    """The first ``limit`` characters, and whether there were more."""
    return F.substring(_c(c), 1, limit), F.coalesce(F.length(_c(c)) > limit, F.lit(False))


def stable_id(*parts: Column | str) -> Column:
    """SHA-1 over the parts joined by U+001F; a null part counts as empty text."""
    return F.sha1(F.concat_ws("\x1f", *[F.coalesce(_c(p).cast("string"), F.lit("")) for p in parts]))


def sha256_text(c: Column | str) -> Column:
    return F.sha2(F.encode(_c(c), "UTF-8"), 256)


def local_name(tag: Column | str) -> Column:
    """A tag without its ``{namespace}``."""
    return F.regexp_replace(_c(tag), r"^.*\}", "")


def kind_from_filename(name: Column | str) -> Column:
    found = F.regexp_extract(_c(name), r"\.(%s)\.xml$" % "|".join(KINDS), 1)
    return F.when(found == "", F.lit("unknown")).otherwise(found)


def kind_from_root(tag: Column | str) -> Column:
    found = F.regexp_extract(F.lower(_c(tag)), r"^(%s)_set$" % "|".join(KINDS), 1)
    return F.when((found == "") | found.isNull() | (F.upper(_c(tag)) != _c(tag)), F.lit("unknown")).otherwise(found)


def kind_consistency(by_name: Column | str, by_root: Column | str) -> Column:
    a, b = _c(by_name), _c(by_root)
    return F.when(a == b, "consistent").when(b != "unknown", "mismatch").otherwise("unknown")


def effective_kind(by_name: Column | str, by_root: Column | str) -> Column:
    return F.when(_c(by_root) != "unknown", _c(by_root)).otherwise(_c(by_name))


def entity_path(entity_type: Column | str, ordinal: Column | str) -> Column:
    return F.concat(F.lit("//"), _c(entity_type), F.lit("["), _c(ordinal).cast("string"), F.lit("]"))


def prefix3(c: Column | str) -> Column:
    return F.substring(_c(c), 1, 3)


def relative_path(path: Column | str, entity_type: Column | str) -> Column:
    """What follows the first path segment named like the entity; null where there is none."""
    p = F.concat(_c(path), F.lit("/"))
    seg = F.concat(F.lit("/"), _c(entity_type), F.lit("/"))
    at = F.locate(seg, p) if isinstance(seg, str) else F.call_function("locate", seg, p)
    rest = F.substring(_c(path), at + F.length(seg) - 1, F.length(path))
    return F.when(at > 0, rest)


def first_non_empty(*cs: Column | str) -> Column:
    return F.coalesce(*[F.nullif(_c(c), F.lit("")) for c in cs])


def safe_ratio(x: Column | str, y: Column | str) -> Column:
    """x / y as double; null where y is 0."""
    return _c(x).cast("double") / F.nullif(_c(y).cast("double"), F.lit(0.0))


def metric_key(*parts: Column | str) -> Column:
    return F.concat_ws("|", *[_c(p) for p in parts])


def json_text(m: Column | str) -> Column:
    """A map as JSON text with sorted keys."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(_c(m)))))


def utc_timestamp(c: Column | str) -> Column:
    """ISO text or a timestamp as UTC wall clock without zone."""
    return F.to_utc_timestamp(F.to_timestamp(_c(c)), F.current_timezone()).cast("timestamp_ntz")


def library_layout(child: Column | str) -> Column:
    """PAIRED, SINGLE or '' from the name of the layout's child element."""
    return F.when(_c(child).isin("PAIRED", "SINGLE"), _c(child)).otherwise(F.lit(""))


def null_normalised(c: Column | str) -> Column:
    """Placeholders of assembly tables as null."""
    return F.when(~F.trim(F.lower(_c(c))).isin(*PLACEHOLDERS), _c(c))


def strain_or_isolate(infraspecific: Column | str, isolate: Column | str) -> Column:
    return F.coalesce(null_normalised(infraspecific), null_normalised(isolate))


def bool_text(c: Column | str) -> Column:
    return _c(c).cast("string")
