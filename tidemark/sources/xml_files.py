"""XML files to rows: one parse of each file gives a row with its entities, and if asked its nodes, as nested arrays.

The parse runs in Arrow batches over rows shaped like Spark's ``binaryFile`` source. Empty, malformed and unknown files
are data, never failures of the job. Names are compared without namespace; "first" is document order at any depth.
"""

from __future__ import annotations

import io
import itertools
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import scalars as X
from tidemark.functions.contract import ENTITY_TYPES
from tidemark.sources import trees as T

ENTITY = "array<struct<entity_type: string, ordinal: long, accession: string, accession_source: string, alias: string, primary_id: string, submitter_id: string, fields: map<string, string>, attributes: array<struct<tag: string, value: string>>>>"
NODE = "array<struct<entity_type: string, accession: string, path: string, is_attribute: boolean, value: string>>"
#: Paths of a file by the entities that have them, so that these are listed once a set and not once a path.
PATH = "array<struct<entities: array<string>, paths: array<struct<entity_type: string, path: string, is_attribute: boolean, nodes: long, filled: long, longest: long, accession: string, value: string, cut: boolean>>>>"
#: Bytes of a file up to which its tree is held as a whole; larger files are read an outermost entity at a time.
TREE = 4 << 20
#: Entities of such a larger file that are held as Python's objects; then they become columns, which take a fraction.
HELD = 10_000


class _Names(dict):
    """Tags without namespace by tag; a look into a dictionary is the cheapest of all, and there is one for each element."""

    def __missing__(self, tag) -> str:
        if len(self) >= 4_096:
            self.clear()
        self[tag] = name = tag.rpartition("}")[2] if isinstance(tag, str) else ""
        return name


_LOCAL = _Names()


def _name(node: ET.Element) -> str:
    return _LOCAL[node.tag]


def _clean(text: str | None) -> str:
    return " ".join(text.split()) if text else ""


def _whole(node: ET.Element) -> str:
    """The cleaned text of an element and what it holds."""
    return _clean("".join(node.itertext()) if len(node) else node.text)


class _Element:
    """Questions to an element; missing things are empty text."""

    def __init__(self, node: ET.Element):
        self.node = node
        self.first = first = {}
        if len(node):
            below = node.iter()
            next(below)
            for x in below:
                if (name := _LOCAL[x.tag]) not in first:
                    first[name] = x

    def attribute(self, name: str) -> str:
        return _clean(self.node.get(name))

    def text(self, name: str) -> str:
        x = self.first.get(name)
        return "" if x is None else _whole(x)

    def of(self, name: str, attribute: str) -> str:
        x = self.first.get(name)
        return "" if x is None else _clean(x.get(attribute))

    def external(self, namespace: str) -> str:
        if "EXTERNAL_ID" not in self.first:
            return ""
        return next((_whole(x) for x in self.node.iter() if _name(x) == "EXTERNAL_ID" and _clean(x.get("namespace")) == namespace), "")

    def linked(self, db: str) -> str:
        for x in self.node.iter() if "XREF_LINK" in self.first else ():
            if _name(x) == "XREF_LINK" and (link := _Element(x)).text("DB") == db:
                return link.text("LABEL") or link.text("ID")
        return ""

    def children(self, name: str) -> list[ET.Element]:
        x = self.first.get(name)
        return [] if x is None else list(x)


def _accession(e: _Element) -> tuple[str, str]:
    if own := e.attribute("accession"):
        return own, "@accession"
    found = e.text("PRIMARY_ID")
    return found, "PRIMARY_ID" if found else ""


#: The fields of each kind, in the order of ``_fields``.
_FIELDS = {
    "RUN": ("experiment_accession",),
    "EXPERIMENT": ("library_strategy", "library_source", "library_selection", "title", "design_description", "sample_accession", "study_accession", "platform", "instrument_model", "library_layout", "center_name"),
    "SAMPLE": ("bio_sample_id", "bioproject_id", "taxon_id", "scientific_name"),
    "STUDY": ("bioproject_id", "bioproject_by", "study_type", "study_title"),
}
_OTHER = ("center_name", "lab_name", "title")


def _fields(kind: str, e: _Element) -> tuple[str, ...]:
    if kind == "RUN":
        return (e.of("EXPERIMENT_REF", "accession"),)
    if kind == "EXPERIMENT":
        platform = e.children("PLATFORM")
        model = next((m for c in platform if (m := _clean(c.get("instrument_model")))), "") or e.text("INSTRUMENT_MODEL")
        layout = e.children("LIBRARY_LAYOUT")
        text = e.text
        return text("LIBRARY_STRATEGY"), text("LIBRARY_SOURCE"), text("LIBRARY_SELECTION"), text("TITLE"), text("DESIGN_DESCRIPTION"), e.of("SAMPLE_DESCRIPTOR", "accession"), e.of("STUDY_REF", "accession"), _name(platform[0]) if platform else "", model, _name(layout[0]) if layout else "", e.attribute("center_name")
    if kind == "SAMPLE":
        return e.external("BioSample"), e.linked("bioproject"), e.text("TAXON_ID"), e.text("SCIENTIFIC_NAME")
    if kind == "STUDY":
        own, other = e.external("BioProject"), e.linked("bioproject")
        return own or other, "EXTERNAL_ID" if own else "XREF_LINK", e.text("STUDY_TYPE") or e.of("STUDY_TYPE", "existing_study_type"), e.text("STUDY_TITLE")
    return e.attribute("center_name"), e.attribute("lab_name"), e.text("TITLE")


_KINDS = frozenset(ENTITY_TYPES)


def _entities(root: ET.Element, seen: dict[str, int] | None = None) -> list[tuple]:
    """The entities of ``root`` in document order, numbered by kind from those ``seen`` on.

    Each has entity type, ordinal, accession, its source, alias, primary id, submitter id, the values of ``_FIELDS``
    and the attributes (tag, value): tuples, which become columns with far less work than dictionaries.
    """
    seen = {} if seen is None else seen
    out = []
    for node in root.iter():
        if (kind := _LOCAL[node.tag]) in _KINDS:
            e = _Element(node)
            accession, source = _accession(e)
            seen[kind] = ordinal = seen.get(kind, 0) + 1
            attributes = [(a.text("TAG"), a.text("VALUE")) for x in node.iter() if _name(x) == "SAMPLE_ATTRIBUTE" for a in [_Element(x)]] if kind == "SAMPLE" and "SAMPLE_ATTRIBUTE" in e.first else ()
            out.append((kind, ordinal, accession, source, e.attribute("alias"), e.text("PRIMARY_ID"), e.text("SUBMITTER_ID"), _fields(kind, e), attributes))
    return out


class _Text:
    """The cleaned text of an element whose pieces come one by one: its length and its first characters."""

    def __init__(self):
        self.size, self.head, self.gap = 0, "", False

    def add(self, piece: str) -> None:
        words = piece.split()
        if words:
            text = (" " if self.size and (self.gap or piece[0].isspace()) else "") + " ".join(words)
            self.size += len(text)
            self.head += text[: X.EXAMPLE_LIMIT - len(self.head)]
        self.gap = piece[-1].isspace() if words else True


def _count(c: list, accession: str | None, head: str, size: int) -> None:
    """Adds a value to the counts of its path."""
    c[0] += 1
    if accession is not None:
        c[4].add(accession)
    if size:
        c[1] += 1
        if size > c[2]:
            c[2] = size
        best = c[3]
        if best is None or not best[0] or accession is None or accession <= best[1]:
            example = (accession is not None, accession or "", head[: X.EXAMPLE_LIMIT], size > X.EXAMPLE_LIMIT)
            c[3] = example if best is None else min(best, example)


class _Step:
    """A path of elements: its counts, those of its attributes and the steps below, by name as it is written."""

    __slots__ = ("below", "counts", "inner", "own", "path")

    def __init__(self, counts: list, path: str, inner: str | None):
        self.counts, self.path, self.inner = counts, path, inner
        self.below: dict[str, _Step | None] = {}
        self.own: dict[str, list] = {}


class _Paths:
    """Counts by path of one file: nodes, filled ones, the longest value, the least example and the entities."""

    def __init__(self):
        self.of: dict[tuple, list] = {}
        self.steps: dict[tuple, _Step] = {}

    def _counts(self, kind: str | None, path: str, is_attribute: bool) -> list:
        c = self.of.get((kind, path, is_attribute))
        if c is None:
            c = self.of[kind, path, is_attribute] = [0, 0, 0, None, set()]
        return c

    def add(self, kind: str | None, accession: str | None, path: str, is_attribute: bool, head: str, size: int) -> None:
        _count(self._counts(kind, path, is_attribute), accession, head, size)

    def _step(self, kind: str | None, path: str, name: str) -> _Step:
        found = self.steps.get((kind, path))
        if found is None:
            found = self.steps[kind, path] = _Step(self._counts(kind, path, False), path, name if name in _KINDS else kind)
        return found

    def tree(self, root: ET.Element, path: str | None = None) -> None:
        """Counts every element and attribute below ``root``, as ``_nodes`` lists them."""
        todo = [(root, self._step(None, path or f"/{_name(root)}", _name(root)), None, None)]
        while todo:
            node, step, kind, accession = todo.pop()
            inside = len(node)
            value = _whole(node) if inside else node.text
            if value:
                value = value if inside else " ".join(value.split())
                _count(step.counts, accession, value, len(value))
            else:  # most elements have no text
                step.counts[0] += 1
                if accession is not None:
                    step.counts[4].add(accession)
            for k, v in node.items():
                own = step.own.get(k)
                if own is None:
                    own = step.own[k] = self._counts(kind, f"{step.path}/@{k.rpartition('}')[2]}", True)
                value = _clean(v)
                _count(own, accession, value, len(value))
            if not inside:
                continue
            if _LOCAL[node.tag] in _KINDS:
                accession = _clean(node.get("accession")) or _accession(_Element(node))[0] or accession
            inner, below = step.inner, step.below
            for x in node:
                tag = x.tag
                if tag not in below:
                    name = _LOCAL[tag]
                    below[tag] = self._step(inner, f"{step.path}/{name}", name) if name else None
                if (to := below[tag]) is not None:
                    todo.append((x, to, inner, accession))

    def rows(self) -> list[dict]:
        sets: dict[frozenset, list[dict]] = {}
        for (k, p, a), (n, f, m, e, s) in self.of.items():
            sets.setdefault(frozenset(s), []).append({"entity_type": k, "path": p, "is_attribute": a, "nodes": n, "filled": f, "longest": m, "accession": e[1] if e and e[0] else None, "value": e[2] if e else None, "cut": e[3] if e else None})
        return [{"entities": sorted(s), "paths": of} for s, of in sets.items()]


def _streamed(content: bytes | pa.Buffer, paths: _Paths | None = None, full: Callable[[list[tuple]], None] | None = None) -> tuple[ET.Element, list[tuple]]:
    """The root, without what it held, and the entities as ``_entities`` gives them; only one outermost entity's tree is held at a time.

    ``paths`` gets the counts of all nodes, as ``_nodes`` gives them. ``full`` gets the entities whenever there are ``HELD``
    of them, and only those after the last call are returned.
    """
    seen: dict[str, int] = {}
    out: list[tuple] = []
    around: list[tuple[ET.Element, str, _Text]] = []
    last: ET.Element | None = None  # the child that ended last; its tail comes with the next event
    inside = 0

    def pieces(*found: str | None) -> None:
        for piece in found:
            if piece:
                for _, _, text in around:
                    text.add(piece)

    for event, node in ET.iterparse(io.BytesIO(content) if isinstance(content, bytes) else pa.BufferReader(content), ("start", "end")):
        entity = _name(node) in ENTITY_TYPES
        if event == "start":
            if not inside:
                if around:
                    pieces(around[-1][0].text if last is None else last.tail)
                if not entity:
                    around.append((node, f"{around[-1][1] if around else ''}/{_name(node)}", _Text()))
                last = None
            inside += entity
            continue
        inside -= entity
        if inside:
            continue
        if entity:
            out += _entities(node, seen)
            if full is not None and len(out) >= HELD:
                full(out)
                out = []
            if paths is not None:
                paths.tree(node, f"{around[-1][1] if around else ''}/{_name(node)}")
                pieces(*node.itertext())
        else:
            pieces(node.text if last is None else last.tail)
            _, path, text = around.pop()
            if paths is not None:
                paths.add(None, None, path, False, text.head, text.size)
                for k, v in node.attrib.items():
                    paths.add(None, None, f"{path}/@{k.rpartition('}')[2]}", True, _clean(v), len(_clean(v)))
        if around:
            around[-1][0].remove(node)
        else:
            root = node
        last = node
    return root, out


#: Bytes of contents whose entities are held at once, unless one file has more.
SLICE = 1 << 20


def _slices(lengths: list[int]) -> Iterator[tuple[int, int]]:
    """First place and number of rows of slices of 64 rows at most, and of over ``SLICE`` bytes only where one row is."""
    first = size = 0
    for k, n in enumerate(lengths):
        if k > first and (k - first == 64 or size + n > SLICE):
            yield first, k - first
            first, size = k, 0
        size += n
    if lengths:
        yield first, len(lengths) - first


def _node_rows(root: ET.Element, names: frozenset[str] | None = None) -> Iterator[tuple]:
    """Every element and attribute (entity type, accession, path, is attribute, value); an entity's own element still belongs to what stands around it.

    ``names``: only those of these names (attributes as @name) that have a value.
    """
    every = names is None
    todo = [(root, f"/{_name(root)}", None, None)]
    below: dict[tuple, str] = {}
    while todo:
        node, path, kind, accession = todo.pop()
        name = _LOCAL[node.tag]
        if every or name in names:
            value = _whole(node)
            if every or value:
                yield kind, accession, path, False, value
        for k, v in node.attrib.items():
            own = f"@{k.rpartition('}')[2]}"
            if every or own in names:
                value = _clean(v)
                if every or value:
                    yield kind, accession, f"{path}/{own}", True, value
        if not len(node):
            continue
        if name in _KINDS:
            kind, accession = name, _clean(node.get("accession")) or _accession(_Element(node))[0] or accession
        for x in reversed(node):
            if tag := _LOCAL[x.tag]:
                to = below.get((path, tag)) or below.setdefault((path, tag), f"{path}/{tag}")
                todo.append((x, to, kind, accession))


def _nodes(root: ET.Element) -> list[dict]:
    return [dict(zip(("entity_type", "accession", "path", "is_attribute", "value"), r, strict=True)) for r in _node_rows(root)]


def _offsets(lists: list) -> pa.Array:
    return pa.array([0, *itertools.accumulate(map(len, lists))], pa.int32())


def _struct(rows: list[tuple], kind: pa.StructType) -> pa.StructArray:
    """Rows by column: far less work than a dictionary for each row."""
    columns = list(zip(*rows, strict=True)) if rows else [()] * kind.num_fields
    return pa.StructArray.from_arrays([pa.array(c, kind.field(i).type) for i, c in enumerate(columns)], fields=list(kind))


def _listed(lists: list[list], kind: pa.ListType) -> pa.ListArray:
    """Lists of tuples as lists of structs."""
    return pa.ListArray.from_arrays(_offsets(lists), _struct([x for of in lists for x in of], kind.value_type), type=kind)


def _entity_struct(every: list[tuple], of: pa.StructType) -> pa.StructArray:
    """Entities, as ``_entities`` gives them, by column."""
    *plain, fields, attributes = zip(*every, strict=True) if every else [()] * of.num_fields
    columns = [pa.array(c, of.field(i).type) for i, c in enumerate(plain)]
    names = [n for e in every for n in _FIELDS.get(e[0], _OTHER)]
    mapped = pa.MapArray.from_arrays(_offsets(fields), pa.array(names, pa.string()), pa.array([v for f in fields for v in f], pa.string()))
    tagged = _listed(attributes, of.field("attributes").type)
    return pa.StructArray.from_arrays([*columns, mapped.cast(of.field("fields").type), tagged], fields=list(of))


def _entity_lists(lists: list[list[tuple] | pa.StructArray], kind: pa.ListType) -> pa.ListArray:
    """A list for each file: of its entities as ``_entities`` gives them, or as columns already."""
    if len(lists) == 1 and isinstance(lists[0], pa.StructArray):
        every = lists[0]
    elif any(isinstance(of, pa.StructArray) for of in lists):
        every = pa.concat_arrays([of if isinstance(of, pa.StructArray) else _entity_struct(of, kind.value_type) for of in lists])
    else:
        every = _entity_struct([e for of in lists for e in of], kind.value_type)
    return pa.ListArray.from_arrays(_offsets(lists), every, type=kind)


def _in_columns(content: bytes | pa.Buffer, paths: _Paths | None, of: pa.StructType | None) -> tuple[ET.Element, list[pa.StructArray], int]:
    """The root, the entities by column in pieces (without ``of``: none) and their number, read as ``_streamed`` does.

    Python holds ``HELD`` entities and an outermost one's at once, however many the file has.
    """
    pieces: list = []
    add = lambda found: pieces.append(len(found) if of is None else _entity_struct(found, of))
    root, rest = _streamed(content, paths, add)
    add(rest)
    return (root, [], sum(pieces)) if of is None else (root, pieces, sum(map(len, pieces)))


def parsed(files: DataFrame, snapshot: str, with_nodes: bool | tuple[str, ...] = False, largest: int | None = None, keep: tuple[str, ...] = (), with_paths: bool = False, with_entities: bool = True) -> DataFrame:
    """A row a file: the file index's columns, ``entities``, ``nodes`` and ``paths``, and the string columns ``keep`` of ``files``.

    ``nodes`` are filled only if asked (the file's tree is then held as a whole; names: only nodes of these names that
    have a value), and so are ``paths``, their counts,
    which are made while the file is read, an outermost entity at a time. Not ``with_entities``: they are only counted.

    ``files`` has path, modificationTime, length, content. Files of any size are parsed; only where a caller gives
    ``largest``, those of more bytes are not and get the status oversized_xml. A file's entities are one row's array.
    """

    names_of = frozenset(with_nodes) if isinstance(with_nodes, tuple) else None

    def one(content: pa.Buffer | None, length: int) -> tuple:
        if largest is not None and length > largest:
            return "oversized_xml", "unknown", "oversized_xml", None, 0, [], [], []
        if not content:
            return "empty_file", "unknown", "xml_syntax", None, 0, [], [], []
        paths = _Paths() if with_paths else None
        entities, pieces = [], []
        try:
            if with_nodes or len(content) <= TREE:
                root = ET.fromstring(content.to_pybytes())
                entities = _entities(root) if with_entities else []
                count = len(entities) if with_entities else sum(_LOCAL[x.tag] in _KINDS for x in root.iter())
                if paths is not None:
                    paths.tree(root)
            else:
                root, pieces, count = _in_columns(content, paths, entity if with_entities else None)
        except ET.ParseError as e:
            return "xml_parse_error", "unknown", "xml_syntax", str(e), 0, [], [], []
        except (ValueError, LookupError) as e:
            return "xml_parse_error", "unknown", "encoding", str(e), 0, [], [], []
        if pieces:
            entities = pa.concat_arrays(pieces)
        known = _name(root) in X.ROOT_OF_KIND.values()
        return "ok" if known else "unsupported_root", _name(root), "none" if known else "unexpected_root", None, count, entities, list(_node_rows(root, names_of)) if with_nodes else [], paths.rows() if paths else []

    entity = pa.struct([(n, pa.string()) for n in ("entity_type",)] + [("ordinal", pa.int64())] + [(n, pa.string()) for n in ("accession", "accession_source", "alias", "primary_id", "submitter_id")] + [("fields", pa.map_(pa.string(), pa.string())), ("attributes", pa.list_(pa.struct([("tag", pa.string()), ("value", pa.string())])))])
    node = pa.struct([("entity_type", pa.string()), ("accession", pa.string()), ("path", pa.string()), ("is_attribute", pa.bool_()), ("value", pa.string())])
    counts = pa.struct([("entity_type", pa.string()), ("path", pa.string()), ("is_attribute", pa.bool_()), *[(n, pa.int64()) for n in ("nodes", "filled", "longest")], ("accession", pa.string()), ("value", pa.string()), ("cut", pa.bool_())])
    path = pa.struct([("entities", pa.list_(pa.string())), ("paths", pa.list_(counts))])
    types = [pa.string()] * 4 + [pa.int64(), pa.list_(entity), pa.list_(node), pa.list_(path)]
    makers = [pa.array] * 5 + [_entity_lists, _listed, pa.array]
    names = ["parse_status", "root_tag", "error_type", "error_message", "entity_count", "entities", "nodes", "paths"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, n in _slices([len(c.as_buffer()) if c.is_valid else 0 for c in b.column(3)]):
                p = b.slice(k, n)
                rows = [one(c.as_buffer(), n.as_py()) for c, n in zip(p.column(3), p.column(2), strict=True)]
                columns = [make(list(c), t) for c, t, make in zip(zip(*rows, strict=True), types, makers, strict=True)]
                yield pa.RecordBatch.from_arrays([*(p.column(i) for i in (0, 1, 2)), *columns, *p.columns[4:]], names=["path", "mtime", "file_size", *names, *keep])

    raw = files.select(F.col("path").cast("string").alias("path"), F.col("modificationTime").cast("string").alias("mtime"), F.col("length").cast("long").alias("file_size"), "content", *keep)
    kept = "".join(f", {c} string" for c in keep)
    d = raw.mapInArrow(run, f"path string, mtime string, file_size long, parse_status string, root_tag string, error_type string, error_message string, entity_count long, entities {ENTITY}, nodes {NODE}, paths {PATH}{kept}")
    parts = F.split("path", "/")
    name, directory = F.element_at(parts, -1), F.element_at(parts, -2)
    by_name, by_root = X.kind_from_filename(name), X.kind_from_root("root_tag")
    relative = F.concat_ws("/", directory, name)
    return d.select(
        F.lit(snapshot).alias("source_snapshot_id"),
        X.stable_id(F.lit(snapshot), relative).alias("file_id"),
        X.stable_id(F.lit(snapshot), directory).alias("directory_id"),
        directory.alias("directory_accession"),
        X.effective_kind(by_name, by_root).alias("xml_kind"),
        by_name.alias("xml_kind_from_filename"),
        by_root.alias("xml_kind_from_root_tag"),
        X.kind_consistency(by_name, by_root).alias("xml_kind_consistency_status"),
        name.alias("file_name"),
        relative.alias("relative_file_path"),
        F.col("path").alias("absolute_file_path"),
        "file_size",
        F.to_timestamp_ntz("mtime").alias("mtime"),
        "parse_status",
        "root_tag",
        F.col("root_tag").alias("root_entity_set_type"),
        "entity_count",
        "error_type",
        "error_message",
        F.lit(0).cast("long").alias("parser_warning_count"),
        "entities",
        "nodes",
        "paths",
        *keep,
    )


def read_xml_tree(spark: SparkSession, *roots: str) -> DataFrame:
    """The files below ``root``/<directory>/ with their contents, empty ones too, listed and read by tasks."""
    return T.contents(T.listed(spark, *roots))


# --- tables from parsed files ----------------------------------------------------------------------------------

_KEYS = ("source_snapshot_id", "file_id", "directory_id", "directory_accession", "xml_kind", "root_tag")
_FILE = ("source_snapshot_id", "file_id", "directory_id", "directory_accession", "xml_kind", "xml_kind_from_filename", "xml_kind_from_root_tag", "xml_kind_consistency_status", "file_name", "relative_file_path", "absolute_file_path", "file_size", "mtime", "parse_status", "root_tag", "root_entity_set_type", "entity_count", "error_type", "error_message", "parser_warning_count")


def file_index(parsed_files: DataFrame) -> DataFrame:
    return parsed_files.drop("entities", "nodes", "paths", "chunk_id")


def _record_id(entity_type: Column, ordinal: Column, accession: Column) -> Column:
    return X.stable_id("source_snapshot_id", "file_id", entity_type, ordinal, F.coalesce(accession, F.lit("missing")))


#: Columns of entity records that follow from others.
_DERIVED = {
    "entity_record_id": lambda: _record_id(F.col("entity_type"), F.col("entity_ordinal"), F.col("entity_accession")),
    "entity_path": lambda: X.entity_path("entity_type", "entity_ordinal"),
}


def stripped(records: DataFrame) -> DataFrame:
    """Entity records for keeping: without the id and the path of each, which ``restored`` makes again. An id is 40 digits that don't compress."""
    return records.drop(*_DERIVED)


def restored(kept: DataFrame) -> DataFrame:
    """Entity records as they were before ``stripped``; what isn't asked for isn't made."""
    columns = list(kept.columns)
    columns.insert(columns.index("source_snapshot_id") + 1, "entity_record_id")
    columns.insert(columns.index("entity_ordinal"), "entity_path")
    return kept.select(*[_DERIVED[c]().alias(c) if c in _DERIVED else c for c in columns])


def entity_records(parsed_files: DataFrame) -> DataFrame:
    """The entity record index, with ``fields`` and ``attributes`` besides."""
    return _records(parsed_files.select(*_KEYS, F.explode("entities").alias("e")))


def records_with_files(parsed_files: DataFrame) -> DataFrame:
    """``entity_records`` and, in the first row of each file, ``file``, the rest of its row of the file index, so that one parse gives both.

    A file without entities has one row, which is no record; ``only_records`` and ``files_of`` take the parts out again.
    """
    rest = F.struct(*[c for c in file_index(parsed_files).columns if c not in _KEYS])
    e = parsed_files.select(*_KEYS, rest.alias("file"), F.posexplode_outer("entities").alias("at", "e"))
    return _records(e.withColumn("file", F.when(F.coalesce("at", F.lit(0)) == 0, F.col("file"))), "file")


def only_records(both: DataFrame) -> DataFrame:
    return both.where(F.col("entity_type").isNotNull()).drop("file")


def files_of(both: DataFrame) -> DataFrame:
    """The file index from ``records_with_files``."""
    rest = both.schema["file"].dataType.names
    return both.where(F.col("file").isNotNull()).select(*[F.col(f"file.{c}" if c in rest else c) for c in _FILE])


def _records(e: DataFrame, *others: str) -> DataFrame:
    empty = lambda c: F.nullif(F.col(f"e.{c}"), F.lit("")).alias(c)
    ok = F.col("e.accession") != ""
    return e.select(
        "source_snapshot_id",
        _record_id(F.col("e.entity_type"), F.col("e.ordinal"), F.when(ok, F.col("e.accession"))).alias("entity_record_id"),
        F.nullif(F.col("e.accession"), F.lit("")).alias("entity_accession"),
        F.col("e.entity_type").alias("entity_type"),
        F.lit("primary").alias("occurrence_role"),
        *_KEYS[1:],
        X.entity_path("e.entity_type", "e.ordinal").alias("entity_path"),
        F.col("e.ordinal").alias("entity_ordinal"),
        F.nullif(F.col("e.accession_source"), F.lit("")).alias("accession_source_path"),
        empty("alias"),
        empty("primary_id"),
        empty("submitter_id"),
        F.when(ok, "ok").otherwise("missing_accession").alias("parse_status"),
        F.col("e.fields").alias("fields"),
        F.col("e.attributes").alias("attributes"),
        *others,
    )


_CORE = {
    "RUN": ("run_accession", ("alias", "experiment_accession")),
    "EXPERIMENT": ("experiment_accession", ("sample_accession", "study_accession", "library_strategy", "library_source", "library_selection", "platform", "instrument_model")),
    "SAMPLE": ("sample_accession", ("bio_sample_id", "taxon_id", "scientific_name")),
    "STUDY": ("study_accession", ("bioproject_id", "study_type", "study_title")),
    "SUBMISSION": ("submission_accession", ("alias", "center_name", "lab_name")),
    "ANALYSIS": ("analysis_accession", ("alias", "center_name", "title")),
}
_EXTENDED = ("alias", "title", "library_layout", "design_description", "center_name")


def core(records: DataFrame, kind: str, columns: tuple[str, ...] | None = None) -> DataFrame:
    """The core table of an entity type; empty values are null, a missing accession is ''."""
    key, own = _CORE[kind]
    value = lambda c: (F.col("alias") if c == "alias" else F.nullif(F.element_at("fields", c), F.lit(""))).alias(c)
    return records.where(F.col("entity_type") == kind).select("source_snapshot_id", "entity_record_id", "file_id", F.coalesce("entity_accession", F.lit("")).alias(key), *map(value, columns or own))


def experiment_extended(records: DataFrame) -> DataFrame:
    """Columns of experiments that only the back check reads; the description cut and flagged."""
    d = core(records, "EXPERIMENT", _EXTENDED)
    text, cut = X.truncated("design_description")
    return d.withColumns({"library_layout": X.library_layout("library_layout"), "design_description_truncated": cut}).withColumn("design_description", text)


def sample_attributes(records: DataFrame) -> DataFrame:
    """A row for each attribute of a sample, numbered from 1; long values cut and flagged."""
    d = records.where(F.col("entity_type") == "SAMPLE").select("source_snapshot_id", "entity_record_id", "file_id", F.col("entity_accession").alias("sample_accession"), F.nullif(F.element_at("fields", F.lit("bio_sample_id")), F.lit("")).alias("bio_sample_id"), F.posexplode("attributes").alias("at", "a"))
    text, cut = X.truncated("a.value")
    return d.select("source_snapshot_id", "entity_record_id", "file_id", "sample_accession", "bio_sample_id", F.col("a.tag").alias("tag"), F.nullif(text, F.lit("")).alias("value"), (F.col("at") + 1).cast("long").alias("attribute_ordinal"), cut.alias("value_truncated"))


def xml_nodes(parsed_files: DataFrame) -> DataFrame:
    """A row for each element and attribute, its path inside the entity included."""
    n = parsed_files.select("source_snapshot_id", "file_id", "xml_kind", "root_tag", F.explode("nodes").alias("n")).select("source_snapshot_id", "file_id", "xml_kind", "root_tag", "n.*")
    return n.withColumn("path_entity_relative", X.relative_path("path", "entity_type"))


def path_sets(parsed_files: DataFrame) -> DataFrame:
    """A row for each set of entities of a file, with the paths that just these have."""
    return parsed_files.select("source_snapshot_id", "xml_kind", "root_tag", "file_id", F.explode("paths").alias("s")).select("source_snapshot_id", "xml_kind", "root_tag", "file_id", "s.*")


def path_counts(sets: DataFrame) -> DataFrame:
    """A row for each path of a file, as ``index.path_parts`` makes it from nodes; from parsed files or their ``path_sets``."""
    if "parse_status" in sets.columns:
        sets = path_sets(sets)
    p = sets.select("source_snapshot_id", "xml_kind", "root_tag", "file_id", "entities", F.explode("paths").alias("p"))
    example = F.when(F.col("p.filled") > 0, F.struct("file_id", "p.accession", "p.value", "p.cut")).alias("example")
    return p.select("source_snapshot_id", "xml_kind", "root_tag", "p.entity_type", "p.path", X.relative_path("p.path", "p.entity_type").alias("path_entity_relative"), "p.is_attribute", "file_id", "p.nodes", "p.filled", "p.longest", example, "entities")


def selected_fields(nodes: DataFrame, names: list[str]) -> DataFrame:
    """Non-empty values of listed elements: entity, field name, path, value."""
    field = F.element_at(F.split("path", "/"), -1)
    return nodes.where(field.isin(*names) & (F.col("value") != "")).select(F.col("accession").alias("entity_accession"), "entity_type", field.alias("field_name"), F.col("path").alias("field_path"), "value")
