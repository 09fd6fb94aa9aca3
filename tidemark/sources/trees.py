"""Trees of files, <root>/<directory>/<file>: listed, read and written by tasks.

The driver names only the root. One task passes over its directories, which are then dealt to tasks that list and read
their files, so neither the number of directories nor that of files reaches the driver. Tasks open the tree by
pyarrow's file systems (local or mounted folders, s3, gs, hdfs, abfs); a local folder must be mounted on all executors.
Empty directories and empty files are rows like others.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.commit import file_system

#: Rows of a batch, and bytes of contents after which a batch ends.
ROWS, BYTES = 10_000, 32 << 20


def qualified(spark: SparkSession, root: str) -> str:
    """``root`` with its scheme, by Hadoop's default."""
    fs, p = file_system(spark, root)
    uri = p.makeQualified(fs.getUri(), fs.getWorkingDirectory()).toString().rstrip("/")
    return uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri


def _local(uri: str) -> str | None:
    """The path of a local file, else none."""
    return uri[7:] if uri.startswith("file://") else None


def _entries(uri: str, directories: bool) -> Iterator[tuple[str, int, float]]:
    """Name, bytes and time of change (seconds) of the directories, or of the files, right below ``uri``."""
    if (path := _local(uri)) is not None:
        with os.scandir(path) as found:
            for e in found:
                if e.is_dir() == directories:
                    s = None if directories else e.stat()
                    yield (e.name, 0, 0.0) if s is None else (e.name, s.st_size, s.st_mtime)
        return
    fs, path = pyarrow.fs.FileSystem.from_uri(uri)
    for e in fs.get_file_info(pyarrow.fs.FileSelector(path)):
        if (e.type == pyarrow.fs.FileType.Directory) == directories:
            yield e.base_name, e.size or 0, e.mtime.timestamp() if e.mtime else 0.0


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held = []
    for r in rows:
        held.append(r)
        if len(held) == ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def directories(spark: SparkSession, *roots: str) -> DataFrame:
    """path and directory_accession of the directories right below the roots; a root is one task."""
    tops = spark.createDataFrame([(qualified(spark, r),) for r in roots], "root string").repartition(len(roots))
    schema = pa.schema([("path", pa.string()), ("directory_accession", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((f"{top}/{name}", name) for b in batches for top in b.column(0).to_pylist() for name, _, _ in _entries(top, True))
        yield from _batches(rows, schema)

    return tops.mapInArrow(run, "path string, directory_accession string")


_TIME = pa.timestamp("us", "UTC")


def listed(spark: SparkSession, *roots: str, suffix: str = ".xml", parts: int | None = None) -> DataFrame:
    """directory_accession, path, length, modificationTime of every file; an empty directory has one row without a path."""
    dealt = directories(spark, *roots).repartition(parts or int(spark.conf.get("spark.sql.shuffle.partitions")))
    schema = pa.schema([("directory_accession", pa.string()), ("path", pa.string()), ("length", pa.int64()), ("modificationTime", _TIME)])

    def of(uri: str, name: str) -> Iterator[tuple]:
        none = True
        for file, size, changed in _entries(uri, False):
            if file.endswith(suffix):
                none = False
                yield name, f"{uri}/{file}", size, datetime.fromtimestamp(changed, UTC)
        if none:
            yield name, None, None, None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches((row for b in batches for uri, name in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for row in of(uri, name)), schema)

    return dealt.mapInArrow(run, "directory_accession string, path string, length long, modificationTime timestamp")


def file_counts(listing: DataFrame) -> DataFrame:
    """directory_accession, files, bytes, empty_files of every directory of a listing."""
    return listing.groupBy("directory_accession").agg(F.count("path").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"), F.count_if(F.col("length") == 0).alias("empty_files"))


def contents(listing: DataFrame) -> DataFrame:
    """The files of a listing (path, length, modificationTime and other columns) with their ``content``, as Spark's binaryFile source has it.

    A file that can't be read fails its task.
    """
    files = listing.where("path is not null")

    def read(uri: str) -> bytes:
        if (path := _local(uri)) is not None:
            with open(path, "rb") as f:
                return f.read()
        fs, path = pyarrow.fs.FileSystem.from_uri(uri)
        with fs.open_input_file(path) as f:
            return f.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            first, held, size = 0, [], 0
            for k, (uri, n) in enumerate(zip(b.column("path").to_pylist(), b.column("length").to_pylist(), strict=True)):
                if held and size + n > BYTES:
                    yield _with(b.slice(first, len(held)), held)
                    first, held, size = k, [], 0
                held.append(read(uri))
                size += n
            if held:
                yield _with(b.slice(first, len(held)), held)

    return files.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema) + ", content binary")


def _with(batch: pa.RecordBatch, content: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, pa.array(content, pa.binary())], names=[*batch.schema.names, "content"])


def write_files(files: DataFrame, root: str) -> tuple[int, int]:
    """Writes ``files`` (name, a path below the root; content) and returns their number and bytes. Without content a name is an empty directory.

    A file appears whole: it is written beside its place and renamed, so a task that runs again does no harm.
    """
    top = qualified(files.sparkSession, root)

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = size = 0
        fs, path = pyarrow.fs.FileSystem.from_uri(top) if _local(top) is None else (pyarrow.fs.LocalFileSystem(), _local(top))
        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                at = f"{path}/{name}"
                fs.create_dir(at if content is None else at.rpartition("/")[0], recursive=True)
                if content is not None:
                    with fs.open_output_stream(part := f"{at}.{uuid.uuid4().hex}") as f:
                        f.write(content)
                    fs.move(part, at)
                    n, size = n + 1, size + len(content)
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([size], pa.int64())], names=["n", "size"])

    done = files.select("name", "content").mapInArrow(put, "n long, size long").agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("size"), F.lit(0))).first()
    return done[0], done[1]
