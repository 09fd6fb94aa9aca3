"""Helpers shared by the corpus operators: input selection, shared folders, byte batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that separates words everywhere in this subpackage.
SPACE = r"[\x20\x09-\x0D]+"
_LOCAL_DIRS: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """Only ``doc_id`` and ``text`` (null read as empty), so that other columns can't clash."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def words_of(text: Column) -> Column:
    """Array of the runs of characters other than the six ASCII white spaces."""
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def shared_dir(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``; where that is unset, below a temporary one, on one machine only.

    A SparkContext without a checkpoint folder gets this root as well, so that ``checkpoint()`` works.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no folder that all executors share")
        app = spark.sparkContext.applicationId
        root = _LOCAL_DIRS.setdefault(app, tempfile.mkdtemp(prefix="spark-shared-"))
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


#: The scopes around, outermost first; each thread has its own.
_SCOPES: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """What ``written`` writes inside is deleted at the end, but for what is written for the scope around (``outer``)."""
    made: list[str] = []
    around = _SCOPES.set((*_SCOPES.get(), made))
    try:
        yield
    finally:
        _SCOPES.reset(around)
        for path in made:
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def written(df: DataFrame, outer: bool = False, options: dict[str, str | int] | None = None) -> DataFrame:
    """``df`` written as Parquet, with the writer's ``options``, in the shared folder and read back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = shared_dir(spark)
    df.write.options(**(options or {})).parquet(path)
    scopes = _SCOPES.get()
    if len(scopes) > outer:
        scopes[-1 - outer].append(path)
    return spark.read.schema(df.schema).parquet(path)


class Memory(dict):
    """Bytes by key, made by ``make`` for all unknown keys of a batch together; remembers the last used.

    Looking up an unknown key gives an empty place, filled by ``settle``. When more than ``size`` keys are held, all
    become old; an old key that is asked for becomes young again. It bounds memory, not results.
    """

    def __init__(self, size: int, make):
        self.size, self.make, self.old, self.unknown = size, make, {}, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.unknown[key] = bytearray()
        self[key] = value
        return value

    def settle(self) -> None:
        keys = list(self.unknown)
        for key, value in zip(keys, self.make(keys), strict=True):
            self.unknown[key][:] = value
            self[key] = value
        self.unknown = {}
        if len(self) > self.size:
            self.old = dict(self)
            self.clear()
