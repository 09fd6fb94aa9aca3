"""Folders that appear whole or not at all: written beside their place, checked, then renamed through Hadoop's file system."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of ``path`` and its Path."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    fs.delete(p, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """A rename; an error where the file system refuses it or ``target`` is there."""
    fs, p = file_system(spark, source)
    to = file_system(spark, target)[1]
    if fs.exists(to):
        raise FileExistsError(target)
    fs.mkdirs(to.getParent())
    if not fs.rename(p, to):
        raise OSError(f"{source} can't be renamed to {target}")


def _beside(path: str, what: str) -> str:
    """A sibling of ``path``; Spark's readers leave out names that begin with an underscore."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_{what}-{name}"


def recover(spark: SparkSession, path: str) -> None:
    """Puts the former folder back where a commit was killed between its two renames."""
    former = _beside(path, "former")
    if exists(spark, former):
        if exists(spark, path):
            delete(spark, former)
        else:
            move(spark, former, path)


def commit(spark: SparkSession, staged: str, path: str) -> None:
    """Puts ``staged`` in the place of ``path``; the former folder comes back if that fails."""
    recover(spark, path)
    former = _beside(path, "former")
    had = exists(spark, path)
    if had:
        move(spark, path, former)
    try:
        move(spark, staged, path)
    except BaseException:
        if had:
            move(spark, former, path)
        raise
    if had:
        delete(spark, former)


@contextmanager
def staging(spark: SparkSession, path: str) -> Iterator[str]:
    """A folder beside ``path`` that takes its place at the end; after an error inside it goes and ``path`` stays as it was."""
    staged = _beside(path, f"staged-{uuid.uuid4().hex}")
    try:
        yield staged
        commit(spark, staged, path)
    finally:
        delete(spark, staged)
