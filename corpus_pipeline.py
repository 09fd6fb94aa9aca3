"""The corpus pipeline: quality rules, near-duplicates, repeated passages, personal data, packing.

Each stage works on all rows that its predecessor kept and, but for the last, returns the columns it got. A filtering
stage decides on the text alone; equal rows are judged alike, and of rows with one doc_id and one text the second
stage keeps one. Empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import minhash, packing, pii_crf, quality_rules, suffix_dedup
from tidemark.llm.common import table, temporary, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the rules' first version rejects."""
    return quality_rules.passing(docs, quality_rules.POLICIES["v1"])


#: Bytes of a repeated string that goes: fewer than 50 words of prose have, in the languages of the tables.
PASSAGE_BYTES = 200


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: shingles of five words, similarity of 0.8 or more."""
    return minhash.one_of_each(docs, words=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of repeated strings of ``PASSAGE_BYTES``."""
    return suffix_dedup.without_repeats(docs, PASSAGE_BYTES)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind."""
    return pii_crf.redacted(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in windows of tokens."""
    return packing.op9_packing(docs)


STAGES = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("personal_data", personal_data),
    ("packing", packed),
]

#: Suffix arrays and the fitted field aren't SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        with temporary(spark):
            docs = written(stage(spark, docs, sf_dir), outer=True)
    return STAGES[-1][1](spark, docs, sf_dir)
