"""Quality rules as a bitmask ledger.

``ledger`` measures every document once and stores one failure bit per rule. A policy is then only a mask over
these bits, so versions of a policy and ablations of single rules never touch the texts again.

Defined cases: a null or empty text has no words and fails ``few_words``; equal rows are judged alike and all kept
in the result; other columns of the input are ignored; an empty table gives an empty ledger.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import id_and_text, words_of

#: Rules in bit order; a rule's condition is over the measurements of ``measure``. True: the document fails.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 50"),
    ("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "100 * n_symbols > 40 * n_words"),
    ("repeated_lines", "100 * n_dup_lines > 40 * n_lines"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 20 * n_words"),
)
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    """A named version: a document is rejected if it fails any of ``rules``."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BIT[r] for r in self.rules)


POLICIES = {
    "base": Policy("base", ("few_words", "repeated_windows")),
    "v1": Policy("v1", tuple(BIT)),
}


def measure(docs: DataFrame, with_row: bool = False) -> DataFrame:
    """One row a document: doc_id and the long measurements n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words.

    ``with_row`` adds the document's own row as the struct ``__row``.
    """
    row = ["__row"] if with_row else []
    d = id_and_text(docs) if not with_row else docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    d = d.select(
        "doc_id",
        *row,
        words_of(F.col("text")).alias("words"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        lines.alias("lines"),
    )
    d = d.select(
        "doc_id",
        *row,
        "words",
        "n_symbols",
        F.size("words").alias("n"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.size("lines").cast("long").alias("n_lines"),
        F.size(F.array_distinct("lines")).cast("long").alias("n_set_lines"),
    )
    # A window's key: its hash, and in as many low bits as the text needs its position.
    starts = F.slice("words", 1, F.greatest(F.col("n") - 2, F.lit(0)))
    d = d.withColumn("low", F.call_function("shiftleft", F.lit(1).cast("long"), F.ceil(F.log2(F.col("n") + 2)).cast("int")) - F.lit(1).cast("long"))
    at = lambda i: F.get("words", i)
    keys = F.transform(starts, lambda w, i: F.xxhash64(w, at(i + 1), at(i + 2)).bitwiseAND(F.bitwise_not("low")).bitwiseOR(i.cast("long")))
    d = d.withColumn("keys", F.sort_array(keys))

    def same(x: Column, y: Column) -> Column:
        """Equal hashes, confirmed on the words."""
        p, q = (v.bitwiseAND(F.col("low")).cast("int") for v in (x, y))
        return (x.bitwiseXOR(y).bitwiseAND(F.bitwise_not("low")) == 0) & (at(p) == at(q)) & (at(p + 1) == at(q + 1)) & (at(p + 2) == at(q + 2))

    twice = F.filter("keys", lambda x, i: F.coalesce(same(x, F.get("keys", i + 1)), F.lit(False)) | F.coalesce(same(x, F.get("keys", i - 1)), F.lit(False)))
    d = d.withColumn("twice", F.sort_array(F.transform(twice, lambda x: x.bitwiseAND(F.col("low")))))
    covered = F.aggregate(
        F.transform("twice", lambda p, i: F.least(F.lit(3).cast("long"), F.coalesce(F.get("twice", i + 1) - p, F.lit(3).cast("long")))),
        F.lit(0).cast("long"),
        lambda a, b: a + b,
    )
    found = F.struct(
        F.col("n").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        "n_lines",
        (F.col("n_lines") - F.col("n_set_lines")).alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
    )
    # Conditions on the measurements stop at this generator: below it they would measure once for each mention.
    return d.select("doc_id", *row, F.explode(F.array(found)).alias("m")).select("doc_id", *row, "m.*")


def ledger(docs: DataFrame, with_row: bool = False) -> DataFrame:
    """The measurements and ``fail_bits`` (long): bit i is set if the document fails rule i of ``RULES``."""
    bits = F.lit(0).cast("long")
    for name, condition in RULES:
        bits = bits.bitwiseOR(F.when(F.expr(condition), F.lit(BIT[name])).otherwise(F.lit(0)).cast("long"))
    return measure(docs, with_row).withColumn("fail_bits", bits)


def apply_policy(entries: DataFrame, policy: Policy) -> DataFrame:
    """``entries`` with boolean ``kept``: none of the policy's bits is set."""
    return entries.withColumn("kept", F.col("fail_bits").bitwiseAND(F.lit(policy.mask).cast("long")) == 0)


def passing(docs: DataFrame, policy: Policy) -> DataFrame:
    """The rows of ``docs``, with all their columns, that ``policy`` keeps."""
    return apply_policy(ledger(docs, with_row=True), policy).where("kept").select("__row.*")


def ablation(entries: DataFrame, policy: Policy) -> DataFrame:
    """For each rule of ``policy``: documents failing it, failing it alone, and kept if the rule were dropped.

    One pass over the ledger; the result has a row a rule.
    """
    hit = F.col("fail_bits").bitwiseAND(F.lit(policy.mask).cast("long"))
    total = [F.count_if(hit == 0).alias("kept_now")]
    for r in policy.rules:
        total += [F.count_if(hit.bitwiseAND(F.lit(BIT[r]).cast("long")) != 0).alias(f"f_{r}"), F.count_if(hit == BIT[r]).alias(f"a_{r}")]
    one = entries.agg(*total)
    rows = F.array(*[F.struct(F.lit(r).alias("rule"), F.col(f"f_{r}").alias("n_failed"), F.col(f"a_{r}").alias("n_failed_alone"), (F.col("kept_now") + F.col(f"a_{r}")).alias("n_kept_without")) for r in policy.rules])
    return one.select(F.inline(rows))


def op6_quality_rules(docs: DataFrame) -> DataFrame:
    """The contract's columns, with ``fail_bits`` besides."""
    base = POLICIES["base"].mask
    d = apply_policy(ledger(docs), POLICIES["v1"])
    failed = F.col("fail_bits").bitwiseAND(F.lit(base).cast("long")) != 0
    return d.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (F.col("kept") & ~failed).alias("kept"), "fail_bits")
