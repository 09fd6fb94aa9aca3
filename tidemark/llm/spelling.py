"""Spelling variants: words one edit apart, found by PartEnum signatures of their letter multisets.

A word's letters, each with its number among equal ones, are a set, that is, a binary vector. One edit changes at most
two places of it (one place where it inserts or deletes). The places are dealt to ``parts`` by hash; sets that differ in
at most k places agree on all parts but k, so each choice of ``parts - k`` parts is one signature, and near words share
one at least. Signatures also hold the length and one half of the word: one edit leaves a half unchanged, so this too
loses nothing. Words are joined on equal signatures; the edit distance is tested inside the join, so only near pairs
leave it.

Defined cases: a null or empty text has no words; a null ``doc_id`` is read as an empty one; repeated rows count again;
of forms with equal counts the least word in code-point order is taken; other columns are ignored; an empty table
gives an empty result. The words of one text are one array, so a task holds those of its longest text.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import temporary, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RUN = "[A-Za-zÀ-ÿ]+"
#: One of so many runs loses a letter.
EVERY = 31
#: A form is so many times as frequent as the word.
FACTOR = 10
#: Parts for words of one length (two places may differ) and of lengths that differ by one (one place).
PARTS_SAME, PARTS_OTHER = 4, 3


def words(docs: DataFrame, least_chars: int = 7, least_n: int = 2) -> DataFrame:
    """word, n: the distinct words of all texts, after the deletions by hash."""
    d = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.translate(F.col("text").cast("string"), UPPER, LOWER).alias("text"))
    runs = d.select("id", F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run")).where(F.length("run") >= least_chars)
    hashed = runs.select("run", F.crc32(F.encode(F.concat("id", F.lit(":"), "run"), "UTF-8")).alias("h"))
    at = F.pmod("h", F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("h") % EVERY == 0, shorter).otherwise(F.col("run"))
    return hashed.groupBy(word.alias("word")).agg(F.count(F.lit(1)).alias("n")).where((F.length("word") >= least_chars) & (F.col("n") >= least_n))


def _choices(places: Column, parts: int, differ: int) -> list[Column]:
    """One hash for each choice of ``parts - differ`` parts of the places."""
    part = lambda p: lambda x: F.pmod(x, F.lit(parts)) == p
    own = [F.aggregate(F.filter(places, part(p)), F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(x)) for p in range(parts)]
    return [F.xxhash64(F.lit(k), *[own[p] for p in chosen]) for k, chosen in enumerate(combinations(range(parts), parts - differ))]


def signatures(w: DataFrame) -> tuple[DataFrame, DataFrame]:
    """sig, same, word, n of the two sides of the join: words as they are, and words from which a letter may go."""
    letters = F.array_sort(F.split("word", ""))
    places = F.transform("letters", lambda c, i: F.xxhash64(c, (i + 2 - F.array_position(F.col("letters"), c)).cast("int")))
    d = w.withColumn("letters", letters).withColumn("places", places).withColumn("len", F.length("word"))
    both = d.select("word", "n", "len", F.array(*_choices(F.col("places"), PARTS_SAME, 2)).alias("two"), F.array(*_choices(F.col("places"), PARTS_OTHER, 1)).alias("one"))

    def keyed(chosen: str, length: Column, gap: int, same: bool) -> Column:
        """Signatures with each half of a word of ``length``; ``gap`` letters in the middle go to neither."""
        half = F.floor(length / 2).cast("int")
        halves = F.array(F.concat(F.lit("<"), F.substring("word", F.lit(1), half)), F.concat(F.lit(">"), F.substring("word", half + 1 + gap, F.length("word"))))
        return F.flatten(F.transform(halves, lambda h: F.transform(chosen, lambda s: F.struct(F.xxhash64(F.lit(same), length, h, s).alias("sig"), F.lit(same).alias("same")))))

    n = F.col("len")
    two = keyed("two", n, 0, True)
    side = lambda one: both.select("word", "n", F.inline(F.concat(two, one)))
    return side(keyed("one", n, 0, False)), side(keyed("one", n - 1, 1, False))


def near_pairs(w: DataFrame) -> DataFrame:
    """word, near, near_n: every ordered pair of words exactly one edit apart, once."""
    short, long = signatures(w)
    a = short.select("sig", "same", F.col("word").alias("a"), F.col("n").alias("an"))
    b = long.select("sig", F.col("same").alias("b_same"), F.col("word").alias("b"), F.col("n").alias("bn"))
    apart = F.when(F.col("same"), F.col("a") < F.col("b")).otherwise(F.length("a") < F.length("b"))
    hit = a.join(b, (a.sig == b.sig) & (F.col("same") == F.col("b_same")) & apart & (F.levenshtein("a", "b", 1) == 1))
    ends = F.inline(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("bn").alias("near_n")), F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("an").alias("near_n"))))
    return hit.select("a", "an", "b", "bn").distinct().select(ends)


def roots(forms: DataFrame) -> DataFrame:
    """word, root from word, form: the ends of the chains, by jumping. Counts grow tenfold at each step, so a chain is short."""
    at = written(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")))
    while at.where("moved").limit(1).count():
        on = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        at = written(at.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
    return at.select("word", "root")


def variants(w: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of the words (word, n)."""
    spark = w.sparkSession
    with temporary(spark):
        w = written(w)
        best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
        near = near_pairs(w).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
        found = w.join(near, "word", "left")
        enough = -F.col("best.less") >= FACTOR * F.col("n")
        d = written(found.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n")))
        ends = roots(d.where("form is not null"))
        return written(d.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"), outer=True)


def op13_spelling(docs: DataFrame) -> DataFrame:
    """The contract's columns."""
    return variants(words(docs))
