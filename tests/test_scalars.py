"""Scalar expressions on hand-made rows."""

import hashlib

from pyspark.sql import functions as F

from tidemark.functions import scalars as X

VALUES = [None, "", "-", " ", "0", "00", "7", "+7", "-3", "n/a", "12345678901234567890"]


def values(spark, column):
    d = spark.createDataFrame([(i, v) for i, v in enumerate(VALUES)], "i int, v string")
    return [r[0] for r in d.orderBy("i").select(column).collect()]


def test_non_missing(spark):
    assert values(spark, X.non_missing("v")) == [False, False, False, True, True, True, True, True, True, True, True]


def test_missing_to_dash(spark):
    assert values(spark, X.missing_to_dash("v"))[:4] == ["-", "-", "-", " "]


def test_try_bigint(spark):
    assert values(spark, X.try_bigint("v")) == [None, None, None, None, 0, 0, 7, 7, -3, None, None]


def test_ids_and_text(spark):
    d = spark.createDataFrame([("SRR1", None, "a  \n b ", "{urn}TAG", "/SAMPLE_SET/SAMPLE/X", "SAMPLE")], "a string, n string, t string, g string, p string, k string")
    r = d.select(X.stable_id("a", "n").alias("i"), X.clean_ws("t").alias("t"), X.local_name("g").alias("g"), X.relative_path("p", "k").alias("p"), X.prefix_class("a").alias("c"), X.truncated("a", 2)[0].alias("x"), X.truncated("a", 2)[1].alias("y"), X.clean_ws("n").alias("e")).first()
    assert r["i"] == hashlib.sha1(b"SRR1\x1f").hexdigest()
    assert (r["t"], r["g"], r["p"], r["c"], r["x"], r["y"], r["e"]) == ("a b", "TAG", "/X", "OTHER", "SR", True, "")


def test_kinds(spark):
    d = spark.createDataFrame([("x.run.xml", "RUN_SET"), ("x.xml", "OTHER"), ("x.run.xml", "SAMPLE_SET"), ("x.run.xml", "run_set")], "n string, r string")
    a, b = X.kind_from_filename("n"), X.kind_from_root("r")
    assert [tuple(r) for r in d.select(X.kind_consistency(a, b), X.effective_kind(a, b)).collect()] == [("consistent", "run"), ("consistent", "unknown"), ("mismatch", "sample"), ("unknown", "run")]


def test_ratio_and_json(spark):
    d = spark.createDataFrame([(1, 0), (1, 4)], "a int, b int")
    assert [r[0] for r in d.select(X.safe_ratio("a", "b")).collect()] == [None, 0.25]
    assert d.select(X.json_text(F.create_map(F.lit("b"), F.lit("1"), F.lit("a"), F.lit("2")))).first()[0] == '{"a":"2","b":"1"}'
    assert [r[0] for r in spark.createDataFrame([("NA",), ("x",), (None,)], "v string").select(X.null_normalised("v")).collect()] == [None, "x", None]
