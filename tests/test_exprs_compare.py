"""Scalar helpers (B, H) and comparison operators (L)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import exprs as X
from tidemark.operators.compare import SchemaMismatch, frames_equal, rounded_equal, sorted_diff


def test_dates():
    assert X.parse_date("1993-7-01") == dt.date(1993, 7, 1)
    assert X.add_months("1993-07-01", 3) == dt.date(1993, 10, 1)
    assert X.add_months("2020-01-31", 1) == dt.date(2020, 2, 29)
    assert X.add_days("1998-12-01", -90) == dt.date(1998, 9, 2)
    with pytest.raises(ValueError):
        X.parse_date("July 1")


def test_words_filter_project_length(spark):
    df = spark.createDataFrame([("hello", "my"), ("world", "name")], "col1 string, col2 string")
    assert df.where(F.col("col2") == "my").count() == 1
    assert [r.n for r in df.select(X.byte_length("col2").alias("n")).collect()] == [2, 4]
    assert df.select(X.byte_length(F.lit("é")).alias("n")).first().n == 2


def test_map_chain_ten_hops(spark):
    df = spark.createDataFrame([("mykey", "")], "key string, value string")
    for _ in range(10):
        df = df.transform(lambda d: d.withColumn("value", F.concat("value", F.lit("X"))))
    assert df.first().value == "X" * 10


def test_typed_parse_and_flags(spark):
    df = spark.createDataFrame([("12",), ("",), ("PROMO BRUSHED",)], "s string")
    r = df.select(X.parse_typed(F.when(F.col("s").rlike("^[0-9]*$"), F.col("s")), "int").alias("i"),
                  X.try_parse_typed("s", "int").alias("j"), X.starts_with_flag("s", "PROMO").alias("p")).collect()
    assert [x.i for x in r] == [12, None, None] and [x.j for x in r] == [12, None, None]
    assert [x.p for x in r] == [0, 0, 1]
    with pytest.raises(Exception):
        df.select(X.parse_typed("s", "int")).collect()


def test_rounding_and_division(spark):
    r = spark.createDataFrame([(2.675, 1.0, 0.0)], "a double, b double, z double").select(
        X.rnd("a", 2).alias("r"), X.safe_div("b", "z").alias("d")).first()
    assert r.r == 2.68 and r.d is None


def test_frames_equal(spark):
    a = spark.createDataFrame([(1, "x", 1.0), (2, "y", 2.0)], "k int, s string, v double")
    b = spark.createDataFrame([(1, "x", 1.0004), (2, "y", 2.5)], "k int, s string, v double")
    r = frames_equal(a, b, ["k"]).first()
    assert (r.rows_a, r.rows_b, r.mismatched_rows) == (2, 2, 1)
    # a smaller value is not accepted just for being smaller
    c = spark.createDataFrame([(1, "x", -5.0), (2, "y", 2.0)], "k int, s string, v double")
    assert frames_equal(a, c, ["k"]).first().mismatched_rows == 1
    with pytest.raises(SchemaMismatch):
        frames_equal(a, a.select("k", "s"), ["k"])


def test_rounded_and_sorted_diff(spark):
    a = spark.createDataFrame([(1, 0.123441), (2, None)], "k int, v double")
    b = spark.createDataFrame([(2, None), (1, 0.12344)], "k int, v double")
    r = rounded_equal(a, b, 4).first()
    assert (r.only_a, r.only_b) == (0, 0)
    srt = spark.createDataFrame([(3,), (2,), (1,)], "k int").coalesce(1)
    d = sorted_diff(srt, spark.createDataFrame([(1,), (2,), (3,)], "k int"), ["k"], [True]).first()
    assert (d.only_actual, d.only_expected, d.in_order) == (0, 0, True)


def test_parse_date_column_and_hash(spark):
    df = spark.createDataFrame([("1993-7-01",), ("1994-01-01",), ("bad",)], "s string")
    got = [r.d for r in df.select(X.parse_date_col("s").alias("d")).collect()]
    assert got == [dt.date(1993, 7, 1), dt.date(1994, 1, 1), None]
    h = spark.createDataFrame([(1, 2.5), (1, 2.5), (2, 2.5)], "a int, b double").select(X.row_hash("a", "b").alias("h"))
    hs = [r.h for r in h.collect()]
    assert hs[0] == hs[1] != hs[2]
