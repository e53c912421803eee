"""Findings of the first review, as tests."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators.bounds import bucket_of, online_sum_ci, t_value
from tidemark.plans.jobs import padded
from tidemark.sources.tpch import tables


def test_t_quantiles_match_published_table():
    # fixed values: two-sided 95 % points of Student's t
    for df, t in ((1, 12.7062), (2, 4.3027), (3, 3.1824), (4, 2.7764), (10, 2.2281), (30, 2.0423)):
        assert t_value(0.95, df) == pytest.approx(t, abs=5e-5)


def test_null_and_negative_units_have_buckets(spark):
    df = spark.range(1000).select(F.lit(1.0).alias("v"), F.expr("CASE WHEN id % 3 = 0 THEN NULL ELSE 500 - id END").alias("u"))
    out = online_sum_ci(df, F.col("v"), F.col("u"), 10).orderBy(F.col("step").desc()).first()
    assert (out["rows_seen"], out["estimate"]) == (1000, 1000.0)
    assert df.where(~bucket_of(F.col("u"), 10).between(0, 9)).count() == 0


def test_long_keys_keep_their_digits(spark):
    got = spark.createDataFrame([("12345678901",), ("12345678902",), ("7",)], "k string").select(padded(F.col("k"), 9)).collect()
    assert [r[0] for r in got] == ["12345678901", "12345678902", "000000007"]


def test_appended_files_are_seen(spark, tmp_path):
    src = spark.read.parquet("/root/testdata/sf0.001/region.parquet")
    for name in ("nation", "customer", "supplier", "part", "orders", "lineitem"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").limit(5).write.parquet(f"{tmp_path}/{name}.parquet")
    src.write.parquet(f"{tmp_path}/region.parquet")
    assert tables(spark, str(tmp_path))["region"].count() == 5
    src.write.mode("append").parquet(f"{tmp_path}/region.parquet")
    assert tables(spark, str(tmp_path))["region"].count() == 10


def test_online_last_follows_the_order_not_the_parts(spark):
    from tidemark.operators.online import Agg, OnlineSpec, online_agg
    df = spark.createDataFrame([(0, 100, "late"), (1, 5, "early"), (1, None, "unordered")], "p long, o long, v string")
    got = online_agg(df, "p", 2, OnlineSpec([], [Agg("v", "last", "v", order="o")])).orderBy("part_idx").collect()
    assert [r.v for r in got] == ["late", "late"]


def test_online_refuses_parts_out_of_range(spark):
    import pytest
    from tidemark.operators.online import Agg, OnlineSpec, online_agg
    spec = OnlineSpec([], [Agg("n", "count_star")])
    for bad in (2, -1, None):
        df = spark.createDataFrame([(0,), (bad,)], "p long")
        with pytest.raises(Exception, match="part outside 0..1"):
            online_agg(df, "p", 2, spec).collect()


def test_small_values_are_not_cut_to_cents(spark):
    df = spark.range(1000).select(F.lit(0.0001).alias("v"), F.col("id").alias("u"))
    out = online_sum_ci(df, F.col("v"), F.col("u"), 10, digits=4).orderBy(F.col("step").desc()).first()
    assert (out["estimate"], out["half_width"]) == (0.1, 0.0)


def test_sums_beyond_a_long(spark):
    from tidemark.operators.relational import agg_spec, sum_all
    df = spark.createDataFrame([(2 ** 62,)] * 4, "k long")
    assert int(sum_all(df).first()[0]) == 2 ** 64
    assert int(agg_spec(df, [], {"k": ["sum"]}).first()["k_sum"]) == 2 ** 64


def test_pi_has_a_point_for_each_row(spark):
    from tidemark.plans.jobs import job_pi
    r = job_pi(spark, "/root/testdata/sf0.01").first()
    assert r["samples"] == spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet").count()
    assert r["pi"] == pytest.approx(3.14159, abs=0.03)


def test_sort_check_takes_nulls_and_nan_as_spark_sorts_them(spark):
    from tidemark.operators.sorting import validate_sort
    df = spark.createDataFrame([("b", 2.0), (None, float("nan")), ("a", None), ("a", 1.0), (None, 3.0)], "k string, x double")
    for asc in (True, False):
        for part in (1, 3):
            s = df.repartition(3).orderBy("k", "x", ascending=asc) if part == 3 else df.coalesce(1).sortWithinPartitions("k", "x", ascending=asc)
            r = validate_sort(s, ["k", "x"], descending=[not asc] * 2).first()
            assert (r["rows"], r["partitions_sorted"], r["boundaries_ordered"]) == (5, True, True)
    wrong = spark.createDataFrame([("a", 1.0), (None, 1.0)], "k string, x double").coalesce(1)
    assert not validate_sort(wrong, "k").first()["partitions_sorted"]
    late = spark.createDataFrame([(float("nan"),), (1.0,)], "x double").coalesce(1)
    assert not validate_sort(late, "x").first()["partitions_sorted"]


def test_tables_of_other_types_differ_and_ties_pair(spark):
    from tidemark.operators.compare import SchemaMismatch, frames_equal
    a = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z")], "k int, v string")
    b = spark.createDataFrame([(1, "y"), (2, "z"), (1, "x")], "k long, v string")
    assert frames_equal(a, b, ["k"]).first()["mismatched_rows"] == 0
    with pytest.raises(SchemaMismatch):
        frames_equal(a, b.withColumn("k", F.col("k").cast("string")), ["k"])
