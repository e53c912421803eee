"""Relational helpers: aggregates, joins, positions, key checks."""

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.operators import relational as R


def test_agg_spec_and_sum_all(spark):
    df = spark.createDataFrame([("a", 20, 0.2), ("a", 10, 0.1), ("b", 7, 0.3), ("c", 9, 0.1), ("b", 1, 0.01)],
                               "date string, temp int, rain double")
    r = {x.date: x for x in R.agg_spec(df, ["date"], {"temp": ["sum", "count"], "rain": ["max"]}).collect()}
    assert (r["a"].temp_sum, r["a"].temp_count, r["b"].rain_max) == (30, 2, 0.3)
    g = R.sum_all(df).first()
    assert g.temp == 47 and round(g.rain, 2) == 0.71
    assert set(R.sum_all(df, ["date"]).columns) == {"date", "temp_sum", "rain_sum"}
    assert R.agg_spec(df, [], {"temp": ["sum"]}).first().temp_sum == 47


def test_last_per_group_and_avg_pair(spark):
    df = spark.createDataFrame([("a", 1, 20), ("a", 2, 10), ("b", 1, 7), ("b", 3, 1), ("c", 1, 9)],
                               "k string, o int, v int")
    assert {r.k: r.v for r in R.last_per_group(df, ["k"], ["v"], "o").collect()} == {"a": 10, "b": 1, "c": 9}
    cells = spark.createDataFrame([(x,) for x in [1, 2, None, 3, 4, None, 5, 6, None, 7, 8, None, 9]], "x int")
    r = cells.agg(R.avg_pair("x").alias("p"), F.count("x").alias("n")).first()
    assert (r.p["sum"], r.p["count"], r.n) == (45, 9, 9)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 100)), min_size=1, max_size=60),
       st.integers(1, 7))
def test_two_phase_equals_one_phase(spark, rows, chunks):
    df = spark.createDataFrame(rows, "k string, v long").withColumn("i", F.monotonically_increasing_id())
    two = R.two_phase_agg(df, F.col("i") % chunks, ["k"], {"s": F.sum("v")}, {"n": F.col("v")}, {"m": F.col("v")})
    one = df.groupBy("k").agg(F.sum("v").alias("s"), F.count("v").alias("n"), F.avg("v").alias("m"))
    a = sorted((r.k, r.s, r.n, round(r.m, 9)) for r in two.collect())
    b = sorted((r.k, r.s, r.n, round(r.m, 9)) for r in one.collect())
    assert a == b


def test_self_join_three_keys(spark):
    rows = [(i // 4, i % 4 + 1, i * 7) for i in range(100)]
    t = spark.createDataFrame(rows + rows, "ok long, ln int, pk long")
    a, b = t.alias("a"), t.alias("b")
    j = a.join(b, (F.col("a.ok") == F.col("b.ok")) & (F.col("a.ln") == F.col("b.ln")) & (F.col("a.pk") == F.col("b.pk")))
    assert j.count() == 400


def test_with_position_and_hconcat(spark):
    left = spark.createDataFrame([(k, f"c{k}") for k in [5, 1, 9, 3]], "k int, name string")
    right = spark.createDataFrame([(k,) for k in [30, 10, 20]], "r int")
    pos = R.with_position(left.repartition(3), ["k"])
    assert sorted((r.pos, r.k) for r in pos.collect()) == [(1, 1), (2, 3), (3, 5), (4, 9)]
    h = sorted(R.hconcat(left, right, ["k"], ["r"]).collect(), key=lambda r: r.k)
    assert [(r.k, r.r) for r in h] == [(1, 10), (3, 20), (5, 30), (9, None)]


def test_key_checks(spark):
    parent = spark.createDataFrame([(1, 1), (2, 1)], "a int, b int")
    child = spark.createDataFrame([(1, 1), (2, 2), (None, 1), (3, 1)], "x int, y int")
    assert R.primary_key_violations(spark.createDataFrame([(1,), (1,), (2,)], "a int"), ["a"]).first().n == 2
    assert R.foreign_key_orphans(child, ["x"], parent, ["a"], "single").first().orphans == 1
    assert R.foreign_key_orphans(child, ["x", "y"], parent, ["a", "b"], "pair").first().orphans == 2


def test_foreign_key_report_many_keys(spark):
    """Odd rows against counting by hand; child rows are not multiplied by their keys, and values keep their types."""
    parent = spark.createDataFrame([(1, 1, 0.0), (2, 1, 1.5), (2, 1, 1.5), (None, 1, None)], "a long, b int, d double")
    child = spark.createDataFrame([(1, 1, -0.0), (2, 2, 1.5), (None, 1, None), (3, 1, 2.5), *[(9, 9, 1.5)] * 50], "x int, y int, z double")
    text = spark.createDataFrame([("1",), ("2",), ("one",), (None,)], "t string")
    report = R.foreign_key_report([
        ("single", child, ["x"], parent, ["a"]), ("pair", child, ["x", "y"], parent, ["a", "b"]), ("decimal", child, ["z"], parent, ["d"]),
        ("part", child, ["x"], parent.where("a = 1"), ["a"]), ("text", text, ["t"], parent, ["a"]),
        ("itself", child, ["y"], child, ["x"]), ("none", child.where("false"), ["x"], parent, ["a"]),
        ("no parent", child, ["x"], parent.where("false"), ["a"])])
    assert report.dtypes == [("fk", "string"), ("orphans", "bigint")]
    assert sorted(map(tuple, report.collect())) == sorted([
        ("single", 51), ("pair", 52), ("decimal", 1), ("part", 52), ("text", 1), ("itself", 0), ("none", 0), ("no parent", 53)])
    assert "Generate" not in report._jdf.queryExecution().optimizedPlan().toString()


def test_union_all(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([("y", 2)], "v string, k int")
    assert sorted(R.union_all([a, b, a]).collect()) == sorted([(1, "x"), (2, "y"), (1, "x")])
