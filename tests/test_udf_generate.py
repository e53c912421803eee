"""UDF surface (B17/B18/C18/K1/K3-K5), generators (A17/A18) and the
forecast-to-completion intent (M45) on a generated running sum."""

import pandas as pd
from pyspark.sql import functions as F

from tidemark.operators import forecast as fc
from tidemark.operators import udf as U
from tidemark.sources.generate import groupby_table, running_sum_series


def test_chain_identity_ignore_map_drop(spark):
    df = spark.createDataFrame([("mykey", "")], "key string, value string")
    hop = lambda d: d.withColumn("value", F.concat("value", F.lit("X")))
    assert U.chain(df, *[hop] * 10).first().value == "X" * 10
    assert U.identity(df).count() == 1 and U.ignore(df).count() == 0 and U.ignore(df).columns == df.columns
    nums = spark.createDataFrame([(1,), (2,), (3,)], "x int")
    kept = U.map_drop(nums, "half", F.when(F.col("x") % 2 == 0, F.col("x") / 2))
    assert [r.half for r in kept.collect()] == [1.0]


def test_map_optional_and_batches(spark):
    nums = spark.createDataFrame([(i,) for i in range(10)], "x long")
    out = U.map_optional(nums, "sq", lambda s: (s * s).where(s % 3 == 0), "double", "x")
    assert sorted(r.sq for r in out.collect()) == [0.0, 9.0, 36.0, 81.0]

    def split(pdf):
        yield pdf.assign(part="lo")[pdf.x < 5]
        yield pdf.assign(part="hi")[pdf.x >= 5]
    fm = U.flat_map_batches(nums, split, "x long, part string")
    assert fm.count() == 10 and fm.where("part = 'hi'").count() == 5

    def chunk_sum(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"n": [len(pdf)], "s": [int(pdf.x.sum())]})
    per = U.apply_per_chunk(nums, F.col("x") % 3, chunk_sum, "n long, s long")
    assert sum(r.s for r in per.collect()) == 45 and per.count() == 3


def test_temp_view(spark):
    df = spark.createDataFrame([(1,), (2,)], "x int")
    with U.temp_view(spark, "tm_view_test", df) as v:
        assert spark.sql(f"SELECT sum(x) AS s FROM {v}").first().s == 3
    assert not spark.catalog.tableExists("tm_view_test")


def test_groupby_table(spark):
    t = groupby_table(spark, 10000, 100, 5, 5)
    assert t.columns == [f"key{i}" for i in range(5)] + [f"val{i}" for i in range(5)]
    assert t.groupBy(*[f"key{i}" for i in range(5)]).count().count() == 100


def test_running_sum_forecast_to_completion(spark):
    s = running_sum_series(spark, 40).collect()
    assert len(s) == 40 and all(9000 * (i + 1) <= r.rows_so_far <= 11000 * (i + 1) for i, r in enumerate(s))
    df = running_sum_series(spark, 40).withColumn("k", F.lit("all"))
    f = fc.forecast_select(df.where(F.col("t") <= 20), ["k"], "t", "sum_so_far", 40.0)
    pred = f.orderBy(F.col("t").desc()).first().forecast
    final = s[-1].sum_so_far
    assert abs(pred - final) / final < 0.05


def test_runs_table_function(spark):
    """K4: runs over a partitioned table argument, also with nulls, in SQL and with columns it cannot find."""
    import pytest
    from tidemark.operators.udf import udtf_runs
    rows = [(1, 1, "a"), (1, 2, "a"), (1, 3, "b"), (1, 4, "a"), (2, 1, None), (2, 2, None), (None, 1, "z")]
    df = spark.createDataFrame(rows, "k int, i int, v string").repartition(3)
    spark.udtf.register("runs_of", udtf_runs())
    df.createOrReplaceTempView("runs_input")
    got = spark.sql("SELECT * FROM runs_of(TABLE(runs_input) PARTITION BY (k) ORDER BY (i), 'k', 'v', 'i')")
    assert got.columns == ["k", "v", "first_place", "last_place", "n"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [
        (1, "a", 1, 2, 2), (1, "b", 3, 3, 1), (1, "a", 4, 4, 1), (2, None, 1, 2, 2), (None, "z", 1, 1, 1)]))
    with pytest.raises(Exception, match="not in the table"):
        spark.sql("SELECT * FROM runs_of(TABLE(runs_input) PARTITION BY (k), 'k', 'w', 'i')").collect()
