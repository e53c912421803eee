"""Generated inputs for tests and micro-benchmarks.

These build on ``spark.range`` so the rows are produced in parallel by the
executors; nothing is built on the driver. (Registered queries never run on
generated input alone; these are for tests and benchmarks.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.sorting import teragen  # noqa: F401  (A16 lives with the sort it feeds)


def groupby_table(spark: SparkSession, n_rows: int, n_groups: int, n_keys: int = 5,
                  n_values: int = 5) -> DataFrame:
    """``n_rows`` rows in ``n_groups`` groups chosen by ``i % n_groups``;
    ``n_keys`` key columns (all derived from the group id, so a group is the
    same tuple in every key column) and ``n_values`` value columns."""
    g = F.col("id") % n_groups
    keys = [(g * (k + 1)).cast("bigint").alias(f"key{k}") for k in range(n_keys)]
    vals = [((F.col("id") * (v + 3)) % 1000).cast("double").alias(f"val{v}") for v in range(n_values)]
    return spark.range(n_rows).select(*keys, *vals)


def running_sum_series(spark: SparkSession, n_batches: int, seed: int = 7, lo: int = 9000,
                       hi: int = 11000) -> DataFrame:
    """Batches of ``lo``-``hi`` seeded random integers; per batch
    ``(t = batch number, rows so far, sum so far)`` -- the running answers a
    forecaster is fed."""
    sizes = spark.range(1, n_batches + 1).select(
        F.col("id").alias("batch"),
        (F.lit(lo) + F.floor(F.rand(seed) * (hi - lo + 1))).cast("long").alias("n"))
    rows = sizes.select("batch", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("j"))
    vals = rows.select("batch", F.floor(F.rand(seed + 1) * 100).cast("long").alias("x"))
    per = vals.groupBy("batch").agg(F.count(F.lit(1)).alias("rows"), F.sum("x").alias("total"))
    w = Window.orderBy("batch").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per.select(F.col("batch").cast("double").alias("t"),
                      F.sum("rows").over(w).alias("rows_so_far"),
                      F.sum("total").over(w).cast("double").alias("sum_so_far"))
