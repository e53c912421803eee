"""Relational helpers (C, D, F rows of the inventory) on the DataFrame API."""

from __future__ import annotations

import functools
from typing import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.exprs import col

_WHOLE = ("byte", "short", "integer", "long")
_OPS = {"count": F.count, "min": F.min, "max": F.max, "mean": F.avg,
        "avg": F.avg, "first": F.first, "last": F.last}


def safe_sum(df: DataFrame, name: str) -> Column:
    """Sum of a column; whole numbers add up as decimal(38, 0), which a long would not hold at any size."""
    whole = df.schema[name].dataType.typeName() in _WHOLE
    return F.sum(F.col(name).cast("decimal(38,0)") if whole else F.col(name))


def agg_spec(df: DataFrame, keys: list[str], spec: dict[str, list[str]]) -> DataFrame:
    """D3: column x [ops] -> ``<col>_<op>``; works with or without keys."""
    exprs = [(safe_sum(df, c) if op == "sum" else _OPS[op](F.col(c))).alias(f"{c}_{op}")
             for c, ops in spec.items() for op in ops]
    return df.groupBy(*keys).agg(*exprs) if keys else df.agg(*exprs)


def sum_all(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """D1 (no keys: bare names) / D2 (keys: ``<col>_sum``) over numeric columns."""
    keys = keys or []
    num = [f.name for f in df.schema.fields if f.name not in keys
           and f.dataType.typeName() in (*_WHOLE, "double", "float", "decimal")]
    if not keys:
        return df.agg(*[safe_sum(df, c).alias(c) for c in num])
    return df.groupBy(*keys).agg(*[safe_sum(df, c).alias(f"{c}_sum") for c in num])


def last_per_group(df: DataFrame, keys: list[str], values: list[str], order_col: str) -> DataFrame:
    """Last value per group in a stated order (``max_by``; one pass,
    partial aggregation, no sort of the group)."""
    return df.groupBy(*keys).agg(*[F.max_by(v, order_col).alias(v) for v in values])


def avg_pair(c) -> Column:
    """AVG as the mergeable (sum, count) pair."""
    return F.struct(F.sum(col(c)).alias("sum"), F.count(col(c)).alias("count"))


def finish_avg(pair) -> Column:
    return F.try_divide(col(pair)["sum"].cast("double"), col(pair)["count"])


def two_phase_agg(df: DataFrame, chunk: Column, keys: list[str],
                  sums: dict[str, Column], counts: dict[str, Column] | None = None,
                  avgs: dict[str, Column] | None = None) -> DataFrame:
    """Partial aggregate per (chunk, keys), then combine per keys.

    AVG is finished from combined sums and counts (not a mean of means)."""
    counts, avgs = counts or {}, avgs or {}
    parts = [e.alias(f"{n}__s") for n, e in sums.items()]
    parts += [F.count(e).alias(f"{n}__c") for n, e in counts.items()]
    for n, e in avgs.items():
        parts += [F.sum(e).alias(f"{n}__as"), F.count(e).alias(f"{n}__ac")]
    partial = df.groupBy(chunk.alias("__chunk"), *keys).agg(*parts)
    final = [F.sum(f"{n}__s").alias(n) for n in sums]
    final += [F.sum(f"{n}__c").alias(n) for n in counts]
    final += [F.try_divide(F.sum(f"{n}__as"), F.sum(f"{n}__ac")).alias(n) for n in avgs]
    return partial.groupBy(*keys).agg(*final)


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """stack frames by column name."""
    return functools.reduce(lambda a, b: a.unionByName(b), frames)


def with_position(df: DataFrame, order: list[str], name: str = "pos") -> DataFrame:
    """1-based position of each row in a stated total order, computed without
    a global window (which would put every row in one task):

    1. range-partitioned sort, so partition i holds the i-th key range;
    2. ``monotonically_increasing_id`` keeps the partition id in the high
       bits and the row's index inside its partition in the low 33 bits;
    3. per-partition row counts (one row per partition) give each
       partition's offset.

    The numbered frame is checkpointed to the shared checkpoint folder so a
    recomputation (lost executor) cannot renumber rows."""
    from tidemark.session import checkpoint_dir
    checkpoint_dir(df.sparkSession)
    numbered = (df.orderBy(*order)
                .withColumn("__pid", F.spark_partition_id())
                .withColumn("__mid", F.monotonically_increasing_id())
                .checkpoint(eager=True))
    counts = numbered.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    w = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__pid", F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__off"))
    low_bits = F.col("__mid").bitwiseAND(F.lit((1 << 33) - 1))
    return (numbered.join(F.broadcast(offsets), "__pid")
            .withColumn(name, F.col("__off") + low_bits + 1)
            .drop("__pid", "__mid", "__off"))


def hconcat(left: DataFrame, right: DataFrame, left_order: list[str], right_order: list[str]) -> DataFrame:
    """C20: positional horizontal concat. Position = rank in a stated order
    on each side, then a full outer join on it (the shorter side pads with
    nulls)."""
    return (with_position(left, left_order, "__pos").join(with_position(right, right_order, "__pos"), "__pos", "full")
            .drop("__pos"))


def primary_key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """A10: key values that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def foreign_key_report(keys: list[tuple[str, DataFrame, list[str], DataFrame, list[str]]]) -> DataFrame:
    """A11 for many keys (name, child, its columns, parent, its columns): one row ``(fk, orphans)`` each. Of a child only a key's own
    columns are read, and its rows are counted by key value before they are joined, so a hot value is one row; keys over the same
    columns share the count. Values are compared in their own types (as text if the two sides' types differ). Null keys are not
    orphans."""
    whole = ("tinyint", "smallint", "int", "bigint")

    def report(name, child, cols, parent, parent_cols):
        here, there = dict(child.dtypes), dict(parent.dtypes)
        alike = [here[x] == there[y] or {here[x], there[y]} <= set(whole) for x, y in zip(cols, parent_cols)]
        used = child.select(*[F.col(x).alias(f"k{i}") for i, x in enumerate(cols)]).na.drop()
        used = used.groupBy(*used.columns).agg(F.count(F.lit(1)).alias("n"))
        own = parent.select(*[F.col(x).alias(f"p{i}") for i, x in enumerate(parent_cols)])
        on = [used[f"k{i}"] == own[f"p{i}"] if same else used[f"k{i}"].cast("string") == own[f"p{i}"].cast("string")
              for i, same in enumerate(alike)]
        orphans = used.join(own, on, "left_anti")
        return orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("orphans")).select(F.lit(name).alias("fk"), "orphans")

    return union_all(report(*k) for k in keys)


def foreign_key_orphans(child: DataFrame, child_cols: list[str], parent: DataFrame,
                        parent_cols: list[str], name: str) -> DataFrame:
    """One row ``(fk, orphans)`` counting child rows whose (possibly
    composite) key has no parent; null keys are not orphans (SQL rule)."""
    cond = functools.reduce(lambda a, b: a & b,
                            [child[c] == parent[p] for c, p in zip(child_cols, parent_cols)])
    nonnull = functools.reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in child_cols])
    orphans = child.where(nonnull).join(parent, cond, "left_anti")
    return orphans.agg(F.count(F.lit(1)).alias("orphans")).select(F.lit(name).alias("fk"), "orphans")
