"""Result comparison as Spark jobs (L1-L3).

Tables are compared without collecting them: rows are paired by position
(a distributed ranking, :func:`with_position`) or as multisets
(``exceptAll``), and the outcome is one row of counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.relational import with_position
from tidemark.operators.sorting import side_by_side, validate_sort

_NUM = (T.DoubleType, T.FloatType, T.DecimalType, T.IntegerType, T.LongType, T.ShortType)


class SchemaMismatch(AssertionError):
    pass


def _check_shape(a: DataFrame, b: DataFrame) -> None:
    """Names (and so the column count) and types are checked before any cell; numbers of any type compare."""
    if a.columns != b.columns:
        raise SchemaMismatch(f"columns differ: {a.columns} vs {b.columns}")
    for x, y in zip(a.schema.fields, b.schema.fields):
        if x.dataType != y.dataType and not (isinstance(x.dataType, _NUM) and isinstance(y.dataType, _NUM)):
            raise SchemaMismatch(f"types of {x.name} differ: {x.dataType.simpleString()} vs {y.dataType.simpleString()}")


def _total_order(df: DataFrame, order: list[str]) -> list[str]:
    """``order`` and then all further columns that have one, fractions last, so that ties pair alike in both tables."""
    rest = [f for f in df.schema.fields if f.name not in order and not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return order + [f.name for f in sorted(rest, key=lambda f: isinstance(f.dataType, (T.DoubleType, T.FloatType)))]


def frames_equal(a: DataFrame, b: DataFrame, order: list[str], tol: float = 1e-3) -> DataFrame:
    """L1: rows paired by position in ``order``; numbers equal within
    ``tol`` (``abs(a - b) <= tol``), text and others by null-safe equality.
    One row ``(rows_a, rows_b, mismatched_rows)``; an unpaired row counts
    as a mismatch. Rows that tie in ``order`` are put in the order of their
    other columns first."""
    _check_shape(a, b)
    order = _total_order(a, order)
    pa = with_position(a.withColumn("__in_a", F.lit(1)), order, "__pos")
    rb = b.toDF(*[x + "__b" for x in b.columns]).withColumn("__in_b", F.lit(1))
    pb = with_position(rb, [o + "__b" for o in order], "__pos")
    j = pa.join(pb, "__pos", "full")
    bad = F.lit(False)
    for f in a.schema.fields:
        x, y = F.col(f.name), F.col(f.name + "__b")
        if isinstance(f.dataType, _NUM):
            same = (x.isNull() & y.isNull()) | F.coalesce(F.abs(x - y) <= tol, F.lit(False))
        else:
            same = x.eqNullSafe(y)
        bad = bad | ~same
    bad = bad | F.col("__in_a").isNull() | F.col("__in_b").isNull()
    return j.agg(F.count("__in_a").alias("rows_a"), F.count("__in_b").alias("rows_b"),
                 F.sum(bad.cast("int")).alias("mismatched_rows"))


def rounded_equal(a: DataFrame, b: DataFrame, digits: int = 4) -> DataFrame:
    """L2: null-safe equality after rounding float columns to ``digits``,
    as multisets. One row ``(only_a, only_b)``."""
    _check_shape(a, b)

    def r(df):
        return df.select(*[F.round(F.col(f.name), digits).alias(f.name)
                           if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
                           for f in df.schema.fields])
    ra, rb = r(a), r(b)
    only_a = ra.exceptAll(rb).agg(F.count(F.lit(1)).alias("only_a"))
    only_b = rb.exceptAll(ra).agg(F.count(F.lit(1)).alias("only_b"))
    return side_by_side(only_a, only_b)


def sorted_diff(actual: DataFrame, expected: DataFrame, keys: list[str],
                descending: list[bool] | None = None) -> DataFrame:
    """L3: the ``diff`` of a sorted output against the expected rows: the
    same multiset, and ``actual`` stored in the stated order. One row
    ``(only_actual, only_expected, in_order)``."""
    _check_shape(actual, expected)
    only_a = actual.exceptAll(expected).agg(F.count(F.lit(1)).alias("only_actual"))
    only_e = expected.exceptAll(actual).agg(F.count(F.lit(1)).alias("only_expected"))
    v = validate_sort(actual, keys, descending=descending).select(
        (F.col("partitions_sorted") & F.col("boundaries_ordered")).alias("in_order"))
    return side_by_side(only_a, only_e, v)
