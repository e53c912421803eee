"""User function surface.

Built-in column expressions are the fast path; these wrappers are for the
cases where user code is a Python function. They all hand Spark Arrow
batches (``pandas_udf``, ``mapInPandas``, ``applyInPandas``), never single
rows.
"""

from __future__ import annotations

from contextlib import contextmanager
from functools import reduce
from typing import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult


# ---------------------------------------------------------------- B17 / B18 / K1

def chain(df: DataFrame, *fns: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Apply frame -> frame functions in order (``df.transform``);
    Catalyst fuses the chain into one plan."""
    return reduce(lambda d, f: d.transform(f), fns, df)


def identity(df: DataFrame) -> DataFrame:
    """Pass everything through."""
    return df


def ignore(df: DataFrame) -> DataFrame:
    """Drop everything (keeps the schema)."""
    return df.where(F.lit(False))


def map_drop(df: DataFrame, name: str, expr: Column) -> DataFrame:
    """Compute ``expr``; rows where it is null are dropped."""
    return df.withColumn(name, expr).where(F.col(name).isNotNull())


# ---------------------------------------------------------------- K3

def map_optional(df: DataFrame, name: str, fn: Callable[[pd.Series], pd.Series], return_type: str,
                 *cols: str) -> DataFrame:
    """K3: record -> optional record. ``fn`` maps Arrow batches of the input
    columns to a Series; null (None/NaN) means drop the record."""
    udf = F.pandas_udf(fn, return_type)
    return map_drop(df, name, udf(*[F.col(c) for c in cols]))


# ---------------------------------------------------------------- K4 / K5

def flat_map_batches(df: DataFrame, fn: Callable[[pd.DataFrame], Iterable[pd.DataFrame]],
                     schema: str) -> DataFrame:
    """K4: block -> many blocks. ``fn`` may yield any number of frames per
    input batch; runs per partition with no shuffle."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield from fn(pdf)
    return df.mapInPandas(run, schema)


def apply_per_chunk(df: DataFrame, chunk: Column, fn: Callable[[pd.DataFrame], pd.DataFrame],
                    schema: str) -> DataFrame:
    """K5: a Python function over each chunk of rows (the remote-task
    model). Chunks are groups of ``chunk``, so choose a chunk column with a
    bounded size per value (e.g. ``hash(key) % n``), never a data key that
    may hold a third of the rows."""
    return df.withColumn("__chunk", chunk).groupBy("__chunk").applyInPandas(
        lambda pdf: fn(pdf.drop(columns="__chunk")), schema)


class Runs:
    """K4 as a table function: the runs of equal values in a partitioned, ordered table argument. Call it with
    ``udtf_runs()`` on ``TABLE(...) PARTITION BY key ORDER BY ...`` and the names of key, value and place columns; it gives a row
    (key, value, first place, last place, rows) as each run ends. A partition is read row by row and never held."""

    @staticmethod
    def analyze(row: AnalyzeArgument, key: AnalyzeArgument, value: AnalyzeArgument, place: AnalyzeArgument) -> AnalyzeResult:
        if not row.isTable:
            raise ValueError("the first argument is a table")
        kind = {f.name: f.dataType for f in row.dataType.fields}
        missing = [a.value for a in (key, value, place) if a.value not in kind]
        if missing:
            raise ValueError(f"not in the table: {missing}")
        out = T.StructType([T.StructField(key.value, kind[key.value]), T.StructField(value.value, kind[value.value]),
                            T.StructField("first_place", kind[place.value]), T.StructField("last_place", kind[place.value]),
                            T.StructField("n", T.LongType())])
        return AnalyzeResult(schema=out)

    def __init__(self):
        self.run = None

    def eval(self, row, key, value, place):
        own = [row[key], row[value], row[place], row[place], 1]
        if self.run and self.run[:2] == own[:2]:
            self.run[3], self.run[4] = own[3], self.run[4] + 1
            return
        if self.run:
            yield tuple(self.run)
        self.run = own

    def terminate(self):
        if self.run:
            yield tuple(self.run)


def udtf_runs():
    """The table function :class:`Runs`."""
    return F.udtf(Runs)


# ---------------------------------------------------------------- C18

@contextmanager
def temp_view(spark: SparkSession, name: str, df: DataFrame):
    """Create a view, use it in SQL, drop it afterwards."""
    df.createOrReplaceTempView(name)
    try:
        yield name
    finally:
        spark.catalog.dropTempView(name)
