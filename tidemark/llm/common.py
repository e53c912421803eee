"""Small shared pieces of the corpus operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import checkpoint_dir

# the white space of the operators' contracts: space, tab, LF, VT, FF, CR
SPACE_CLASS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read by Spark so that any file system works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ids_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Only the id and the text (null: empty), so no further column of the input can clash, and columns the caller names."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), *(carry or []))


def one_space(text: Column) -> Column:
    """Each run of white space replaced by one space."""
    return F.regexp_replace(text, SPACE_CLASS, " ")


def shared_path(spark: SparkSession, what: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


def stored(df: DataFrame, what: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts the lineage, survives lost executors,
    and fixes rows that a second evaluation could order otherwise."""
    path = shared_path(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let_go(spark: SparkSession) -> None:
    """After a large stored job, nothing reads its shuffle files. Spark deletes them when the driver collects its garbage, which is asked
    for here, as a chain of jobs would else keep all of theirs."""
    spark.sparkContext._jvm.System.gc()
