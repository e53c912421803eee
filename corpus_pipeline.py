"""Corpus pipeline: quality filter, exact dedup, near dedup, substring dedup, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the
next one's ``docs``. All but the last return the columns of ``docs``. Every stage works on all rows that its
predecessor kept, and its decisions take effect:

1. quality: documents that the classifier rejects (score below 0.7; labels of the given table) go;
2. exact_dedup: of equal texts (white space runs as one space) the row with the smallest doc_id stays;
3. near_dedup: of documents linked by 5-word shingle sets of Jaccard similarity 0.8 or more the smallest id stays;
4. substring_dedup: words covered by a window of 50 words that also starts in a document with a smaller doc_id
   go; a document that loses words gets the kept words joined by one space, others keep their text as it is, and
   a document without any word left goes;
5. packing: the texts' token pieces with their places in sequences of 4096.

Stages decide by row: a row is known by its doc_id (null equals null) and a 128-bit hash of its text.

Defined cases: null texts count as empty; empty tables pass through; rows that repeat doc_id and text are one
document for stage 2, and of rows that repeat an id with texts equal but for white space the one with the smallest hash stays;
rows of one id that are near copies of each other all stay; a null doc_id takes part in every stage as an id larger
than any, so near copies that all have none stay too. Very long texts pass whole. Further
columns may have any names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import shared_path, stored, table
from tidemark.llm.exact_dedup import exact_dedup
from tidemark.llm.jaccard_join import jaccard_components
from tidemark.llm.packing import pack, pieces
from tidemark.llm.quality import quality_scores
from tidemark.llm.substring_dedup import substring_dedup

# SQL cannot express the classifier and the tokenizer; tests hold the stages against brute force
ORACLE_SQL = None


def _hash() -> Column:
    return F.unhex(F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))))


def _rows(docs: DataFrame) -> DataFrame:
    """doc_id, text and ``_row``, the hash that knows a row beside its id."""
    return docs.select("doc_id", "text", _hash().alias("_row"))


def _those(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """Rows of ``docs`` by whether ``keys`` (doc_id, and _row if given) has them, null equal to null. Only keys are written
    and joined; Spark reads their size off the files and sends them to the tasks when they are below its broadcast
    threshold, so the texts are not shuffled, and joins by a shuffle beyond it."""
    fresh = "_" * (1 + max(map(len, docs.columns)))  # longer than any name of the input
    keys = stored(keys.toDF(*[fresh + c for c in keys.columns]), "keys")
    on = F.col("doc_id").eqNullSafe(F.col(fresh + "doc_id"))
    return docs.join(keys, on & (_hash() == F.col(fresh + "_row")) if len(keys.columns) > 1 else on, how)


def _keep(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """``docs`` less the rows that ``decided`` (doc_id, _row, keep; stored) does not keep. An id of which no row is kept is
    known by itself, which is shorter; hashes are only for rows of ids of which others stay."""
    ids = stored(decided.groupBy("doc_id").agg(F.bool_or("keep").alias("some"), F.bool_and("keep").alias("every")).where("not every"), "ids")
    left = _those(docs, ids.where("not some").select("doc_id"), "left_anti")
    mixed = ids.where("some").select(F.col("doc_id").alias("_mixed"))
    rows = decided.where("not keep").join(mixed, F.col("doc_id").eqNullSafe(F.col("_mixed")), "left_semi")
    return _those(left, rows.select("doc_id", "_row").distinct(), "left_anti")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = quality_scores(_rows(docs), table(spark, sf_dir, "labels"), carry=["_row"])
    return _keep(docs, stored(scored.select("doc_id", "_row", (F.col("predicted") == 1).alias("keep")), "decided"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    copies = stored(exact_dedup(_rows(docs), carry=["_row"]).select("doc_id", "_row", "kept", F.unhex("text_sha256").alias("group")), "copies")
    # rows that share the smallest id of their group: one of them stays
    several = copies.where("kept").groupBy("group").agg(F.min("_row").alias("first"), F.count(F.lit(1)).alias("rows")).where("rows > 1")
    several = stored(several.select("group", "first"), "several")
    decided = stored(copies.join(several, "group", "left").select("doc_id", "_row", "first", "kept", (F.col("kept") & F.col("first").isNull()).alias("keep")), "decided")
    fresh = "_" * (1 + max(map(len, docs.columns)))
    first = decided.where("kept and _row = first").select("doc_id", "_row").distinct()
    once = _those(docs, first, "left_semi").withColumn(fresh, _hash()).dropDuplicates(["doc_id", fresh])
    return _keep(docs, decided).unionByName(once.drop(fresh))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = jaccard_components(_rows(docs), carry=["_row"])
    return _keep(docs, stored(found.select("doc_id", "_row", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("keep")), "decided"))


def substring(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    own = [c for c in docs.columns if c != "doc_id"]
    out = substring_dedup(docs, k=50, carry=own)
    lost = F.col("n_removed") > 0
    out = out.where(~lost | (F.col("n_removed") < F.col("n_words")))
    out = out.withColumn("text", F.when(lost, F.col("kept")).otherwise(F.col("text")))
    if "n_chars" in own:
        out = out.withColumn("n_chars", F.when(lost, F.length("kept").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(stored(pieces(docs, public_tokenizers.path("word_bpe_49k.json")), "pieces"))


STAGES = [("quality", quality), ("exact_dedup", exact), ("near_dedup", near), ("substring_dedup", substring),
          ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
