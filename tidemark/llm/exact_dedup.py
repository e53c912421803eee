"""Exact dedup (operator 10), native: a 128-bit content hash finds the groups, bytes settle them.

Texts are equal when identical after replacing each run of white space by one space. The whole
normalised text is a grouping key beside its 128-bit hash, so two texts with one hash are told apart
by their bytes; the partial aggregate keeps one copy of a text per task, so a group with a third of
all rows shuffles as one row per task. Documents then take their group by the pair of the 128-bit
hash and the text's SHA-256, a join on two fixed-size keys that AQE splits when one is hot (their struct
form gives the join exchanges of its own, which AQE may split, unlike the aggregate's). If two different texts ever agreed in both hashes, the query stops with an error instead of joining them.

Defined cases: a null text counts as empty, and all empty texts are one group. Every input row gives
one row; rows that repeat a doc_id each count in ``group_size``, and all rows with the group's
smallest id have ``kept``. A null doc_id is never the smallest unless its group has no other; then
``keep_id`` is null and the rows are kept. Texts of any length are compared whole; an empty table gives
no rows. Further input columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ids_and_text, one_space, table
from tidemark.llm.registry import register


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs``, then the columns of ``carry``."""
    carry = carry or []
    norm = ids_and_text(docs, id_col, text_col, carry).select("doc_id", one_space(F.col("text")).alias("norm"), *carry)
    hashed = norm.withColumn("h", F.unhex(F.md5("norm")))
    texts = hashed.groupBy("h", "norm").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
    groups = (texts.select("h", F.sha2("norm", 256).alias("sha"), "keep_id", "n")
              .groupBy("h", "sha").agg(F.min("keep_id").alias("keep_id"), F.sum("n").alias("group_size"),
                                       F.count(F.lit(1)).alias("texts"))
              .withColumn("group_size", F.when(F.col("texts") == 1, F.col("group_size")).otherwise(
                  F.raise_error(F.lit("two different texts share MD5 and SHA-256")).cast("long")))
              .drop("texts"))
    rows = hashed.select("doc_id", "h", F.sha2("norm", 256).alias("sha"), *carry)
    groups = groups.select(F.struct("h", "sha").alias("k"), "keep_id", "group_size")
    return rows.join(groups, F.struct(F.col("h"), F.col("sha")) == F.col("k")).select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("sha").alias("text_sha256"), *carry)


@register("op10_exact_dedup", r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id,
       CAST(count(*) OVER (PARTITION BY norm) AS BIGINT) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256
FROM n""")
def op10_exact_dedup(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents"))
