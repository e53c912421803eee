"""Connected components of a link table by alternating large and small stars.

Each round joins every node to its smallest neighbour (large star: the larger neighbours; small star: the
smaller ones) until nothing changes; about the logarithm of the longest path in rounds. Links are rows,
minima are partial aggregates, and each round is written to the shared folder, so nothing is gathered and
a lost executor costs one round at most. Joins use a form of the key that the aggregate is not partitioned
by, so that AQE may split the rows of a node with very many links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import let_go, stored


def by_key(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join on ``key`` through its struct form: both sides get an exchange of their own that AQE can split."""
    r = right.withColumnRenamed(key, "_k")
    return left.join(r, F.struct(F.col(key)) == F.struct(F.col("_k")), how).drop("_k")


def components(links: DataFrame) -> DataFrame:
    """``links``: columns a, b of one orderable type. Gives (id, root): every linked id with the smallest id
    it reaches; ids without a link to another are absent."""
    now = stored(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                 .distinct(), "links")
    let_go(links.sparkSession)  # of what made the links; the rounds are small beside it
    sign, before = _signature(now), None
    while sign != before:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = by_key(both.where("v > u"), least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        root = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (by_key(large, root, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(root.select("u", F.col("m").alias("v"))))
        now, before = stored(small.distinct(), "links"), sign
        sign = _signature(now)
    return now.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct())


def _signature(links: DataFrame):
    return links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def in_blocks(rows: DataFrame, block: int) -> DataFrame:
    """Rows (root, g, class, ...) of groups of ``g``, once for each pair of blocks (i <= j) that they are in."""
    rows = rows.withColumn("blocks", F.ceil(F.col("g") / block).cast("int"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return (rows.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
            .drop("g", "blocks", "other"))
