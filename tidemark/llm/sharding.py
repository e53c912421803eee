"""Sharding (operator 9): jump consistent hashing maps stable keys to shards without a ring table.

The shard of a row is a function of its key and the shard count alone, so appending a shard moves only
the rows that go to it, about one in ``shards + 1``. The walk of jumps runs on whole Arrow batches, all
keys at once, and takes about log(shards) steps. Slots number a shard's rows from 0 without gaps: each
shard is cut into buckets by the hash of id, size and checksum, so an id of very many rows fills many buckets; rows
are numbered inside (shard, bucket) and the buckets' offsets (shards x buckets rows) are added. Texts are read once:
ids, sizes, checksums and shards are written to the shared folder, and only those are shuffled.

Defined cases: a null text has size 16 and checksum 0. A null doc_id is a key of its own. Rows that repeat
a doc_id share a shard and get slots of their own; an empty table gives no rows. Further input columns are ignored; ``write_shards``
keeps them.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored, table
from tidemark.llm.registry import register

# fixed value: the multiplier of the 64-bit congruential generator in the published jump hash
JUMP_MULTIPLIER = np.uint64(2862933555777941757)
ROWS_PER_BUCKET = 100_000


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each unsigned 64-bit key, all keys walking together until none jumps inside the range."""
    at = np.zeros(len(keys), np.int64)
    state = keys.astype(np.uint64)
    live = np.arange(len(keys))
    while len(live):
        state = state * JUMP_MULTIPLIER + np.uint64(1)
        step = float(1 << 31) / ((state >> np.uint64(33)).astype(np.float64) + 1.0)
        to = np.floor((at[live] + 1) * step)
        stays = to < shards
        live, state = live[stays], state[stays]
        at[live] = to[stays].astype(np.int64)
    return at


def shard_of(key: Column, shards: int) -> Column:
    """The shard of a long column (its stable 64-bit key)."""
    if shards < 1:
        raise ValueError("at least one shard")

    @F.pandas_udf("int")
    def walk(keys: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(keys.to_numpy(np.int64).view(np.uint64), shards).astype(np.int32))

    return walk(key)


def assign_shards(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text",
                  rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row of ``docs``."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(id_col).cast("long")).alias("key"),
                       F.encode(F.coalesce(F.col(text_col).cast("string"), F.lit("")), "UTF-8").alias("raw"))
    rows = stored(rows.select("doc_id", (F.octet_length("raw") + 16).cast("long").alias("size"), F.crc32("raw").alias("text_crc32"),
                       shard_of(F.col("key"), shards).alias("shard"), shard_of(F.col("key"), shards + 1).alias("grown_shard")), "shards")
    buckets = max(1, -(-rows.count() // (shards * rows_per_bucket)))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.lit(buckets)).cast("int"))
    inside = Window.partitionBy("shard", "bucket").orderBy("doc_id", "size", "text_crc32")
    ranked = rows.withColumn("rank", F.row_number().over(inside) - 1)
    counts = rows.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return ranked.join(offsets, ["shard", "bucket"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("base") + F.col("rank")).cast("long").alias("slot"), "grown_shard")


def write_shards(docs: DataFrame, path: str, shards: int, id_col: str = "doc_id",
                 max_records_per_file: int = 1_000_000) -> None:
    """Write ``docs`` with all columns as one folder per shard (``shard_no=K``)."""
    (docs.withColumn("shard_no", shard_of(F.xxhash64(F.col(id_col).cast("long")), shards))
     .write.option("maxRecordsPerFile", max_records_per_file).partitionBy("shard_no").parquet(path))


@register("op9_jump_hash")
def op9_jump_hash(spark, sf_dir):
    return assign_shards(table(spark, sf_dir, "documents"), 40)
