"""The reference's Spark jobs, run over the given tables.

* ``job_sort_cap``  (E3): text columns cast to int, filter, two-key sort.
* ``job_terasort`` (A16, E4, E5): 10-byte keys derived from every lineitem
  row, total-order sort, validation (per-partition order, boundaries,
  checksum before = after).
* ``job_pi``        (D19): Monte-Carlo estimate of pi from points derived
  by hashing every lineitem row (work grows with the table).
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.operators.sorting import checksum, tera_records as tera_rows, total_sort, validate_sorted_files
from tidemark.plans.registry import register
from tidemark.session import checkpoint_dir
from tidemark.sources.tpch import tables

c = F.col

# Year cap of the filter job, moved from 2023 to the data's range.
YEAR_CAP = 1999


def padded(text, width: int):
    """Zeros in front up to ``width``; longer text stays whole."""
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


@register("job_sort_cap", f"""
SELECT CAST(CAST(extract(year FROM o_orderdate) AS VARCHAR) AS INTEGER) AS Year,
       'SN' || CASE WHEN length(CAST(o_orderkey AS VARCHAR)) < 9 THEN lpad(CAST(o_orderkey AS VARCHAR), 9, '0') ELSE CAST(o_orderkey AS VARCHAR) END AS SerialNumber
FROM orders WHERE extract(year FROM o_orderdate) <= {YEAR_CAP}
ORDER BY Year DESC, SerialNumber
""", prelude=False)
def job_sort_cap(spark, sf_dir):
    """Rows arrive as text (as from a header CSV read without a schema),
    ``Year`` is cast with ``try_cast`` so a bad year is null, not an error."""
    o = tables(spark, sf_dir)["orders"]
    text = o.select(F.year("o_orderdate").cast("string").alias("Year"),
                    F.concat(F.lit("SN"), padded(c("o_orderkey").cast("string"), 9)).alias("SerialNumber"))
    typed = text.withColumn("Year", c("Year").try_cast("int"))
    return typed.where(c("Year") <= YEAR_CAP).orderBy(c("Year").desc(), c("SerialNumber").asc())


def _tera_key_sql():
    return ("substr(md5(CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR) || '|' || "
            "CAST(l_partkey AS VARCHAR) || '|' || CAST(l_suppkey AS VARCHAR)), 1, 20)")


def tera_records(spark, sf_dir):
    li = tables(spark, sf_dir)["lineitem"]
    # a 10-byte key (20 hex digits) from a hash of the row's identifying columns
    key = F.substring(F.md5(F.concat_ws("|", *[c(x).cast("string") for x in
                                             ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])), 1, 20)
    return li.select(key.alias("key"), c("l_orderkey").alias("rowid"),
                     F.concat_ws("|", "l_returnflag", "l_linestatus", c("l_quantity").cast("string")).alias("payload"))


@register("job_terasort", f"""
SELECT count(*) AS rows, min(k) AS min_key, max(k) AS max_key, true AS partitions_sorted,
       true AS boundaries_ordered, true AS checksum_match
FROM (SELECT {_tera_key_sql()} AS k FROM lineitem) q
""", prelude=False)
def job_terasort(spark, sf_dir, n_parts: int | None = None):
    """Generate (records from lineitem), sort, validate -- as the reference
    chains TeraGen, TeraSort and TeraValidate: the sorted output is written
    once to the shared folder and validated by reading those files once."""
    cols = ["key", "rowid", "payload"]
    recs = tera_records(spark, sf_dir)
    out = f"{checkpoint_dir(spark).rstrip('/')}/terasort/{uuid.uuid4().hex}"
    total_sort(recs, ["key"], n_parts).write.mode("overwrite").parquet(out)
    v = validate_sorted_files(spark, out, "key", cols)
    cs_in = checksum(recs, cols).select("checksum").scalar()
    j = v.withColumn("cs_in", cs_in)
    return j.select(c("rows").cast("bigint").alias("rows"), "min_key", "max_key", "partitions_sorted",
                    "boundaries_ordered", (c("checksum") == c("cs_in")).alias("checksum_match"))


@register("job_teragen", """
SELECT count(*) AS records, CAST(100 * count(*) AS BIGINT) AS octets, CAST(100 AS BIGINT) AS shortest, CAST(100 AS BIGINT) AS longest,
       count(DISTINCT l_orderkey * 8 + l_linenumber) AS ids, CAST(max(l_orderkey * 8 + l_linenumber) AS BIGINT) AS last_id FROM lineitem
""", prelude=False)
def job_teragen(spark, sf_dir):
    """A record of 100 bytes for each line; its id is made of the order key and the line's number."""
    li = tables(spark, sf_dir)["lineitem"]
    recs = tera_rows(li.select((c("l_orderkey") * 8 + c("l_linenumber")).alias("id")))
    size = F.octet_length(F.concat("key", "rowid", "filler")).cast("bigint")
    return recs.agg(F.count(F.lit(1)).alias("records"), F.sum(size).alias("octets"), F.min(size).alias("shortest"), F.max(size).alias("longest"),
                    F.count_distinct("rowid").alias("ids"), F.conv(F.max("rowid"), 16, 10).cast("bigint").alias("last_id"))


HEX = 12  # hex digits of the row's hash that make one coordinate
CELLS = float(16 ** HEX)


def _coord_sql(first: int) -> str:
    return f"CAST(CAST('0x' || substr(h, {first}, {HEX}) AS BIGINT) AS DOUBLE) / {CELLS!r}"


@register("job_pi", f"""
SELECT CAST(round(4.0 * sum(CASE WHEN x * x + y * y <= 1.0 THEN 1 ELSE 0 END) / count(*), 6) AS DOUBLE) AS pi,
       count(*) AS samples
FROM (SELECT {_coord_sql(1)} AS x, {_coord_sql(1 + HEX)} AS y
      FROM (SELECT md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(CAST(l_shipdate AS DATE) AS VARCHAR))) AS h
            FROM lineitem) k) q
""", prelude=False)
def job_pi(spark, sf_dir):
    """One point for each row: its coordinates are two parts of a hash of the row's identifying columns."""
    li = tables(spark, sf_dir)["lineitem"]
    own = [c(x).cast("string") for x in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
    points = li.select(F.md5(F.concat_ws("|", *own, c("l_shipdate").cast("date").cast("string"))).alias("h"))
    x, y = (F.conv(F.substring("h", first, HEX), 16, 10).cast("double") / CELLS for first in (1, 1 + HEX))
    hits = F.sum(F.when(x * x + y * y <= 1.0, 1).otherwise(0))
    return points.agg(F.round(F.lit(4.0) * hits / F.count(F.lit(1)), 6).alias("pi"),
                      F.count(F.lit(1)).alias("samples"))
