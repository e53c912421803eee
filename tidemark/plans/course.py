"""Course queries a-d (M23-M26) and the four chunk-parallel pandas/Ray
queries re-expressed as Spark plans (M29-M32)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.exprs import (add_days, add_months, add_years, disc_price, in_range, lit_date,
                                      parse_date, rnd, sql_rnd as R)
from tidemark.operators.relational import two_phase_agg
from tidemark.plans.online_queries import course_d_join
from tidemark.plans.registry import register
from tidemark.sources.tpch import tables

c = F.col


@register("course_a", f"""
SELECT {R('sum(l_extendedprice * l_discount)')} AS revenue FROM lineitem_d
WHERE l_shipdate >= DATE '1996-01-01' AND l_shipdate < DATE '1996-01-01' + INTERVAL 1 YEAR
""")
def course_a(spark, sf_dir, start: str = "1996-01-01"):
    li = tables(spark, sf_dir)["lineitem"].where(in_range("l_shipdate", start, add_years(start, 1)))
    return li.agg(rnd(F.sum(c("l_extendedprice") * c("l_discount"))).alias("revenue"))


@register("course_b", f"""
SELECT c_name, {R('sum(o_totalprice)')} AS o_totalprice_sum
FROM orders_d, customer_d WHERE o_custkey = c_custkey AND c_mktsegment = 'AUTOMOBILE'
GROUP BY c_name ORDER BY o_totalprice_sum DESC
""")
def course_b(spark, sf_dir, segment: str = "AUTOMOBILE"):
    t = tables(spark, sf_dir)
    cu = t["customer"].where(c("c_mktsegment") == segment).select("c_custkey", "c_name")
    # aggregate orders per customer key first: the join then sees one row per customer
    per = t["orders"].groupBy("o_custkey").agg(F.sum("o_totalprice").alias("tp"))
    return (per.join(cu, c("o_custkey") == c("c_custkey"))
            .groupBy("c_name").agg(rnd(F.sum("tp")).alias("o_totalprice_sum"))
            .orderBy(c("o_totalprice_sum").desc()))


@register("course_c", f"""
SELECT c_custkey, c_name, c_acctbal, {R('sum(l_extendedprice * (1 - l_discount))')} AS revenue
FROM customer_d, orders_d, lineitem_d
WHERE c_custkey = o_custkey AND l_orderkey = o_orderkey
  AND o_orderdate >= DATE '1996-10-01' AND o_orderdate < DATE '1996-10-01' + INTERVAL 3 MONTH
GROUP BY c_custkey, c_name, c_acctbal ORDER BY revenue DESC
""")
def course_c(spark, sf_dir, start: str = "1996-10-01"):
    t = tables(spark, sf_dir)
    o = t["orders"].where(in_range("o_orderdate", start, add_months(start, 3))).select("o_orderkey", "o_custkey")
    li = t["lineitem"].select("l_orderkey", "l_extendedprice", "l_discount")
    rev = li.join(o, c("l_orderkey") == c("o_orderkey")).groupBy("o_custkey").agg(F.sum(disc_price()).alias("r"))
    cu = t["customer"].select("c_custkey", "c_name", "c_acctbal")
    return (cu.join(rev, c("c_custkey") == c("o_custkey"))
            .select("c_custkey", "c_name", "c_acctbal", rnd("r").alias("revenue"))
            .orderBy(c("revenue").desc()))


@register("course_d", f"""
SELECT {R('sum(l_extendedprice * (1 - l_discount))')} AS revenue
FROM lineitem_d, part_d
WHERE p_partkey = l_partkey AND l_shipinstruct = 'DELIVER IN PERSON'
  AND ((p_brand = 'Brand#12' AND l_quantity >= 1 AND l_quantity <= 1 + 10 AND p_size BETWEEN 1 AND 5)
    OR (p_brand = 'Brand#23' AND l_quantity >= 10 AND l_quantity <= 10 + 10 AND p_size BETWEEN 1 AND 10)
    OR (p_brand = 'Brand#34' AND l_quantity >= 20 AND l_quantity <= 20 + 10 AND p_size BETWEEN 1 AND 15))
""")
def course_d(spark, sf_dir):
    return course_d_join(tables(spark, sf_dir)).agg(rnd(F.sum(disc_price())).alias("revenue"))


# ---------------------------------------------------------- M29-M32

N_CHUNKS = 16   # chunk count of the two-phase form; any value gives the same answer


@register("q6_year", f"""
SELECT {R('sum(l_extendedprice * l_discount)')} AS revenue FROM lineitem_d
WHERE l_shipdate >= DATE '1996-01-01' AND l_shipdate < DATE '1997-01-01'
  AND l_discount >= 0.05 AND l_discount <= 0.07 AND l_quantity < 24
""")
def q6_year(spark, sf_dir, time: str = "1996-01-01"):
    """Revenue of discounted small orders in the year from ``time``."""
    start = parse_date(time)
    li = tables(spark, sf_dir)["lineitem"].where(
        in_range("l_shipdate", start, add_years(start, 1)) & (c("l_discount") >= 0.05)
        & (c("l_discount") <= 0.07) & (c("l_quantity") < 24))
    chunk = c("l_orderkey") % N_CHUNKS
    res = two_phase_agg(li, chunk, [], {"revenue": F.sum(c("l_extendedprice") * c("l_discount"))})
    return res.select(rnd("revenue").alias("revenue"))


@register("pricing_summary", f"""
SELECT l_returnflag, l_linestatus,
  {R('sum(l_quantity)')} AS sum_qty, {R('sum(l_extendedprice)')} AS sum_base_price,
  {R('sum(l_extendedprice * (1 - l_discount))')} AS sum_disc_price,
  {R('sum(l_extendedprice * (1 - l_discount) * (1 + l_tax))')} AS sum_charge,
  {R('avg(l_quantity)', 4)} AS avg_qty, {R('avg(l_extendedprice)', 4)} AS avg_price,
  {R('avg(l_discount)', 4)} AS avg_disc, count(l_quantity) AS count_order
FROM lineitem_d WHERE l_shipdate <= DATE '1998-12-01' - INTERVAL 90 DAY
GROUP BY l_returnflag, l_linestatus ORDER BY l_returnflag, l_linestatus
""")
def pricing_summary(spark, sf_dir, timediff: int = 90):
    """Q1 with a day-offset parameter, as partial-per-chunk + combine."""
    li = tables(spark, sf_dir)["lineitem"].where(c("l_shipdate") <= lit_date(add_days("1998-12-01", -timediff)))
    res = two_phase_agg(
        li, c("l_orderkey") % N_CHUNKS, ["l_returnflag", "l_linestatus"],
        sums={"sum_qty": F.sum("l_quantity"), "sum_base_price": F.sum("l_extendedprice"),
              "sum_disc_price": F.sum(disc_price()),
              "sum_charge": F.sum(disc_price() * (F.lit(1.0) + c("l_tax")))},
        counts={"count_order": c("l_quantity")},
        avgs={"avg_qty": c("l_quantity"), "avg_price": c("l_extendedprice"), "avg_disc": c("l_discount")})
    return (res.select("l_returnflag", "l_linestatus",
                       *[rnd(x).alias(x) for x in ("sum_qty", "sum_base_price", "sum_disc_price", "sum_charge")],
                       *[rnd(x, 4).alias(x) for x in ("avg_qty", "avg_price", "avg_disc")],
                       c("count_order").cast("bigint").alias("count_order"))
            .orderBy("l_returnflag", "l_linestatus"))


@register("top_unshipped", f"""
SELECT l_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_shippriority,
  {R('sum(l_extendedprice * (1 - l_discount))')} AS revenue
FROM customer_d LEFT JOIN orders_d ON c_custkey = o_custkey LEFT JOIN lineitem_d ON o_orderkey = l_orderkey
WHERE c_mktsegment = 'BUILDING' AND o_orderdate < DATE '1995-03-15' AND l_shipdate > DATE '1995-03-15'
GROUP BY l_orderkey, o_orderdate, o_shippriority
ORDER BY revenue DESC, o_orderdate, l_orderkey LIMIT 10
""")
def top_unshipped(spark, sf_dir, segment: str = "BUILDING", day: str = "1995-03-15"):
    """Top-10 unshipped orders. Written with the left joins of the
    original; the null-rejecting filters let Catalyst turn them into inner
    joins and push each filter to its scan. Top-k with a unique tie-break
    key runs as TakeOrderedAndProject (per-task top-k, then merge)."""
    t = tables(spark, sf_dir)
    j = (t["customer"].join(t["orders"], c("c_custkey") == c("o_custkey"), "left")
         .join(t["lineitem"], c("o_orderkey") == c("l_orderkey"), "left")
         .where((c("c_mktsegment") == segment) & (c("o_orderdate") < lit_date(day))
                & (c("l_shipdate") > lit_date(day))))
    return (j.groupBy("l_orderkey", "o_orderdate", "o_shippriority")
            .agg(rnd(F.sum(disc_price())).alias("revenue"))
            .select("l_orderkey", c("o_orderdate").cast("date").alias("o_orderdate"), "o_shippriority", "revenue")
            .orderBy(c("revenue").desc(), "o_orderdate", "l_orderkey").limit(10))


@register("priority_check", """
SELECT o_orderpriority, count(*) AS order_count FROM orders_d
WHERE o_orderdate >= DATE '1996-07-01' AND o_orderdate < DATE '1996-10-01'
  AND o_orderkey IN (SELECT l_orderkey FROM lineitem_d WHERE l_commitdate < l_receiptdate)
GROUP BY o_orderpriority ORDER BY o_orderpriority
""")
def priority_check(spark, sf_dir, time: str = "1996-7-01"):
    """Orders of a quarter with a late line, per priority (semi join +
    count; the date text may be unpadded, H11)."""
    start = parse_date(time)
    t = tables(spark, sf_dir)
    late = t["lineitem"].where(c("l_commitdate") < c("l_receiptdate")).select("l_orderkey")
    o = (t["orders"].where(in_range("o_orderdate", start, add_months(start, 3)))
         .join(late, c("o_orderkey") == c("l_orderkey"), "left_semi"))
    return o.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("order_count")).orderBy("o_orderpriority")
