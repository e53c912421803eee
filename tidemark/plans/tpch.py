"""TPC-H Q1-Q22 as DataFrame plans (M1-M22), with DuckDB oracle text.

Parameters follow the standard text, moved to what the driver tables hold
(dates 1995-2001, nations NATION_0..24, one-word part types, derived
containers/ship modes; SURVEY 7.5). Money is rounded to 2 digits, ratios
and averages to 4, the same way in both engines.

Plan notes for scale:
* dimension tables nation/region are the only explicit broadcasts (25 and 5
  rows by definition); every other join is left to AQE, which broadcasts a
  side only when its measured size is under the threshold and otherwise
  shuffles (sort-merge / shuffled hash) with skew splitting on.
* correlated subqueries become an aggregate per key plus a join (Q2, Q17,
  Q20), so a hot key is pre-aggregated map-side instead of nested-looped.
* Q21's EXISTS / NOT EXISTS with ``<>`` become per-order min/max of
  supplier keys: linear, no pair enumeration inside an order.
* uncorrelated scalar subqueries use ``DataFrame.scalar()`` (one value,
  computed once).
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.exprs import (add_days, add_months, add_years, charge, disc_price, in_range, lit_date,
                                      rnd, sql_rnd as R, year_of)
from tidemark.plans.registry import register
from tidemark.sources.tpch import tables

c = F.col


def _t(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return tables(spark, sf_dir)


def _nations(t, region_name=None):
    n = t["nation"]
    if region_name is not None:
        r = t["region"].where(c("r_name") == region_name)
        n = n.join(F.broadcast(r), c("n_regionkey") == c("r_regionkey"), "left_semi")
    return F.broadcast(n)


# ------------------------------------------------------------------ Q1
@register("tpch_q1", f"""
SELECT l_returnflag, l_linestatus,
  {R('sum(l_quantity)')} AS sum_qty,
  {R('sum(l_extendedprice)')} AS sum_base_price,
  {R('sum(l_extendedprice * (1 - l_discount))')} AS sum_disc_price,
  {R('sum(l_extendedprice * (1 - l_discount) * (1 + l_tax))')} AS sum_charge,
  {R('avg(l_quantity)', 4)} AS avg_qty,
  {R('avg(l_extendedprice)', 4)} AS avg_price,
  {R('avg(l_discount)', 4)} AS avg_disc,
  count(*) AS count_order
FROM lineitem_d
WHERE l_shipdate <= DATE '1998-12-01' - INTERVAL 90 DAY
GROUP BY l_returnflag, l_linestatus
ORDER BY l_returnflag, l_linestatus
""")
def q1(spark, sf_dir, delta_days: int = 90):
    li = _t(spark, sf_dir)["lineitem"].where(c("l_shipdate") <= lit_date(add_days("1998-12-01", -delta_days)))
    return (li.groupBy("l_returnflag", "l_linestatus")
            .agg(rnd(F.sum("l_quantity")).alias("sum_qty"),
                 rnd(F.sum("l_extendedprice")).alias("sum_base_price"),
                 rnd(F.sum(disc_price())).alias("sum_disc_price"),
                 rnd(F.sum(charge())).alias("sum_charge"),
                 rnd(F.avg("l_quantity"), 4).alias("avg_qty"),
                 rnd(F.avg("l_extendedprice"), 4).alias("avg_price"),
                 rnd(F.avg("l_discount"), 4).alias("avg_disc"),
                 F.count(F.lit(1)).alias("count_order"))
            .orderBy("l_returnflag", "l_linestatus"))


# ------------------------------------------------------------------ Q2
@register("tpch_q2", """
SELECT s_acctbal, s_name, n_name, p_partkey, p_mfgr, s_address, s_phone, s_comment
FROM part_d, supplier_d, partsupp_d, nation_d, region_d
WHERE p_partkey = ps_partkey AND s_suppkey = ps_suppkey AND p_size = 15
  AND p_type LIKE '%ALL' AND s_nationkey = n_nationkey AND n_regionkey = r_regionkey
  AND r_name = 'EUROPE'
  AND ps_supplycost = (SELECT min(ps_supplycost) FROM partsupp_d, supplier_d, nation_d, region_d
                       WHERE p_partkey = ps_partkey AND s_suppkey = ps_suppkey
                         AND s_nationkey = n_nationkey AND n_regionkey = r_regionkey
                         AND r_name = 'EUROPE')
ORDER BY s_acctbal DESC, n_name, s_name, p_partkey
LIMIT 100
""")
def q2(spark, sf_dir):
    t = _t(spark, sf_dir)
    n = _nations(t, "EUROPE").select("n_nationkey", "n_name")
    s = t["supplier"].join(n, c("s_nationkey") == c("n_nationkey"))
    ps = t["partsupp"].select("ps_partkey", "ps_suppkey", "ps_supplycost")
    p = t["part"].where((c("p_size") == 15) & c("p_type").like("%ALL")).select("p_partkey", "p_mfgr")
    ps_eu = ps.join(s, c("ps_suppkey") == c("s_suppkey"))
    # correlated MIN -> aggregate per part over the same (part-restricted) set, then join back
    ps_eu_p = ps_eu.join(p, c("ps_partkey") == c("p_partkey"))
    best = ps_eu_p.groupBy(c("ps_partkey").alias("m_partkey")).agg(F.min("ps_supplycost").alias("m_cost"))
    res = ps_eu_p.join(best, (c("ps_partkey") == c("m_partkey")) & (c("ps_supplycost") == c("m_cost")))
    return (res.select("s_acctbal", "s_name", "n_name", "p_partkey", "p_mfgr", "s_address", "s_phone", "s_comment")
            .orderBy(c("s_acctbal").desc(), "n_name", "s_name", "p_partkey").limit(100))


# ------------------------------------------------------------------ Q3
@register("tpch_q3", f"""
SELECT l_orderkey, {R('sum(l_extendedprice * (1 - l_discount))')} AS revenue,
  CAST(o_orderdate AS DATE) AS o_orderdate, o_shippriority
FROM customer_d, orders_d, lineitem_d
WHERE c_mktsegment = 'BUILDING' AND c_custkey = o_custkey AND l_orderkey = o_orderkey
  AND o_orderdate < DATE '1995-03-15' AND l_shipdate > DATE '1995-03-15'
GROUP BY l_orderkey, o_orderdate, o_shippriority
ORDER BY revenue DESC, o_orderdate
""")
def q3(spark, sf_dir, segment: str = "BUILDING", day: str = "1995-03-15"):
    t = _t(spark, sf_dir)
    cust = t["customer"].where(c("c_mktsegment") == segment).select("c_custkey")
    o = (t["orders"].where(c("o_orderdate") < lit_date(day))
         .join(cust, c("o_custkey") == c("c_custkey"), "left_semi")
         .select("o_orderkey", "o_orderdate", "o_shippriority"))
    li = t["lineitem"].where(c("l_shipdate") > lit_date(day))
    return (li.join(o, c("l_orderkey") == c("o_orderkey"))
            .groupBy("l_orderkey", "o_orderdate", "o_shippriority")
            .agg(rnd(F.sum(disc_price())).alias("revenue"))
            .select("l_orderkey", "revenue", c("o_orderdate").cast("date").alias("o_orderdate"), "o_shippriority")
            .orderBy(c("revenue").desc(), "o_orderdate"))


# ------------------------------------------------------------------ Q4
@register("tpch_q4", """
SELECT o_orderpriority, count(*) AS order_count
FROM orders_d
WHERE o_orderdate >= DATE '1996-07-01' AND o_orderdate < DATE '1996-07-01' + INTERVAL 3 MONTH
  AND EXISTS (SELECT * FROM lineitem_d WHERE l_orderkey = o_orderkey AND l_commitdate < l_receiptdate)
GROUP BY o_orderpriority ORDER BY o_orderpriority
""")
def q4(spark, sf_dir, start: str = "1996-07-01"):
    t = _t(spark, sf_dir)
    late = t["lineitem"].where(c("l_commitdate") < c("l_receiptdate")).select("l_orderkey")
    o = (t["orders"].where(in_range("o_orderdate", start, add_months(start, 3)))
         .join(late, c("o_orderkey") == c("l_orderkey"), "left_semi"))
    return (o.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("order_count"))
            .orderBy("o_orderpriority"))


# ------------------------------------------------------------------ Q5
@register("tpch_q5", f"""
SELECT n_name, {R('sum(l_extendedprice * (1 - l_discount))')} AS revenue
FROM customer_d, orders_d, lineitem_d, supplier_d, nation_d, region_d
WHERE c_custkey = o_custkey AND l_orderkey = o_orderkey AND l_suppkey = s_suppkey
  AND c_nationkey = s_nationkey AND s_nationkey = n_nationkey AND n_regionkey = r_regionkey
  AND r_name = 'ASIA' AND o_orderdate >= DATE '1996-01-01'
  AND o_orderdate < DATE '1996-01-01' + INTERVAL 1 YEAR
GROUP BY n_name ORDER BY revenue DESC
""")
def q5(spark, sf_dir, region: str = "ASIA", start: str = "1996-01-01"):
    t = _t(spark, sf_dir)
    n = _nations(t, region).select("n_nationkey", "n_name")
    s = (t["supplier"].join(n, c("s_nationkey") == c("n_nationkey"))
         .select("s_suppkey", "s_nationkey", "n_name"))
    cu = t["customer"].select("c_custkey", "c_nationkey")
    o = (t["orders"].where(in_range("o_orderdate", start, add_years(start, 1)))
         .join(cu, c("o_custkey") == c("c_custkey")).select("o_orderkey", "c_nationkey"))
    li = t["lineitem"].select("l_orderkey", "l_suppkey", "l_extendedprice", "l_discount")
    j = (li.join(o, c("l_orderkey") == c("o_orderkey"))
         .join(s, (c("l_suppkey") == c("s_suppkey")) & (c("c_nationkey") == c("s_nationkey"))))
    return (j.groupBy("n_name").agg(rnd(F.sum(disc_price())).alias("revenue"))
            .orderBy(c("revenue").desc()))


# ------------------------------------------------------------------ Q6
@register("tpch_q6", f"""
SELECT {R('sum(l_extendedprice * l_discount)')} AS revenue
FROM lineitem_d
WHERE l_shipdate >= DATE '1996-01-01' AND l_shipdate < DATE '1996-01-01' + INTERVAL 1 YEAR
  AND l_discount BETWEEN 0.05 AND 0.07 AND l_quantity < 24
""")
def q6(spark, sf_dir, start: str = "1996-01-01", discount: float = 0.06, quantity: float = 24):
    li = _t(spark, sf_dir)["lineitem"].where(
        in_range("l_shipdate", start, add_years(start, 1))
        & c("l_discount").between(round(discount - 0.01, 2), round(discount + 0.01, 2))
        & (c("l_quantity") < quantity))
    return li.agg(rnd(F.sum(c("l_extendedprice") * c("l_discount"))).alias("revenue"))


# ------------------------------------------------------------------ Q7
@register("tpch_q7", f"""
SELECT supp_nation, cust_nation, l_year, {R('sum(volume)')} AS revenue
FROM (SELECT n1.n_name AS supp_nation, n2.n_name AS cust_nation,
             CAST(extract(year FROM l_shipdate) AS BIGINT) AS l_year,
             l_extendedprice * (1 - l_discount) AS volume
      FROM supplier_d, lineitem_d, orders_d, customer_d, nation_d n1, nation_d n2
      WHERE s_suppkey = l_suppkey AND o_orderkey = l_orderkey AND c_custkey = o_custkey
        AND s_nationkey = n1.n_nationkey AND c_nationkey = n2.n_nationkey
        AND ((n1.n_name = 'NATION_6' AND n2.n_name = 'NATION_7')
             OR (n1.n_name = 'NATION_7' AND n2.n_name = 'NATION_6'))
        AND l_shipdate BETWEEN DATE '1995-01-01' AND DATE '1996-12-31') AS shipping
GROUP BY supp_nation, cust_nation, l_year
ORDER BY supp_nation, cust_nation, l_year
""")
def q7(spark, sf_dir, nation1: str = "NATION_6", nation2: str = "NATION_7"):
    t = _t(spark, sf_dir)
    n = F.broadcast(t["nation"].where(c("n_name").isin(nation1, nation2)))
    s = t["supplier"].join(n, c("s_nationkey") == c("n_nationkey")).select("s_suppkey", c("n_name").alias("supp_nation"))
    cu = t["customer"].join(n, c("c_nationkey") == c("n_nationkey")).select("c_custkey", c("n_name").alias("cust_nation"))
    o = t["orders"].select("o_orderkey", "o_custkey").join(cu, c("o_custkey") == c("c_custkey"))
    li = t["lineitem"].where(c("l_shipdate").between(lit_date("1995-01-01"), lit_date("1996-12-31")))
    j = (li.join(s, c("l_suppkey") == c("s_suppkey")).join(o, c("l_orderkey") == c("o_orderkey"))
         .where(((c("supp_nation") == nation1) & (c("cust_nation") == nation2))
                | ((c("supp_nation") == nation2) & (c("cust_nation") == nation1))))
    return (j.groupBy("supp_nation", "cust_nation", year_of("l_shipdate").alias("l_year"))
            .agg(rnd(F.sum(disc_price())).alias("revenue"))
            .orderBy("supp_nation", "cust_nation", "l_year"))


# ------------------------------------------------------------------ Q8
@register("tpch_q8", f"""
SELECT o_year, {R("sum(CASE WHEN nation = 'NATION_2' THEN volume ELSE 0 END) / sum(volume)", 4)} AS mkt_share
FROM (SELECT CAST(extract(year FROM o_orderdate) AS BIGINT) AS o_year,
             l_extendedprice * (1 - l_discount) AS volume, n2.n_name AS nation
      FROM part_d, supplier_d, lineitem_d, orders_d, customer_d, nation_d n1, nation_d n2, region_d
      WHERE p_partkey = l_partkey AND s_suppkey = l_suppkey AND l_orderkey = o_orderkey
        AND o_custkey = c_custkey AND c_nationkey = n1.n_nationkey AND n1.n_regionkey = r_regionkey
        AND r_name = 'AMERICA' AND s_nationkey = n2.n_nationkey
        AND o_orderdate BETWEEN DATE '1995-01-01' AND DATE '1996-12-31'
        AND p_type = 'ECONOMY') AS all_nations
GROUP BY o_year ORDER BY o_year
""")
def q8(spark, sf_dir, nation: str = "NATION_2", region: str = "AMERICA", ptype: str = "ECONOMY"):
    t = _t(spark, sf_dir)
    n1 = _nations(t, region).select("n_nationkey")
    cu = t["customer"].join(n1, c("c_nationkey") == c("n_nationkey"), "left_semi").select("c_custkey")
    o = (t["orders"].where(c("o_orderdate").between(lit_date("1995-01-01"), lit_date("1996-12-31")))
         .join(cu, c("o_custkey") == c("c_custkey"), "left_semi")
         .select("o_orderkey", year_of("o_orderdate").alias("o_year")))
    p = t["part"].where(c("p_type") == ptype).select("p_partkey")
    n2 = F.broadcast(t["nation"].select(c("n_nationkey").alias("n2_key"), c("n_name").alias("nation")))
    s = t["supplier"].join(n2, c("s_nationkey") == c("n2_key")).select("s_suppkey", "nation")
    j = (t["lineitem"].join(p, c("l_partkey") == c("p_partkey"), "left_semi")
         .join(o, c("l_orderkey") == c("o_orderkey"))
         .join(s, c("l_suppkey") == c("s_suppkey"))
         .withColumn("volume", disc_price()))
    return (j.groupBy("o_year")
            .agg(rnd(F.try_divide(F.sum(F.when(c("nation") == nation, c("volume")).otherwise(0.0)),
                                  F.sum("volume")), 4).alias("mkt_share"))
            .orderBy("o_year"))


# ------------------------------------------------------------------ Q9
@register("tpch_q9", f"""
SELECT nation, o_year, {R('sum(amount)')} AS sum_profit
FROM (SELECT n_name AS nation, CAST(extract(year FROM o_orderdate) AS BIGINT) AS o_year,
             l_extendedprice * (1 - l_discount) - ps_supplycost * l_quantity AS amount
      FROM part_d, supplier_d, lineitem_d, partsupp_d, orders_d, nation_d
      WHERE s_suppkey = l_suppkey AND ps_suppkey = l_suppkey AND ps_partkey = l_partkey
        AND p_partkey = l_partkey AND o_orderkey = l_orderkey AND s_nationkey = n_nationkey
        AND p_name LIKE '%old%') AS profit
GROUP BY nation, o_year ORDER BY nation, o_year DESC
""")
def q9(spark, sf_dir, word: str = "old"):
    t = _t(spark, sf_dir)
    p = t["part"].where(c("p_name").contains(word)).select("p_partkey")
    n = F.broadcast(t["nation"].select("n_nationkey", c("n_name").alias("nation")))
    s = t["supplier"].join(n, c("s_nationkey") == c("n_nationkey")).select("s_suppkey", "nation")
    ps = t["partsupp"].select("ps_partkey", "ps_suppkey", "ps_supplycost")
    o = t["orders"].select("o_orderkey", year_of("o_orderdate").alias("o_year"))
    j = (t["lineitem"].join(p, c("l_partkey") == c("p_partkey"), "left_semi")
         .join(ps, (c("l_partkey") == c("ps_partkey")) & (c("l_suppkey") == c("ps_suppkey")))
         .join(s, c("l_suppkey") == c("s_suppkey"))
         .join(o, c("l_orderkey") == c("o_orderkey")))
    amount = disc_price() - c("ps_supplycost") * c("l_quantity")
    return (j.groupBy("nation", "o_year").agg(rnd(F.sum(amount)).alias("sum_profit"))
            .orderBy("nation", c("o_year").desc()))


# ------------------------------------------------------------------ Q10
@register("tpch_q10", f"""
SELECT c_custkey, c_name, {R('sum(l_extendedprice * (1 - l_discount))')} AS revenue,
  c_acctbal, n_name, c_address, c_phone, c_comment
FROM customer_d, orders_d, lineitem_d, nation_d
WHERE c_custkey = o_custkey AND l_orderkey = o_orderkey
  AND o_orderdate >= DATE '1996-10-01' AND o_orderdate < DATE '1996-10-01' + INTERVAL 3 MONTH
  AND l_returnflag = 'R' AND c_nationkey = n_nationkey
GROUP BY c_custkey, c_name, c_acctbal, c_phone, n_name, c_address, c_comment
ORDER BY revenue DESC
""")
def q10(spark, sf_dir, start: str = "1996-10-01"):
    t = _t(spark, sf_dir)
    o = t["orders"].where(in_range("o_orderdate", start, add_months(start, 3))).select("o_orderkey", "o_custkey")
    li = t["lineitem"].where(c("l_returnflag") == "R").select("l_orderkey", "l_extendedprice", "l_discount")
    # aggregate revenue per customer before touching the wide customer row
    rev = (li.join(o, c("l_orderkey") == c("o_orderkey"))
           .groupBy("o_custkey").agg(F.sum(disc_price()).alias("rev")))
    n = F.broadcast(t["nation"].select("n_nationkey", "n_name"))
    cu = t["customer"].join(n, c("c_nationkey") == c("n_nationkey"))
    return (cu.join(rev, c("c_custkey") == c("o_custkey"))
            .select("c_custkey", "c_name", rnd("rev").alias("revenue"), "c_acctbal", "n_name",
                    "c_address", "c_phone", "c_comment")
            .orderBy(c("revenue").desc()))


# ------------------------------------------------------------------ Q11
@register("tpch_q11", f"""
SELECT ps_partkey, {R('sum(ps_supplycost * ps_availqty)')} AS value
FROM partsupp_d, supplier_d, nation_d
WHERE ps_suppkey = s_suppkey AND s_nationkey = n_nationkey AND n_name = 'NATION_7'
GROUP BY ps_partkey
HAVING sum(ps_supplycost * ps_availqty) > (
  SELECT sum(ps_supplycost * ps_availqty) * 0.0001000000
  FROM partsupp_d, supplier_d, nation_d
  WHERE ps_suppkey = s_suppkey AND s_nationkey = n_nationkey AND n_name = 'NATION_7')
ORDER BY value DESC
""")
def q11(spark, sf_dir, nation: str = "NATION_7", fraction: float = 0.0001):
    t = _t(spark, sf_dir)
    n = F.broadcast(t["nation"].where(c("n_name") == nation).select("n_nationkey"))
    s = t["supplier"].join(n, c("s_nationkey") == c("n_nationkey"), "left_semi").select("s_suppkey")
    ps = t["partsupp"].join(s, c("ps_suppkey") == c("s_suppkey"), "left_semi")
    val = c("ps_supplycost") * c("ps_availqty")
    grouped = ps.groupBy("ps_partkey").agg(F.sum(val).alias("value_raw"))
    threshold = ps.agg(F.sum(val) * F.lit(fraction)).scalar()
    return (grouped.where(c("value_raw") > threshold)
            .select("ps_partkey", rnd("value_raw").alias("value"))
            .orderBy(c("value").desc()))


# ------------------------------------------------------------------ Q12
@register("tpch_q12", """
SELECT l_shipmode,
  CAST(sum(CASE WHEN o_orderpriority = '1-URGENT' OR o_orderpriority = '2-HIGH' THEN 1 ELSE 0 END) AS BIGINT) AS high_line_count,
  CAST(sum(CASE WHEN o_orderpriority <> '1-URGENT' AND o_orderpriority <> '2-HIGH' THEN 1 ELSE 0 END) AS BIGINT) AS low_line_count
FROM orders_d, lineitem_d
WHERE o_orderkey = l_orderkey AND l_shipmode IN ('MAIL', 'SHIP')
  AND l_commitdate < l_receiptdate AND l_shipdate < l_commitdate
  AND l_receiptdate >= DATE '1996-01-01' AND l_receiptdate < DATE '1996-01-01' + INTERVAL 1 YEAR
GROUP BY l_shipmode ORDER BY l_shipmode
""")
def q12(spark, sf_dir, modes=("MAIL", "SHIP"), start: str = "1996-01-01"):
    t = _t(spark, sf_dir)
    li = t["lineitem"].where(c("l_shipmode").isin(*modes) & (c("l_commitdate") < c("l_receiptdate"))
                             & (c("l_shipdate") < c("l_commitdate"))
                             & in_range("l_receiptdate", start, add_years(start, 1)))
    j = li.join(t["orders"].select("o_orderkey", "o_orderpriority"), c("l_orderkey") == c("o_orderkey"))
    high = c("o_orderpriority").isin("1-URGENT", "2-HIGH")
    return (j.groupBy("l_shipmode")
            .agg(F.sum(F.when(high, 1).otherwise(0)).cast("bigint").alias("high_line_count"),
                 F.sum(F.when(~high, 1).otherwise(0)).cast("bigint").alias("low_line_count"))
            .orderBy("l_shipmode"))


# ------------------------------------------------------------------ Q13
@register("tpch_q13", """
SELECT c_count, count(*) AS custdist
FROM (SELECT c_custkey, count(o_orderkey)
      FROM customer_d LEFT OUTER JOIN orders_d
        ON c_custkey = o_custkey AND o_comment NOT LIKE '%special%requests%'
      GROUP BY c_custkey) AS c_orders (c_custkey, c_count)
GROUP BY c_count ORDER BY custdist DESC, c_count DESC
""")
def q13(spark, sf_dir, w1: str = "special", w2: str = "requests"):
    t = _t(spark, sf_dir)
    # pre-aggregate orders per customer, then one customer-sized outer join
    per_cust = (t["orders"].where(~c("o_comment").like(f"%{w1}%{w2}%"))
                .groupBy("o_custkey").agg(F.count("o_orderkey").alias("n")))
    c_orders = (t["customer"].select("c_custkey")
                .join(per_cust, c("c_custkey") == c("o_custkey"), "left")
                .select("c_custkey", F.coalesce(c("n"), F.lit(0)).cast("bigint").alias("c_count")))
    return (c_orders.groupBy("c_count").agg(F.count(F.lit(1)).alias("custdist"))
            .orderBy(c("custdist").desc(), c("c_count").desc()))


# ------------------------------------------------------------------ Q14
@register("tpch_q14", f"""
SELECT {R("100.00 * sum(CASE WHEN p_type LIKE 'PROMO%' THEN l_extendedprice * (1 - l_discount) ELSE 0 END) / sum(l_extendedprice * (1 - l_discount))", 4)} AS promo_revenue
FROM lineitem_d, part_d
WHERE l_partkey = p_partkey AND l_shipdate >= DATE '1995-09-01'
  AND l_shipdate < DATE '1995-09-01' + INTERVAL 1 MONTH
""")
def q14(spark, sf_dir, start: str = "1995-09-01"):
    t = _t(spark, sf_dir)
    li = t["lineitem"].where(in_range("l_shipdate", start, add_months(start, 1)))
    j = li.join(t["part"].select("p_partkey", "p_type"), c("l_partkey") == c("p_partkey"))
    promo = F.sum(F.when(c("p_type").startswith("PROMO"), disc_price()).otherwise(0.0))
    return j.agg(rnd(F.try_divide(F.lit(100.0) * promo, F.sum(disc_price())), 4).alias("promo_revenue"))


# ------------------------------------------------------------------ Q15
@register("tpch_q15", f"""
, revenue0 (supplier_no, total_revenue) AS (
  SELECT l_suppkey, sum(l_extendedprice * (1 - l_discount)) FROM lineitem_d
  WHERE l_shipdate >= DATE '1996-01-01' AND l_shipdate < DATE '1996-01-01' + INTERVAL 3 MONTH
  GROUP BY l_suppkey)
SELECT s_suppkey, s_name, s_address, s_phone, {R('total_revenue')} AS total_revenue
FROM supplier_d, revenue0
WHERE s_suppkey = supplier_no AND total_revenue = (SELECT max(total_revenue) FROM revenue0)
ORDER BY s_suppkey
""")
def q15(spark, sf_dir, start: str = "1996-01-01"):
    t = _t(spark, sf_dir)
    revenue0 = (t["lineitem"].where(in_range("l_shipdate", start, add_months(start, 3)))
                .groupBy(c("l_suppkey").alias("supplier_no"))
                .agg(F.sum(disc_price()).alias("total_revenue"))
                .persist(StorageLevel.MEMORY_AND_DISK))   # the view is read twice; one scan
    top = revenue0.agg(F.max("total_revenue")).scalar()
    return (t["supplier"].join(revenue0.where(c("total_revenue") == top), c("s_suppkey") == c("supplier_no"))
            .select("s_suppkey", "s_name", "s_address", "s_phone", rnd("total_revenue").alias("total_revenue"))
            .orderBy("s_suppkey"))


# ------------------------------------------------------------------ Q16
@register("tpch_q16", """
SELECT p_brand, p_type, p_size, count(DISTINCT ps_suppkey) AS supplier_cnt
FROM partsupp_d, part_d
WHERE p_partkey = ps_partkey AND p_brand <> 'Brand#45' AND p_type NOT LIKE 'MEDIUM%'
  AND p_size IN (49, 14, 23, 45, 19, 3, 36, 9)
  AND ps_suppkey NOT IN (SELECT s_suppkey FROM supplier_d WHERE s_comment LIKE '%Customer%Complaints%')
GROUP BY p_brand, p_type, p_size
ORDER BY supplier_cnt DESC, p_brand, p_type, p_size
""")
def q16(spark, sf_dir, brand: str = "Brand#45", type_prefix: str = "MEDIUM",
        sizes=(49, 14, 23, 45, 19, 3, 36, 9)):
    t = _t(spark, sf_dir)
    p = t["part"].where((c("p_brand") != brand) & ~c("p_type").startswith(type_prefix)
                        & c("p_size").isin(*sizes)).select("p_partkey", "p_brand", "p_type", "p_size")
    bad = t["supplier"].where(c("s_comment").like("%Customer%Complaints%")).select("s_suppkey")
    # NOT IN over a non-nullable key is exactly an anti join
    ps = t["partsupp"].join(bad, c("ps_suppkey") == c("s_suppkey"), "left_anti")
    j = ps.join(p, c("ps_partkey") == c("p_partkey"))
    return (j.groupBy("p_brand", "p_type", "p_size")
            .agg(F.countDistinct("ps_suppkey").alias("supplier_cnt"))
            .orderBy(c("supplier_cnt").desc(), "p_brand", "p_type", "p_size"))


# ------------------------------------------------------------------ Q17
@register("tpch_q17", f"""
SELECT {R('sum(l_extendedprice) / 7.0')} AS avg_yearly
FROM lineitem_d, part_d
WHERE p_partkey = l_partkey AND p_brand = 'Brand#23' AND p_container = 'LG CAN'
  AND l_quantity < (SELECT 0.2 * avg(l_quantity) FROM lineitem_d WHERE l_partkey = p_partkey)
""")
def q17(spark, sf_dir, brand: str = "Brand#23", container: str = "LG CAN"):
    t = _t(spark, sf_dir)
    p = t["part"].where((c("p_brand") == brand) & (c("p_container") == container)).select("p_partkey")
    li = (t["lineitem"].select("l_partkey", "l_quantity", "l_extendedprice")
          .join(p, c("l_partkey") == c("p_partkey"), "left_semi"))
    avg_q = li.groupBy(c("l_partkey").alias("a_partkey")).agg((F.lit(0.2) * F.avg("l_quantity")).alias("lim"))
    j = li.join(avg_q, c("l_partkey") == c("a_partkey")).where(c("l_quantity") < c("lim"))
    return j.agg(rnd(F.sum("l_extendedprice") / F.lit(7.0)).alias("avg_yearly"))


# ------------------------------------------------------------------ Q18
@register("tpch_q18", f"""
SELECT c_name, c_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_totalprice,
  {R('sum(l_quantity)')} AS sum_qty
FROM customer_d, orders_d, lineitem_d
WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem_d GROUP BY l_orderkey HAVING sum(l_quantity) > 300)
  AND c_custkey = o_custkey AND o_orderkey = l_orderkey
GROUP BY c_name, c_custkey, o_orderkey, o_orderdate, o_totalprice
ORDER BY o_totalprice DESC, o_orderdate
""")
def q18(spark, sf_dir, quantity: float = 300):
    t = _t(spark, sf_dir)
    # one aggregate per order serves both the IN subquery and the final sum
    per_order = (t["lineitem"].groupBy("l_orderkey").agg(F.sum("l_quantity").alias("qty"))
                 .where(c("qty") > quantity))
    o = t["orders"].select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    cu = t["customer"].select("c_custkey", "c_name")
    return (per_order.join(o, c("l_orderkey") == c("o_orderkey"))
            .join(cu, c("o_custkey") == c("c_custkey"))
            .select("c_name", "c_custkey", "o_orderkey", c("o_orderdate").cast("date").alias("o_orderdate"),
                    "o_totalprice", rnd("qty").alias("sum_qty"))
            .orderBy(c("o_totalprice").desc(), "o_orderdate"))


# ------------------------------------------------------------------ Q19
Q19_SQL = f"""
SELECT {R('sum(l_extendedprice * (1 - l_discount))')} AS revenue
FROM lineitem_d, part_d
WHERE (p_partkey = l_partkey AND p_brand = 'Brand#12'
       AND p_container IN ('SM CASE', 'SM BOX', 'SM PACK', 'SM PKG')
       AND l_quantity >= 1 AND l_quantity <= 1 + 10 AND p_size BETWEEN 1 AND 5
       AND l_shipmode IN ('AIR', 'AIR REG') AND l_shipinstruct = 'DELIVER IN PERSON')
   OR (p_partkey = l_partkey AND p_brand = 'Brand#23'
       AND p_container IN ('MED BAG', 'MED BOX', 'MED PKG', 'MED PACK')
       AND l_quantity >= 10 AND l_quantity <= 10 + 10 AND p_size BETWEEN 1 AND 10
       AND l_shipmode IN ('AIR', 'AIR REG') AND l_shipinstruct = 'DELIVER IN PERSON')
   OR (p_partkey = l_partkey AND p_brand = 'Brand#34'
       AND p_container IN ('LG CASE', 'LG BOX', 'LG PACK', 'LG PKG')
       AND l_quantity >= 20 AND l_quantity <= 20 + 10 AND p_size BETWEEN 1 AND 15
       AND l_shipmode IN ('AIR', 'AIR REG') AND l_shipinstruct = 'DELIVER IN PERSON')
"""


@register("tpch_q19", Q19_SQL)
def q19(spark, sf_dir):
    t = _t(spark, sf_dir)
    li = t["lineitem"].where(c("l_shipmode").isin("AIR", "AIR REG")
                             & (c("l_shipinstruct") == "DELIVER IN PERSON")
                             & c("l_quantity").between(1, 30))
    p = t["part"].where(c("p_brand").isin("Brand#12", "Brand#23", "Brand#34"))
    band = lambda brand, cont, qlo, smax: ((c("p_brand") == brand) & c("p_container").isin(*cont)
                                           & c("l_quantity").between(qlo, qlo + 10)
                                           & c("p_size").between(1, smax))
    cond = (band("Brand#12", ["SM CASE", "SM BOX", "SM PACK", "SM PKG"], 1, 5)
            | band("Brand#23", ["MED BAG", "MED BOX", "MED PKG", "MED PACK"], 10, 10)
            | band("Brand#34", ["LG CASE", "LG BOX", "LG PACK", "LG PKG"], 20, 15))
    j = li.join(p, c("l_partkey") == c("p_partkey")).where(cond)
    return j.agg(rnd(F.sum(disc_price())).alias("revenue"))


# ------------------------------------------------------------------ Q20
@register("tpch_q20", """
SELECT s_name, s_address
FROM supplier_d, nation_d
WHERE s_suppkey IN (
    SELECT ps_suppkey FROM partsupp_d
    WHERE ps_partkey IN (SELECT p_partkey FROM part_d WHERE p_name LIKE 'red%')
      AND ps_availqty > (SELECT 0.5 * sum(l_quantity) FROM lineitem_d
                         WHERE l_partkey = ps_partkey AND l_suppkey = ps_suppkey
                           AND l_shipdate >= DATE '1996-01-01'
                           AND l_shipdate < DATE '1996-01-01' + INTERVAL 1 YEAR))
  AND s_nationkey = n_nationkey AND n_name = 'NATION_3'
ORDER BY s_name
""")
def q20(spark, sf_dir, prefix: str = "red", start: str = "1996-01-01", nation: str = "NATION_3"):
    t = _t(spark, sf_dir)
    p = t["part"].where(c("p_name").startswith(prefix)).select("p_partkey")
    ps = t["partsupp"].join(p, c("ps_partkey") == c("p_partkey"), "left_semi")
    shipped = (t["lineitem"].where(in_range("l_shipdate", start, add_years(start, 1)))
               .join(p, c("l_partkey") == c("p_partkey"), "left_semi")
               .groupBy("l_partkey", "l_suppkey").agg((F.lit(0.5) * F.sum("l_quantity")).alias("half_qty")))
    good = (ps.join(shipped, (c("ps_partkey") == c("l_partkey")) & (c("ps_suppkey") == c("l_suppkey")))
            .where(c("ps_availqty") > c("half_qty")).select("ps_suppkey"))
    n = F.broadcast(t["nation"].where(c("n_name") == nation).select("n_nationkey"))
    s = t["supplier"].join(n, c("s_nationkey") == c("n_nationkey"), "left_semi")
    return (s.join(good, c("s_suppkey") == c("ps_suppkey"), "left_semi")
            .select("s_name", "s_address").orderBy("s_name"))


# ------------------------------------------------------------------ Q21
@register("tpch_q21", """
SELECT s_name, count(*) AS numwait
FROM supplier_d, lineitem_d l1, orders_d, nation_d
WHERE s_suppkey = l1.l_suppkey AND o_orderkey = l1.l_orderkey AND o_orderstatus = 'F'
  AND l1.l_receiptdate > l1.l_commitdate
  AND EXISTS (SELECT * FROM lineitem_d l2 WHERE l2.l_orderkey = l1.l_orderkey AND l2.l_suppkey <> l1.l_suppkey)
  AND NOT EXISTS (SELECT * FROM lineitem_d l3 WHERE l3.l_orderkey = l1.l_orderkey
                  AND l3.l_suppkey <> l1.l_suppkey AND l3.l_receiptdate > l3.l_commitdate)
  AND s_nationkey = n_nationkey AND n_name = 'NATION_20'
GROUP BY s_name ORDER BY numwait DESC, s_name
""")
def q21(spark, sf_dir, nation: str = "NATION_20"):
    t = _t(spark, sf_dir)
    late = c("l_receiptdate") > c("l_commitdate")
    # EXISTS other supplier  <=> min(supp) != max(supp) in the order
    # NOT EXISTS other late  <=> the order's late lines have one supplier; each of them is a row of the answer
    per_order = (t["lineitem"].groupBy("l_orderkey").agg(
        F.min("l_suppkey").alias("smin"), F.max("l_suppkey").alias("smax"),
        F.min(F.when(late, c("l_suppkey"))).alias("lmin"),
        F.max(F.when(late, c("l_suppkey"))).alias("lmax"), F.count_if(late).alias("late"))
        .where((c("smin") != c("smax")) & (c("lmin") == c("lmax"))).select("l_orderkey", "lmin", "late"))
    o = t["orders"].where(c("o_orderstatus") == "F").select("o_orderkey")
    n = F.broadcast(t["nation"].where(c("n_name") == nation).select("n_nationkey"))
    s = t["supplier"].join(n, c("s_nationkey") == c("n_nationkey"), "left_semi").select("s_suppkey", "s_name")
    return (per_order.join(o, c("l_orderkey") == c("o_orderkey"), "left_semi")
            .join(s, c("lmin") == c("s_suppkey"))
            .groupBy("s_name").agg(F.sum("late").alias("numwait"))
            .orderBy(c("numwait").desc(), "s_name"))


# ------------------------------------------------------------------ Q22
CODES = ("13", "31", "23", "29", "30", "18", "17")


@register("tpch_q22", f"""
SELECT cntrycode, count(*) AS numcust, {R('sum(c_acctbal)')} AS totacctbal
FROM (SELECT substring(c_phone FROM 1 FOR 2) AS cntrycode, c_acctbal
      FROM customer_d
      WHERE substring(c_phone FROM 1 FOR 2) IN ('13', '31', '23', '29', '30', '18', '17')
        AND c_acctbal > (SELECT avg(c_acctbal) FROM customer_d WHERE c_acctbal > 0.00
                         AND substring(c_phone FROM 1 FOR 2) IN ('13', '31', '23', '29', '30', '18', '17'))
        AND NOT EXISTS (SELECT * FROM orders_d WHERE o_custkey = c_custkey AND o_orderdate >= DATE '2000-01-01')
     ) AS custsale
GROUP BY cntrycode ORDER BY cntrycode
""")
def q22(spark, sf_dir, codes=CODES, since: str = "2000-01-01"):
    """Every customer of the data has orders, so the ones without an order since a date are asked for."""
    t = _t(spark, sf_dir)
    cu = t["customer"].withColumn("cntrycode", F.substring("c_phone", 1, 2)).where(c("cntrycode").isin(*codes))
    avg_bal = cu.where(c("c_acctbal") > 0.0).agg(F.avg("c_acctbal")).scalar()
    buyers = t["orders"].where(c("o_orderdate") >= lit_date(since)).select("o_custkey")
    sel = (cu.where(c("c_acctbal") > avg_bal)
           .join(buyers, c("c_custkey") == c("o_custkey"), "left_anti"))
    return (sel.groupBy("cntrycode").agg(F.count(F.lit(1)).alias("numcust"),
                                         rnd(F.sum("c_acctbal")).alias("totacctbal"))
            .orderBy("cntrycode"))
