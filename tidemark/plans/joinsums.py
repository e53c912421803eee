"""Join sums 3, 7, 10: exact (M33-M35), online with bounds (M36-M38) and
online under selective predicates (M39-M41).

Dates move from 1990-1994 to the data's 1995-2001 by +4 years; nation CHINA
becomes NATION_18. Each online query is paired with an exact one of the same
predicates so the final step can be checked against it.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.exprs import disc_price, lit_date, rnd, sql_rnd as R
from tidemark.operators.bounds import looks, online_sum_ci, online_sum_sequential, online_sum_sql, sequential_quantiles
from tidemark.plans.registry import register
from tidemark.sources.tpch import tables

c = F.col
BUCKETS = 50
VALUE = "l_extendedprice * (1 - l_discount)"


def _j3(t, dated: bool):
    cu = t["customer"].where(c("c_mktsegment") == "BUILDING").select("c_custkey")
    o = t["orders"].select("o_orderkey", "o_custkey", "o_orderdate", "o_shippriority")
    li = t["lineitem"].select("l_orderkey", "l_extendedprice", "l_discount", "l_shipdate")
    if dated:
        o = o.where(c("o_orderdate") < lit_date("1996-03-15"))
        li = li.where(c("l_shipdate") > lit_date("1994-03-15"))
    o = o.join(cu, c("o_custkey") == c("c_custkey"), "left_semi")
    return li.join(o, c("l_orderkey") == c("o_orderkey"))


def _j7(t, nation: str | None):
    n1 = t["nation"].select(c("n_nationkey").alias("n1_key"), c("n_name").alias("n1_name"))
    if nation is not None:
        n1 = n1.where(c("n1_name") == nation)
    n2 = t["nation"].select(c("n_nationkey").alias("n2_key"))
    s = t["supplier"].join(F.broadcast(n1), c("s_nationkey") == c("n1_key")).select("s_suppkey")
    cu = t["customer"].join(F.broadcast(n2), c("c_nationkey") == c("n2_key")).select("c_custkey")
    o = t["orders"].select("o_orderkey", "o_custkey").join(cu, c("o_custkey") == c("c_custkey"), "left_semi")
    li = t["lineitem"].select("l_orderkey", "l_suppkey", "l_extendedprice", "l_discount")
    return (li.join(s, c("l_suppkey") == c("s_suppkey"), "left_semi")
            .join(o, c("l_orderkey") == c("o_orderkey")))


def _j10(t, selective: bool):
    n = t["nation"].select("n_nationkey")
    cu = t["customer"]
    if selective:
        cu = cu.where(c("c_acctbal") > 3000)
    cu = cu.join(F.broadcast(n), c("c_nationkey") == c("n_nationkey"), "left_semi").select("c_custkey")
    o = t["orders"].select("o_orderkey", "o_custkey", "o_orderdate")
    if selective:
        o = o.where(c("o_orderdate") >= lit_date("1998-07-01"))
    o = o.join(cu, c("o_custkey") == c("c_custkey"), "left_semi")
    li = t["lineitem"].where(c("l_returnflag") == "R").select("l_orderkey", "l_extendedprice", "l_discount")
    return li.join(o, c("l_orderkey") == c("o_orderkey"))


J3_DATED = ("SELECT * FROM customer_d, orders_d, lineitem_d WHERE c_mktsegment = 'BUILDING' "
            "AND c_custkey = o_custkey AND l_orderkey = o_orderkey "
            "AND o_orderdate < DATE '1996-03-15' AND l_shipdate > DATE '1994-03-15'")
J3_ALL = ("SELECT * FROM customer_d, orders_d, lineitem_d WHERE c_mktsegment = 'BUILDING' "
          "AND c_custkey = o_custkey AND l_orderkey = o_orderkey")
J7_ALL = ("SELECT * FROM supplier_d, lineitem_d, orders_d, customer_d, nation_d n1, nation_d n2 "
          "WHERE s_suppkey = l_suppkey AND o_orderkey = l_orderkey AND c_custkey = o_custkey "
          "AND s_nationkey = n1.n_nationkey AND c_nationkey = n2.n_nationkey")
J7_ONE = J7_ALL + " AND n1.n_name = 'NATION_18'"
J10_ALL = ("SELECT * FROM customer_d, lineitem_d, orders_d, nation_d WHERE c_custkey = o_custkey "
           "AND l_orderkey = o_orderkey AND l_returnflag = 'R' AND c_nationkey = n_nationkey")
J10_SEL = J10_ALL + " AND o_orderdate >= DATE '1998-07-01' AND c_acctbal > 3000"


# ------------------------------------------------------------- exact
@register("wj_exact_3", f"""
SELECT o_shippriority, {R(f'sum({VALUE})')} AS revenue FROM ({J3_DATED}) q GROUP BY o_shippriority
""")
def wj_exact_3(spark, sf_dir):
    return (_j3(tables(spark, sf_dir), True).groupBy("o_shippriority")
            .agg(rnd(F.sum(disc_price())).alias("revenue")))


@register("wj_exact_7", f"SELECT {R(f'sum({VALUE})')} AS revenue FROM ({J7_ALL}) q")
def wj_exact_7(spark, sf_dir):
    return _j7(tables(spark, sf_dir), None).agg(rnd(F.sum(disc_price())).alias("revenue"))


@register("wj_exact_10", f"SELECT {R(f'sum({VALUE})')} AS revenue FROM ({J10_SEL}) q")
def wj_exact_10(spark, sf_dir):
    return _j10(tables(spark, sf_dir), True).agg(rnd(F.sum(disc_price())).alias("revenue"))


# ------------------------------------------------------------- online
def _online(df):
    return online_sum_ci(df, disc_price(), c("l_orderkey"), BUCKETS, 0.95).orderBy("step")


def _osql(base):
    return online_sum_sql(base, VALUE, "l_orderkey", BUCKETS, 0.95, R)


@register("wj_online_3", _osql(J3_ALL))
def wj_online_3(spark, sf_dir):
    return _online(_j3(tables(spark, sf_dir), False))


@register("wj_online_7", _osql(J7_ONE))
def wj_online_7(spark, sf_dir):
    return _online(_j7(tables(spark, sf_dir), "NATION_18"))


@register("wj_online_10", _osql(J10_ALL))
def wj_online_10(spark, sf_dir):
    return _online(_j10(tables(spark, sf_dir), False))


@register("wj_online_skew_3", _osql(J3_DATED))
def wj_online_skew_3(spark, sf_dir):
    return _online(_j3(tables(spark, sf_dir), True))


@register("wj_online_skew_7", _osql(J7_ALL))
def wj_online_skew_7(spark, sf_dir):
    return _online(_j7(tables(spark, sf_dir), None))


@register("wj_online_skew_10", _osql(J10_SEL))
def wj_online_skew_10(spark, sf_dir):
    return _online(_j10(tables(spark, sf_dir), True))


# ------------------------------------------------------------- reports and stopping
EVERY, WANTED = 5, 0.1


def _stop_sql(base):
    steps = online_sum_sql(base, VALUE, "l_orderkey", BUCKETS, 0.95, R, crit_values=sequential_quantiles(BUCKETS, 0.95, EVERY))
    i = steps.rindex("SELECT CAST(m AS BIGINT)")
    at = ", ".join(map(str, looks(BUCKETS, EVERY)))
    return (steps[:i] + ", steps AS (" + steps[i:] + f"),\nreports AS (SELECT * FROM steps WHERE step IN ({at})),\n"
            f"ended AS (SELECT min(step) AS last FROM reports WHERE step = {BUCKETS} OR half_width <= abs(estimate) * {WANTED})\n"
            "SELECT reports.*, step = last AS stop FROM reports, ended WHERE step <= last")


def _until(df):
    return online_sum_sequential(df, disc_price(), c("l_orderkey"), BUCKETS, 0.95, EVERY, WANTED)


@register("wj_until_3", _stop_sql(J3_ALL))
def wj_until_3(spark, sf_dir):
    """Reports every five buckets until the half-width is a tenth of the sum."""
    return _until(_j3(tables(spark, sf_dir), False))


@register("wj_until_skew_10", _stop_sql(J10_SEL))
def wj_until_skew_10(spark, sf_dir):
    """The same under a selective predicate."""
    return _until(_j10(tables(spark, sf_dir), True))
