"""Online (progressively refined) queries: M27 online Q1, M28 online Q14,
and the online forms of course queries a-d (I1 + I4 + I5 + I7).

Fact rows are split in ten parts by ``orderkey % 10`` (FIXTURES 4); each
snapshot is the answer over the parts seen so far, the last one exact.
Dimension sides (part, customer) are complete before the fact side streams
(C3): in batch form that is simply an ordinary join ahead of the online
aggregate.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.exprs import in_range, lit_date, sql_rnd
from tidemark.operators.online import Accumulator, Agg, Derived, OnlineSpec, online_agg, online_sql
from tidemark.plans.registry import register
from tidemark.sources.tpch import tables

c = F.col
N_PARTS = 10
DISC = "l_extendedprice * (1 - l_discount)"

Q1_SPEC = OnlineSpec(
    keys=["l_returnflag", "l_linestatus"],
    aggs=[Agg("sum_qty", "sum", "l_quantity", 2),
          Agg("sum_base_price", "sum", "l_extendedprice", 2),
          Agg("sum_disc_price", "sum", DISC, 2),
          Agg("sum_charge", "sum", f"{DISC} * (1 + l_tax)", 2),
          Agg("avg_qty", "avg", "l_quantity", 4),
          Agg("avg_price", "avg", "l_extendedprice", 4),
          Agg("avg_disc", "avg", "l_discount", 4),
          Agg("count_order", "count_star")])


@register("online_q1", online_sql(
    "SELECT * FROM lineitem_d WHERE l_shipdate <= DATE '1998-09-02'", "l_orderkey % 10", N_PARTS, Q1_SPEC, sql_rnd))
def online_q1(spark, sf_dir):
    return q1_snapshots(spark, sf_dir).orderBy("part_idx", *Q1_SPEC.keys)


def q1_snapshots(spark, sf_dir):
    """Online Q1's snapshots without the presentation order (for consumers
    such as the forecasts, which partition them by key themselves)."""
    li = tables(spark, sf_dir)["lineitem"].where(c("l_shipdate") <= lit_date("1998-09-02"))
    return online_agg(li, c("l_orderkey") % N_PARTS, N_PARTS, Q1_SPEC)


Q14_SPEC = OnlineSpec(
    keys=[],
    aggs=[Agg("promo", "sum", f"CASE WHEN p_type LIKE 'PROMO%' THEN {DISC} ELSE 0 END"),
          Agg("vol", "sum", DISC)],
    derived=[Derived("promo_revenue", "100.0 * promo / NULLIF(vol, 0)", 4)],
    hidden=["promo", "vol"])


@register("online_q14", online_sql(
    "SELECT * FROM lineitem_d, part_d WHERE l_partkey = p_partkey AND l_shipdate >= DATE '1995-09-01' "
    "AND l_shipdate < DATE '1995-10-01'", "l_orderkey % 10", N_PARTS, Q14_SPEC, sql_rnd))
def online_q14(spark, sf_dir):
    t = tables(spark, sf_dir)
    li = t["lineitem"].where(in_range("l_shipdate", "1995-09-01", "1995-10-01"))
    j = li.join(t["part"].select("p_partkey", "p_type"), c("l_partkey") == c("p_partkey"))
    return online_agg(j, c("l_orderkey") % N_PARTS, N_PARTS, Q14_SPEC).orderBy("part_idx")


A_SPEC = OnlineSpec(keys=[], aggs=[Agg("revenue", "sum", "l_extendedprice * l_discount", 2)])


@register("online_a", online_sql(
    "SELECT * FROM lineitem_d WHERE l_shipdate >= DATE '1996-01-01' AND l_shipdate < DATE '1997-01-01'",
    "l_orderkey % 10", N_PARTS, A_SPEC, sql_rnd))
def online_a(spark, sf_dir):
    li = tables(spark, sf_dir)["lineitem"].where(in_range("l_shipdate", "1996-01-01", "1997-01-01"))
    return online_agg(li, c("l_orderkey") % N_PARTS, N_PARTS, A_SPEC).orderBy("part_idx")


B_SPEC = OnlineSpec(keys=["c_name"], aggs=[Agg("o_totalprice_sum", "sum", "o_totalprice", 2)])


@register("online_b", online_sql(
    "SELECT * FROM orders_d, customer_d WHERE o_custkey = c_custkey AND c_mktsegment = 'AUTOMOBILE'",
    "o_orderkey % 10", N_PARTS, B_SPEC, sql_rnd))
def online_b(spark, sf_dir):
    t = tables(spark, sf_dir)
    cu = t["customer"].where(c("c_mktsegment") == "AUTOMOBILE").select("c_custkey", "c_name")
    j = t["orders"].select("o_orderkey", "o_custkey", "o_totalprice").join(cu, c("o_custkey") == c("c_custkey"))
    return online_agg(j, c("o_orderkey") % N_PARTS, N_PARTS, B_SPEC)


C_SPEC = OnlineSpec(keys=["c_custkey", "c_name", "c_acctbal"], aggs=[Agg("revenue", "sum", DISC, 2)])


@register("online_c", online_sql(
    "SELECT * FROM customer_d, orders_d, lineitem_d WHERE c_custkey = o_custkey AND l_orderkey = o_orderkey "
    "AND o_orderdate >= DATE '1996-10-01' AND o_orderdate < DATE '1997-01-01'",
    "l_orderkey % 10", N_PARTS, C_SPEC, sql_rnd))
def online_c(spark, sf_dir):
    t = tables(spark, sf_dir)
    o = t["orders"].where(in_range("o_orderdate", "1996-10-01", "1997-01-01")).select("o_orderkey", "o_custkey")
    cu = t["customer"].select("c_custkey", "c_name", "c_acctbal")
    li = t["lineitem"].select("l_orderkey", "l_extendedprice", "l_discount")
    j = li.join(o, c("l_orderkey") == c("o_orderkey")).join(cu, c("o_custkey") == c("c_custkey"))
    return online_agg(j, c("l_orderkey") % N_PARTS, N_PARTS, C_SPEC)


D_WHERE = ("p_partkey = l_partkey AND l_shipinstruct = 'DELIVER IN PERSON' AND ("
           "(p_brand = 'Brand#12' AND l_quantity >= 1 AND l_quantity <= 1 + 10 AND p_size BETWEEN 1 AND 5) OR "
           "(p_brand = 'Brand#23' AND l_quantity >= 10 AND l_quantity <= 10 + 10 AND p_size BETWEEN 1 AND 10) OR "
           "(p_brand = 'Brand#34' AND l_quantity >= 20 AND l_quantity <= 20 + 10 AND p_size BETWEEN 1 AND 15))")
D_SPEC = OnlineSpec(keys=[], aggs=[Agg("revenue", "sum", DISC, 2)])


def course_d_join(t):
    """Lineitem x part for query d: the one-sided predicates go below the
    join (pushed to the scans), the OR of bands stays above it."""
    li = t["lineitem"].where((c("l_shipinstruct") == "DELIVER IN PERSON") & c("l_quantity").between(1, 30))
    p = t["part"].where(c("p_brand").isin("Brand#12", "Brand#23", "Brand#34")).select(
        "p_partkey", "p_brand", "p_size")
    band = lambda b, q, s: ((c("p_brand") == b) & c("l_quantity").between(q, q + 10) & c("p_size").between(1, s))
    return (li.join(p, c("l_partkey") == c("p_partkey"))
            .where(band("Brand#12", 1, 5) | band("Brand#23", 10, 10) | band("Brand#34", 20, 15)))


@register("online_d", online_sql(
    f"SELECT * FROM lineitem_d, part_d WHERE {D_WHERE}", "l_orderkey % 10", N_PARTS, D_SPEC, sql_rnd))
def online_d(spark, sf_dir):
    j = course_d_join(tables(spark, sf_dir))
    return online_agg(j, c("l_orderkey") % N_PARTS, N_PARTS, D_SPEC).orderBy("part_idx")


LAST_SPEC = OnlineSpec(
    keys=["l_returnflag"],
    aggs=[Agg("last_price", "last", "l_extendedprice", order="struct(l_shipdate, l_orderkey, l_linenumber)"),
          Agg("last_part", "last", "l_partkey", order="struct(l_shipdate, l_orderkey, l_linenumber)")])


@register("online_last", """
SELECT p.range AS part_idx, l_returnflag, arg_max(l_extendedprice, (l_shipdate, l_orderkey, l_linenumber)) AS last_price,
       arg_max(l_partkey, (l_shipdate, l_orderkey, l_linenumber)) AS last_part
FROM range(10) p JOIN lineitem ON l_orderkey % 10 <= p.range GROUP BY p.range, l_returnflag
""", prelude=False)
def online_last(spark, sf_dir):
    """The last row by ship date over the parts so far; the dates do not follow the parts."""
    li = tables(spark, sf_dir)["lineitem"]
    return online_agg(li, c("l_orderkey") % N_PARTS, N_PARTS, LAST_SPEC, with_progress=False)


class Histogram(Accumulator):
    """Counts of a value in bins of equal width from 0, as text. The state is an array, merged bin by bin."""

    def __init__(self, name: str, column: str, width: float, bins: int):
        self.name, self.column, self.width, self.bins = name, column, width, bins

    def partial(self):
        at = F.least(F.floor(F.col(self.column) / self.width), F.lit(self.bins - 1))
        return F.array(*[F.count_if(at == b) for b in range(self.bins)])

    def merge(self, a, b):
        return F.zip_with(a, b, lambda x, y: x + y)

    def finish(self, state):
        return F.concat_ws(",", state.cast("array<string>"))


class MedianBin(Histogram):
    """First bin up to which half of the values lie."""

    def finish(self, state):
        total = F.aggregate(state, F.lit(0).cast("bigint"), lambda t, x: t + x)
        upto = lambda i: F.aggregate(F.slice(state, F.lit(1), i + 1), F.lit(0).cast("bigint"), lambda t, x: t + x)
        return F.array_min(F.filter(F.transform(state, lambda _, i: F.when(upto(i) * 2 >= total, i)), lambda i: i.isNotNull()))


HIST_SPEC = OnlineSpec(["l_returnflag"], [Histogram("quantities", "l_quantity", 10.0, 6), MedianBin("median_bin", "l_quantity", 10.0, 6),
                                          Agg("avg_qty", "avg", "l_quantity", 4)])


@register("online_histogram", f"""
, s AS (SELECT p.range AS part_idx, l_returnflag, least(CAST(floor(l_quantity / 10.0) AS INT), 5) AS bin, l_quantity
        FROM range(10) p JOIN lineitem ON l_orderkey % 10 <= p.range),
n AS (SELECT part_idx, l_returnflag, g.range AS bin, (SELECT count(*) FROM s WHERE s.part_idx = k.part_idx AND s.l_returnflag = k.l_returnflag AND s.bin = g.range) AS n
      FROM (SELECT DISTINCT part_idx, l_returnflag FROM s) k, range(6) g),
r AS (SELECT *, sum(n) OVER (PARTITION BY part_idx, l_returnflag ORDER BY bin) AS upto, sum(n) OVER (PARTITION BY part_idx, l_returnflag) AS total FROM n)
SELECT part_idx, l_returnflag, string_agg(CAST(n AS VARCHAR), ',' ORDER BY bin) AS quantities,
       CAST(min(CASE WHEN upto * 2 >= total THEN bin END) AS INT) AS median_bin,
       (SELECT {sql_rnd('avg(l_quantity)', 4)} FROM s WHERE s.part_idx = r.part_idx AND s.l_returnflag = r.l_returnflag) AS avg_qty
FROM r GROUP BY part_idx, l_returnflag
""")
def online_histogram(spark, sf_dir):
    """K2: a user's own accumulator (array state) beside a built-in one."""
    li = tables(spark, sf_dir)["lineitem"]
    return online_agg(li, c("l_orderkey") % N_PARTS, N_PARTS, HIST_SPEC, with_progress=False)
