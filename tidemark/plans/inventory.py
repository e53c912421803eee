"""Registered queries for inventory rows that no whole query isolates
(A10, A11, C9, C14, C20, D1-D3, D7, F1/F2, H4), over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.exprs import byte_length, parse_typed, rnd, sql_rnd as R, starts_with_flag, try_parse_typed
from tidemark.operators.relational import (agg_spec, avg_pair, finish_avg, foreign_key_report, last_per_group,
                                           primary_key_violations, sum_all, union_all, with_position)
from tidemark.operators.udf import apply_per_chunk, temp_view, udtf_runs
from tidemark.plans.registry import register
from tidemark.sources.tpch import register_tables, tables

c = F.col


@register("inv_a10_pk_lineitem", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""", prelude=False)
def inv_a10_pk_lineitem(spark, sf_dir):
    """A10: (l_orderkey, l_linenumber) values breaking the primary key."""
    return primary_key_violations(tables(spark, sf_dir)["lineitem"], ["l_orderkey", "l_linenumber"])


FKS = [  # (name, child, child cols, parent, parent cols)
    ("lineitem_orders", "lineitem", ["l_orderkey"], "orders", ["o_orderkey"]),
    ("lineitem_part", "lineitem", ["l_partkey"], "part", ["p_partkey"]),
    ("lineitem_supplier", "lineitem", ["l_suppkey"], "supplier", ["s_suppkey"]),
    ("lineitem_partsupp", "lineitem", ["l_partkey", "l_suppkey"], "partsupp", ["ps_partkey", "ps_suppkey"]),
    ("orders_customer", "orders", ["o_custkey"], "customer", ["c_custkey"]),
    ("customer_nation", "customer", ["c_nationkey"], "nation", ["n_nationkey"]),
    ("supplier_nation", "supplier", ["s_nationkey"], "nation", ["n_nationkey"]),
    ("nation_region", "nation", ["n_regionkey"], "region", ["r_regionkey"]),
    # keys into parts of tables, which some rows do not have
    ("orders_customer_in_credit", "orders", ["o_custkey"], "customer", ["c_custkey"], "c_acctbal >= 0"),
    ("lineitem_small_part", "lineitem", ["l_partkey"], "part", ["p_partkey"], "p_size <= 25"),
    ("lineitem_scarce_partsupp", "lineitem", ["l_partkey", "l_suppkey"], "partsupp", ["ps_partkey", "ps_suppkey"], "ps_availqty < 5000"),
]


def _fk_sql(name, child, ccols, parent, pcols, where="true"):
    on = " AND ".join(f"ch.{a} = pa.{b}" for a, b in zip(ccols, pcols))
    nn = " AND ".join(f"ch.{a} IS NOT NULL" for a in ccols)
    return (f"SELECT '{name}' AS fk, count(*) AS orphans FROM {child}_d ch WHERE {nn} AND NOT EXISTS "
            f"(SELECT 1 FROM {parent}_d pa WHERE {on} AND {where})")


@register("inv_a11_fk_check", "\n UNION ALL ".join(_fk_sql(*f) for f in FKS))
def inv_a11_fk_check(spark, sf_dir):
    """One row per foreign key with its orphan count (single and
    composite keys), each key in its own types and columns."""
    t = tables(spark, sf_dir)
    return foreign_key_report([(name, t[ch], cc, t[pa].where(where[0]) if where else t[pa], pc) for name, ch, cc, pa, pc, *where in FKS])


@register("inv_c9_not_in", """
SELECT c_mktsegment, count(*) AS customers FROM customer
WHERE c_nationkey NOT IN (SELECT CASE WHEN n_regionkey = 4 THEN NULL ELSE n_nationkey END
                          FROM nation WHERE n_regionkey >= 3)
GROUP BY c_mktsegment
UNION ALL
SELECT 'none' AS c_mktsegment, count(*) AS customers FROM customer
WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 3)
""", prelude=False)
def inv_c9_not_in(spark, sf_dir):
    """Null-aware NOT IN. The first list holds a NULL, so no row passes
    (SQL three-valued logic); the second has none. Planned by Catalyst as a
    null-aware anti join."""
    t = tables(spark, sf_dir)
    # the views are resolved when spark.sql analyses the text; drop them after
    with temp_view(spark, "tm_customer", t["customer"]), temp_view(spark, "tm_nation", t["nation"]):
        return spark.sql("""
SELECT c_mktsegment, count(*) AS customers FROM tm_customer
WHERE c_nationkey NOT IN (SELECT CASE WHEN n_regionkey = 4 THEN NULL ELSE n_nationkey END
                          FROM tm_nation WHERE n_regionkey >= 3)
GROUP BY c_mktsegment
UNION ALL
SELECT 'none' AS c_mktsegment, count(*) AS customers FROM tm_customer
WHERE c_nationkey NOT IN (SELECT n_nationkey FROM tm_nation WHERE n_regionkey = 3)""")


@register("inv_c14_merge_join", f"""
SELECT o_orderpriority, count(*) AS lines, {R('sum(l_extendedprice)')} AS price
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderpriority
""", prelude=False)
def inv_c14_merge_join(spark, sf_dir):
    """C14: sorted-merge join requested by hint (both sides exchanged and
    sorted on the key)."""
    t = tables(spark, sf_dir)
    li = t["lineitem"].select("l_orderkey", "l_extendedprice").hint("merge")
    o = t["orders"].select("o_orderkey", "o_orderpriority")
    return (li.join(o, c("l_orderkey") == c("o_orderkey")).groupBy("o_orderpriority")
            .agg(F.count(F.lit(1)).alias("lines"), rnd(F.sum("l_extendedprice")).alias("price")))


@register("inv_c20_hconcat", """
SELECT coalesce(a.pos, b.pos) AS pos, a.c_custkey, a.c_name, b.o_orderkey, b.o_totalprice
FROM (SELECT row_number() OVER (ORDER BY c_custkey) AS pos, c_custkey, c_name FROM customer) a
FULL OUTER JOIN (SELECT row_number() OVER (ORDER BY o_orderkey) AS pos, o_orderkey, o_totalprice FROM orders) b
ON a.pos = b.pos
""", prelude=False)
def inv_c20_hconcat(spark, sf_dir):
    """C20: positional horizontal concat of customer and orders (each in key
    order); positions come from a distributed sort, see ``with_position``."""
    t = tables(spark, sf_dir)
    a = with_position(t["customer"].select("c_custkey", "c_name"), ["c_custkey"])
    b = with_position(t["orders"].select("o_orderkey", "o_totalprice"), ["o_orderkey"])
    return (a.join(b, "pos", "full")
            .select(c("pos").cast("bigint").alias("pos"), "c_custkey", "c_name", "o_orderkey", "o_totalprice"))


LI_NUM = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
          "l_discount", "l_tax"]
LI_INT = {"l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"}


def _sum_sql(col_, alias):
    return f"CAST(sum({col_}) AS VARCHAR) AS {alias}" if col_ in LI_INT else f"{R(f'sum({col_})')} AS {alias}"


@register("inv_d1_sum_all", "SELECT " + ", ".join(_sum_sql(x, x) for x in LI_NUM) + " FROM lineitem",
          prelude=False)
def inv_d1_sum_all(spark, sf_dir):
    """Global sum of every numeric column, names kept bare; sums of whole numbers, exact at any
    size, are shown as text."""
    li = tables(spark, sf_dir)["lineitem"].select(*LI_NUM)
    s = sum_all(li)
    return s.select(*[c(x).cast("string").alias(x) if x in LI_INT else rnd(x).alias(x) for x in LI_NUM])


@register("inv_d2_sum_by_flag", "SELECT l_returnflag, " + ", ".join(_sum_sql(x, x + "_sum") for x in LI_NUM)
          + " FROM lineitem GROUP BY l_returnflag", prelude=False)
def inv_d2_sum_by_flag(spark, sf_dir):
    """Grouped sum of every numeric non-key column as ``<col>_sum``."""
    li = tables(spark, sf_dir)["lineitem"].select("l_returnflag", *LI_NUM)
    s = sum_all(li, ["l_returnflag"])
    return s.select("l_returnflag", *[c(x + "_sum").cast("string").alias(x + "_sum") if x in LI_INT else rnd(x + "_sum").alias(x + "_sum")
                                      for x in LI_NUM])


@register("inv_d3_agg_spec", f"""
SELECT l_linestatus, {R('sum(l_quantity)')} AS l_quantity_sum, count(l_quantity) AS l_quantity_count,
  {R('min(l_discount)', 4)} AS l_discount_min, {R('max(l_discount)', 4)} AS l_discount_max,
  {R('avg(l_discount)', 4)} AS l_discount_mean
FROM lineitem GROUP BY l_linestatus
""", prelude=False)
def inv_d3_agg_spec(spark, sf_dir):
    """D3: aggregate list column x [ops] named ``<col>_<op>``."""
    li = tables(spark, sf_dir)["lineitem"]
    r = agg_spec(li, ["l_linestatus"], {"l_quantity": ["sum", "count"], "l_discount": ["min", "max", "mean"]})
    return r.select("l_linestatus", rnd("l_quantity_sum").alias("l_quantity_sum"), "l_quantity_count",
                    *[rnd(x, 4).alias(x) for x in ("l_discount_min", "l_discount_max", "l_discount_mean")])


@register("inv_d7_last_order", """
SELECT o_custkey, arg_max(o_totalprice, o_orderkey) AS o_totalprice, arg_max(o_orderpriority, o_orderkey)
  AS o_orderpriority FROM orders GROUP BY o_custkey
""", prelude=False)
def inv_d7_last_order(spark, sf_dir):
    """Last value per group in a stated order (the latest order key)."""
    return last_per_group(tables(spark, sf_dir)["orders"], ["o_custkey"],
                          ["o_totalprice", "o_orderpriority"], "o_orderkey")


@register("inv_f1_union_balances", f"""
SELECT kind, nationkey, count(*) AS n, {R('sum(acctbal)')} AS acctbal FROM (
  SELECT 'S' AS kind, s_nationkey AS nationkey, s_acctbal AS acctbal FROM supplier
  UNION ALL SELECT 'C' AS kind, c_nationkey AS nationkey, c_acctbal AS acctbal FROM customer) u
GROUP BY kind, nationkey
""", prelude=False)
def inv_f1_union_balances(spark, sf_dir):
    """stack supplier and customer balances by name, then aggregate."""
    t = tables(spark, sf_dir)
    s = t["supplier"].select(F.lit("S").alias("kind"), c("s_nationkey").alias("nationkey"), c("s_acctbal").alias("acctbal"))
    cu = t["customer"].select(F.lit("C").alias("kind"), c("c_nationkey").alias("nationkey"), c("c_acctbal").alias("acctbal"))
    return (union_all([s, cu]).groupBy("kind", "nationkey")
            .agg(F.count(F.lit(1)).alias("n"), rnd(F.sum("acctbal")).alias("acctbal")))


@register("inv_h4_text_bytes", """
SELECT doc_id, length(text) AS chars, strlen(text) AS bytes FROM documents
""", prelude=False)
def inv_h4_text_bytes(spark, sf_dir):
    """H4: byte length (UTF-8) next to character length for every document."""
    d = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    return d.select("doc_id", F.length("text").cast("bigint").alias("chars"),
                    byte_length("text").cast("bigint").alias("bytes"))


@register("inv_k4_priority_runs", """
WITH o AS (SELECT o_custkey, o_orderpriority, o_orderkey,
                  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey)
                  - row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderkey) AS island FROM orders)
SELECT o_custkey, o_orderpriority, min(o_orderkey) AS first_place, max(o_orderkey) AS last_place, count(*) AS n
FROM o GROUP BY o_custkey, o_orderpriority, island
""", prelude=False)
def inv_k4_priority_runs(spark, sf_dir):
    """K4: a table function over orders, partitioned by customer: each customer's runs of orders of one priority."""
    o = tables(spark, sf_dir)["orders"].select("o_custkey", "o_orderkey", "o_orderpriority")
    rows = o.asTable().partitionBy("o_custkey").orderBy("o_orderkey")
    return udtf_runs()(rows, F.lit("o_custkey"), F.lit("o_orderpriority"), F.lit("o_orderkey"))


@register("inv_a8_registered", """
SELECT r_name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name
""", prelude=False)
def inv_a8_registered(spark, sf_dir):
    """Every table registered as a view, then plain SQL."""
    register_tables(spark, sf_dir, "_a8")
    return spark.sql("SELECT r_name, count(*) AS customers FROM customer_a8 JOIN nation_a8 ON c_nationkey = n_nationkey "
                     "JOIN region_a8 ON n_regionkey = r_regionkey GROUP BY r_name")


@register("inv_b13_starts_with", """
SELECT p_brand, CAST(sum(CASE WHEN starts_with(p_type, 'ST') THEN 1 ELSE 0 END) AS BIGINT) AS hits, count(*) AS n FROM part GROUP BY p_brand
""", prelude=False)
def inv_b13_starts_with(spark, sf_dir):
    """A prefix test as 0/1, summed."""
    p = tables(spark, sf_dir)["part"]
    return p.groupBy("p_brand").agg(F.sum(starts_with_flag("p_type", "ST")).alias("hits"), F.count(F.lit(1)).alias("n"))


@register("inv_c2_self_join", """
SELECT a.l_returnflag, count(*) AS pairs FROM lineitem a JOIN lineitem b
ON a.l_orderkey = b.l_orderkey AND a.l_suppkey = b.l_suppkey AND a.l_linenumber < b.l_linenumber GROUP BY a.l_returnflag
""", prelude=False)
def inv_c2_self_join(spark, sf_dir):
    """A self join on two keys: lines of one order by one supplier."""
    li = tables(spark, sf_dir)["lineitem"].select("l_orderkey", "l_suppkey", "l_linenumber", "l_returnflag")
    a, b = li.alias("a"), li.alias("b")
    on = [c("a.l_orderkey") == c("b.l_orderkey"), c("a.l_suppkey") == c("b.l_suppkey"), c("a.l_linenumber") < c("b.l_linenumber")]
    return a.join(b, on).groupBy(c("a.l_returnflag").alias("l_returnflag")).agg(F.count(F.lit(1)).alias("pairs"))


@register("inv_d9_avg_pair", f"""
SELECT o_orderpriority, {R('sum(o_totalprice)')} AS total, count(o_totalprice) AS n, {R('avg(o_totalprice)', 4)} AS mean FROM orders GROUP BY o_orderpriority
""", prelude=False)
def inv_d9_avg_pair(spark, sf_dir):
    """The average as the pair that merges, and its finish."""
    o = tables(spark, sf_dir)["orders"]
    pair = o.groupBy("o_orderpriority").agg(avg_pair("o_totalprice").alias("p"))
    return pair.select("o_orderpriority", rnd(c("p.sum")).alias("total"), c("p.count").alias("n"), rnd(finish_avg("p"), 4).alias("mean"))


@register("inv_h12_h14_parse", """
SELECT CAST(count(b) AS BIGINT) AS whole, CAST(count(*) - count(b) AS BIGINT) AS empty, CAST(sum(b) AS BIGINT) AS total, CAST(count(t) AS BIGINT) AS tried
FROM (SELECT CAST(NULLIF(x, '') AS INT) AS b, TRY_CAST(y AS INT) AS t
      FROM (SELECT CASE WHEN p_size % 5 = 0 THEN '' ELSE CAST(p_size AS VARCHAR) END AS x,
                   CASE WHEN p_size % 3 = 0 THEN 'size ' || CAST(p_size AS VARCHAR) ELSE CAST(p_size AS VARCHAR) END AS y FROM part) q) r
""", prelude=False)
def inv_h12_h14_parse(spark, sf_dir):
    """Typed parse (empty is null, else it must parse) and lossy parse (bad text is null)."""
    p, size = tables(spark, sf_dir)["part"], c("p_size").cast("string")
    text = p.select(F.when(c("p_size") % 5 == 0, "").otherwise(size).alias("x"),
                    F.when(c("p_size") % 3 == 0, F.concat(F.lit("size "), size)).otherwise(size).alias("y"))
    got = text.select(parse_typed("x", "int").alias("b"), try_parse_typed("y", "int").alias("t"))
    return got.agg(F.count("b").alias("whole"), (F.count(F.lit(1)) - F.count("b")).alias("empty"),
                   F.sum("b").alias("total"), F.count("t").alias("tried"))


def _spread(pdf):
    got = pdf.groupby("o_orderpriority")["o_totalprice"].agg(["count", "min", "max"]).reset_index()
    return got.rename(columns={"count": "n", "min": "least", "max": "most"})


@register("inv_k5_chunks", f"""
SELECT o_orderpriority, count(*) AS n, {R('min(o_totalprice)')} AS least, {R('max(o_totalprice)')} AS most FROM orders GROUP BY o_orderpriority
""", prelude=False)
def inv_k5_chunks(spark, sf_dir, chunk_rows: int = 100_000):
    """K5: a Python function over chunks of rows, whose results are merged; the chunks' number grows with the table."""
    o = tables(spark, sf_dir)["orders"].select("o_orderkey", "o_orderpriority", "o_totalprice")
    chunk = F.floor(c("o_orderkey") / chunk_rows)
    part = apply_per_chunk(o, chunk, _spread, "o_orderpriority string, n long, least double, most double")
    return part.groupBy("o_orderpriority").agg(F.sum("n").alias("n"), rnd(F.min("least")).alias("least"), rnd(F.max("most")).alias("most"))
