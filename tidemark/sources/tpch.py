"""TPC-H tables over the given parquet files, with the columns the files lack.

The driver tables carry a subset of TPC-H (no partsupp, no commit/receipt
dates, ship modes, containers, phones, comments ...). The missing columns are
derived from the keys by fixed arithmetic. Each derivation is one SQL
expression that Spark (``F.expr``) and DuckDB parse the same way, so an
independent engine can rebuild exactly the same tables for checking.

Derivations are projections (no shuffle) except partsupp, which is the set of
distinct (partkey, suppkey) pairs that lineitem references: a partial
aggregate per task followed by one hash exchange on the pair.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# columns of the given files; stated, so that no job reads footers while a query is built
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
              "o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
}
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

# Fixed values for the derived columns: ship modes, ship instructions,
# container size and kind words, comment texts (as TPC-H spells them).
SHIP_MODES = ["REG AIR", "AIR", "RAIL", "SHIP", "TRUCK", "MAIL", "FOB"]
SHIP_INSTRUCT = ["DELIVER IN PERSON", "COLLECT COD", "NONE", "TAKE BACK RETURN"]
CONTAINER_SIZE = ["SM", "LG", "MED", "JUMBO", "WRAP"]
CONTAINER_KIND = ["CASE", "BOX", "BAG", "JAR", "PKG", "PACK", "CAN", "DRUM"]


def _pick(expr: str, words: list[str]) -> str:
    """CASE expression choosing ``words[expr]`` (expr in 0..len-1)."""
    arms = " ".join(f"WHEN {i} THEN '{w}'" for i, w in enumerate(words[:-1]))
    return f"(CASE CAST({expr} AS INT) {arms} ELSE '{words[-1]}' END)"


# name -> list of (column, SQL expression). Expressions only use syntax that
# Spark SQL and DuckDB share: CASE, CAST, %, ||, date + int.
DERIVED: dict[str, list[tuple[str, str]]] = {
    "lineitem": [
        ("l_commitdate", "CAST(l_shipdate AS DATE) + CAST((l_orderkey + l_linenumber * 3) % 61 - 30 AS INT)"),
        ("l_receiptdate", "CAST(l_shipdate AS DATE) + CAST(1 + (l_orderkey * 7 + l_linenumber) % 30 AS INT)"),
        ("l_shipmode", _pick("(l_orderkey + l_linenumber) % 7", SHIP_MODES)),
        ("l_shipinstruct", _pick("(l_partkey + l_linenumber) % 4", SHIP_INSTRUCT)),
    ],
    "orders": [
        ("o_shippriority", "CAST(0 AS INT)"),
        ("o_comment", "(CASE WHEN o_orderkey % 17 = 3 THEN 'final special deposits requests' "
                      "WHEN o_orderkey % 17 = 5 THEN 'special packages' "
                      "WHEN o_orderkey % 17 = 8 THEN 'requests are special' "
                      "ELSE 'regular deposits' END)"),
    ],
    "customer": [
        ("c_phone", "CAST(c_nationkey + 10 AS STRING) || '-' || CAST(100 + c_custkey % 900 AS STRING)"
                    " || '-' || CAST(1000 + c_custkey % 9000 AS STRING)"),
        ("c_address", "'Addr ' || CAST(c_custkey AS STRING)"),
        ("c_comment", "'account ' || CAST(c_custkey % 97 AS STRING)"),
    ],
    "supplier": [
        ("s_address", "'SAddr ' || CAST(s_suppkey AS STRING)"),
        ("s_phone", "CAST(s_nationkey + 10 AS STRING) || '-' || CAST(100 + s_suppkey % 900 AS STRING)"),
        ("s_comment", "(CASE WHEN s_suppkey % 23 = 7 THEN 'blithely Customer slyly Complaints' "
                      "ELSE 'quiet deposits' END)"),
    ],
    "part": [
        ("p_mfgr", "'Manufacturer#' || CAST(1 + p_partkey % 5 AS STRING)"),
        ("p_container", _pick("p_partkey % 5", CONTAINER_SIZE) + " || ' ' || "
                        + _pick("(p_partkey * 3 + 1) % 8", CONTAINER_KIND)),
    ],
}

PARTSUPP_COLUMNS = [
    ("ps_availqty", "CAST((ps_partkey * 7 + ps_suppkey * 13) % 9999 + 1 AS INT)"),
    ("ps_supplycost", "CAST((ps_partkey * 31 + ps_suppkey * 17) % 100000 AS DOUBLE) / 100.0 + 1.0"),
]


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(table_path(sf_dir, name))


def with_derived(df: DataFrame, name: str) -> DataFrame:
    cols = DERIVED.get(name, [])
    if not cols:
        return df
    return df.withColumns({c: F.expr(e) for c, e in cols})


def partsupp_from(lineitem: DataFrame) -> DataFrame:
    ps = (lineitem.select(F.col("l_partkey").alias("ps_partkey"),
                          F.col("l_suppkey").alias("ps_suppkey"))
          .distinct())
    return ps.withColumns({c: F.expr(e) for c, e in PARTSUPP_COLUMNS})


class _Tables(Mapping):
    """Table name -> DataFrame, each planned on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir, self._made = spark, sf_dir, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            if name == "partsupp":
                self._made[name] = partsupp_from(read_raw(self._spark, self._dir, "lineitem"))
            elif name in TABLES:
                self._made[name] = with_derived(read_raw(self._spark, self._dir, name), name)
            else:
                raise KeyError(name)
        return self._made[name]

    def __iter__(self):
        return iter((*TABLES, "partsupp"))

    def __len__(self) -> int:
        return len(TABLES) + 1


def tables(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    """All TPC-H tables (plus partsupp) as lazily planned DataFrames. Only those asked for are planned, without a job. The
    mapping is read-only and made anew at each call, so files added to a table
    are seen by the next query."""
    return _Tables(spark, sf_dir)


def register_tables(spark: SparkSession, sf_dir: str, suffix: str = "") -> list[str]:
    """Register every table as a temp view (A8); returns the view names."""
    names = []
    t = tables(spark, sf_dir)
    for n in (*TABLES, "partsupp"):
        t[n].createOrReplaceTempView(n + suffix)
        names.append(n + suffix)
    return names


def duckdb_prelude() -> str:
    """``WITH`` clause that rebuilds the derived tables in DuckDB under the
    names ``<table>_d`` from the raw views the checker registers."""
    ctes = []
    for n in ("lineitem", "orders", "customer", "supplier", "part"):
        extra = ", ".join(f"{e} AS {c}" for c, e in DERIVED[n])
        ctes.append(f"{n}_d AS (SELECT *, {extra} FROM {n})")
    ps_extra = ", ".join(f"{e} AS {c}" for c, e in PARTSUPP_COLUMNS)
    ctes.append("partsupp_d AS (SELECT *, " + ps_extra + " FROM (SELECT DISTINCT l_partkey AS ps_partkey, "
                "l_suppkey AS ps_suppkey FROM lineitem) ps0)")
    ctes.append("nation_d AS (SELECT * FROM nation)")
    ctes.append("region_d AS (SELECT * FROM region)")
    return "WITH " + ",\n".join(ctes) + "\n"
