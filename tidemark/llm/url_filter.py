"""URL filters (operator 8), native: a Bloom filter cascade over the corpus's complete key universe.

Listed are sites (``casino-win.example.com`` lists the host and all its subdomains); the keys are hosts,
the universe every host of the pages. Building the cascade marks the distinct hosts that lie under a listed
site. Level 0 is a Bloom filter of the listed keys; level 1 one of the unlisted keys that level 0 lets
through; level 2 one of the listed keys that level 1 lets through; and so on until a level lets nothing
wrong through. A key of the universe is listed exactly when the first level that rejects it is an odd one,
or when it passes an odd number of levels in all; so membership is exact and the pages need no join: each
filter is a constant array of 64-bit words in their projection. Everything is DataFrame functions; the
driver learns counts and the filters, whose size is checked against ``max_bits``.

Rules stand above the list: a rule (host, path) fits its host and every subdomain when the url's path
starts with its path; the longest fitting rule decides, else the list does.

Defined cases: a null url, or one without ``://``, has empty host and path, fits no rule and is allowed.
Repeated urls and rows each give a row. An empty list allows whatever no rule blocks. Further columns are
ignored. Null list entries are ignored. Urls of any length are read whole; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored, table
from tidemark.llm.registry import register

WORD = 64
MAX_LEVELS = 64


def url_host(url: Column) -> Column:
    """A-Z lower-cased part after the first ``://`` up to ``/``, ``?``, ``#`` or the end; else empty."""
    raw = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def url_path(url: Column) -> Column:
    """The part from the end of the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffixes(host: Column) -> Column:
    """``a.b.c`` -> [a.b.c, b.c, c]; an empty host has none."""
    parts = F.split(host, r"\.")
    every = F.transform(F.sequence(F.lit(1), F.size(parts)),
                        lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(every)


def _bits(key: Column, level: int, m: int, k: int) -> Column:
    return F.array(*[F.pmod(F.xxhash64(key, F.lit(1000 * level + i)), F.lit(m)) for i in range(k)])


class _Level:
    """One Bloom filter: ``m`` bits (whole words), ``k`` hash functions."""

    def __init__(self, keys: DataFrame, level: int, n: int, others: int, max_bits: int):
        ratio = max(1.0, math.log2(max(others, 1) / max(n, 1))) if level == 0 else 1.0
        self.k = max(1, round(ratio))
        self.m = WORD * max(1, math.ceil(n * ratio * 1.4427 / WORD))
        if self.m > max_bits:
            raise ValueError(f"level {level} needs {self.m} bits, over the bound of {max_bits}")
        self.level = level
        words = self.m // WORD
        spark = keys.sparkSession
        bit = F.explode(_bits(F.col("key"), level, self.m, self.k)).alias("bit")
        on = keys.select(bit).select(F.floor(F.col("bit") / WORD).cast("int").alias("w"),
                                     F.expr("shiftleft(1L, cast(bit % 64 as int))").alias("b"))
        off = spark.range(words).select(F.col("id").cast("int").alias("w"), F.lit(0).cast("long").alias("b"))
        filter_ = (on.unionByName(off).groupBy("w").agg(F.bit_or("b").alias("b"))
                   .agg(F.sort_array(F.collect_list(F.struct("w", "b"))).alias("s"))
                   .select(F.transform("s", lambda x: x["b"]).alias("words")))
        self.array = stored(filter_, "bloom")  # one row; later levels and scans read it, none builds it again

    def passes(self, key: Column) -> Column:
        words = self.array.scalar()
        one = lambda p: F.getbit(F.get(words, F.floor(p / WORD).cast("int")), F.pmod(p, F.lit(WORD)).cast("int"))
        tests = [one(F.pmod(F.xxhash64(key, F.lit(1000 * self.level + i)), F.lit(self.m))) == 1
                 for i in range(self.k)]
        out = tests[0]
        for t in tests[1:]:
            out = out & t
        return out


class BloomCascade:
    """Exact membership for every key of ``universe`` (columns key, listed)."""

    def __init__(self, universe: DataFrame, max_bits: int = 1 << 26):
        self.levels: list[_Level] = []
        universe = stored(universe, "keys")
        n = universe.agg(F.count_if("listed").alias("r"), F.count_if(~F.col("listed")).alias("s")).first()
        left, others, side = n["r"], n["s"], True
        alive = universe
        while left and len(self.levels) < MAX_LEVELS:
            level = _Level(alive.where(F.col("listed") == side), len(self.levels), left, others, max_bits)
            self.levels.append(level)
            # whoever is on the other side and passes must be told apart by the next level
            alive = stored(alive.where((F.col("listed") == side) | level.passes(F.col("key"))), "keys")
            side = not side
            others, left = left, alive.where(F.col("listed") == side).count()
        if left:
            raise RuntimeError("the cascade did not converge")

    def listed(self, key: Column) -> Column:
        """True exactly for the listed keys, for any key of the universe."""
        out = F.lit(len(self.levels) % 2 == 1)  # passes every level
        for level in reversed(self.levels):
            out = F.when(level.passes(key), out).otherwise(F.lit(level.level % 2 == 1))
        return out


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest fitting rule as struct(rule, verdict); null without one."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule_host, rule_path, verdict in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        out = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
                     ).otherwise(out)
    return out


def url_filter(pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str, str]] = (),
               id_col: str = "page_id", url_col: str = "url", max_bits: int = 1 << 26) -> DataFrame:
    """page_id, host, path, rule, verdict, listed for every row of ``pages``; ``listed``: column key."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
    rows = rows.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    # distinct hosts first: the suffixes of a hot host are looked up once
    seen = rows.select(F.col("host").alias("key")).distinct()
    sites = listed.select(F.translate(F.col("key").cast("string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("site")).where("site is not null")
    under = (seen.select("key", F.explode(suffixes(F.col("key"))).alias("site"))
             .join(sites, "site", "left_semi").select("key"))
    universe = (seen.select("key", F.lit(False).alias("listed"))
                .unionByName(under.select("key", F.lit(True).alias("listed")))
                .groupBy("key").agg(F.bool_or("listed").alias("listed")))
    cascade = BloomCascade(universe, max_bits)
    hit = cascade.listed(F.col("host"))
    rule = rule_of(F.col("host"), F.col("path"), rules)
    out = rows.select("page_id", "host", "path", rule.alias("r"), hit.alias("listed"))
    return out.select("page_id", "host", "path", F.col("r.rule").alias("rule"),
                      F.coalesce(F.col("r.verdict"), F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"),
                      "listed")


# fixed values: the query's rules (host, path, verdict) and its list of sites
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block")]
SITES = [f"{name}.example.{top}" for name in ("ads-track", "spam-farm", "casino-win", "adult-x", "cheap-pills",
                                              "free-bets") for top in ("com", "net", "org")]

_RULE_SQL = " ".join(
    f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h}{p}'"
    for h, p, _ in sorted(RULES, key=lambda r: -len(r[0]) - len(r[1])))
_VERDICT_SQL = " ".join(f"WHEN '{h}{p}' THEN '{v}'" for h, p, v in RULES)


@register("op8_bloom_cascade", f"""
WITH p AS (SELECT page_id, translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                  coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path FROM pages),
r AS (SELECT *, CASE {_RULE_SQL} END AS rule,
      list_has_any([array_to_string(string_split(host, '.')[i:], '.') for i in range(1, len(string_split(host, '.')) + 1)],
                   {SITES!r}) AS listed FROM p)
SELECT page_id, host, path, rule,
       coalesce(CASE rule {_VERDICT_SQL} END, CASE WHEN listed THEN 'block' ELSE 'allow' END) AS verdict, listed
FROM r""")
def op8_bloom_cascade(spark, sf_dir):
    sites = spark.range(len(SITES)).select(
        F.get(F.array(*map(F.lit, SITES)), F.col("id").cast("int")).alias("key"))
    return url_filter(table(spark, sf_dir, "pages"), sites, RULES)
