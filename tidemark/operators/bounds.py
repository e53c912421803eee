"""Online SUM with confidence bounds over a join.

Fact rows are assigned to ``buckets`` clusters by a multiplicative hash of a
unit key (for lineitem: the order key, so an order is one cluster). The
bucket order is the bucket index, which the hash makes a random order of
clusters drawn without replacement. After m of B buckets:

    estimate   = B * mean(y_1..y_m)
    half_width = q_m * B * sqrt((1 - m/B) * s^2 / m)    (s^2: sample variance)

with q_m the Student t critical value on m - 1 degrees of freedom.

with y_b the bucket total (0 for a bucket no row reaches). At m = B the
estimate is exact and the half-width 0; at m = 1 the half-width is null.

Plan: one pass over the (filtered, joined) fact rows with a partial
aggregate per bucket -- B groups, combined map-side, so even a unit holding a
third of all rows costs one task-local partial. The B-row result is densified
against a B-row grid and walked with running windows. A bucket column can
also be written into the fact layout (``A14``) so an early stop after m
buckets prunes files instead of scanning them.
"""

from __future__ import annotations

import math
from functools import lru_cache
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.exprs import sql_rnd

# Fixed hash constants: Knuth's multiplicative constant and a 2^31 word.
HASH_MULT = 2654435761
HASH_WORD = 2147483648


def bucket_of(unit: Column, buckets: int) -> Column:
    """Bucket index in [0, buckets): high part of (unit * A mod 2^31).

    Every intermediate stays below 2^63 for any bigint unit key."""
    unit = F.pmod(F.coalesce(unit, F.lit(0)), F.lit(HASH_WORD))  # negative units have a bucket, null units that of 0
    h = (unit * F.lit(HASH_MULT)) % HASH_WORD
    return F.floor(h * buckets / F.lit(float(HASH_WORD))).cast("bigint")


def bucket_sql(unit: str, buckets: int) -> str:
    """The same bucket expression as DuckDB text."""
    return f"CAST((((coalesce({unit}, 0) % {HASH_WORD} + {HASH_WORD}) % {HASH_WORD}) * {HASH_MULT}) % {HASH_WORD} * {buckets} // {HASH_WORD} AS BIGINT)"


def z_value(confidence: float) -> float:
    return NormalDist().inv_cdf(0.5 + confidence / 2.0)


def _t_cdf(t: float, df: int) -> float:
    """Student's t for whole degrees of freedom: the elementary finite sums in the angle atan(t / sqrt(df))
    (Abramowitz and Stegun 26.7.3 for odd, 26.7.4 for even degrees)."""
    angle = math.atan(t / math.sqrt(df))
    cos2 = math.cos(angle) ** 2
    odd = df % 2
    term = math.cos(angle) if odd else 1.0
    total = 0.0
    for k in range(2 + odd, df + 1, 2):
        total += term
        term *= cos2 * (k - 1) / k
    inside = math.sin(angle) * total
    return 0.5 + 0.5 * ((angle + inside) * 2 / math.pi if odd else inside)


def t_value(confidence: float, df: int) -> float:
    """Two-sided Student t quantile (bisection on the CDF; driver-side, one
    number per step count)."""
    p = 0.5 + confidence / 2.0
    lo, hi = 0.0, 1e6
    for _ in range(200):
        mid = (lo + hi) / 2.0
        if _t_cdf(mid, df) < p:
            lo = mid
        else:
            hi = mid
    return round((lo + hi) / 2.0, 12)


@lru_cache(maxsize=64)
def quantiles(buckets: int, confidence: float, dist: str = "t") -> tuple[float, ...]:
    """Critical value per step m = 1..buckets (t with m - 1 degrees of
    freedom; z for ``dist="z"``). Step 1 has no interval; its entry is 0."""
    if dist == "z":
        return (z_value(confidence),) * buckets
    return (0.0,) + tuple(t_value(confidence, m - 1) for m in range(2, buckets + 1))


def looks(buckets: int, report_every: int) -> list[int]:
    """Steps at which a sequential sum reports: every so many buckets (two at least, as one has no variance), and the last."""
    return [m for m in range(report_every, buckets, report_every) if m > 1] + [buckets]


@lru_cache(maxsize=64)
def sequential_quantiles(buckets: int, confidence: float, report_every: int) -> tuple[float, ...]:
    """Critical value per step m = 1..buckets that holds at all looks together: Student t with the error shared equally by the looks
    before the last (which is exact). So it also holds at a look chosen by what was seen, as when stopping."""
    at = looks(buckets, report_every)[:-1]
    share = (1 - confidence) / max(1, len(at))
    return tuple(t_value(1 - share, m - 1) if m in at else 0.0 for m in range(1, buckets + 1))


def online_sum_ci(df: DataFrame, value: Column, unit: Column | None = None, buckets: int = 50,
                  confidence: float = 0.95, max_buckets: int | None = None, dist: str = "t",
                  bucket_col: str | None = None, scale: int = 6, digits: int = 2,
                  crit_values: tuple[float, ...] | None = None) -> DataFrame:
    """Rows ``(step, rows_seen, estimate, half_width)`` for steps 1..B
    (or 1..max_buckets, the WITHTIME-style cap on how far to go). The
    critical value is Student t with m - 1 degrees of freedom (``dist="z"``
    for the normal one).

    Buckets come from ``unit`` (hashed here) or from an existing column
    ``bucket_col`` -- e.g. the partition column of a fact table written with
    :func:`write_bucket_layout`. The cap is applied before the aggregate, so
    with such a layout Catalyst prunes the unread buckets' files.

    Values are summed as exact decimals of ``scale`` decimals (finer values
    are rounded to it), so totals do not depend on the order rows are added
    in; only the output is rounded, to ``digits``."""
    spark = df.sparkSession
    crit = "array(" + ", ".join(f"{q!r}D" for q in crit_values or quantiles(buckets, confidence, dist)) + ")"
    b = F.col(bucket_col).cast("bigint") if bucket_col else bucket_of(unit, buckets)
    if max_buckets is not None:
        df = df.where(b < max_buckets)
    exact = f"DECIMAL(38,{scale})"
    per = (df.select(b.alias("bucket"), value.cast(exact).alias("v"))
           .groupBy("bucket").agg(F.expr("sum(v) AS y"), F.expr("count(1) AS n")))
    grid = spark.range(buckets).withColumnRenamed("id", "bucket")
    dense = (grid.join(F.broadcast(per), "bucket", "left")
             .selectExpr("bucket", f"coalesce(y, CAST(0 AS {exact})) AS y", "coalesce(n, 0) AS n"))
    if max_buckets is not None:
        dense = dense.where(F.col("bucket") < max_buckets)
    w = "(ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    run = dense.selectExpr("bucket + 1 AS m", f"CAST(sum(y) OVER {w} AS DOUBLE) / (bucket + 1) AS mean",
                           f"var_samp(CAST(y AS DOUBLE)) OVER {w} AS var", f"sum(n) OVER {w} AS rows_seen")
    hw = (f"element_at({crit}, CAST(m AS INT)) * {float(buckets)!r}D * "
          f"sqrt(greatest(1.0D - CAST(m AS DOUBLE) / {buckets}, 0.0D) * var / m)")
    return run.selectExpr("CAST(m AS BIGINT) AS step", "CAST(rows_seen AS BIGINT) AS rows_seen",
                          f"{sql_rnd(f'{float(buckets)!r}D * mean', digits)} AS estimate",
                          f"{sql_rnd(hw, digits)} AS half_width")


def online_sum_sequential(df: DataFrame, value: Column, unit: Column | None = None, buckets: int = 50, confidence: float = 0.95,
                          report_every: int = 5, relative: float | None = None, **kw) -> DataFrame:
    """I9/I10 with a report interval and a stopping rule: rows ``(step, rows_seen, estimate, half_width, stop)`` at every
    ``report_every`` buckets, up to the first whose half-width is at most ``relative`` times the estimate
    (``stop``; without ``relative``, the last). The bounds hold at all reports together, see
    :func:`sequential_quantiles`. :func:`read_until` reads only what that needs."""
    crit = sequential_quantiles(buckets, confidence, report_every)
    steps = online_sum_ci(df, value, unit, buckets, confidence, crit_values=crit, **kw)
    steps = steps.where(F.col("step").isin(looks(buckets, report_every)))
    enough = F.col("step") == buckets
    if relative is not None:
        enough = enough | (F.col("half_width") <= F.abs("estimate") * relative)
    # one row a report
    first = F.min(F.when(enough, F.col("step"))).over(Window.partitionBy())
    return (steps.withColumn("__first", first).where(F.col("step") <= F.col("__first"))
            .withColumn("stop", F.col("step") == F.col("__first")).drop("__first"))


def read_until(spark, path: str, value: Column, buckets: int, relative: float, confidence: float = 0.95, report_every: int = 5,
               scale: int = 6, digits: int = 2) -> list[dict]:
    """The reports of :func:`online_sum_sequential` over a table that :func:`write_bucket_layout` wrote, reading the buckets of one
    report at a time (other folders are pruned) and none after the one that stops. The driver holds one total a bucket."""
    crit, exact = sequential_quantiles(buckets, confidence, report_every), f"decimal(38,{scale})"
    totals, rows, out, done = [0.0] * buckets, 0, [], 0
    for m in looks(buckets, report_every):
        part = spark.read.parquet(path).where((F.col("bucket") >= done) & (F.col("bucket") < m))
        for r in part.groupBy("bucket").agg(F.sum(value.cast(exact)).alias("y"), F.count(F.lit(1)).alias("n")).collect():
            totals[r["bucket"]] = float(r["y"] or 0)
            rows += r["n"]
        done, mean = m, math.fsum(totals[:m]) / m
        var = math.fsum((y - mean) ** 2 for y in totals[:m]) / (m - 1) if m > 1 else 0.0
        half = crit[m - 1] * buckets * math.sqrt(max(0.0, 1 - m / buckets) * var / m)
        stop = m == buckets or half <= abs(buckets * mean) * relative
        out.append({"step": m, "rows_seen": rows, "estimate": round(buckets * mean, digits), "half_width": round(half, digits), "stop": stop})
        if stop:
            break
    return out


def write_bucket_layout(df: DataFrame, unit: Column, path: str, buckets: int = 50) -> None:
    """A14 for I9: fact rows laid out by bucket (one folder per bucket), so
    reading the first m buckets reads only their files."""
    df.withColumn("bucket", bucket_of(unit, buckets)).write.mode("overwrite").partitionBy("bucket").parquet(path)


def online_sum_sql(base: str, value: str, unit: str, buckets: int = 50, confidence: float = 0.95,
                   round_sql=None, dist: str = "t", scale: int = 6, digits: int = 2, crit_values: tuple[float, ...] | None = None) -> str:
    """DuckDB twin of :func:`online_sum_ci`; ``base`` selects the joined,
    filtered fact rows."""
    crit = "[" + ", ".join(repr(q) for q in crit_values or quantiles(buckets, confidence, dist)) + "]"
    r = round_sql
    exact = f"DECIMAL(38,{scale})"
    return f"""
, base AS ({base}),
per AS (SELECT {bucket_sql(unit, buckets)} AS bucket,
               sum(CAST({value} AS {exact})) AS y, count(*) AS n
        FROM base GROUP BY 1),
dense AS (SELECT g.range AS bucket, coalesce(per.y, CAST(0 AS {exact})) AS y, coalesce(per.n, 0) AS n
          FROM range({buckets}) g LEFT JOIN per ON per.bucket = g.range),
run AS (SELECT bucket + 1 AS m, CAST(sum(y) OVER w AS DOUBLE) / (bucket + 1) AS mean,
               var_samp(CAST(y AS DOUBLE)) OVER w AS var,
               sum(n) OVER w AS rows_seen
        FROM dense WINDOW w AS (ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT CAST(m AS BIGINT) AS step, CAST(rows_seen AS BIGINT) AS rows_seen,
       {r(f'{float(buckets)} * mean', digits)} AS estimate,
       {r(f'{crit}[m] * {float(buckets)} * sqrt(greatest(1.0 - CAST(m AS DOUBLE) / {buckets}, 0.0) * var / m)', digits)} AS half_width
FROM run
"""
