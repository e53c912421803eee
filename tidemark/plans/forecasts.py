"""Forecasts of the final answer from the running answers of online Q1
(J1-J10, H15, H16, M45).

The series are online Q1's snapshots: per (l_returnflag, l_linestatus) the
running ``sum_qty`` at step t = part_idx + 1, forecast to the last step
(t = 10). The oracles rebuild the same snapshots in DuckDB and use windows
(J1, J2, J4-J6) or a self-join with closed-form weights (J3, J7).
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import functions as F

from tidemark.functions.exprs import rnd, sql_rnd as R
from tidemark.operators import forecast as fc
from tidemark.plans.online_queries import N_PARTS, Q1_SPEC, q1_snapshots
from tidemark.operators.online import online_sql
from tidemark.plans.registry import register

c = F.col
KEYS = ["l_returnflag", "l_linestatus"]
FINAL_T = float(N_PARTS)

SNAP_SQL = online_sql("SELECT * FROM lineitem_d WHERE l_shipdate <= DATE '1998-09-02'", "l_orderkey % 10",
                      N_PARTS, Q1_SPEC, R, as_cte="snap")
SERIES_SQL = SNAP_SQL + """, ser AS (SELECT part_idx, l_returnflag, l_linestatus,
    CAST(part_idx + 1 AS DOUBLE) AS t, sum_qty AS v FROM snap)
"""
W = "PARTITION BY l_returnflag, l_linestatus ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
OUT = "part_idx, l_returnflag, l_linestatus, t, v"


def series(spark, sf_dir):
    snaps = q1_snapshots(spark, sf_dir)
    return snaps.select("part_idx", *KEYS, (c("part_idx") + 1).cast("double").alias("t"), c("sum_qty").alias("v"))


def _cell(model):
    def build(spark, sf_dir):
        out = fc.forecast_cell(series(spark, sf_dir), KEYS, "t", "v", FINAL_T, model)
        return out.withColumn("forecast", rnd("forecast", 2))
    return build


def _ses_sql(value_expr: str, alpha: float, src: str) -> str:
    """Closed form sum a^((t_n - t_i)/f) x_i / sum a^((t_n - t_i)/f) by self-join."""
    return f"""
SELECT a.part_idx, a.l_returnflag, a.l_linestatus,
  sum(power({alpha}, (a.t - b.t) / a.f) * b.{value_expr}) / sum(power({alpha}, (a.t - b.t) / a.f)) AS sm
FROM {src} a JOIN {src} b ON a.l_returnflag = b.l_returnflag AND a.l_linestatus = b.l_linestatus AND b.t <= a.t
GROUP BY a.part_idx, a.l_returnflag, a.l_linestatus"""


STEP_SQL = """, st AS (SELECT *, min(t) OVER (PARTITION BY l_returnflag, l_linestatus) AS f,
    (v - coalesce(lag(v) OVER (PARTITION BY l_returnflag, l_linestatus ORDER BY t), 0.0))
      / (t - coalesce(lag(t) OVER (PARTITION BY l_returnflag, l_linestatus ORDER BY t), 0.0)) AS s FROM ser)
"""

register("fc_tail", SERIES_SQL + f"SELECT {OUT}, {R('v')} AS forecast FROM ser")(_cell("tail"))
register("fc_mean", SERIES_SQL + f"SELECT {OUT}, {R(f'avg(v) OVER ({W})')} AS forecast FROM ser")(_cell("mean"))
register("fc_ses", SERIES_SQL + STEP_SQL + f", sm AS ({_ses_sql('v', fc.SES_ALPHA, 'st')})\n"
         f"SELECT {OUT}, {R('sm.sm')} AS forecast FROM st JOIN sm USING (part_idx, l_returnflag, l_linestatus)"
         )(_cell("ses"))
register("fc_ols", SERIES_SQL + f""", o AS (SELECT *, var_pop(t) OVER ({W}) AS vt, covar_pop(t, v) OVER ({W}) AS cv,
    avg(t) OVER ({W}) AS mt, avg(v) OVER ({W}) AS mv FROM ser),
o2 AS (SELECT *, CASE WHEN vt = 0 THEN 0.0 ELSE cv / vt END AS b FROM o)
SELECT {OUT}, {R(f'b * {FINAL_T} + (mv - b * mt)')} AS forecast FROM o2""")(_cell("ols"))
register("fc_trend_tail", SERIES_SQL + STEP_SQL +
         f"SELECT {OUT}, {R(f's * {FINAL_T} + (v - s * t)')} AS forecast FROM st")(_cell("trend_tail"))
register("fc_trend_mean", SERIES_SQL + STEP_SQL + f", st2 AS (SELECT *, avg(s) OVER ({W}) AS b FROM st)\n"
         f"SELECT {OUT}, {R(f'b * {FINAL_T} + (v - b * t)')} AS forecast FROM st2")(_cell("trend_mean"))
register("fc_trend_ses", SERIES_SQL + STEP_SQL + f", sm AS ({_ses_sql('s', fc.TREND_SES_ALPHA, 'st')})\n"
         f"SELECT {OUT}, {R(f'sm.sm * {FINAL_T} + (v - sm.sm * t)')} AS forecast "
         f"FROM st JOIN sm USING (part_idx, l_returnflag, l_linestatus)")(_cell("trend_ses"))


@register("fc_select", SERIES_SQL + fc.forecast_select_sql("ser", KEYS, "v", FINAL_T, R) +
          f"SELECT part_idx, l_returnflag, l_linestatus, t, v, {R('forecast')} AS forecast, forecast_model "
          f"FROM fs_out")
def fc_select(spark, sf_dir):
    """J8 on each series; ``forecast_model`` is the chosen candidate index."""
    out = fc.forecast_select(series(spark, sf_dir), KEYS, "t", "v", FINAL_T, with_choice=True)
    return out.withColumn("forecast", rnd("forecast", 2))


class Drift(fc.Estimator):
    """Line through the first and the newest observation."""
    name = "drift"
    complexity = 2

    def line(self, mean, x):
        slope = fc.ratio(x.v - x.first_v, x.t - x.first_t)
        return slope, x.v - slope * x.t


class DampedTrend(fc.Estimator):
    """A share of the smoothed step slope through the newest observation."""
    name = "damped_trend"
    complexity = 2
    alpha = fc.TREND_SES_ALPHA

    def __init__(self, share: float = 0.5):
        self.share = share

    def observe(self, x):
        return {"step": x.step}

    def line(self, mean, x):
        slope = self.share * mean["step"]
        return slope, x.v - slope * x.t


CUSTOM = [fc.Tail(), fc.LeastSquares(), Drift(), DampedTrend()]
CUSTOM_LINES = [fc.DEFAULT_LINES[0], fc.DEFAULT_LINES[3],
                ("CASE WHEN t = f THEN 0.0 ELSE (v - fv) / (t - f) END",
                 "v - (CASE WHEN t = f THEN 0.0 ELSE (v - fv) / (t - f) END) * t"),
                ("0.5 * ss", "v - 0.5 * ss * t")]


@register("fc_select_custom", SERIES_SQL + fc.forecast_select_sql("ser", KEYS, "v", FINAL_T, R, lines=CUSTOM_LINES) +
          f"SELECT part_idx, l_returnflag, l_linestatus, t, v, {R('forecast')} AS forecast, forecast_model "
          f"FROM fs_out")
def fc_select_custom(spark, sf_dir):
    """K6: the selector over a candidate list with two estimators of a user's own."""
    out = fc.forecast_select(series(spark, sf_dir), KEYS, "t", "v", FINAL_T, with_choice=True, candidates=CUSTOM)
    return out.withColumn("forecast", rnd("forecast", 2))


VALUE_COLS = ["sum_qty", "sum_base_price", "sum_disc_price", "sum_charge", "avg_qty", "avg_price",
              "avg_disc", "count_order"]


FC_TABLE_SQL = (SNAP_SQL + ", wide AS (SELECT part_idx, l_returnflag, l_linestatus, CAST(part_idx + 1 AS DOUBLE) AS t, "
                + ", ".join(f"CAST({v} AS DOUBLE) AS {v}" for v in VALUE_COLS) + " FROM snap),\n"
                + "long AS (UNPIVOT wide ON " + ", ".join(VALUE_COLS) + " INTO NAME col VALUE val)\n"
                + fc.forecast_select_sql("long", KEYS + ["col"], "val", FINAL_T, R, prefix="ft")
                + "SELECT part_idx, l_returnflag, l_linestatus, "
                + ", ".join(f"{R(f'max(CASE WHEN col = {chr(39)}{v}{chr(39)} THEN forecast END)', 4)} AS {v}"
                            for v in VALUE_COLS)
                + " FROM ft_out GROUP BY part_idx, l_returnflag, l_linestatus")


@register("fc_table", FC_TABLE_SQL)
def fc_table(spark, sf_dir):
    """Online Q1's snapshots with every value column replaced by
    its forecast of the final answer (step counter = part_idx + 1)."""
    snaps = (q1_snapshots(spark, sf_dir).withColumn("step", (c("part_idx") + 1).cast("double"))
             .withColumn("count_order", c("count_order").cast("double")))
    out = fc.forecast_table(snaps.select("part_idx", "step", *KEYS, *VALUE_COLS), KEYS, VALUE_COLS, "step", FINAL_T)
    return out.select("part_idx", *KEYS, *[rnd(v, 4).alias(v) for v in VALUE_COLS])


@register("ic_scores", SERIES_SQL + f""", fit AS (
  SELECT l_returnflag, l_linestatus, count(*) AS n,
    CASE WHEN var_pop(t) = 0 THEN 0.0 ELSE covar_pop(t, v) / var_pop(t) END AS b, avg(t) AS mt, avg(v) AS mv
  FROM ser GROUP BY l_returnflag, l_linestatus),
rs AS (SELECT f.l_returnflag, f.l_linestatus, f.n, sum(power(s.v - (f.b * s.t + (f.mv - f.b * f.mt)), 2)) AS rss
  FROM fit f JOIN ser s USING (l_returnflag, l_linestatus) GROUP BY f.l_returnflag, f.l_linestatus, f.n),
ll AS (SELECT *, CASE WHEN rss > 0 THEN -n * ln(rss / n) / 2.0 END AS loglik FROM rs)
SELECT l_returnflag, l_linestatus, CAST(n AS BIGINT) AS n, {R('loglik', 4)} AS loglik,
  {R('2.0 * 2 - 2.0 * loglik', 4)} AS aic,
  {R('2.0 * 2 - 2.0 * loglik + (2.0 * 2 * 2 + 2.0 * 2) / NULLIF(n - 2 - 1.0, 0)', 4)} AS aicc,
  {R('2 * ln(n) - 2.0 * loglik', 4)} AS bic
FROM ll""")
def ic_scores(spark, sf_dir):
    """Information criteria of the least-squares line fitted to
    each whole series (k = 2)."""
    s = series(spark, sf_dir).persist(StorageLevel.MEMORY_AND_DISK)   # fitted, then scored
    fit = s.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("n"),
        F.when(F.var_pop("t") == 0, 0.0).otherwise(F.try_divide(F.covar_pop("t", "v"), F.var_pop("t"))).alias("b"),
        F.avg("t").alias("mt"), F.avg("v").alias("mv"))
    rss = (s.join(fit, KEYS)
           .groupBy(*KEYS, "n").agg(F.sum(F.pow(c("v") - (c("b") * c("t") + (c("mv") - c("b") * c("mt"))), 2))
                                    .alias("rss")))
    ll = rss.withColumn("loglik", fc.least_square_loglik(c("rss"), c("n").cast("double")))
    ic = fc.information_criteria(F.lit(2.0), c("loglik"), c("n").cast("double"))
    return ll.select(*KEYS, c("n").cast("bigint").alias("n"), rnd("loglik", 4).alias("loglik"),
                     *[rnd(v, 4).alias(k) for k, v in ic.items()])
