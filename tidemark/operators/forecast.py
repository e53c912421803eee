"""Forecasting the final answer from running answers.

Input rows are observations ``(keys..., t, v)`` with t > 0 increasing per
series. For every row the operators give the prediction at ``final_time``
using the rows up to and including it.

A candidate is an :class:`Estimator`: it keeps running weighted means of quantities of the observations and
reads a line (slope, intercept) off them. Its two methods are plain arithmetic, so the same class runs on
Columns here and on numbers in :mod:`tidemark.streaming.forecast_state`; a user's own candidates go into the same list.

All of it is window functions, linear in the series length. The weight of observation i seen from n is
``alpha ** ((t_n - t_i) / t_1)``. Running sums of weighted terms are prefix sums with the weight turned round
(``alpha ** (-(t_i - base) / t_1)``), which would overflow on a long series, so a series is cut into blocks in which the turned weight stays
below 2**512, each with its own base. A row adds the prefix sum of its block and that of the block before, aged; what is
older weighs less than 2**-512 and is left out.

Default candidates (index in the selector, complexity k):

0 tail          v_n                                              k=1
1 mean          avg(v_1..v_n)                                    k=1
2 ses(a)        sum a^((t_n-t_i)/f) v_i / sum a^((t_n-t_i)/f)    k=1, f = t_1
3 ols           least-squares line (slope 0 when var(t) = 0)     k=2
4 trend tail    last step slope through (t_n, v_n)               k=2
5 trend mean    mean step slope through (t_n, v_n)               k=2
6 trend ses(b)  ses of step slopes through (t_n, v_n)            k=2

Step slopes are (v_i - v_{i-1}) / (t_i - t_{i-1}) with (t_0, v_0) = (0, 0); a repeated time has none, and quantities
that are null are left out of the means.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the default selector: candidate smoothing bases and the
# smoothing base of the rolling squared error.
SES_ALPHA = 0.75
TREND_SES_ALPHA = 0.5
ERROR_ALPHA = 0.75
BLOCK = 512  # halvings of a weight within one block

# ---------------------------------------------------------------- candidates


@dataclass
class Observation:
    """What a candidate sees of an observation; Columns in batch, numbers on a stream."""
    t: object
    v: object
    step: object    # slope from the observation before
    first_t: object
    first_v: object


def ratio(a, b, otherwise=0.0):
    """a / b, or ``otherwise`` where b is 0."""
    if isinstance(a, Column) or isinstance(b, Column):
        b = b if isinstance(b, Column) else F.lit(b)
        return F.when(b == 0, F.lit(otherwise)).otherwise(F.try_divide(a if isinstance(a, Column) else F.lit(a), b))
    return otherwise if b == 0 else a / b


class Estimator:
    """One candidate. ``observe`` names the quantities of an observation whose running means it needs, ``line`` gives
    slope and intercept from those means and the newest observation. Both may use + - * / and :func:`ratio` only."""
    name = "estimator"
    complexity = 1
    alpha = 1.0  # in (0, 1]; 1: all observations weigh the same

    def observe(self, x: Observation) -> dict:
        return {}

    def line(self, mean: dict, x: Observation) -> tuple:
        raise NotImplementedError


class Tail(Estimator):
    name = "tail"

    def line(self, mean, x):
        return 0.0, x.v


class Mean(Estimator):
    """Mean value; with ``alpha`` below 1 an exponential smoother."""

    def __init__(self, name: str = "mean", alpha: float = 1.0):
        self.name, self.alpha = name, alpha

    def observe(self, x):
        return {"v": x.v}

    def line(self, mean, x):
        return 0.0, mean["v"]


class LeastSquares(Estimator):
    """Line of least squares, in coordinates that begin at the first observation."""
    name = "ols"
    complexity = 2

    def observe(self, x):
        t, v = x.t - x.first_t, x.v - x.first_v
        return {"t": t, "v": v, "tt": t * t, "tv": t * v}

    def line(self, mean, x):
        slope = ratio(mean["tv"] - mean["t"] * mean["v"], mean["tt"] - mean["t"] * mean["t"])
        return slope, x.first_v + mean["v"] - slope * (x.first_t + mean["t"])


class TrendTail(Estimator):
    name = "trend_tail"
    complexity = 2

    def line(self, mean, x):
        return x.step, x.v - x.step * x.t


class TrendMean(Estimator):
    """Mean step slope through the newest observation; with ``alpha`` below 1 a smoothed one."""
    complexity = 2

    def __init__(self, name: str = "trend_mean", alpha: float = 1.0):
        self.name, self.alpha = name, alpha

    def observe(self, x):
        return {"step": x.step}

    def line(self, mean, x):
        return mean["step"], x.v - mean["step"] * x.t


def default_candidates(ses_alpha: float = SES_ALPHA, trend_alpha: float = TREND_SES_ALPHA) -> list[Estimator]:
    return [Tail(), Mean(), Mean("ses", ses_alpha), LeastSquares(), TrendTail(), TrendMean(),
            TrendMean("trend_ses", trend_alpha)]


MODELS = [e.name for e in default_candidates()]
COMPLEXITY = [e.complexity for e in default_candidates()]


def checked(candidates: list[Estimator]) -> list[Estimator]:
    """Candidates, of which there is one at least, with weights that fall."""
    if not candidates or any(not 0 < e.alpha <= 1 for e in candidates):
        raise ValueError("give one candidate at least, each with alpha in (0, 1]")
    return candidates


# ---------------------------------------------------------------- batch form

def _col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _lit(x) -> Column:
    return x if isinstance(x, Column) else F.lit(float(x))


def weighted_means(df: DataFrame, keys: list[str], order: list[str], t: str, first_t: str, alpha: float,
                   values: dict[str, Column]) -> DataFrame:
    """Add, under each name, the running mean of a value, in which an observation weighs
    ``alpha ** ((t_n - t_i) / t_1)``; nulls are left out. ``t`` and ``first_t`` name the time and the series' first."""
    if not values:
        return df
    by, sort = [_col(k) for k in keys], [_col(o) for o in order]
    row = Window.partitionBy(*by).orderBy(*sort)
    if alpha == 1:
        return df.select("*", *[F.avg(x).over(row.rowsBetween(Window.unboundedPreceding, 0)).alias(n) for n, x in values.items()])
    halvings = -math.log2(alpha)
    own = list(df.columns)
    block = Window.partitionBy(*by, "__block").orderBy(*sort).rowsBetween(Window.unboundedPreceding, 0)
    age = lambda x: F.try_divide(x, F.col(first_t)) * halvings
    d = df.withColumn("__block", F.floor(age(F.col(t)) / BLOCK))
    d = d.withColumn("__base", F.first(t).over(block))
    d = d.withColumn("__w", F.pow(F.lit(2.0), age(F.col(t) - F.col("__base"))))
    sums = []
    for i, x in enumerate(values.values()):
        x = x.cast("double")
        sums += [F.sum(F.col("__w") * x).over(block).alias(f"__p{i}"),
                 F.sum(F.when(x.isNotNull(), F.col("__w"))).over(block).alias(f"__q{i}")]
    d = d.select("*", *sums)
    parts = ["__base"] + [f"__{x}{i}" for i in range(len(values)) for x in "pq"]
    d = d.withColumn("__last", F.lag(F.struct(*parts)).over(row))
    d = d.withColumn("__before", F.first("__last").over(block))  # of the block before: what its last row has
    d = d.withColumn("__aged", F.pow(F.lit(2.0), -age(F.col("__base") - F.col("__before.__base"))))
    both = lambda x: F.coalesce(F.col(x), F.lit(0.0)) + F.coalesce(F.col(f"__before.{x}") * F.col("__aged"), F.lit(0.0))
    return d.select(*[_col(c) for c in own],
                    *[F.try_divide(both(f"__p{i}"), F.nullif(both(f"__q{i}"), F.lit(0.0))).alias(n) for i, n in enumerate(values)])


def with_models(df: DataFrame, keys: list[str], t: str, v: str, candidates: list[Estimator],
                order: list[str] | None = None, prefix: str = "") -> DataFrame:
    """Add ``{prefix}b{i}`` and ``{prefix}a{i}``: slope and intercept of candidate i fitted on the rows up to each row.
    Also ``__t``, ``__v`` and ``__first_t``; the caller drops them."""
    order = order or [t]
    row = Window.partitionBy(*[_col(k) for k in keys]).orderBy(*[_col(o) for o in order])
    running = row.rowsBetween(Window.unboundedPreceding, 0)
    d = df.withColumns({"__t": _col(t).cast("double"), "__v": _col(v).cast("double")})
    d = d.withColumns({"__step": F.try_divide(F.col("__v") - F.lag("__v", 1, 0.0).over(row), F.col("__t") - F.lag("__t", 1, 0.0).over(row)),
                       "__first_t": F.first("__t").over(running), "__first_v": F.first("__v").over(running)})
    x = Observation(*(F.col(c) for c in ("__t", "__v", "__step", "__first_t", "__first_v")))
    names, by_alpha = [], {}
    for i, e in enumerate(checked(candidates)):
        observed = {f"__m{i}_{n}": _lit(q) for n, q in e.observe(x).items()}
        names.append({n[len(f"__m{i}_"):]: n for n in observed})
        by_alpha.setdefault(e.alpha, {}).update(observed)
    for alpha, values in by_alpha.items():
        d = weighted_means(d, keys, order, "__t", "__first_t", alpha, values)
    lines = {}
    for i, (e, own) in enumerate(zip(candidates, names)):
        slope, icpt = e.line({n: F.col(c) for n, c in own.items()}, x)
        lines |= {f"{prefix}b{i}": _lit(slope), f"{prefix}a{i}": _lit(icpt)}
    return d.withColumns(lines).drop("__step", "__first_v", *[c for own in names for c in own.values()])


def _named(model: str | Estimator, ses_alpha: float, trend_alpha: float) -> Estimator:
    if isinstance(model, Estimator):
        return model
    return next(e for e in default_candidates(ses_alpha, trend_alpha) if e.name == model)


def forecast_cell(df: DataFrame, keys: list[str], t: str, v: str, final_time, model: str | Estimator,
                  out: str = "forecast", order: list[str] | None = None,
                  ses_alpha: float = SES_ALPHA, trend_alpha: float = TREND_SES_ALPHA) -> DataFrame:
    """One model's prediction at ``final_time`` after each row. Only that model is planned."""
    d = with_models(df, keys, t, v, [_named(model, ses_alpha, trend_alpha)], order, "__")
    return d.withColumn(out, F.col("__b0") * _lit(final_time) + F.col("__a0")).drop("__b0", "__a0", "__t", "__v", "__first_t")


def model_params(df: DataFrame, keys: list[str], t: str, v: str, model: str | Estimator,
                 order: list[str] | None = None, ses_alpha: float = SES_ALPHA,
                 trend_alpha: float = TREND_SES_ALPHA) -> DataFrame:
    """K6: a model as (slope, intercept) columns after each row."""
    d = with_models(df, keys, t, v, [_named(model, ses_alpha, trend_alpha)], order, "__")
    return d.withColumnsRenamed({"__b0": "slope", "__a0": "intercept"}).drop("__t", "__v", "__first_t")


def forecast_select(df: DataFrame, keys: list[str], t: str, v: str, final_time, out: str = "forecast",
                    order: list[str] | None = None, ses_alpha: float = SES_ALPHA,
                    trend_alpha: float = TREND_SES_ALPHA, error_alpha: float = ERROR_ALPHA,
                    with_choice: bool = False, candidates: list[Estimator] | None = None) -> DataFrame:
    """Model selection by smoothed one-step-ahead squared error.

    Row k's candidates (fit on rows <= k) are scored at row k+1; errors are
    smoothed with SES(error_alpha) on the training time t_k. The answer at
    row n uses the candidate with the lowest smoothed error over k < n, fit
    on rows < n (the newest row is held back); ties go to the last
    candidate, and one without a score never wins. With nothing scored yet (first row) it predicts the row's
    own value. ``candidates``: the defaults, or any list of :class:`Estimator`."""
    order = order or [t]
    candidates = candidates or default_candidates(ses_alpha, trend_alpha)
    n = len(candidates)
    row = Window.partitionBy(*[_col(k) for k in keys]).orderBy(*[_col(o) for o in order])
    d = with_models(df, keys, t, v, candidates, order, "__")
    d = d.withColumns({"__nt": F.lead("__t").over(row), "__nv": F.lead("__v").over(row)})
    error = {f"__e{i}": F.pow(F.col("__nv") - (F.col(f"__b{i}") * F.col("__nt") + F.col(f"__a{i}")), 2) for i in range(n)}
    d = weighted_means(d, keys, order, "__t", "__first_t", error_alpha, error)
    scored = [F.struct(F.coalesce(F.col(f"__e{i}"), F.lit(float("inf"))).alias("m"), F.lit(-i).alias("neg"),
                       F.col(f"__b{i}").alias("b"), F.col(f"__a{i}").alias("a")) for i in range(n)]
    # the best after the row before, fitted up to that row
    d = d.withColumn("__best", F.lag(F.array_min(F.array(*scored))).over(row))
    d = d.withColumn(out, F.when(F.col("__best").isNull(), F.col("__v"))
                     .otherwise(F.col("__best.b") * _lit(final_time) + F.col("__best.a")))
    if with_choice:
        d = d.withColumn(out + "_model", -F.col("__best.neg"))
    return d.drop("__t", "__v", "__first_t", "__nt", "__nv", "__best",
                  *[f"__{x}{i}" for i in range(n) for x in "abe"])


def forecast_table(df: DataFrame, keys: list[str], values: list[str], step: str, final_time,
                   **kw) -> DataFrame:
    """An independent selector per value column and per key; value
    columns are replaced by their forecasts. ``step`` is the table's step
    counter (1 for the first snapshot), so a key that first appears late
    starts its series at a larger t.

    The value columns are unpivoted into one long set of series keyed by
    (keys, column), forecast in one pass, and pivoted back on the row id
    (``step`` + keys), so the plan does not grow with the number of columns."""
    ids = [c for c in df.columns if c not in values]
    long = (df.select(*ids, *[F.col(v).cast("double").alias(v) for v in values])
            .unpivot(ids, values, "__col", "__val"))
    fcst = forecast_select(long, keys + ["__col"], step, "__val", final_time, out="__fc", **kw)
    wide = fcst.groupBy(*ids).pivot("__col", values).agg(F.first("__fc"))
    return wide.select(*[_col(c) for c in df.columns])


# ---------------------------------------------------------------- scores

def information_criteria(k: Column, log_l: Column, n: Column) -> dict[str, Column]:
    """AIC = 2k - 2lnL, AICc = AIC + (2k^2 + 2k) / (n - k - 1), BIC = k ln n - 2 lnL."""
    aic = F.lit(2.0) * k - F.lit(2.0) * log_l
    aicc = aic + F.try_divide(F.lit(2.0) * k * k + F.lit(2.0) * k, n - k - F.lit(1.0))
    bic = k * F.log(n.cast("double")) - F.lit(2.0) * log_l
    return {"aic": aic, "aicc": aicc, "bic": bic}


def least_square_loglik(rss: Column, n: Column) -> Column:
    """-n ln(RSS/n) / 2 (null when RSS is 0: a perfect fit)."""
    return F.when(rss > 0, -n * F.log(rss / n) / F.lit(2.0))


# ---------------------------------------------------------------- SQL twin

DEFAULT_LINES = [("0.0", "v"), ("0.0", "mv"), ("0.0", "sv"), ("ob", "mv - ob * mt"), ("s", "v - s * t"),
                 ("ms", "v - ms * t"), ("ss", "v - ss * t")]


def forecast_select_sql(src: str, keys: list[str], value: str, final_time: float, round_sql,
                        ses_alpha: float = SES_ALPHA, trend_alpha: float = TREND_SES_ALPHA,
                        error_alpha: float = ERROR_ALPHA, prefix: str = "fs",
                        lines: list[tuple[str, str]] = DEFAULT_LINES) -> str:
    """DuckDB text for :func:`forecast_select` over the CTE ``src`` (columns
    ``part_idx, keys..., t, <value>``); an independent formulation: smoothed
    averages in closed form (sum a^((t_n - t_i)/f) x_i / sum a^(...)) by
    self-joins, candidates as columns, ties to the last candidate by a CASE
    chain. ``lines`` gives each candidate's slope and intercept over the columns
    v, t, s (last step slope), f and fv (first t and v), mv, mt, ms (means), ob (least-squares slope), sv and
    ss (smoothed v and s). Ends with CTE ``{prefix}_out (part_idx, keys..., t, v, forecast,
    forecast_model)``; the caller adds the final SELECT."""
    n = len(lines)
    ks = ", ".join(keys)
    on = " AND ".join([f"a.{k} IS NOT DISTINCT FROM b.{k}" for k in keys] or ["TRUE"])
    part = f"PARTITION BY {ks} " if keys else ""
    w0 = f"({part}ORDER BY t)"
    wr = f"({part}ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    ga = ", ".join(["a.part_idx"] + [f"a.{k}" for k in keys])
    use = ", ".join(["part_idx"] + keys)
    T = f"{float(final_time)!r}"
    p = prefix
    bs = [f"b{i}" for i in range(n)]
    as_ = [f"a{i}" for i in range(n)]
    errs = ",\n  ".join(f"power(nv - (b{i} * nt + a{i}), 2) AS e{i}" for i in range(n))
    wsum = lambda alpha, col: (f"sum(power({alpha!r}, (a.t - b.t) / a.f) * b.{col}) / "
                               f"sum(power({alpha!r}, (a.t - b.t) / a.f))")
    maes = ",\n  ".join(f"{wsum(error_alpha, f'e{i}')} AS m{i}" for i in range(n))
    chain = " ".join(f"WHEN m{i} <= mm THEN {i}" for i in reversed(range(n)))
    slopes = ", ".join(f"{b} AS b{i}" for i, (b, _) in enumerate(lines))
    icpts = ", ".join(f"{a} AS a{i}" for i, (_, a) in enumerate(lines))
    prev = ", ".join(f"lag({c}) OVER {w0} AS p{c}" for c in bs + as_)
    pick = " ".join(f"WHEN {i} THEN pb{i} * {T} + pa{i}" for i in range(n))
    return f"""
, {p}_st AS (SELECT part_idx, {ks + ', ' if keys else ''}t, CAST({value} AS DOUBLE) AS v,
    min(t) OVER ({part.strip()}) AS f, first_value(CAST({value} AS DOUBLE)) OVER {w0} AS fv,
    (CAST({value} AS DOUBLE) - coalesce(lag(CAST({value} AS DOUBLE)) OVER {w0}, 0.0))
      / (t - coalesce(lag(t) OVER {w0}, 0.0)) AS s FROM {src}),
{p}_sm AS (SELECT {ga}, {wsum(ses_alpha, 'v')} AS sv, {wsum(trend_alpha, 's')} AS ss
  FROM {p}_st a JOIN {p}_st b ON {on} AND b.t <= a.t GROUP BY {ga}),
{p}_m AS (SELECT x.*, y.sv, y.ss, avg(v) OVER {wr} AS mv, avg(t) OVER {wr} AS mt, avg(s) OVER {wr} AS ms,
    CASE WHEN var_pop(t) OVER {wr} = 0 THEN 0.0 ELSE covar_pop(t, v) OVER {wr} / var_pop(t) OVER {wr} END AS ob
  FROM {p}_st x JOIN {p}_sm y USING ({use})),
{p}_p AS (SELECT *, {slopes}, {icpts},
    lead(t) OVER {w0} AS nt, lead(v) OVER {w0} AS nv FROM {p}_m),
{p}_e AS (SELECT *, {errs} FROM {p}_p),
{p}_mae AS (SELECT {ga}, count(b.t) AS nscored, {maes}
  FROM {p}_e a LEFT JOIN {p}_e b ON {on} AND b.t < a.t GROUP BY {ga}),
{p}_c AS (SELECT e.*, q.nscored, least({', '.join(f'q.m{i}' for i in range(n))}) AS mm,
    {', '.join(f'q.m{i}' for i in range(n))}, {prev} FROM {p}_e e JOIN {p}_mae q USING ({use})),
{p}_out AS (SELECT part_idx, {ks + ', ' if keys else ''}t, v,
    CASE WHEN nscored = 0 OR pb0 IS NULL THEN v ELSE CASE (CASE {chain} ELSE 0 END) {pick} END END AS forecast,
    CASE WHEN nscored > 0 THEN (CASE {chain} ELSE 0 END) END AS forecast_model FROM {p}_c)
"""
