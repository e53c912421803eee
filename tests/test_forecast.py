"""Forecasting operators on the reference's fixed cases (FIXTURES 3) and
against a brute-force row-by-row selector."""

import math
import random

import pytest
from pyspark.sql import functions as F

from forecast_ref import select_series
from tidemark.operators import forecast as fc


def _series(spark, ts, vs, key="k"):
    return spark.createDataFrame([(key, i, float(t), float(v)) for i, (t, v) in enumerate(zip(ts, vs))],
                                 "key string, seq int, t double, v double")


def _cell(spark, model, ts, vs, at, alpha):
    df = fc.forecast_cell(_series(spark, ts, vs), ["key"], "t", "v", at, model, order=["seq"],
                          ses_alpha=alpha, trend_alpha=alpha)
    return [r.forecast for r in df.orderBy("seq").collect()]


def test_tail_mean_ses(spark):
    assert _cell(spark, "tail", [1, 2, 3, 5], [1, 2, -6, 27], 10, 0.5) == [1, 2, -6, 27]
    assert _cell(spark, "mean", [1, 2, 3, 5], [1, 2, -6, 27], 10, 0.5) == [1, 1.5, -1, 6]
    assert _cell(spark, "ses", [1, 2, 3, 5, 10000], [1, 4, -5.75, 15.25, 100], 10000, 0.5) == [1, 3, -2, 10, 100]


def test_trend_lines(spark):
    assert _cell(spark, "trend_tail", [1, 2, 3, 5], [1, 2, -6, 27], 10, 0.5) == [10, 10, -62, 109.5]
    assert _cell(spark, "trend_mean", [1, 2, 3, 5], [1, 1.5, 3, 7], 10, 0.5) == [10, 7.5, 10, 13.25]
    got = _cell(spark, "trend_ses", [1, 2, 3, 5], [1, 1.25, 1.4, 2], 10, 0.5)
    assert all(abs(a - b) < 1e-4 for a, b in zip(got, [10, 5.25, 3.5, 3.5]))


@pytest.mark.parametrize("vs,slope,icpt", [([1, 2.5, 1.5, 2.5, 3.5, 5], 1, 0), ([11, 12.5, 11.5, 12.5, 13.5, 15], 1, 10)])
def test_ols_with_repeated_times(spark, vs, slope, icpt):
    r = fc.model_params(_series(spark, [1, 2, 2, 3, 3, 5], vs), ["key"], "t", "v", "ols", order=["seq"])
    last = r.orderBy(F.col("seq").desc()).first()
    for t in (0.0, 17.0, 999.0):
        assert abs((last.slope * t + last.intercept) - (slope * t + icpt)) < 1e-4


def _select(spark, ts, vs, at, alpha=0.5):
    df = fc.forecast_select(_series(spark, ts, vs), ["key"], "t", "v", at, order=["seq"], ses_alpha=alpha,
                            with_choice=True)
    return [(r.forecast, r.forecast_model) for r in df.orderBy("seq").collect()]


def test_selector_affine_convergent_log(spark):
    ts = [1, 2, 3, 5, 10, 12]
    out = _select(spark, ts, [5 * t + 10 for t in ts], 100.0)
    assert abs(out[-1][0] - 510) < 1e-4
    ts = list(range(1, 102))
    assert abs(_select(spark, ts, [100 - 100 / t for t in ts], 1100.0)[-1][0] - 100) < 10
    ts = list(range(1, 100))
    assert abs(_select(spark, ts, [math.log(t) for t in ts], 200.0)[-1][0] - math.log(200)) < 1


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_selector_matches_brute_force(spark, seed):
    rnd = random.Random(seed)
    ts = sorted(rnd.sample(range(1, 60), 14))
    vs = [rnd.uniform(-5, 5) + 0.3 * t for t in ts]
    got = _select(spark, ts, vs, 80.0, alpha=0.75)
    want = select_series([float(t) for t in ts], vs, 80.0, ses=0.75)
    for (g, gi), (w, wi) in zip(got, want):
        assert abs(g - w) < 1e-6 * max(1.0, abs(w))
        assert wi is None or gi == wi


def _cities(t):
    # six series: population grows linearly with t; area linear, zero or constant
    return [("K1", "S1", "C1", t * 100.0, t * 1.5), ("K1", "S1", "C2", t * 200.0, t * 0.0),
            ("K1", "S2", "C3", t * 300.0, 2.5), ("K1", "S2", "C4", t * 400.0, 3.5),
            ("K2", "S3", "C5", t * 500.0, 4.5), ("K2", "S3", "C6", t * 600.0, t * 0.0)]


KEYS = ["country", "state", "city"]
SCHEMA = "step double, country string, state string, city string, population double, area double"


def test_table_forecast_exact_from_second_step(spark):
    final = 10
    rows = [(float(t), *r) for t in range(1, final) for r in _cities(float(t))]
    out = fc.forecast_table(spark.createDataFrame(rows, SCHEMA), KEYS, ["population", "area"], "step", float(final))
    want = {r[:3]: r[3:] for r in _cities(float(final))}
    for r in out.where("step >= 2").collect():
        assert (r.population, r.area) == want[(r.country, r.state, r.city)]
    assert out.where("step = 1").count() == 6


def test_table_forecast_late_keys(spark):
    mid, final = 12, 20
    rows = [(float(t), *r) for t in range(1, mid) for r in _cities(float(t))[:3]]
    rows += [(float(t), *r) for t in range(mid, final) for r in _cities(float(t))]
    out = fc.forecast_table(spark.createDataFrame(rows, SCHEMA), KEYS, ["population", "area"], "step", float(final))
    want = {r[:3]: r[3:] for r in _cities(float(final))}
    for r in out.where("step >= 2").collect():
        late = r.city not in ("C1", "C2", "C3")
        if late and r.step <= mid:
            continue
        assert (r.population, r.area) == want[(r.country, r.state, r.city)]


def test_information_criteria():
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    df = spark.createDataFrame([(2.0, -10.0, 20.0)], "k double, ll double, n double")
    ic = fc.information_criteria(F.col("k"), F.col("ll"), F.col("n"))
    r = df.select(*[v.alias(k) for k, v in ic.items()]).first()
    assert r.aic == 24.0
    assert abs(r.aicc - (24.0 + 12.0 / 17.0)) < 1e-12
    assert abs(r.bic - (2 * math.log(20) + 20)) < 1e-12


@pytest.mark.parametrize("seed", [5, 6, 7])
def test_state_step_matches_brute_force(seed):
    """The keyed-state update used on streams gives the selector's answers."""
    from tidemark.streaming.forecast_state import step
    rnd = random.Random(seed)
    ts = [float(t) for t in sorted(rnd.sample(range(1, 80), 20))]
    vs = [rnd.uniform(-3, 3) + 0.5 * t for t in ts]
    want = select_series(ts, vs, 90.0, ses=0.75, trend=0.5)
    st = None
    for (t, v), (w, wi) in zip(zip(ts, vs), want):
        st, pred, choice = step(st, t, v, 90.0)
        assert abs(pred - w) <= 1e-9 * max(1.0, abs(w)) and choice == wi


@pytest.mark.parametrize("alpha", [0.75, 0.01, 0.999])
def test_long_series_in_linear_time(spark, alpha):
    """10,000 steps of one key: block-wise prefix sums against the recursion, step by step."""
    rnd = random.Random(3)
    ts, t = [], 0.0
    for _ in range(10_000):
        t += rnd.choice([0.25, 1.0, 1.0, 700.0])
        ts.append(t)
    vs = [math.sin(x / 50) * 1e3 + x for x in ts]
    got = _cell(spark, "ses", ts, vs, 1.0, alpha)
    mean, weight, last = 0.0, 0.0, ts[0]
    for x, v, g in zip(ts, vs, got):
        weight = 1.0 + weight * alpha ** ((x - last) / ts[0])
        mean += (v - mean) / weight
        last = x
        assert abs(g - mean) <= 1e-9 * max(1.0, abs(mean), abs(v))


def test_selector_over_a_long_series_equals_the_steps(spark):
    from tidemark.streaming.forecast_state import step
    rnd = random.Random(9)
    ts = [float(t) for t in range(1, 3001)]
    vs = [math.log(t) * 1e4 + rnd.uniform(-1, 1) for t in ts]
    got = _select(spark, ts, vs, 4000.0, alpha=0.75)
    state = None
    for (f, _), t, v in zip(got, ts, vs):
        state, want, _ = step(state, t, v, 4000.0)
        assert abs(f - want) <= 1e-6 * abs(want)


def test_only_the_model_asked_for_is_planned(spark):
    df = _series(spark, [1, 2], [1, 2])
    plan = fc.forecast_cell(df, ["key"], "t", "v", 9.0, "tail", order=["seq"])._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "avg(" not in plan and "pow" not in plan.lower()
    assert "collect_list" not in fc.forecast_select(df, ["key"], "t", "v", 9.0)._jdf.queryExecution().optimizedPlan().toString()


class Half(fc.Estimator):
    """A user's own candidate: half of the mean value, weighted."""
    name = "half"
    alpha = 0.5

    def observe(self, x):
        return {"half": x.v / 2}

    def line(self, mean, x):
        return fc.ratio(x.step, x.t) * 0, mean["half"]


def test_own_candidates_in_batch_and_in_steps(spark):
    from tidemark.streaming.forecast_state import step
    own = [Half(), fc.Tail(), Half()]
    ts, vs = [1.0, 2.0, 4.0, 5.0, 9.0], [8.0, 4.0, 2.0, 1.0, 0.5]
    df = fc.forecast_select(_series(spark, ts, vs), ["key"], "t", "v", 20.0, order=["seq"], with_choice=True, candidates=own)
    state = None
    for r, t, v in zip(df.orderBy("seq").collect(), ts, vs):
        state, forecast, choice = step(state, t, v, 20.0, own)
        assert abs(r.forecast - forecast) < 1e-12 and r.forecast_model == choice
    assert {r.forecast_model for r in df.collect()} <= {None, 1, 2}  # of two alike the last
    with pytest.raises(ValueError):
        fc.checked([])
