"""Brute-force forecasting oracle (tests only).

Every candidate is refitted from scratch on each prefix of the series,
straight from its definition (closed-form weights, two-pass least squares),
and the selection rule is applied literally. Cubic in the series length --
only for short fixtures."""

import math


def _ses(ts, xs, alpha, f):
    """sum a^((t_n - t_i)/f) x_i / sum a^((t_n - t_i)/f) over the prefix."""
    tn = ts[-1]
    w = [alpha ** ((tn - t) / f) for t in ts]
    return sum(wi * x for wi, x in zip(w, xs)) / sum(w)


def _steps(ts, vs):
    prev = [(0.0, 0.0)] + list(zip(ts, vs))[:-1]
    return [(v - pv) / (t - pt) for (pt, pv), t, v in zip(prev, ts, vs)]


def fit(ts, vs, ses=0.75, trend=0.5):
    """(slope, intercept) of the seven candidates fitted on the whole prefix."""
    n, f = len(ts), ts[0]
    mt, mv = sum(ts) / n, sum(vs) / n
    var = sum((t - mt) ** 2 for t in ts) / n
    b = 0.0 if var == 0 else sum((t - mt) * (v - mv) for t, v in zip(ts, vs)) / n / var
    s = _steps(ts, vs)
    tn, vn = ts[-1], vs[-1]
    trend_slopes = [s[-1], sum(s) / n, _ses(ts, s, trend, f)]
    return ([(0.0, vn), (0.0, mv), (0.0, _ses(ts, vs, ses, f)), (b, mv - b * mt)]
            + [(k, vn - k * tn) for k in trend_slopes])


def select_series(ts, vs, at, ses=0.75, trend=0.5, err_alpha=0.75):
    """Prediction at ``at`` after each observation, and the chosen index."""
    out = []
    for n in range(1, len(ts) + 1):
        if n == 1:
            out.append((vs[0], None))
            continue
        fits = [fit(ts[:k], vs[:k], ses, trend) for k in range(1, n)]     # trained on rows <= k
        # the fit on rows 1..k is scored on row k + 1
        errs = [[(vs[k] - (bk * ts[k] + ak)) ** 2 for bk, ak in fk] for k, fk in enumerate(fits, start=1)]
        train_t = ts[:n - 1]
        maes = [_ses(train_t, [e[c] for e in errs], err_alpha, ts[0]) for c in range(7)]
        best = min(maes)
        c = max(i for i, m in enumerate(maes) if m <= best)
        bc, ac = fits[-1][c]
        out.append((bc * at + ac, c))
    return out


assert math.isclose(_ses([1.0, 2.0], [1.0, 4.0], 0.5, 1.0), 3.0)
