"""GARCH fits on series that send the simplex far out."""
import datetime as dt
import math

import numpy as np
import pandas as pd

from sparkfin.operators import volatility as V


def test_steps_far_out_are_refused_not_an_error():
    e, far = [0.01, -0.02, 0.03] * 20, 2000.0
    for model, n in (("garch", 3), ("gjr", 4), ("tgarch", 4)):
        for at in range(n):
            for x in (-far, far):
                theta = [-9.0, -2.0, -2.0, 2.0][:n]
                theta[at] = x
                assert V._nll(model, theta, e, 4e-4) > -math.inf
                V._params(model, theta)
    assert V._nll("garch", [far, -2.0, 2.0], e, 4e-4) == math.inf


def test_a_series_without_key_and_one_whose_best_weight_is_zero():
    rng = np.random.default_rng(1)
    for seed in range(3):
        jumps = np.where(rng.random(120) < 0.1, 3.0, 0.0) + rng.normal(0, 1e-6, 120)
        got = V.fit_group(pd.DataFrame({"permno": [None] * 120, "date": range(120), "ret": np.expm1(jumps)}))
        assert got["permno"].isna().all() and list(got["model"]) == ["garch", "gjr", "tgarch"]
        assert np.isfinite(got["loglik"]).all()


def _alone(model, theta, e, v0):
    """The likelihood day by day, for one series."""
    sig = [1 / (1 + math.exp(-x)) for x in theta]
    w, a, g = math.exp(theta[0]), sig[1], 0.0 if model == "garch" else sig[2]
    b = sig[2] * (1 - a) if model == "garch" else sig[3] * max(1e-9, 1 - a - 0.5 * g)
    ll, state = 0.0, math.sqrt(v0) if model == "tgarch" else v0
    for t, x in enumerate(e):
        if t:
            c, prev = a + g * (e[t - 1] < 0), e[t - 1]
            state = w + (c * abs(prev) if model == "tgarch" else c * prev * prev) + b * state
        var = max(state * state if model == "tgarch" else state, 1e-300)
        ll += math.log(var) + x * x / var
    return 0.5 * (ll + len(e) * math.log(2 * math.pi))


def _history(seed, days):
    return np.random.default_rng(seed).standard_t(4, days) * 0.02


def test_likelihoods_of_many_series_are_those_of_each():
    sizes = np.array([90, 60, 60, 31])
    e = np.zeros((90, 4))
    for j, n in enumerate(sizes):
        e[:n, j] = _history(j, n)
    v0 = np.array([np.var(e[:n, j]) for j, n in enumerate(sizes)])
    for model, k in (("garch", 3), ("gjr", 4), ("tgarch", 4)):
        theta = np.random.default_rng(k).normal(0, 1, (4, k)) - [8, *[0] * (k - 1)]
        got = V._nlls(model, theta, e, sizes, v0)
        for j, n in enumerate(sizes):
            assert math.isclose(got[j], _alone(model, theta[j], e[:n, j].tolist(), v0[j]), rel_tol=1e-12)


def test_securities_fitted_together_are_fitted_as_alone(spark):
    rows = [(k, d, float(np.expm1(x))) for k in (None, 1, 2, 3, 4) for d, x in enumerate(_history(k or 9, 20 if k == 3 else 40 + (k or 0) * 7))]
    rows += [(5, d, 0.0) for d in range(40)] + [(4, None, 0.5), (4, 3, None)]
    rets = spark.createDataFrame([(k, None if d is None else dt.date(2020, 1, 1) + dt.timedelta(d), x) for k, d, x in rows], "permno long, date date, ret double")
    alone = pd.concat([V.fit_group(x) for _, x in rets.filter("ret is not null").toPandas().groupby("permno", dropna=False)])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 25)
    try:
        got = V.garch_fits(rets).toPandas()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == 18 and got.groupby("permno", dropna=False)["model"].nunique().eq(3).all()
    assert set(got[got.permno == 3].reason) == {"short series"} and set(got[got.permno == 5].reason) == {"flat series"}
    a, b = (x.sort_values(["permno", "model"]).reset_index(drop=True) for x in (alone, got))
    pd.testing.assert_frame_equal(a.astype({"permno": float}), b.astype({"permno": float}), check_dtype=False, rtol=1e-9)


def test_points_of_many_simplexes_are_tried_in_few_passes(monkeypatch):
    calls, real = [], V._nlls
    monkeypatch.setattr(V, "_nlls", lambda *a: calls.append(len(a[1])) or real(*a))
    V.fit_series([(k, np.expm1(_history(k, 35))) for k in range(40)])
    assert len(calls) < 3 * 2 * 260 and max(calls) >= 40       # not some hundreds for each security
