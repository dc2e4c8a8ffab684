"""Volatility models per security: naive baselines and GARCH-family fits.

Baselines are window expressions.  For the GARCH fits securities are dealt by
key; a task takes its daily returns as they stream in, and fits many securities
at the same time: one step of all their simplexes is a few passes over the days,
each a numpy operation over the securities.  What is held is a bounded number of
returns, or one security's history, whose length is the number of trading days it
has existed (not the size of the table).
"""
from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import written


def baselines(rets: DataFrame, key: str = "permno", date: str = "date", ret: str = "ret") -> DataFrame:
    """Forecasts of the squared log return: the expanding mean of past
    squared returns and the random walk (yesterday's squared return), with
    their squared errors."""
    w = Window.partitionBy(key).orderBy(date)
    lr = F.log(F.col(ret) + 1)
    base = (rets.filter(F.col(ret).isNotNull()).select(key, date, lr.alias("lr"))
            .select(key, date, "lr", (F.col("lr") * F.col("lr")).alias("r2")))
    past = w.rowsBetween(Window.unboundedPreceding, -1)
    f = base.select("*", F.avg("r2").over(past).alias("f_mean"), F.lag("r2").over(w).alias("f_rw"))
    return f.select(key, date, "lr", "r2", "f_mean", "f_rw",
                    ((F.col("r2") - F.col("f_mean")) ** 2).alias("se_mean"),
                    ((F.col("r2") - F.col("f_rw")) ** 2).alias("se_rw"))


# ------------------------------------------------------------------ GARCH
#: returns of the securities that are fitted at the same time, and rows of a task
HELD, TASK_ROWS = 1 << 21, 2_000_000
#: with fewer securities than this every point a step may need is tried in one pass
FEW = 256


def _nelder_mead(f, x0: np.ndarray, iters: int = 400, tol: float = 1e-9) -> tuple[np.ndarray, np.ndarray]:
    """Plain Nelder-Mead simplex minimiser (no external optimiser here), one
    simplex for each row of ``x0``; ``f(rows, points)``: values at the points, one
    for each row named.  A simplex moves as it would alone."""
    m, n = x0.shape
    pts = np.repeat(x0[:, None].astype(float), n + 1, axis=1)
    for i in range(n):
        pts[:, i + 1, i] += np.where(x0[:, i] == 0, 0.5, 0.25 * np.abs(x0[:, i]) + 0.1)
    at = np.arange(m)
    vals = np.stack([f(at, pts[:, i]) for i in range(n + 1)], axis=1)
    for _ in range(iters):
        order = np.argsort(vals[at], axis=1)
        pts[at], vals[at] = pts[at[:, None], order], vals[at[:, None], order]
        with np.errstate(invalid="ignore"):
            at = at[~(np.abs(vals[at, -1] - vals[at, 0]) <= tol * (1 + np.abs(vals[at, 0])))]
        if not len(at):
            break
        p, v = pts[at], vals[at]
        c = np.mean(p[:, :-1], axis=1)
        tried = np.stack([c + (c - p[:, -1]), c + 2 * (c - p[:, -1]), c + 0.5 * (p[:, -1] - c)])
        if len(at) < FEW:
            fr, fe, fc = f(np.tile(at, 3), tried.reshape(-1, n)).reshape(3, -1)
            far, near = fr < v[:, 0], ~(fr < v[:, 0]) & ~(fr < v[:, -2])
        else:
            fr = f(at, tried[0])
            far, near = fr < v[:, 0], ~(fr < v[:, 0]) & ~(fr < v[:, -2])
            fe, fc = np.full(len(at), np.inf), np.full(len(at), np.inf)
            turn = np.concatenate([np.flatnonzero(far), np.flatnonzero(near)])
            got = f(at[turn], np.concatenate([tried[1, far], tried[2, near]]))
            fe[far], fc[near] = got[:far.sum()], got[far.sum():]
        stretched, pulled = far & (fe < fr), near & (fc < v[:, -1])
        for which, point, value in ((~near & ~stretched, tried[0], fr), (stretched, tried[1], fe), (pulled, tried[2], fc)):
            pts[at[which], -1], vals[at[which], -1] = point[which], value[which]
        shrunk = at[near & ~pulled]
        if len(shrunk):
            pts[shrunk, 1:] = pts[shrunk, :1] + 0.5 * (pts[shrunk, 1:] - pts[shrunk, :1])
            vals[shrunk, 1:] = f(np.repeat(shrunk, n), pts[shrunk, 1:].reshape(-1, n)).reshape(-1, n)
    best = np.argmin(vals, axis=1)
    return pts[np.arange(m), best], vals[np.arange(m), best]


def _exp(x):
    """The simplex has no bounds: beyond the largest double it is infinite."""
    return np.where(x < 709, np.exp(np.minimum(x, 709)), np.inf)


def _sig(x):
    return 1.0 / (1.0 + _exp(-x))


def _weights(model: str, theta: np.ndarray) -> tuple:
    """omega, alpha, gamma, beta of each row of ``theta``."""
    w, a = _exp(theta[:, 0]), _sig(theta[:, 1])
    if model == "garch":
        return w, a, np.zeros(len(theta)), _sig(theta[:, 2]) * (1 - a)
    g = _sig(theta[:, 2])
    return w, a, g, _sig(theta[:, 3]) * np.maximum(1e-9, 1 - a - 0.5 * g)


def _nlls(model: str, theta: np.ndarray, e: np.ndarray, sizes: np.ndarray, v0: np.ndarray) -> np.ndarray:
    """Negative Gaussian log-likelihoods, one for each row of ``theta`` and column
    of ``e``: demeaned returns by day, longest series first (``sizes``: days)."""
    with np.errstate(all="ignore"):
        w, a, g, b = _weights(model, theta)
        on_deviation = model == "tgarch"
        state = np.sqrt(v0) if on_deviation else v0.copy()
        ll, part, logs, var = (np.zeros(len(w)) for _ in range(4))
        alive = np.searchsorted(-sizes, -np.arange(len(e)), "left")     # series with more than t days
        for t in range(len(e)):
            if alive[t] < len(w):
                w, a, g, b, state, part, logs, var = (x[:alive[t]] for x in (w, a, g, b, state, part, logs, var))
            x = e[t, :len(w)]
            if t:
                prev = e[t - 1, :len(w)]
                state *= b
                if model == "garch":
                    np.multiply(a, prev, out=part)
                else:
                    np.less(prev, 0, out=part)
                    part *= g
                    part += a
                    part *= np.abs(prev, out=logs) if on_deviation else prev
                if not on_deviation:
                    part *= prev
                part += w
                state += part
            if on_deviation:
                np.maximum(np.multiply(state, state, out=var), 1e-300, out=var)
            else:
                var = np.maximum(state, 1e-300, out=state)
            np.multiply(x, x, out=part)
            part /= var
            part += np.log(var, out=logs)
            ll[:len(w)] += part
        return np.where(np.isnan(ll), np.inf, 0.5 * (ll + sizes * math.log(2 * math.pi)))


def _nll(model: str, theta, e: list[float], v0: float) -> float:
    """Negative Gaussian log-likelihood of the demeaned returns ``e``."""
    return float(_nlls(model, np.array([theta], float), np.array(e, float)[:, None], np.array([len(e)]), np.array([v0]))[0])


def _params(model: str, theta) -> dict:
    with np.errstate(all="ignore"):
        return dict(zip(("omega", "alpha", "gamma", "beta"), (float(x[0]) for x in _weights(model, np.array([theta], float)))))


FIT_SCHEMA = ("permno long, model string, n long, omega double, alpha double, gamma double, "
              "beta double, loglik double, aic double, reason string")
_FITS = pa.schema([("permno", pa.int64()), ("model", pa.string()), ("n", pa.int64()),
                   *((c, pa.float64()) for c in ("omega", "alpha", "gamma", "beta", "loglik", "aic")), ("reason", pa.string())])


def fit_series(series: list[tuple]) -> list[dict]:
    """GARCH(1,1), GJR-GARCH(1,1,1) and TGARCH(1,1,1) of every (key, returns in
    order of date)."""
    rows, fitted = [], []
    for key, ret in series:
        with np.errstate(all="ignore"):
            r = np.log1p(ret)   # log returns
        r = r[np.isfinite(r)]
        reason = "short series" if len(r) < 30 else "flat series" if not np.var(r) else None
        if reason:   # a row that says why there is no fit
            rows += [{"permno": key, "model": m, "n": len(r), "reason": reason} for m in ("garch", "gjr", "tgarch")]
        else:
            fitted.append((key, r - r.mean(), float(np.var(r))))
    if not fitted:
        return rows
    fitted.sort(key=lambda x: -len(x[1]))
    sizes, v0 = np.array([len(r) for _, r, _ in fitted]), np.array([v for _, _, v in fitted])
    e = np.zeros((sizes[0], len(fitted)))
    for j, (_, r, _) in enumerate(fitted):
        e[:len(r), j] = r
    for model, first, rest in (("garch", np.log(v0 * 0.1), (-2.0, 2.0)), ("gjr", np.log(v0 * 0.1), (-2.5, -2.5, 2.0)),
                               ("tgarch", np.log(np.sqrt(v0) * 0.1), (-2.5, -2.5, 2.0))):
        def value(at, points, model=model):
            order = np.argsort(at, kind="stable")       # longest series first
            pick = at[order]
            out = np.empty(len(at))
            out[order] = _nlls(model, points[order], e[:sizes[pick[0]], pick], sizes[pick], v0[pick])
            return out
        theta, nll = _nelder_mead(value, np.column_stack([first, np.tile(rest, (len(first), 1))]), iters=250)
        k = len(rest) + 2
        for j, (key, r, _) in enumerate(fitted):
            rows.append({"permno": key, "model": model, "n": len(r), **_params(model, theta[j]),
                         "loglik": -nll[j], "aic": 2 * k + 2 * nll[j], "reason": None})
    return rows


def fit_group(pdf: pd.DataFrame) -> pd.DataFrame:
    """The three fits of one security; ``pdf``: permno, date, ret."""
    pdf = pdf.sort_values("date")
    key = None if pdf["permno"].isna().iloc[0] else int(pdf["permno"].iloc[0])
    return pd.DataFrame(fit_series([(key, pdf["ret"].to_numpy(dtype=float))]), columns=_FITS.names)


def _fitted(batches):
    """Rows (key, return) come sorted by key and date; a key's rows may span batches."""
    key, parts, series, held = None, [], [], 0

    def found():
        rows = fit_series(series)
        return pa.RecordBatch.from_pydict({c: [r.get(c) for r in rows] for c in _FITS.names}, schema=_FITS)
    for batch in batches:
        keys, ret = batch.column(0).to_pylist(), batch.column(1).to_numpy(zero_copy_only=False)
        cuts = [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1]]
        for lo, hi in zip(cuts, [*cuts[1:], len(keys)], strict=True):
            if parts and keys[lo] != key:
                series.append((key, np.concatenate(parts)))
                held, parts = held + len(series[-1][1]), []
                if held >= HELD:
                    yield found()
                    series, held = [], 0
            key = keys[lo]
            parts.append(ret[lo:hi])
    if parts:
        series.append((key, np.concatenate(parts)))
        yield found()


def garch_fits(rets: DataFrame, key: str = "permno") -> DataFrame:
    """The fits of every security: dealt by key, as many tasks as there are
    cores, or more if a task would hold more than ``TASK_ROWS`` returns."""
    known = written(rets.filter(F.col("ret").isNotNull()).select(F.col(key).cast("long").alias("permno"), "date", F.col("ret").cast("double").alias("ret")))
    tasks = max(rets.sparkSession.sparkContext.defaultParallelism, math.ceil(known.count() / TASK_ROWS))
    dealt = known.repartition(tasks, "permno").sortWithinPartitions("permno", F.asc_nulls_last("date"), "ret")
    return dealt.select("permno", "ret").mapInArrow(_fitted, FIT_SCHEMA)
