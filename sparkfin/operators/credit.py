"""Distance to default: Merton-model inputs, solve and output.

Inputs are one DataFrame plan (joins + windows).  The solve is an expression:
root finding by ``aggregate`` over a bracket inside the row, so it runs in the
JVM wherever the row is and needs no grouping or ordering.
"""
from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import ffill_limit, rint_n, z
from ..session import by_key, written
from .aggregates import rolling_deviation
from .panel import dedup_first, dedup_last

RATE_SERIES = "BUILDING"   # macro series standing in for the 1-year rate
VOL_DAYS = 252
TOLERANCE = 1e-6    # relative residual of a solved row


def rate_series(macro: DataFrame, series: str = RATE_SERIES) -> DataFrame:
    """Percent to fraction: forward fill two published dates, round to 4
    places, then divide by 100 (that order)."""
    w = Window.partitionBy("series_key").orderBy("date")
    m = macro.filter(F.col("series_key") == series)
    return m.select("date", (rint_n(ffill_limit("value", w, 2), 4) / 100).alias("trate_1y_dd"))


def dtd_inputs(dsf: DataFrame, macro: DataFrame, link: DataFrame, fundq: DataFrame) -> DataFrame:
    """Per firm-quarter: equity value, lagged book debt, 252-day equity
    volatility and the 1-year rate.

    The daily file is the large input.  Its rows are written once, so that the
    volatility window is dealt by security into tasks of a bounded size; the month-end reduction keeps one row per security-month before
    the join with the quarterly fundamentals.  The rate table has one row
    per calendar day (bounded by the calendar, not by the data), so the
    planner may broadcast it.
    """
    daily = dsf.select("date", "permno", "cusip",
                      (F.abs("prc") * F.col("shrout") / 1000).alias("mcap_crsp_dd"), "ret").distinct()
    daily = by_key(written(daily.join(rate_series(macro), "date", "left")), "permno")
    daily = rolling_deviation(daily, "ret", "permno", "date", VOL_DAYS, "sd_12M_dd") \
        .withColumn("sd_12M_dd", F.col("sd_12M_dd") * math.sqrt(VOL_DAYS))
    daily = daily.withColumn("month_end", F.last_day("date"))
    monthly = dedup_last(daily, ["permno", "month_end"], ["date"]).select(
        F.col("month_end").alias("date"), "permno", "mcap_crsp_dd", "sd_12M_dd", "trate_1y_dd")

    ccm = (link.filter(F.col("linktype").isin("LU", "LC") & F.col("linkprim").isin("P", "C")))
    ccm = dedup_first(ccm, ["gvkey"], ["linkdt", "lpermno"]).select("gvkey", F.col("lpermno").alias("permno"))

    wq = Window.partitionBy("gvkey").orderBy("date")
    comp = fundq.select("gvkey", "cusip", F.col("datadate").alias("date"), "dlcq", "dlttq", "conm")
    comp = comp.withColumn("bv_debt_dd", F.lag(z("dlcq") + 0.5 * z("dlttq"), 1).over(wq))
    comp = comp.join(ccm, "gvkey", "left")
    out = comp.join(monthly, ["date", "permno"], "left")
    return out.select("date", "conm", "gvkey", "cusip", "mcap_crsp_dd", "bv_debt_dd", "sd_12M_dd",
                      "trate_1y_dd")


# ---------------------------------------------------------------- solver
# fixed values: numerator and denominator of Hart's rational form of the normal tail
_NUM = (3.52624965998911e-02, 0.700383064443688, 6.37396220353165, 33.912866078383, 112.079291497871,
        221.213596169931, 220.206867912376)
_DEN = (8.83883476483184e-02, 1.75566716318264, 16.064177579207, 86.7807322029461, 296.564248779674,
        637.333633378831, 793.826512519948, 440.413735824752)


#: halvings of the bracket: a width of 10,000 comes down to 5e-16
HALVINGS = 64


def _poly(coefficients, x) -> F.Column:
    out = F.lit(coefficients[0])
    for c in coefficients[1:]:
        out = out * x + F.lit(c)
    return out


def _let(value, use) -> F.Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _upper_tail(a) -> F.Column:
    e = F.exp(F.lit(-0.5) * a * a)
    far = e / (a + 1 / (a + 2 / (a + 3 / (a + 4 / (a + 0.65))))) / math.sqrt(2 * math.pi)
    return F.when(a < 7.07106781186547, e * _poly(_NUM, a) / _poly(_DEN, a)).otherwise(far)


def norm_cdf(x) -> F.Column:
    """Standard normal distribution function: a rational form near 0, a
    continued fraction in the far tail."""
    return _let(x, lambda v: _let(F.least(F.abs(v), F.lit(37.0)), lambda a: _let(
        _upper_tail(a), lambda tail: F.when(v > 0, 1 - tail).otherwise(tail))))


def _at(d2, E, D, vol, use) -> F.Column:
    """``use(d2, s, V)`` of the asset volatility and value that both equations
    give for a d2: vol E = s V N(d1) and E = V N(d1) - D N(d2)."""
    return _let(d2, lambda d2: _let(E + D * norm_cdf(d2), lambda held: _let(
        vol * E / held, lambda s: _let(held / norm_cdf(d2 + s), lambda v: use(d2, s, v)))))


def merton(E, D, vol) -> F.Column:
    """d2 of the Merton model (T = 1) with E = V N(d1) - D N(d2) and
    vol E = s V N(d1).

    Given d2 both equations are explicit in s and V; what is left is that d2
    is the one of that s and V, one equation whose left side falls from plus to
    minus infinity.  Its root is bracketed by E <= V <= E + D and
    vol E / (E + D) <= s <= vol and halved inside the row."""
    least = vol * E / (E + D)
    start = F.struct((F.least(F.log(E / D), F.lit(0.0)) / least - vol / 2).alias("lo"), (F.log1p(E / D) / least).alias("hi"))

    def halve(b, _):
        return _at((b["lo"] + b["hi"]) / 2, E, D, vol, lambda mid, s, v: F.when(
            F.log(v / D) - s * s / 2 - s * mid > 0, F.struct(mid.alias("lo"), b["hi"].alias("hi"))).otherwise(F.struct(b["lo"].alias("lo"), mid.alias("hi"))))
    return F.aggregate(F.sequence(F.lit(1), F.lit(HALVINGS)), start, halve, lambda b: (b["lo"] + b["hi"]) / 2)


def prepare_for_solve(inputs: DataFrame) -> DataFrame:
    """Debt null or zero becomes 0.01; rows without volatility are dropped."""
    debt = F.when(F.col("bv_debt_dd").isNull() | (F.col("bv_debt_dd") == 0), F.lit(0.01)) \
        .otherwise(F.col("bv_debt_dd"))
    return inputs.withColumn("bv_debt_dd", debt).filter(F.col("sd_12M_dd").isNotNull())


def dtd_solve(inputs: DataFrame) -> DataFrame:
    """Asset value and volatility, distance to default, how far both equations
    are from holding (relative to the equity) and whether that is within
    ``TOLERANCE``; rows without positive equity, debt and volatility, or without
    a rate, have none of them."""
    df = prepare_for_solve(inputs)
    E, D, vol = F.col("mcap_crsp_dd"), F.col("pv_debt"), F.col("sd_12M_dd")
    df = df.withColumn("pv_debt", F.col("bv_debt_dd") * F.exp(-F.col("trate_1y_dd")))
    ok = F.coalesce((E > 0) & (D > 0) & (vol > 0), F.lit(False))
    df = df.withColumn("_d2", F.when(ok, merton(E, D, vol)))
    df = df.withColumn("_a", F.when(ok, _at(F.col("_d2"), E, D, vol, lambda _, s, v: F.struct(v.alias("v"), s.alias("s")))))
    df = df.withColumn("asset_value_a", F.col("_a.v")).withColumn("volatility_a", F.col("_a.s"))
    V, S = F.col("asset_value_a"), F.col("volatility_a")
    d1 = (F.log(V / D) + S * S / 2) / S
    miss = F.greatest(F.abs(V * norm_cdf(d1) - D * norm_cdf(d1 - S) - E) / E, F.abs(S * V * norm_cdf(d1) / (E * vol) - 1))
    return df.withColumn("dtd", (V - D) / (V * S)).withColumn("residual", F.when(ok, miss)) \
        .withColumn("converged", F.coalesce(F.col("residual") < TOLERANCE, F.lit(False))) \
        .select("date", "conm", "gvkey", "cusip", "mcap_crsp_dd", "bv_debt_dd", "sd_12M_dd", "trate_1y_dd", "pv_debt",
                "asset_value_a", "volatility_a", "dtd", "residual", "converged")


def dtd_output(solved: DataFrame) -> DataFrame:
    return solved.select("date", "conm", "gvkey", "cusip", "dtd", "asset_value_a", "volatility_a")
