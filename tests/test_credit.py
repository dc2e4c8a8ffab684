"""Merton solve: residuals, bounds and the input rules."""
import math

import numpy as np

from pyspark.sql import functions as F

from sparkfin.operators.credit import merton, norm_cdf, _at


def cdf(x):
    return np.array([0.5 * math.erfc(-v / math.sqrt(2)) for v in x])


def _solved(spark, rows):
    df = spark.createDataFrame([tuple(map(float, r)) for r in rows], "e double, d double, v double")
    e, d, v = (F.col(c) for c in "edv")
    both = _at(F.col("d2"), e, d, v, lambda _, s, value: F.struct(value.alias("value"), s.alias("s")))
    got = df.withColumn("d2", merton(e, d, v)).withColumn("a", both).select("e", "d", "v", "a.value", "a.s").collect()
    return (np.array(x) for x in zip(*got))


def test_residuals_and_bounds(spark):
    rng = np.random.default_rng(7)
    rows = list(zip(rng.uniform(10, 5000, 300), rng.uniform(1, 8000, 300), rng.uniform(0.05, 1.5, 300)))
    rows += [(1.0, 1000.0, 0.2), (1000.0, 1.0, 3.0), (1e-3, 1e6, 0.5), (1e6, 1e-3, 1e-4), (5.0, 5.0, 4.0)]
    E, D, vol, V, s = _solved(spark, rows)
    d1 = (np.log(V / D) + 0.5 * s * s) / s
    assert np.max(np.abs(V * cdf(d1) - D * cdf(d1 - s) - E) / np.maximum(E, 1e-7 * V)) < 1e-6
    assert np.max(np.abs(s * V * cdf(d1) / (vol * E) - 1)) < 1e-6
    ok = D < 50 * E  # beyond, the value's rounding shows in the equity
    assert np.max(np.abs(V * cdf(d1) - D * cdf(d1 - s) - E)[ok] / E[ok]) < 1e-8
    assert np.all(V >= E) and np.all(s > 0) and np.all(s <= vol * (1 + 1e-12))


def test_tiny_debt_limit(spark):
    _, _, _, V, s = _solved(spark, [(100.0, 1e-6, 0.3)])
    assert math.isclose(V[0], 100.0 + 1e-6, rel_tol=1e-9) and math.isclose(s[0], 0.3, rel_tol=1e-6)


def test_solve_runs_no_python(spark):
    from sparkfin.operators.credit import dtd_solve
    df = spark.createDataFrame([], "date date, conm string, gvkey string, cusip string, mcap_crsp_dd double, bv_debt_dd double, "
                                   "sd_12M_dd double, trate_1y_dd double")
    plan = dtd_solve(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    assert dtd_solve(df).count() == 0


def test_edge_dtd_rules(spark):
    import datetime as dt

    from sparkfin.operators.credit import dtd_output, dtd_solve
    rows = [(dt.date(2000, 3, 31), "F", "1", "c", 100.0, 0.0, 0.3, 0.02),     # zero debt -> 0.01
            (dt.date(2000, 6, 30), "F", "1", "c", 100.0, None, 0.3, 0.02),    # null debt -> 0.01
            (dt.date(2000, 9, 30), "F", "1", "c", 100.0, 50.0, 0.3, None),    # null rate -> null
            (dt.date(2000, 12, 31), "F", "1", "c", 100.0, 50.0, None, 0.02),  # null vol -> dropped
            (dt.date(2001, 3, 31), "F", "1", "c", 100.0, 50.0, 1e-4, 0.02)]   # tiny vol
    df = spark.createDataFrame(rows, "date date, conm string, gvkey string, cusip string, mcap_crsp_dd double, "
                                     "bv_debt_dd double, sd_12M_dd double, trate_1y_dd double")
    out = {r.date: r for r in dtd_output(dtd_solve(df)).collect()}
    assert len(out) == 4
    assert out[dt.date(2000, 9, 30)].dtd is None
    assert out[dt.date(2000, 3, 31)].dtd > 0 and out[dt.date(2000, 6, 30)].dtd > 0
    assert out[dt.date(2001, 3, 31)].asset_value_a >= 100.0


def test_norm_cdf_against_erfc(spark):
    x = np.linspace(-36, 36, 1481)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    rows = df.select("x", norm_cdf(F.col("x")).alias("p")).collect()
    x, got = (np.array(v) for v in zip(*rows))
    want = cdf(x)
    assert np.abs(got - want).max() < 1e-14 and (np.abs(got - want) / want).max() < 1e-6
