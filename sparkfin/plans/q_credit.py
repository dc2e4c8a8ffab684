"""Credit-risk, macro and volatility queries."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import expr as X
from ..operators import credit as C
from ..operators import macro as MC
from ..operators import volatility as V
from ..sources import adapters as A
from . import oracle as O
from .registry import register


def L(spark, sf, name):
    return A.load(spark, sf, name)


_DTD_SQL = O.sql(["a_dsf", "a_macro", "a_link", "a_fundq"], """
SELECT f.date, f.conm, f.gvkey, f.cusip, c.mcap_crsp_dd, f.bv_debt_dd, c.sd_12M_dd, c.trate_1y_dd
FROM (SELECT f.*, k.permno FROM comp f LEFT JOIN ccm k ON f.gvkey = k.gvkey) f
LEFT JOIN daily_m c ON f.date = c.date AND f.permno = c.permno""", """rate AS (
  SELECT date, round_even(last_value(value IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
                          * 10000, 0) / 10000 / 100 AS trate_1y_dd
  FROM a_macro WHERE series_key = 'BUILDING'),
daily AS (
  SELECT d.*, r.trate_1y_dd,
    CASE WHEN count(ret) OVER (PARTITION BY permno ORDER BY d.date ROWS BETWEEN 251 PRECEDING AND CURRENT ROW) >= 252
         THEN stddev_samp(ret) OVER (PARTITION BY permno ORDER BY d.date ROWS BETWEEN 251 PRECEDING AND CURRENT ROW) * sqrt(252)
    END AS sd_12M_dd
  FROM (SELECT DISTINCT date, permno, cusip, abs(prc) * shrout / 1000 AS mcap_crsp_dd, ret FROM a_dsf) d
  LEFT JOIN rate r ON d.date = r.date),
daily_m AS (
  SELECT last_day(date) AS date, permno, mcap_crsp_dd, sd_12M_dd, trate_1y_dd FROM (
    SELECT *, row_number() OVER (PARTITION BY permno, last_day(date) ORDER BY date DESC) AS rn FROM daily) t
  WHERE rn = 1),
ccm AS (
  SELECT gvkey, lpermno AS permno FROM (
    SELECT *, row_number() OVER (PARTITION BY gvkey ORDER BY linkdt, lpermno) AS rn FROM a_link
    WHERE linktype IN ('LU', 'LC') AND linkprim IN ('P', 'C')) t WHERE rn = 1),
comp AS (
  SELECT gvkey, cusip, datadate AS date, conm,
         lag(coalesce(dlcq, 0.0) + 0.5 * coalesce(dlttq, 0.0)) OVER (PARTITION BY gvkey ORDER BY datadate) AS bv_debt_dd
  FROM a_fundq)""")


def dtd_inputs(spark, sf):
    return C.dtd_inputs(L(spark, sf, "a_dsf"), L(spark, sf, "a_macro"), L(spark, sf, "a_link"),
                        L(spark, sf, "a_fundq"))


register("dtd_inputs", _DTD_SQL)(dtd_inputs)


def _cdf_sql(x: str) -> str:
    """The normal distribution function, spelled out."""
    a = f"least(abs({x}), 37.0)"

    def poly(c):
        return " + ".join(f"{v!r} * pow({a}, {len(c) - 1 - i})" for i, v in enumerate(c))
    tail = (f"(CASE WHEN {a} < 7.07106781186547 THEN exp(-0.5 * {a} * {a}) * ({poly(C._NUM)}) / ({poly(C._DEN)}) "
            f"ELSE exp(-0.5 * {a} * {a}) / ({a} + 1 / ({a} + 2 / ({a} + 3 / ({a} + 4 / ({a} + 0.65))))) / sqrt(2 * pi()) END)")
    return f"(CASE WHEN {x} > 0 THEN 1 - {tail} ELSE {tail} END)"


# the halving of the bracket as a recursive table, one row a step
_SOLVE_SQL = f"""WITH RECURSIVE inputs AS ({_DTD_SQL}),
prepared AS (
  SELECT row_number() OVER () AS id, * REPLACE (CASE WHEN bv_debt_dd IS NULL OR bv_debt_dd = 0 THEN 0.01 ELSE bv_debt_dd END AS bv_debt_dd)
  FROM inputs WHERE sd_12M_dd IS NOT NULL),
rows AS MATERIALIZED (SELECT *, bv_debt_dd * exp(-trate_1y_dd) AS pv_debt, mcap_crsp_dd AS e, bv_debt_dd * exp(-trate_1y_dd) AS d, sd_12M_dd AS vol FROM prepared),
steps AS (
  SELECT id, e, d, vol, least(ln(e / d), 0.0) * (e + d) / (vol * e) - vol / 2 AS lo, ln(1 + e / d) * (e + d) / (vol * e) AS hi, 0 AS k
  FROM rows WHERE e > 0 AND d > 0 AND vol > 0
  UNION ALL
  SELECT id, e, d, vol, CASE WHEN ln(held / n1 / d) - s * s / 2 - s * mid > 0 THEN mid ELSE lo END,
         CASE WHEN ln(held / n1 / d) - s * s / 2 - s * mid > 0 THEN hi ELSE mid END, k + 1
  FROM (SELECT *, {_cdf_sql("(mid + s)")} AS n1 FROM (SELECT *, vol * e / held AS s FROM (
    SELECT *, e + d * {_cdf_sql("mid")} AS held FROM (SELECT *, (lo + hi) / 2 AS mid FROM steps WHERE k < {C.HALVINGS}))))),
solved AS (
  SELECT id, held / {_cdf_sql("(mid + s)")} AS v, s FROM (SELECT *, vol * e / held AS s FROM (
    SELECT *, e + d * {_cdf_sql("mid")} AS held FROM (SELECT *, (lo + hi) / 2 AS mid FROM steps WHERE k = {C.HALVINGS}))))
"""

_SOLVED = "rows LEFT JOIN solved USING (id)"


@register("dtd_solve", _SOLVE_SQL + f"""
SELECT date, conm, gvkey, cusip, mcap_crsp_dd, bv_debt_dd, sd_12M_dd, trate_1y_dd, pv_debt, v AS asset_value_a, s AS volatility_a,
       (v - d) / (v * s) AS dtd, CASE WHEN v IS NOT NULL THEN CAST(0 AS DOUBLE) END AS residual, v IS NOT NULL AS converged FROM {_SOLVED}""")
def dtd_solve(spark, sf):
    return C.dtd_solve(dtd_inputs(spark, sf)).withColumn("residual", F.round("residual", 8))


@register("dtd_output", _SOLVE_SQL + f"""
SELECT date, conm, gvkey, cusip, (v - d) / (v * s) AS dtd, v AS asset_value_a, s AS volatility_a FROM {_SOLVED}""")
def dtd_output(spark, sf):
    return C.dtd_output(C.dtd_solve(dtd_inputs(spark, sf)))


# ---------------------------------------------------------------- macro
def _locs(spark, sf):
    """Series names come from the nation table (bounded by it)."""
    return sorted(r[0] for r in L(spark, sf, "nation").select("n_name").distinct().collect())


@register("macro_long", O.sql(["a_macro_m"], """
SELECT l.loc, d.publicdate, m.value
FROM (SELECT DISTINCT publicdate FROM a_macro_m) d
CROSS JOIN (SELECT DISTINCT n_name AS loc FROM nation) l
LEFT JOIN a_macro_m m ON m.loc = l.loc AND m.publicdate = d.publicdate"""))
def macro_long(spark, sf):
    locs = _locs(spark, sf)
    wide = MC.to_wide(L(spark, sf, "a_macro_m"), locs)
    return MC.to_long(wide, locs)


@register("macro_rate", O.sql(["a_macro"], """
SELECT series_key, date,
  round_even(last_value(value IGNORE NULLS) OVER (PARTITION BY series_key ORDER BY date
             ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) * 10000, 0) / 10000 / 100 AS rate
FROM a_macro"""))
def macro_rate(spark, sf):
    """Percent to fraction per series: fill two dates, round 4, divide by 100."""
    w = X.firm_window("series_key", "date")
    return L(spark, sf, "a_macro").select(
        "series_key", "date", (X.rint_n(X.ffill_limit("value", w, 2), 4) / 100).alias("rate"))

_PANEL_LOC_SQL = """pl AS (
  SELECT f.gvkey, f.datadate, last_day(f.datadate + INTERVAL 2 MONTH) AS publicdate, l.loc
  FROM a_fundq f LEFT JOIN a_loc l ON f.gvkey = l.gvkey)"""


def _panel_loc(spark, sf):
    return (L(spark, sf, "a_fundq").select("gvkey", "datadate")
            .join(L(spark, sf, "a_loc").select("gvkey", "loc"), "gvkey", "left")
            .withColumn("publicdate", F.last_day(F.add_months("datadate", 2)))
            .select("gvkey", "datadate", "publicdate", "loc"))


register("macro_attach", O.sql(["a_fundq", "a_loc", "a_macro_m"], """
SELECT p.gvkey, p.datadate, p.publicdate, p.loc, m.value AS macro
FROM pl p LEFT JOIN a_macro_m m ON p.publicdate = m.publicdate AND p.loc = m.loc""", _PANEL_LOC_SQL))(
    lambda spark, sf: _panel_loc(spark, sf).join(
        L(spark, sf, "a_macro_m").withColumnRenamed("value", "macro"), ["publicdate", "loc"], "left")
    .select("gvkey", "datadate", "publicdate", "loc", "macro"))


@register("macro_overlay", O.sql(["a_fundq", "a_loc", "a_macro_m"], """
SELECT p.gvkey, p.datadate, p.publicdate, p.loc,
       coalesce(u.government_bond, p.government_bond) AS government_bond,
       coalesce(u.government_bond_pct, p.government_bond_pct) AS government_bond_pct
FROM (SELECT pl.*, CASE WHEN pl.loc < 'K' THEN 1.0 END AS government_bond,
             CAST(NULL AS double) AS government_bond_pct FROM pl) p
LEFT JOIN (SELECT loc, publicdate, value AS government_bond,
                  value / nullif(lag(value) OVER (PARTITION BY loc ORDER BY publicdate), 0) - 1 AS government_bond_pct
           FROM a_macro_m) u
  ON p.loc = u.loc AND p.publicdate = u.publicdate""", _PANEL_LOC_SQL))
def macro_overlay(spark, sf):
    """Cells of the panel's bond columns replaced by the non-null values of
    the monthly series table at matching (loc, publicdate)."""
    base = _panel_loc(spark, sf).select(
        "*", F.when(F.col("loc") < "K", F.lit(1.0)).alias("government_bond"),
        F.lit(None).cast("double").alias("government_bond_pct"))
    upd = MC.pct_change(L(spark, sf, "a_macro_m").withColumnRenamed("value", "government_bond"),
                        "loc", "publicdate", "government_bond", "government_bond_pct")
    return MC.overlay(base, upd, ["loc", "publicdate"], ["government_bond", "government_bond_pct"])


# ---------------------------------------------------------------- volatility
register("vol_baselines", O.sql(["a_dsf"], """
SELECT permno, date, lr, r2, f_mean, f_rw, (r2 - f_mean) * (r2 - f_mean) AS se_mean,
       (r2 - f_rw) * (r2 - f_rw) AS se_rw
FROM (SELECT permno, date, lr, lr * lr AS r2,
        avg(lr * lr) OVER (PARTITION BY permno ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS f_mean,
        lag(lr * lr) OVER (PARTITION BY permno ORDER BY date) AS f_rw
      FROM (SELECT permno, date, ln(ret + 1) AS lr FROM a_dsf WHERE ret IS NOT NULL) r) t"""))(
    lambda spark, sf: V.baselines(L(spark, sf, "a_dsf")))


@register("vol_garch")
def vol_garch(spark, sf):
    return V.garch_fits(L(spark, sf, "a_dsf"))
