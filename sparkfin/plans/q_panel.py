"""Scans, projections, joins, aggregates and window queries."""
from __future__ import annotations

import math
import os
import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import expr as X
from ..operators import aggregates as AG
from ..operators import panel as P
from ..operators import ratios as R
from ..session import ensure_checkpoint_dir
from ..sources import adapters as A
from . import inputs as I
from . import oracle as O
from .q_ratios import ratios_cte
from .registry import register


def L(spark, sf, name):
    return A.load(spark, sf, name)


def _W():
    return X.firm_window()

# ---------------------------------------------------------------- scans
register("scan_monthly_prices", O.sql(["a_secm"], """
SELECT gvkey, iid, datadate, last_day(datadate) AS month_end, conm, prccm, ajexm,
       prccm / nullif(ajexm, 0) AS prccm_adj, cshoq * prccm AS mcap
FROM a_secm WHERE tpci = '0' AND fic = 'USA' AND primiss = 'P'"""))(
    lambda spark, sf: L(spark, sf, "a_secm")
    .filter((F.col("tpci") == "0") & (F.col("fic") == "USA") & (F.col("primiss") == "P"))
    .select("gvkey", "iid", "datadate", F.last_day("datadate").alias("month_end"), "conm", "prccm",
            "ajexm", X.div("prccm", "ajexm").alias("prccm_adj"),
            (F.col("cshoq") * F.col("prccm")).alias("mcap")))


@register("scan_by_key_list", O.sql(["a_fundq", "a_link", "a_msf"], """
SELECT date, permno, prc, shrout, cfacpr FROM a_msf
WHERE permno IN (SELECT lpermno FROM a_link WHERE linktype IN ('LU', 'LC')
                 AND gvkey IN (SELECT DISTINCT gvkey FROM a_fundq))"""))
def scan_by_key_list(spark, sf):
    """Key list carried from one result into the next scan as semi joins;
    AQE turns a semi join into a broadcast only when the key side is small
    at runtime, so a large key list still works as a shuffle join."""
    firms = L(spark, sf, "a_fundq").select("gvkey").distinct()
    permnos = (L(spark, sf, "a_link").filter(F.col("linktype").isin("LU", "LC"))
               .join(firms, "gvkey", "left_semi").select(F.col("lpermno").alias("permno")))
    return (L(spark, sf, "a_msf").join(permnos, "permno", "left_semi")
            .select("date", "permno", "prc", "shrout", "cfacpr"))


register("scan_fundamentals", O.sql(["a_fundq"], """
SELECT gvkey, datadate, fyearq, fqtr, atq, saleq, ltq FROM a_fundq
WHERE indfmt IN ('INDL', 'FS') AND datafmt = 'STD' AND popsrc = 'D' AND consol = 'C'
  AND datadate BETWEEN DATE '1995-01-01' AND DATE '2001-12-31'"""))(
    lambda spark, sf: L(spark, sf, "a_fundq")
    .filter(F.col("indfmt").isin("INDL", "FS") & (F.col("datafmt") == "STD") & (F.col("popsrc") == "D")
            & (F.col("consol") == "C") & F.col("datadate").between(F.lit("1995-01-01").cast("date"),
                                                                    F.lit("2001-12-31").cast("date")))
    .select("gvkey", "datadate", "fyearq", "fqtr", "atq", "saleq", "ltq"))


@register("csv_roundtrip", O.sql(["a_secm"], "SELECT gvkey, datadate, prccm, ajexm FROM a_secm"))
def csv_roundtrip(spark, sf):
    """Write with a leading index column, read back with a fixed schema and
    drop that column.  The folder is under the cluster's shared
    checkpoint location, never a machine-local one."""
    src = L(spark, sf, "a_secm").select("gvkey", "datadate", "prccm", "ajexm")
    path = os.path.join(ensure_checkpoint_dir(spark), "csv_roundtrip", uuid.uuid4().hex)
    (src.select(F.monotonically_increasing_id().alias("idx"), "*")
     .write.mode("overwrite").option("header", True).csv(path))
    schema = "idx LONG, gvkey STRING, datadate DATE, prccm DOUBLE, ajexm DOUBLE"
    back = spark.read.schema(schema).option("header", True).csv(path)
    return back.drop(back.columns[0])


# ---------------------------------------------------------------- projections
register("market_values", O.sql(["a_msf"], """
SELECT date, permno, abs(prc) AS prc_abs, abs(prc) * shrout / 1000 AS mcap_crsp,
       abs(prc) / nullif(cfacpr, 0) AS prc_adj FROM a_msf"""))(
    lambda spark, sf: L(spark, sf, "a_msf").select(
        "date", "permno", F.abs("prc").alias("prc_abs"),
        (F.abs("prc") * F.col("shrout") / 1000).alias("mcap_crsp"),
        X.div(F.abs("prc"), "cfacpr").alias("prc_adj")))

register("global_prices", O.sql(["a_dsf"], I.GLOBAL_PRICES_SQL))(I.global_prices)

register("month_end_align", O.sql(["a_dsf"], "SELECT permno, date, last_day(date) AS month_end FROM a_dsf"))(
    lambda spark, sf: L(spark, sf, "a_dsf").select("permno", "date", F.last_day("date").alias("month_end")))

register("public_date", O.sql(["a_fundq"], """
SELECT gvkey, datadate, last_day(datadate + INTERVAL 2 MONTH) AS public_date FROM a_fundq"""))(
    lambda spark, sf: L(spark, sf, "a_fundq").select(
        "gvkey", "datadate", F.last_day(F.add_months("datadate", 2)).alias("public_date")))

register("key_mapping", O.sql(["a_fundq"], """
SELECT DISTINCT gvkey, cusip, substring(cusip, 1, length(cusip) - 1) AS cusip8 FROM a_fundq"""))(
    lambda spark, sf: L(spark, sf, "a_fundq").select(
        "gvkey", "cusip", P.drop_last_char("cusip").alias("cusip8")).distinct())


@register("gics_levels", O.sql(["a_gics"], """
SELECT gvkey, gind, substring(gind, 1, length(gind) - 4) AS sector, substring(gind, 1, length(gind) - 2) AS grp
FROM a_gics"""))
def gics_levels(spark, sf):
    s, g = P.gics_levels("gind")
    return L(spark, sf, "a_gics").select("gvkey", "gind", s.alias("sector"), g.alias("grp"))


register("price_coalesce", O.sql(["a_panelq"], """
SELECT gvkey, datadate, coalesce(mcap_crsp, mcap_comp) AS mktcap,
       coalesce(prc_crsp_unadj, prc_comp_unadj) AS price_unadj,
       coalesce(prc_crsp_adj, prc_comp_adj) AS price_adj FROM a_panelq"""))(
    lambda spark, sf: I.us_panel(spark, sf).select(
        "gvkey", "datadate", F.coalesce("mcap_crsp", "mcap_comp").alias("mktcap"),
        F.coalesce("prc_crsp_unadj", "prc_comp_unadj").alias("price_unadj"),
        F.coalesce("prc_crsp_adj", "prc_comp_adj").alias("price_adj")))

register("book_debt", O.sql(["a_fundq"], """
SELECT gvkey, datadate, coalesce(dlcq, 0.0) + 0.5 * coalesce(dlttq, 0.0) AS debt FROM a_fundq"""))(
    lambda spark, sf: L(spark, sf, "a_fundq").select(
        "gvkey", "datadate", (X.z("dlcq") + 0.5 * X.z("dlttq")).alias("debt")))

_PRICE_COLS = ["mcap_crsp", "prc_crsp_unadj", "prc_crsp_adj", "dvrate"]
register("drop_all_null_rows", O.sql(["a_panelq"], f"""
SELECT gvkey, datadate, {', '.join(_PRICE_COLS)} FROM a_panelq
WHERE {' OR '.join(c + ' IS NOT NULL' for c in _PRICE_COLS)}"""))(
    lambda spark, sf: P.drop_all_null(I.us_panel(spark, sf), _PRICE_COLS)
    .select("gvkey", "datadate", *_PRICE_COLS))

register("require_not_null", O.sql(["a_fundq"], """
SELECT gvkey, datadate, atq, ltq FROM a_fundq WHERE atq IS NOT NULL AND ltq IS NOT NULL"""))(
    lambda spark, sf: P.require_not_null(L(spark, sf, "a_fundq"), ["atq", "ltq"])
    .select("gvkey", "datadate", "atq", "ltq"))

_GICS_FIRST_SQL = """gics1 AS (
  SELECT gvkey, gsector, ggroup, gind FROM (
    SELECT *, row_number() OVER (PARTITION BY gvkey ORDER BY indfrom, gind) AS rn FROM a_gics) t
  WHERE rn = 1)"""


def _gics_first(spark, sf):
    return P.dedup_first(L(spark, sf, "a_gics"), ["gvkey"], ["indfrom", "gind"]).select(
        "gvkey", "gsector", "ggroup", "gind")


register("exclude_financials", O.sql(["a_fundq", "a_gics"], """
SELECT f.gvkey, f.datadate, g.gsector FROM a_fundq f LEFT JOIN gics1 g ON f.gvkey = g.gvkey
WHERE g.gsector <> '40' AND cast(g.gsector AS int) > 0""", _GICS_FIRST_SQL))(
    lambda spark, sf: L(spark, sf, "a_fundq").join(_gics_first(spark, sf), "gvkey", "left")
    .filter((F.col("gsector") != "40") & (F.col("gsector").cast("int") > 0))
    .select("gvkey", "datadate", "gsector"))


@register("ratio_clean", O.sql(["a_panelq"], "SELECT gvkey, datadate, "
                               + ", ".join(R.FAMILIES_US["efficiency"]) + " FROM qd", ratios_cte("US")[0]))
def ratio_clean(spark, sf):
    from .q_ratios import prepared_panel
    df = R.family(prepared_panel(spark, sf), "efficiency")
    return df.select("gvkey", "datadate", *[X.clean_inf(c).alias(c) for c in R.FAMILIES_US["efficiency"]])


@register("ratio_output", O.sql(["a_panelq"], "SELECT gvkey, datadate, "
                                + ", ".join(R.ratio_columns(R.US)) + " FROM qd", ratios_cte("US")[0]))
def ratio_output(spark, sf):
    """US output table: keys, then the 69 quarterly ratios in family order."""
    from .q_ratios import prepared_panel
    return R.quarterly_ratios(prepared_panel(spark, sf)).select(
        "gvkey", "datadate", *R.ratio_columns(R.US))


# ---------------------------------------------------------------- joins
register("link_market_to_firm", O.sql(["a_msf", "a_link"], """
SELECT m.date, m.permno, l.gvkey, m.prc, l.linktype, l.linkprim
FROM a_msf m LEFT JOIN (SELECT * FROM a_link WHERE linktype IN ('LU', 'LC') AND linkprim IN ('P', 'C')) l
  ON m.permno = l.lpermno"""))(
    lambda spark, sf: P.link_market(L(spark, sf, "a_msf"), L(spark, sf, "a_link"))
    .select("date", "permno", "gvkey", "prc", "linktype", "linkprim"))

register("attach_industry", O.sql(["a_fundq", "a_gics"], """
SELECT f.gvkey, f.datadate, g.gsector, g.ggroup, g.gind FROM a_fundq f LEFT JOIN gics1 g ON f.gvkey = g.gvkey""",
                                  _GICS_FIRST_SQL))(
    lambda spark, sf: L(spark, sf, "a_fundq").join(_gics_first(spark, sf), "gvkey", "left")
    .select("gvkey", "datadate", "gsector", "ggroup", "gind"))

register("market_price_merge", O.sql(["a_fundq", "v_market"], """
SELECT f.gvkey, f.datadate, p.mcap_crsp, p.mcap_comp
FROM a_fundq f LEFT JOIN v_market p ON f.gvkey = p.gvkey AND f.datadate = p.datadate"""))(
    lambda spark, sf: L(spark, sf, "a_fundq").join(I.market(spark, sf), ["gvkey", "datadate"], "left")
    .select("gvkey", "datadate", "mcap_crsp", "mcap_comp"))


@register("estimates_merge", O.sql(["a_est_act", "a_est_sum"], """
SELECT a.cusip, a.pends, a.value, a.current_actual, s.statpers, last_day(s.statpers) AS statpers_me, s.actual AS fut_actual,
       s.meanest AS fut_eps, g.meanest AS ltg_eps,
       CASE WHEN a.current_actual <> 0 THEN (s.meanest - a.current_actual) / abs(a.current_actual) END AS futepsgrowth
FROM (SELECT x.cusip, x.pends, x.value,
             (SELECT max_by(y.value, y.pends) FROM a_est_act y WHERE y.cusip = x.cusip AND y.pends < x.pends) AS current_actual
      FROM a_est_act x) a
LEFT JOIN (SELECT * FROM a_est_sum WHERE fpi = '1' AND fiscalp = 'ANN' AND curr_act = 'USD') s
  ON a.cusip = s.cusip AND a.pends = s.fpedats
LEFT JOIN (SELECT * FROM a_est_sum WHERE fpi = '0' AND fiscalp = 'LTG') g
  ON a.cusip = g.cusip AND s.statpers = g.statpers"""))
def estimates_merge(spark, sf):
    return P.forecast_growth(L(spark, sf, "a_est_act"), L(spark, sf, "a_est_sum"))


@register("fundamentals_merge", O.sql(["a_fundq", "a_est_sum", "a_msf"], """
SELECT f.gvkey, f.datadate, e.meanest, m.mcap_crsp
FROM a_fundq f
LEFT JOIN (SELECT cusip AS cusip8, statpers AS statpers_me, meanest FROM a_est_sum WHERE fpi = '1') e
  ON substring(f.cusip, 1, length(f.cusip) - 1) = e.cusip8 AND f.datadate = e.statpers_me
LEFT JOIN (SELECT lpad(cast(permno - 10000 AS string), 6, '0') AS gvkey, last_day(date) AS date,
                  abs(prc) * shrout / 1000 AS mcap_crsp FROM a_msf) m
  ON f.gvkey = m.gvkey AND f.datadate = m.date"""))
def fundamentals_merge(spark, sf):
    """Left joins whose keys carry different names on the two sides."""
    f = L(spark, sf, "a_fundq").withColumn("cusip8", P.drop_last_char("cusip"))
    e = (L(spark, sf, "a_est_sum").filter(F.col("fpi") == "1")
         .select(F.col("cusip").alias("e_cusip"), F.col("statpers").alias("statpers_me"), "meanest"))
    m = L(spark, sf, "a_msf").select(
        F.lpad((F.col("permno") - 10000).cast("string"), 6, "0").alias("m_gvkey"),
        F.last_day("date").alias("date"), (F.abs("prc") * F.col("shrout") / 1000).alias("mcap_crsp"))
    out = (f.join(e, (f.cusip8 == e.e_cusip) & (f.datadate == e.statpers_me), "left")
           .join(m, (F.col("gvkey") == m.m_gvkey) & (F.col("datadate") == m.date), "left"))
    return out.select("gvkey", "datadate", "meanest", "mcap_crsp")


@register("fundamentals_merge_global", O.sql(["a_fundq", "a_dsf"], """
SELECT f.isin, f.datadate, p.prc_comp_unadj, p.mcap_comp
FROM a_fundq f LEFT JOIN (
  SELECT isin, last_day(datadate) AS datadate, prc_comp_unadj, mcap_comp FROM (
    SELECT *, row_number() OVER (PARTITION BY isin, last_day(datadate) ORDER BY datadate DESC) AS rn
    FROM gp) t WHERE rn = 1) p
ON f.isin = p.isin AND f.datadate = p.datadate""", "gp AS (" + I.GLOBAL_PRICES_SQL + ")"))
def fundamentals_merge_global(spark, sf):
    gp = P.global_month_ends(I.global_prices(spark, sf))
    return (L(spark, sf, "a_fundq").join(gp, ["isin", "datadate"], "left")
            .select("isin", "datadate", "prc_comp_unadj", "mcap_comp"))


# ---------------------------------------------------------------- aggregates
_GS_SQL = """gs_in AS (SELECT gvkey, cusip, datadate, conm, saleq, atq, xrdq FROM a_fundq
  UNION ALL SELECT gvkey, cusip, datadate, conm, saleq, atq, xrdq FROM a_fundq WHERE fqtr = 4)"""


def _gs_in(spark, sf):
    full = L(spark, sf, "a_fundq")
    f = full.select("gvkey", "cusip", "datadate", "conm", "saleq", "atq", "xrdq")
    return f.unionByName(full.filter(F.col("fqtr") == 4).select(*f.columns))


register("panel_group_sum", O.sql(["a_fundq"], """
SELECT gvkey, cusip, datadate, conm, sum(saleq) AS saleq, sum(atq) AS atq, sum(xrdq) AS xrdq
FROM gs_in WHERE gvkey IS NOT NULL AND cusip IS NOT NULL AND datadate IS NOT NULL AND conm IS NOT NULL
GROUP BY gvkey, cusip, datadate, conm""", _GS_SQL))(
    lambda spark, sf: P.group_sum(_gs_in(spark, sf), ["gvkey", "cusip", "datadate", "conm"],
                                  ["saleq", "atq", "xrdq"]))

register("panel_group_sum_zero", O.sql(["a_fundq"], """
SELECT gvkey, cusip, datadate, conm, coalesce(sum(saleq), 0.0) AS saleq, coalesce(sum(atq), 0.0) AS atq,
       coalesce(sum(xrdq), 0.0) AS xrdq
FROM gs_in WHERE gvkey IS NOT NULL AND cusip IS NOT NULL AND datadate IS NOT NULL AND conm IS NOT NULL
GROUP BY gvkey, cusip, datadate, conm""", _GS_SQL))(
    lambda spark, sf: P.group_sum(_gs_in(spark, sf), ["gvkey", "cusip", "datadate", "conm"],
                                  ["saleq", "atq", "xrdq"], zero_when_empty=True))

register("distinct_keys", O.sql(["a_msf"], "SELECT DISTINCT permno, cusip FROM a_msf"))(
    lambda spark, sf: L(spark, sf, "a_msf").select("permno", "cusip").distinct())

register("dedup_first", O.sql(["a_link"], """
SELECT gvkey, lpermno, linktype, linkprim, linkdt, linkenddt FROM (
  SELECT *, row_number() OVER (PARTITION BY gvkey ORDER BY linkdt, lpermno) AS rn FROM a_link) t
WHERE rn = 1"""))(
    lambda spark, sf: P.dedup_first(L(spark, sf, "a_link"), ["gvkey"], ["linkdt", "lpermno"]))

register("dedup_last", O.sql(["a_dsf"], """
SELECT permno, month_end, date, prc FROM (
  SELECT permno, last_day(date) AS month_end, date, prc,
         row_number() OVER (PARTITION BY permno, last_day(date) ORDER BY date DESC) AS rn FROM a_dsf) t
WHERE rn = 1"""))(
    lambda spark, sf: P.dedup_last(
        L(spark, sf, "a_dsf").select("permno", F.last_day("date").alias("month_end"), "date", "prc"),
        ["permno", "month_end"], ["date"]))

_DESCRIBE_ITEMS = ["saleq", "atq", "ltq", "cheq"]


@register("describe_panel", O.sql(["a_fundq"], " UNION ALL ".join(f"""
SELECT '{c}' AS item, count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std, min({c}) AS min,
       quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS p50, quantile_cont({c}, 0.75) AS p75,
       max({c}) AS max FROM a_fundq""" for c in _DESCRIBE_ITEMS)))
def describe_panel(spark, sf):
    return AG.describe(L(spark, sf, "a_fundq"), _DESCRIBE_ITEMS)


register("union_frames", O.sql(["a_secm"], """
SELECT gvkey, datadate, prccm, fic FROM a_secm WHERE fic = 'USA'
UNION ALL SELECT gvkey, datadate, prccm, fic FROM a_secm WHERE fic <> 'USA'"""))(
    lambda spark, sf: (lambda s: s.filter(F.col("fic") == "USA").unionByName(s.filter(F.col("fic") != "USA")))(
        L(spark, sf, "a_secm").select("gvkey", "datadate", "prccm", "fic")))


# ---------------------------------------------------------------- windows
register("ttm_sum", O.sql(["a_fundq"], f"""
SELECT gvkey, datadate, {O.t4('saleq', 4)} AS saleq_ttm, {O.t4('saleq', 1)} AS saleq_ttm_glb FROM a_fundq"""))(
    lambda spark, sf: L(spark, sf, "a_fundq").select(
        "gvkey", "datadate", X.T4("saleq", _W(), 4).alias("saleq_ttm"), X.T4("saleq", _W(), 1).alias("saleq_ttm_glb")))

register("mean_year", O.sql(["a_fundq"], f"""
SELECT gvkey, datadate, {O.m4('atq', 4)} AS atq_my, {O.m4('atq', 1)} AS atq_my_glb FROM a_fundq"""))(
    lambda spark, sf: L(spark, sf, "a_fundq").select(
        "gvkey", "datadate", X.M4("atq", _W(), 4).alias("atq_my"), X.M4("atq", _W(), 1).alias("atq_my_glb")))

register("rolling_mean_n", O.sql(["a_fundq"], f"""
SELECT gvkey, datadate,
  {O.ordered_mean("saleq", 5)} AS saleq_avg5,
  {O.ordered_mean("saleq", 20)} AS saleq_avg20
FROM a_fundq"""))(
    lambda spark, sf: L(spark, sf, "a_fundq").select(
        "gvkey", "datadate", X.rolling_mean("saleq", _W(), 5).alias("saleq_avg5"),
        X.rolling_mean("saleq", _W(), 20).alias("saleq_avg20")))


def rolling_volatility_df(dsf, n: int = 252):
    """Annualised rolling deviation of daily returns by security; the frame
    needs ``n`` returns.  Rounded to 6 places (half-even)."""
    d = AG.rolling_deviation(dsf.select("permno", "date", "ret"), "ret", "permno", "date", n, "sd")
    return d.select("permno", "date", X.rint_n(F.col("sd") * math.sqrt(n), 6).alias("vol"))


_VOLW = f"OVER (PARTITION BY permno ORDER BY date {O.rows(252)})"
register("rolling_volatility", O.sql(["a_dsf"], f"""
SELECT permno, date, round_even((CASE WHEN count(ret) {_VOLW} >= 252 THEN stddev_samp(ret) {_VOLW} * sqrt(252) END)
  * 1000000, 0) / 1000000 AS vol FROM a_dsf"""))(
    lambda spark, sf: rolling_volatility_df(L(spark, sf, "a_dsf")))

register("lag_lead_diff", O.sql(["a_fundq"], f"""
SELECT gvkey, datadate, {O.lag('saleq', 1)} AS lag1, {O.lag('saleq', 4)} AS lag4, {O.lag('saleq', 8)} AS lag8,
       {O.lead('saleq', 1)} AS lead1, saleq - {O.lag('saleq', 1)} AS diff1, saleq - {O.lag('saleq', 4)} AS diff4
FROM a_fundq"""))(
    lambda spark, sf: L(spark, sf, "a_fundq").select(
        "gvkey", "datadate", X.lag("saleq", _W(), 1).alias("lag1"), X.lag("saleq", _W(), 4).alias("lag4"),
        X.lag("saleq", _W(), 8).alias("lag8"), X.lead("saleq", _W(), 1).alias("lead1"),
        X.delta("saleq", _W(), 1).alias("diff1"), X.delta("saleq", _W(), 4).alias("diff4")))

_YTD = {"oancfq": "oancfy", "capxq": "capxy", "dpcq": "dpcy", "ibcq": "ibcy", "dpq": "dpy", "dvq": "dvy"}
register("ytd_to_quarter", O.sql(["a_fundq"], "SELECT gvkey, datadate, fqtr, " + ", ".join(
    f"CASE WHEN fqtr = 1 THEN {s} ELSE {s} - {O.lag(s)} END AS {d}" for d, s in _YTD.items()) + " FROM a_fundq"))(
    lambda spark, sf: L(spark, sf, "a_fundq").select(
        "gvkey", "datadate", "fqtr", *[X.ytd_to_quarter(s, _W()).alias(d) for d, s in _YTD.items()]))

_ZF = ["dvpq", "mibq", "xidoq", "miiq", "spiq", "nopiq", "pstkq", "dvy"]
_ZFW = O.W(frame="ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW")
register("zero_fill_after_first", O.sql(["a_fundq"], "SELECT gvkey, datadate, " + ", ".join(
    f"CASE WHEN count({c}) {_ZFW} > 0 THEN coalesce({c}, 0.0) END AS {c}" for c in _ZF) + " FROM a_fundq"))(
    lambda spark, sf: L(spark, sf, "a_fundq").select(
        "gvkey", "datadate", *[X.zero_fill_after_first(c, _W()).alias(c) for c in _ZF]))

_IP = ["saleq", "atq", "ltq"]


register("interpolate_linear", O.sql(["a_fundq"], "SELECT gvkey, datadate, "
                                     + ", ".join(O.interp_sql(c) for c in _IP)
                                     + " FROM (SELECT *, row_number() OVER (PARTITION BY gvkey ORDER BY datadate)"
                                       " AS rn FROM a_fundq) t"))(
    lambda spark, sf: P.interpolate_linear(L(spark, sf, "a_fundq").select("gvkey", "datadate", *_IP), _IP))

_MW = "OVER (PARTITION BY series_key ORDER BY date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"
register("ffill_limit", O.sql(["a_macro"], f"""
SELECT series_key, date, last_value(value IGNORE NULLS) {_MW} AS value FROM a_macro"""))(
    lambda spark, sf: L(spark, sf, "a_macro").select(
        "series_key", "date", X.ffill_limit("value", X.firm_window("series_key", "date"), 2).alias("value")))

register("quarter_check", O.sql(["a_fundq"], f"""
SELECT gvkey, datadate, qtrcheck FROM (SELECT gvkey, datadate, {O.t4('fqtr', 4)} AS qtrcheck FROM a_fundq) t
WHERE qtrcheck = 10"""))(
    lambda spark, sf: L(spark, sf, "a_fundq").select(
        "gvkey", "datadate", X.T4(F.col("fqtr").cast("double"), _W(), 4).alias("qtrcheck"))
    .filter(F.col("qtrcheck") == 10))

register("pct_change", O.sql(["a_macro"], """
SELECT series_key, date, value / nullif(lag(value) OVER (PARTITION BY series_key ORDER BY date), 0) - 1 AS pct
FROM a_macro"""))(
    lambda spark, sf: L(spark, sf, "a_macro").select(
        "series_key", "date",
        (X.div("value", X.lag("value", X.firm_window("series_key", "date"))) - 1).alias("pct")))


@register("eps_growth_3y", O.sql(["a_fundq"], f"""
SELECT gvkey, datadate, pe_exi, y1, y2, y3, (coalesce(y1, 0.0) + coalesce(y2, 0.0) + coalesce(y3, 0.0)) / 3 AS eps3yr_growth
FROM (SELECT gvkey, datadate, pe_exi,
        pe_exi / nullif({O.lag('pe_exi', 4)}, 0) - 1 AS y1,
        {O.lag('pe_exi', 4)} / nullif({O.lag('pe_exi', 8)}, 0) - 1 AS y2,
        {O.lag('pe_exi', 8)} / nullif({O.lag('pe_exi', 12)}, 0) - 1 AS y3
      FROM (SELECT gvkey, datadate, coalesce(epsf12, {O.t4('epsfxq / nullif(ajexq, 0)')}) AS pe_exi FROM a_fundq) a) b"""))
def eps_growth_3y(spark, sf):
    f = L(spark, sf, "a_fundq")
    a = f.select("gvkey", "datadate", F.coalesce("epsf12", X.T4(X.div("epsfxq", "ajexq"), _W())).alias("pe_exi"))
    g = a.select("gvkey", "datadate", "pe_exi",
                 (X.div("pe_exi", X.lag("pe_exi", _W(), 4)) - 1).alias("y1"),
                 (X.div(X.lag("pe_exi", _W(), 4), X.lag("pe_exi", _W(), 8)) - 1).alias("y2"),
                 (X.div(X.lag("pe_exi", _W(), 8), X.lag("pe_exi", _W(), 12)) - 1).alias("y3"))
    return g.withColumn("eps3yr_growth", (X.z("y1") + X.z("y2") + X.z("y3")) / 3)


@register("accruals", O.sql(["a_fundq"], f"""
SELECT gvkey, datadate, accrq, at5, accrq / nullif(at5, 0) AS accrualq FROM (
  SELECT gvkey, datadate, coalesce(oancfq, 0.0) - coalesce(ibq, 0.0) AS accrq,
    (coalesce(atq, 0.0) + {O.lag('coalesce(atq, 0.0)', 1)} + {O.lag('coalesce(atq, 0.0)', 2)}
     + {O.lag('coalesce(atq, 0.0)', 3)} + {O.lag('coalesce(atq, 0.0)', 4)}) / 5 AS at5
  FROM (SELECT *, CASE WHEN fqtr = 1 THEN oancfy ELSE oancfy - {O.lag('oancfy')} END AS oancfq FROM a_fundq) a) b"""))
def accruals(spark, sf):
    f = L(spark, sf, "a_fundq").withColumn("oancfq", X.ytd_to_quarter("oancfy", _W()))
    at = X.z("atq")
    b = f.select("gvkey", "datadate", (X.z("oancfq") - X.z("ibq")).alias("accrq"),
                 ((at + X.lag(at, _W(), 1) + X.lag(at, _W(), 2) + X.lag(at, _W(), 3) + X.lag(at, _W(), 4)) / 5).alias("at5"))
    return b.withColumn("accrualq", X.div("accrq", "at5"))


register("sorted_panel", O.sql(["a_fundq"], "SELECT gvkey, datadate, saleq FROM a_fundq ORDER BY gvkey, datadate"))(
    lambda spark, sf: L(spark, sf, "a_fundq").select("gvkey", "datadate", "saleq").orderBy("gvkey", "datadate"))

register("limit_head_tail", O.sql(["a_fundq"], """
SELECT * FROM (SELECT 'head' AS side, gvkey, datadate, saleq FROM a_fundq ORDER BY datadate, gvkey LIMIT 5)
UNION ALL
SELECT * FROM (SELECT 'tail' AS side, gvkey, datadate, saleq FROM a_fundq ORDER BY datadate DESC, gvkey DESC LIMIT 5)"""))(
    lambda spark, sf: (lambda f: f.orderBy("datadate", "gvkey").limit(5).select(F.lit("head").alias("side"), "*")
                       .unionByName(f.orderBy(F.desc("datadate"), F.desc("gvkey")).limit(5)
                                    .select(F.lit("tail").alias("side"), "*")))(
        L(spark, sf, "a_fundq").select("gvkey", "datadate", "saleq")))
