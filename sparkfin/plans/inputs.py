"""The panels the ratio families read: fundamentals with market values and
forecast growth, put together by the panel operators.  ``VIEWS`` are the same
tables written apart in DuckDB SQL, for the oracles only."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import expr as X
from ..operators import panel as P
from ..sources import adapters as A


def market(spark: SparkSession, sf: str) -> DataFrame:
    return P.market_values(A.load(spark, sf, "a_msf"), A.load(spark, sf, "a_link"), A.load(spark, sf, "a_secm"))


def global_prices(spark: SparkSession, sf: str) -> DataFrame:
    """Daily prices of securities by isin, shares in millions."""
    d = A.load(spark, sf, "a_dsf")
    cshoc = F.col("shrout") * 1000 / 1000000
    return d.select(F.concat(F.lit("XS"), F.lpad((F.col("permno") - 10000).cast("string"), 10, "0")).alias("isin"),
                    F.col("date").alias("datadate"), F.abs("prc").alias("prc_comp_unadj"),
                    X.div(F.abs("prc"), "cfacpr").alias("prc_comp_adj"), cshoc.alias("cshoc"),
                    (cshoc * F.abs("prc")).alias("mcap_comp"))


def us_panel(spark: SparkSession, sf: str, fundamentals: str = "a_fundq") -> DataFrame:
    """US panel over the quarterly or annual (``a_funda``) fundamentals."""
    growth = P.forecast_growth(A.load(spark, sf, "a_est_act"), A.load(spark, sf, "a_est_sum"))
    return P.ratio_panel(A.load(spark, sf, fundamentals), market(spark, sf), growth)


def global_panel(spark: SparkSession, sf: str, fundamentals: str = "a_fundq") -> DataFrame:
    """Global panel: the month-end prices come by isin, without a link table."""
    return A.load(spark, sf, fundamentals).join(P.global_month_ends(global_prices(spark, sf)), ["isin", "datadate"], "left")


GLOBAL_PRICES_SQL = """
SELECT 'XS' || lpad(cast(permno - 10000 AS string), 10, '0') AS isin, date AS datadate,
       abs(prc) AS prc_comp_unadj, abs(prc) / nullif(cfacpr, 0) AS prc_comp_adj,
       shrout * 1000 / 1000000 AS cshoc, (shrout * 1000 / 1000000) * abs(prc) AS mcap_comp
FROM a_dsf"""

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {}

VIEWS["v_market"] = (("a_msf", "a_link", "a_secm"), """
SELECT s.gvkey, last_day(m.date) AS datadate, abs(m.prc) * m.shrout / 1000 AS mcap_crsp,
       abs(m.prc) AS prc_crsp_unadj, abs(m.prc) / nullif(m.cfacpr, 0) AS prc_crsp_adj,
       s.cshoq * s.prccm AS mcap_comp, s.prccm AS prc_comp_unadj, s.prccm / nullif(s.ajexm, 0) AS prc_comp_adj, s.dvrate
FROM a_msf m, a_secm s
WHERE s.tpci = '0' AND s.fic = 'USA' AND s.primiss = 'P' AND last_day(s.datadate) = last_day(m.date)
  AND EXISTS (SELECT 1 FROM a_link k WHERE k.lpermno = m.permno AND k.gvkey = s.gvkey
              AND k.linktype IN ('LU', 'LC') AND k.linkprim IN ('P', 'C'))""")

VIEWS["v_growth"] = (("a_est_act", "a_est_sum"), """
SELECT s.cusip, last_day(s.statpers) AS statpers_me, (s.meanest - p.value) / nullif(abs(p.value), 0) AS futepsgrowth,
       (SELECT max(g.meanest) FROM a_est_sum g WHERE g.cusip = s.cusip AND g.statpers = s.statpers
          AND g.fpi = '0' AND g.fiscalp = 'LTG') AS ltg_eps
FROM a_est_sum s JOIN a_est_act a ON a.cusip = s.cusip AND a.pends = s.fpedats
LEFT JOIN a_est_act p ON p.cusip = a.cusip
  AND p.pends = (SELECT max(y.pends) FROM a_est_act y WHERE y.cusip = a.cusip AND y.pends < a.pends)
WHERE s.fpi = '1' AND s.fiscalp = 'ANN' AND s.curr_act = 'USD'
""")

for _view, _fund in (("a_panelq", "a_fundq"), ("a_panela", "a_funda")):
    VIEWS[_view] = ((_fund, "v_market", "v_growth"), f"""
SELECT f.*, m.* EXCLUDE (gvkey, datadate), g.futepsgrowth, g.ltg_eps
FROM {_fund} f LEFT JOIN v_market m ON f.gvkey = m.gvkey AND f.datadate = m.datadate
LEFT JOIN v_growth g ON g.cusip = left(f.cusip, 8) AND g.statpers_me = f.datadate""")
    VIEWS[_view + "_global"] = ((_fund, "a_dsf"), f"""
SELECT f.*, p.prc_comp_unadj, p.prc_comp_adj, p.mcap_comp
FROM {_fund} f LEFT JOIN (
  SELECT isin, last_day(datadate) AS datadate, arg_max(prc_comp_unadj, datadate) AS prc_comp_unadj,
         arg_max(prc_comp_adj, datadate) AS prc_comp_adj, arg_max(mcap_comp, datadate) AS mcap_comp
  FROM ({GLOBAL_PRICES_SQL}) GROUP BY 1, 2) p ON f.isin = p.isin AND f.datadate = p.datadate""")
