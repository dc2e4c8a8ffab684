"""Market values reach the ratio panel through the link table."""
import datetime as dt

from sparkfin.operators import panel as P

JAN, FEB = dt.date(2000, 1, 31), dt.date(2000, 2, 29)


def _inputs(spark):
    msf = spark.createDataFrame([(dt.date(2000, 1, 28), 70, -4.0, 1000.0, 2.0), (dt.date(2000, 2, 25), 70, None, 1000.0, 2.0),
                                 (dt.date(2000, 1, 28), 71, 5.0, 1000.0, 0.0), (dt.date(2000, 1, 28), 72, 6.0, 1000.0, 1.0)],
                                "date date, permno int, prc double, shrout double, cfacpr double")
    link = spark.createDataFrame([("A", 70, "LU", "P"), ("A", 70, "LC", "C"), ("B", 71, "LU", "P"), ("C", 72, "NR", "P"), ("D", 72, "LU", "P")],
                                 "gvkey string, lpermno int, linktype string, linkprim string")
    secm = spark.createDataFrame([("A", dt.date(2000, 1, 28), 4.0, 2.0, 1.0, 0.1, "0"), ("A", dt.date(2000, 2, 25), 3.0, 2.0, 1.0, 0.1, "0"),
                                  ("C", dt.date(2000, 1, 28), 9.0, 1.0, 1.0, 0.1, "0"), ("B", dt.date(2000, 2, 25), 8.0, 1.0, 1.0, 0.1, "0"),
                                  ("D", dt.date(2000, 1, 28), 6.0, 1.0, 1.0, 0.1, "1")],
                                 "gvkey string, datadate date, prccm double, ajexm double, cshoq double, dvrate double, tpci string") \
        .selectExpr("*", "'USA' as fic", "'P' as primiss")
    return msf, link, secm


def test_market_values_by_link(spark):
    got = {(r.gvkey, r.datadate): r for r in P.market_values(*_inputs(spark)).collect()}
    assert set(got) == {("A", JAN), ("A", FEB), ("B", JAN)}
    a = got["A", JAN]
    assert (a.mcap_crsp, a.prc_crsp_unadj, a.prc_crsp_adj, a.mcap_comp, a.prc_comp_adj) == (4.0, 4.0, 2.0, 4.0, 2.0)
    assert got["A", FEB].mcap_crsp is None and got["A", FEB].mcap_comp == 3.0
    assert got["B", JAN].prc_crsp_adj is None and got["B", JAN].mcap_comp is None


def test_panel_keeps_firms_without_market_or_forecast(spark):
    fund = spark.createDataFrame([("A", "000000011", JAN), ("A", "000000011", FEB), ("C", "000000031", JAN)], "gvkey string, cusip string, datadate date")
    growth = spark.createDataFrame([("00000001", dt.date(1999, 12, 31), dt.date(2000, 1, 15), JAN, 0.5, None),
                                    ("00000001", dt.date(2000, 12, 31), dt.date(2000, 1, 15), JAN, 0.7, None),
                                    ("00000003", dt.date(1999, 12, 31), None, None, None, None)],
                                   "cusip string, pends date, statpers date, statpers_me date, futepsgrowth double, ltg_eps double")
    rows = P.ratio_panel(fund, P.market_values(*_inputs(spark)), growth).collect()
    got = {(r.gvkey, r.datadate): (r.mcap_crsp, r.futepsgrowth) for r in rows}
    assert len(rows) == 3 and got == {("A", JAN): (4.0, 0.5), ("A", FEB): (None, None), ("C", JAN): (None, None)}


def test_empty_inputs(spark):
    msf, link, secm = _inputs(spark)
    assert P.market_values(msf, link.limit(0), secm).isEmpty() and P.market_values(msf.limit(0), link, secm).isEmpty()
