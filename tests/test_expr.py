"""Window kit and panel operators on the hand-written edge tables."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from sparkfin.functions import expr as X
from sparkfin.operators import panel as P


def _panel(spark, vals, firm="A", start=1995):
    rows = []
    for i, v in enumerate(vals):
        y, q = start + i // 4, i % 4 + 1
        d = (dt.date(y + (3 * q == 12), (3 * q) % 12 + 1, 1) - dt.timedelta(days=1))
        rows.append((firm, d, q, None if v is None else float(v)))
    return rows


SCHEMA = "gvkey string, datadate date, fqtr int, x double"


def test_edge_roll_us_and_global(spark):
    df = spark.createDataFrame(_panel(spark, [1, 2, None, 4, 5, 6, 7]), SCHEMA)
    w = X.firm_window()
    out = df.select("datadate", X.T4("x", w, 4).alias("us"), X.T4("x", w, 1).alias("glb")) \
        .orderBy("datadate").collect()
    assert [r.us for r in out] == [None] * 6 + [22.0]
    assert [r.glb for r in out] == [1.0, 3.0, 3.0, 7.0, 11.0, 15.0, 22.0]


def test_edge_round_half_even(spark):
    df = spark.createDataFrame([(v,) for v in [0.25, 0.35, 26.75, 0.05, 1234567.25]], "x double")
    got = [r[0] for r in df.select(X.rint_n("x", 1)).collect()]
    assert got == [0.2, 0.4, 26.8, 0.0, 1234567.2]


def test_edge_div(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0), (None, 0.0), (6.0, 3.0)], "n double, d double")
    got = [r[0] for r in df.select(X.div_or("n", "d", F.lit(-1.0))).collect()]
    # 1/0 is infinite: no fallback, ends null; 0/0 and null/0 are missing: fallback
    assert got == [None, -1.0, -1.0, 2.0]


def test_edge_ytd(spark):
    rows = [("A", dt.date(2000, 3, 31), 1, 10.0), ("A", dt.date(2000, 6, 30), 2, 25.0),
            ("A", dt.date(2000, 9, 30), 3, 40.0), ("A", dt.date(2000, 12, 31), 4, 70.0),
            ("A", dt.date(2001, 3, 31), 1, 5.0), ("A", dt.date(2001, 9, 30), 3, 20.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = [r[0] for r in df.select(X.ytd_to_quarter("x", X.firm_window())).collect()]
    assert got == [10.0, 15.0, 15.0, 30.0, 5.0, 15.0]


def test_edge_twofirms_no_cross_reads(spark):
    rows = _panel(spark, [1, 2, 3], "A") + _panel(spark, [10, 20, 30, 40, 50], "B")
    df = spark.createDataFrame(rows, SCHEMA)
    w = X.firm_window()
    both = {(r.gvkey, r.datadate): r.s for r in
            df.select("gvkey", "datadate", X.T4("x", w, 1).alias("s")).collect()}
    only_b = {(r.gvkey, r.datadate): r.s for r in
              df.filter("gvkey = 'B'").select("gvkey", "datadate", X.T4("x", w, 1).alias("s")).collect()}
    assert all(both[k] == v for k, v in only_b.items())
    assert both[("B", min(k[1] for k in only_b))] == 10.0


def test_edge_interp(spark):
    df = spark.createDataFrame(_panel(spark, [None, 1, None, 3, None, None]), SCHEMA)
    got = [r.x for r in P.interpolate_linear(df, ["x"]).orderBy("datadate").collect()]
    assert got == [None, 1.0, 2.0, 3.0, 3.0, 3.0]


def test_interpolation_stays_between_neighbours(spark):
    vals = [5, None, None, None, 1, None, 9]
    df = spark.createDataFrame(_panel(spark, vals), SCHEMA)
    got = [r.x for r in P.interpolate_linear(df, ["x"]).orderBy("datadate").collect()]
    assert got[1:4] == pytest.approx([4.0, 3.0, 2.0])
    assert got[5] == pytest.approx(5.0)


def test_zero_fill_after_first(spark):
    df = spark.createDataFrame(_panel(spark, [None, None, 3, None, 5]), SCHEMA)
    got = [r[0] for r in df.select(X.zero_fill_after_first("x", X.firm_window())).orderBy("datadate").collect()]
    assert got[:2] == [None, None] and got[2:] == [3.0, 0.0, 5.0]


def test_ffill_limit_two(spark):
    df = spark.createDataFrame(_panel(spark, [1, None, None, None, 5]), SCHEMA)
    got = [r[1] for r in df.select("datadate", X.ffill_limit("x", X.firm_window(), 2)).orderBy("datadate")
           .collect()]
    assert got == [1.0, 1.0, 1.0, None, 5.0]


def test_edge_month(spark):
    days = [dt.date(2000, 2, 28), dt.date(2000, 2, 29), dt.date(2001, 2, 28), dt.date(2001, 4, 30),
            dt.date(2001, 4, 15)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = [r[0] for r in df.select(F.last_day("d")).collect()]
    assert got == [dt.date(2000, 2, 29), dt.date(2000, 2, 29), dt.date(2001, 2, 28), dt.date(2001, 4, 30),
                   dt.date(2001, 4, 30)]


def test_month_grid_size(spark):
    rows = _panel(spark, [1, 2, 3, 4], "A") + _panel(spark, [1, 2], "B")
    df = spark.createDataFrame(rows, SCHEMA)
    g = P.month_grid(df)
    assert g.count() == 2 * 10   # two firms x (1995-03 .. 1995-12)


def test_monthly_panel_matches_grid_definition(spark):
    """The explode-based monthly panel equals grid + ffill(2) + check."""
    from sparkfin.operators.ratios import monthly_panel
    rows = _panel(spark, [1, 2, 3, 4, 5, None, 7], "A")
    df = spark.createDataFrame(rows, SCHEMA)
    out = monthly_panel(df, ["x"]).orderBy("datadate").collect()
    # check passes from the 4th quarter on (fqtr T4 = 10); each quarter fills 2 more months
    first = out[0]
    assert first.qdate == dt.date(1995, 12, 31) and first.x == 4.0
    xs = [r.x for r in out]
    assert xs[:3] == [4.0, 4.0, 4.0] and xs[3:6] == [5.0, 5.0, 5.0] and xs[6:9] == [None, None, None]


def test_link_dates_option(spark):
    msf = spark.createDataFrame([(dt.date(1988, 6, 30), 10001, 5.0), (dt.date(1995, 6, 30), 10001, 6.0)],
                                "date date, permno long, prc double")
    link = spark.createDataFrame(
        [("000001", 10001, "LU", "P", dt.date(1990, 1, 1), None),
         ("000009", 10001, "LC", "C", dt.date(1985, 1, 1), dt.date(1989, 12, 31))],
        "gvkey string, lpermno long, linktype string, linkprim string, linkdt date, linkenddt date")
    loose = P.link_market(msf, link).collect()
    strict = {r.date: r.gvkey for r in P.link_market(msf, link, respect_link_dates=True).collect()}
    assert len(loose) == 4                      # dates ignored: both links match both months
    assert strict == {dt.date(1988, 6, 30): "000009", dt.date(1995, 6, 30): "000001"}


def test_prepare_quarterly_order(spark):
    """Duplicates collapse, zero fill after first, interpolation, then R&D."""
    rows = [("A", "c", "F", dt.date(2000, 3, 31), None, 1.0, None),
            ("A", "c", "F", dt.date(2000, 3, 31), None, 9.0, None),      # duplicate date: dropped
            ("A", "c", "F", dt.date(2000, 6, 30), 2.0, None, 5.0),
            ("A", "c", "F", dt.date(2000, 9, 30), None, 3.0, None),
            ("A", "c", "F", dt.date(2000, 12, 31), None, None, None)]      # all items null: dropped
    df = spark.createDataFrame(rows, "gvkey string, cusip string, conm string, datadate date, "
                                     "dvpq double, saleq double, xrdq double")
    out = {r.datadate: r for r in P.prepare_quarterly(df, group_keys=("gvkey", "cusip", "datadate", "conm"))
           .collect()}
    assert sorted(out) == [dt.date(2000, 3, 31), dt.date(2000, 6, 30), dt.date(2000, 9, 30)]
    assert out[dt.date(2000, 3, 31)].dvpq is None and out[dt.date(2000, 9, 30)].dvpq == 0.0
    assert out[dt.date(2000, 6, 30)].saleq == 2.0          # interpolated between 1 and 3
    # R&D is interpolated first (a trailing gap repeats the last value), leading gap stays
    assert out[dt.date(2000, 9, 30)].xrdq == 5.0 and out[dt.date(2000, 3, 31)].xrdq is None
