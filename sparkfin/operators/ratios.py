"""Trailing-twelve-month financial ratio families on a firm-quarter panel.

Plan shape: every stage is one ``select`` over the same window
``partitionBy(firm).orderBy(date)``, so the physical plan holds one exchange
on the firm key and one sort; later stages reuse that partitioning.  Stages
exist only because Spark (like SQL) does not nest window functions:

  A  year-to-date unwinding, coalesced prices          (lag)
  B  T4 / M4 / differences and the coalesce chains      (sliding frames)
  C  lags of stage-B means, 20-quarter average, leads   (lag / avg / lead)
  D  the ratios themselves                              (row arithmetic)

Catalyst prunes the intermediate columns a family does not use, so a
family query only computes its own inputs.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import (M4 as _M4, T4 as _T4, add0, col, delta, div, div_or,
                              firm_window, lag, lead, nz, rolling_mean, sub0,
                              ytd_to_quarter, z)


@dataclass(frozen=True)
class Opts:
    """US and global variants differ only in these switches."""
    min_periods: int = 4          # non-null values a T4/M4 window needs
    key: str = "gvkey"            # firm key (isin in the global panel)
    date: str = "datadate"
    region: str = "US"


US = Opts()
GLOBAL = Opts(min_periods=1, key="isin", region="GLB")

# Output columns per family (US quarterly, in source order).
FAMILIES_US = {
    "capitalization": ["capital_ratioq", "equity_invcapq", "debt_invcapq", "totdebt_invcapq"],
    "efficiency": ["at_turnq", "inv_turnq", "pay_turnq", "rect_turnq", "sale_equityq",
                   "sale_invcapq", "sale_nwcq"],
    "soundness": ["invt_actq", "rect_actq", "fcf_ocfq", "ocf_lctq", "cash_debtq", "cash_ltq",
                  "cfmq", "short_debtq", "profit_lctq", "curr_debtq", "debt_ebitdaq",
                  "dltt_beq", "int_debtq", "int_totdebtq", "lt_debtq", "lt_ppentq"],
    "liquidity": ["cash_conversionq", "cash_ratioq", "curr_ratioq", "quick_ratioq"],
    "other": ["accrualq", "rd_saleq"],
    "profitability": ["efftaxq", "GProfq", "aftret_eqq", "aftret_equityq", "aftret_invcapxq",
                      "gpmq", "npmq", "opmadq", "opmbdq", "pretret_earnatq", "pretret_noq",
                      "ptpmq", "roaq", "roceq", "roeq"],
    "solvency": ["de_ratioq", "debt_atq", "lt_atq", "debt_capitalq", "intcovq", "intcov_ratioq"],
    "valuation": ["dprq", "PEG_1yrforward", "PEG_ltgforward", "PEG_trailing", "bmq", "capeiq",
                  "divyieldq", "evmq", "pcfq", "pe_exiq", "pe_incq", "pe_op_basicq",
                  "pe_op_dilq", "psq", "ptbq"],
}
_GLB_MISSING = {"equity_invcapq", "debt_invcapq", "totdebt_invcapq", "sale_invcapq",
                "rd_saleq", "aftret_invcapxq", "PEG_1yrforward", "PEG_ltgforward",
                "PEG_trailing", "divyieldq", "pe_exiq", "pe_incq", "pe_op_basicq", "pe_op_dilq"}
FAMILIES_GLB = {f: [c for c in cs if c not in _GLB_MISSING] for f, cs in FAMILIES_US.items()}


def ratio_columns(o: Opts = US) -> list[str]:
    fam = FAMILIES_US if o.region == "US" else FAMILIES_GLB
    return [c for cs in fam.values() for c in cs]


_ITEM_NUMERIC_EXCLUDE = {"fyr", "fyearq", "fqtr"}


# columns the global output carries next to the ratios
GLOBAL_KEYS = ["gvkey", "conm", "fyr", "fyearq", "fqtr", "gsector", "ggroup", "gind"]
GLOBAL_PRICES = ["mktcap", "price_adj", "price_unadj"]


def quarterly_ratios(df: DataFrame, o: Opts = US, keep: list[str] | None = None) -> DataFrame:
    """All quarterly ratios of one region variant, keyed by (firm, date);
    ``keep`` names further columns of the panel to carry along."""
    us = o.region == "US"
    w = firm_window(o.key, o.date)

    # -- stage A: unwind year-to-date items; the global panel is zero-filled
    if not us:
        num = [f.name for f in df.schema.fields
               if f.dataType.typeName() == "double" and f.name not in _ITEM_NUMERIC_EXCLUDE]
        df = df.select(*[z(c).alias(c) if c in num else F.col(c) for c in df.columns])
    ytd = {"oancfq": "oancfy", "capxq": "capxy", "dpcq": "dpcy", "ibcq": "ibcy",
           "dpq": "dpy", "dvq": "dvy"}
    if not us:
        ytd.update({"xidocq": "xidocy", "txdcq": "txdcy"})
    base = df.drop("dpq")
    a = base.select(
        "*",
        *[ytd_to_quarter(src, w).alias(dst) for dst, src in ytd.items()],
        (F.coalesce("mcap_crsp", "mcap_comp") if us else col("mcap_comp")).alias("mktcap"),
        (F.coalesce("prc_crsp_unadj", "prc_comp_unadj") if us else col("prc_comp_unadj")).alias("price_unadj"),
        (F.coalesce("prc_crsp_adj", "prc_comp_adj") if us else col("prc_comp_adj")).alias("price_adj"),
    )

    b_cols, c_cols, d_cols = _stage_exprs(o)
    b = a.select("*", *[c.alias(n) for n, c in b_cols.items()])
    c = b.select("*", *[v.alias(n) for n, v in c_cols.items()])
    more = [x for x in keep or [] if x != "fqtr"]
    return c.select(o.key, o.date, "fqtr", *more, *[v.alias(n) for n, v in d_cols.items()],
                    *[n for n in b_cols if n in set(ratio_columns(o))])


_EXPR_CACHE: dict = {}


def _stage_exprs(o: Opts):
    """Column expressions of stages B, C and D.  They depend only on the
    variant (not on the data), so they are built once per variant and
    process: building ~300 window expressions costs thousands of calls into
    the JVM, which would otherwise be paid by every ratio query."""
    from pyspark import SparkContext
    sc = SparkContext._active_spark_context
    key = (o, sc.applicationId if sc is not None else None)
    if key in _EXPR_CACHE:
        return _EXPR_CACHE[key]
    us = o.region == "US"
    w = firm_window(o.key, o.date)
    mp = o.min_periods

    def T(x) -> Column:
        return _T4(x, w, mp)

    def M(x) -> Column:
        return _M4(x, w, mp)

    def D4(x) -> Column:
        return delta(x, w, 4)

    # -- stage B: trailing sums and means, coalesce chains
    txd = "txditcq" if us else "txdcq"
    beq = z("seqq") + z(txd) - z("pstkq")
    ibq2 = F.coalesce(col("ibq"), z("niq") + z("xidoq")) if us else col("ibq")
    txp_term = D4(z("txpq")) if us else F.lit(0.0)
    ocf_fb_inner = (D4(z("actq")) + -D4(z("cheq")) + -D4(z("lctq")) + D4(z("dlcq"))
                    + (txp_term if us else F.lit(0.0)) + -z("dpq"))
    b_cols = {
        "T_sale": T("saleq"), "T_cogs_z": T(z("cogsq")), "T_sale_z": T(z("saleq")),
        "T_xopr_z": T(z("xoprq")), "T_xsga_z": T(z("xsgaq")), "T_dp_z": T(z("dpq")),
        "T_xint": T("xintq"), "T_ibq": T("ibq"), "T_oibdp": T("oibdpq"),
        "M_lct": M("lctq"), "M_lt": M("ltq"), "M_at": M("atq"), "M_act": M("actq"),
        "M_che": M("cheq"), "M_dltt": M("dlttq"),
        # capitalization
        "capital_ratioq": div(M("dlttq"), M(z("dlttq")) + M(z("ceqq") + z("pstkq"))),
        # efficiency
        "at_turnq": div(T("saleq"), M("atq")),
        "inv_turnq": div(T("cogsq"), M(nz("invtq") if us else col("invtq"))),
        "pay_turnq": div(T(z("cogsq")) + D4(z("invtq")), M(nz("apq") if us else col("apq"))),
        "rect_turnq": div(T("saleq"), M(nz("rectq") if us else col("rectq"))),
        "sale_equityq": div(T("saleq"), M("seqq")),
        "sale_nwcq": div(T("saleq"), M(sub0("actq", "lctq") if us else z("actq") - z("lctq"))),
        # soundness
        "invt_actq": div(M("invtq"), M("actq")),
        "rect_actq": div(M("rectq"), M("actq")),
        "ocf": F.coalesce(T("oancfq"), T(z("ibq")) - ocf_fb_inner),
        "T_capx_z": T(z("capxq")),
        "cash_ltq": div(M("cheq"), M("ltq")),
        "incomeq": F.coalesce(T(z("ibcq") + z("dpcq")), T(z("ibq")) + z("dpq")),
        "short_debtq": div(M("dlcq"), M(z("dlttq") + z("dlcq"))),
        "opibd": F.coalesce(T("oibdpq"), T(z("saleq")) - T(z("xoprq"))),
        "curr_debtq": div(M("lctq"), M("ltq")),
        "ebitdaq": F.coalesce(T("oibdpq"), T(z("saleq") - z("cogsq") - z("xsgaq"))),
        "M_debt_sum": M(add0("dlttq", "dlcq") if us else z("dlttq") + z("dlcq")),
        "dltt_beq": div(M("dlttq"), M(beq)),
        "int_debtq": div(T("xintq"), M(nz("dlttq") if us else col("dlttq"))),
        "int_totdebtq": div(T("xintq"), M(nz("dlttq") + nz("dlcq") if us else z("dlttq") + z("dlcq"))),
        "lt_debtq": div(M("dlttq"), M("ltq")),
        "lt_ppentq": div(M("ltq"), M(nz("ppentq") if us else col("ppentq"))),
        # liquidity
        "cash_conversionq": (div(M("invtq"), T(z("cogsq")) / 365) + div(M(z("rectq")), T(z("saleq")) / 365)
                             - div(M(z("apq")), T(z("cogsq")) / 365)),
        "cash_ratioq": div(M("cheq"), M("lctq")),
        "currentq": F.coalesce(M("actq"), M(z("cheq") + z("rectq") + z("invtq"))),
        "caniq": F.coalesce(M(z("actq") - z("invtq")), M(z("cheq") + z("rectq"))),
        # other
        "accrq": F.coalesce(z("oancfq") - z("ibq"),
                            -(D4(z("actq")) + -D4(z("cheq")) + -D4(z("lctq")) + D4(z("dlcq"))
                              + txp_term + T(-z("dpq")))),
        "at5": (z("atq") + lag(z("atq"), w, 1) + lag(z("atq"), w, 2) + lag(z("atq"), w, 3)
                + lag(z("atq"), w, 4)) / 5,
        # profitability
        "incometaxq": F.coalesce(T("piq"), T(z("oiadpq")) - T(z("xintq")) + T(z("spiq")) + T(z("nopiq"))),
        "T_txt": T("txtq"),
        "GProfq": div(T(z("revtq") - z("cogsq")), M("atq")),
        "niaftq": (F.coalesce(T("ibcomq"), T(z("ibq") - z("dvpq"))) if us
                   else T(sub0("ibq", "dvpdpq"))),
        "M_ceq": M("ceqq"), "M_seq": M("seqq"),
        "gpmq": (div(T(col("revtq") - col("cogsq")), T("saleq")) if us
                 else div(T(z("revtq") - z("cogsq")), T(z("saleq")))),
        "npmq": div(T("ibq"), T("saleq")),
        "oiadq": F.coalesce(T("oiadpq"), T(z("oibdpq") - z("dpq")), T(z("saleq") - z("xoprq") - z("dpq"))),
        "opmbdq": div(F.coalesce(T("oibdpq"), T(z("saleq")) - T(z("xoprq"))), T("saleq")),
        "oiadq45": (F.coalesce(T("oiadpq"), T(sub0("oibdpq", "dpq")), T(sub0(sub0("saleq", "xoprq"), "dpq")))
                    if us else F.coalesce(T("oiadpq"), T(z("oibdpq") - z("dpq")),
                                          T(z("saleq") - z("xoprq") - z("dpq")))),
        "M_ppent_act": M(add0("ppentq", "actq") if us else z("ppentq") + z("actq")),
        "oibdq": (F.coalesce(T("oibdpq"), T(sub0("oiadpq", "dpq")), T(sub0(sub0("saleq", "xoprq"), "dpq")))
                  if us else F.coalesce(T("oibdpq"), T(z("oiadpq")) - T(z("dpq")),
                                        T(z("saleq")) - T(z("xoprq")) - T(z("dpq")))),
        "M_noa": M(sub0(add0("ppentq", "actq"), "lctq") if us else z("ppentq") + z("actq") - z("lctq")),
        "pretaxiq": F.coalesce(T("piq"), T(z("oiadpq")) - T(z("xintq")) + T(z("spiq")) + T(z("nopiq"))),
        "oiadq_roa": F.coalesce(T("oibdpq"), T(z("saleq")) - T(z("xoprq"))),
        "earningsq": F.coalesce(T("oiadpq"), T(z("oibdpq")) - T(z("dpq")),
                                T(z("saleq")) - T(z("xoprq")) - T(z("dpq")),
                                T(z("saleq")) - T(z("cogsq")) - T(z("xsgaq")) - T(z("dpq"))),
        "M_capital": M(z("dlttq") + z("dlcq") + z("ceqq")),
        "M_beq": M(beq),
        # solvency
        "de_ratioq": (div(M("ltq"), z(M(col("ceqq") + col("pstkq")))) if us
                      else div(M("ltq"), M(z("ceqq") + z("pstkq")))),
        "debt_atq": div(M(z("dlttq") + z("dlcq")), M("atq") if us else M(z("atq"))),
        "lt_atq": div(M("ltq"), M("atq")),
        "debt_capitalq": div(M(z("apq")) + M(z("dlcq") + z("dlttq")),
                             M(z("apq")) + M(z("dlcq") + z("dlttq")) + M(z("ceqq") + z("pstkq"))),
        "intcovq": div(T(z("xintq") + z("ibq")), T(nz("xintq") if us else col("xintq"))),
        "earningsq56": F.coalesce(T("oiadpq"), T(z("saleq")) - T(z("cogsq")) - T(z("xsgaq")) - T(z("dpq"))),
        "T_xint_nz": T(nz("xintq") if us else col("xintq")),
        # valuation
        "beq": beq,
        "capei_t": T(ibq2),
        "ocf2": F.coalesce(T("oancfq"), T(z(ibq2)) - D4(z("actq")) + -D4(z("cheq")) + -D4(z("lctq"))
                           + D4(z("dlcq")) + txp_term + -z("dpq")),
        "evq": (M(z("dlttq")) + M(z("dlcq")) + M(z("mibq")) + M(z("pstkq"))
                + (M(z("prccq") * z("cshoq")) if us else M(z("mktcap")))),
        "lead_price_adj": lead("price_adj", w, 1),
        "lead_mktcap": lead("mktcap", w, 1),
    }
    if us:
        b_cols.update({
            "equity_invcapq": div(M("ceqq"), M("icaptq")),
            "debt_invcapq": div(M("dlttq"), M("icaptq")),
            "totdebt_invcapq": div(M(z("dlttq")) + M(z("dlcq")), M(z("icaptq"))),
            "sale_invcapq": div(T("saleq"), M("icaptq")),
            "rd_saleq": div(T(col("xrdq") + 0), T("saleq")),
            "M_lagcap": M(z("icaptq") + z("txditcq") + -z("mibq")),
            "T_aftret_num": T(z("ibq") + z("xintq") + z("miiq")),
            "pe_exi": F.coalesce(col("epsf12"), T(div("epsfxq", "ajexq"))),
            "T_dv_dvp": T(z("dvq") + z("dvpq")), "T_ibadj": T("ibadjq"),
            "T_eps_fx": T(div("epsfxq", "ajexq")), "T_eps_fi": T(div("epsfiq", "ajexq")),
            "T_eps_op": T(div("opepsq", "ajexq")), "T_eps_opx": T(div("oepsxq", "ajexq")),
            "M_dvrate": M("dvrate"), "M_price_unadj": M("price_unadj"),
        })
    else:
        b_cols.update({"T_dv": T("dvq"), "T_ibc": T("ibcq")})
    # -- stage C: lags of stage-B means, 20-quarter average of T4(ib)
    c_cols = {
        "lag_M_ceq": lag("M_ceq", w), "lag_M_seq": lag("M_seq", w), "lag_M_at": lag("M_at", w),
        "lag_M_ppent_act": lag("M_ppent_act", w), "lag_M_noa": lag("M_noa", w),
        "lag_M_capital": lag("M_capital", w), "lag_M_beq": lag("M_beq", w),
        "capei20": rolling_mean("capei_t", w, 20),
    }
    if us:
        c_cols.update({
            "lagicapt4": lag("M_lagcap", w),
            "lag4_pe_exi": lag("pe_exi", w, 4), "lag8_pe_exi": lag("pe_exi", w, 8),
            "lag12_pe_exi": lag("pe_exi", w, 12),
        })
    # -- stage D: ratios
    lp, lm = col("lead_price_adj"), col("lead_mktcap")
    d_cols = {
        "fcf_ocfq": div(z("ocf") - col("T_capx_z"), col("ocf")),
        "ocf_lctq": div("ocf", "M_lct"),
        "cash_debtq": div("ocf", "M_lt"),
        "cfmq": div("incomeq", "T_sale"),
        "profit_lctq": div("opibd", "M_lct"),
        "debt_ebitdaq": div("M_debt_sum", "ebitdaq"),
        "curr_ratioq": div("currentq", "M_lct"),
        "quick_ratioq": div("caniq", "M_lct"),
        "accrualq": div("accrq", "at5"),
        "efftaxq": div("T_txt", "incometaxq"),
        "aftret_eqq": div("niaftq", "lag_M_ceq"),
        "aftret_equityq": div("T_ibq", "lag_M_seq"),
        "opmadq": div("oiadq", "T_sale"),
        "pretret_earnatq": div("oiadq45", "lag_M_ppent_act"),
        "pretret_noq": div("oibdq", "lag_M_noa"),
        "ptpmq": div("pretaxiq", "T_sale"),
        "roaq": div("oiadq_roa", "lag_M_at"),
        "roceq": div("earningsq", "lag_M_capital"),
        "roeq": div("T_ibq", "lag_M_beq"),
        "intcov_ratioq": div("earningsq56", "T_xint_nz"),
        "capeiq": div(lm, col("capei20")),
        "evmq": div_or(col("evq"), col("T_oibdp"),
                       div(col("evq"), col("T_sale_z") - col("T_cogs_z") - col("T_xsga_z"))),
        "pcfq": div(lm, col("ocf2")),
        "psq": div(lm, col("T_sale")),
        "ptbq": div(lm, col("beq")),
    }
    if us:
        mcap_q = col("prccq") * col("cshoq")
        pe58 = div(lp, col("pe_exi"))
        y1 = div(col("pe_exi"), col("lag4_pe_exi")) - 1
        y2 = div(col("lag4_pe_exi"), col("lag8_pe_exi")) - 1
        y3 = div(col("lag8_pe_exi"), col("lag12_pe_exi")) - 1
        g3 = (z(y1) + z(y2) + z(y3)) / 3
        bm = div(col("beq"), mcap_q)
        d_cols.update({
            "aftret_invcapxq": div("T_aftret_num", "lagicapt4"),
            "dprq": div_or(col("T_dv_dvp"), col("ibadj12"), div(col("T_dv_dvp"), col("T_ibadj"))),
            "PEG_1yrforward": div(F.abs(pe58), col("futepsgrowth") * 100),
            "PEG_ltgforward": div(F.abs(pe58), col("ltg_eps")),
            "PEG_trailing": div(div(col("price_adj"), col("pe_exi")), 100 * g3),
            "bmq": F.when(~(z(mcap_q) < 0), bm),
            "divyieldq": div_or(col("M_dvrate"), col("M_price_unadj"), F.lit(0.0)),
            "pe_exiq": div_or(lp, col("epsf12"), div(lp, col("T_eps_fx"))),
            "pe_incq": div_or(lp, col("epsfi12"), div(lp, col("T_eps_fi"))),
            "pe_op_basicq": div_or(lp, col("oeps12"), div(lp, col("T_eps_op"))),
            "pe_op_dilq": div_or(lp, col("oepf12"), div(lp, col("T_eps_opx"))),
        })
    else:
        d_cols.update({
            "dprq": div("T_dv", "T_ibc"),
            "bmq": div("beq", "mcap_comp"),
        })
    _EXPR_CACHE[key] = (b_cols, c_cols, d_cols)
    return b_cols, c_cols, d_cols

def family(df: DataFrame, name: str, o: Opts = US) -> DataFrame:
    fam = FAMILIES_US if o.region == "US" else FAMILIES_GLB
    return quarterly_ratios(df, o).select(o.key, o.date, *fam[name])


def efficiency(df: DataFrame, o: Opts = US) -> DataFrame:
    return family(df, "efficiency", o)


def monthly_panel(q: DataFrame, cols: list[str], key: str = "gvkey", date: str = "datadate",
                  plain: list[str] | None = None) -> DataFrame:
    """Quarterly ratios spread onto month ends.

    Meaning: a (firm x month-end) grid over the sample's global date range,
    each column forward-filled at most two months, rows whose filled
    four-quarter check (T4 of the fiscal quarter) is not 10 removed, a
    publication date two months later, everything rounded to 4 places.

    Plan: instead of materialising the whole grid and joining, each
    quarterly row emits itself for its own month and the two following
    months (``k`` = 0, 1, 2); per (firm, month) every column takes the value
    of the nearest row that has one (``min_by`` over ``k``).  Grid rows
    without a quarterly row in reach would be all-null and fail the check,
    so they are never made.  The aggregation is keyed by (firm, month) and
    the input is already hash-partitioned by firm, so no new exchange.
    """
    w = firm_window(key, date)
    hi = q.agg(F.max(date)).scalar()   # last date of the sample: a scalar subquery of the same plan
    base = (q.select(key, date, F.col(date).alias("qdate"),
                     _T4(F.col("fqtr").cast("double"), w, 4).alias("qtrcheck"), *(plain or []), *cols)
            .filter(F.col(date) == F.last_day(date)))
    ex = base.select("*", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("_k"))
    ex = ex.withColumn("_m", F.last_day(F.add_months(date, F.col("_k")))).filter(F.col("_m") <= hi)
    plain = plain or []   # carried along unrounded
    vals = ["qdate", "qtrcheck", *plain, *cols]
    g = ex.groupBy(key, "_m").agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), F.col("_k"))).alias(c)
                                    for c in vals])
    return (g.filter(F.col("qtrcheck") == 10)
            .select(key, F.col("_m").alias(date), "qdate",
                    F.last_day(F.add_months("_m", 2)).alias("publicdate"),
                    F.col("qtrcheck"), *plain,
                    *[(F.rint(F.col(c) * 10000.0) / 10000.0).alias(c) for c in cols]))


# ---------------------------------------------------------------- annual
ANNUAL_COLS = [
    "capital_ratioa", "equity_invcapa", "debt_invcapa", "totdebt_invcapa", "at_turna", "inv_turna",
    "pay_turna", "rect_turna", "sale_equitya", "sale_invcapa", "sale_nwc", "invt_acta", "rect_acta",
    "fcf_ocfa", "ocf_lcta", "cash_debta", "cash_lta", "cfma", "short_debta", "profit_lcta",
    "curr_debta", "debt_ebitda", "dltt_bea", "int_debta", "int_totdebta", "lt_debta", "lt_ppenta",
    "cash_conversiona", "cash_ratioa", "curr_ratioa", "quick_ratioa", "accruala", "rd_salea",
    "adv_salea", "staff_salea", "efftaxa", "GProfa", "aftret_eqa", "aftret_equitya",
    "aftret_invcapxa", "gpma", "npma", "opmada", "opmbda", "pretret_earnata", "pretret_noa",
    "ptpma", "roaa", "rocea", "roea", "de_ratioa", "debt_ata", "lt_ata", "debt_capitala",
    "intcova", "intcov_ratioa", "dpra", "PEG_1yrforwarda", "PEG_ltgforwarda", "PEG_trailinga",
    "bma", "capeia2", "divyielda", "evma", "pcfa", "pe_exia", "pe_inca",
]


# The global annual family has no advertising, labour, growth-multiple or dividend-yield ratio.
ANNUAL_COLS_GLB = [c for c in ANNUAL_COLS if c not in (
    "adv_salea", "staff_salea", "PEG_1yrforwarda", "PEG_ltgforwarda", "PEG_trailinga", "divyielda")]


def annual_panel_global(df: DataFrame, key: str = "isin", date: str = "datadate") -> DataFrame:
    """One row per (security, fiscal year end), market value and prices from
    the company's own price file alone."""
    from .panel import dedup_first
    values = [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]
    none = F.lit(None).cast("double")
    return dedup_first(df, [key, date], [F.col(date), F.xxhash64(*values)]).withColumns(
        dict.fromkeys(("mcap_crsp", "prc_crsp_unadj", "prc_crsp_adj", "dvrate", "futepsgrowth", "ltg_eps"), none))


def annual_ratios_global(df: DataFrame, key: str = "isin", date: str = "datadate") -> DataFrame:
    """Global annual ratios, keyed by security.  Those whose definition differs
    from the US family: gross profit is always revenue less cost; net operating
    assets, capital employed and total assets under debt count a missing item
    as 0; after-tax return takes income less preferred dividends; payout is over
    ``ibc``; book to market and enterprise value use the panel's market value."""
    w = firm_window(key, date)
    us = annual_ratios(annual_panel_global(df, key, date), key, date, keep=(
        "mktcap", "revt", "cogs", "sale", "at", "ib", "dvp", "dvc", "ibc", "ceq", "dltt", "dlc", "mib", "pstk",
        "ppent", "act", "lct", "oiadp", "dp", "ebit", "xsga", "ebitda", "oibdp", "bea"))
    gross = z("revt") - z("cogs")
    noa = z("ppent") + z("act") - z("lct")
    debt = z("dltt") + z("dlc")
    capital = debt + z("ceq")
    ev = debt + z("mib") + z("pstk") + z("mktcap")
    d = us.select("*", lag(noa, w).alias("_noa1"), lag(capital, w).alias("_capital1"), lag(z("ceq"), w).alias("_ceq1"))
    own = {
        "GProfa": div(gross, col("at")),
        "gpma": div(gross, col("sale")),
        "aftret_eqa": div(z("ib") - z("dvp"), (z("ceq") + col("_ceq1")) / 2),
        "pretret_noa": div(F.coalesce(col("oiadp"), -z("dp")), (z("_noa1") + noa) / 2),
        "rocea": div(F.coalesce(col("ebit"), z("sale") - z("cogs") - z("xsga") - z("dp")), (capital + col("_capital1")) / 2),
        "debt_ata": div(debt, z("at")),
        "dpra": div("dvc", "ibc"),
        "bma": div("bea", "mktcap"),
        "evma": div_or(ev, col("ebitda"), div_or(ev, col("oibdp"), div(ev, z("sale") - z("cogs") - z("xsga")))),
    }
    return d.select(key, date, *[own[c].alias(c) if c in own else F.col(c) for c in ANNUAL_COLS_GLB])


def annual_ratios(df: DataFrame, key: str = "gvkey", date: str = "datadate", keep: tuple[str, ...] = ()) -> DataFrame:
    """US annual ratios (computed by the reference but never returned), with
    the input or intermediate columns named in ``keep``.

    Two-period averages use the previous fiscal year of the same firm; the
    EPS growth lags are 1, 2 and 3 years; ``roea`` uses the two-period
    average of book equity and ``debt_capitala`` its stated definition."""
    w = firm_window(key, date)

    def lz(x, k=1):
        return lag(z(x), w, k)

    def avg2(x):
        return (z(x) + lz(x)) / 2

    def d1(x):
        return z(x) - lz(x)

    a = df.select(
        "*",
        F.coalesce("mcap_crsp", "mcap_comp").alias("mktcap"),
        F.coalesce("prc_crsp_unadj", "prc_comp_unadj").alias("price_unadj"),
        F.coalesce("prc_crsp_adj", "prc_comp_adj").alias("price_adj"))
    bea = z("seq") + z("txditc") - z("pstk")
    noa = sub0(add0("ppent", "act"), "lct")
    pe_exi = div("epsfx", "ajex")
    b = a.select(
        "*",
        F.coalesce(col("oancf"), z("ib") - (d1("act") - d1("che") - d1("lct") + d1("dlc") + d1("txp") - z("dp")))
        .alias("ocf"),
        bea.alias("bea"), lag(bea, w).alias("bea_l"),
        lag(noa, w).alias("noa1a"), noa.alias("noa2a"),
        pe_exi.alias("pe_exi"), lag(pe_exi, w, 1).alias("pe1"), lag(pe_exi, w, 2).alias("pe2"),
        lag(pe_exi, w, 3).alias("pe3"),
        rolling_mean("ib", w, 5).alias("capeia"),
        lead("price_adj", w).alias("lead_price_adj"), lead("mktcap", w).alias("lead_mktcap"),
        avg2("at").alias("at_avg"), avg2("invt").alias("invt_avg"), avg2("ap").alias("ap_avg"),
        avg2("rect").alias("rect_avg"), avg2("dltt").alias("dltt_avg"), avg2("dlc").alias("dlc_avg"),
        avg2("ceq").alias("ceq_avg"), avg2("seq").alias("seq_avg"), d1("invt").alias("d_invt"),
        (lz("icapt") + lz("txditc") + lag(z(-col("mib")), w)).alias("lagcap"),
        (lz("ppent") + lz("act") + (z("ppent") + z("act"))).alias("ppent_act2"),
        (z("dltt") + lz("dltt") + z("dlc") + lz("dlc") + col("ceq") + lz("ceq")).alias("capital2"),
    )
    grosspa = F.coalesce(col("gp"), z("revt") - z("cogs"))
    oiada43 = F.coalesce(col("oiadp"), z("oibdp") - z("dp"))
    oiada45 = F.coalesce(col("oiadp"), z("oiadp") - z("dp"))
    ebitdaa = F.coalesce(col("ebitda"), col("oibdp"), z("sale") - z("cogs") - z("xsga"))
    pe58 = div("lead_price_adj", "pe_exi")
    g3 = (z(div("pe_exi", "pe1") - 1) + z(div("pe1", "pe2") - 1) + z(div("pe2", "pe3") - 1)) / 3
    eva = z("dltt") + z("dlc") + z("mib") + z("pstk") + z("prcc_f") * z("csho")
    c = {
        "capital_ratioa": div("dltt", z("dltt") + z("ceq") + z("pstk")),
        "equity_invcapa": div("ceq", "icapt"),
        "debt_invcapa": div("dltt", "icapt"),
        "totdebt_invcapa": div(z("dltt") + z("dlc"), z("icapt")),
        "at_turna": div("sale", "at_avg"),
        "inv_turna": div("cogs", "invt_avg"),
        "pay_turna": div(z("cogs") + col("d_invt"), col("ap_avg")),
        "rect_turna": div("sale", "rect_avg"),
        "sale_equitya": div("sale", "seq"),
        "sale_invcapa": div("sale", "icapt"),
        "sale_nwc": div("sale", z("act") - z("lct")),
        "invt_acta": div("invt", "act"),
        "rect_acta": div("rect", "act"),
        "fcf_ocfa": div(z("ocf") - z("capx"), col("ocf")),
        "ocf_lcta": div("ocf", "lct"),
        "cash_debta": div(col("ocf"), F.coalesce(col("lt"), z("dltt") + z("dlc"))),
        "cash_lta": div("che", "lt"),
        "cfma": div(z("ibc") + z("dpc"), col("sale")),
        "short_debta": div("dlc", z("dltt") + z("dlc")),
        "profit_lcta": div(F.coalesce(col("oibdp"), z("sale") - z("xopr")), col("lct")),
        "curr_debta": div("lct", "lt"),
        "debt_ebitda": div(z("dltt") + z("dlc"), ebitdaa),
        "dltt_bea": div("dltt", "bea"),
        "int_debta": div("xint", "dltt_avg"),
        "int_totdebta": div(col("xint"), col("dltt_avg") + col("dlc_avg")),
        "lt_debta": div("dltt", "lt"),
        "lt_ppenta": div("lt", "ppent"),
        "cash_conversiona": (div("invt_avg", z("cogs") / 365) + div("rect_avg", z("sale") / 365)
                             - div("ap_avg", z("cogs") / 365)),
        "cash_ratioa": div("che", "lct"),
        "curr_ratioa": div(F.coalesce(col("act"), z("che") + z("rect") + z("invt")), col("lct")),
        "quick_ratioa": div(z("act") - z("invt"), col("lct")),
        "accruala": div(z("oancf") - z("ib"), col("at_avg")),
        "rd_salea": div(col("xrd") + 0, col("sale")),
        "adv_salea": div(col("xad") + 0, col("sale")),
        "staff_salea": div(col("xlr") + 0, col("sale")),
        "efftaxa": div(col("txt"), F.coalesce(col("pi"), z("oiadp") - z("xint") + z("spi") + z("nopi"))),
        "GProfa": div(grosspa, col("at")),
        "aftret_eqa": div(F.coalesce(col("ibcom"), z("ib") - z("dvp")), col("ceq_avg")),
        "aftret_equitya": div("ib", "seq_avg"),
        "aftret_invcapxa": div(z("ib") + z("xint") + z("mii"), col("lagcap")),
        "gpma": div(grosspa, col("sale")),
        "npma": div("ib", "sale"),
        "opmada": div(oiada43, col("sale")),
        "opmbda": div(F.coalesce(col("oibdp"), z("sale") - z("xopr")), col("sale")),
        "pretret_earnata": div(oiada45, col("ppent_act2") / 2),
        "pretret_noa": div(F.coalesce(col("oiadp"), z("oiadp") - z("dp")), (z("noa1a") + z("noa2a")) / 2),
        "ptpma": div(F.coalesce(col("pi"), z("oiadp") - z("xint") + z("spi") + z("nopi")), col("sale")),
        "roaa": div(F.coalesce(col("oibdp"), z("sale") - z("xopr")), col("at_avg")),
        "rocea": div(F.coalesce(col("ebit"), z("sale") - z("cogs") - z("xsga") - z("dp")), col("capital2") / 2),
        "roea": div(col("ib"), (z("bea") + z("bea_l")) / 2),
        "de_ratioa": div(z("dltt") + z("dlc"), z("ceq") + z("pstk")),
        "debt_ata": div(z("dltt") + z("dlc"), col("at")),
        "lt_ata": div("lt", "at"),
        "debt_capitala": div(z("ap") + z("dlc") + z("dltt"),
                             (z("ap") + z("dlc") + z("dltt")) + (z("ceq") + z("pstk"))),
        "intcova": div(z("xint") + z("ib"), col("xint")),
        "intcov_ratioa": div(F.coalesce(col("ebit"), col("oiadp"), z("sale") - z("cogs") - z("xsga") - z("dp")),
                             col("xint")),
        "dpra": div("dvc", "ibadj"),
        "PEG_1yrforwarda": div(F.abs(pe58), col("futepsgrowth") * 100),
        "PEG_ltgforwarda": div(F.abs(pe58), col("ltg_eps")),
        "PEG_trailinga": div(div("price_adj", "pe_exi"), 100 * g3),
        "bma": div(col("bea"), col("prcc_f") * col("csho")),
        "capeia2": div("lead_mktcap", "capeia"),
        "divyielda": div("dvrate", "price_unadj"),
        "evma": div_or(eva, col("ebitda"), div_or(eva, col("oibdp"), div(z(eva), z("sale") - z("cogs") - z("xsga")))),
        "pcfa": div("lead_mktcap", "oancf"),
        "pe_exia": div("lead_price_adj", "pe_exi"),
        "pe_inca": div(col("lead_price_adj"), div("epsfi", "ajex")),
    }
    return b.select(key, date, *keep, *[c[n].alias(n) for n in ANNUAL_COLS])
