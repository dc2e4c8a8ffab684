"""Ratio family queries and their DuckDB oracles."""
from __future__ import annotations

import re

from pyspark.sql import functions as F

from ..operators import panel as P
from ..operators import ratios as R
from ..session import by_key, written
from ..sources import adapters as A
from . import inputs as I
from . import oracle as O
from .registry import register

z, nz, dv, dv_or, add0, sub0 = O.z, O.nz, O.dv, O.dv_or, O.add0, O.sub0

_PANEL_DOUBLES = (["prccq", "cshoq", "ajexq"] + A.Q_ITEMS + A.Q_YTD_ITEMS +
                  ["mcap_crsp", "prc_crsp_unadj", "prc_crsp_adj", "mcap_comp",
                   "prc_comp_unadj", "prc_comp_adj", "dvrate", "futepsgrowth", "ltg_eps"])


#: wide rows of a task
PANEL_ROWS = 25_000
#: columns of the US panel that the global panel does not bring
_US_ONLY = {"mcap_crsp", "prc_crsp_unadj", "prc_crsp_adj", "dvrate", "futepsgrowth", "ltg_eps"}


def prep_ctes() -> str:
    """DuckDB: the quarterly preparation chain over ``a_panelq`` (one row per
    firm-date, no all-null rows, zero fill after first, interpolation, R&D
    zero fill, group sum), ending in CTE ``p_gs``."""
    vals = _PANEL_DOUBLES
    nn = " OR ".join(f"{c} IS NOT NULL" for c in vals if c != "ajexq")
    run = "OVER (PARTITION BY gvkey ORDER BY datadate ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    zf = ", ".join(f"CASE WHEN count({c}) {run} > 0 THEN coalesce({c}, 0.0) END AS {c}"
                   for c in P.ZERO_FILL_Q if c in vals)
    ip = ", ".join(O.interp_sql(c) for c in P.INTERPOLATE_Q if c in vals)
    keys = ", ".join(P.PANEL_GROUP_KEYS)
    return f"""p_dd AS (SELECT * EXCLUDE (rn_dd) FROM (
    SELECT *, row_number() OVER (PARTITION BY gvkey, datadate ORDER BY datadate) AS rn_dd FROM a_panelq) t
  WHERE rn_dd = 1),
p_nn AS (SELECT * FROM p_dd WHERE {nn}),
p_zf AS (SELECT * REPLACE ({zf}) FROM p_nn),
p_ip AS (SELECT * REPLACE ({ip}) FROM (
    SELECT *, row_number() OVER (PARTITION BY gvkey ORDER BY datadate) AS rn FROM p_zf) t),
p_rd AS (SELECT * REPLACE (CASE WHEN count(xrdq) {run} > 0 THEN coalesce(xrdq, 0.0) END AS xrdq) FROM p_ip),
p_gs AS (SELECT {keys}, {", ".join(f"sum({c}) AS {c}" for c in vals)} FROM p_rd
  WHERE {" AND ".join(k + " IS NOT NULL" for k in P.PANEL_GROUP_KEYS)}
  GROUP BY {keys})"""


_GICS_CTE = """gics1 AS (
  SELECT gvkey, gsector, ggroup, gind FROM (
    SELECT *, row_number() OVER (PARTITION BY gvkey ORDER BY indfrom, gind) AS rn FROM a_gics) t
  WHERE rn = 1)"""


def prep_global_ctes() -> str:
    """DuckDB: the global preparation over ``a_panelq_global``, ending in ``g_ip``."""
    run = "OVER (PARTITION BY isin ORDER BY datadate ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    zf = ", ".join(f"CASE WHEN count({c}) {run} > 0 THEN coalesce({c}, 0.0) END AS {c}" for c in P.ZERO_FILL_GLOBAL)
    ip = ", ".join(O.interp_sql(c).replace("PARTITION BY gvkey", "PARTITION BY isin") for c in P.INTERPOLATE_GLOBAL if c in _PANEL_DOUBLES)
    return f"""{_GICS_CTE},
g_dd AS (SELECT t.* EXCLUDE (rn_dd), gsector, ggroup, gind FROM (
    SELECT *, row_number() OVER (PARTITION BY isin, datadate ORDER BY datadate) AS rn_dd FROM a_panelq_global) t JOIN gics1 USING (gvkey)
  WHERE rn_dd = 1 AND gsector <> '40' AND cast(gsector AS int) > 0),
g_zf AS (SELECT * REPLACE ({zf}) FROM g_dd),
g_ip AS (SELECT * REPLACE ({ip}) FROM (
    SELECT *, row_number() OVER (PARTITION BY isin ORDER BY datadate) AS rn FROM g_zf) t)"""


def ratios_cte(region: str = "US") -> tuple[str, str]:
    """CTE chain (without WITH) computing every quarterly ratio; returns
    (ctes, final cte name)."""
    us = region == "US"
    key = "gvkey" if us else "isin"
    mp = 4 if us else 1

    def T(x):
        return O.t4(x, mp, key)

    def M(x):
        return O.m4(x, mp, key)

    def L(x, k=1):
        return O.lag(x, k, key)

    def D4(x):
        return f"({x} - {L(x, 4)})"

    w = O.W(key)
    if us:
        src = "SELECT * FROM p_gs"
    else:
        src = ("SELECT " + ", ".join(f"coalesce({c}, 0.0) AS {c}" for c in _PANEL_DOUBLES if c not in _US_ONLY)
               + ", " + ", ".join([*P.PANEL_GROUP_KEYS, "gsector", "ggroup", "gind"]) + " FROM g_ip")
    ytd = {"oancfq": "oancfy", "capxq": "capxy", "dpcq": "dpcy", "ibcq": "ibcy",
           "dpq": "dpy", "dvq": "dvy"}
    if not us:
        ytd.update({"xidocq": "xidocy", "txdcq": "txdcy"})
    ytd_sql = ",\n  ".join(
        f"CASE WHEN fqtr = 1 THEN {s} ELSE {s} - lag({s}) {w} END AS {d}" for d, s in ytd.items())
    if us:
        prices = ("coalesce(mcap_crsp, mcap_comp) AS mktcap, coalesce(prc_crsp_unadj, prc_comp_unadj) AS price_unadj, "
                  "coalesce(prc_crsp_adj, prc_comp_adj) AS price_adj")
    else:
        prices = "mcap_comp AS mktcap, prc_comp_unadj AS price_unadj, prc_comp_adj AS price_adj"
    qa = (prep_ctes() if us else prep_global_ctes()) + f",\nqsrc AS ({src}),\nqa AS (SELECT * EXCLUDE (dpq),\n  {ytd_sql},\n  {prices}\nFROM qsrc)"

    txd = "txditcq" if us else "txdcq"
    beq = f"({z('seqq')} + {z(txd)} - {z('pstkq')})"
    ibq2 = f"coalesce(ibq, {z('niq')} + {z('xidoq')})" if us else "ibq"
    txp = f" + {D4(z('txpq'))}" if us else ""
    ocf_inner = (f"({D4(z('actq'))} + -{D4(z('cheq'))} + -{D4(z('lctq'))} + {D4(z('dlcq'))}{txp} + -{z('dpq')})")
    b = {
        "T_sale": T("saleq"), "T_cogs_z": T(z("cogsq")), "T_sale_z": T(z("saleq")),
        "T_xopr_z": T(z("xoprq")), "T_xsga_z": T(z("xsgaq")), "T_oibdp": T("oibdpq"),
        "T_ibq": T("ibq"), "M_lct": M("lctq"), "M_lt": M("ltq"), "M_at": M("atq"),
        "capital_ratioq": dv(M("dlttq"), f"{M(z('dlttq'))} + {M(z('ceqq') + ' + ' + z('pstkq'))}"),
        "at_turnq": dv(T("saleq"), M("atq")),
        "inv_turnq": dv(T("cogsq"), M(nz("invtq") if us else "invtq")),
        "pay_turnq": dv(f"{T(z('cogsq'))} + {D4(z('invtq'))}", M(nz("apq") if us else "apq")),
        "rect_turnq": dv(T("saleq"), M(nz("rectq") if us else "rectq")),
        "sale_equityq": dv(T("saleq"), M("seqq")),
        "sale_nwcq": dv(T("saleq"), M(sub0("actq", "lctq") if us else f"{z('actq')} - {z('lctq')}")),
        "invt_actq": dv(M("invtq"), M("actq")),
        "rect_actq": dv(M("rectq"), M("actq")),
        "ocf": f"coalesce({T('oancfq')}, {T(z('ibq'))} - {ocf_inner})",
        "T_capx_z": T(z("capxq")),
        "cash_ltq": dv(M("cheq"), M("ltq")),
        "incomeq": f"coalesce({T(z('ibcq') + ' + ' + z('dpcq'))}, {T(z('ibq'))} + {z('dpq')})",
        "short_debtq": dv(M("dlcq"), M(f"{z('dlttq')} + {z('dlcq')}")),
        "opibd": f"coalesce({T('oibdpq')}, {T(z('saleq'))} - {T(z('xoprq'))})",
        "curr_debtq": dv(M("lctq"), M("ltq")),
        "ebitdaq": f"coalesce({T('oibdpq')}, {T(z('saleq') + ' - ' + z('cogsq') + ' - ' + z('xsgaq'))})",
        "M_debt_sum": M(add0("dlttq", "dlcq") if us else f"{z('dlttq')} + {z('dlcq')}"),
        "dltt_beq": dv(M("dlttq"), M(beq)),
        "int_debtq": dv(T("xintq"), M(nz("dlttq") if us else "dlttq")),
        "int_totdebtq": dv(T("xintq"), M(f"{nz('dlttq')} + {nz('dlcq')}" if us else f"{z('dlttq')} + {z('dlcq')}")),
        "lt_debtq": dv(M("dlttq"), M("ltq")),
        "lt_ppentq": dv(M("ltq"), M(nz("ppentq") if us else "ppentq")),
        "cash_conversionq": (f"{dv(M('invtq'), T(z('cogsq')) + ' / 365')} + {dv(M(z('rectq')), T(z('saleq')) + ' / 365')}"
                             f" - {dv(M(z('apq')), T(z('cogsq')) + ' / 365')}"),
        "cash_ratioq": dv(M("cheq"), M("lctq")),
        "currentq": f"coalesce({M('actq')}, {M(z('cheq') + ' + ' + z('rectq') + ' + ' + z('invtq'))})",
        "caniq": f"coalesce({M(z('actq') + ' - ' + z('invtq'))}, {M(z('cheq') + ' + ' + z('rectq'))})",
        "accrq": (f"coalesce({z('oancfq')} - {z('ibq')}, -({D4(z('actq'))} + -{D4(z('cheq'))} + -{D4(z('lctq'))}"
                  f" + {D4(z('dlcq'))}{txp} + {T('-' + z('dpq'))}))"),
        "at5": f"({z('atq')} + {L(z('atq'), 1)} + {L(z('atq'), 2)} + {L(z('atq'), 3)} + {L(z('atq'), 4)}) / 5",
        "incometaxq": f"coalesce({T('piq')}, {T(z('oiadpq'))} - {T(z('xintq'))} + {T(z('spiq'))} + {T(z('nopiq'))})",
        "T_txt": T("txtq"),
        "GProfq": dv(T(f"{z('revtq')} - {z('cogsq')}"), M("atq")),
        "niaftq": (f"coalesce({T('ibcomq')}, {T(z('ibq') + ' - ' + z('dvpq'))})" if us
                   else T(sub0("ibq", "dvpdpq"))),
        "M_ceq": M("ceqq"), "M_seq": M("seqq"),
        "gpmq": (dv(T("revtq - cogsq"), T("saleq")) if us
                 else dv(T(f"{z('revtq')} - {z('cogsq')}"), T(z("saleq")))),
        "npmq": dv(T("ibq"), T("saleq")),
        "oiadq": (f"coalesce({T('oiadpq')}, {T(z('oibdpq') + ' - ' + z('dpq'))}, "
                  f"{T(z('saleq') + ' - ' + z('xoprq') + ' - ' + z('dpq'))})"),
        "opmbdq": dv(f"coalesce({T('oibdpq')}, {T(z('saleq'))} - {T(z('xoprq'))})", T("saleq")),
        "oiadq45": (f"coalesce({T('oiadpq')}, {T(sub0('oibdpq', 'dpq'))}, {T(sub0(sub0('saleq', 'xoprq'), 'dpq'))})" if us
                    else f"coalesce({T('oiadpq')}, {T(z('oibdpq') + ' - ' + z('dpq'))}, "
                         f"{T(z('saleq') + ' - ' + z('xoprq') + ' - ' + z('dpq'))})"),
        "M_ppent_act": M(add0("ppentq", "actq") if us else f"{z('ppentq')} + {z('actq')}"),
        "oibdq": (f"coalesce({T('oibdpq')}, {T(sub0('oiadpq', 'dpq'))}, {T(sub0(sub0('saleq', 'xoprq'), 'dpq'))})" if us
                  else f"coalesce({T('oibdpq')}, {T(z('oiadpq'))} - {T(z('dpq'))}, "
                       f"{T(z('saleq'))} - {T(z('xoprq'))} - {T(z('dpq'))})"),
        "M_noa": M(sub0(add0("ppentq", "actq"), "lctq") if us else f"{z('ppentq')} + {z('actq')} - {z('lctq')}"),
        "pretaxiq": f"coalesce({T('piq')}, {T(z('oiadpq'))} - {T(z('xintq'))} + {T(z('spiq'))} + {T(z('nopiq'))})",
        "oiadq_roa": f"coalesce({T('oibdpq')}, {T(z('saleq'))} - {T(z('xoprq'))})",
        "earningsq": (f"coalesce({T('oiadpq')}, {T(z('oibdpq'))} - {T(z('dpq'))}, "
                      f"{T(z('saleq'))} - {T(z('xoprq'))} - {T(z('dpq'))}, "
                      f"{T(z('saleq'))} - {T(z('cogsq'))} - {T(z('xsgaq'))} - {T(z('dpq'))})"),
        "M_capital": M(f"{z('dlttq')} + {z('dlcq')} + {z('ceqq')}"),
        "M_beq": M(beq),
        "de_ratioq": (dv(M("ltq"), z(M("ceqq + pstkq"))) if us
                      else dv(M("ltq"), M(f"{z('ceqq')} + {z('pstkq')}"))),
        "debt_atq": dv(M(f"{z('dlttq')} + {z('dlcq')}"), M("atq") if us else M(z("atq"))),
        "lt_atq": dv(M("ltq"), M("atq")),
        "debt_capitalq": dv(f"{M(z('apq'))} + {M(z('dlcq') + ' + ' + z('dlttq'))}",
                            f"{M(z('apq'))} + {M(z('dlcq') + ' + ' + z('dlttq'))} + {M(z('ceqq') + ' + ' + z('pstkq'))}"),
        "intcovq": dv(T(f"{z('xintq')} + {z('ibq')}"), T(nz("xintq") if us else "xintq")),
        "earningsq56": (f"coalesce({T('oiadpq')}, {T(z('saleq'))} - {T(z('cogsq'))} - {T(z('xsgaq'))}"
                        f" - {T(z('dpq'))})"),
        "T_xint_nz": T(nz("xintq") if us else "xintq"),
        "beq": beq,
        "capei_t": T(ibq2),
        "ocf2": (f"coalesce({T('oancfq')}, {T(z(ibq2))} - {D4(z('actq'))} + -{D4(z('cheq'))} + -{D4(z('lctq'))}"
                 f" + {D4(z('dlcq'))}{txp} + -{z('dpq')})"),
        "evq": (f"{M(z('dlttq'))} + {M(z('dlcq'))} + {M(z('mibq'))} + {M(z('pstkq'))} + "
                + (M(f"{z('prccq')} * {z('cshoq')}") if us else M(z("mktcap")))),
        "lead_price_adj": O.lead("price_adj", 1, key),
        "lead_mktcap": O.lead("mktcap", 1, key),
    }
    if us:
        b.update({
            "equity_invcapq": dv(M("ceqq"), M("icaptq")),
            "debt_invcapq": dv(M("dlttq"), M("icaptq")),
            "totdebt_invcapq": dv(f"{M(z('dlttq'))} + {M(z('dlcq'))}", M(z("icaptq"))),
            "sale_invcapq": dv(T("saleq"), M("icaptq")),
            "rd_saleq": dv(T("xrdq + 0"), T("saleq")),
            "M_lagcap": M(f"{z('icaptq')} + {z('txditcq')} + -{z('mibq')}"),
            "T_aftret_num": T(f"{z('ibq')} + {z('xintq')} + {z('miiq')}"),
            "pe_exi": f"coalesce(epsf12, {T(dv('epsfxq', 'ajexq'))})",
            "T_dv_dvp": T(f"{z('dvq')} + {z('dvpq')}"), "T_ibadj": T("ibadjq"),
            "T_eps_fx": T(dv("epsfxq", "ajexq")), "T_eps_fi": T(dv("epsfiq", "ajexq")),
            "T_eps_op": T(dv("opepsq", "ajexq")), "T_eps_opx": T(dv("oepsxq", "ajexq")),
            "M_dvrate": M("dvrate"), "M_price_unadj": M("price_unadj"),
        })
    else:
        b.update({"T_dv": T("dvq"), "T_ibc": T("ibcq")})
    qb = "qb AS (SELECT *,\n  " + ",\n  ".join(f"{v} AS {n}" for n, v in b.items()) + "\nFROM qa)"

    c = {
        "lag_M_ceq": L("M_ceq"), "lag_M_seq": L("M_seq"), "lag_M_at": L("M_at"),
        "lag_M_ppent_act": L("M_ppent_act"), "lag_M_noa": L("M_noa"),
        "lag_M_capital": L("M_capital"), "lag_M_beq": L("M_beq"),
        "capei20": O.ordered_mean("capei_t", 20, key),
    }
    if us:
        c.update({"lagicapt4": L("M_lagcap"), "lag4_pe_exi": L("pe_exi", 4),
                  "lag8_pe_exi": L("pe_exi", 8), "lag12_pe_exi": L("pe_exi", 12)})
    qc = "qc AS (SELECT *,\n  " + ",\n  ".join(f"{v} AS {n}" for n, v in c.items()) + "\nFROM qb)"

    d = {
        "fcf_ocfq": dv(f"{z('ocf')} - T_capx_z", "ocf"),
        "ocf_lctq": dv("ocf", "M_lct"), "cash_debtq": dv("ocf", "M_lt"),
        "cfmq": dv("incomeq", "T_sale"), "profit_lctq": dv("opibd", "M_lct"),
        "debt_ebitdaq": dv("M_debt_sum", "ebitdaq"),
        "curr_ratioq": dv("currentq", "M_lct"), "quick_ratioq": dv("caniq", "M_lct"),
        "accrualq": dv("accrq", "at5"), "efftaxq": dv("T_txt", "incometaxq"),
        "aftret_eqq": dv("niaftq", "lag_M_ceq"), "aftret_equityq": dv("T_ibq", "lag_M_seq"),
        "opmadq": dv("oiadq", "T_sale"), "pretret_earnatq": dv("oiadq45", "lag_M_ppent_act"),
        "pretret_noq": dv("oibdq", "lag_M_noa"), "ptpmq": dv("pretaxiq", "T_sale"),
        "roaq": dv("oiadq_roa", "lag_M_at"), "roceq": dv("earningsq", "lag_M_capital"),
        "roeq": dv("T_ibq", "lag_M_beq"), "intcov_ratioq": dv("earningsq56", "T_xint_nz"),
        "capeiq": dv("lead_mktcap", "capei20"),
        "evmq": dv_or("evq", "T_oibdp", dv("evq", "T_sale_z - T_cogs_z - T_xsga_z")),
        "pcfq": dv("lead_mktcap", "ocf2"), "psq": dv("lead_mktcap", "T_sale"),
        "ptbq": dv("lead_mktcap", "beq"),
    }
    if us:
        pe58 = dv("lead_price_adj", "pe_exi")
        g3 = (f"(({z(dv('pe_exi', 'lag4_pe_exi') + ' - 1')}) + ({z(dv('lag4_pe_exi', 'lag8_pe_exi') + ' - 1')})"
              f" + ({z(dv('lag8_pe_exi', 'lag12_pe_exi') + ' - 1')})) / 3")
        d.update({
            "aftret_invcapxq": dv("T_aftret_num", "lagicapt4"),
            "dprq": dv_or("T_dv_dvp", "ibadj12", dv("T_dv_dvp", "T_ibadj")),
            "PEG_1yrforward": dv(f"abs({pe58})", "futepsgrowth * 100"),
            "PEG_ltgforward": dv(f"abs({pe58})", "ltg_eps"),
            "PEG_trailing": dv(dv("price_adj", "pe_exi"), f"100 * ({g3})"),
            "bmq": f"(CASE WHEN {z('prccq * cshoq')} < 0 THEN NULL ELSE {dv(beq, 'prccq * cshoq')} END)",
            "divyieldq": dv_or("M_dvrate", "M_price_unadj", "0.0"),
            "pe_exiq": dv_or("lead_price_adj", "epsf12", dv("lead_price_adj", "T_eps_fx")),
            "pe_incq": dv_or("lead_price_adj", "epsfi12", dv("lead_price_adj", "T_eps_fi")),
            "pe_op_basicq": dv_or("lead_price_adj", "oeps12", dv("lead_price_adj", "T_eps_op")),
            "pe_op_dilq": dv_or("lead_price_adj", "oepf12", dv("lead_price_adj", "T_eps_opx")),
        })
    else:
        d.update({"dprq": dv("T_dv", "T_ibc"), "bmq": dv("beq", "mcap_comp")})
    qd = "qd AS (SELECT *,\n  " + ",\n  ".join(f"{v} AS {n}" for n, v in d.items()) + "\nFROM qc)"
    return ",\n".join([qa, qb, qc, qd]), "qd"


def _family_sql(fam: str, region: str = "US") -> str:
    ctes, last = ratios_cte(region)
    key = "gvkey" if region == "US" else "isin"
    cols = (R.FAMILIES_US if region == "US" else R.FAMILIES_GLB)[fam]
    return O.sql(["a_panelq"] if region == "US" else ["a_panelq_global", "a_gics"], f"SELECT {key}, datadate, {', '.join(cols)} FROM {last}", ctes)


def prepared_panel(spark, sf):
    """The ratio input: the firm-quarter panel after the quarterly preparation.
    The panel is written once: its readers do not derive it again, and its
    firms are dealt into tasks of a bounded size."""
    return P.prepare_quarterly(by_key(written(I.us_panel(spark, sf)), "gvkey", rows=PANEL_ROWS))


def _family_query(fam: str):
    def run(spark, sf):
        return R.family(prepared_panel(spark, sf), fam, R.US)
    run.__name__ = f"ratios_{fam}"
    return run


for _fam in R.FAMILIES_US:
    register(f"ratios_{_fam}", _family_sql(_fam))(_family_query(_fam))


def prepared_global(spark, sf):
    """The global ratio input: the panel by security after its preparation."""
    gics = P.dedup_first(A.load(spark, sf, "a_gics"), ["gvkey"], ["indfrom", "gind"])
    return P.prepare_global(by_key(written(I.global_panel(spark, sf)), "isin", rows=PANEL_ROWS), gics)


@register("ratios_global", O.sql(["a_panelq_global", "a_gics"], "SELECT isin, datadate, "
                                 + ", ".join(R.ratio_columns(R.GLOBAL)) + " FROM " + ratios_cte("GLB")[1],
                                 ratios_cte("GLB")[0]))
def ratios_global(spark, sf):
    return R.quarterly_ratios(prepared_global(spark, sf), R.GLOBAL).select(
        "isin", "datadate", *R.ratio_columns(R.GLOBAL))


def _monthly_sql(region: str = "US") -> str:
    ctes, last = ratios_cte(region)
    us = region == "US"
    key = "gvkey" if us else "isin"
    rounded = R.ratio_columns(R.US if us else R.GLOBAL) + ([] if us else R.GLOBAL_PRICES)
    plain = [] if us else R.GLOBAL_KEYS
    grid = f"""qq AS (SELECT {key}, datadate, datadate AS qdate, {O.t4('cast(fqtr AS double)', 4, key)} AS qtrcheck,
    {', '.join(plain + rounded)} FROM {last}),
months AS (SELECT DISTINCT last_day(cast(m AS date)) AS datadate FROM (
    SELECT unnest(generate_series(date_trunc('month', min(datadate)), date_trunc('month', max(datadate)),
                                  INTERVAL 1 MONTH)) AS m FROM qq) t),
grid AS (SELECT f.{key}, m.datadate FROM (SELECT DISTINCT {key} FROM qq) f CROSS JOIN months m),
filled AS (SELECT g.{key}, g.datadate, {', '.join(
        f"last_value(q.{c} IGNORE NULLS) OVER (PARTITION BY g.{key} ORDER BY g.datadate ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS {c}"
        for c in ['qdate', 'qtrcheck'] + plain + rounded)}
  FROM grid g LEFT JOIN qq q ON g.{key} = q.{key} AND g.datadate = q.datadate)"""
    body = (f"SELECT {key}, datadate, qdate, last_day(datadate + INTERVAL 2 MONTH) AS publicdate, qtrcheck, "
            + "".join(f"{c}, " for c in plain)
            + ", ".join(f"round_even({c} * 10000.0, 0) / 10000.0 AS {c}" for c in rounded)
            + " FROM filled WHERE qtrcheck = 10")
    return O.sql(["a_panelq"] if us else ["a_panelq_global", "a_gics"], body, ctes + ",\n" + grid)


@register("ratio_monthly_panel", _monthly_sql())
def ratio_monthly_panel(spark, sf):
    return R.monthly_panel(R.quarterly_ratios(prepared_panel(spark, sf)), R.ratio_columns(R.US))


@register("ratio_monthly_global", _monthly_sql("GLB"))
def ratio_monthly_global(spark, sf):
    """The global monthly panel with its output columns: codes, fiscal keys,
    market value and prices next to the ratios."""
    q = R.quarterly_ratios(prepared_global(spark, sf), R.GLOBAL, keep=R.GLOBAL_KEYS + R.GLOBAL_PRICES)
    return R.monthly_panel(q, R.ratio_columns(R.GLOBAL) + R.GLOBAL_PRICES, key="isin", plain=R.GLOBAL_KEYS)


def _annual_sql() -> str:
    w = "OVER (PARTITION BY gvkey ORDER BY datadate)"

    def lz(x, k=1):
        return f"lag({z(x)}, {k}) {w}"

    def avg2(x):
        return f"(({z(x)} + {lz(x)}) / 2)"

    def d1(x):
        return f"({z(x)} - {lz(x)})"

    bea = f"({z('seq')} + {z('txditc')} - {z('pstk')})"
    noa = sub0(add0("ppent", "act"), "lct")
    pe = "(epsfx / nullif(ajex, 0))"
    stage_b = f"""ya AS (SELECT *, coalesce(mcap_crsp, mcap_comp) AS mktcap,
    coalesce(prc_crsp_unadj, prc_comp_unadj) AS price_unadj, coalesce(prc_crsp_adj, prc_comp_adj) AS price_adj
  FROM a_panela),
yb AS (SELECT *,
  coalesce(oancf, {z('ib')} - ({d1('act')} - {d1('che')} - {d1('lct')} + {d1('dlc')} + {d1('txp')} - {z('dp')})) AS ocf,
  {bea} AS bea, lag({bea}) {w} AS bea_l, lag({noa}) {w} AS noa1a, {noa} AS noa2a,
  {pe} AS pe_exi, lag({pe}, 1) {w} AS pe1, lag({pe}, 2) {w} AS pe2, lag({pe}, 3) {w} AS pe3,
  {O.ordered_mean("ib", 5)} AS capeia,
  lead(price_adj) {w} AS lead_price_adj, lead(mktcap) {w} AS lead_mktcap,
  {avg2('at')} AS at_avg, {avg2('invt')} AS invt_avg, {avg2('ap')} AS ap_avg, {avg2('rect')} AS rect_avg,
  {avg2('dltt')} AS dltt_avg, {avg2('dlc')} AS dlc_avg, {avg2('ceq')} AS ceq_avg, {avg2('seq')} AS seq_avg,
  {d1('invt')} AS d_invt,
  ({lz('icapt')} + {lz('txditc')} + lag(coalesce(-mib, 0.0)) {w}) AS lagcap,
  ({lz('ppent')} + {lz('act')} + ({z('ppent')} + {z('act')})) AS ppent_act2,
  ({z('dltt')} + {lz('dltt')} + {z('dlc')} + {lz('dlc')} + ceq + {lz('ceq')}) AS capital2
  FROM ya)"""
    grosspa = f"coalesce(gp, {z('revt')} - {z('cogs')})"
    pe58 = dv("lead_price_adj", "pe_exi")
    g3 = (f"(({z(dv('pe_exi', 'pe1') + ' - 1')}) + ({z(dv('pe1', 'pe2') + ' - 1')}) + "
          f"({z(dv('pe2', 'pe3') + ' - 1')})) / 3")
    eva = f"({z('dltt')} + {z('dlc')} + {z('mib')} + {z('pstk')} + {z('prcc_f')} * {z('csho')})"
    pi_fb = f"coalesce(pi, {z('oiadp')} - {z('xint')} + {z('spi')} + {z('nopi')})"
    c = {
        "capital_ratioa": dv("dltt", f"{z('dltt')} + {z('ceq')} + {z('pstk')}"),
        "equity_invcapa": dv("ceq", "icapt"), "debt_invcapa": dv("dltt", "icapt"),
        "totdebt_invcapa": dv(f"{z('dltt')} + {z('dlc')}", z("icapt")),
        "at_turna": dv("sale", "at_avg"), "inv_turna": dv("cogs", "invt_avg"),
        "pay_turna": dv(f"{z('cogs')} + d_invt", "ap_avg"), "rect_turna": dv("sale", "rect_avg"),
        "sale_equitya": dv("sale", "seq"), "sale_invcapa": dv("sale", "icapt"),
        "sale_nwc": dv("sale", f"{z('act')} - {z('lct')}"), "invt_acta": dv("invt", "act"),
        "rect_acta": dv("rect", "act"), "fcf_ocfa": dv(f"{z('ocf')} - {z('capx')}", "ocf"),
        "ocf_lcta": dv("ocf", "lct"), "cash_debta": dv("ocf", f"coalesce(lt, {z('dltt')} + {z('dlc')})"),
        "cash_lta": dv("che", "lt"), "cfma": dv(f"{z('ibc')} + {z('dpc')}", "sale"),
        "short_debta": dv("dlc", f"{z('dltt')} + {z('dlc')}"),
        "profit_lcta": dv(f"coalesce(oibdp, {z('sale')} - {z('xopr')})", "lct"),
        "curr_debta": dv("lct", "lt"),
        "debt_ebitda": dv(f"{z('dltt')} + {z('dlc')}",
                          f"coalesce(ebitda, oibdp, {z('sale')} - {z('cogs')} - {z('xsga')})"),
        "dltt_bea": dv("dltt", "bea"), "int_debta": dv("xint", "dltt_avg"),
        "int_totdebta": dv("xint", "dltt_avg + dlc_avg"), "lt_debta": dv("dltt", "lt"),
        "lt_ppenta": dv("lt", "ppent"),
        "cash_conversiona": (f"{dv('invt_avg', z('cogs') + ' / 365')} + {dv('rect_avg', z('sale') + ' / 365')}"
                             f" - {dv('ap_avg', z('cogs') + ' / 365')}"),
        "cash_ratioa": dv("che", "lct"),
        "curr_ratioa": dv(f"coalesce(act, {z('che')} + {z('rect')} + {z('invt')})", "lct"),
        "quick_ratioa": dv(f"{z('act')} - {z('invt')}", "lct"),
        "accruala": dv(f"{z('oancf')} - {z('ib')}", "at_avg"),
        "rd_salea": dv("xrd + 0", "sale"), "adv_salea": dv("xad + 0", "sale"),
        "staff_salea": dv("xlr + 0", "sale"), "efftaxa": dv("txt", pi_fb),
        "GProfa": dv(grosspa, "at"),
        "aftret_eqa": dv(f"coalesce(ibcom, {z('ib')} - {z('dvp')})", "ceq_avg"),
        "aftret_equitya": dv("ib", "seq_avg"),
        "aftret_invcapxa": dv(f"{z('ib')} + {z('xint')} + {z('mii')}", "lagcap"),
        "gpma": dv(grosspa, "sale"), "npma": dv("ib", "sale"),
        "opmada": dv(f"coalesce(oiadp, {z('oibdp')} - {z('dp')})", "sale"),
        "opmbda": dv(f"coalesce(oibdp, {z('sale')} - {z('xopr')})", "sale"),
        "pretret_earnata": dv(f"coalesce(oiadp, {z('oiadp')} - {z('dp')})", "ppent_act2 / 2"),
        "pretret_noa": dv(f"coalesce(oiadp, {z('oiadp')} - {z('dp')})", f"({z('noa1a')} + {z('noa2a')}) / 2"),
        "ptpma": dv(pi_fb, "sale"),
        "roaa": dv(f"coalesce(oibdp, {z('sale')} - {z('xopr')})", "at_avg"),
        "rocea": dv(f"coalesce(ebit, {z('sale')} - {z('cogs')} - {z('xsga')} - {z('dp')})", "capital2 / 2"),
        "roea": dv("ib", f"({z('bea')} + {z('bea_l')}) / 2"),
        "de_ratioa": dv(f"{z('dltt')} + {z('dlc')}", f"{z('ceq')} + {z('pstk')}"),
        "debt_ata": dv(f"{z('dltt')} + {z('dlc')}", "at"), "lt_ata": dv("lt", "at"),
        "debt_capitala": dv(f"{z('ap')} + {z('dlc')} + {z('dltt')}",
                            f"({z('ap')} + {z('dlc')} + {z('dltt')}) + ({z('ceq')} + {z('pstk')})"),
        "intcova": dv(f"{z('xint')} + {z('ib')}", "xint"),
        "intcov_ratioa": dv(f"coalesce(ebit, oiadp, {z('sale')} - {z('cogs')} - {z('xsga')} - {z('dp')})", "xint"),
        "dpra": dv("dvc", "ibadj"),
        "PEG_1yrforwarda": dv(f"abs({pe58})", "futepsgrowth * 100"),
        "PEG_ltgforwarda": dv(f"abs({pe58})", "ltg_eps"),
        "PEG_trailinga": dv(dv("price_adj", "pe_exi"), f"100 * ({g3})"),
        "bma": dv("bea", "prcc_f * csho"), "capeia2": dv("lead_mktcap", "capeia"),
        "divyielda": dv("dvrate", "price_unadj"),
        "evma": dv_or(eva, "ebitda", dv_or(eva, "oibdp", dv(z(eva), f"{z('sale')} - {z('cogs')} - {z('xsga')}"))),
        "pcfa": dv("lead_mktcap", "oancf"), "pe_exia": dv("lead_price_adj", "pe_exi"),
        "pe_inca": dv("lead_price_adj", "(epsfi / nullif(ajex, 0))"),
    }
    body = "SELECT gvkey, datadate, " + ", ".join(f"{c[n]} AS {n}" for n in R.ANNUAL_COLS) + " FROM yb"
    # ``at`` (total assets) is a DuckDB keyword: quote it as an identifier
    quote = re.compile(r"(?<![\w.'])at(?![\w'])")
    return O.sql(["a_panela"], quote.sub('"at"', body), quote.sub('"at"', stage_b))


@register("ratios_annual", _annual_sql())
def ratios_annual(spark, sf):
    return R.annual_ratios(I.us_panel(spark, sf, "a_funda"))


def _annual_global_sql() -> str:
    """Every global annual ratio from the definitions, apart from the US text."""
    w = "OVER (PARTITION BY isin ORDER BY datadate)"

    def mean2(x):
        return f"(({z(x)} + lag({z(x)}) {w}) / 2)"

    def diff(x):
        return f"({z(x)} - lag({z(x)}) {w})"

    debt, bea = f"({z('dltt')} + {z('dlc')})", f"({z('seq')} + {z('txditc')} - {z('pstk')})"
    noa, gross = f"({z('ppent')} + {z('act')} - {z('lct')})", f"({z('revt')} - {z('cogs')})"
    capital = f"({debt} + {z('ceq')})"
    works = f"({z('ppent')} + {z('act')})"
    income = f"coalesce(pi, {z('oiadp')} - {z('xint')} + {z('spi')} + {z('nopi')})"
    after = f"coalesce(oiadp, 0.0 - {z('dp')})"
    before = f"coalesce(oibdp, {z('sale')} - {z('xopr')})"
    stage = f"""gy AS (SELECT *, mcap_comp AS mktcap, prc_comp_adj AS price_adj FROM (
    SELECT *, row_number() OVER (PARTITION BY isin, datadate ORDER BY datadate) AS rn FROM a_panela_global) t WHERE rn = 1),
gz AS (SELECT *, {debt} AS debt, {bea} AS bea, {capital} AS capital,
  coalesce(oancf, {z('ib')} - ({diff('act')} - {diff('che')} - {diff('lct')} + {diff('dlc')} + {diff('txp')} - {z('dp')})) AS ocf,
  lag({bea}) {w} AS bea1, lag({noa}) {w} AS noa1, lag({capital}) {w} AS capital1, lag({works}) {w} AS works1,
  lag({z('icapt')} + {z('txditc')} + coalesce(-mib, 0.0)) {w} AS invested1,
  {debt} + {z('mib')} + {z('pstk')} + {z('mktcap')} AS ev,
  {O.ordered_mean("ib", 5, part="isin")} AS ib5,
  lead(price_adj) {w} AS price1, lead(mktcap) {w} AS mktcap1,
  {", ".join(f"{mean2(x)} AS {x}_m" for x in ("at", "invt", "ap", "rect", "dltt", "dlc", "ceq", "seq"))},
  {diff('invt')} AS invt_d FROM gy)"""
    last = f"{z('sale')} - {z('cogs')} - {z('xsga')}"
    c = {
        "capital_ratioa": dv("dltt", f"{z('dltt')} + {z('ceq')} + {z('pstk')}"),
        "equity_invcapa": dv("ceq", "icapt"), "debt_invcapa": dv("dltt", "icapt"),
        "totdebt_invcapa": dv("debt", z("icapt")), "at_turna": dv("sale", "at_m"), "inv_turna": dv("cogs", "invt_m"),
        "pay_turna": dv(f"{z('cogs')} + invt_d", "ap_m"), "rect_turna": dv("sale", "rect_m"),
        "sale_equitya": dv("sale", "seq"), "sale_invcapa": dv("sale", "icapt"),
        "sale_nwc": dv("sale", f"{z('act')} - {z('lct')}"), "invt_acta": dv("invt", "act"), "rect_acta": dv("rect", "act"),
        "fcf_ocfa": dv(f"{z('ocf')} - {z('capx')}", "ocf"), "ocf_lcta": dv("ocf", "lct"),
        "cash_debta": dv("ocf", "coalesce(lt, debt)"), "cash_lta": dv("che", "lt"),
        "cfma": dv(f"{z('ibc')} + {z('dpc')}", "sale"), "short_debta": dv("dlc", "debt"), "profit_lcta": dv(before, "lct"),
        "curr_debta": dv("lct", "lt"), "debt_ebitda": dv("debt", f"coalesce(ebitda, oibdp, {last})"),
        "dltt_bea": dv("dltt", "bea"), "int_debta": dv("xint", "dltt_m"), "int_totdebta": dv("xint", "dltt_m + dlc_m"),
        "lt_debta": dv("dltt", "lt"), "lt_ppenta": dv("lt", "ppent"),
        "cash_conversiona": f"{dv('invt_m', z('cogs') + ' / 365')} + {dv('rect_m', z('sale') + ' / 365')} - {dv('ap_m', z('cogs') + ' / 365')}",
        "cash_ratioa": dv("che", "lct"), "curr_ratioa": dv(f"coalesce(act, {z('che')} + {z('rect')} + {z('invt')})", "lct"),
        "quick_ratioa": dv(f"{z('act')} - {z('invt')}", "lct"), "accruala": dv(f"{z('oancf')} - {z('ib')}", "at_m"),
        "rd_salea": dv("xrd", "sale"), "efftaxa": dv("txt", income), "GProfa": dv(gross, "at"),
        "aftret_eqa": dv(f"{z('ib')} - {z('dvp')}", "ceq_m"), "aftret_equitya": dv("ib", "seq_m"),
        "aftret_invcapxa": dv(f"{z('ib')} + {z('xint')} + {z('mii')}", "invested1"), "gpma": dv(gross, "sale"),
        "npma": dv("ib", "sale"), "opmada": dv(f"coalesce(oiadp, {z('oibdp')} - {z('dp')})", "sale"),
        "opmbda": dv(before, "sale"), "pretret_earnata": dv(after, f"(works1 + {works}) / 2"),
        "pretret_noa": dv(after, f"({z('noa1')} + {noa}) / 2"), "ptpma": dv(income, "sale"), "roaa": dv(before, "at_m"),
        "rocea": dv(f"coalesce(ebit, {last} - {z('dp')})", "(capital + capital1) / 2"),
        "roea": dv("ib", f"({z('bea')} + {z('bea1')}) / 2"), "de_ratioa": dv("debt", f"{z('ceq')} + {z('pstk')}"),
        "debt_ata": dv("debt", z("at")), "lt_ata": dv("lt", "at"),
        "debt_capitala": dv(f"{z('ap')} + {z('dlc')} + {z('dltt')}", f"({z('ap')} + {z('dlc')} + {z('dltt')}) + ({z('ceq')} + {z('pstk')})"),
        "intcova": dv(f"{z('xint')} + {z('ib')}", "xint"),
        "intcov_ratioa": dv(f"coalesce(ebit, oiadp, {last} - {z('dp')})", "xint"), "dpra": dv("dvc", "ibc"),
        "bma": dv("bea", "mktcap"), "capeia2": dv("mktcap1", "ib5"),
        "evma": dv_or("ev", "ebitda", dv_or("ev", "oibdp", dv("ev", last))), "pcfa": dv("mktcap1", "oancf"),
        "pe_exia": dv("price1", dv("epsfx", "ajex")), "pe_inca": dv("price1", dv("epsfi", "ajex")),
    }
    quote = re.compile(r"(?<![\w.'])at(?![\w'])")
    body = "SELECT isin, datadate, " + ", ".join(f"{c[n]} AS {n}" for n in R.ANNUAL_COLS_GLB) + " FROM gz"
    return O.sql(["a_panela_global"], quote.sub('"at"', body), quote.sub('"at"', stage))


@register("ratios_annual_global", _annual_global_sql())
def ratios_annual_global(spark, sf):
    return R.annual_ratios_global(I.global_panel(spark, sf, "a_funda"))
