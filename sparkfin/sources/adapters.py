"""Adapters: finance-shaped inputs derived from the driver tables.

The reference reads licensed databases; here every input table (fundamentals,
prices, links, estimates, macro series, statement cells, forum posts) is
derived from the driver's parquet tables by a fixed rule.  The adapter text
is the only code shared by the Spark queries and the DuckDB oracles, so both
sides start from bit-identical inputs; it is written in the SQL subset both
engines accept (no bare double->int casts, no integer division).

Every adapter is a scan + group/window of a driver table, so its size grows
with the data.  In Spark each adapter is ``spark.sql(text, **inputs)`` over
DataFrames; in DuckDB the same text becomes a CTE.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .tables import TABLES, read_table

# ---------------------------------------------------------------------------
# Item names used by the fundamentals adapters (names follow
# the quarterly and annual fundamentals item lists of the ratio scripts).
# ---------------------------------------------------------------------------
Q_ITEMS = [
    "epsf12", "epsfi12", "ibadj12", "oepsxq", "oepf12", "oeps12", "seqq",
    "ceqq", "txditcq", "txdbq", "epsfxq", "epsfiq", "opepsq", "spiq",
    "nopiq", "saleq", "pstkq", "ibadjq", "dvpq", "ibq", "oibdpq", "dpq",
    "oiadpq", "revtq", "cogsq", "piq", "atq", "niq", "ibcomq", "icaptq",
    "mibq", "xsgaq", "xidoq", "xintq", "miiq", "ppentq", "actq", "lctq",
    "dlttq", "dlcq", "cheq", "invtq", "ltq", "rectq", "xoprq", "txpq",
    "txtq", "apq", "xrdq", "dvpdpq",
]
Q_YTD_ITEMS = ["oancfy", "capxy", "dpcy", "ibcy", "dpy", "dvy", "xidocy",
               "txdcy", "saley", "oepsxy"]
A_ITEMS = [
    "seq", "ceq", "txditc", "txdb", "itcb", "pstkrv", "pstkl", "pstk",
    "epsfx", "epsfi", "oprepsx", "opeps", "ebit", "spi", "nopi", "sale",
    "ibadj", "dvc", "dvp", "ib", "oibdp", "dp", "oiadp", "gp", "revt", "cogs",
    "pi", "ibc", "dpc", "at", "ni", "ibcom", "icapt", "mib", "ebitda", "xsga",
    "xido", "xint", "mii", "ppent", "act", "lct", "dltt", "dlc", "che", "invt",
    "lt", "rect", "xopr", "oancf", "txp", "txt", "ap", "xrd", "xad", "xlr",
    "capx",
]


def _triple(j: int) -> tuple[int, int, int]:
    """Small integer weights of item j on (100*price, discount, tax) cents."""
    return j % 5, (5 * j) % 7 - 3, (3 * j) % 5 - 2


def _item_expr(j: int, pc: str, dc: str, tc: str) -> str:
    a, b, c = _triple(j)
    return f"({a} * 100 * {pc} + ({b}) * {dc} + ({c}) * {tc})"


def _fundq_items_sql() -> str:
    cols = []
    for j, name in enumerate(Q_ITEMS):
        cols.append(
            f"CASE WHEN (7 * firm + 3 * q + {j}) % 13 = 0 THEN NULL "
            f"ELSE {_item_expr(j, 'pc', 'dc', 'tc')} / 1e6 END AS {name}")
    for k, name in enumerate(Q_YTD_ITEMS):
        j = len(Q_ITEMS) + k
        num = _item_expr(j, "pc", "dc", "tc")
        cols.append(
            f"CASE WHEN (7 * firm + 3 * q + {j}) % 13 = 0 THEN NULL ELSE "
            f"sum({num}) OVER (PARTITION BY firm, fyearq ORDER BY qend "
            f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / 1e6 END AS {name}")
    return ",\n       ".join(cols)


def _funda_items_sql() -> str:
    cols = []
    for j, name in enumerate(A_ITEMS):
        cols.append(
            f"CASE WHEN (7 * firm + 3 * fyear + {j}) % 13 = 0 THEN NULL "
            f"ELSE {_item_expr(j, 'pc', 'dc', 'tc')} / 1e6 END AS {name}")
    return ",\n       ".join(cols)


# name -> (inputs, sql).  Inputs are driver tables or other adapters.
ADAPTERS: dict[str, tuple[tuple[str, ...], str]] = {}

ADAPTERS["a_base"] = (("lineitem",), """
SELECT l_suppkey AS firm,
       last_day(make_date(cast(year(l_shipdate) AS int), cast(quarter(l_shipdate) * 3 AS int), 1)) AS qend,
       cast(sum(cast(round(l_extendedprice * 100) AS bigint)) AS bigint) AS pc,
       cast(sum(cast(round(l_extendedprice * 100) AS bigint) * cast(round(l_discount * 100) AS bigint)) AS bigint) AS dc,
       cast(sum(cast(round(l_extendedprice * 100) AS bigint) * cast(round(l_tax * 100) AS bigint)) AS bigint) AS tc,
       cast(sum(cast(round(l_quantity) AS bigint)) AS bigint) AS qn,
       cast(sum(CASE WHEN l_returnflag = 'R' THEN cast(round(l_extendedprice * 100) AS bigint) END) AS bigint) AS nr
FROM {lineitem}
GROUP BY 1, 2
""")

ADAPTERS["a_fundq"] = (("a_base",), """
SELECT lpad(cast(firm AS string), 6, '0') AS gvkey,
       lpad(cast(firm AS string), 8, '0') || '1' AS cusip,
       'XS' || lpad(cast(firm AS string), 10, '0') AS isin,
       'FIRM ' || lpad(cast(firm AS string), 6, '0') AS conm,
       qend AS datadate, 12 AS fyr, fyearq, fqtr,
       'INDL' AS indfmt, 'STD' AS datafmt, 'D' AS popsrc, 'C' AS consol,
       cast(pc AS double) / (100 * cast(qn AS double)) AS prccq,
       cast(qn AS double) / 10 AS cshoq,
       cast(1 + firm % 3 AS double) AS ajexq,
       """ + _fundq_items_sql() + """
FROM (SELECT b.*, cast(year(qend) AS int) AS fyearq, cast(quarter(qend) AS int) AS fqtr,
             (cast(year(qend) AS int) - 1995) * 4 + cast(quarter(qend) AS int) - 1 AS q
      FROM {a_base} b) t
WHERE (firm + q) % 29 <> 0
""")

ADAPTERS["a_funda"] = (("a_base",), """
SELECT lpad(cast(firm AS string), 6, '0') AS gvkey,
       lpad(cast(firm AS string), 8, '0') || '1' AS cusip,
       'XS' || lpad(cast(firm AS string), 10, '0') AS isin,
       'FIRM ' || lpad(cast(firm AS string), 6, '0') AS conm,
       make_date(fyear, 12, 31) AS datadate, fyear, 12 AS fyr,
       'INDL' AS indfmt, 'STD' AS datafmt, 'D' AS popsrc, 'C' AS consol,
       cast(pc AS double) / (100 * cast(qn AS double)) AS prcc_f,
       cast(qn AS double) / 40 AS csho,
       cast(1 + firm % 3 AS double) AS ajex,
       """ + _funda_items_sql() + """
FROM (SELECT firm, cast(year(qend) AS int) AS fyear,
             cast(sum(pc) AS bigint) AS pc, cast(sum(dc) AS bigint) AS dc,
             cast(sum(tc) AS bigint) AS tc, cast(sum(qn) AS bigint) AS qn
      FROM {a_base} GROUP BY 1, 2) t
""")

# daily stock file: permno = 10000 + supplier; price negative (bid/ask mean
# convention) for every fifth supplier.
ADAPTERS["a_dsf"] = (("lineitem",), """
SELECT permno, date, cusip, prc, shrout, cfacpr,
       abs(prc) / lag(abs(prc)) OVER (PARTITION BY permno ORDER BY date) - 1 AS ret
FROM (SELECT 10000 + l_suppkey AS permno,
             cast(l_shipdate AS date) AS date,
             lpad(cast(l_suppkey AS string), 8, '0') || '1' AS cusip,
             CASE WHEN l_suppkey % 5 = 0 THEN -1 ELSE 1 END
               * cast(sum(cast(round(l_extendedprice * 100) AS bigint)) AS double)
               / (100 * cast(sum(cast(round(l_quantity) AS bigint)) AS double)) AS prc,
             cast(sum(cast(round(l_quantity) AS bigint)) AS double) AS shrout,
             cast(1 + l_suppkey % 3 AS double) AS cfacpr
      FROM {lineitem}
      GROUP BY 1, 2, 3, l_suppkey) t
""")

# last day of each month of the daily file
ADAPTERS["a_month"] = (("a_dsf",), """
SELECT date, permno, cusip, prc, shrout, cfacpr, ret
FROM (SELECT d.*, row_number() OVER (PARTITION BY permno, last_day(date) ORDER BY date DESC) AS rn
      FROM {a_dsf} d) t
WHERE rn = 1
""")

# monthly stock file; every fourth month of a security has no price
ADAPTERS["a_msf"] = (("a_month",), """
SELECT date, permno, cusip, CASE WHEN (permno + month(date)) % 4 = 1 THEN NULL ELSE prc END AS prc, shrout, cfacpr, ret
FROM {a_month}
""")

# monthly security file; shares in millions where the stock file has thousands
ADAPTERS["a_secm"] = (("a_month",), """
SELECT cusip, lpad(cast(permno - 10000 AS string), 6, '0') AS gvkey, '01' AS iid,
       date AS datadate, abs(prc) AS prccm, cfacpr AS ajexm, shrout AS cshom,
       shrout / 1000 AS cshoq, cast(permno % 4 AS double) / 10 AS dvrate,
       'FIRM ' || lpad(cast(permno - 10000 AS string), 6, '0') AS conm,
       CASE WHEN (permno - 10000) % 10 = 9 THEN '1' ELSE '0' END AS tpci,
       CASE WHEN (permno - 10000) % 7 = 6 THEN 'CAN' ELSE 'USA' END AS fic,
       'P' AS primiss
FROM {a_month}
""")

ADAPTERS["a_link"] = (("supplier",), """
SELECT gvkey, lpermno, linktype, linkprim, linkdt, linkenddt FROM (
  SELECT lpad(cast(s_suppkey AS string), 6, '0') AS gvkey, 10000 + s_suppkey AS lpermno,
         CASE s_suppkey % 3 WHEN 0 THEN 'LU' WHEN 1 THEN 'LC' ELSE 'NR' END AS linktype,
         CASE WHEN s_suppkey % 7 < 3 THEN 'P' WHEN s_suppkey % 7 < 5 THEN 'C' ELSE 'J' END AS linkprim,
         make_date(1990, 1, 1) AS linkdt, cast(NULL AS date) AS linkenddt
  FROM {supplier}
  UNION ALL
  SELECT lpad(cast(s_suppkey AS string), 6, '0'), 10000 + s_suppkey,
         CASE s_suppkey % 3 WHEN 0 THEN 'LU' WHEN 1 THEN 'LC' ELSE 'NR' END,
         CASE WHEN s_suppkey % 7 < 3 THEN 'P' WHEN s_suppkey % 7 < 5 THEN 'C' ELSE 'J' END,
         make_date(1985, 1, 1), make_date(1989, 12, 31)
  FROM {supplier} WHERE s_suppkey % 10 = 0) t
""")

# Industry codes: six-digit code from the nation key through the sector list
# (fixed values: the eleven two-digit sector codes, 40 = financials).
ADAPTERS["a_gics"] = (("supplier",), """
SELECT gvkey, gsector, gsector || sub AS ggroup, gsector || sub || '10' AS gind, indfrom FROM (
  SELECT lpad(cast(s_suppkey AS string), 6, '0') AS gvkey,
         CASE s_nationkey % 11 WHEN 0 THEN '10' WHEN 1 THEN '15' WHEN 2 THEN '20' WHEN 3 THEN '25'
              WHEN 4 THEN '30' WHEN 5 THEN '35' WHEN 6 THEN '40' WHEN 7 THEN '45' WHEN 8 THEN '50'
              WHEN 9 THEN '55' ELSE '60' END AS gsector,
         lpad(cast(10 + 10 * (s_suppkey % 3) AS string), 2, '0') AS sub,
         make_date(1990, 1, 1) AS indfrom
  FROM {supplier}
  UNION ALL
  SELECT lpad(cast(s_suppkey AS string), 6, '0'), '20',
         lpad(cast(10 + 10 * (s_suppkey % 2) AS string), 2, '0'), make_date(1995, 6, 30)
  FROM {supplier} WHERE s_suppkey % 4 = 0) t
""")

ADAPTERS["a_est_act"] = (("orders", "supplier"), """
SELECT cusip, pends, 'ANN' AS pdicity, pends + 60 AS anndats, cast(value AS double) / 100 AS value FROM (
  SELECT lpad(cast(o_custkey % (SELECT count(*) FROM {supplier}) + 1 AS string), 8, '0') AS cusip,
         make_date(cast(year(o_orderdate) AS int), 12, 31) AS pends,
         cast(floor(sum(cast(round(o_totalprice * 100) AS bigint)) / count(*)) AS bigint) AS value
  FROM {orders} GROUP BY 1, 2) t
""")

ADAPTERS["a_est_sum"] = (("orders", "supplier"), """
SELECT cusip, statpers, fpi, CASE WHEN fpi = '0' THEN 'LTG' ELSE 'ANN' END AS fiscalp, 'USD' AS curr_act,
       cast(actual AS double) / 100 AS actual, cast(meanest AS double) / 100 AS meanest,
       statpers + 45 AS anndats_act, make_date(cast(year(statpers) AS int), 12, 31) AS fpedats
FROM (
  SELECT lpad(cast(o_custkey % (SELECT count(*) FROM {supplier}) + 1 AS string), 8, '0') AS cusip,
         last_day(cast(o_orderdate AS date)) AS statpers,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN '1' ELSE '0' END AS fpi,
         cast(floor(sum(cast(round(o_totalprice * 100) AS bigint)) / count(*)) AS bigint) AS meanest,
         cast(max(cast(round(o_totalprice * 100) AS bigint)) AS bigint) AS actual
  FROM {orders} GROUP BY 1, 2, 3) t
""")

# Macro series: one value per (series, day) from order counts by market segment.
ADAPTERS["a_macro"] = (("orders", "customer"), """
SELECT series_key, date,
       CASE WHEN dayofyear(date) % 9 = 0 THEN NULL ELSE cast(n % 500 AS double) / 100 END AS value
FROM (SELECT c_mktsegment AS series_key, cast(o_orderdate AS date) AS date, count(*) AS n
      FROM {orders} JOIN {customer} ON o_custkey = c_custkey
      GROUP BY 1, 2) t
""")

# Firm location: the supplier's nation.
ADAPTERS["a_loc"] = (("supplier", "nation"), """
SELECT lpad(cast(s_suppkey AS string), 6, '0') AS gvkey, n_name AS loc, s_nationkey AS loc_rank
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey
""")

# Monthly macro series by country (customer nation), month-end dated.
ADAPTERS["a_macro_m"] = (("orders", "customer", "nation"), """
SELECT loc, publicdate,
       CASE WHEN (cast(month(publicdate) AS int) + k) % 7 = 0 THEN NULL ELSE cast(n % 50 AS double) / 10 END AS value
FROM (SELECT n_name AS loc, n_nationkey AS k, last_day(cast(o_orderdate AS date)) AS publicdate, count(*) AS n
      FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
      GROUP BY 1, 2, 3) t
""")


# ---------------------------------------------------------------------------
# Statement cells: one "file" per firm, six sheets, a header row of period
# labels (row 13) and label rows from row 16 on; values are integer strings.
# Sheet names and row labels of the statement downloads.
# ---------------------------------------------------------------------------
SHEETS = ["Income Statement", "Balance Sheet", "Cash Flow", "Ratios",
          "Capital Structure Summary", "Historical Capitalization"]
# (sheet, label, annual item expression or NULL)
CELL_ROWS = [
    ("Income Statement", "Total Revenue", "sale"),
    ("Income Statement", "Cost Of Goods Sold", "cogs"),
    ("Income Statement", "Net Income", "ni"),
    ("Income Statement", "Note: figures restated", None),
    ("Income Statement", "Currency", None),
    ("Income Statement", "Unused Item", None),
    ("Balance Sheet", "Total Assets", "at"),
    ("Balance Sheet", "LIABILITIES", None),
    ("Balance Sheet", "Total Liabilities", "lt"),
    ("Balance Sheet", "Total Equity", "seq"),
    ("Cash Flow", "Cash from Ops.", "oancf"),
    ("Cash Flow", "Capital Expenditure", "capx"),
    ("Cash Flow", "Net Income", "ib"),
    ("Cash Flow", "Filing Date", None),
    ("Ratios", " Return on Equity %", "ib"),
    ("Ratios", "Gross Margin %", "gp"),
    ("Capital Structure Summary", "Total Senior Debt", "dltt"),
    ("Historical Capitalization", "Share Price", "prcc_f"),
    ("Historical Capitalization", "Shares Out.", "csho"),
    ("Historical Capitalization", "Market Capitalization", "prcc_f * csho"),
    ("Historical Capitalization", "Tier 1 Capital", "ceq"),
    ("Historical Capitalization", "Tier 2 Capital", "pstk"),
    ("Historical Capitalization", "= Total Enterprise Value (TEV)", "ebitda"),
    ("Historical Capitalization", "Total Capital", "icapt"),
    ("Historical Capitalization", "= Total Capital", "icapt"),
]
BANK_ONLY = {"Tier 1 Capital", "Tier 2 Capital", "Total Capital"}
NONBANK_ONLY = {"= Total Enterprise Value (TEV)", "= Total Capital"}


def _cells_sql() -> tuple[str, str]:
    """Cell table as a few set operations: firm-years times a small fixed
    table of row definitions (an unpivot of known item columns)."""
    sheets = ", ".join(f"('{sh}')" for sh in SHEETS)
    defs = []
    cases = []
    for i, (sh, label, item) in enumerate(CELL_ROWS):
        bank = 1 if label in BANK_ONLY else (-1 if label in NONBANK_ONLY else 0)
        defs.append(f"({i}, '{sh}', {16 + i}, '{label}', {bank})")
        if item is None:
            cases.append(f"WHEN {i} THEN " + ("cast(NULL AS string)" if label == "Unused Item" else "'USD'"))
            continue
        qual = " * ".join(f"fy.{t}" for t in item.split(" * "))
        num = f"cast(cast(floor({qual}) AS bigint) AS string)"
        if label == "Cost Of Goods Sold":
            num = f"CASE WHEN (fy.firm + fy.fyear) % 11 = 0 THEN 'DSC' ELSE {num} END"
        if label == "Tier 2 Capital":   # no error marker on the capital sheets
            num = f"CASE WHEN (fy.firm + fy.fyear) % 7 = 0 THEN 'DSC' ELSE {num} END"
        if label == "Share Price":
            num = f"CASE WHEN (fy.firm + fy.fyear) % 17 = 3 THEN 'FYC' ELSE {num} END"
        if label == "Total Assets":
            num = f"CASE WHEN (fy.firm + fy.fyear) % 13 = 5 THEN 'FYC' ELSE {num} END"
        cases.append(f"WHEN {i} THEN {num}")
    case = "CASE d.i " + " ".join(cases) + " END"
    # the capital sheets have their own headers: row 12; the summary uses every
    # second column, the other sheet also holds quarters that are no fiscal year end
    # (the summary of every third firm has its header in row 13)
    head = ("CASE WHEN s.sheet = 'Historical Capitalization' OR (s.sheet = 'Capital Structure Summary' AND {t}.firm % 3 <> 0) THEN 12 ELSE 13 END")
    year_col = "CASE WHEN s.sheet = 'Capital Structure Summary' THEN 2 * (fy.fyear - 1994) - 1 ELSE fy.fyear - 1994 END"
    last_col = "CASE WHEN s.sheet = 'Capital Structure Summary' THEN 17 ELSE 9 END"
    bank_ok = "(d.bank = 0 OR (d.bank = 1 AND {t}.firm % 5 = 0) OR (d.bank = -1 AND {t}.firm % 5 <> 0))"
    body = f"""
SELECT file, 'Income Statement' AS sheet, 3 AS row, 0 AS col,
       conm || ' (' || CASE firm % 3 WHEN 0 THEN 'NYSE' WHEN 1 THEN 'NASDAQ' ELSE 'ASX' END
       || ':F' || cast(firm AS string) || ')' AS value FROM files
UNION ALL
SELECT fy.file, s.sheet, {head.format(t='fy')}, {year_col}, '12 months Dec-31-' || cast(fy.fyear AS string)
FROM fy CROSS JOIN (VALUES {sheets}) AS s(sheet)
UNION ALL
SELECT f.file, s.sheet, {head.format(t='f')}, {last_col},
       'LTM 12 months Jun-30-' || cast(CASE WHEN f.firm % 4 = 0 THEN 2002 ELSE 2001 END AS string)
FROM files f CROSS JOIN (VALUES {sheets}) AS s(sheet) WHERE f.firm % 2 = 0
UNION ALL
SELECT f.file, s.sheet, {head.format(t='f')}, CASE WHEN s.sheet = 'Capital Structure Summary' THEN 15 ELSE 8 END, 'Fiscal Year' || chr(10) || 'Change'
FROM files f CROSS JOIN (VALUES {sheets}) AS s(sheet) WHERE f.firm % 6 = 1
UNION ALL
SELECT fy.file, 'Historical Capitalization', 12, fy.fyear - 1974, 'Mar-31-' || cast(fy.fyear AS string) FROM fy
UNION ALL
SELECT fy.file, d.sheet, d.row, fy.fyear - 1974, '7' FROM fy CROSS JOIN defs d WHERE d.sheet = 'Historical Capitalization'
UNION ALL
SELECT fy.file, d.sheet, d.row, 2 * (fy.fyear - 1994), '12.5%' FROM fy CROSS JOIN defs d WHERE d.sheet = 'Capital Structure Summary'
UNION ALL
SELECT f.file, d.sheet, d.row, 0, d.label FROM files f CROSS JOIN defs d WHERE {bank_ok.format(t="f")}
UNION ALL
SELECT file, sheet, row, col, value FROM (
  SELECT fy.file, d.sheet, d.row, {year_col.replace("s.sheet", "d.sheet")} AS col, d.label, {case} AS value
  FROM fy CROSS JOIN defs d WHERE {bank_ok.format(t="fy")}) v
WHERE value IS NOT NULL OR label = 'Unused Item'
UNION ALL
SELECT file, sheet, row, col, value FROM (
  SELECT fy.file, d.sheet, d.row, {last_col.replace("s.sheet", "d.sheet")} AS col, d.label, {case} AS value
  FROM fy CROSS JOIN defs d WHERE fy.fyear = 2001 AND fy.firm % 2 = 0 AND {bank_ok.format(t="fy")}) v
WHERE value IS NOT NULL AND label NOT IN ('Currency', 'Filing Date', 'Note: figures restated', 'LIABILITIES')
"""
    return body, ", ".join(defs)


_CELLS_BODY, _CELLS_DEFS = _cells_sql()

ADAPTERS["a_cells"] = (("a_funda",), """
WITH fy AS (SELECT 'firm_' || gvkey || '.xls' AS file, cast(gvkey AS int) AS firm, f.* FROM {a_funda} f),
files AS (SELECT DISTINCT file, firm, conm FROM fy),
defs AS (SELECT * FROM (VALUES """ + _CELLS_DEFS + """) AS d(i, sheet, row, label, bank))
SELECT file, sheet, cast(row AS int) AS row, cast(col AS int) AS col, value FROM (
""" + _CELLS_BODY + """
) t
""")

# ---------------------------------------------------------------------------
# Forum tables.
# ---------------------------------------------------------------------------
ADAPTERS["a_submissions"] = (("events",), """
SELECT 's' || cast(event_id AS string) AS id, ts AS created_utc,
       CASE WHEN user_id % 3 = 0 THEN 'AutoModerator' ELSE 'user' || cast(user_id AS string) END AS author,
       CASE WHEN event_type = 'view' THEN 'Daily Discussion - ' || cast(cast(ts AS date) AS string)
            ELSE event_type || ' post ' || cast(event_id AS string) END AS title,
       'forum' AS subreddit
FROM {events}
""")

# Comments (conversation turn 0, documents) and replies (later turns).
ADAPTERS["a_comments"] = (("conversations", "documents"), """
SELECT 'thread_' || lpad(cast(conv_id % 30 AS string), 2, '0') AS sub,
       make_date(2024, 1, 1) + cast(conv_id % 30 AS int) AS sub_date,
       conv_id AS comment_index_track, turn AS position,
       CASE WHEN turn = 0 THEN 'comment' ELSE 'reply' END AS kind,
       CASE WHEN (conv_id + turn) % 17 = 0 THEN '[deleted]'
            WHEN (conv_id + turn) % 19 = 0 THEN NULL
            ELSE role || '_' || cast(conv_id % 50 AS string) END AS author,
       text AS comment, cast(length(text) % 100 AS int) AS comment_upvotes
FROM {conversations}
UNION ALL
SELECT 'thread_' || lpad(cast(doc_id % 30 AS string), 2, '0'),
       make_date(2024, 1, 1) + cast(doc_id % 30 AS int),
       1000000 + doc_id, cast(0 AS bigint), 'comment',
       CASE WHEN doc_id % 23 = 0 THEN '[deleted]' ELSE source END,
       text, cast(length(text) % 100 AS int)
FROM {documents}
""")

# One row per comment author that still has an account: karma from the
# author's own rows, the account opened 30 days before the first of them.
ADAPTERS["a_authors"] = (("a_comments",), """
SELECT author, author_link_karma, author_comment_karma, author_comment_karma % 2 = 0 AS author_has_verified_email,
       author_comment_karma % 7 = 0 AS author_is_gold, author_account_created
FROM (SELECT author, cast(count(DISTINCT comment_index_track) AS bigint) AS author_link_karma,
             cast(sum(comment_upvotes) AS bigint) AS author_comment_karma, min(sub_date) - 30 AS author_account_created
      FROM {a_comments} WHERE author IS NOT NULL AND author <> '[deleted]' GROUP BY author) t
WHERE author_comment_karma % 11 <> 10
""")

# One row per thread: the day it was opened, its votes and the share of them
# that are up votes.
ADAPTERS["a_threads"] = (("a_comments",), """
SELECT sub, min(sub_date) AS sub_created, cast(count(*) AS bigint) AS sub_upvotes,
       cast(sum(CASE WHEN comment_upvotes >= 50 THEN 1 ELSE 0 END) AS double) / cast(count(*) AS double) AS sub_upvote_ratio
FROM {a_comments} GROUP BY sub
""")

# Ticker-like symbols: first word of a part name -> its brand spelled in
# letters (digits 0-9 as a-j), lower case.
ADAPTERS["a_symbols"] = (("part",), """
SELECT split_part(p_name, ' ', 1) AS symbol,
       min(lower(translate(replace(p_brand, '#', ''), '0123456789', 'abcdefghij'))) AS name_lower
FROM {part} GROUP BY 1
""")

# Credit-rating sample: one rating per firm-quarter from the returned share
# of sales (22 classes; ranks 1-20, 23, 24), -1 when unrated.
ADAPTERS["a_rating"] = (("a_base", "a_loc"), """
SELECT gvkey, qdate, loc, loc_rank, loc AS country_exch, class_pos,
       CASE WHEN class_pos IS NULL THEN -1 WHEN class_pos < 20 THEN class_pos + 1
            WHEN class_pos = 20 THEN 23 ELSE 24 END AS rating_rank
FROM (SELECT lpad(cast(b.firm AS string), 6, '0') AS gvkey, b.qend AS qdate, l.loc, l.loc_rank,
             CASE WHEN b.nr IS NULL THEN NULL
                  ELSE cast(least(21, floor(cast(b.nr AS double) / cast(b.pc AS double) * 44)) AS int) END AS class_pos
      FROM {a_base} b LEFT JOIN {a_loc} l ON lpad(cast(b.firm AS string), 6, '0') = l.gvkey) t
""")


def _deps_order(names: list[str], known: dict[str, tuple[tuple[str, ...], str]]) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        if n in TABLES or n in out:
            return
        for d in known[n][0]:
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def load(spark: SparkSession, sf_dir: str, name: str, _cache: dict | None = None) -> DataFrame:
    """Build adapter ``name`` as a lazy Spark plan over the driver tables."""
    cache = {} if _cache is None else _cache
    if name in cache:
        return cache[name]
    if name in TABLES:
        df = read_table(spark, sf_dir, name)
    else:
        deps, sql = ADAPTERS[name]
        kw = {d: load(spark, sf_dir, d, cache) for d in deps}
        df = spark.sql(sql, **kw)
    cache[name] = df
    return df


def duckdb_with(names: list[str], views: dict[str, tuple[tuple[str, ...], str]] | None = None) -> str:
    """WITH clause defining the given adapters (and their inputs) for DuckDB;
    ``views`` are further texts that only the oracles use."""
    known = {**ADAPTERS, **(views or {})}
    order = _deps_order(names, known)
    if not order:
        return ""
    parts = []
    for n in order:
        deps, sql = known[n]
        parts.append(f"{n} AS MATERIALIZED ({sql.format(**{d: d for d in deps})})")
    return "WITH " + ",\n".join(parts) + "\n"
