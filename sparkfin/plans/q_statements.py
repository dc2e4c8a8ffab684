"""Statement queries."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import statements as ST
from ..sources import adapters as A
from . import oracle as O
from .registry import register


def cells(spark, sf):
    return A.load(spark, sf, "a_cells")


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _lit(s: str) -> str:
    """DuckDB literal; a newline is spelled with chr(10)."""
    parts = s.split("\n")
    return " || chr(10) || ".join(_q(p) for p in parts) if len(parts) > 1 else _q(s)


_SHEETS_IN = ", ".join(_q(s) for s in A.SHEETS)
_STATEMENTS = ", ".join(_q(s) for s in ST.STATEMENTS)
_LABEL_OK = "CASE sheet " + " ".join(
    f"WHEN {_q(s)} THEN " + " AND ".join(f"NOT contains(value, {_lit(w)})" for w in words) for s, words in ST.STOPWORDS.items()) + " ELSE true END"
_PMARK = ", ".join(_lit(m) for m in ST.PERIOD_MARKERS)
_BODY = "row >= CASE WHEN sheet = 'Ratios' THEN 13 ELSE 16 END"
# every column the fixture's labels can give
_ALL = list(dict.fromkeys(ST.snake(ST.clean_label_py(label)) for sheet, label, _ in A.CELL_ROWS
                          if not any(w in label for w in ST.STOPWORDS.get(sheet, ()))))


def _in(labels):
    return ", ".join(_q(x) for x in labels)


_CTES = f"""labels AS (
  SELECT file, sheet, row, value AS label FROM a_cells WHERE {_BODY} AND col = 0 AND value IS NOT NULL AND {_LABEL_OK}),
errcols AS (
  SELECT DISTINCT c.file, c.sheet, c.col FROM a_cells c JOIN labels l USING (file, sheet, row)
  WHERE c.col >= 1 AND c.sheet IN ({_STATEMENTS}) AND c.value IN ('DSC', 'FYC')
  UNION
  SELECT file, sheet, col FROM a_cells WHERE col >= 1 AND row >= 16 AND sheet NOT IN ({_STATEMENTS}) AND value = 'FYC'),
body AS (
  SELECT c.* FROM a_cells c WHERE {_BODY} AND c.col >= 1
  AND NOT EXISTS (SELECT 1 FROM errcols e WHERE e.file = c.file AND e.sheet = c.sheet AND e.col = c.col)),
headers AS (
  SELECT * FROM a_cells WHERE col >= 1 AND row = 13 AND sheet IN ({_STATEMENTS})
  UNION ALL SELECT * FROM a_cells WHERE col >= 1 AND row = 12 AND sheet = 'Historical Capitalization'
  UNION ALL SELECT * FROM a_cells WHERE col % 2 = 1 AND row = 12 AND sheet = 'Capital Structure Summary'
  UNION ALL SELECT * FROM a_cells c WHERE col % 2 = 1 AND row = 13 AND sheet = 'Capital Structure Summary'
    AND NOT EXISTS (SELECT 1 FROM a_cells x WHERE x.file = c.file AND x.sheet = c.sheet AND x.row = 12 AND x.col >= 1 AND x.value IS NOT NULL)),
periods AS (
  SELECT file, sheet, col, value AS header,
         try_strptime(right(value, 11), '%b-%d-%Y')::date AS period_date,
         contains(value, 'LTM') AS is_ltm
  FROM headers WHERE value IS NOT NULL AND right(value, 11) NOT IN ({_PMARK})),
ann AS (SELECT file, col, period_date, year(period_date) AS year, is_ltm FROM periods
        WHERE sheet = 'Income Statement' AND NOT is_ltm),
chosen AS (
  SELECT * FROM ann
  UNION ALL
  SELECT file, col, period_date, year(period_date), is_ltm FROM periods p
  WHERE sheet = 'Income Statement' AND is_ltm
    AND NOT EXISTS (SELECT 1 FROM ann a WHERE a.file = p.file AND a.year = year(p.period_date))),
firstcol AS (
  SELECT f.file, s.sheet, f.year, min(f.col) AS col FROM chosen f CROSS JOIN (SELECT unnest([{_STATEMENTS}]) AS sheet) s GROUP BY ALL
  UNION ALL
  SELECT p.file, p.sheet, year(p.period_date), min(p.col) FROM periods p JOIN (SELECT DISTINCT file, period_date FROM chosen) c
    ON p.file = c.file AND p.period_date = c.period_date
  WHERE p.sheet NOT IN ({_STATEMENTS}) GROUP BY ALL),
banks AS (SELECT DISTINCT file FROM labels WHERE sheet = 'Historical Capitalization' AND label = 'Tier 1 Capital'),
wanted AS (
  SELECT * FROM labels WHERE sheet IN ({_STATEMENTS})
  UNION ALL SELECT * FROM labels WHERE sheet = 'Capital Structure Summary' AND label IN ({_in(ST.SUMMARY_LABELS)})
  UNION ALL SELECT * FROM labels WHERE sheet = 'Historical Capitalization' AND file IN (FROM banks) AND label IN ({_in(ST.BANK_LABELS)})
  UNION ALL SELECT * FROM labels WHERE sheet = 'Historical Capitalization' AND file NOT IN (FROM banks) AND label IN ({_in(ST.OTHER_LABELS)})),
named AS (
  SELECT b.file, f.year, b.sheet,
    CASE {' '.join(f"WHEN b.sheet = {_q(s)} THEN {i}" for i, s in enumerate(A.SHEETS))} END AS so,
    regexp_replace(regexp_replace(lower(
      CASE ltrim(regexp_replace(l.label, '[% ]+$', ''))
        {' '.join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in ST.RENAME.items())}
        ELSE ltrim(regexp_replace(l.label, '[% ]+$', '')) END), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS name,
    try_cast(b.value AS double) AS v
  FROM body b JOIN wanted l ON b.file = l.file AND b.sheet = l.sheet AND b.row = l.row
  JOIN firstcol f ON b.file = f.file AND b.sheet = f.sheet AND b.col = f.col),
wide AS (SELECT file, year, {', '.join(f"arg_max(v, so) FILTER (WHERE name = '{c}') AS {c}" for c in _ALL)}
  FROM named GROUP BY file, year),
ident AS (
  SELECT file, split_part(value, ' (', 1) AS company,
         regexp_extract(value, '\\(([^:]*):', 1) AS exchange,
         regexp_extract(value, ':([^)]*)\\)', 1) AS ticker
  FROM a_cells WHERE sheet = 'Income Statement' AND row = 3 AND col = 0)"""

_NONEMPTY = [c for c in _ALL if c != "unused_item"]


def _sql(body: str) -> str:
    return O.sql(["a_cells"], body, _CTES)


register("statement_cells_scan", O.sql(["a_cells"], f"""
SELECT file, sheet, row, col, value FROM a_cells WHERE sheet IN ({_SHEETS_IN})"""))(
    lambda spark, sf: cells(spark, sf).filter(F.col("sheet")
        .isin(*A.SHEETS)).select("file", "sheet", "row", "col", "value"))

register("statement_label_filter", _sql("SELECT file, sheet, row, label FROM labels"))(
    lambda spark, sf: ST.label_filter(cells(spark, sf)))

register("statement_error_periods", _sql("SELECT file, sheet, row, col, value FROM body"))(
    lambda spark, sf: ST.body_values(cells(spark, sf)).select("file", "sheet", "row", "col", "value"))

register("statement_periods", _sql("SELECT file, sheet, col, header, period_date, is_ltm FROM periods"))(
    lambda spark, sf: ST.periods(cells(spark, sf)))

register("statement_period_choice", _sql("SELECT file, col, period_date, year, is_ltm FROM chosen"))(
    lambda spark, sf: _year_bigint(ST.period_choice(cells(spark, sf))))

register("statement_period_semi", _sql("""
SELECT p.file, p.col, p.period_date FROM periods p
WHERE p.sheet = 'Capital Structure Summary'
  AND EXISTS (SELECT 1 FROM chosen c WHERE c.file = p.file AND c.period_date = p.period_date)"""))(
    lambda spark, sf: ST.period_semi(cells(spark, sf)))

register("statement_wide", _sql(f"SELECT file, year, {', '.join(_NONEMPTY)} FROM wide"))(
    lambda spark, sf: _year_bigint(ST.wide(cells(spark, sf))))

register("statement_identity", _sql("SELECT file, company, exchange, ticker FROM ident"))(
    lambda spark, sf: ST.identity(cells(spark, sf)))

register("capitalization_select", _sql("""
SELECT w.file, w.year, coalesce(b.bank, false) AS bank, share_price, shares_out, market_capitalization,
       CASE WHEN coalesce(b.bank, false) THEN tier_1_capital END AS tier_1_capital,
       CASE WHEN coalesce(b.bank, false) THEN tier_2_capital END AS tier_2_capital,
       CASE WHEN NOT coalesce(b.bank, false) THEN total_enterprise_value END AS total_enterprise_value,
       total_capital
FROM wide w LEFT JOIN (SELECT file, true AS bank FROM banks) b
  ON w.file = b.file"""))(
    lambda spark, sf: _year_bigint(ST.capitalization(cells(spark, sf))))

register("statement_union", _sql(f"""
SELECT w.file, w.year, i.company, i.exchange, i.ticker, {', '.join(sorted(_NONEMPTY))}
FROM wide w LEFT JOIN ident i ON w.file = i.file WHERE total_revenue IS NOT NULL"""))(
    lambda spark, sf: _year_bigint(ST.stacked(cells(spark, sf))))


def _year_bigint(df):
    return df.withColumn("year", df["year"].cast("bigint"))
