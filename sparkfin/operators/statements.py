"""Financial statement assembly from a long cell table.

A statement download is six sheets of cells.  Instead of transposing each
sheet in memory and chaining outer joins, everything stays a long
(file, sheet, row, col, value) table: labels and periods are attached by
joins on (file, ...), and one ``pivot`` per (file, year) builds the wide
rows.  All work is keyed by file, so files spread over the cluster.
"""
from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import by_key, cut_lineage, written
from ..sources.adapters import SHEETS

HEADER_ROW = 13
BODY_ROW = 16
RATIO_BODY_ROW = 13
CAPITAL_HEADER_ROW = 12

STATEMENTS = SHEETS[:4]
SUMMARY, CAPITALIZATION = SHEETS[4:]

# Label fragments that mark non-data rows (the capital sheets
# have none), error markers, header markers.
COMMON_STOPWORDS = ["For the Fiscal Period Ending", "Note:", "Currency", "NaN", "Exchange Rate",
                    "Conversion Method", "Filing Date", "Occasionally", "Restatement Type",
                    "Calculation Type", "\n", "FYC", "Compustat"]
STOPWORDS = {"Income Statement": COMMON_STOPWORDS,
             "Balance Sheet": [*COMMON_STOPWORDS, "LIABILITIES", "Supplemental Items"],
             "Cash Flow": [*COMMON_STOPWORDS, "Supplemental Items"],
             "Ratios": [*COMMON_STOPWORDS, "Supplemental Items"]}
ERROR_MARKERS = ["DSC", "FYC"]
CAPITAL_ERROR_MARKERS = ["FYC"]
PERIOD_MARKERS = ["urce Change", "Year\nChange", "Year Change"]
# The rows taken from the capital sheets, and column renames.
SUMMARY_LABELS = ["Total Senior Debt"]
BANK_LABELS = ["Share Price", "Shares Out.", "Market Capitalization", "Tier 1 Capital", "Tier 2 Capital", "Total Capital"]
OTHER_LABELS = ["Share Price", "Shares Out.", "Market Capitalization", "= Total Enterprise Value (TEV)", "= Total Capital"]
RENAME = {"= Total Enterprise Value (TEV)": "Total Enterprise Value", "= Total Capital": "Total Capital"}


def clean_label_py(label: str) -> str:
    s = re.sub(r"[% ]+$", "", label).lstrip()
    return RENAME.get(s, s)


def snake(label: str) -> str:
    return re.sub(r"[^a-z0-9]+", "_", label.lower()).strip("_")


def sheet_order() -> F.Column:
    expr = F.lit(None).cast("int")
    for i, s in enumerate(SHEETS):
        expr = F.when(F.col("sheet") == s, F.lit(i)).otherwise(expr)
    return expr


def _is_statement() -> F.Column:
    return F.col("sheet").isin(*STATEMENTS)


def _in_body() -> F.Column:
    return F.col("row") >= F.when(F.col("sheet") == "Ratios", RATIO_BODY_ROW).otherwise(BODY_ROW)


def _stop_label(label: F.Column) -> F.Column:
    """Whether a label holds one of its own sheet's stop fragments."""
    bad = F.lit(False)
    for sheet, fragments in STOPWORDS.items():
        hit = F.lit(False)
        for f in fragments:
            hit = hit | label.contains(f)
        bad = bad | ((F.col("sheet") == sheet) & hit)
    return bad


def _is_marker() -> F.Column:
    return F.when(_is_statement(), F.col("value").isin(*ERROR_MARKERS)).otherwise(F.col("value").isin(*CAPITAL_ERROR_MARKERS))


def label_filter(cells: DataFrame) -> DataFrame:
    """Body label cells whose text holds none of their sheet's stop fragments."""
    lab = F.col("value")
    return (cells.filter(_in_body() & (F.col("col") == 0) & lab.isNotNull() & ~_stop_label(lab))
            .select("file", "sheet", "row", F.col("value").alias("label")))


def error_periods(cells: DataFrame) -> DataFrame:
    """(file, sheet, col) holding an error marker: in a kept row of a
    statement, in any body row of a capital sheet."""
    hit = cells.filter(_in_body() & (F.col("col") >= 1) & _is_marker())
    kept = hit.filter(_is_statement()).join(label_filter(cells), ["file", "sheet", "row"], "left_semi")
    return kept.unionByName(hit.filter(~_is_statement())).select("file", "sheet", "col").distinct()


def body_values(cells: DataFrame) -> DataFrame:
    """Body cells of data columns without error markers."""
    body = cells.filter(_in_body() & (F.col("col") >= 1))
    return body.join(error_periods(cells), ["file", "sheet", "col"], "left_anti")


def _own_header(c: DataFrame) -> DataFrame:
    """Marks header cells (``hdr``): row 13 of a statement; row 12 of a capital
    sheet, of the summary every second column, and its row 13 where its row 12
    is empty."""
    in_row_12 = F.max(((F.col("row") == CAPITAL_HEADER_ROW) & (F.col("col") >= 1) & F.col("value").isNotNull()).cast("int")) \
        .over(Window.partitionBy("file", "sheet"))
    row = F.when(_is_statement() | ((F.col("sheet") == SUMMARY) & (in_row_12 == 0)), HEADER_ROW).otherwise(CAPITAL_HEADER_ROW)
    odd = (F.col("sheet") != SUMMARY) | (F.col("col") % 2 == 1)
    return c.withColumn("hdr", (F.col("row") == row) & (F.col("col") >= 1) & F.col("value").isNotNull() & odd)


def periods(cells: DataFrame) -> DataFrame:
    """Header cells parsed to dates: last 11 characters, 'MMM-dd-yyyy';
    year-change markers dropped."""
    tail = F.substring(F.col("value"), -11, 11)
    return (_own_header(cells).filter(F.col("hdr") & ~tail.isin(*PERIOD_MARKERS))
            .select("file", "sheet", "col", F.col("value").alias("header"),
                    F.try_to_date(tail, "MMM-dd-yyyy").alias("period_date"),
                    F.col("value").contains("LTM").alias("is_ltm")))


def period_choice(cells: DataFrame) -> DataFrame:
    """Fiscal-year periods of the income statement, plus the LTM period when
    its year is not already among them."""
    p = periods(cells).filter(F.col("sheet") == "Income Statement").withColumn("year", F.year("period_date"))
    annual = p.filter(~F.col("is_ltm"))
    ltm = p.filter(F.col("is_ltm")).join(annual.select("file", "year"), ["file", "year"], "left_anti")
    return annual.unionByName(ltm).select("file", "col", "period_date", "year", "is_ltm")


def period_semi(cells: DataFrame, sheet: str = "Capital Structure Summary") -> DataFrame:
    """Periods of one sheet kept only when the chosen periods hold them."""
    p = periods(cells).filter(F.col("sheet") == sheet)
    return p.join(period_choice(cells).select("file", "period_date"), ["file", "period_date"], "left_semi") \
        .select("file", "col", "period_date")


def _clean_label_col(c: F.Column) -> F.Column:
    s = F.ltrim(F.regexp_replace(c, r"[% ]+$", ""))
    for k, v in RENAME.items():
        s = F.when(s == k, F.lit(v)).otherwise(s)
    return F.regexp_replace(F.regexp_replace(F.lower(s), r"[^a-z0-9]+", "_"), r"^_+|_+$", "")


def long_values(cells: DataFrame) -> DataFrame:
    """(file, year, sheet, name, v) for chosen periods, one column per year.

    The four statements share the income statement's header by column; the
    capital sheets bring their own and keep the dates that are among the
    chosen ones.  One pass: the cells are hash-partitioned by file once, and
    every lookup a transposition needs is a window inside the file - the row's
    label, the column's error marker and header, the file's fiscal years and
    chosen dates, the first column of each year.  All these windows reuse the
    one file partitioning, so the plan has a single exchange and no joins; a
    file (one company's statements) is a bounded group, and there are as many
    tasks as the (written) cells need."""
    c = _own_header(by_key(cells, "file"))
    by_row, by_col = Window.partitionBy("file", "sheet", "row"), Window.partitionBy("file", "sheet", "col")
    by_file = Window.partitionBy("file")
    income = F.col("hdr") & (F.col("sheet") == "Income Statement")
    c = c.select("*", F.max(F.when(F.col("col") == 0, F.col("value"))).over(by_row).alias("label"),
                 F.when(_is_statement(), F.max(F.when(income, F.col("value"))).over(Window.partitionBy("file", "col")))
                 .otherwise(F.max(F.when(F.col("hdr"), F.col("value"))).over(by_col)).alias("header"))
    kept_row = F.col("label").isNotNull() & ~_stop_label(F.col("label"))
    marker = _in_body() & (F.col("col") >= 1) & _is_marker() & (kept_row | ~_is_statement())
    tail = F.substring(F.col("header"), -11, 11)
    c = c.select("*", kept_row.alias("kept_row"), F.max(F.coalesce(marker, F.lit(False)).cast("int")).over(by_col).alias("err"),
                 F.when(~tail.isin(*PERIOD_MARKERS), F.try_to_date(tail, "MMM-dd-yyyy")).alias("period_date"),
                 F.col("header").contains("LTM").alias("is_ltm"))
    c = c.withColumn("year", F.year("period_date"))
    annual = F.collect_set(F.when(income & ~F.col("is_ltm"), F.col("year"))).over(by_file)
    c = c.withColumn("chosen", F.col("period_date").isNotNull() & (~F.col("is_ltm") | ~F.array_contains(annual, F.col("year"))))
    dates = F.collect_set(F.when(income & F.col("chosen"), F.col("period_date"))).over(by_file)
    c = c.withColumn("chosen", F.when(_is_statement(), F.col("chosen")).otherwise(
        F.col("period_date").isNotNull() & F.array_contains(dates, F.col("period_date"))))
    first = F.when(_is_statement(), F.min(F.when(F.col("chosen") & income, F.col("col"))).over(Window.partitionBy("file", "year"))) \
        .otherwise(F.min(F.when(F.col("chosen") & F.col("hdr"), F.col("col"))).over(Window.partitionBy("file", "sheet", "year")))
    bank = F.max(((F.col("sheet") == CAPITALIZATION) & _in_body() & (F.col("col") == 0) & (F.col("value") == "Tier 1 Capital")).cast("int")).over(by_file)
    c = c.select("*", first.alias("first_col"), bank.alias("bank"))
    taken = F.when(_is_statement(), F.col("kept_row")).when(F.col("sheet") == SUMMARY, F.col("label").isin(*SUMMARY_LABELS)) \
        .otherwise(F.when(F.col("bank") == 1, F.col("label").isin(*BANK_LABELS)).otherwise(F.col("label").isin(*OTHER_LABELS)))
    body = c.filter(_in_body() & (F.col("col") >= 1) & taken & (F.col("err") == 0) & F.col("chosen") & (F.col("col") == F.col("first_col")))
    return body.select("file", "year", "sheet", _clean_label_col(F.col("label")).alias("name"),
                       F.col("value").try_cast("double").alias("v"))


def wide(cells: DataFrame, drop_empty: bool = True, required: tuple[str, ...] = ()) -> DataFrame:
    """One row per (file, year), one column per cleaned label found in the
    cells.  A label in two sheets keeps the later sheet's value.  The labels,
    and which of them hold a value, come from one grouped pass; what reaches
    the driver is the vocabulary of the statements.  Columns without a value
    are dropped unless ``drop_empty`` is off; ``required`` ones always stay.
    The long values are written once: both passes read them."""
    return _wide(written(cells), drop_empty, required)


def _wide(cells: DataFrame, drop_empty: bool = True, required: tuple[str, ...] = ()) -> DataFrame:
    lv = cut_lineage(long_values(cells).withColumn("_so", sheet_order()))
    found = lv.groupBy("name").agg(F.count("v").alias("n")).collect()
    names = sorted({r.name for r in found if r.name and (r.n or not drop_empty)} | set(required))
    # the input is hash-partitioned by file, so (file, year) groups need no new exchange
    return lv.groupBy("file", "year").pivot("name", names).agg(F.max_by("v", "_so"))


def identity(cells: DataFrame) -> DataFrame:
    """Company, exchange and ticker from 'Name (EXCH:TICK)'."""
    v = F.col("value")
    c = cells.filter((F.col("sheet") == "Income Statement") & (F.col("row") == 3) & (F.col("col") == 0))
    return c.select("file", F.substring_index(v, " (", 1).alias("company"),
                    F.regexp_extract(v, r"\(([^:]*):", 1).alias("exchange"),
                    F.regexp_extract(v, r":([^)]*)\)", 1).alias("ticker"))


def capitalization(cells: DataFrame) -> DataFrame:
    """Bank files (a 'Tier 1 Capital' row exists) report tier capital;
    others report enterprise value; both report total capital."""
    cells = written(cells)
    wd = _wide(cells, required=("share_price", "shares_out", "market_capitalization", "tier_1_capital", "tier_2_capital",
                                "total_enterprise_value", "total_capital"))
    bank = (label_filter(cells).filter((F.col("label") == "Tier 1 Capital") & (F.col("sheet") == CAPITALIZATION)).select("file").distinct()
            .withColumn("bank", F.lit(True)))
    out = wd.join(bank, "file", "left").withColumn("bank", F.coalesce("bank", F.lit(False)))
    return out.select(
        "file", "year", "bank", "share_price", "shares_out", "market_capitalization",
        F.when(F.col("bank"), F.col("tier_1_capital")).alias("tier_1_capital"),
        F.when(F.col("bank"), F.col("tier_2_capital")).alias("tier_2_capital"),
        F.when(~F.col("bank"), F.col("total_enterprise_value")).alias("total_enterprise_value"),
        F.col("total_capital"))


def stacked(cells: DataFrame) -> DataFrame:
    """All companies' wide tables stacked: the union of their columns in
    sorted order, identity first, rows without revenue dropped."""
    cells = written(cells)
    wd = _wide(cells)
    ident = identity(cells)
    cols = sorted(c for c in wd.columns if c not in ("file", "year"))
    return (wd.join(ident, "file", "left").filter(F.col("total_revenue").isNotNull())
            .select("file", "year", "company", "exchange", "ticker", *cols))
