"""Statement headers and period choice."""
from sparkfin.operators import statements as ST

CELLS = "file string, sheet string, row int, col int, value string"


def test_edge_headers(spark):
    rows = [("f", "Income Statement", 13, 1, "Restated Class Dec-31-2018"),
            ("f", "Income Statement", 13, 2, "12 months Dec-31-2018"),
            ("f", "Income Statement", 13, 3, "LTM 12 months Jun-30-2019"),
            ("f", "Income Statement", 13, 4, "Fiscal Year\nChange"),
            ("g", "Income Statement", 13, 1, "12 months Dec-31-2019"),
            ("g", "Income Statement", 13, 2, "LTM 12 months Jun-30-2019")]
    cells = spark.createDataFrame(rows, CELLS)
    p = {(r.file, r.col): r for r in ST.periods(cells).collect()}
    assert (("f", 4) not in p) and p[("f", 1)].period_date.year == 2018
    ch = sorted((r.file, r.col) for r in ST.period_choice(cells).collect())
    # f: both 2018 columns kept, LTM 2019 added (year not present); g: LTM dropped
    assert ch == [("f", 1), ("f", 2), ("f", 3), ("g", 1)]


def test_label_filter_and_error_columns(spark):
    rows = [("f", "Balance Sheet", 16, 0, "Total Assets"), ("f", "Balance Sheet", 17, 0, "LIABILITIES"),
            ("f", "Balance Sheet", 18, 0, "Note: x"), ("f", "Balance Sheet", 16, 1, "5"),
            ("f", "Balance Sheet", 16, 2, "FYC"), ("f", "Balance Sheet", 17, 2, "7")]
    cells = spark.createDataFrame(rows, CELLS)
    assert [r.label for r in ST.label_filter(cells).collect()] == ["Total Assets"]
    assert sorted(r.col for r in ST.body_values(cells).collect()) == [1]


def test_identity(spark):
    cells = spark.createDataFrame([("f", "Income Statement", 3, 0, "Acme Corp (NYSE:ACM)")], CELLS)
    r = ST.identity(cells).first()
    assert (r.company, r.exchange, r.ticker) == ("Acme Corp", "NYSE", "ACM")


def test_labels_come_from_the_cells(spark):
    """A label no list knows becomes a column; capital sheets keep their own dates."""
    head = [("f", "Income Statement", 13, 1, "12 months Dec-31-2018"), ("f", "Income Statement", 13, 2, "12 months Dec-31-2019"),
            ("f", "Historical Capitalization", 12, 1, "Mar-31-2019"), ("f", "Historical Capitalization", 12, 2, "Dec-31-2019"),
            ("f", "Capital Structure Summary", 12, 1, "12 months Dec-31-2018"), ("f", "Capital Structure Summary", 12, 3, "12 months Dec-31-2019")]
    body = [("f", "Income Statement", 16, 0, "Brand New Item"), ("f", "Income Statement", 16, 1, "1"), ("f", "Income Statement", 16, 2, "2"),
            ("f", "Income Statement", 17, 0, "LIABILITIES of kind"), ("f", "Income Statement", 17, 1, "3"),
            ("f", "Balance Sheet", 16, 0, "LIABILITIES"), ("f", "Balance Sheet", 16, 1, "4"),
            ("f", "Historical Capitalization", 16, 0, "Share Price"), ("f", "Historical Capitalization", 16, 1, "10"),
            ("f", "Historical Capitalization", 16, 2, "11"), ("f", "Historical Capitalization", 17, 0, "Shares Out."),
            ("f", "Historical Capitalization", 17, 2, "DSC"), ("f", "Capital Structure Summary", 16, 0, "Total Senior Debt"),
            ("f", "Capital Structure Summary", 16, 1, "5"), ("f", "Capital Structure Summary", 16, 2, "50%"), ("f", "Capital Structure Summary", 16, 3, "6")]
    got = {r.year: r.asDict() for r in ST.wide(spark.createDataFrame(head + body, CELLS)).collect()}
    assert (got[2018]["brand_new_item"], got[2019]["brand_new_item"]) == (1.0, 2.0)
    assert got[2018]["liabilities_of_kind"] == 3.0 and "liabilities" not in got[2018]
    assert (got[2018]["share_price"], got[2019]["share_price"]) == (None, 11.0)
    assert (got[2018]["total_senior_debt"], got[2019]["total_senior_debt"]) == (5.0, 6.0)
