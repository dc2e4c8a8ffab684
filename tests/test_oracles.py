"""Spark queries against their DuckDB oracles on the smallest tables.

The full set runs in tools/check.py at sf0.01; here a representative subset
keeps the suite quick."""
import math

import duckdb
import pytest

from conftest import SF_SMALL

SUBSET = ["ratios_efficiency", "ratios_valuation", "ratios_global", "ratio_monthly_panel", "ratios_annual",
          "interpolate_linear", "zero_fill_after_first", "quarter_check", "describe_panel", "dtd_inputs",
          "macro_overlay", "statement_union", "capitalization_select", "text_stopwords", "phrases_bigram",
          "ngram_sentences", "topk_similar", "rating_features", "first_per_group", "stream_daily_windows",
          "link_market_to_firm", "fundamentals_merge", "panel_group_sum", "estimates_merge"]


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)


@pytest.fixture(scope="module")
def con():
    from sparkfin.sources.tables import TABLES
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", SUBSET)
def test_query_matches_oracle(spark, con, name):
    import __spark_entry__ as E
    pdf = E.queries()[name](spark, SF_SMALL).toPandas()
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(pdf.columns) == sorted(rel.columns)
    assert _rows(list(pdf.columns), [tuple(r) for r in pdf.itertuples(index=False)]) == \
        _rows(rel.columns, rel.fetchall())


def test_every_query_has_a_builder_and_most_an_oracle():
    import __spark_entry__ as E
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 106 and len(o) >= 92


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0 and "at_turnq" in df.columns
