"""Physical-plan properties: one shuffle per firm window, no Python in the
relational plans, no product joins in the monthly panel."""
from conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ratio_family_firm_exchanges(spark):
    """From a panel that is read as it is: one exchange by (firm, date) for
    the one row per date, one by firm for all windows."""
    import re
    from sparkfin.operators import panel as P
    from sparkfin.operators import ratios as R
    from sparkfin.plans import inputs
    schema = inputs.us_panel(spark, SF_SMALL).schema
    panel = spark.createDataFrame([], schema).repartition(3)
    plan = _plan(R.family(P.prepare_quarterly(panel), "efficiency"))
    keys = re.findall(r"Exchange hashpartitioning\(([^,)]*)#\d+, ([^,)]*)", plan)
    assert 1 <= len(keys) <= 3 and all(k[0] == "gvkey" for k in keys), plan


def test_no_python_in_relational_plans(spark):
    import __spark_entry__ as E
    q = E.queries()
    for name in ["ratio_output", "ratio_monthly_panel", "dtd_inputs", "statement_wide", "text_stopwords",
                 "phrases_bigram"]:
        plan = _plan(q[name](spark, SF_SMALL))
        assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan, name


def test_monthly_panel_has_no_product_join(spark):
    import __spark_entry__ as E
    plan = _plan(E.queries()["ratio_monthly_panel"](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scan_prunes_columns(spark):
    from sparkfin.sources.tables import read_table
    df = read_table(spark, SF_SMALL, "lineitem").filter("l_suppkey = 3").select("l_suppkey", "l_quantity")
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(l_suppkey), EqualTo(l_suppkey,3)]" in plan
    assert "ReadSchema: struct<l_suppkey:bigint,l_quantity:double>" in plan
