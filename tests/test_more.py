"""Exact quantiles, rating outputs, streaming = batch."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL


def test_exact_quantiles_match_numpy(spark):
    from sparkfin.operators.aggregates import exact_quantiles
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=1001), rng.uniform(size=10)
    rows = [("a", float(x)) for x in a] + [("b", float(x)) for x in b]
    df = spark.createDataFrame(rows, "item string, v double").repartition(7)
    got = {(r.item, r.q): r.value for r in exact_quantiles(df, [0.25, 0.5, 0.75]).collect()}
    for k, arr in (("a", a), ("b", b)):
        for q in (0.25, 0.5, 0.75):
            assert got[(k, q)] == pytest.approx(float(np.quantile(arr, q)), rel=1e-12)


@pytest.fixture(scope="module")
def scored(spark):
    from sparkfin.plans import q_rating as QR
    model, test = QR._model_and_test(spark, SF_SMALL)
    return model.transform(test)


def test_class_percents_are_whole_and_bounded(scored):
    from sparkfin.operators.rating import probabilities
    p = probabilities(scored)
    cols = [c for c in p.columns if c.startswith("p_")]
    assert len(cols) == 22
    row_sums = p.select(sum(F.col(c) for c in cols).alias("s")).collect()
    assert all(0 <= r.s <= 100 for r in row_sums)


def test_top_classes_sorted(scored):
    from sparkfin.operators.rating import top_classes
    for r in top_classes(scored).collect():
        probs = [x["prob"] for x in r.top_classes]
        assert len(probs) == 3 and probs == sorted(probs, reverse=True)


def test_accuracy_row(scored):
    from sparkfin.operators.rating import accuracy
    r = accuracy(scored).first()
    assert 0.0 <= r.accuracy <= 1.0 and r.n_test > 0 and 0.0 < r.majority_share <= 1.0


def test_stream_equals_batch(spark, tmp_path):
    """The stream counts every day, the last ones included, and a second run
    over the same folder finds nothing new."""
    from sparkfin.streaming.daily import daily_windows
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    b = ev.withColumn("day", F.to_date("ts")).groupBy("day", "event_type").count().collect()
    want = {(r.day, r.event_type): r["count"] for r in b}
    for _ in range(2):
        got = daily_windows(spark, SF_SMALL, str(tmp_path / "stream"))
        assert {(r.day, r.event_type): r.n_events for r in got.collect()} == want


def test_global_annual_ratios_of_null_single_repeated_and_no_rows(spark):
    import datetime as dt

    from sparkfin.operators import ratios as R
    from sparkfin.sources.adapters import A_ITEMS
    values = ["prcc_f", "csho", "ajex", *A_ITEMS, "mcap_comp", "prc_comp_unadj", "prc_comp_adj", "dvrate", "futepsgrowth", "ltg_eps"]
    schema = "isin string, datadate date, " + ", ".join(f"`{c}` double" for c in values)
    full = {c: 10.0 for c in values}

    def row(isin, year, **own):
        return (isin, dt.date(year, 12, 31), *[({**full, **own}).get(c) for c in values])
    nothing = ("i0", dt.date(2000, 12, 31), *[None] * len(values))
    df = spark.createDataFrame([nothing, row("i1", 2000), row("i1", 2001, revt=30.0, gp=99.0, mcap_comp=50.0),
                                row("i1", 2001, revt=30.0, gp=99.0, mcap_comp=50.0)], schema)
    got = {(r.isin, r.datadate.year): r for r in R.annual_ratios_global(df).collect()}
    assert sorted(got) == [("i0", 2000), ("i1", 2000), ("i1", 2001)]
    assert all(got[("i0", 2000)][c] is None for c in R.ANNUAL_COLS_GLB)
    first, second = got[("i1", 2000)], got[("i1", 2001)]
    assert first.aftret_eqa is None and second.aftret_eqa == 0.0     # no earlier year; income less preferred dividends
    assert second.GProfa == 2.0                                     # revenue less cost, the given gross profit unused
    assert second.bma == 10.0 / 50.0 and first.pcfa == 50.0 / 10.0 and second.pcfa is None
    assert R.annual_ratios_global(df.limit(0)).count() == 0
