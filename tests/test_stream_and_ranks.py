"""Stream: arrivals, late rows, replaced files.  Quantiles: a hot value."""
import datetime as dt
import os

import numpy as np
import pandas as pd
import pytest

from sparkfin.operators.aggregates import exact_quantiles, rolling_deviation
from sparkfin.streaming.daily import daily_windows, late_rows

GLOB = "events*.parquet"


def _arrive(folder, name, rows):
    t = pd.DataFrame([(i, dt.datetime(2024, 1, day, 12), kind, float(v)) for i, day, kind, v in rows],
                     columns=["event_id", "ts", "event_type", "value"])
    t["ts"] = t["ts"].astype("datetime64[us]")
    t.to_parquet(os.path.join(folder, name), index=False)


def _counts(spark, source, folder):
    got = daily_windows(spark, source, folder, GLOB).collect()
    return {(r.day.day, r.event_type): (r.n_events, r.value_sum) for r in got}


def test_arrivals_late_rows_and_a_replaced_file(spark, tmp_path):
    source, folder = str(tmp_path / "in"), str(tmp_path / "state")
    os.mkdir(source)
    _arrive(source, "events-1.parquet", [(1, 10, "a", 1.5), (2, 10, "a", 2), (2, 10, "a", 2), (3, 11, "b", 4)])
    first = {(10, "a"): (2, 3.5), (11, "b"): (1, 4.0)}
    assert _counts(spark, source, folder) == first
    assert _counts(spark, source, folder) == first  # nothing new
    # a second arrival: one new day, a duplicate, one row that is days late
    _arrive(source, "events-2.parquet", [(4, 12, "a", 8), (3, 11, "b", 4), (9, 2, "a", 16)])
    second = {**first, (12, "a"): (1, 8.0)}
    assert _counts(spark, source, folder) == second
    assert [r.event_id for r in late_rows(spark, source, folder, GLOB).collect()] == [9]
    # a known file is replaced: what was counted no longer holds
    _arrive(source, "events-1.parquet", [(5, 11, "c", 1), (6, 11, "c", 1)])
    got = _counts(spark, source, folder)
    assert got[(11, "c")] == (2, 2.0) and (10, "a") not in got and got[(12, "a")] == (1, 8.0) and got[(11, "b")] == (1, 4.0)


def test_quantiles_with_a_value_that_fills_most_rows(spark):
    rng = np.random.default_rng(3)
    a = np.concatenate([np.zeros(4000), rng.normal(size=999)])
    b = np.repeat(7.5, 300)
    rows = [("a", float(x)) for x in a] + [("b", float(x)) for x in b] + [("c", 1.0)]
    df = spark.createDataFrame(rows, "item string, v double").repartition(9)
    qs = [0.0, 0.01, 0.25, 0.5, 0.99, 1.0]
    got = {(r.item, r.q): r.value for r in exact_quantiles(df, qs).collect()}
    for key, x in (("a", a), ("b", b), ("c", np.array([1.0]))):
        for q in qs:
            assert got[key, q] == pytest.approx(float(np.quantile(x, q)), rel=1e-12, abs=1e-15)


def test_rolling_deviation_of_heavy_tails(spark):
    rng = np.random.default_rng(6)
    series = {"a": rng.standard_t(1.5, 700) * 1e-3, "b": 1e6 + rng.normal(size=95), "c": rng.normal(size=20), "d": rng.normal(size=21), "e": np.full(70, 0.25)}
    series["a"][300] = 1e4  # one wild value must not spoil the frames after it
    rows = [(k, i, None if k == "d" and i == 3 else float(v)) for k, x in series.items() for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "k string, t int, v double").repartition(5)
    got = {(r.k, r.t): r.s for r in rolling_deviation(df, "v", "k", "t", 20, "s").collect()}
    assert len(got) == len(rows)
    for k, x in series.items():
        for i in range(len(x)):
            frame = x[max(0, i - 19):i + 1]
            if len(frame) < 20 or k == "d" and i - 19 <= 3:
                assert got[k, i] is None
            else:
                assert got[k, i] == pytest.approx(np.std(frame, ddof=1), rel=1e-9, abs=1e-12)
