"""Macro series: wide/long reshaping, overlays and attachment to panels."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import div


def to_wide(long: DataFrame, locs: Sequence[str], key: str = "loc", date: str = "publicdate",
            value: str = "value") -> DataFrame:
    """One column per series; the value list is given, so Spark does not
    run an extra job to discover it."""
    return long.groupBy(date).pivot(key, list(locs)).agg(F.first(value))


def to_long(wide: DataFrame, locs: Sequence[str], key: str = "loc", date: str = "publicdate",
            value: str = "value") -> DataFrame:
    """Wide series table back to (series, date, value) rows, missing cells kept."""
    return wide.unpivot([date], list(locs), key, value).select(key, date, value)


def pct_change(df: DataFrame, key: str, date: str, value: str, out: str) -> DataFrame:
    w = Window.partitionBy(key).orderBy(date)
    return df.withColumn(out, div(F.col(value), F.lag(value).over(w)) - 1)


def overlay(base: DataFrame, upd: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """pandas ``update``: where ``upd`` has a row for the key and a non-null
    value, it replaces the base cell; everything else stays."""
    u = upd.select(*keys, *[F.col(c).alias(f"_u_{c}") for c in cols])
    j = base.join(u, list(keys), "left")
    return j.select(*[F.coalesce(F.col(f"_u_{c}"), F.col(c)).alias(c) if c in cols else F.col(c)
                      for c in base.columns])
