"""Column helpers: the small expression kit every ratio and panel job uses.

All helpers return ``Column`` expressions built from ``pyspark.sql.functions``
so they stay inside whole-stage codegen; none of them is a Python UDF.
"""
from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

FIRM = "gvkey"
DATE = "datadate"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def firm_window(keys=(FIRM,), order=DATE) -> WindowSpec:
    """One partitioning (firm) and one order (date) for every window stage,
    so Spark plans a single exchange + sort for a whole ratio family."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return Window.partitionBy(*keys).orderBy(order)


def rint_n(c, n: int) -> Column:
    """Half-even rounding to n places (pandas ``round``), not Spark's half-up."""
    s = float(10 ** n)
    return F.rint(col(c) * s) / s


def z(c) -> Column:
    """Null as zero."""
    return F.coalesce(col(c), F.lit(0.0))


def nz(c) -> Column:
    """Zero as null."""
    c = col(c)
    return F.when(c != 0, c)


def div(num, den) -> Column:
    """Division that yields null for a zero or missing denominator."""
    return F.try_divide(col(num), col(den))


def div_or(num, den, fallback) -> Column:
    """Quotient, or ``fallback`` where the quotient would be missing.

    Mirrors float semantics of the reference: x/0 with x != 0 is infinite
    (not missing, so the fallback is skipped, and the cell ends up null);
    0/0 and null inputs are missing, so the fallback is used.
    """
    num, den = col(num), col(den)
    q = F.try_divide(num, den)
    inf = (den == 0) & num.isNotNull() & (num != 0)
    return F.when(inf, F.lit(None).cast("double")).otherwise(F.coalesce(q, col(fallback)))


def add0(a, b) -> Column:
    """a + b with one missing side counted as zero (pandas ``add(fill_value=0)``)."""
    a, b = col(a), col(b)
    return F.when(a.isNull() & b.isNull(), F.lit(None).cast("double")).otherwise(z(a) + z(b))


def sub0(a, b) -> Column:
    a, b = col(a), col(b)
    return F.when(a.isNull() & b.isNull(), F.lit(None).cast("double")).otherwise(z(a) - z(b))


def _frame(w: WindowSpec, n: int) -> WindowSpec:
    return w.rowsBetween(-(n - 1), 0)


def T4(x, w: WindowSpec, min_periods: int = 4) -> Column:
    """Trailing four-row sum, rounded to one place, null under ``min_periods``
    non-null values (4 for the US panel, 1 for the global one)."""
    x = col(x)
    f = _frame(w, 4)
    return F.when(F.count(x).over(f) >= min_periods, rint_n(F.sum(x).over(f), 1))


def M4(x, w: WindowSpec, min_periods: int = 4) -> Column:
    """Trailing four-row mean with the same gate and rounding as ``T4``."""
    x = col(x)
    f = _frame(w, 4)
    return F.when(F.count(x).over(f) >= min_periods, rint_n(F.avg(x).over(f), 1))


def rolling_mean(x, w: WindowSpec, n: int) -> Column:
    """Mean of the last n rows, only when all n are present."""
    x = col(x)
    f = _frame(w, n)
    return F.when(F.count(x).over(f) >= n, F.avg(x).over(f))


def lag(x, w: WindowSpec, k: int = 1) -> Column:
    return F.lag(col(x), k).over(w)


def lead(x, w: WindowSpec, k: int = 1) -> Column:
    return F.lead(col(x), k).over(w)


def delta(x, w: WindowSpec, k: int = 1) -> Column:
    return col(x) - F.lag(col(x), k).over(w)


def ytd_to_quarter(x, w: WindowSpec, fqtr="fqtr") -> Column:
    """Year-to-date item to its quarterly flow: quarter one as is, else the
    difference to the previous row of the firm."""
    return F.when(col(fqtr) == 1, col(x)).otherwise(col(x) - F.lag(col(x), 1).over(w))


def zero_fill_after_first(x, w: WindowSpec) -> Column:
    """Null as 0 once the firm has had a value (leading gap stays null)."""
    x = col(x)
    seen = F.last(x, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return F.when(seen.isNotNull(), F.coalesce(x, F.lit(0.0)))


def ffill_limit(x, w: WindowSpec, limit: int = 2) -> Column:
    """Forward fill from at most ``limit`` rows back."""
    return F.last(col(x), ignorenulls=True).over(w.rowsBetween(-limit, 0))


def clean_inf(c) -> Column:
    """NaN and +-inf to null."""
    c = col(c)
    return F.when(~(F.isnan(c) | (F.abs(c) == float("inf"))), c)
