"""DuckDB spellings of the window kit, for the oracle SQL texts.

These build plain SQL strings; they share nothing with the Spark Column code
except the meaning they are meant to have.
"""
from __future__ import annotations

from ..sources.adapters import duckdb_with
from .inputs import VIEWS


def W(part: str = "gvkey", order: str = "datadate", frame: str | None = None) -> str:
    f = f" {frame}" if frame else ""
    return f"OVER (PARTITION BY {part} ORDER BY {order}{f})"


def rows(n: int) -> str:
    return f"ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW"


def t4(x: str, minp: int = 4, part: str = "gvkey", order: str = "datadate") -> str:
    w = W(part, order, rows(4))
    return f"(CASE WHEN count({x}) {w} >= {minp} THEN round_even(sum({x}) {w} * 10, 0) / 10 END)"


def m4(x: str, minp: int = 4, part: str = "gvkey", order: str = "datadate") -> str:
    w = W(part, order, rows(4))
    return f"(CASE WHEN count({x}) {w} >= {minp} THEN round_even(avg({x}) {w} * 10, 0) / 10 END)"


def lag(x: str, k: int = 1, part: str = "gvkey", order: str = "datadate") -> str:
    return f"lag({x}, {k}) {W(part, order)}"


def lead(x: str, k: int = 1, part: str = "gvkey", order: str = "datadate") -> str:
    return f"lead({x}, {k}) {W(part, order)}"


def z(x: str) -> str:
    return f"coalesce({x}, 0.0)"


def nz(x: str) -> str:
    return f"nullif({x}, 0)"


def dv(a: str, b: str) -> str:
    return f"(({a}) / nullif({b}, 0))"


def dv_or(a: str, b: str, fb: str) -> str:
    return (f"(CASE WHEN ({b}) = 0 AND ({a}) IS NOT NULL AND ({a}) <> 0 THEN NULL "
            f"ELSE coalesce(({a}) / nullif({b}, 0), {fb}) END)")


def add0(a: str, b: str) -> str:
    return f"(CASE WHEN ({a}) IS NULL AND ({b}) IS NULL THEN NULL ELSE {z(a)} + {z(b)} END)"


def sub0(a: str, b: str) -> str:
    return f"(CASE WHEN ({a}) IS NULL AND ({b}) IS NULL THEN NULL ELSE {z(a)} - {z(b)} END)"


def sql(adapters: list[str], body: str, extra_ctes: str = "") -> str:
    """Adapter CTEs, optional extra CTEs (``name AS (...), ...``), then body."""
    w = duckdb_with(adapters, VIEWS)
    if extra_ctes:
        w = (w.rstrip() + ",\n" if w else "WITH ") + extra_ctes + "\n"
    return w + body


def ordered_mean(x: str, n: int, part: str = "gvkey", order: str = "datadate") -> str:
    """Mean of the last n rows, only when all n are present, summed oldest
    first (the order a sliding frame adds its rows)."""
    w = W(part, order)
    terms = [f"lag({x}, {k}) {w}" for k in range(n - 1, 0, -1)] + [x]
    return (f"(CASE WHEN count({x}) {W(part, order, rows(n))} >= {n} "
            f"THEN ({' + '.join(terms)}) / {n} END)")


def interp_sql(c: str) -> str:
    """Linear interpolation by row position (needs a row-number column ``rn``)."""
    back = W(frame="ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW")
    fwd = W(frame="ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING")
    pv = f"last_value({c} IGNORE NULLS) {back}"
    pr = f"max(CASE WHEN {c} IS NOT NULL THEN rn END) {back}"
    nv = f"first_value({c} IGNORE NULLS) {fwd}"
    nr = f"min(CASE WHEN {c} IS NOT NULL THEN rn END) {fwd}"
    return (f"CASE WHEN {c} IS NOT NULL THEN {c} WHEN {pr} IS NULL THEN NULL WHEN {nr} IS NULL THEN {pv} "
            f"ELSE {pv} + ({nv} - {pv}) * (rn - {pr}) / ({nr} - {pr}) END AS {c}")
