"""Aggregate expressions of the accuracy marts."""

from __future__ import annotations

from .scalar import pg_round


def mae(abs_error: str, digits: int = 2) -> str:
    return pg_round(f"avg({abs_error})", digits)


def rmse(squared_error: str, digits: int = 2) -> str:
    return pg_round(f"sqrt(avg({squared_error}))", digits)


def pct_within(abs_error: str, tolerance: float, digits: int = 1) -> str:
    """Share of all rows, in percent, with an error within ``tolerance``; an unknown error is a miss."""
    return pg_round(f"cast(count_if({abs_error} <= {float(tolerance)}D) AS double) / count(1) * 100.0D", digits)


def avg_where(value: str, condition: str) -> str:
    return f"avg({value}) FILTER (WHERE {condition})"
