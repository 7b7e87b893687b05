"""Helpers for writing the DuckDB oracle strings."""

from __future__ import annotations


def R(expr: str, n: int = 6) -> str:
    """Round like Spark's ``round`` on doubles (half-up on the decimal form)."""
    return f"CAST(round(CAST(CAST(({expr}) AS DOUBLE) AS VARCHAR)::DECIMAL(38,17), {n}) AS DOUBLE)"
