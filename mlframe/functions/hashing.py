"""Deterministic pseudo-random draws from row keys.

A draw depends only on the key columns and a lane name, never on
partitioning, task order or a seed held in memory, so a re-run after an
executor loss gives the same rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO32 = 4294967296.0


def _key(cols, lane: str) -> Column:
    parts = [F.lit(lane)] + [F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in cols]
    return F.concat_ws("|", *parts)


def hash_uniform(*cols, lane: str = "u") -> Column:
    """U[0,1) from the first 32 bits of md5(lane|k1|k2...)."""
    h = F.substring(F.md5(_key(cols, lane)), 1, 8)
    return F.conv(h, 16, 10).cast("double") / F.lit(TWO32)


def hash_uniform_sql(cols: str, lane: str = "u") -> str:
    """DuckDB twin of :func:`hash_uniform` (``cols`` is a comma list of SQL expressions)."""
    keys = ", ".join(f"CAST({c.strip()} AS VARCHAR)" for c in cols.split(","))
    return f"(CAST(('0x' || substr(md5(concat_ws('|', '{lane}', {keys})), 1, 8)) AS UBIGINT) / {TWO32})"


def hash_normal(*cols, lane: str = "n") -> Column:
    """N(0,1) by Box-Muller over two uniform lanes, first lane floored at 1e-12."""
    u1 = F.greatest(hash_uniform(*cols, lane=lane + "1"), F.lit(1e-12))
    u2 = hash_uniform(*cols, lane=lane + "2")
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2 * math.pi) * u2)


def hash_normal_sql(cols: str, lane: str = "n") -> str:
    u1 = f"greatest({hash_uniform_sql(cols, lane + '1')}, 1e-12)"
    u2 = hash_uniform_sql(cols, lane + "2")
    return f"(sqrt(-2.0 * ln({u1})) * cos({2 * math.pi} * {u2}))"


def lognormal_count(rate: Column, z: Column, sigma: float = 0.35) -> Column:
    """Count draw ``round(rate * exp(sigma * z))`` used by demand synthesis."""
    return F.round(rate * F.exp(F.lit(sigma) * z))
