"""Set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_all(dfs, allow_missing: bool = False) -> DataFrame:
    """Union many parts by column name in one plan (a single Union node
    feeding one write, not one write per part)."""
    dfs = list(dfs)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), dfs)


def distinct_keys(df: DataFrame, keys) -> DataFrame:
    """Distinct key set (partial dedup on the map side, then one shuffle)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.select(*keys).distinct()
