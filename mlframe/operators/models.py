"""Model application helpers shared by batch and stream scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stamp(df: DataFrame, model_name: str, version: str, run_id: str) -> DataFrame:
    """P20: provenance on every prediction row."""
    return df.select("*", F.lit(model_name).alias("model_name"), F.lit(version).alias("model_version"),
                     F.lit(run_id).alias("model_run_id"), F.current_timestamp().alias("scored_at"))


def fit_scaler(df: DataFrame, cols, where: str | None = None) -> DataFrame:
    """M1: mean and population stddev per column (one aggregate), fitted on
    the rows matching ``where`` (e.g. unlabeled rows only)."""
    d = df.where(where) if where else df
    agg = d.agg(*[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"s_{c}") for c in cols])
    stack = ", ".join(f"'{c}', m_{c}, s_{c}" for c in cols)
    return agg.selectExpr(f"stack({len(cols)}, {stack}) AS (column, mean, std)")


def apply_scaler(df: DataFrame, scaler: DataFrame, cols, prefix: str = "z_") -> DataFrame:
    """Standardise with a fitted scaler. Like any ``pyspark.ml`` fit, the
    fitted parameters (two numbers per column, never data rows) come back to
    the driver once and enter the plan as literals, so the transform is a
    plain projection inside whole-stage codegen. A constant column becomes 0;
    a column without values becomes null."""
    p = {r["column"]: (r["mean"], r["std"]) for r in scaler.collect()}
    def z(c):
        mean, std = p[c]
        if mean is None:
            return F.lit(None).cast("double")
        return (F.col(c) - F.lit(mean)) / F.lit(std) if std else F.when(F.col(c).isNotNull(), F.lit(0.0))

    return df.select("*", *[z(c).alias(prefix + c) for c in cols])
