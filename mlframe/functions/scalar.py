"""Scalar column functions (P1-P22, N2). All are built-in expressions, so
they stay inside whole-stage codegen; none is a Python UDF."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---- fixed values that must equal the reference's --------------------------
# Characters replaced by "_" in column names.
BAD_NAME_CHARS = " ,;{}()\n\t=-"
# Vendor missing-value sentinel.
SENTINEL = -9999
# On-demand features: night hours are >= 23 or < 6; high amount is > 500;
# category ordinal A..E -> 0..4, anything else -1.
NIGHT_FROM, NIGHT_TO = 23, 6
HIGH_AMOUNT = 500.0
CATEGORY_ORDER = ["A", "B", "C", "D", "E"]
# Holiday demand factors by day-of-year band (inclusive), else 1.0.
HOLIDAY_BANDS = [
    (144, 152, 1.25),  # Memorial Day
    (181, 190, 1.35),  # July 4
    (240, 250, 1.20),  # Labor Day
    (326, 334, 1.15),  # Thanksgiving
    (354, 366, 1.18),  # Christmas / New Year
]
# -----------------------------------------------------------------------------


def c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def sanitize(df: DataFrame) -> DataFrame:
    """P5: replace characters that break table writers by "_"."""
    pat = "[" + re.escape(BAD_NAME_CHARS) + "]"
    return df.toDF(*[re.sub(pat, "_", n) for n in df.columns])


def replace_sentinel(df: DataFrame, cols, v=SENTINEL) -> DataFrame:
    """Sentinel -> null for the listed columns that exist, in one projection."""
    cols = set(cols) & set(df.columns)
    return df.select(*[F.nullif(F.col(n), F.lit(v)).alias(n) if n in cols else F.col(n) for n in df.columns])


def log_columns(df: DataFrame, cols, keep_null: bool = False, prefix: str = "log_") -> DataFrame:
    """``log1p(greatest(x, 0))``. ``greatest`` skips nulls, so a null
    becomes log1p(0) = 0 unless ``keep_null``."""
    out = []
    for n in cols:
        e = F.log1p(F.greatest(F.col(n), F.lit(0.0)))
        if keep_null:
            e = F.when(F.col(n).isNotNull(), e)
        out.append(e.alias(prefix + n))
    return df.select("*", *out)


def calendar(df: DataFrame, ts: str, prefix: str = "") -> DataFrame:
    """Calendar parts of a timestamp (Spark day-of-week: 1 = Sunday)."""
    t = F.col(ts)
    return df.select("*",
                     F.hour(t).alias(prefix + "hour"), F.dayofweek(t).alias(prefix + "dow"),
                     F.month(t).alias(prefix + "month"), F.year(t).alias(prefix + "year"),
                     F.dayofyear(t).alias(prefix + "doy"), F.weekofyear(t).alias(prefix + "iso_week"),
                     F.quarter(t).alias(prefix + "quarter"))


def epoch_to_ts(x, unit: str = "s") -> Column:
    """Epoch seconds / milliseconds -> timestamp."""
    return F.timestamp_millis(c(x).cast("long")) if unit == "ms" else F.timestamp_seconds(c(x))


def period_start(ts, grain: str) -> Column:
    return F.to_date(ts) if grain == "day" else F.trunc(c(ts), "month")


def period_end(ts, grain: str) -> Column:
    """Start of the next day / month, as a timestamp of the input's kind."""
    if grain == "day":
        return F.date_add(F.to_date(ts), 1)
    return F.add_months(F.trunc(c(ts), "month"), 1)


def holiday_factor(ts) -> Column:
    """P10: demand factor from the day-of-year band."""
    doy = F.dayofyear(ts)
    e = None
    for lo, hi, f in HOLIDAY_BANDS:
        cond = doy.between(lo, hi)
        e = F.when(cond, F.lit(f)) if e is None else e.when(cond, F.lit(f))
    return e.otherwise(F.lit(1.0))


def multi_hot(df: DataFrame, col: str, terms, exact: bool = False, prefix: str = "g_") -> DataFrame:
    """One 0/1 column per vocabulary term, in one projection.

    ``exact=True`` tests whole tokens (split on spaces and ``|``) instead of a
    substring, so a term never matches inside a longer word.
    """
    if exact:
        toks = F.split(F.col(col), r"[ |]+")
        cols = [F.array_contains(toks, t).cast("int").alias(prefix + re.sub(r"\W", "_", t)) for t in terms]
    else:
        cols = [F.col(col).contains(t).cast("int").alias(prefix + re.sub(r"\W", "_", t)) for t in terms]
    return df.select("*", *cols)


# ---- P12 on-demand request features (native expressions, no Python UDF) ----

def odf_log_amount(amount) -> Column:
    return F.log1p(F.coalesce(c(amount), F.lit(0.0)))


def odf_is_night(ts) -> Column:
    h = F.hour(ts)
    return F.coalesce(((h >= NIGHT_FROM) | (h < NIGHT_TO)).cast("int"), F.lit(0))


def odf_high_amount(amount) -> Column:
    return (F.coalesce(c(amount), F.lit(0.0)) > HIGH_AMOUNT).cast("int")


def odf_category_ordinal(code) -> Column:
    # array_position is 1-based and returns 0 when absent -> -1; null -> -1
    pos = F.array_position(F.array(*[F.lit(x) for x in CATEGORY_ORDER]), c(code))
    return F.coalesce(pos.cast("int") - 1, F.lit(-1))


def on_demand(df: DataFrame, amount: str = "amount", ts: str = "event_ts", code: str = "category_code") -> DataFrame:
    return df.select("*",
                     odf_log_amount(amount).alias("odf_log_amount"),
                     odf_is_night(ts).alias("odf_is_night"),
                     odf_high_amount(amount).alias("odf_high_amount"),
                     odf_category_ordinal(code).alias("odf_category_ordinal"))


ON_DEMAND_SQL_FUNCTIONS = {
    # U4: the same four features as SQL functions (no Python body).
    "odf_log_amount": "(amount DOUBLE) RETURNS DOUBLE RETURN ln(1 + coalesce(amount, 0D))",
    "odf_is_night": "(event_ts TIMESTAMP_NTZ) RETURNS INT RETURN coalesce(CAST(hour(event_ts) >= 23 OR hour(event_ts) < 6 AS INT), 0)",
    "odf_high_amount": "(amount DOUBLE) RETURNS INT RETURN CAST(coalesce(amount, 0D) > 500 AS INT)",
    "odf_category_ordinal": "(code STRING) RETURNS INT RETURN coalesce(array_position(array('A','B','C','D','E'), code) - 1, -1)",
}


def register_on_demand(spark, temporary: bool = True) -> list[str]:
    """U4: register the on-demand features as SQL scalar functions."""
    kind = "TEMPORARY FUNCTION" if temporary else "FUNCTION"
    for name, body in ON_DEMAND_SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE {kind} {name}{body}")
    return list(ON_DEMAND_SQL_FUNCTIONS)


def encode_profile(df: DataFrame) -> DataFrame:
    """Premium flag, numeric region code ("r3" -> 3), numerics pass through."""
    return df.select("*",
                     (F.col("account_tier") == "premium").cast("int").alias("is_premium"),
                     F.regexp_replace("home_region", "r", "").cast("int").alias("home_region_code"))


def band_pos(value, low, high) -> Column:
    """Position inside the normal band; null for a zero-width band."""
    return F.try_divide(c(value) - c(low), c(high) - c(low))


def ensemble_mean(cols) -> Column:
    """Element-wise mean of several score columns."""
    cols = [c(x) for x in cols]
    s = cols[0]
    for x in cols[1:]:
        s = s + x
    return s / F.lit(float(len(cols)))


def key_from_path(path, suffix: bool = True) -> Column:
    """Core key from a file name (``.../GC01-Y_geochem.csv`` -> ``GC01-Y``)."""
    base = F.element_at(F.split(c(path), "/"), -1)
    key = F.regexp_extract(base, r"^([^_.]+)", 1)
    return key


def site_from_key(key) -> Column:
    """Strip a ``-X``/``-Y``/``-Z`` section suffix."""
    return F.regexp_replace(c(key), r"-[XYZ]$", "")
