"""Drift of column distributions (Q4): between consecutive windows and against a stored baseline.

A column's distribution is kept as a mergeable quantile sketch with bounded
relative error: counts per key, where a key is the logarithm of the value in
steps of the error, so keys are ordered like the values. Sketches of days or
tables merge by adding counts; nothing is read again. A sketch has at most
some 75,000 keys per column (at 1 %), whatever the number of rows.

The baseline's sketch gives bins of equal mass. Values outside the baseline's
range have bins of their own, as nulls do, so a shift out of the old range
shows. Windows are compared through their sketches alone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 0.01
NULL_BIN, BELOW_BIN = -2, -1


def _scale(accuracy: float) -> tuple[float, int]:
    """The logarithm's step, and a number above that of every finite double."""
    step = math.log((1 + accuracy) / (1 - accuracy))
    return step, int(746 / step) + 2


def sketch_key(col, accuracy: float = ACCURACY) -> Column:
    """The sketch key of a number: non-decreasing in it; values of one key differ by twice the ``accuracy`` at most.

    Null has none; 0, infinities and NaN have keys of their own (NaN last).
    """
    step, far = _scale(accuracy)
    c = (F.col(col) if isinstance(col, str) else col).cast("double")
    size = F.when(F.abs(c) == float("inf"), F.lit(2 * far)).otherwise(F.ceil(F.log(F.abs(c)) / F.lit(step)) + far)
    return (F.when(c.isNull(), F.lit(None)).when(F.isnan(c), F.lit(3 * far)).when(c == 0, F.lit(0))
            .otherwise(F.when(c > 0, size).otherwise(-size))).cast("long")


def key_value(key, accuracy: float = ACCURACY) -> Column:
    """The value that stands for a key: within ``accuracy`` of every value that has it."""
    step, far = _scale(accuracy)
    k = F.col(key) if isinstance(key, str) else key
    size = F.exp((F.abs(k) - far) * F.lit(step)) * F.lit(2 / (1 + math.exp(step)))
    size = F.when(F.abs(k) == 2 * far, F.lit(float("inf"))).otherwise(size)
    return F.when(k == 3 * far, F.lit(float("nan"))).when(k == 0, F.lit(0.0)).otherwise(F.when(k > 0, size).otherwise(-size))


def column_sketches(df: DataFrame, cols, ts: str, window: str = "day", accuracy: float = ACCURACY) -> DataFrame:
    """(window_start, column, key, n) of numeric columns: one aggregation for all of them. A null value has a null key."""
    w = F.window(ts, window).start if " " in window else F.date_trunc(window, ts)
    long = df.select(w.cast("timestamp_ntz").alias("window_start"), *[F.col(c).cast("double").alias(c) for c in cols]) \
        .unpivot(["window_start"], list(cols), "column", "v")
    return long.groupBy("window_start", "column", sketch_key("v", accuracy).alias("key")).agg(F.count(F.lit(1)).alias("n"))


def merge_sketches(sketches: DataFrame, by=("column",)) -> DataFrame:
    """Sketches of several windows (or tables) as one per ``by``."""
    return sketches.groupBy(*by, "key").agg(F.sum("n").alias("n"))


def sketch_quantiles(sketch: DataFrame, qs: list[float], accuracy: float = ACCURACY) -> DataFrame:
    """(column, q, value): quantiles of a merged sketch, each within ``accuracy`` of the exact nearest-rank one; nulls do not count."""
    w = Window.partitionBy("column")
    ranks = sketch.where("key IS NOT NULL").select("column", "key", "n", F.sum("n").over(w.orderBy("key")).alias("upto"), F.sum("n").over(w).alias("total"))
    ask = ranks.withColumn("q", F.explode(F.array(*[F.lit(float(q)) for q in qs])))
    hit = ask.where(F.col("upto") >= F.greatest(F.ceil(F.col("q") * F.col("total") - F.lit(1e-9)), F.lit(1)))
    return hit.groupBy("column", "q").agg(F.min("key").alias("key")).select("column", "q", key_value("key", accuracy).alias("value"))


def equal_mass_bins(baseline: DataFrame, bins: int = 20) -> DataFrame:
    """(column, lows, top): where each bin of about equal mass begins (keys, ascending), and the baseline's last key.

    A key is in one bin only, so a value that holds more than a bin's mass makes fewer bins.
    """
    w = Window.partitionBy("column")
    k = baseline.where("key IS NOT NULL").select("column", "key", (F.sum("n").over(w.orderBy("key")) - F.col("n")).alias("before"),
                                                 F.sum("n").over(w).alias("total"))
    each = k.groupBy("column", F.expr(f"before * {bins} div total").alias("bin")).agg(F.min("key").alias("low"), F.max("key").alias("high"))
    return each.groupBy("column").agg(F.sort_array(F.collect_list("low")).alias("lows"), F.max("high").alias("top"))


def _histograms(sketches: DataFrame, edges: DataFrame, bins: int, by) -> DataFrame:
    """One row per ``by``: h (map bin -> count) and total; ``edges`` has a row per column."""
    bin_ = (F.when(F.col("key").isNull(), NULL_BIN).when(F.col("key") < F.col("lows")[0], BELOW_BIN).when(F.col("key") > F.col("top"), bins)
            .otherwise(F.size(F.filter("lows", lambda low: low <= F.col("key"))) - 1))
    counts = sketches.join(edges, "column").groupBy(*by, bin_.alias("bin")).agg(F.sum("n").alias("c"))
    return counts.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("bin", "c"))).alias("h"), F.sum("c").alias("total"))


def js_distance(h: Column, total: Column, other: Column, other_total: Column, bins: int) -> Column:
    """Jensen-Shannon distance (root of the base-2 divergence) of two maps bin -> count."""
    def term(b):
        p = F.coalesce(F.try_element_at(h, b), F.lit(0)) / total
        q = F.coalesce(F.try_element_at(other, b), F.lit(0)) / other_total
        m = (p + q) / 2
        part = lambda x: F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))
        return (part(p) + part(q)) / 2

    total_js = F.aggregate(F.sequence(F.lit(NULL_BIN), F.lit(bins)), F.lit(0.0), lambda acc, b: acc + term(b))
    return F.sqrt(F.greatest(total_js, F.lit(0.0)))


def drift_report(sketches: DataFrame, baseline: DataFrame, bins: int = 20, digits: int = 6) -> DataFrame:
    """Q4: (window_start, column, drift_type, compared_to, js_distance).

    ``consecutive`` compares each window with the one before it (compared_to
    is its start), ``baseline`` with the merged sketch ``baseline`` (null).
    Both use the baseline's equal-mass bins, so the two distances compare.
    Columns without a value in the baseline have no bins and no rows.
    """
    edges = equal_mass_bins(baseline, bins)
    base = _histograms(baseline, edges, bins, ["column"]).select("column", F.struct(F.lit(None).cast("timestamp_ntz").alias("at"), "h", "total").alias("base"))
    own = _histograms(sketches, edges, bins, ["column", "window_start"])
    before = F.lag(F.struct(F.col("window_start").alias("at"), "h", "total")).over(Window.partitionBy("column").orderBy("window_start"))
    both = own.withColumn("before", before).join(base, "column")
    kinds = F.array(F.struct(F.lit("consecutive").alias("kind"), F.col("before").alias("o")), F.struct(F.lit("baseline").alias("kind"), F.col("base").alias("o")))
    rows = both.select("window_start", "column", "h", "total", F.explode(kinds).alias("x")).where("x.o IS NOT NULL")
    rows = rows.select("window_start", "column", "h", "total", F.col("x.kind").alias("drift_type"), F.col("x.o.at").alias("compared_to"),
                       F.col("x.o.h").alias("oh"), F.col("x.o.total").alias("ototal"))
    distance = js_distance(F.col("h"), F.col("total"), F.col("oh"), F.col("ototal"), bins)
    return rows.select("window_start", "column", "drift_type", "compared_to", F.round(distance, digits).alias("js_distance"))
