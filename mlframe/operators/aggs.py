"""Aggregations and reshaping."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mlframe.operators.ranking import _left, exact_quantile, group_quantiles


def exact_avg(col, decimals: int) -> Column:
    """Mean of a column holding values with ``decimals`` exact decimals.

    The sum is rounded to those decimals first (removing summation-order
    noise), then divided once: any engine that sums the same rows returns the
    bit-identical double."""
    c = F.col(col) if isinstance(col, str) else col
    return F.round(F.sum(c), decimals) / F.count(c)


def entity_stats(df: DataFrame, keys, col: str, leave_one_out: bool = False, digits: int = 6) -> DataFrame:
    """Per-key mean, count and sample stddev of ``col`` joined back to
    every row (null stddev -> 0); rows with a null key form a group of their
    own. ``leave_one_out`` removes the row's own value from its key's
    statistics, so the target does not leak into its features.

    Moments are central (count, mean, sum of squared deviations), so values
    far from zero lose nothing. Each key is one partial aggregation and one
    null-safe join (broadcast by AQE when the key table is small)."""
    out = df
    for k in ([keys] if isinstance(keys, str) else keys):
        st = df.groupBy(k).agg(F.count(col).alias("_n"), F.sum(col).alias("_s"), F.avg(col).alias("_m"),
                               (F.var_pop(col) * F.count(col)).alias("_d2"))
        out = _left(out, st, [k])
        n, m, d2, x = F.col("_n"), F.col("_m"), F.coalesce("_d2", F.lit(0.0)), F.col(col)
        if leave_one_out:
            own = x.isNotNull()
            n1 = F.when(own, n - 1).otherwise(n)
            m1 = F.when(own, F.when(n > 1, (F.col("_s") - x) / (n - 1))).otherwise(m)
            d1 = F.when(own & (n > 1), F.greatest(d2 - (x - m) * (x - m) * n / (n - 1), F.lit(0.0))).otherwise(d2)
        else:
            n1, m1, d1 = n, m, d2
        std = F.when(n1 > 1, F.sqrt(d1 / (n1 - 1))).otherwise(F.lit(0.0))
        out = out.select("*", F.round(F.when(n1 > 0, m1), digits).alias(f"{k}_avg"), n1.alias(f"{k}_cnt"),
                         F.round(std, digits).alias(f"{k}_std")).drop("_n", "_s", "_m", "_d2")
    return out


def dominant(df: DataFrame, by, col: str, name: str = "dominant") -> DataFrame:
    """Mode of ``col`` per group; ties go to the smallest value. Counts are a
    partial aggregate, the pick is a window over the (small) count table."""
    by = [by] if isinstance(by, str) else list(by)
    cnt = df.groupBy(*by, col).agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(*by).orderBy(F.col("_c").desc(), F.col(col).asc())
    return cnt.withColumn("_r", F.row_number().over(w)).where("_r = 1").select(*by, F.col(col).alias(name))


def pivot_counts(df: DataFrame, row: str, col: str, values, total: str = "total") -> DataFrame:
    """Row x fixed column values, 0 fill, plus the total of all values, listed or not (one aggregate)."""
    return df.groupBy(row).agg(*[F.count_if(F.col(col) == v).alias(str(v)) for v in values], F.count(F.lit(1)).alias(total))


def null_rate(df: DataFrame, by, cols, digits: int = 3) -> DataFrame:
    """Share of nulls per column per group."""
    by = [by] if isinstance(by, str) else list(by)
    return df.groupBy(*by).agg(*[F.round(F.avg(F.col(c).isNull().cast("double")), digits).alias(f"null_{c}") for c in cols])


def to_long(df: DataFrame, ids, cols, name: str = "element", value: str = "value") -> DataFrame:
    """Wide -> long, nulls dropped."""
    ids = [ids] if isinstance(ids, str) else list(ids)
    return df.unpivot(ids, list(cols), name, value).where(F.col(value).isNotNull())


def corr_matrix(df: DataFrame, cols, digits: int = 6) -> DataFrame:
    """All pairwise Pearson correlations in ONE aggregate pass (partial
    moments per task), returned long (a, b, corr)."""
    pairs = list(combinations(cols, 2))
    agg = df.agg(*[F.corr(a, b).alias(f"{a}__{b}") for a, b in pairs])
    stack = ", ".join(f"'{a}', '{b}', `{a}__{b}`" for a, b in pairs)
    return agg.selectExpr(f"stack({len(pairs)}, {stack}) AS (a, b, corr)").select(
        "a", "b", F.round("corr", digits).alias("corr"))


def bin_index(x, lo: float, hi: float, n: int) -> Column:
    """Fixed-width bin 0..n-1 of [lo, hi]; values below have bin -1, values above bin n, so nothing outside hides in an end bin."""
    col = F.col(x) if isinstance(x, str) else x
    inner = F.least(F.floor((col - lo) / (hi - lo) * n), F.lit(n - 1))
    return F.when(col < lo, -1).when(col > hi, n).otherwise(inner).cast("int")


def histogram(df: DataFrame, col, lo: float, hi: float, n: int, by=()) -> DataFrame:
    """Counts per fixed bin (and group)."""
    by = [by] if isinstance(by, str) else list(by)
    return df.groupBy(*by, bin_index(col, lo, hi, n).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def latency_summary(df: DataFrame, col: str, ts: str | None = None, by=(), method: str = "linear",
                    digits: int = 4) -> DataFrame:
    """P10/P50/P90/P99, mean, max (and rows/second over the time
    span; null if all rows have one time). ``linear`` interpolates,
    ``nearest`` is the nearest-rank definition; both are exact and come from
    order statistics over value buckets, so a group of any size is never held
    by one task. ``approx`` is the sketch (``percentile_approx``)."""
    by = [by] if isinstance(by, str) else list(by)
    qs = [0.1, 0.5, 0.9, 0.99]
    names = [f"p{int(q * 100)}" for q in qs]
    aggs = [F.avg(col).alias("mean"), F.max(col).alias("max"), F.count(F.lit(1)).alias("n")]
    if ts:
        span = (F.unix_micros(F.max(ts).cast("timestamp")) - F.unix_micros(F.min(ts).cast("timestamp"))) / 1e6
        aggs.append(F.try_divide(F.count(F.lit(1)), span).alias("per_sec"))
    if method == "approx":
        out = df.groupBy(*by).agg(*[F.percentile_approx(col, q, 10000).alias(n) for q, n in zip(qs, names)], *aggs)
    else:
        # without a group both sides are one row, joined on a constant
        keys = by or ["_one"]
        d = df if by else df.withColumn("_one", F.lit(1))
        found = group_quantiles(d, keys, col, qs, method)
        out = _left(d.groupBy(*keys).agg(*aggs), found, keys)
        out = out.select(*by, *[F.col("q")[i].alias(n) for i, n in enumerate(names)], *[c for c in out.columns if c not in (*keys, "q")])
    return out.select(*by, *[F.round(F.col(c), digits).alias(c) if c not in ("n",) else F.col(c)
                             for c in out.columns if c not in by])


def impute_median(df: DataFrame, cols) -> DataFrame:
    """Nulls replaced by the exact column median, from the two middle
    order statistics (no task holds the column)."""
    return df.select(*[F.coalesce(F.col(c), F.lit(exact_quantile(df, c, 0.5))).alias(c) if c in cols else F.col(c) for c in df.columns])


def pos_weight(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Negatives / positives ratio as the positive-class weight (no row needs it without positives)."""
    ratio = df.agg(F.try_divide(F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1)).alias("r")).scalar()
    return df.withColumn(name, F.when(F.col(label) == 1, ratio).otherwise(F.lit(1.0)))


# ---- A20: stored distinct sketches ----------------------------------------------------

SKETCH_LG = 12  # standard error of a merged estimate: below 1.04 / sqrt(2 ** 12), about 1.6 %


def distinct_sketches(df: DataFrame, by, col: str, lg: int = SKETCH_LG) -> DataFrame:
    """Per group the row count and a HyperLogLog sketch of ``col`` (at most ``2 ** lg`` bytes and a little; nulls do not count)."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.hll_sketch_agg(col, F.lit(lg)).alias("sketch"))


def merge_sketches(sketches: DataFrame, by, n: str = "n_events", users: str = "approx_users") -> DataFrame:
    """Counts and distinct estimates of coarser groups from stored sketches; no row of the source is read again.
    Sketches merge without loss: the estimate is that of one sketch over all rows of the group."""
    return sketches.groupBy(*by).agg(F.sum("n").alias(n), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(users))
