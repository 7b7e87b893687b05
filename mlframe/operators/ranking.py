"""Positions and running sums over a whole table without a single-partition
window (used by W7, W12, L3, M5, M6).

Spark runs ``row_number() OVER (ORDER BY x)`` with no PARTITION BY in one
task. Here the order is split into ranges by a bucket expression that is
monotone in the order: a hash range, a time unit, or :func:`value_buckets`,
whose bounds are quantiles of the data, so that outliers and piled-up values
do not fill one bucket. Per-bucket counts (a tiny aggregate) give running
offsets, and each bucket is numbered by its own task. Null partitions and
null buckets are values like any other: all joins here are null-safe.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


ROWS_EACH = 200_000  # rows that a bucket of values should hold
MOST_BUCKETS = 32_768  # 6.5 billion rows at ROWS_EACH; buckets of a larger table grow


def _same(left: DataFrame, right: DataFrame, keys) -> DataFrame:
    """Null-safe inner join on ``keys``; the left side's key columns stay."""
    names = {k: f"_j{i}" for i, k in enumerate(keys)}
    right = right.select(*[F.col(k).alias(v) for k, v in names.items()], *[c for c in right.columns if c not in names])
    cond = F.lit(True)
    for k, v in names.items():
        cond = cond & left[k].eqNullSafe(right[v])
    return left.join(right, cond).drop(*names.values())


def value_bounds(df: DataFrame, col: str, rows_each: int = ROWS_EACH) -> list:
    """Upper bounds of buckets of about ``rows_each`` rows: approximate quantiles from one bounded sketch per task.

    At most MOST_BUCKETS numbers reach the driver. Only the buckets' sizes
    depend on the sketch's error, never a result.
    """
    c = F.col(col)
    c = F.unix_micros(c.cast("timestamp")) if dict(df.dtypes)[col].startswith("timestamp") else c.cast("double")
    n = df.agg(F.count(col)).first()[0]
    k = min(MOST_BUCKETS, n // rows_each + 1)
    if k < 2:
        return []
    cuts = df.agg(F.percentile_approx(c, [i / k for i in range(1, k)], 4 * k)).first()[0]
    return sorted(set(cuts or []))


def value_buckets(df: DataFrame, col: str, rows_each: int = ROWS_EACH) -> Column:
    """Bucket number of ``col`` (a number or a time), non-decreasing in it; null goes to -1 (nulls first).

    Rows of one value share a bucket.
    """
    bounds = value_bounds(df, col, rows_each)
    c = F.col(col)
    c = F.unix_micros(c.cast("timestamp")) if dict(df.dtypes)[col].startswith("timestamp") else c.cast("double")
    return F.when(c.isNull(), -1).otherwise(_search(c, bounds)).cast("int")


def _search(c: Column, bounds: list) -> Column:
    """How many of the sorted bounds are below ``c``: a binary search in one constant array, the same small expression for any number of bounds."""
    if not bounds:
        return F.lit(0)
    kind = "bigint" if isinstance(bounds[0], int) else "double"
    # one text for the whole array, which the optimizer turns into a constant; NaN and infinities are spelled as SQL casts them
    text = ",".join(str(b) if kind == "bigint" else {"inf": "Infinity", "-inf": "-Infinity", "nan": "NaN"}.get(repr(b), repr(b)) for b in bounds)
    array = F.split(F.lit(text), ",").cast(f"array<{kind}>")
    steps = [1 << k for k in reversed(range(len(bounds).bit_length()))]
    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0),
                       lambda at, s: at + F.when(F.coalesce(F.get(array, at + s - 1) < c, F.lit(False)), s).otherwise(F.lit(0)))


def positions(df: DataFrame, order: list, bucket: Column, partition=(), name: str = "pos") -> DataFrame:
    """1-based position of each row in ``order`` within ``partition``.

    ``bucket`` must be non-decreasing in ``order`` (rows of a lower bucket
    always sort first). Exact; the work per task is one bucket.
    """
    partition = list(partition)
    d = df.withColumn("_bk", bucket)
    counts = d.groupBy(*partition, "_bk").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*partition).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select(*partition, "_bk", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    wr = Window.partitionBy(*partition, "_bk").orderBy(*order)
    return (_same(d.withColumn("_rn", F.row_number().over(wr)), offs, [*partition, "_bk"])
            .withColumn(name, F.col("_rn") + F.col("_off"))
            .drop("_bk", "_rn", "_off"))


def running_sums(df: DataFrame, order: str, values: list[str], bucket: Column, partition=(),
                 descending: bool = False, suffix: str = "_cum") -> DataFrame:
    """Inclusive running sums of ``values`` in ``order`` (one row per distinct
    order value expected; aggregate ties first)."""
    partition = list(partition)
    d = df.withColumn("_bk", bucket)
    tot = d.groupBy(*partition, "_bk").agg(*[F.sum(v).alias(f"_t_{v}") for v in values])
    ob = F.col("_bk").desc() if descending else F.col("_bk").asc()
    w = Window.partitionBy(*partition).orderBy(ob).rowsBetween(Window.unboundedPreceding, -1)
    offs = tot.select(*partition, "_bk", *[F.coalesce(F.sum(f"_t_{v}").over(w), F.lit(0)).alias(f"_o_{v}") for v in values])
    oc = F.col(order).desc() if descending else F.col(order).asc()
    wr = Window.partitionBy(*partition, "_bk").orderBy(oc).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = _same(d.select("*", *[F.sum(v).over(wr).alias(f"_r_{v}") for v in values]), offs, [*partition, "_bk"])
    for v in values:
        out = out.withColumn(v + suffix, F.col(f"_r_{v}") + F.col(f"_o_{v}"))
    return out.drop("_bk", *[f"_r_{v}" for v in values], *[f"_o_{v}" for v in values])


def unit_bucket(u, n: int = 1024) -> Column:
    """Bucket for a value in [0, 1) (hash draws, probabilities)."""
    col = F.col(u) if isinstance(u, str) else u
    return F.least(F.floor(col * n), F.lit(n - 1)).cast("int")


def group_quantiles(df: DataFrame, by, col: str, qs: list[float], kind: str = "linear", rows_each: int = ROWS_EACH) -> DataFrame:
    """Exact quantiles per group, one array<double> column ``q`` in the order of ``qs``; nulls of ``col`` do not count.

    ``linear`` interpolates (``percentile`` / ``quantile_cont``), ``nearest``
    takes the first value whose cumulative share reaches q
    (``percentile_disc``). Counts per (group, value bucket) tell which buckets
    hold the wanted order statistics; only their different values are sorted,
    with their counts, each bucket in a task of its own: no task holds or
    sorts a whole group, nor the rows of one value that is repeated often. A group
    without a value has nulls.
    """
    by = [by] if isinstance(by, str) else list(by)
    d = df.select(*by, F.col(col).cast("double").alias("_v"))
    d = d.withColumn("_bk", value_buckets(d, "_v", rows_each))
    counts = d.where("_v IS NOT NULL").groupBy(*by, "_bk").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    counts = (counts.withColumn("_off", F.sum("_n").over(w.orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)))
              .withColumn("_all", F.sum("_n").over(w)).withColumn("_off", F.coalesce("_off", F.lit(0))))
    wanted = []
    for i, q in enumerate(qs):
        if kind == "linear":
            h = (F.col("_all") - 1) * F.lit(q)
            wanted += [F.struct(F.lit(i).alias("i"), (F.floor(h) + 1).alias("r"), (F.ceil(h) - h).alias("w"), (F.floor(h) == F.ceil(h)).alias("whole")),
                       F.struct(F.lit(i).alias("i"), (F.ceil(h) + 1).alias("r"), (h - F.floor(h)).alias("w"), F.lit(False).alias("whole"))]
        else:
            r = F.greatest(F.ceil(F.col("_all") * F.lit(q) - F.lit(1e-12)), F.lit(1))
            wanted.append(F.struct(F.lit(i).alias("i"), r.alias("r"), F.lit(1.0).alias("w"), F.lit(True).alias("whole")))
    ranks = counts.select(*by, "_bk", "_off", "_n", F.explode(F.array(*wanted)).alias("_s")).where(
        (F.col("_s.r") > F.col("_off")) & (F.col("_s.r") <= F.col("_off") + F.col("_n")))
    need = ranks.groupBy(*by, "_bk").agg(F.first("_off").alias("_off"), F.collect_list("_s").alias("_wanted"))
    wr = Window.partitionBy(*by, "_bk").orderBy("_v")
    rows = (_same(d.where("_v IS NOT NULL"), need, [*by, "_bk"]).groupBy(*by, "_bk", "_v", "_off", "_wanted").agg(F.count(F.lit(1)).alias("_c"))
            .withColumn("_r", F.sum("_c").over(wr.rowsBetween(Window.unboundedPreceding, Window.currentRow)) + F.col("_off")))  # its last place
    hit = rows.select(*by, "_v", F.explode(F.filter("_wanted", lambda s: (s["r"] <= F.col("_r")) & (s["r"] > F.col("_r") - F.col("_c")))).alias("_s"))
    value = F.when(F.col("_s.whole"), F.col("_v")).when(F.col("_s.w") > 0, F.col("_s.w") * F.col("_v"))
    parts = hit.groupBy(*by).agg(*[F.sum(F.when(F.col("_s.i") == i, value)).alias(f"_q{i}") for i in range(len(qs))])
    found = parts.select(*by, F.array(*[F.col(f"_q{i}") for i in range(len(qs))]).alias("q"))
    if not by:
        return found
    empty = df.select(*by).distinct()
    return _left(empty, found, by).select(*by, F.coalesce("q", F.array(*[F.lit(None).cast("double")] * len(qs))).alias("q"))


def _left(left: DataFrame, right: DataFrame, keys) -> DataFrame:
    """Null-safe left join on ``keys``; the left side's key columns stay."""
    names = {k: f"_j{i}" for i, k in enumerate(keys)}
    right = right.select(*[F.col(k).alias(v) for k, v in names.items()], *[c for c in right.columns if c not in names])
    cond = F.lit(True)
    for k, v in names.items():
        cond = cond & left[k].eqNullSafe(right[v])
    return left.join(right, cond, "left").drop(*names.values())


def exact_quantile(df: DataFrame, col: str, q: float, rows_each: int = ROWS_EACH):
    """Exact linear-interpolation quantile of a column as a Python float (None for an empty column)."""
    return group_quantiles(df, [], col, [q], rows_each=rows_each).first()["q"][0]
