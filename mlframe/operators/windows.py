"""Window operators.

Row-frame windows partition by the series key. A key holding a large share
of all rows would land in one task, so :func:`halo_blocks` can cut every
series into fixed-size blocks of consecutive rows, each carrying the few
preceding rows its frame needs (a halo); results are exact and the work per
task is bounded by the block size, whatever the key skew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mlframe.operators.ranking import positions


def halo_blocks(df: DataFrame, key, order: list, halo: int, block_rows: int, bucket: Column) -> DataFrame:
    """Number rows within ``key`` (by ``order``), cut into blocks of
    ``block_rows`` and copy every row into the following blocks whose frame
    reaches back to it (the ``halo`` rows before each block's first row);
    ``_halo`` = 1 on the copies. Window over (key, ``_blk``) and drop the
    halo rows afterwards."""
    key = [key] if isinstance(key, str) else list(key)
    d = positions(df, order, bucket, partition=key, name="_pos")
    p0 = F.col("_pos") - 1
    blk = F.floor(p0 / block_rows)
    reach = -(-halo // block_rows)  # how many later blocks one row can serve
    ks = F.filter(F.sequence(F.lit(0), F.lit(reach)),
                  lambda k: (k == 0) | (p0 >= (blk + k) * block_rows - halo))
    return (d.withColumn("_c", F.explode(ks))
            .withColumn("_blk", (blk + F.col("_c")).cast("long"))
            .withColumn("_halo", (F.col("_c") > 0).cast("int")).drop("_c"))


def rolling_z(df: DataFrame, key: str, ts: str, col: str, n: int = 12,
              block_rows: int | None = None) -> DataFrame:
    """Mean and sample stddev of the ``n`` preceding rows (current row
    excluded) per ``key``; z = 0 when the stddev is null or 0. Nothing is
    rounded here. Rows with a null key are a series like any other.

    ``block_rows`` enables the skew-safe block + halo plan. The frame's
    moments are central (``avg``, ``stddev_samp``), so an offset of the values
    costs no precision; equal values have a stddev of exactly 0."""
    part = [key]
    base = df
    if block_rows:
        base = halo_blocks(df, key, [F.col(ts)], n, block_rows, F.date_trunc("hour", ts))
        part = [key, "_blk"]
    w = Window.partitionBy(*part).orderBy(ts).rowsBetween(-n, -1)
    x = F.col(col)
    flat = F.min(x).over(w) == F.max(x).over(w)
    out = base.select("*", F.avg(x).over(w).alias("roll_mean"),
                      F.when(flat & (F.count(x).over(w) > 1), F.lit(0.0)).otherwise(F.stddev_samp(x).over(w)).alias("roll_std"))
    z = F.when(F.col("roll_std").isNull() | (F.col("roll_std") == 0), F.lit(0.0)).otherwise((x - F.col("roll_mean")) / F.col("roll_std"))
    out = out.withColumn("z", z)
    if block_rows:
        out = out.where("_halo = 0").drop("_halo", "_blk", "_pos")
    return out


def detect(df: DataFrame, low_side: bool = False, z_limit: float = 3.0, skip_bad: bool = False) -> DataFrame:
    """Keep rows over the critical threshold or with |z| > limit (the
    unrounded z; only the reported one has 2 decimals); the reason is ``crit_threshold`` first, then ``zscore>3``; with
    ``low_side`` also rows under the normal band (``below_band``). A null
    threshold never breaches."""
    d = df.where(F.col("quality_code") != "Bad") if skip_bad else df
    z = F.col("z")
    crit = F.coalesce(F.col("value") > F.col("crit_threshold"), F.lit(False))
    zs = F.abs(z) > z_limit
    low = F.coalesce(F.col("value") < F.col("normal_low"), F.lit(False))
    reason = F.when(crit, "crit_threshold").when(zs, "zscore>3")
    cond = crit | zs
    if low_side:
        reason = reason.when(low, "below_band")
        cond = cond | low
    return d.where(cond).select("*", F.round(z, 2).alias("zscore"), reason.alias("detect_reason"))


def lag_features(df: DataFrame, keys, ts: str, y: str, lags=(1, 2, 3, 12), drop_incomplete: bool = True) -> DataFrame:
    """Lags of ``y`` per series plus the month; rows without every lag
    dropped. Lags count rows: fill the gaps of the series first (:func:`densify`)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    w = Window.partitionBy(*keys).orderBy(ts)
    out = df.select("*", *[F.lag(y, k).over(w).alias(f"lag_{k}") for k in lags], F.month(ts).alias("month"))
    return out.na.drop(subset=[f"lag_{k}" for k in lags]) if drop_incomplete else out


def lagged_rolling(df: DataFrame, keys, ts: str, y: str, lags=(1, 2, 3, 7, 14, 30, 360)) -> DataFrame:
    """Shifted lags, expanding mean of lag 7 and rolling means (7 rows at
    lag 14, 14 rows at lag 30), all from one window specification."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    w = Window.partitionBy(*keys).orderBy(ts)
    exp7 = Window.partitionBy(*keys).orderBy(ts).rowsBetween(Window.unboundedPreceding, -7)
    r14 = Window.partitionBy(*keys).orderBy(ts).rowsBetween(-20, -14)
    r30 = Window.partitionBy(*keys).orderBy(ts).rowsBetween(-43, -30)
    return df.select("*", *[F.lag(y, k).over(w).alias(f"lag{k}") for k in lags],
                     F.avg(y).over(exp7).alias("expanding_mean_lag7"),
                     F.avg(y).over(r14).alias("rolling_mean_lag14_window_size7"),
                     F.avg(y).over(r30).alias("rolling_mean_lag30_window_size14"))


def episodes(df: DataFrame, key: str, ts: str, flag: str, block_rows: int = 100_000) -> DataFrame:
    """Contiguous runs of flagged rows per key (gaps and islands):
    start, end, length and run number. Rows with a null key are a series of
    their own; a null flag is not flagged.

    A run starts where a flagged row's predecessor is not flagged. Rows are
    numbered once, in blocks of consecutive rows, so a key holding most of the
    rows is spread over many tasks; runs that go on across a block's border
    are joined in the (much smaller) run table."""
    f = F.coalesce(F.col(flag).cast("int"), F.lit(0))
    d = positions(df.select(key, ts, f.alias("_f")), [F.col(ts)], F.date_trunc("hour", ts), partition=[key])
    d = d.withColumn("_blk", F.floor((F.col("pos") - 1) / block_rows))
    w = Window.partitionBy(key, "_blk").orderBy("pos")
    hit = d.withColumn("_run", F.when(F.col("_f") == 1, F.col("pos") - F.sum("_f").over(w))).where("_f = 1")
    pieces = hit.groupBy(key, "_blk", "_run").agg(F.min(ts).alias("start_ts"), F.max(ts).alias("end_ts"), F.count(F.lit(1)).alias("n_rows"),
                                                  F.min("pos").alias("_a"), F.max("pos").alias("_z"))
    wk = Window.partitionBy(key).orderBy("_a")
    first = F.coalesce(F.lag("_z").over(wk) + 1 < F.col("_a"), F.lit(True)).cast("int")
    runs = (pieces.withColumn("_first", first).withColumn("episode_no", F.sum("_first").over(wk).cast("int"))
            .groupBy(key, "episode_no").agg(F.min("start_ts").alias("start_ts"), F.max("end_ts").alias("end_ts"), F.sum("n_rows").alias("n_rows")))
    return runs.select(key, "start_ts", "end_ts", "n_rows", "episode_no")


def top_n(df: DataFrame, by, order: list, n: int, name: str = "rank") -> DataFrame:
    """First ``n`` rows per group; Catalyst pushes the limit into a
    per-partition group-limit before the shuffle."""
    by = [by] if isinstance(by, str) else list(by)
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= n)


def time_idx(df: DataFrame, keys, ts: str, step: str = "month", name: str = "time_idx") -> DataFrame:
    """Integer steps since each series' first period."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    start = F.min(ts).over(Window.partitionBy(*keys))
    if step == "month":
        idx = F.months_between(F.trunc(ts, "month"), F.trunc(start, "month")).cast("int")
    elif step == "week":
        idx = (F.datediff(ts, start) / 7).cast("int")
    else:
        idx = F.datediff(ts, start)
    return df.withColumn(name, idx)


def densify(df: DataFrame, keys, ts: str, y: str, step: str = "1 MONTH") -> DataFrame:
    """Each series on a regular grid from its first to its last period,
    missing periods inserted with 0. ``step`` is a number of units (DAY, WEEK,
    MONTH, ...): times are truncated to the unit, the grid starts at the
    series' first period, and a period's values are summed (null: 0). A null
    key is a series of its own. One pass: every period generates the empty
    ones up to the next."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    each, unit = int(step.split()[0]), step.split()[1].rstrip("sS").upper()
    kind = df.schema[ts].dataType
    d = df.select(*keys, F.date_trunc(unit, ts).alias("_p"), F.col(y).alias("_y"))
    if each > 1:
        first = F.min("_p").over(Window.partitionBy(*keys))
        whole = F.floor(F.timestamp_diff(unit, first, F.col("_p")) / each) * each
        d = d.withColumn("_p", F.timestamp_add(unit, whole.cast("int"), first))
    d = d.where("_p IS NOT NULL").groupBy(*keys, "_p").agg(F.coalesce(F.sum("_y"), F.lit(0)).cast(df.schema[y].dataType).alias("_y"))
    after = F.lead("_p").over(Window.partitionBy(*keys).orderBy("_p"))
    gap = F.coalesce(F.floor(F.timestamp_diff(unit, F.col("_p"), after) / each).cast("int"), F.lit(1))
    steps = d.withColumn("_n", gap).select(*keys, "_p", "_y", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("_k"))
    return steps.select(*keys, F.timestamp_add(unit, F.col("_k") * each, F.col("_p")).cast(kind).alias(ts),
                        F.when(F.col("_k") == 0, F.col("_y")).otherwise(0).cast(df.schema[y].dataType).alias(y))


def sequence_windows(df: DataFrame, keys, ts: str, y: str, enc: int = 10, pred: int = 3,
                     min_enc: int = 5, min_pred: int = 2, cutoff=None) -> DataFrame:
    """Per row, the last ``enc`` values (current included) as the
    encoder input and the next ``pred`` values as the target.

    With ``cutoff`` (a time) rows get a split: ``train`` if the whole target
    lies at or before it, ``validation`` if the whole target lies after it;
    windows across the cutoff are left out, so no training target leaks."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    w_enc = Window.partitionBy(*keys).orderBy(ts).rowsBetween(-(enc - 1), 0)
    w_pred = Window.partitionBy(*keys).orderBy(ts).rowsBetween(1, pred)
    w_next = Window.partitionBy(*keys).orderBy(ts)
    out = df.select(*keys, ts, F.collect_list(y).over(w_enc).alias("encoder"), F.collect_list(y).over(w_pred).alias("target"),
                    F.lead(ts).over(w_next).alias("_lo"), F.max(ts).over(w_pred).alias("_hi"))
    out = out.where((F.size("encoder") >= min_enc) & (F.size("target") >= min_pred))
    if cutoff is None:
        return out.drop("_lo", "_hi")
    end = F.lit(cutoff).cast(dict(df.dtypes)[ts])
    split = F.when(F.col("_hi") <= end, "train").when(F.col("_lo") > end, "validation")
    return out.withColumn("split", split).drop("_lo", "_hi").where("split IS NOT NULL")
