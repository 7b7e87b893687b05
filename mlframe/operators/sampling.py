"""Splits and samples (L1-L4, W12). All are deterministic functions of the
row key (md5 lanes), so a retried task or a re-run yields the same rows,
unlike ``randomSplit``/``sample`` whose output depends on partitioning."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mlframe.functions.hashing import hash_uniform
from mlframe.operators.ranking import _left, positions, unit_bucket, value_buckets


def top_k(df: DataFrame, order: list, k: int) -> DataFrame:
    """L1: global order + limit; Catalyst plans TakeOrderedAndProject
    (per-partition top-k, then one merge of k rows per partition)."""
    return df.orderBy(*order).limit(k)


def hash_split(df: DataFrame, keys, frac: float = 0.8, salt: str = "split",
               name: str = "split") -> DataFrame:
    """L2: reproducible train/test label from a hash of the key."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    u = hash_uniform(*keys, lane=salt)
    return df.withColumn(name, F.when(u < frac, "train").otherwise("test"))


def hash_sample(df: DataFrame, keys, frac: float, salt: str = "sample") -> DataFrame:
    """L4: keep a deterministic ``frac`` of rows (filter pushed into the scan stage)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.where(hash_uniform(*keys, lane=salt) < frac)


def stratified_split(df: DataFrame, keys, label: str, frac: float = 0.8, salt: str = "strat",
                     name: str = "split", buckets: int = 1024) -> DataFrame:
    """L3: exactly ``round(frac * n_label)`` rows of each label go to train.

    Rows are ranked by a hash draw inside their label. The rank comes from
    per-(label, hash-bucket) counts and running offsets, so a label holding
    most of the rows is still numbered by many tasks. A null label is a label.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    d = df.withColumn("_u", hash_uniform(*keys, lane=salt))
    ranked = positions(d, [F.col("_u"), *[F.col(k) for k in keys]], unit_bucket("_u", buckets),
                       partition=[label], name="_pos")
    n = d.groupBy(label).agg(F.count(F.lit(1)).alias("_nl"))
    return (_left(ranked, n, [label])
            .withColumn(name, F.when(F.col("_pos") <= F.round(F.col("_nl") * frac), "train").otherwise("test"))
            .drop("_u", "_pos", "_nl"))


def time_split(df: DataFrame, ts: str, keys, frac: float = 0.8, name: str = "split") -> DataFrame:
    """The oldest ``round(frac * n)`` rows (ties broken by key) train,
    the rest validate; rows without a time count as oldest. Positions come
    from counts per time range of about equal rows, so no task sorts the whole
    table, however long its time span or however uneven its days are."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    n = df.agg(F.count(F.lit(1))).scalar()
    ranked = positions(df, [F.col(ts).asc_nulls_first(), *[F.col(k) for k in keys]], value_buckets(df, ts), name="_pos")
    return ranked.withColumn(name, F.when(F.col("_pos") <= F.round(n * frac), "train").otherwise("valid")).drop("_pos")


def holdout(df: DataFrame, keys, ts: str, n: int, name: str = "split") -> DataFrame:
    """Last ``n`` periods of each series are the holdout."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    w = Window.partitionBy(*keys).orderBy(F.col(ts).desc())
    return df.withColumn(name, F.when(F.row_number().over(w) <= n, "holdout").otherwise("train"))
