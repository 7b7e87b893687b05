"""Distributed isolation forest.

Fit: each tree gets its own deterministic sub-sample (rows whose hash for
that tree falls under a small rate, then the ``sample_size`` smallest
hashes), so a row is copied only to the few trees that sample it. Trees are
grown in parallel with ``applyInPandas`` (one group = one tree, bounded by
``sample_size`` rows). The fitted forest is small and bounded
(trees x 2*sample_size nodes), so it is the model that gets broadcast;
scoring is ``mapInPandas`` over Arrow batches.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TREE_SCHEMA = T.StructType([
    T.StructField("tree", T.IntegerType()),
    T.StructField("feature", T.ArrayType(T.IntegerType())),
    T.StructField("split", T.ArrayType(T.DoubleType())),
    T.StructField("left", T.ArrayType(T.IntegerType())),
    T.StructField("right", T.ArrayType(T.IntegerType())),
    T.StructField("size", T.ArrayType(T.IntegerType())),
])


def _c(n: float) -> float:
    """Average path length of an unsuccessful BST search over n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n


def _grow(x: np.ndarray, rng: np.random.Generator, max_depth: int):
    feat, split, left, right, size = [], [], [], [], []

    def node(idx, depth):
        i = len(feat)
        feat.append(-1), split.append(0.0), left.append(-1), right.append(-1), size.append(len(idx))
        if depth >= max_depth or len(idx) <= 1:
            return i
        sub = x[idx]
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        ok = np.flatnonzero(hi > lo)
        if ok.size == 0:
            return i
        f = int(rng.choice(ok))
        s = float(rng.uniform(lo[f], hi[f]))
        feat[i], split[i] = f, s
        m = sub[:, f] < s
        left[i] = node(idx[m], depth + 1)
        right[i] = node(idx[~m], depth + 1)
        return i

    node(np.arange(len(x)), 0)
    return feat, split, left, right, size


def fit_iforest(df: DataFrame, cols, trees: int = 150, sample_size: int = 256, seed: int = 42, row_key=None) -> DataFrame:
    """Returns the forest as a DataFrame (one row per tree).

    Rows with a null feature do not train. Each tree draws rows by a hash of
    ``row_key`` (the columns that identify a row; by default all columns), so
    equal feature values do not enter a tree together. One draw per row and
    tree decides, and its value orders the tree's sample."""
    own = df.dropna(subset=list(cols))
    n = own.count()
    rate = min(1.0, 1.5 * sample_size / max(n, 1))
    max_depth = int(math.ceil(math.log2(max(sample_size, 2))))
    feats = F.array(*[F.col(c).cast("double") for c in cols])
    row_key = [row_key] if isinstance(row_key, str) else list(row_key or df.columns)
    key = F.xxhash64(*[F.col(c) for c in row_key])
    draw = lambda t: F.pmod(F.xxhash64(key, t, F.lit("iforest")), F.lit(1 << 52)) / float(1 << 52)
    picks = F.filter(F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.struct(t.alias("tree"), draw(t).alias("u"))),
                     lambda s: s["u"] < rate)
    cand = own.select(feats.alias("x"), key.alias("_k"), F.explode(picks).alias("p")).select("x", "_k", "p.tree", F.col("p.u").alias("_u"))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_u", "_k"]).head(sample_size)
        t = int(pdf["tree"].iloc[0])
        x = np.vstack(pdf["x"].to_numpy()).astype(float)
        f, s, l, r, z = _grow(x, np.random.default_rng(seed + t), max_depth)
        return pd.DataFrame({"tree": [t], "feature": [f], "split": [s], "left": [l], "right": [r], "size": [z]})

    return cand.groupBy("tree").applyInPandas(grow, TREE_SCHEMA).withColumn("sample_size", F.lit(sample_size))


def _walkable(feature, split, left, right, size):
    """A tree for rows that walk it together: per node its feature, split, two children (a leaf's are itself) and path
    length (depth, and at a leaf the average length below it, which needs no look at the rows), and the tree's depth."""
    feature, size, n = np.array(feature), np.array(size), len(feature)
    leaf = feature < 0
    child = np.stack([np.where(leaf, np.arange(n), left), np.where(leaf, np.arange(n), right)], axis=1)
    depth = np.zeros(n)
    for i in np.flatnonzero(~leaf):  # a node is numbered before its children
        depth[child[i]] = depth[i] + 1
    length = depth + np.array([_c(z) for z in size])
    return np.where(leaf, 0, feature), np.array(split, dtype=float), child.ravel(), length, int(depth.max())


def _path_lengths(x: np.ndarray, tree) -> np.ndarray:
    feature, split, child, length, depth = tree
    at, flat, start = np.zeros(len(x), dtype=np.int64), x.ravel(), np.arange(len(x)) * x.shape[1]
    for _ in range(depth):
        at = child[2 * at + ~(flat[start + feature[at]] < split[at])]
    return length[at]


def score_iforest(df: DataFrame, cols, forest: DataFrame, name: str = "anomaly_score") -> DataFrame:
    """Anomaly score 2^(-E[h(x)]/c(psi)) per row (higher = more anomalous); null for a row with a null feature."""
    rows = forest.orderBy("tree").collect()  # the fitted model: bounded by trees x nodes
    psi = rows[0]["sample_size"] if rows else 256
    bc = df.sparkSession.sparkContext.broadcast([_walkable(r["feature"], r["split"], r["left"], r["right"], r["size"]) for r in rows])
    cpsi = _c(psi)
    out_schema = T.StructType(df.schema.fields + [T.StructField(name, T.DoubleType())])

    def run(it):
        forest_m = bc.value
        for pdf in it:
            x = pdf[cols].to_numpy(dtype=float)
            if len(x) and forest_m:
                h = sum(_path_lengths(x, t) for t in forest_m) / len(forest_m)
                pdf[name] = np.where(np.isnan(x).any(axis=1), np.nan, np.power(2.0, -h / cpsi) if cpsi > 0 else 0.0)
            else:
                pdf[name] = 0.0
            yield pdf

    return df.mapInPandas(run, out_schema).withColumn(name, F.nanvl(F.col(name), F.lit(None).cast("double")))


def flag_top(df: DataFrame, score: str = "anomaly_score", contamination: float = 0.02,
             name: str = "is_anomaly") -> DataFrame:
    """Anomaly = score at or above the exact (1 - contamination) quantile.
    The scored frame is checkpointed once (scoring is the costly part) and
    the quantile comes from bucketed order statistics, not a global sort."""
    from mlframe.operators.ranking import exact_quantile
    from mlframe.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    df = df.checkpoint(eager=True)
    thr = exact_quantile(df, score, 1 - contamination)
    return df.withColumn(name, (F.col(score) >= F.lit(thr)).cast("int"))
