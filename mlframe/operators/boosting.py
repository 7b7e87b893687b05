"""Boosted classifiers on counted cells.

Spark's trees see a feature only through its split points (at most ``BINS`` - 1), so all rows between the same points that
share a label have the same gradient in every round. They are counted once into cells, with their weights summed up, and the
rounds read cells: as many as the bins and labels allow, however many rows there are, and never more than rows."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 32  # bins of a feature: maxBins of Spark's trees
POINT_ROWS = 10_000  # rows that Spark's trees take split points from (of smaller tables all); no other step reads a sample
CELL_PARAMS = {"maxDepth", "maxIter", "stepSize", "subsamplingRate"}  # parameters that mean the same on cells as on rows
SEED = 42


def split_points(df: DataFrame, rows: int, weight=None) -> list[list[float]]:
    """Each feature's split points by the rule of Spark's trees: between all neighbouring values if they are few, else
    where the weights up to a point come nearest to the next multiple of a bin's share."""
    drawn = df.sample(POINT_ROWS / rows, SEED) if rows > POINT_ROWS else df
    values = drawn.select(F.lit(1.0 if weight is None else F.col(weight)).alias("w"), F.posexplode(vector_to_array("features")).alias("feature", "value"))
    found = values.groupBy("feature", "value").agg(F.sum("w").alias("w")).groupBy("feature").applyInPandas(
        lambda g: pd.DataFrame({"feature": g["feature"][:1], "points": [_points(g["value"].to_numpy(), g["w"].to_numpy())]}),
        "feature int, points array<double>")
    return [points for _, points in sorted(map(tuple, found.collect()))]


def _points(values: np.ndarray, weights: np.ndarray) -> list[float]:
    order = np.argsort(values)
    v, upto = values[order], np.cumsum(weights[order])
    mid = (v[:-1] + v[1:]) / 2
    if len(mid) < BINS:
        return mid.tolist()
    share = upto[-1] / BINS
    points, target = [], share
    for i in range(len(mid)):
        if abs(upto[i] - target) < abs(upto[i + 1] - target):
            points.append(float(mid[i]))
            target += share
    return points


def count_cells(df: DataFrame, label: str, points, weight=None, draws=None, by=()) -> DataFrame:
    """Cells of the features between ``points`` and the label: the vector ``cell`` of bin numbers, ``n`` rows and the sum ``w``
    of their weights. ``draws`` (name -> (seed, rate)) are row samples: every row is drawn or not in each of them, and a
    column holds the weights of the drawn ones. Rows that differ in the columns ``by`` are counted apart."""
    draws, keys = draws or {}, [label, *by]
    split = [i for i, p in enumerate(points) if p]
    bins = [f"_bin{i}" for i in split]
    w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    rows = df.select(*keys, w.alias("w"), vector_to_array("features").alias("_x"), *[F.when(F.rand(seed) < rate, w).otherwise(0.0).alias(d) for d, (seed, rate) in draws.items()])
    rows = rows.select(*keys, "w", *draws, *[F.col("_x")[i].alias(f"_x{i}") for i in split])
    if split:  # a tree's left side is closed, a bucket's open: the next number after a point is the bucket's border
        borders = [np.nextafter(points[i], np.inf) for i in split]
        rows = Bucketizer(splitsArray=[[-math.inf, *b[np.isfinite(b)].tolist(), math.inf] for b in borders],
                          inputCols=[f"_x{i}" for i in split], outputCols=bins).transform(rows)
    else:
        rows, bins = rows.withColumn("_bin", F.lit(0)), ["_bin"]
    cells = rows.groupBy(*keys, *[F.col(b).cast("int").alias(b) for b in bins]).agg(
        F.count(F.lit(1)).alias("n"), F.sum("w").alias("w"), *[F.sum(d).alias(d) for d in draws])
    return VectorAssembler(inputCols=bins, outputCol="cell").transform(cells).drop(*bins)


def score_configs(train: DataFrame, test: DataFrame, label: str, configs: dict, rows: int, weight=None):
    """Fits one boosted classifier per configuration on the cells of ``train``, a table of ``rows`` rows; yields its name and the cells of
    ``test`` with ``score``. All of them share ``weight``."""
    draws = {f"_d{i}_{m}": (name, m) for i, (name, p) in enumerate(configs.items()) if p.get("subsamplingRate", 1.0) < 1.0
             for m in range(p.get("maxIter", 20))}
    points = split_points(train, rows, weight)
    # seeds are those of Spark's boosting: on the same partitions the trees get the very rows that it would draw
    cells = count_cells(train, label, points, weight, {d: (SEED + 1 + m, configs[name]["subsamplingRate"]) for d, (name, m) in draws.items()})
    held = count_cells(test, label, points)
    cores = train.sparkSession.sparkContext.defaultParallelism  # the rounds are many short jobs: no more tasks than cores
    cells, held = cells.coalesce(cores).persist(), held.coalesce(cores).persist()
    try:
        # so many bins that all cells are looked at for split points, which are then those between neighbouring bin numbers
        tree = {"featuresCol": "cell", "seed": SEED, "maxBins": min(max(BINS, math.isqrt(cells.count()) + 1), 46_000)}
        for name, p in configs.items():
            mine = [d for d, (whose, _) in draws.items() if whose == name]
            if mine:
                yield name, _boost(cells, held, label, mine, p, tree)
            else:
                scored = GBTClassifier(labelCol=label, weightCol="w", **tree, **p).fit(cells).transform(held)
                yield name, scored.withColumn("score", vector_to_array("probability")[1])
    finally:
        cells.unpersist()
        held.unpersist()


def _boost(cells: DataFrame, held: DataFrame, label: str, draws, params: dict, tree: dict) -> DataFrame:
    """``GBTClassifier`` where a tree's row sample is given: it would draw whole cells. A tree per draw, fitted to the
    gradients of the log loss; the first counts in full, the others by ``stepSize``."""
    y, f = F.when(F.col(label) == 1, 1.0).when(F.col(label) == 0, -1.0), F.col("f")
    now, held = cells.withColumn("f", F.lit(0.0)), held.withColumn("f", F.lit(0.0))
    last = None
    for m, d in enumerate(draws):
        gradient = 4.0 * y / (1.0 + F.exp(2.0 * y * f)) if m else y
        model = DecisionTreeRegressor(labelCol="gradient", weightCol=d, maxDepth=params.get("maxDepth", 5), **tree).fit(now.withColumn("gradient", gradient))
        step = params.get("stepSize", 0.1) if m else 1.0
        now, held = (model.transform(c).withColumn("f", f + step * F.col("prediction")).drop("prediction") for c in (now, held))
        now = now.persist()
        now.count()
        if last is not None:
            last.unpersist()
        last = now
    last.unpersist()
    return held.withColumn("score", 1.0 / (1.0 + F.exp(-2.0 * f)))
