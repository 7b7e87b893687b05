"""Boosted classifiers on counted cells against Spark's boosting on the rows."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from mlframe.operators import boosting as B
from mlframe.operators import metrics as MT
from mlframe.operators import ml as ML


@pytest.fixture(scope="module")
def parts(spark):
    """6,000 rows in three partitions, on at most 7,000 points of a grid; (training, held out)."""
    u = lambda lane, n: F.pmod(F.xxhash64("id", F.lit(lane)), F.lit(n)).cast("double")
    df = spark.range(6000, numPartitions=3).select("id", u(1, 1000).alias("a"), u(2, 7).alias("b"), u(3, 1000).alias("noise"))
    df = df.withColumn("label", (F.col("a") * (1 + F.col("b")) / 4 + F.col("noise") > 1200).cast("int"))
    a = ML.assemble(df.withColumn("weight", F.when(F.col("label") == 1, 3.7).otherwise(1.0)), ["a", "b"]).select("id", "features", "label", "weight").persist()
    yield a.where("id % 5 != 0"), a.where("id % 5 = 0")
    a.unpersist()


@pytest.mark.parametrize("params, weight", [({"maxIter": 3, "maxDepth": 3, "subsamplingRate": 0.7}, "weight"), ({"maxIter": 3, "maxDepth": 4, "stepSize": 0.3}, "weight"),
                                            ({"maxIter": 2, "maxDepth": 3, "subsamplingRate": 0.5, "stepSize": 0.2}, None)])
def test_scores_are_those_of_the_rows(parts, params, weight):
    """Same trees from cells as from rows; a row sample draws the very rows that Spark's boosting draws."""
    train, test = parts
    gbt = GBTClassifier(labelCol="label", featuresCol="features", seed=42, **params)
    model = (gbt.setWeightCol(weight) if weight else gbt).fit(train)
    want = ML.probability(model.transform(test)).groupBy("label", F.round("score", 9).alias("s")).agg(F.count(F.lit(1)).alias("n"))
    got = [s.groupBy("label", F.round("score", 9).alias("s")).agg(F.sum("n").alias("n")).collect() for _, s in B.score_configs(train, test, "label", {"x": params}, train.count(), weight)]
    assert len(got) == 1 and sorted(map(tuple, got[0])) == sorted(map(tuple, want.collect())) and len(got[0]) > 10


def test_no_tree_of_a_large_table_reads_the_rows(parts, monkeypatch):
    train, test = parts
    seen = []
    monkeypatch.setattr(ML, "CELLS_FROM", train.count() - 1)
    for cls in (GBTClassifier, DecisionTreeRegressor):
        monkeypatch.setattr(cls, "fit", lambda self, df, *a, fit=cls.fit: (seen.append(df.count()), fit(self, df, *a))[1])
    r = ML.fit_compare(train, test, "label", {"all": {"maxIter": 2, "maxDepth": 2}, "drawn": {"maxIter": 2, "maxDepth": 2, "subsamplingRate": 0.8}})
    assert r.count() == 2 and len(seen) == 3 and max(seen) <= B.BINS * 7 * 2 < train.count() / 10


def test_every_row_is_counted_and_drawn_by_itself(parts):
    train, _ = parts
    cells = B.count_cells(train, "label", B.split_points(train, train.count()), "weight", {"d": (7, 0.25)})
    n, w, d = cells.agg(F.sum("n"), F.sum("w"), F.sum("d")).first()
    assert n == train.count() and w == pytest.approx(train.agg(F.sum("weight")).first()[0])
    assert 0.2 * w < d < 0.3 * w
    assert cells.where("d > 0 and d < w").count() > cells.count() / 2  # no cell comes or goes as a whole


def test_limits_of_rows_in_a_leaf_are_fitted_on_the_rows(parts, monkeypatch):
    train, test = parts
    monkeypatch.setattr(ML, "CELLS_FROM", 0)
    p = {"maxIter": 2, "maxDepth": 3, "minInstancesPerNode": 40}
    r = {x["config"]: x for x in ML.fit_compare(train, test, "label", {"cells": {"maxIter": 2, "maxDepth": 3}, "rows": p}).collect()}
    scored = ML.probability(GBTClassifier(labelCol="label", featuresCol="features", seed=42, **p).fit(train).transform(test))
    assert r["rows"]["roc_auc"] == MT.ranking_metrics(scored, "label", "score").first()["roc_auc"]
    assert sorted(x["rank"] for x in r.values()) == [1, 2]


def test_split_points(spark):
    few = B._points(np.array([3.0, 1.0, 2.0]), np.array([1.0, 1e6, 1.0]))
    assert few == [1.5, 2.5]  # rare values keep their points
    many = B._points(np.arange(320.0), np.ones(320))
    assert len(many) == B.BINS - 1 and np.allclose(np.diff(many), 10)
    same = ML.assemble(spark.createDataFrame([(1.0, i % 2) for i in range(20)], "x double, label int"), ["x"])
    assert B.split_points(same, 20) == [[]]
    assert {(r["label"], r["n"]) for r in B.count_cells(same, "label", [[]]).collect()} == {(0, 10), (1, 10)}
    edge = ML.assemble(spark.createDataFrame([(v, 0) for v in (float("-inf"), 1.0, 2.0, float("inf"))], "x double, label int"), ["x"])
    assert sorted(r["n"] for r in B.count_cells(edge, "label", [[1.0, float("inf")]]).collect()) == [2, 2]  # a point belongs to its left side


def test_counted_rows_rank_as_the_rows_do(spark):
    df = spark.createDataFrame([(i % 2, float(i % 5), 1 + i % 4) for i in range(40)], "y int, s double, n int")
    each = df.select("y", "s", F.explode(F.sequence(F.lit(1), "n")))
    assert MT.ranking_metrics(df, "y", "s", rows="n").first() == MT.ranking_metrics(each, "y", "s").first()
