"""Trees grown on counted cells against Spark's on the rows (forests, searches)."""

import json

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from mlframe.operators import boosting as B
from mlframe.operators import cell_trees as C
from mlframe.operators import ml as ML


@pytest.fixture(scope="module")
def table(spark):
    """6,000 rows with two categories, three numbers and a label that follows them in part."""
    u = lambda lane, n: F.pmod(F.xxhash64("id", F.lit(lane)), F.lit(n)).cast("double")
    df = spark.range(6000, numPartitions=3).select("id", u(1, 40).alias("a"), u(2, 7).alias("b"), u(3, 1000).alias("noise"),
                                                   F.concat(F.lit("s"), u(4, 3).cast("int")).alias("s"), F.concat(F.lit("t"), u(5, 4).cast("int")).alias("t"))
    df = df.withColumn("label", (F.col("a") * (1 + F.col("b")) * 6 + F.col("noise") + F.when(F.col("s") == "s1", 300).otherwise(0) > 1200).cast("int")).persist()
    yield df
    df.unpersist()


def _vectors(table, cols=("a", "b")):
    return ML.assemble(table, cols).select("id", "features", "label")


def _cells(v, part=None):
    points = B.split_points(v, v.count())
    return points, C.collect_cells(v, "label", points, part)


def test_every_row_is_in_its_cell(table):
    v = _vectors(table).withColumn("train", F.col("id") % 5 != 0)
    points, got = _cells(v, "train")
    assert set(got) == {True, False} and got[True].counts.sum() == v.where("train").count() and got[False].counts.sum() == v.where("not train").count()
    want = {(x, y): n for x, y, n in v.where("train").select(vector_to_array("features").alias("x"), "label").groupBy(
        F.transform("x", lambda e: e).alias("x"), "label").agg(F.count(F.lit(1)).alias("n")).select(F.col("x")[1], "label", "n").groupBy("x[1]", "label").agg(F.sum("n")).collect()}
    mine = {}
    for label, n in enumerate(got[True].counts):
        for b, k in zip(got[True].bins[1], n):
            mine[float(b), label] = mine.get((float(b), label), 0) + int(k)
    some = C.collect_cells(v.withColumn("train", F.when(F.col("id") % 2 == 0, F.col("train"))), "label", points, "train")
    assert sum(c.counts.sum() for c in some.values()) == v.where("id % 2 = 0").count()
    assert mine == want  # b's values are 0 to 6, so are its bins


@pytest.mark.parametrize("params", [{"maxIter": 4, "maxDepth": 6, "minInstancesPerNode": 3, "stepSize": 0.05}, {"maxIter": 3, "maxDepth": 3, "stepSize": 0.3},
                                    {"maxIter": 2, "maxDepth": 8, "minInstancesPerNode": 40}])
def test_boosted_scores_are_those_of_the_rows(table, params):
    """The least rows of a leaf are rows, not cells."""
    v = _vectors(table)
    points, cells = _cells(v)
    model = GBTClassifier(labelCol="label", featuresCol="features", seed=42, **params).fit(v)
    want = model.transform(v).groupBy(F.round(vector_to_array("rawPrediction")[1], 9).alias("s")).count().collect()
    got = {}
    for s, n in zip(np.round(C.boost(cells[True], cells[True], params), 9), cells[True].counts.sum(axis=0)):
        got[s + 0.0] = got.get(s + 0.0, 0) + int(n)
    assert got == {r["s"] + 0.0: r["count"] for r in want} and len(got) > 5


def test_a_row_sample_is_drawn_of_rows():
    c = C.Cells(np.zeros((1, 1), np.uint8), np.array([[4000], [4000]]), [1])
    means = [C.boost(c, c, {"maxIter": 1, "subsamplingRate": 0.5})[0]]
    assert 0 < abs(means[0]) < 0.1  # not the whole cell in or out: neither 0, nor an empty tree


def test_one_tree_is_that_of_the_rows(spark, table):
    v = _vectors(table)
    rf = RandomForestClassifier(labelCol="label", featuresCol="features", seed=42, numTrees=1, maxDepth=7, bootstrap=False, minInstancesPerNode=3)
    want = rf.fit(v)
    points, cells = _cells(v)
    got = C.fit_forest(spark, rf, cells[True], points)
    trees = [m.toDebugString.split("\n", 1)[1] for m in (got, want)]
    assert trees[0] == trees[1] and trees[0].count("Predict") > 5
    assert np.allclose(got.featureImportances.toArray(), want.featureImportances.toArray(), atol=1e-9)
    prob = lambda m: [r[0] for r in m.transform(v).orderBy("id").select(vector_to_array("probability")[1]).collect()]
    assert np.allclose(prob(got), prob(want), atol=1e-12)


def test_a_forest_of_a_large_table_is_grown_on_cells_and_like_that_of_its_rows(table, monkeypatch):
    train, test = table.where("id % 5 != 0"), table.where("id % 5 = 0")
    pipe = ML.propensity_pipeline(["s", "t"], ["a", "b"], "label", trees=60, depth=6)
    rows, points = ML.fit_propensity(pipe, train, train.count())
    assert points is None
    monkeypatch.setattr(ML, "CELLS_FROM", 0)
    seen, fit = [], RandomForestClassifier.fit
    monkeypatch.setattr(RandomForestClassifier, "fit", lambda self, df, *a: (seen.append(df.count()), fit(self, df, *a))[1])
    model, points = ML.fit_propensity(pipe, train, train.count())
    assert seen == [2]  # one row per class, for the frame
    assert model.stages[-1].getNumTrees == 60 and max(t.depth for t in model.stages[-1].trees) == 6
    a, b = (m.stages[-1].featureImportances.toArray() for m in (model, rows))
    assert np.abs(a - b).max() < 0.03 and ML.feature_names(model, test) == ML.feature_names(rows, test)
    by_cells, by_rows = ML.held_out_auc(model, test, "label", points), BinaryClassificationEvaluator(labelCol="label").evaluate(model.transform(test))
    assert by_cells == pytest.approx(by_rows, abs=2e-3) and abs(by_rows - ML.held_out_auc(rows, test, "label")) < 0.02 and by_rows > 0.8


def test_too_many_cells_and_other_parameters_go_by_rows(table, monkeypatch):
    monkeypatch.setattr(ML, "CELLS_FROM", 0)
    monkeypatch.setattr(C, "CELLS_MOST", 3)
    pipe = ML.propensity_pipeline(["s"], ["a"], "label", trees=2, depth=2)
    assert ML.fit_propensity(pipe, table, 6000)[1] is None
    monkeypatch.setattr(C, "CELLS_MOST", 10 ** 6)
    assert ML.fit_propensity(pipe, table, 6000)[1] is not None
    odd = Pipeline(stages=[*pipe.getStages()[:-1], RandomForestClassifier(labelCol="label", numTrees=2, minInfoGain=0.01)])
    assert ML.fit_propensity(odd, table, 6000)[1] is None


def test_labels_that_are_no_classes_fail(spark):
    df = ML.assemble(spark.createDataFrame([(1.0, 0.5), (2.0, 1.0)], "x double, y double"), ["x"])
    with pytest.raises(ValueError):
        C.collect_cells(df, "y", [[1.5]])


SPACE = {"maxDepth": ML.randint(1, 5), "stepSize": ML.loguniform(1e-2, 1.0), "subsamplingRate": ML.uniform(0.8, 1.0), "minInstancesPerNode": ML.choice([1, 5])}


def test_searches_of_a_large_table_fit_no_trial_on_rows(table, monkeypatch):
    """Without a row sample metrics are those of the rows, with it they are near."""
    v = _vectors(table).withColumn("_part", F.col("id") % 5 != 0)
    tr, te = v.where("_part"), v.where("not _part")
    by_rows = ML.random_search(tr, te, "label", SPACE, 4, seed=3, budgets=(2, 4)).collect()
    no_sample = {k: v for k, v in SPACE.items() if k != "subsamplingRate"}
    exact = ML.random_search(tr, te, "label", no_sample, 4, seed=3, budgets=(2, 4)).collect()
    grid = {"maxDepth": [1, 3], "maxIter": [3]}
    grid_rows = {r["params"]: r["area_under_pr"] for r in ML.search(v, "label", grid).collect()}
    monkeypatch.setattr(ML, "CELLS_FROM", 0)
    monkeypatch.setattr(GBTClassifier, "fit", lambda *a: pytest.fail("a fit on rows"))
    for whole in (None, v):
        got = ML.random_search(tr, te, "label", SPACE, 4, seed=3, budgets=(2, 4), whole=whole).collect()
        assert [r[:4] for r in got if r["rung"] == 0] == [r[:4] for r in by_rows if r["rung"] == 0] and len(got) == 6
        assert sorted(r["area_under_pr"] for r in got) == pytest.approx(sorted(r["area_under_pr"] for r in by_rows), abs=0.03)
        assert [tuple(r) for r in got] == [tuple(r) for r in ML.random_search(tr, te, "label", SPACE, 4, seed=3, budgets=(2, 4)).collect()]
    got = ML.random_search(tr, te, "label", no_sample, 4, seed=3, budgets=(2, 4)).collect()
    assert [(r["rung"], r["trial"], r["stays"]) for r in got] == [(r["rung"], r["trial"], r["stays"]) for r in exact]
    assert [r["area_under_pr"] for r in got] == pytest.approx([r["area_under_pr"] for r in exact], abs=1e-6)
    found = {r["params"]: r["area_under_pr"] for r in ML.search(v, "label", grid, rows=7000).collect()}
    assert found == pytest.approx(grid_rows, abs=1e-6) and all(json.loads(k)["maxIter"] == 3 for k in found)
