"""Random search (M17) and fitted smoothing."""

import datetime as dt
import json

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from mlframe.operators import forecast as FC
from mlframe.operators import ml as ML

SPACE = {"maxDepth": ML.randint(1, 4), "stepSize": ML.loguniform(1e-2, 1.0), "subsamplingRate": ML.uniform(0.5, 1.0), "minInstancesPerNode": ML.choice([1, 5])}


def test_draws_follow_their_distributions():
    drawn = ML.draw_trials(SPACE, 400, 3)
    assert drawn == ML.draw_trials(SPACE, 500, 3)[:400] and drawn != ML.draw_trials(SPACE, 400, 4)
    assert {p["maxDepth"] for p in drawn} == {1, 2, 3} and {p["minInstancesPerNode"] for p in drawn} == {1, 5}
    logs = np.log10([p["stepSize"] for p in drawn])
    assert -2 <= logs.min() and logs.max() <= 0 and abs(logs.mean() + 1) < 0.1 and abs(np.mean([p["subsamplingRate"] for p in drawn]) - 0.75) < 0.03


def test_halving_is_repeatable_and_not_worse_than_a_grid(spark):
    df = spark.range(600).select(array_to_vector(F.array((F.col("id") % 17).cast("double"), (F.col("id") * 7 % 23).cast("double"))).alias("features"),
                                 ((F.col("id") % 17 > 8) & (F.col("id") * 7 % 23 > 11)).cast("double").alias("label"), (F.col("id") % 5).alias("fold"))
    tr, va = df.where("fold > 0").drop("fold"), df.where("fold = 0").drop("fold")
    rows = [tuple(r) for r in ML.random_search(tr, va, "label", SPACE, 4, seed=1, budgets=(2, 4)).orderBy("rung", "trial").collect()]
    assert rows == [tuple(r) for r in ML.random_search(tr, va, "label", SPACE, 4, seed=1, budgets=(2, 4), parallelism=1).orderBy("rung", "trial").collect()]
    assert [r[0] for r in rows] == [0] * 4 + [1] * 2 and sum(r[5] for r in rows) == 3
    assert {r[2] for r in rows if r[0] == 1} == {r[2] for r in rows if r[0] == 0 and r[5]}
    grid = max(r["area_under_pr"] for r in ML.search(df.drop("fold"), "label", {"maxDepth": [1, 2], "stepSize": [0.1], "maxIter": [4]}).collect())
    assert max(r[4] for r in rows) >= grid - 1e-9 and json.loads(rows[0][3]).keys() == SPACE.keys()


def series(seed, n=72):
    rng = np.random.Generator(np.random.PCG64(seed))
    t = np.arange(n)
    kinds = [50 + 0.8 * t + 10 * np.sin(t * np.pi / 6) + rng.normal(0, 3, n), np.cumsum(rng.normal(0, 5, n)) + 100, rng.poisson(2, n).astype(float),
             np.full(n, 7.0), np.where(t < 40, 10.0, 90.0) + rng.normal(0, 1, n)]
    return kinds[seed % 5]


@pytest.mark.parametrize("seed", range(15))
def test_fit_is_at_most_a_fine_grid(seed):
    y = series(seed)
    own = FC.fit_smoothing(y, 12)
    grid = np.stack(np.meshgrid(*[np.linspace(0, 1, 26)] * 3, indexing="ij")).reshape(3, -1)
    assert ((0 <= own) & (own <= 1)).all()
    assert FC.smoothing_errors(y, 12, own[:, None])[0][0] <= FC.smoothing_errors(y, 12, grid)[0].min() * (1 + 1e-9) + 1e-12


def test_forecast_steps_in_the_grain(spark):
    rows = [("a", dt.date(2024, 1, 1) + dt.timedelta(weeks=i), float(i % 4)) for i in range(12)]
    df = spark.createDataFrame(rows, "k string, ds date, y double")
    got = [r["forecast_month"] for r in FC.group_forecast(df, ["k"], horizon=2, season=4, grain="WEEK").orderBy("forecast_month").collect()]
    assert got == [rows[-1][1] + dt.timedelta(weeks=1), rows[-1][1] + dt.timedelta(weeks=2)]
