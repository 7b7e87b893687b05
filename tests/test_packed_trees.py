"""Boosted regression on packed rows against Spark's on the rows."""

import pytest
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from mlframe.operators import ml as ML
from mlframe.operators import packed_trees as P


@pytest.fixture(scope="module")
def table(spark):
    u = lambda lane, n: F.pmod(F.xxhash64("id", F.lit(lane)), F.lit(n)).cast("double")
    df = spark.range(5000, numPartitions=3).select("id", u(1, 997).alias("a"), (u(2, 8001) / 7 - 300).alias("b"), u(3, 2).alias("flag"), u(4, 12).alias("month"), F.lit(1.0).alias("same"), u(5, 100).alias("noise"))
    df = df.withColumn("y", F.col("a") / 100 + F.when(F.col("flag") == 1, F.col("b") / 90).otherwise(0) + F.col("month") * F.col("month") / 30 + F.col("noise") / 60)
    a = ML.assemble(df, ["a", "b", "flag", "month", "same"]).select("id", "features", "y").persist()
    yield a.where("id % 5 != 0"), a.where("id % 5 = 0")
    a.unpersist()


@pytest.mark.parametrize("iters, depth, block", [(1, 3, 100_000), (6, 5, 100_000), (3, 4, 300)])
def test_errors_are_those_of_the_rows_and_no_tree_reads_them(table, monkeypatch, iters, depth, block):
    train, test = table
    want = ML.fit_rating(train, test, "y", iters, depth).first()
    monkeypatch.setattr(ML, "CELLS_FROM", 0)
    monkeypatch.setattr(P, "BLOCK_ROWS", block)
    monkeypatch.setattr(GBTRegressor, "fit", lambda *a: pytest.fail("a fit on rows"))
    got = ML.fit_rating(train, test, "y", iters, depth).first()
    assert (got["rmse"], got["mae"]) == pytest.approx((want["rmse"], want["mae"]), rel=1e-9)


def test_labels_that_lack(table, monkeypatch):
    monkeypatch.setattr(ML, "CELLS_FROM", 0)
    train, test = table
    some = test.withColumn("y", F.when(F.col("id") % 2 == 0, F.col("y")))
    assert ML.fit_rating(train, some, "y", 1, 2).first() == ML.fit_rating(train, test.where("id % 2 = 0"), "y", 1, 2).first()
    with pytest.raises(ValueError):
        ML.fit_rating(some, test, "y", 1, 2)
    assert tuple(ML.fit_rating(train, test.limit(0), "y", 1, 2).first()) == (None, None)


def test_equal_labels_are_one_leaf(table, monkeypatch):
    monkeypatch.setattr(ML, "CELLS_FROM", 0)
    train, test = (d.withColumn("y", F.lit(2.5)) for d in table)
    assert tuple(ML.fit_rating(train, test, "y", 3, 4).first()) == (0.0, 0.0)
