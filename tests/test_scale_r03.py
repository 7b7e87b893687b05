"""Findings of round 3: fits on few partitions, searches on large tables, spools, repeated values, long batches."""

import threading
import time

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from mlframe.functions.text import lexicon_array
from mlframe.operators import iforest as IF
from mlframe.operators import ml as ML
from mlframe.operators import ranking
from mlframe.operators import text as TX
from mlframe.plans import fits
from mlframe.streaming import operators as SO
from tests.test_keyed_state import Handle, frame


def _sizes(df):
    return [r[0] for r in df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).select("n").collect()]


def test_a_fit_is_dealt_over_the_cores_and_a_small_table_stays(spark):
    few = spark.range(ML.SPREAD_FROM + 20_000, numPartitions=1)
    sizes = _sizes(ML.spread(few))
    assert len(sizes) == 4 and max(sizes) < 1.5 * sum(sizes) / 4 and sum(sizes) == few.count()
    small = spark.range(ML.SPREAD_FROM, numPartitions=1)
    assert ML.spread(small) is small and ML.spread(small.limit(0)).count() == 0


def test_a_forest_remembers_nodes_only_in_bounds():
    cached = lambda rows: ML.propensity_pipeline(["a"], ["b"], "y", trees=200, rows=rows).getStages()[-1].getCacheNodeIds()
    assert cached(700_000) and not cached(50_000_000) and not cached(None)


@pytest.mark.parametrize("limit, most", [(10, 1), (10 ** 6, 2)])
def test_trials_of_a_large_table_run_one_by_one_and_none_twice(spark, monkeypatch, limit, most):
    df = spark.range(200).select(array_to_vector(F.array((F.col("id") % 7).cast("double"))).alias("features"), (F.col("id") % 2).cast("double").alias("label"))
    running, seen, lock, fit = [0], [], threading.Lock(), ML.GBTClassifier.fit

    def counted(self, *a, **k):
        with lock:
            running[0] += 1
            seen.append(running[0])
        time.sleep(0.2)
        try:
            return fit(self, *a, **k)
        finally:
            with lock:
                running[0] -= 1
    monkeypatch.setattr(ML.GBTClassifier, "fit", counted)
    monkeypatch.setattr(ML, "SIDE_BY_SIDE_ROWS", limit)
    assert ML.search(df, "label", {"maxDepth": [1, 2], "maxIter": [1]}, parallelism=2).count() == 2
    assert len(seen) == 2 and max(seen) == most
    seen.clear()
    assert ML.random_search(df, df, "label", {"maxDepth": ML.randint(1, 3)}, 3, budgets=(1,), parallelism=2).count() == 3
    assert len(seen) == 3 and max(seen) == most


def test_the_lag_fit_reads_a_written_table(spark, sf_dir, monkeypatch):
    from pyspark.ml.regression import GBTRegressor
    plans, fit = [], GBTRegressor.fit
    monkeypatch.setattr(GBTRegressor, "fit", lambda self, df: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()), fit(self, df))[1])
    fits.lag_forecaster(spark, sf_dir)
    assert "Join" not in plans[0] and "Window" not in plans[0]


def test_both_rating_errors(spark):
    df = spark.createDataFrame([(float(i % 3), float(i % 3) + (i % 2)) for i in range(60)], "x double, y double")
    a = ML.assemble(df, ["x"]).select("features", "y")
    r = ML.fit_rating(a, a, "y", iters=1, depth=2).first()
    assert r["rmse"] == pytest.approx(0.5) and r["mae"] == pytest.approx(0.5)


def test_leaf_lengths_equal_the_walk():
    rng = np.random.default_rng(3)
    x = np.vstack([rng.normal(size=(300, 2)), [[np.nan, 0.0], [0.0, np.nan]]])
    f, s, left, right, z = IF._grow(x[:256], np.random.default_rng(1), 8)

    def walk(row, i=0, depth=0):
        return depth + IF._c(z[i]) if f[i] < 0 else walk(row, left[i] if row[f[i]] < s[i] else right[i], depth + 1)
    assert IF._path_lengths(x, IF._walkable(f, s, left, right, z)).tolist() == [walk(r) for r in x]


def test_the_spool_is_asked_per_block_not_per_row():
    rng = np.random.Generator(np.random.PCG64(2))
    rows = [(i, i * 61, float(rng.integers(0, 50))) for i in range(6000)]  # a minute apart and more
    shuffled = [rows[i] for i in rng.permutation(len(rows))]
    p = SO.RollingZ(12, 1000, 60_000_000)
    p.init(Handle())
    asked, update = [], p.spool.updateValue
    p.spool.updateValue = lambda k, v: (asked.append(k), update(k, v))
    got = [i for out in p.handleInputRows(("a",), (frame(shuffled[a:a + 1000]) for a in range(0, 6000, 1000)), None) for i in out["reading_id"]]
    assert got == list(range(6000)) and len(asked) <= 6 * (1000 // p.BLOCK + 1) and not p.spool


def test_quantiles_sort_values_not_rows(spark):
    df = spark.range(9000).select((F.col("id") % 2).alias("k"), (F.col("id") % 3).cast("double").alias("v"))
    q = ranking.group_quantiles(df, "k", "v", [0.0, 0.5, 0.9, 1.0], rows_each=1000)
    assert "row_number" not in q._jdf.queryExecution().optimizedPlan().toString()
    want = df.groupBy("k").agg(F.percentile("v", [0.0, 0.5, 0.9, 1.0]).alias("q"))
    assert sorted(map(tuple, q.collect())) == sorted(map(tuple, want.collect()))


def test_pieces_of_a_batch_change_nothing(spark, monkeypatch):
    df = spark.createDataFrame([(i, [f"Good day {i} ACME 12345.", "", "bad a@b.c"][: i % 4] or [""]) for i in range(50)], "doc_id long, sentences array<string>").coalesce(1)
    want = sorted(map(str, TX.infer_sentences(df).collect()))
    for size in (1, 100, TX.PIECE_BYTES):
        monkeypatch.setattr(TX, "PIECE_BYTES", size)
        assert sorted(map(str, TX.infer_sentences_arrow(df).collect())) == want


def test_tokens_are_cut_once(spark):
    plan = spark.createDataFrame([(["a b"],)], "s array<string>").select(lexicon_array("s").alias("m"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("split(") == 1
