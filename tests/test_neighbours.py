import numpy as np

from mlframe.operators.neighbours import knn1, knn1_work


def _frame(spark, X, first=0):
    return spark.createDataFrame([(first + i, [float(a) for a in x], i % 7) for i, x in enumerate(X)],
                                 "id long, v array<double>, label int")


def _brute(T, Q, first):
    out = {}
    for i, q in enumerate(Q):
        d = ((T - q) ** 2).sum(1)
        at = int(np.flatnonzero(d == d.min())[0])
        out[first + i] = (at, at % 7)
    return out


def _got(df):
    return {r["test_id"]: (r["nn_id"], r["pred"]) for r in df.collect()}


def test_clusters_hot_point_and_ties(spark):
    """Clusters far apart, a third of the training rows in one point, integer coordinates with many ties."""
    g = np.random.Generator(np.random.PCG64(5))
    centres = g.integers(-1000, 1000, (12, 5))
    T = np.vstack([centres[g.integers(0, 12, 600)] + g.integers(-6, 7, (600, 5)), np.tile(centres[0], (300, 1))]).astype(float)
    Q = np.vstack([centres[g.integers(0, 12, 150)] + g.integers(-6, 7, (150, 5)), centres[:1], g.integers(-3000, 3000, (9, 5))]).astype(float)
    t, q = _frame(spark, T), _frame(spark, Q, 10_000)
    assert _got(knn1(t, q, "id", "v", "label", block_rows=32)) == _brute(T, Q, 10_000)
    w = knn1_work(t, q, "id", "v", "label", block_rows=32).first()
    assert w["pairs"] == 900 * 160 and w["compared"] < 0.5 * w["pairs"]


def test_random_directions_skip_nothing_wrong(spark):
    g = np.random.Generator(np.random.PCG64(6))
    T, Q = g.normal(size=(300, 32)), g.normal(size=(60, 32))
    assert _got(knn1(_frame(spark, T), _frame(spark, Q, 1000), "id", "v", "label", block_rows=16)) == _brute(T, Q, 1000)


def test_far_from_the_origin(spark):
    """Coordinates around 1e7: the matrix product loses what separates neighbours, exact distances decide."""
    g = np.random.Generator(np.random.PCG64(7))
    T, Q = 1e7 + g.integers(0, 40, (200, 3)).astype(float), 1e7 + g.integers(0, 40, (50, 3)).astype(float)
    assert _got(knn1(_frame(spark, T), _frame(spark, Q, 500), "id", "v", "label", block_rows=16)) == _brute(T, Q, 500)


def test_nulls_and_empty_tables(spark):
    schema = "id long, v array<double>, label int"
    t = spark.createDataFrame([(1, [0.0, 0.0], None), (2, None, 3), (3, [float("nan"), 0.0], 4)], schema)
    q = spark.createDataFrame([(10, [1.0, 0.0], 0), (11, None, 0)], schema)
    assert _got(knn1(t, q, "id", "v", "label")) == {10: (1, None), 11: (None, None)}
    assert _got(knn1(t.limit(0), q, "id", "v", "label")) == {10: (None, None), 11: (None, None)}
    assert _got(knn1(t, q.limit(0), "id", "v", "label")) == {}


def test_pairs_are_compared_where_they_lie(spark, capsys):
    """No exchange carries a chunk of queries with a block of training rows: the bytes shuffled grow with the tables, not with their product."""
    g = np.random.Generator(np.random.PCG64(8))
    T, Q = np.vstack([g.normal(size=(300, 8)), np.zeros((100, 8))]), np.vstack([g.normal(size=(60, 8)), np.zeros((40, 8))])
    found = knn1(_frame(spark, T), _frame(spark, Q, 1000), "id", "v", "label", block_rows=16)
    found.explain()
    lines = capsys.readouterr().out.split("\n")
    solved = [i for i, x in enumerate(lines) if "MapInArrow" in x]
    assert solved and all("CartesianProduct" in next(x for x in lines[i:] if "Exchange" in x or "Join" in x or "Cartesian" in x) for i in solved)
    assert _got(found) == _brute(T, Q, 1000)
