"""Series and universes with null keys, and dates beside the grid."""

import datetime as dt

from mlframe.operators import joins as J
from mlframe.operators import windows as W


def days(*ds):
    return [dt.date(2024, m, d) for m, d in ds]


def test_universe_keeps_a_null_key(spark):
    keys = spark.createDataFrame([(None,), (1,), (0,), (1,)], "k int")
    agg = spark.createDataFrame([(None, 3), (1, 4)], "k int, n long")
    assert sorted(map(tuple, J.full_universe(keys, agg, "k").collect()), key=str) == sorted([(None, 3), (1, 4), (0, 0)], key=str)


def test_null_key_is_a_series(spark):
    df = spark.createDataFrame([(None, d, y) for d, y in zip(days((1, 1), (3, 1)), (5.0, 7.0))], "k string, ds date, y double")
    assert [tuple(r) for r in W.densify(df, "k", "ds", "y").orderBy("ds").collect()] == [
        (None, d, y) for d, y in zip(days((1, 1), (2, 1), (3, 1)), (5.0, 0.0, 7.0))]


def test_dates_beside_the_grid_keep_their_values(spark):
    df = spark.createDataFrame([("a", d, y) for d, y in zip(days((1, 15), (2, 10), (2, 20), (4, 20)), (5.0, 7.0, 1.0, 9.0))], "k string, ds date, y double")
    assert [tuple(r)[1:] for r in W.densify(df, "k", "ds", "y").orderBy("ds").collect()] == list(zip(days((1, 1), (2, 1), (3, 1), (4, 1)), (5.0, 8.0, 0.0, 9.0)))


def test_steps_of_several_units(spark):
    df = spark.createDataFrame([("a", d, y) for d, y in zip(days((1, 1), (1, 9), (1, 29)), (1.0, 2.0, 4.0))], "k string, ds date, y double")
    assert [tuple(r)[1:] for r in W.densify(df, "k", "ds", "y", "7 DAY").orderBy("ds").collect()] == list(
        zip(days((1, 1), (1, 8), (1, 15), (1, 22), (1, 29)), (1.0, 2.0, 0.0, 0.0, 4.0)))
    assert W.densify(df.where("false"), "k", "ds", "y").collect() == []


def test_windows_of_a_null_key_survive_the_cutoff(spark):
    df = spark.createDataFrame([(None, dt.date(2024, 1, 1) + dt.timedelta(days=i), float(i)) for i in range(20)], "k string, ds date, y double")
    whole = W.sequence_windows(df, "k", "ds", "y").count()
    split = W.sequence_windows(df, "k", "ds", "y", cutoff="2024-01-12").collect()
    assert whole == 14 and {r["split"] for r in split} == {"train", "validation"} and len(split) == 14 - 3 + 1
