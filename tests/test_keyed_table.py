import os

import pytest

from mlframe.sources.tables import read_keyed, upsert_keyed, write_keyed

SCHEMA = "k long, v string"


def _files(path):
    return {os.path.join(r, f) for r, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def _rows(spark, path):
    return sorted(map(tuple, read_keyed(spark, path).collect()), key=str)


@pytest.fixture()
def table(spark, tmp_dir):
    rows = spark.createDataFrame([(i, "old") for i in range(200)] + [(None, "old")], SCHEMA)
    return write_keyed(rows, f"{tmp_dir}/t", "k", parts=16)


def test_untouched_files_keep_their_names(spark, table):
    before = _files(table)
    updates = spark.createDataFrame([(7, "new"), (None, "new"), (1000, "new")], SCHEMA)
    touched = upsert_keyed(spark, table, updates, "k")
    after = _files(table)
    assert 1 <= len(touched) <= 3
    parts = {f"_of16={p}" for p in touched}
    assert {f for f in before if f.split(os.sep)[-2] not in parts} == {f for f in after if f.split(os.sep)[-2] not in parts}
    want = sorted([(i, "new" if i == 7 else "old") for i in range(200)] + [(None, "new"), (1000, "new")], key=str)
    assert _rows(spark, table) == want
    upsert_keyed(spark, table, updates, "k")  # replay
    assert _rows(spark, table) == want


def test_no_updates_and_repeated_keys(spark, table):
    before = _files(table)
    assert upsert_keyed(spark, table, spark.createDataFrame([], SCHEMA), "k") == []
    with pytest.raises(ValueError):
        upsert_keyed(spark, table, spark.createDataFrame([(1, "a"), (1, "b")], SCHEMA), "k")
    assert _files(table) == before


def test_a_lost_writer_is_finished_by_the_next_call(spark, table, monkeypatch):
    from mlframe.sources import tables as TB
    updates = spark.createDataFrame([(3, "new")], SCHEMA)
    real = TB._remove

    def lost(*_):
        raise RuntimeError("lost")
    monkeypatch.setattr(TB, "_remove", lost)
    with pytest.raises(RuntimeError):
        upsert_keyed(spark, table, updates, "k")
    monkeypatch.setattr(TB, "_remove", real)
    part = [f for f in _files(f"{table}/_pending")][0].split(os.sep)[-2]
    for f in _files(f"{table}/{part}"):  # as if the move had only begun
        os.remove(f)
    assert upsert_keyed(spark, table, spark.createDataFrame([], SCHEMA), "k") == []
    assert _rows(spark, table) == sorted([(i, "new" if i == 3 else "old") for i in range(200)] + [(None, "old")], key=str)
    assert not os.path.exists(f"{table}/_pending")


def test_two_columns_as_key(spark, tmp_dir):
    path = write_keyed(spark.createDataFrame([(1, "a", 1), (1, "b", 2)], "x int, y string, v int"), f"{tmp_dir}/t", ["x", "y"], parts=4)
    upsert_keyed(spark, path, spark.createDataFrame([(1, "b", 9), (2, "b", 3)], "x int, y string, v int"), ["x", "y"])
    assert _rows(spark, path) == [(1, "a", 1), (1, "b", 9), (2, "b", 3)]
