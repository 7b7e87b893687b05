"""Keyed stream state (T6): chunks stay small, idle tags are forgotten; and the progress listener."""

import datetime as dt
import time

import numpy as np
import pandas as pd

from mlframe.operators import windows as W
from mlframe.streaming import operators as SO
from mlframe.streaming import progress as SP
from mlframe.streaming import sinks as SK

SCHEMA = "reading_id long, tag_id string, reading_ts timestamp_ntz, value double"
T0 = dt.datetime(2024, 1, 1)


class Value:
    def __init__(self):
        self.v = None

    def exists(self):
        return self.v is not None

    def get(self):
        return self.v

    update = put = lambda self, v: setattr(self, "v", v)


class Map(dict):
    getValue, updateValue, removeKey = dict.get, dict.__setitem__, dict.__delitem__


class Handle:
    def getListState(self, *a, **k):
        return Value()

    getValueState = getListState

    def getMapState(self, *a, **k):
        return Map()


def frame(rows):
    return pd.DataFrame([(i, "a", pd.Timestamp(T0) + pd.Timedelta(seconds=s), v) for i, s, v in rows], columns=["reading_id", "tag_id", "reading_ts", "value"])


def test_a_hot_tag_is_scored_in_small_pieces():
    rng = np.random.Generator(np.random.PCG64(1))
    rows = [(i, int(i * 0.7), float(rng.integers(0, 50))) for i in range(20_000)]
    shuffled = [rows[i] for i in rng.permutation(len(rows))]
    p = SO.RollingZ(12, 1000, 60_000_000)
    p.init(Handle())
    sizes, score = [], p._score
    p._score = lambda key, ring, chunk: (sizes.append(len(chunk[0])), score(key, ring, chunk))[1]
    out = pd.concat(p.handleInputRows(("a",), (frame(shuffled[a:a + 500]) for a in range(0, len(rows), 500)), None))
    assert max(sizes) <= 500 and len(p.spool) == 0 and len(p.ring.get()) == 12
    mean, std = SO.rolling_moments(np.array([r[2] for r in rows]), 12, 0)
    out = out.sort_values("reading_id")
    assert out["reading_id"].tolist() == [r[0] for r in rows]
    np.testing.assert_allclose(out["roll_mean"], mean)
    np.testing.assert_allclose(out["roll_std"], std)


def test_chunks_change_nothing(spark, tmp_dir):
    rows = [(i, f"t{i % 3}", T0 + dt.timedelta(seconds=(i * 37) % 500), float(i * i % 11)) for i in range(600)]
    df = spark.createDataFrame(rows, SCHEMA)
    df.repartition(3).write.parquet(f"{tmp_dir}/in")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        with SK.rocksdb_state(spark):
            q = SK.start_append(SO.stream_rolling_z(spark.readStream.schema(SCHEMA).parquet(f"{tmp_dir}/in"), bucket="30 seconds"), f"{tmp_dir}/out", f"{tmp_dir}/ck")
        SK.drain(q)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    rounded = lambda d: sorted((r["reading_id"], None if r["roll_mean"] is None else round(r["roll_mean"], 9), round(r["z"], 9)) for r in d.collect())
    got = spark.read.parquet(f"{tmp_dir}/out")
    ids = W.rolling_z(df, "tag_id", "reading_ts", "value", 12)
    ties = {r["reading_ts"] for r in df.groupBy("tag_id", "reading_ts").count().where("count > 1").collect()}
    assert not ties and rounded(got) == rounded(ids)


def test_an_idle_tag_is_forgotten(spark, tmp_dir):
    stream = lambda: SO.stream_rolling_z(spark.readStream.schema(SCHEMA).parquet(f"{tmp_dir}/in"), ttl="2 seconds")

    def land(first, at):
        spark.createDataFrame([(first + i, "a", T0 + dt.timedelta(seconds=at + i), float(i)) for i in range(4)], SCHEMA).coalesce(1) \
            .write.mode("append").parquet(f"{tmp_dir}/in")
        with SK.rocksdb_state(spark):
            q = SK.start_append(stream(), f"{tmp_dir}/out", f"{tmp_dir}/ck")
        SK.drain(q)

    land(0, 100)
    time.sleep(3)
    land(10, 50)  # older than anything before, but nothing is left to compare with
    got = {r["reading_id"]: r for r in spark.read.parquet(f"{tmp_dir}/out").collect()}
    assert got[10]["roll_mean"] is None and got[10]["z"] == 0.0
    assert got[11]["roll_mean"] == 0.0 and got[3]["roll_mean"] == 1.0


def test_the_listener_sees_every_batch(spark, tmp_dir):
    for k in range(3):
        spark.range(k * 10, k * 10 + 10 + k).selectExpr("id % 4 AS k", "id AS v").coalesce(1).write.mode("append").parquet(f"{tmp_dir}/in")
        time.sleep(1.1)
    s = spark.readStream.schema("k long, v long").option("maxFilesPerTrigger", 1).parquet(f"{tmp_dir}/in")
    q = SP.logged(spark, f"{tmp_dir}/log", lambda: SK.drain(
        SK.for_each_batch(s.groupBy("k").count(), lambda b, e: b.count(), f"{tmp_dir}/ck", output_mode="update")))
    rows = SP.read_progress(spark, f"{tmp_dir}/log").orderBy("batch_id").collect()
    assert [r["n_input_rows"] for r in rows if r["n_input_rows"]] == [10, 11, 12]
    assert {r["run_id"] for r in rows} == {str(q.runId)} and rows[0]["watermark"] is None and rows[2]["state_rows"] == 4
