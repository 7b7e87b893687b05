"""Streaming twins: every stream equals its batch form after a drain, a
restart from the checkpoint adds no duplicates, and late rows beyond the
watermark are the only ones a windowed stream drops."""

import datetime as dt
import json
import os
import time

from pyspark.sql import functions as F

from mlframe.operators import windows as W
from mlframe.plans import streams as PS
from mlframe.sources.tables import read
from mlframe.streaming import operators as SO
from mlframe.streaming import sinks as SK
from mlframe.streaming import sources as SS


def test_restart_adds_no_duplicates(spark, sf_dir, tmp_dir):
    e, parts = PS._parts(read(spark, sf_dir, "events"), "event_id")
    SS.land(e, f"{tmp_dir}/in", "_part", parts[:2])
    src = lambda: SS.table_stream(spark, f"{tmp_dir}/in", PS.EVENT_SCHEMA, max_files=1)
    SK.drain(SK.start_append(src(), f"{tmp_dir}/out", f"{tmp_dir}/ck"))
    n1 = spark.read.parquet(f"{tmp_dir}/out").count()
    SK.drain(SK.start_append(src(), f"{tmp_dir}/out", f"{tmp_dir}/ck"))  # nothing new
    assert spark.read.parquet(f"{tmp_dir}/out").count() == n1
    SS.land(e, f"{tmp_dir}/in", "_part", parts[2:])
    SK.drain(SK.start_append(src(), f"{tmp_dir}/out", f"{tmp_dir}/ck"))
    out = spark.read.parquet(f"{tmp_dir}/out")
    assert out.count() == e.count() == out.select("event_id").distinct().count()


def test_stream_rolling_z_equals_batch(spark, sf_dir):
    s = PS.stream_rolling_z(spark, sf_dir)
    from mlframe.plans.sensors import rolling_zscore
    b = rolling_zscore(spark, sf_dir)
    assert sorted(s.collect()) == sorted(b.collect())


def test_window_feature_stream_equals_batch(spark, sf_dir):
    s = PS.declared_window_feature(spark, sf_dir)
    b = PS.declared_window_batch(spark, sf_dir)
    assert sorted(s.collect()) == sorted(b.collect())


def test_watermark_bounds_state(spark, tmp_dir):
    """The watermark trails the newest event time by the declared delay, so
    state for windows older than that is evicted. (Spark may still fold a row
    later than the watermark into a fresh window; it does not promise to drop
    it, so stream/batch equality is stated for in-order arrival.)"""
    t0 = dt.datetime(2024, 1, 1, 12, 0, 0)
    on_time = [(i, t0 + dt.timedelta(minutes=10 * i), 1, "x", 1.0, "{}") for i in range(12)]
    later = [(100, t0 + dt.timedelta(hours=3), 1, "x", 1.0, "{}")]
    spark.createDataFrame(on_time, PS.EVENT_SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/in")
    time.sleep(1.5)  # arrival order follows modification time
    spark.createDataFrame(later, PS.EVENT_SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/in")
    s = SS.table_stream(spark, f"{tmp_dir}/in", PS.EVENT_SCHEMA, max_files=1)
    agg = SO.window_feature(s, SO.WindowFeature(key="user_id", ts="ts", col="value"))
    q = SK.for_each_batch(agg, SO.update_log_writer(f"{tmp_dir}/out", ["window_start", "user_id"]), f"{tmp_dir}/ck", output_mode="update")
    SK.drain(q)
    wm = [p["eventTime"].get("watermark") for p in q.recentProgress if p.get("eventTime")]
    assert wm[-1].startswith("2024-01-01T14:00:00")  # newest event (15:00) minus the 1-hour delay
    state_rows = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    assert state_rows[-1] < state_rows[0] + 12


def test_json_rescue_column(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/in")
    with open(f"{tmp_dir}/in/a.json", "w") as f:
        f.write(json.dumps({"event_id": 1, "ts": "2024-01-01T00:00:00.000000", "user_id": 2, "event_type": "x",
                            "value": 1.5, "props": "{}", "extra": "kept"}) + "\n")
        f.write(json.dumps({"event_id": 2, "ts": "2024-01-01T00:00:01.000000", "user_id": 2, "event_type": "x",
                            "value": 2.5, "props": "{}"}) + "\n")
    s = SS.bronze_json_stream(spark, f"{tmp_dir}/in", PS.EVENT_SCHEMA)
    SK.drain(SK.start_append(s, f"{tmp_dir}/out", f"{tmp_dir}/ck"))
    got = {r["event_id"]: r["_rescued_data"] for r in spark.read.parquet(f"{tmp_dir}/out").collect()}
    assert got == {1: '{"extra":"kept"}', 2: None}


def test_rate_stream_renames(spark, tmp_dir):
    s = SS.rate_stream(spark, 50)
    q = SK.start_append(s, f"{tmp_dir}/out", f"{tmp_dir}/ck", trigger="1 second")
    SK.run_for(q, 3)
    out = spark.read.parquet(f"{tmp_dir}/out")
    assert out.columns == ["tx_id", "tx_time"]


def test_medallion_gold_equals_batch_detector(spark, sf_dir):
    s = PS.medallion_stream(spark, sf_dir)
    from mlframe.plans.sensors import gold_anomalies
    b = gold_anomalies(spark, sf_dir)
    assert sorted(s.collect()) == sorted(b.collect())


def test_stream_expectations_counts_in_progress(spark, sf_dir, tmp_dir):
    e, parts = PS._parts(read(spark, sf_dir, "events"), "event_id")
    SS.land(e, f"{tmp_dir}/in", "_part", parts)
    s = SS.table_stream(spark, f"{tmp_dir}/in", PS.EVENT_SCHEMA, max_files=1)
    q = SK.start_append(SO.expect_stream(s, PS.STREAM_RULES), f"{tmp_dir}/out", f"{tmp_dir}/ck")
    SK.drain(q)
    seen = sum(int(p["observedMetrics"]["expectations"]["value_below_99"]) for p in q.recentProgress
               if p.get("observedMetrics"))
    batch = e.where(~F.coalesce(F.col("value") < 99, F.lit(False))).count()
    assert seen == batch


def test_detection_records(spark, tmp_dir):
    from mlframe.sources.images import detection_records, read_images
    os.makedirs(f"{tmp_dir}/img")
    for name in ("a.png", "b.png"):
        with open(f"{tmp_dir}/img/{name}", "wb") as f:
            f.write(b"\x89PNG-bytes-" + name.encode())
    ann = spark.createDataFrame(
        [("a.png", 100, 200, [([10.0, 20.0, 30.0, 40.0], 0)]), ("b.png", 50, 50, [])],
        "file_name string, width int, height int, objects array<struct<bbox:array<double>,category:int>>")
    rec = detection_records(read_images(spark, f"{tmp_dir}/img"), ann, max_objects=3)
    got = {r["file_name"]: r for r in rec.collect()}
    a = got["a.png"]
    assert [round(x, 6) for x in a["boxes"][0]] == [0.1, 0.1, 0.4, 0.3]
    assert a["categories"] == [1, 0, 0] and a["n_objects"] == 1
    assert got["b.png"]["boxes"] == [[0.0] * 4] * 3


def test_rolling_windows_batch_plan_has_one_exchange_per_key(spark, sf_dir):
    from mlframe import bindings as B
    r = B.readings(spark, sf_dir)
    plan = W.rolling_z(r, "tag_id", "reading_ts", "value", 12)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
