"""Drift against a stored baseline: sketch error, merging, equal-mass bins, shifts that a fixed range hides."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from mlframe.operators import drift as DR


def rows(spark, values, day=1, col="x"):
    return spark.createDataFrame([(dt.datetime(2024, 1, day), None if v is None else float(v)) for v in values], f"ts timestamp_ntz, {col} double")


def test_keys_follow_the_order_of_values(spark):
    values = [-math.inf, -1e300, -5.0, -1.0, -1e-300, 0.0, 5e-324, 1e-9, 0.99, 1.0, 1.01, 7.0, 1e308, math.inf, math.nan]
    got = rows(spark, values).select("x", DR.sketch_key("x").alias("k"), DR.key_value(DR.sketch_key("x")).alias("v")).collect()
    keys = [r["k"] for r in got]
    assert keys == sorted(keys) and len(set(keys)) >= 13
    for r in got:
        if math.isfinite(r["x"]) and abs(r["x"]) > 1e-300:
            assert abs(r["v"] - r["x"]) <= 0.01001 * abs(r["x"])
    assert math.isnan(got[-1]["v"]) and got[0]["v"] == -math.inf and got[5]["v"] == 0.0


def test_merged_sketches_equal_the_sketch_of_all_rows(spark):
    rnd = random.Random(1)
    parts = [[rnd.lognormvariate(0, 2) for _ in range(300)] for _ in range(3)]
    df = rows(spark, parts[0], 1).unionByName(rows(spark, parts[1], 2)).unionByName(rows(spark, parts[2], 3))
    days = DR.column_sketches(df, ["x"], "ts")
    whole = DR.column_sketches(df.withColumn("ts", F.lit(dt.datetime(2024, 1, 1))), ["x"], "ts").drop("window_start")
    merged = DR.merge_sketches(days)
    assert sorted(map(tuple, merged.select("column", "key", "n").collect())) == sorted(map(tuple, whole.select("column", "key", "n").collect()))
    exact = sorted(v for p in parts for v in p)
    for r in DR.sketch_quantiles(merged, [0.0, 0.25, 0.5, 0.99, 1.0]).collect():
        want = exact[max(math.ceil(r["q"] * 900 - 1e-9), 1) - 1]
        assert abs(r["value"] - want) <= 0.01001 * want


def test_bins_hold_equal_mass(spark):
    sketch = DR.merge_sketches(DR.column_sketches(rows(spark, range(1, 1001)), ["x"], "ts"))
    edges = DR.equal_mass_bins(sketch, 10).first()
    assert len(edges["lows"]) == 10
    held = {r["b"]: r["n"] for r in sketch.withColumn("b", F.size(F.filter(F.array(*[F.lit(v) for v in edges["lows"]]), lambda v: v <= F.col("key"))))
            .groupBy("b").agg(F.sum("n").alias("n")).collect()}
    assert sum(held.values()) == 1000 and all(70 <= n <= 130 for n in held.values())


def report(spark, base, *days):
    baseline = DR.merge_sketches(DR.column_sketches(rows(spark, base), ["x"], "ts"))
    df = rows(spark, days[0], 2)
    for k, values in enumerate(days[1:], 3):
        df = df.unionByName(rows(spark, values, k))
    got = DR.drift_report(DR.column_sketches(df, ["x"], "ts"), baseline, 10).collect()
    return {(r["window_start"].day, r["drift_type"]): (r["js_distance"], r["compared_to"]) for r in got}


def test_slow_drift_shows_against_the_baseline(spark):
    base = list(range(1, 201))
    got = report(spark, base, base, [v * 1.1 for v in base], [v * 1.2 for v in base], [v * 1.3 for v in base])
    assert got[2, "baseline"] == (0.0, None) and (2, "consecutive") not in got
    assert got[5, "baseline"][0] > got[4, "baseline"][0] > got[3, "baseline"][0] > 0
    assert got[5, "baseline"][0] > got[5, "consecutive"][0] and got[5, "consecutive"][1].day == 4


@pytest.mark.parametrize("shifted", [[1e6] * 50, [-3.0] * 50, [None] * 50, [math.nan] * 50])
def test_all_out_of_the_old_range(spark, shifted):
    got = report(spark, range(1, 101), list(range(1, 101)), shifted, shifted)
    assert got[3, "baseline"][0] == got[3, "consecutive"][0] == 1.0 and got[4, "consecutive"][0] == 0.0


def test_one_value_and_empty(spark):
    got = report(spark, [0.0] * 10, [0.0] * 3, [0.0, 0.0, 1.0, 1.0])
    assert got[2, "baseline"][0] == 0.0 and 0 < got[3, "baseline"][0] < 1
    empty = rows(spark, [1.0]).where("false")
    sk = DR.column_sketches(empty, ["x"], "ts")
    assert DR.drift_report(sk, DR.merge_sketches(sk)).collect() == []
