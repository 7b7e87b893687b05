"""Dyadic interval blocks (J6) and value buckets of any number."""

import datetime as dt
import random

from pyspark.sql import functions as F

from mlframe.operators import joins as J
from mlframe.operators import ranking as RK


def test_blocks_cover_every_unit_once(spark):
    rnd = random.Random(2)
    spans = [(0, 0), (0, 1), (1, 1), (1, 2), (7, 8), (-5, 3), (-1, 0), (19_000, 22_652)] + [(a, a + rnd.randrange(400)) for a in (rnd.randrange(-900, 900) for _ in range(150))]
    df = spark.createDataFrame(spans, "lo long, hi long")
    for r in df.withColumn("b", J.dyadic_blocks(F.col("lo"), F.col("hi"))).collect():
        units = [u for x in r["b"] for u in range(x["block"] << x["level"], (x["block"] + 1) << x["level"])]
        assert sorted(units) == list(range(r["lo"], r["hi"] + 1))
        assert len(r["b"]) <= 2 * (r["hi"] - r["lo"] + 1).bit_length()
    ten_years = df.where("lo = 19000").select(F.size(J.dyadic_blocks(F.col("lo"), F.col("hi"))).alias("n")).first()["n"]
    assert ten_years < 40


def test_long_and_short_windows_match_like_a_loop(spark):
    rnd, t0 = random.Random(3), dt.datetime(1995, 1, 1)
    at = lambda: t0 + dt.timedelta(minutes=rnd.randrange(0, 12 * 365 * 1440))
    ws = [(i, rnd.choice(["a", "b", None]), s, s + dt.timedelta(minutes=rnd.choice([0, 5, 3000, 2_000_000]))) for i in range(60) for s in [at()]] + [(99, "a", t0, None)]
    ps = [(i, rnd.choice(["a", "b", "c", None]), at()) for i in range(400)] + [(1000 + i, w[1], w[2]) for i, w in enumerate(ws)]
    w = spark.createDataFrame(ws, "wid int, k string, start_ts timestamp_ntz, end_ts timestamp_ntz")
    p = spark.createDataFrame(ps, "pid int, k string, ts timestamp_ntz")
    for closed in ("both", "left"):
        want = []
        for i, k, s, e in ws:
            hit = [(i, j) for j, kk, t in ps if k is not None and k == kk and e is not None and s <= t and (t <= e if closed == "both" else t < e)]
            want += hit or [(i, None)]
        for bucket in ("day", "hour"):
            got = [(r["w"]["wid"], r["p"]["pid"] if r["p"] else None) for r in J.match_intervals(w, p, "k", "ts", closed=closed, bucket=bucket).collect()]
            assert sorted(got, key=str) == sorted(want, key=str)


def test_ten_thousand_buckets(spark):
    bounds = [i * 0.5 - 100 for i in range(10_000)] + [float("inf")]
    values = [-1e9, -100.0, -99.9, 0.0, 0.25, 0.5, 1234.5, 4899.5, 1e9, float("inf"), None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r["b"] for r in df.select(RK._search(F.col("x"), bounds).alias("b")).collect()]
    assert got == [sum(b < v for b in bounds) if v is not None else 0 for v in values]
    plan = df.select(RK._search(F.col("x"), bounds).alias("b"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("CASE WHEN") <= 1


def test_positions_over_many_small_buckets(spark):
    df = spark.range(3000).select((F.col("id") * 7919 % 1009).cast("double").alias("x"), "id").withColumn("x", F.when(F.col("id") % 50 > 0, F.col("x")))
    got = RK.positions(df, [F.col("x").asc_nulls_first(), F.col("id")], RK.value_buckets(df, "x", rows_each=3)).collect()
    assert [(r["pos"]) for r in sorted(got, key=lambda r: (r["x"] is not None, r["x"] or 0, r["id"]))] == list(range(1, 3001))
