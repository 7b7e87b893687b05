"""Golden micro-cases (FIXTURES.md part 4) on tiny hand-made frames."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from mlframe.functions import scalar as S
from mlframe.functions.text import sentences
from mlframe.operators import survival as SV
from mlframe.operators import windows as W
from mlframe.operators.aggs import latency_summary
from mlframe.operators.graph import rollup
from mlframe.operators.joins import AsOfLookup, asof_join, match_intervals

# ---- fixed values: the reference's bearing lifetimes and meter graph -------
LIFETIMES = [17.88, 28.92, 33.00, 41.52, 42.12, 45.60, 48.48, 51.84, 51.96, 54.12,
             55.56, 67.80, 68.64, 68.64, 68.88, 84.12, 93.12, 98.64, 105.12, 105.84,
             127.92, 128.04, 173.40]
METER_VERTICES = [(1, 2), (2, 3), (3, 10), (4, 10), (5, None), (6, None), (7, None), (8, None)]
METER_EDGES = [(1, 5), (2, 6), (3, 6), (4, 7), (6, 8), (7, 8)]


def test_graph_totals(spark):
    v = spark.createDataFrame(METER_VERTICES, "id long, reading long")
    e = spark.createDataFrame(METER_EDGES, "src long, dst long")
    got = {r["id"]: r["total"] for r in rollup(v, e).collect()}
    assert got == {1: 2, 2: 3, 3: 10, 4: 10, 5: 2, 6: 13, 7: 10, 8: 23}


def test_graph_negative_increments_carried(spark):
    v = spark.createDataFrame([(1, -5), (2, 3), (3, None)], "id long, reading long")
    e = spark.createDataFrame([(1, 3), (2, 3)], "src long, dst long")
    got = {r["id"]: r["total"] for r in rollup(v, e).collect()}
    assert got[3] == -2


def _lifetimes(spark, cap=None):
    rows = [("g", min(t, cap) if cap else t, 1 if (cap is None or t <= cap) else 0) for t in LIFETIMES]
    return spark.createDataFrame(rows, "grp string, t double, failed int")


def test_weibull_complete(spark):
    r = SV.weibull_mle(_lifetimes(spark), "grp").first()
    assert r["beta"] == pytest.approx(2.102, abs=2e-3)
    assert r["alpha"] == pytest.approx(81.88, abs=0.05)
    assert r["median_life"] == pytest.approx(68.78, abs=0.05)


def test_weibull_censored_t28(spark):
    r = SV.weibull_mle(_lifetimes(spark, 28.0), "grp").first()
    assert r["n_failed"] == 1
    assert r["beta"] == pytest.approx(2.266, abs=2e-3)
    assert r["alpha"] == pytest.approx(110.33, abs=0.1)
    assert r["median_life"] == pytest.approx(93.86, abs=0.1)
    # the inspection sweep withholds fits with fewer than two failures
    sw = SV.censor_sweep(_lifetimes(spark), "grp", [28.0]).first()
    assert sw["beta"] is None and sw["n_failed"] == 1


def test_weibull_censored_t34_t60(spark):
    r34 = SV.weibull_mle(_lifetimes(spark, 34.0), "grp").first()
    r60 = SV.weibull_mle(_lifetimes(spark, 60.0), "grp").first()
    assert r34["alpha"] == pytest.approx(57.89, abs=0.1)
    assert r60["alpha"] == pytest.approx(68.68, abs=0.1)


def test_weibull_bounded_on_cap(spark):
    r = SV.weibull_mle(_lifetimes(spark, 60.0), "grp", alpha_max=60.0).first()
    assert r["alpha"] == 60.0 and r["on_cap"] is True


def test_weibull_bayes_t28_t60(spark):
    b28 = SV.weibull_bayes(_lifetimes(spark, 28.0), "grp").first()
    assert b28["beta_mean"] == pytest.approx(2.224, abs=2e-3)
    assert b28["alpha_mean"] == pytest.approx(134.05, abs=0.05)
    assert b28["alpha_lo"] == pytest.approx(62.78, abs=0.05)
    assert b28["alpha_hi"] == pytest.approx(259.25, abs=0.05)
    b60 = SV.weibull_bayes(_lifetimes(spark, 60.0), "grp").first()
    assert b60["beta_mean"] == pytest.approx(2.528, abs=2e-3)
    assert b60["alpha_mean"] == pytest.approx(76.38, abs=0.05)


def test_on_demand_features(spark):
    df = spark.createDataFrame(
        [(22, 500.0, "A"), (23, 500.01, "E"), (0, None, "Z"), (5, 1.0, None), (6, 0.0, "B"), (None, 3.0, "C")],
        "h int, amount double, category_code string")
    df = df.withColumn("event_ts", F.when(F.col("h").isNotNull(),
                                          F.make_timestamp_ntz(F.lit(2024), F.lit(1), F.lit(1), "h", F.lit(0), F.lit(0))))
    got = S.on_demand(df).select("odf_is_night", "odf_high_amount", "odf_category_ordinal").collect()
    assert [r[0] for r in got] == [0, 1, 1, 1, 0, 0]
    assert [r[1] for r in got] == [0, 1, 0, 0, 0, 0]
    assert [r[2] for r in got] == [0, 4, -1, -1, 1, 2]


def _ts(s):
    return dt.datetime.fromisoformat(s)


def test_asof_boundary_and_feed_forward(spark):
    feats = spark.createDataFrame([(1, _ts("2024-01-02 00:00:00"), 7)], "k long, feature_ts timestamp_ntz, x int")
    spine = spark.createDataFrame([(1, _ts("2024-01-01 23:59:59")), (1, _ts("2024-01-02 00:00:00")),
                                   (1, _ts("2024-01-05 00:00:00"))], "k long, ts timestamp_ntz")
    got = asof_join(spine, [AsOfLookup(feats, ["k"], "feature_ts")], "ts", bucket="day").orderBy("ts").collect()
    assert [r["x"] for r in got] == [None, 7, 7]


def test_asof_null_in_latest_row_does_not_fall_through(spark):
    feats = spark.createDataFrame([(1, _ts("2024-01-01 00:00:00"), 1), (1, _ts("2024-01-03 00:00:00"), None)],
                                  "k long, feature_ts timestamp_ntz, x int")
    spine = spark.createDataFrame([(1, _ts("2024-01-04 00:00:00"))], "k long, ts timestamp_ntz")
    got = asof_join(spine, [AsOfLookup(feats, ["k"], "feature_ts")], "ts").first()
    assert got["x"] is None


def test_asof_max_age(spark):
    feats = spark.createDataFrame([(1, _ts("2024-01-01 00:00:00"), 1)], "k long, feature_ts timestamp_ntz, x int")
    spine = spark.createDataFrame([(1, _ts("2024-01-02 00:00:00")), (1, _ts("2024-01-20 00:00:00"))],
                                  "k long, ts timestamp_ntz")
    got = asof_join(spine, [AsOfLookup(feats, ["k"], "feature_ts", max_age="7 days")], "ts").orderBy("ts").collect()
    assert [r["x"] for r in got] == [1, None]


def test_rolling_z_start_and_reason_order(spark):
    rows = [("t", _ts(f"2024-01-01 00:{i:02d}:00"), float(v)) for i, v in enumerate([1, 2, 3, 2, 100])]
    df = spark.createDataFrame(rows, "tag string, ts timestamp_ntz, value double")
    z = W.rolling_z(df, "tag", "ts", "value", 12).orderBy("ts").collect()
    assert z[0]["z"] == 0.0 and z[1]["z"] == 0.0
    det = W.detect(z_df := W.rolling_z(df, "tag", "ts", "value", 12)
                   .withColumn("crit_threshold", F.lit(50.0)).withColumn("normal_low", F.lit(0.0))
                   .withColumn("quality_code", F.lit("Good"))).collect()
    assert z_df is not None
    assert [r["detect_reason"] for r in det] == ["crit_threshold"]


def test_interval_edges_closed(spark):
    w = spark.createDataFrame([(1, _ts("2024-01-01 00:00:00"), _ts("2024-01-01 06:00:00"))],
                              "k long, start_ts timestamp_ntz, end_ts timestamp_ntz")
    p = spark.createDataFrame([(1, _ts("2024-01-01 00:00:00")), (1, _ts("2024-01-01 06:00:00")),
                               (1, _ts("2024-01-01 06:00:01"))], "k long, ts timestamp_ntz")
    assert match_intervals(w, p, "k", "ts").count() == 2
    assert match_intervals(w, p, "k", "ts", closed="left").count() == 1


def test_sentence_split(spark):
    df = spark.createDataFrame([("",), ("Hi. Yo!  ",), (None,)], "text string")
    got = [r[0] for r in df.select(sentences("text")).collect()]
    assert got == [[""], ["Hi.", "Yo!"], [""]]


def test_percentile_kinds(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 4)], "v double")
    assert latency_summary(df, "v").first()["p50"] == 2.5
    assert latency_summary(df, "v", method="nearest").first()["p50"] == 2.0


def test_core_id_and_site(spark):
    df = spark.createDataFrame([("/data/raw/GC01-Y_geochem.csv",)], "p string")
    r = df.select(S.key_from_path("p").alias("k")).select("k", S.site_from_key("k").alias("s")).first()
    assert (r["k"], r["s"]) == ("GC01-Y", "GC01")


def test_sentinel_and_log(spark):
    df = spark.createDataFrame([(-9999.0,), (-1.0,), (0.0,), (None,)], "ppm double")
    clean = S.replace_sentinel(df, ["ppm", "absent"])
    assert [r[0] for r in clean.collect()] == [None, -1.0, 0.0, None]
    logs = [r[0] for r in S.log_columns(clean, ["ppm"]).select("log_ppm").collect()]
    assert logs == [0.0, 0.0, 0.0, 0.0]
    kept = [r[0] for r in S.log_columns(clean, ["ppm"], keep_null=True).select("log_ppm").collect()]
    assert kept[0] is None and kept[3] is None


def test_box_normalisation(spark):
    from mlframe.sources.images import normalise_box
    df = spark.createDataFrame([([10.0, 20.0, 30.0, 40.0], 100, 200)], "bbox array<double>, width int, height int")
    r = df.select(normalise_box("bbox", "width", "height").alias("b")).first()["b"]
    assert [round(x, 6) for x in r] == [0.10, 0.10, 0.40, 0.30]


def test_holiday_factor_bands(spark):
    df = spark.createDataFrame([(dt.date(2021, 7, 4),), (dt.date(2021, 3, 1),)], "d date")
    assert [r[0] for r in df.select(S.holiday_factor(F.col("d"))).collect()] == [1.35, 1.0]


def test_hash_normal_moments(spark):
    from mlframe.functions.hashing import hash_normal
    z = spark.range(20000).select(hash_normal("id").alias("z")).agg(F.avg("z"), F.stddev("z")).first()
    assert abs(z[0]) < 0.05 and abs(z[1] - 1) < 0.05
    assert math.isfinite(z[1])
