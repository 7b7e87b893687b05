"""One test per fault found earlier, from the value that should come out."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mlframe.functions.text import sentences
from mlframe.operators import forecast as FC
from mlframe.operators import iforest as IF
from mlframe.operators import metrics as M
from mlframe.operators import ml as ML
from mlframe.operators import quality as Q
from mlframe.operators import survival as SV
from mlframe.operators import windows as W
from mlframe.operators.aggs import entity_stats, impute_median, latency_summary, pivot_counts, pos_weight
from mlframe.operators.features import create_training_set, pit_counters
from mlframe.operators.graph import rollup
from mlframe.operators.joins import AsOfLookup, asof_join, match_intervals
from mlframe.operators.models import apply_scaler, fit_scaler
from mlframe.operators.ranking import group_quantiles, value_buckets
from mlframe.operators.sampling import stratified_split, time_split
from mlframe.plans import streams as PS
from mlframe.sources import tables as TB
from mlframe.streaming import operators as SO
from mlframe.streaming import sinks as SK
from mlframe.streaming import sources as SS

T0 = dt.datetime(2024, 1, 1)


def test_long_sentences_stay_whole(spark):
    long = "x" * 5000 + "."
    got = spark.createDataFrame([(f"{long} End.",)], "t string").select(sentences("t").alias("s")).first()["s"]
    assert got == [long, "End."]


def test_rollup_of_a_long_chain_and_a_cycle(spark):
    v = spark.createDataFrame([(i, 1) for i in range(15)], "id long, reading long")
    e = spark.createDataFrame([(i, i + 1) for i in range(14)], "src long, dst long")
    assert {r["id"]: r["total"] for r in rollup(v, e).collect()}[14] == 15.0
    with pytest.raises(ValueError):
        rollup(v, e.unionByName(spark.createDataFrame([(14, 0)], "src long, dst long")))


def test_weibull_shape_beyond_the_first_grid(spark):
    rng = random.Random(1)
    rows = [("g", rng.gauss(100, 2), 1) for _ in range(60)]
    r = SV.weibull_mle(spark.createDataFrame(rows, "g string, t double, failed int"), "g").first()
    assert 30 < r["beta"] < 120 and 99 < r["alpha"] < 103


def test_weibull_groups_without_failures_or_with_one_lifetime(spark):
    rows = [("none", 5.0, 0), ("none", 7.0, 0), ("same", 9.0, 1), ("same", 9.0, 1), (None, 3.0, 1), (None, 8.0, 1)]
    df = spark.createDataFrame(rows, "g string, t double, failed int")
    got = {r["g"]: r for r in SV.weibull_mle(df, "g").collect()}
    assert got["none"]["beta"] is None and got["none"]["n_failed"] == 0 and got["same"]["beta"] is None
    assert got[None]["beta"] > 0
    sweep = {(r["g"], r["inspect_t"]): r for r in SV.censor_sweep(df, "g", [1.0, 10.0], alpha_max=30.0).collect()}
    assert sweep[None, 1.0]["beta"] is None and sweep[None, 1.0]["alpha_mean"] > 0
    assert sweep[None, 10.0]["beta"] > 0 and sweep[None, 10.0]["alpha_lo"] <= sweep[None, 10.0]["alpha_hi"]


def test_seasonal_naive_beyond_a_year(spark):
    rows = [("a", dt.date(2023, m, 1), float(m)) for m in range(1, 13)]
    got = FC.seasonal_naive(spark.createDataFrame(rows, "k string, ds date, y double"), "k", horizon=18).orderBy("forecast_month").collect()
    assert [r["forecast_cases"] for r in got] == [float(m) for m in [*range(1, 13), *range(1, 7)]]
    assert got[-1]["forecast_month"] == dt.date(2025, 6, 1)


def test_short_series_come_back_with_a_reason(spark):
    rows = [("a", 1, dt.date(2020 + m // 12, m % 12 + 1, 1), 10.0 + m % 12) for m in range(36)] + [("b", 2, dt.date(2024, 1, 1), 1.0)]
    df = spark.createDataFrame(rows, "k string, n int, ds date, y double")
    got = FC.group_forecast(df, ["k", "n"], horizon=15).collect()
    assert len([r for r in got if r["k"] == "a"]) == 15
    short = [r for r in got if r["k"] == "b"]
    assert len(short) == 1 and short[0]["forecast_cases"] is None and "needed" in short[0]["reason"]
    for r in got:
        if r["k"] == "a":
            assert r["forecast_cases"] == pytest.approx(10.0 + r["forecast_month"].month - 1, abs=0.5)
    back = {r["k"]: r for r in FC.backtest(df, ["k", "n"]).collect()}
    assert back["a"]["mape"] < 0.05 and back["b"]["mape"] is None and back["b"]["reason"]
    wide, narrow = (FC.group_forecast(df, ["k", "n"], level=v).where("k = 'a'").agg(F.sum(F.col("forecast_hi") - F.col("forecast_lo"))).first()[0]
                    for v in (0.99, 0.5))
    assert wide >= narrow


@pytest.mark.parametrize("values", [[0.0, 0.001, 0.002, 0.003, 0.004, 0.0], [1e9, 1e9 + 1, 1e9 + 2, 1e9 + 3, 1e9 + 4, 1e9]])
@pytest.mark.parametrize("block", [None, 2])
def test_rolling_z_keeps_small_and_offset_values(spark, values, block):
    rows = [("a", T0 + dt.timedelta(minutes=i), v) for i, v in enumerate(values)]
    z = W.rolling_z(spark.createDataFrame(rows, "k string, ts timestamp_ntz, v double"), "k", "ts", "v", 12, block_rows=block).orderBy("ts").collect()
    step = values[1] - values[0]
    mean, std = values[0] + 2 * step, step * 2.5 ** 0.5
    assert z[5]["z"] == pytest.approx((values[5] - mean) / std, rel=1e-6)


def test_equal_values_have_no_z_and_null_keys_are_a_series(spark):
    rows = [(None, T0 + dt.timedelta(minutes=i), 0.1) for i in range(5)] + [("a", T0 + dt.timedelta(minutes=i), float(i)) for i in range(3)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, v double")
    for block in (None, 2):
        got = W.rolling_z(df, "k", "ts", "v", 3, block_rows=block).collect()
        assert len(got) == 8 and all(r["z"] == 0.0 for r in got if r["k"] is None)


def test_limit_holds_for_the_unrounded_z(spark):
    df = spark.createDataFrame([(3.001, 1.0), (3.0, 1.0), (-3.004, 1.0)], "z double, value double").withColumn(
        "crit_threshold", F.lit(None).cast("double"))
    assert sorted(r["zscore"] for r in W.detect(df).collect()) == [-3.0, 3.0]


def test_null_keys_labels_and_times_stay(spark):
    rows = [(i, None if i % 4 == 0 else "ab"[i % 2], None if i % 8 == 0 else T0 + dt.timedelta(days=i), float(i)) for i in range(40)]
    df = spark.createDataFrame(rows, "id int, label string, ts timestamp_ntz, v double")
    split = stratified_split(df, "id", "label").groupBy("label", "split").count().collect()
    assert sum(r["count"] for r in split) == 40
    assert {(r["label"], r["split"]): r["count"] for r in split}[None, "train"] == 8
    timed = time_split(df, "ts", "id").collect()
    assert len(timed) == 40 and sum(r["split"] == "train" for r in timed) == 32
    assert all(r["split"] == "train" for r in timed if r["ts"] is None)
    stats = entity_stats(df, "label", "v").collect()
    assert len(stats) == 40 and {r["label_cnt"] for r in stats if r["label"] is None} == {10}
    flags = df.withColumn("f", F.lit(1))
    assert {(r["label"], r["n_rows"]) for r in W.episodes(flags.where("ts IS NOT NULL"), "label", "ts", "f").collect()} == {(None, 5), ("a", 10), ("b", 20)}


def test_leave_one_out_statistics(spark):
    df = spark.createDataFrame([("a", 1e9 + v) for v in (1.0, 2.0, 4.0)] + [("b", 7.0)], "k string, v double")
    got = {(r["k"], r["v"]): (r["k_avg"], r["k_cnt"], r["k_std"]) for r in entity_stats(df, "k", "v", leave_one_out=True).collect()}
    assert got["a", 1e9 + 1] == (1e9 + 3, 2, pytest.approx(2 ** 0.5, abs=1e-3))
    assert got["b", 7.0] == (None, 0, 0.0)


def test_pit_counters_for_spans_over_several_buckets(spark):
    hours = [0, 12, 24, 36, 48, 60, 72, 80, 84, 90]
    rows = [(i, "k", T0 + dt.timedelta(hours=h), "pass", 1.0) for i, h in enumerate(hours)]
    df = spark.createDataFrame(rows, "event_id int, instrument_id string, event_ts timestamp_ntz, outcome string, amount double")
    got, want = (sorted((r["event_id"], r["pit_txn_cnt"]) for r in pit_counters(df, seconds=3 * 86400, bucket=b).collect()) for b in ("day", None))
    assert got == want and [n for _, n in got][:7] == [0, 1, 2, 3, 4, 5, 6]


def test_leak_free_training_set(spark):
    rows = [(i, "k", 1, T0 + dt.timedelta(minutes=10 * i), "hard_fail" if i == 2 else "pass", 1.0, "A", int(i == 2)) for i in range(4)]
    spine = spark.createDataFrame(rows, "event_id int, instrument_id string, account_id int, event_ts timestamp_ntz, outcome string, amount double, "
                                        "category_code string, label int")
    empty = spark.createDataFrame([], "account_id int, feature_ts timestamp_ntz, x double")
    profile = spark.createDataFrame([], "account_id int, is_premium int, home_region_code int, acct_balance double")
    got = create_training_set(spine, instrument_counters=None, daily=empty, monthly=empty.withColumnRenamed("x", "y"), profile=profile,
                              leak_free=True, exclude=("instrument_id",)).orderBy("event_id").collect()
    assert [r["pit_fail_cnt"] for r in got] == [0, 0, 0, 1]


def test_asof_null_keys_and_ties(spark):
    spine = spark.createDataFrame([(None, T0), ("a", T0)], "k string, ts timestamp_ntz")
    feats = spark.createDataFrame([(None, T0, 1), ("a", T0, 2), ("a", T0, 5)], "k string, fts timestamp_ntz, v int")
    got = {r["k"]: r["v"] for r in asof_join(spine, [AsOfLookup(feats, ["k"], "fts")], "ts").collect()}
    assert got == {None: None, "a": 5}
    with pytest.raises(ValueError):
        asof_join(spine, [AsOfLookup(feats, ["k"], "fts")], "ts", check_unique=True)


def test_intervals_over_many_days(spark):
    w = spark.createDataFrame([("a", T0, T0 + dt.timedelta(days=5)), ("a", T0, T0 + dt.timedelta(days=5)), ("b", T0, T0), (None, T0, T0)],
                              "k string, start_ts timestamp_ntz, end_ts timestamp_ntz")
    p = spark.createDataFrame([("a", T0 + dt.timedelta(days=d, hours=1), d) for d in range(-1, 6)] + [(None, T0, 9)], "k string, ts timestamp_ntz, v int")
    got = sorted(((r["w"]["k"] or "", r["p"]["v"] if r["p"] else -9) for r in match_intervals(w, p, "k", "ts").collect()))
    assert got == [("", -9)] + sorted([("a", d) for d in range(5)] * 2) + [("b", -9)]


def test_quantiles_of_skewed_and_null_groups(spark):
    rng = random.Random(5)
    rows = [("a" if i % 3 else None, 1e12 if i == 7 else float(rng.choice([0, 0, 0, rng.randint(1, 9999)]))) for i in range(4000)] + [("n", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    want = {r["k"]: r["q"] for r in df.groupBy("k").agg(F.array(*[F.percentile("v", q) for q in (0.0, 0.05, 0.5, 0.97, 1.0)]).alias("q")).collect()}
    got = {r["k"]: r["q"] for r in group_quantiles(df, "k", "v", [0.0, 0.05, 0.5, 0.97, 1.0], rows_each=100).collect()}
    assert got["n"] == [None] * 5
    for k in (None, "a"):
        assert got[k] == pytest.approx(want[k], rel=1e-12)
    disc = group_quantiles(df, "k", "v", [0.1, 0.9], "nearest", rows_each=100)
    ref = {r["k"]: [r["a"], r["b"]] for r in df.groupBy("k").agg(F.expr("percentile_disc(0.1) WITHIN GROUP (ORDER BY v)").alias("a"),
                                                                F.expr("percentile_disc(0.9) WITHIN GROUP (ORDER BY v)").alias("b")).collect()}
    assert {r["k"]: r["q"] for r in disc.collect()} == ref


def test_one_outlier_does_not_fill_a_bucket(spark):
    df = spark.range(20_000).select(F.when(F.col("id") == 0, 1e15).otherwise(F.col("id") / 20_000.0).alias("v"))
    most = df.groupBy(value_buckets(df, "v", rows_each=500)).count().agg(F.max("count")).first()[0]
    assert most < 2_000


def test_no_division_by_zero(spark):
    one = spark.createDataFrame([("p", 1, 0.5), ("p", 1, 0.7), ("m", 0, 0.5), ("m", 1, 0.9)], "g string, label int, score double")
    got = {r["g"]: (r["roc_auc"], r["avg_precision"]) for r in M.ranking_metrics(one, "label", "score", "g").collect()}
    assert got == {"p": (None, 1.0), "m": (1.0, 1.0)}
    assert M.ranking_metrics(one.where("label = 0"), "label", "score").first()["avg_precision"] is None
    flat = spark.createDataFrame([(2.0, None), (2.0, None)], "c double, n double")
    z = apply_scaler(flat, fit_scaler(flat, ["c", "n"]), ["c", "n"]).collect()
    assert [(r["z_c"], r["z_n"]) for r in z] == [(0.0, None)] * 2
    at = spark.createDataFrame([(1.0, T0), (3.0, T0)], "v double, ts timestamp_ntz")
    r = latency_summary(at, "v", "ts").first()
    assert r["per_sec"] is None and r["p50"] == 2.0
    assert pos_weight(one.where("label = 0"), "label").first()["weight"] == 1.0
    zero = spark.createDataFrame([(0.0, 1.0, 2.0)], "y double, naive_last double, train_mean double")
    assert {r["wmape"] for r in FC.leaderboard(zero).collect()} == {None}


def test_pivot_total_and_median_of_all_rows(spark):
    df = spark.createDataFrame([("r", "a"), ("r", "b"), ("r", "z")], "row string, col string")
    assert pivot_counts(df, "row", "col", ["a", "b"]).first()["total"] == 3
    m = impute_median(spark.createDataFrame([(1.0,), (None,), (4.0,)], "v double"), ["v"])
    assert sorted(r["v"] for r in m.collect()) == [1.0, 2.5, 4.0]


def test_drift_out_of_the_range_shows(spark):
    rows = [(T0, 99.0)] * 10 + [(T0 + dt.timedelta(days=1), 250.0)] * 10 + [(T0 + dt.timedelta(days=2), -5.0)] * 10
    got = Q.js_drift(spark.createDataFrame(rows, "ts timestamp_ntz, v double"), "v", "ts", 0.0, 100.0).collect()
    assert [r["js_distance"] for r in got] == [1.0, 1.0]


def test_forest_samples_equal_rows_one_by_one(spark):
    df = spark.range(20_000).select("id", F.when(F.col("id") % 10 > 0, 1.0).otherwise(F.rand(1)).alias("a"), F.lit(2.0).alias("b"))
    forest = IF.fit_iforest(df, ["a", "b"], trees=10, sample_size=64, row_key="id")
    sizes = [r["size"][0] for r in forest.collect()]
    assert len(sizes) == 10 and max(sizes) <= 64 and min(sizes) > 20
    odd = spark.createDataFrame([(None, 2.0), (1.0, 2.0)], "a double, b double")
    scores = [r["anomaly_score"] for r in IF.score_iforest(odd, ["a", "b"], forest).collect()]
    assert scores[0] is None and 0 < scores[1] < 1


def test_cluster_table_keeps_rows_with_nulls(spark):
    df = spark.createDataFrame([(i, float(i % 2) * 10 + i / 100, 1.0 if i else None) for i in range(20)], "id int, a double, b double")
    rows, cents = ML.cluster_table(df, ["a", "b"], k=2)
    got = {r["id"]: r["cluster"] for r in rows.collect()}
    assert len(got) == 20 and got[0] is None and cents.count() == 2


def test_sequence_windows_split_at_a_cutoff(spark):
    rows = [("a", dt.date(2024, 1, 1) + dt.timedelta(days=i), float(i)) for i in range(20)]
    got = W.sequence_windows(spark.createDataFrame(rows, "k string, ds date, y double"), "k", "ds", "y", cutoff="2024-01-12").collect()
    for r in got:
        last = dt.date(2024, 1, 1) + dt.timedelta(days=int(r["target"][-1]))
        first = dt.date(2024, 1, 1) + dt.timedelta(days=int(r["target"][0]))
        assert (r["split"] == "train") == (last <= dt.date(2024, 1, 12)) and (r["split"] == "validation") == (first > dt.date(2024, 1, 12))


def test_lineage_log_finds_tables_behind_tables(spark, tmp_dir):
    spark.range(3).write.parquet(f"{tmp_dir}/raw")
    raw = spark.read.parquet(f"{tmp_dir}/raw")
    Q.log_lineage({"raw": raw}, "mid", f"{tmp_dir}/log")
    log = Q.log_lineage({"mid": raw}, "end", f"{tmp_dir}/log")
    assert sorted((r["source"], r["depth"], r["n_rows"]) for r in Q.upstream(log, "end").collect()) == [("mid", 1, 3), ("raw", 2, 3)]


def test_upsert_is_idempotent_with_null_keys(spark, tmp_dir):
    old = spark.createDataFrame([(None, 1), ("a", 1)], "k string, v int")
    new = spark.createDataFrame([(None, 2), ("b", 2)], "k string, v int")
    once = TB.upsert(old, new, "k")
    assert sorted(TB.upsert(once, new, "k").collect(), key=str) == sorted(once.collect(), key=str)
    assert once.count() == 3
    with pytest.raises(ValueError):
        TB.upsert(old, new.unionByName(new), "k")


def test_failing_ctas_keeps_the_old_table(spark, tmp_dir):
    TB.create_as(spark, "keep_me", "SELECT 1 AS x", f"{tmp_dir}/t")
    with pytest.raises(Exception):
        TB.create_as(spark, "keep_me", "SELECT raise_error('no') AS x", f"{tmp_dir}/t")
    assert spark.table("keep_me").first()["x"] == 1
    TB.create_as(spark, "keep_me", "SELECT 2 AS x", f"{tmp_dir}/t")
    assert spark.table("keep_me").first()["x"] == 2
    spark.sql("DROP TABLE keep_me")


def test_create_as_moves_the_name_in_one_statement(spark, tmp_dir, monkeypatch):
    TB.create_as(spark, "moved", "SELECT 1 AS x, 'a' AS y", f"{tmp_dir}/m")
    said = []
    run = type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, q, *a, **k: (said.append(q), run(self, q, *a, **k))[1])
    assert [tuple(r) for r in TB.create_as(spark, "moved", "SELECT 2 AS x, 'b' AS y", f"{tmp_dir}/m").collect()] == [(2, "b")]
    assert not any(q.startswith(("DROP", "CREATE")) for q in said)
    assert [tuple(r) for r in TB.create_as(spark, "moved", "SELECT 3 AS x", f"{tmp_dir}/m").collect()] == [(3,)]
    spark.sql("DROP TABLE moved")


def test_partitioned_write_leaves_the_session_alone(spark, tmp_dir):
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    df = spark.createDataFrame([(1, T0), (2, T0 + dt.timedelta(days=1))], "v int, ts timestamp_ntz")
    TB.write_partitioned(df, f"{tmp_dir}/p", "ts")
    TB.write_partitioned(df.where("v = 2").withColumn("v", F.lit(9)), f"{tmp_dir}/p", "ts")
    assert sorted(r["v"] for r in spark.read.parquet(f"{tmp_dir}/p").collect()) == [1, 9]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before


def test_rescue_of_misfits_and_broken_lines(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/in")
    with open(f"{tmp_dir}/in/a.json", "w") as f:
        f.write('{"v":"abc","w":1}\nnot json\n{"v":2.5,"x":{"y":1}}\n{"v":null}\n')
    s = SS.bronze_json_stream(spark, f"{tmp_dir}/in", T.StructType.fromDDL("v double, w long"))
    SK.drain(SK.start_append(s, f"{tmp_dir}/out", f"{tmp_dir}/ck"))
    got = sorted(((r["v"], r["w"], json.loads(r["_rescued_data"]) if r["_rescued_data"] else None)
                  for r in spark.read.parquet(f"{tmp_dir}/out").collect()), key=str)
    assert got == sorted([(None, 1, {"v": "abc"}), (None, None, {"_corrupt_record": "not json"}), (2.5, None, {"x": '{"y":1}'}), (None, None, None)], key=str)


def test_fail_rule_ends_a_stream(spark, tmp_dir):
    spark.createDataFrame([(1, 5.0), (2, -1.0)], "id int, v double").write.parquet(f"{tmp_dir}/in")
    s = spark.readStream.schema("id int, v double").parquet(f"{tmp_dir}/in")
    q = SK.start_append(SO.expect_stream(s, [Q.Rule("positive", "v > 0", "fail")]), f"{tmp_dir}/out", f"{tmp_dir}/ck")
    with pytest.raises(Exception, match="positive"):
        SK.drain(q)
    kept = SK.start_append(SO.expect_stream(s, [Q.Rule("any", "v IS NOT NULL", "fail")]), f"{tmp_dir}/out2", f"{tmp_dir}/ck2")
    SK.drain(kept)
    assert spark.read.parquet(f"{tmp_dir}/out2").count() == 2


def test_bus_options_never_fall_back(spark):
    with pytest.raises(ValueError):
        SS.bus_options("sasl_magic", "h:1", user="u", password="p")
    with pytest.raises(ValueError):
        SS.bus_options("scram_sha_512", "h:1", user="u")
    assert SS.bus_options("scram_sha_512", "h:1", user="u", password="p")["kafka.sasl.mechanism"] == "SCRAM-SHA-512"
    assert SS.bus_options("mtls", "h:1", keystore_location="k", keystore_password="p", truststore_location="t",
                          truststore_password="q")["kafka.security.protocol"] == "SSL"
    assert SS.bus_options("iam", "h:1")["kafka.security.protocol"] == "SASL_SSL"


def test_refresh_goes_on_after_a_restart(spark, tmp_dir, sf_dir):
    from mlframe import bindings as B
    first = SO.refresh_loop(spark, lambda: B.payments(spark, sf_dir), f"{tmp_dir}/c", 0.0, 2)
    again = SO.refresh_loop(spark, lambda: B.payments(spark, sf_dir), f"{tmp_dir}/c", 0.0, 1)
    assert [p.rsplit("/", 1)[1] for p in first + again] == ["v=000000", "v=000001", "v=000002"]
    assert sorted(spark.read.parquet(again[0]).collect()) == sorted(spark.read.parquet(first[0]).collect())


def test_late_rows_do_not_use_the_wrong_history(spark, tmp_dir):
    import time
    rows = lambda ts, v: spark.createDataFrame([(i, T0 + dt.timedelta(minutes=m), "a", "x", v, "Good") for i, m in ts], PS.READING_SCHEMA)
    rows([(1, 10), (2, 11), (3, 12)], 1.0).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/in")
    time.sleep(1.2)
    rows([(4, 5), (5, 13)], 2.0).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/in")
    s = spark.readStream.schema(PS.READING_SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{tmp_dir}/in")
    with SK.rocksdb_state(spark):
        query = SK.start_append(SO.stream_rolling_z(s), f"{tmp_dir}/out", f"{tmp_dir}/ck")
    SK.drain(query)
    got = {r["reading_id"]: r for r in spark.read.parquet(f"{tmp_dir}/out").collect()}
    assert got[4]["roll_mean"] is None and got[4]["z"] is None
    assert got[5]["roll_mean"] == 1.0 and got[5]["roll_std"] == 0.0


def test_compacted_update_log_reads_the_same(spark, tmp_dir):
    write = SO.update_log_writer(f"{tmp_dir}/log", "k", compact_every=3)
    newest = {}
    for epoch in range(8):
        batch = [(k, epoch * 10 + k) for k in range(epoch % 4, 5)]
        newest.update(batch)
        write(spark.createDataFrame(batch, "k int, n int"), epoch)
    write(spark.createDataFrame(batch, "k int, n int"), 7)  # a replay
    assert {r["k"]: r["n"] for r in SO.read_update_log(spark, f"{tmp_dir}/log", "k").collect()} == newest
    assert len(os.listdir(f"{tmp_dir}/log/base")) == 2


def test_landing_is_written_by_several_tasks(spark, sf_dir, tmp_dir):
    e, parts = PS._parts(TB.read(spark, sf_dir, "events"), "event_id")
    SS.land(e, f"{tmp_dir}/in", "_part", parts, files=3)
    assert len([n for n in os.listdir(f"{tmp_dir}/in") if n.endswith(".parquet")]) == 9
    assert spark.read.parquet(f"{tmp_dir}/in").count() == e.count()


def test_a_cluster_needs_a_shared_folder():
    from mlframe import session

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(lambda: type("C", (), {"get": staticmethod(lambda *a: None)}))

    class Session:
        sparkContext = Context
        conf = type("C", (), {"get": staticmethod(lambda *a: None)})

    with pytest.raises(ValueError):
        session.ensure_checkpoint_dir(Session)
