"""Property tests: operators against brute force on the sf0.001 tables and
small generated frames."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from mlframe import bindings as B
from mlframe.operators import metrics as MT
from mlframe.operators import windows as W
from mlframe.operators.joins import AsOfLookup, asof_join
from mlframe.operators.ranking import positions, running_sums, unit_bucket
from mlframe.operators.sampling import hash_split, stratified_split
from mlframe.sources.tables import read, upsert


def test_asof_matches_brute_force_range_join(spark, sf_dir):
    p = B.payments(spark, sf_dir)
    from mlframe.operators.features import periodic_cache
    daily = periodic_cache(p, grain="day")
    got = asof_join(p.select("event_id", "account_id", "event_ts"),
                    [AsOfLookup(daily, ["account_id"], "feature_ts")], "event_ts", bucket="week")
    # brute force: all earlier feature rows, keep the newest
    s = p.select("event_id", "account_id", "event_ts").alias("s")
    f = daily.alias("f")
    cand = s.join(f, (F.col("s.account_id") == F.col("f.account_id")) & (F.col("f.feature_ts") <= F.col("s.event_ts")), "left")
    w = Window.partitionBy("event_id").orderBy(F.col("f.feature_ts").desc_nulls_last())
    brute = cand.withColumn("r", F.row_number().over(w)).where("r = 1").select("event_id", "acct_daily_cnt")
    a = {r[0]: r[1] for r in got.select("event_id", "acct_daily_cnt").collect()}
    b = {r[0]: r[1] for r in brute.collect()}
    assert len(a) == p.count()
    assert a == b


@pytest.mark.parametrize("bucket", ["day", "week", "month", "year"])
def test_asof_bucket_choice_does_not_change_answer(spark, sf_dir, bucket):
    p = B.payments(spark, sf_dir)
    from mlframe.operators.features import periodic_cache
    daily = periodic_cache(p, grain="day")
    spine = p.select("event_id", "account_id", "event_ts")
    ref = asof_join(spine, [AsOfLookup(daily, ["account_id"], "feature_ts")], "event_ts", bucket="year")
    got = asof_join(spine, [AsOfLookup(daily, ["account_id"], "feature_ts")], "event_ts", bucket=bucket)
    assert sorted(ref.collect()) == sorted(got.collect())


def test_split_is_disjoint_and_covers(spark, sf_dir):
    o = read(spark, sf_dir, "orders", ["o_orderkey"])
    s = hash_split(o, "o_orderkey", 0.8)
    n = o.count()
    assert s.count() == n
    assert s.select("o_orderkey").distinct().count() == n
    frac = s.where("split = 'train'").count() / n
    assert 0.7 < frac < 0.9


def test_stratified_split_keeps_exact_share(spark, sf_dir):
    o = read(spark, sf_dir, "orders", ["o_orderkey", "o_orderstatus"])
    s = stratified_split(o, "o_orderkey", "o_orderstatus", 0.8, buckets=16)
    got = {r[0]: (r[1], r[2]) for r in s.groupBy("o_orderstatus").agg(
        F.count_if(F.col("split") == "train"), F.count(F.lit(1))).collect()}
    for _, (tr, n) in got.items():
        assert tr == round(n * 0.8 + 1e-9) or abs(tr - n * 0.8) <= 0.5


def test_positions_equal_row_number(spark):
    rows = [(i, random.Random(i).random()) for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, u double")
    got = positions(df, [F.col("u"), F.col("id")], unit_bucket("u", 32))
    ref = df.withColumn("ref", F.row_number().over(Window.orderBy("u", "id")))
    j = got.join(ref, ["id", "u"])
    assert j.where("pos <> ref").count() == 0 and j.count() == 2000


def test_running_sums_equal_cumsum(spark):
    rows = [(float(i), i % 3, 1) for i in range(500)]
    df = spark.createDataFrame(rows, "s double, pos int, neg int")
    got = running_sums(df, "s", ["pos", "neg"], F.floor(F.col("s") / 37).cast("int"), descending=True)
    ref = df.withColumn("ref", F.sum("pos").over(Window.orderBy(F.col("s").desc())))
    assert got.join(ref, "s").where("pos_cum <> ref").count() == 0


def test_auc_equals_pair_counting(spark):
    rng = random.Random(7)
    rows = [(rng.randint(0, 1), round(rng.random(), 2)) for _ in range(500)]
    df = spark.createDataFrame(rows, "y int, s double")
    auc = MT.ranking_metrics(df, "y", "s").first()["roc_auc"]
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    num = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    assert auc == pytest.approx(num / (len(pos) * len(neg)), abs=1e-6)


def test_rolling_z_block_halo_equals_plain(spark, sf_dir):
    r = B.readings(spark, sf_dir)
    plain = W.rolling_z(r, "tag_id", "reading_ts", "value", 12).select("reading_id", "z", "roll_mean", "roll_std")
    blocks = W.rolling_z(r, "tag_id", "reading_ts", "value", 12, block_rows=5).select(
        "reading_id", F.col("z").alias("z2"), F.col("roll_mean").alias("m2"), F.col("roll_std").alias("s2"))
    j = plain.join(blocks, "reading_id")
    assert j.count() == r.count()
    assert j.where("abs(z - z2) > 1e-9 OR NOT (roll_mean <=> m2) OR NOT (roll_std <=> s2)").count() == 0


def test_upsert_idempotent(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    u = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    once = upsert(t, u, "k")
    twice = upsert(once, u, "k")
    assert sorted(once.collect()) == sorted(twice.collect()) == [(1, "a"), (2, "B"), (3, "C")]


def test_bayes_posterior_sums_to_one_and_pca_identity(spark, sf_dir):
    import numpy as np
    from mlframe.operators.ml import pca_score
    from mlframe.operators.models import apply_scaler, fit_scaler
    ws = B.wide_sensors(spark, sf_dir)
    z = apply_scaler(ws, fit_scaler(ws, B.SENSOR_COLS), B.SENSOR_COLS)
    cols = [f"z_{c}" for c in B.SENSOR_COLS]
    scored, share = pca_score(z, cols, k=2)
    # mean reconstruction error = (1 - kept share) x total variance per column (data are standardised)
    n = scored.count()
    mean_err = scored.agg(F.avg("recon_error")).first()[0]
    tot = sum(v for v in z.agg(*[F.var_pop(c) for c in cols]).first()) / len(cols)
    assert mean_err == pytest.approx(tot * (1 - share) * (n - 1) / n, rel=2e-2)
    assert 0 < share <= 1 and np.isfinite(share)


def test_graph_root_totals_equal_leaf_sums(spark, sf_dir):
    from mlframe.operators.graph import rollup
    v, e = B.graph(spark, sf_dir)
    tot = {r["id"]: r["total"] for r in rollup(v, e).collect()}
    leaves = v.where("id LIKE 'c%' OR id LIKE 's%'").agg(F.sum("reading")).first()[0]
    roots = sum(t for k, t in tot.items() if k.startswith("r"))
    assert roots == pytest.approx(leaves, abs=1e-6)


def test_knn_matches_brute_force(spark, sf_dir):
    import numpy as np
    from mlframe.operators.ml import knn1
    e = read(spark, sf_dir, "embeddings")
    tr, te = e.where("vec_id % 5 <> 0"), e.where("vec_id % 5 = 0")
    got = {r["test_id"]: r["nn_id"] for r in knn1(tr, te, "vec_id", "embedding", "label", block_rows=16).collect()}
    T = [(r[0], np.array(r[1], dtype=float)) for r in tr.select("vec_id", "embedding").collect()]
    for qid, qv in te.select("vec_id", "embedding").collect():
        qv = np.array(qv, dtype=float)
        best = min(T, key=lambda t: (float(((t[1] - qv) ** 2).sum()), t[0]))[0]
        assert got[qid] == best


def test_arrow_lexicon_equals_python_model(spark, sf_dir):
    from mlframe.functions.text import sentences
    from mlframe.operators.text import doc_summary, infer_sentences, infer_sentences_arrow
    docs = read(spark, sf_dir, "documents", ["doc_id", "text"]).select("doc_id", sentences("text").alias("sentences"))
    a = doc_summary(infer_sentences_arrow(docs)).collect()
    b = doc_summary(infer_sentences(docs)).collect()
    assert sorted(a) == sorted(b) and len(a) == docs.count()


@pytest.mark.parametrize("q", [0.0, 0.1, 0.5, 0.98, 0.99, 1.0])
def test_exact_quantile_equals_percentile(spark, sf_dir, q):
    from mlframe.operators.ranking import exact_quantile
    li = read(spark, sf_dir, "lineitem", ["l_extendedprice"])
    ref = li.agg(F.percentile("l_extendedprice", q)).first()[0]
    assert exact_quantile(li, "l_extendedprice", q, rows_each=100) == pytest.approx(ref, rel=1e-12)


@pytest.mark.parametrize("bucket", ["hour", "day"])
def test_pit_counters_time_halo_equals_plain(spark, sf_dir, bucket):
    from mlframe.operators.features import pit_counters
    p = B.payments(spark, sf_dir)
    cols = ["event_id", "pit_txn_cnt", "pit_fail_cnt", "pit_avg_amount"]
    plain = pit_counters(p, bucket=None).select(*cols)
    halo = pit_counters(p, bucket=bucket).select(*cols)
    assert sorted(plain.collect()) == sorted(halo.collect())


def test_episodes_match_plain_gaps_and_islands(spark, sf_dir):
    r = B.readings(spark, sf_dir).withColumn("flag", (F.col("value") > 60).cast("int"))
    got = W.episodes(r, "tag_id", "reading_ts", "flag", block_rows=7)
    wa = Window.partitionBy("tag_id").orderBy("reading_ts")
    wf = Window.partitionBy("tag_id", "flag").orderBy("reading_ts")
    g = r.select("tag_id", "reading_ts", "flag", (F.row_number().over(wa) - F.row_number().over(wf)).alias("g"))
    ref = g.where("flag = 1").groupBy("tag_id", "g").agg(F.min("reading_ts").alias("start_ts"),
                                                         F.max("reading_ts").alias("end_ts"), F.count("*").alias("n_rows"))
    a = sorted((x["tag_id"], x["start_ts"], x["end_ts"], x["n_rows"]) for x in got.collect())
    b = sorted((x["tag_id"], x["start_ts"], x["end_ts"], x["n_rows"]) for x in ref.collect())
    assert a == b


def test_approx_distinct_within_bound(spark, sf_dir):
    import __spark_entry__ as E
    got = E.queries()["daily_event_summary"](spark, sf_dir)
    e = read(spark, sf_dir, "events", ["ts", "event_type", "user_id"])
    exact = e.groupBy(F.to_date("ts").alias("event_date"), "event_type", (F.col("user_id") % 4).alias("region")) \
        .agg(F.count_distinct("user_id").alias("exact"), F.count(F.lit(1)).alias("n"))
    j = got.join(exact, ["event_date", "event_type", "region"])
    assert j.count() == exact.count() == got.count()
    assert j.where("n_events <> n").count() == 0
    # HyperLogLog++ at 5% relative standard deviation: every group within 4 sigma
    assert j.where("abs(approx_users - exact) > 0.2 * exact + 1").count() == 0


def test_merged_sketches_equal_one_sketch(spark, sf_dir):
    """Sketches merged from days, null users and an empty group among them, estimate as one sketch over all rows does."""
    from mlframe.operators.aggs import distinct_sketches, merge_sketches
    e = read(spark, sf_dir, "events").select(F.to_date("ts").alias("day"), "event_type", F.when(F.col("user_id") % 9 > 0, F.col("user_id")).alias("u"))
    e = e.unionByName(spark.createDataFrame([(None, "silent", None)], e.schema))
    merged = merge_sketches(distinct_sketches(e, ["day", "event_type"], "u"), ["event_type"])
    whole = merge_sketches(distinct_sketches(e, ["event_type"], "u"), ["event_type"])
    exact = {r[0]: r[1] for r in e.groupBy("event_type").agg(F.count_distinct("u")).collect()}
    got = {r["event_type"]: (r["n_events"], r["approx_users"]) for r in merged.collect()}
    assert set(got) == set(exact) and got["silent"] == (1, 0)
    for r in whole.collect():
        n, users = got[r["event_type"]]
        assert n == r["n_events"] and abs(users - exact[r["event_type"]]) <= 0.065 * exact[r["event_type"]] + 1
        assert abs(users - r["approx_users"]) <= 0.02 * r["approx_users"] + 1
