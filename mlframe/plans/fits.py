"""Model fits (2.J): PCA, k-means, forests, boosted trees, isolation forest,
per-series forecasts, 1-NN. Fitted models are checked by properties in the
tests; queries with deterministic answers also carry a DuckDB oracle."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from mlframe import bindings as B
from mlframe.functions import scalar as S
from mlframe.functions.hashing import hash_uniform, hash_uniform_sql
from mlframe.operators import forecast as FC
from mlframe.operators import iforest as IF
from mlframe.operators import ml as ML
from mlframe.operators import windows as W
from mlframe.operators.aggs import entity_stats, pos_weight
from mlframe.operators.models import stamp
from mlframe.plans import query
from mlframe.plans.aggregates import ENTITY_SQL, joined_once
from mlframe.plans.relational import GENRE_TERMS
from mlframe.plans.sql import R
from mlframe.plans.windowed import filled_demand
from mlframe.session import scratch_dir
from mlframe.sources.tables import read


def _scaled_sensors(spark, d):
    from mlframe.operators.models import apply_scaler, fit_scaler
    ws = B.wide_sensors(spark, d)
    sc = fit_scaler(ws, B.SENSOR_COLS, where="is_labeled = 0")
    return apply_scaler(ws, sc, B.SENSOR_COLS)


@query("pca_recon_score")
def pca_recon_score(spark, d):
    """M2: PCA on scaled sensors; reconstruction error per row plus the kept
    variance share (as a column)."""
    z = _scaled_sensors(spark, d)
    zc = [f"z_{c}" for c in B.SENSOR_COLS]
    scored, share = ML.pca_score(z, zc, k=2)
    return scored.select("l_orderkey", "l_linenumber", "is_failure", "pc1", "pc2", "recon_error",
                         F.lit(share).alias("explained_variance"))


@query("kmeans_sweep")
def kmeans_sweep(spark, d):
    """M9: k = 2..10 on the embeddings: inertia, silhouette, CH, DB."""
    e = read(spark, d, "embeddings").select(array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    return ML.kmeans_sweep(e, "features", range(2, 11))


@query("cluster_table")
def cluster_table(spark, d):
    """Cluster labels + 2 principal coordinates on log sensor features."""
    return clustered_sensors(spark, d)[0].select("l_orderkey", "l_linenumber", "cluster", "pc1", "pc2")


@query("cluster_centroids")
def cluster_centroids(spark, d):
    """The centroids of ``cluster_table`` in original units."""
    return clustered_sensors(spark, d)[1]


def clustered_sensors(spark, d):
    """(labelled rows, centroids) of the log sensor features."""
    cols = [f"log_{c}" for c in B.SENSOR_COLS]
    return ML.cluster_table(S.log_columns(B.wide_sensors(spark, d), B.SENSOR_COLS), cols, k=4, log_cols=cols)


def _orders_features(spark, d):
    o = read(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                                  "o_orderpriority"])
    c = read(spark, d, "customer", ["c_custkey", "c_mktsegment", "c_acctbal"])
    f = o.join(c, o.o_custkey == c.c_custkey, "left").select(
        "o_orderkey", "o_orderstatus", "c_mktsegment", "o_totalprice", "c_acctbal",
        F.month("o_orderdate").cast("double").alias("month"),
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").cast("int").alias("label"))
    return f.withColumn("split", F.when(hash_uniform("o_orderkey", lane="split") < 0.8, "train").otherwise("test"))


def _propensity(spark, d, trees: int = 200, depth: int = 12):
    f = ML.spread(_orders_features(spark, d))
    train = f.where("split = 'train'").persist()  # iterative fit: read the input once
    try:
        rows = train.count()
        pipe = ML.propensity_pipeline(["o_orderstatus", "c_mktsegment"], ["o_totalprice", "c_acctbal", "month"], "label",
                                      trees=trees, depth=depth, rows=rows)
        return f, *ML.fit_propensity(pipe, train, rows)
    finally:
        train.unpersist()


@query("propensity_model")
def propensity_model(spark, d):
    """One-hot + numerics -> random forest (200 trees, depth 12);
    held-out AUC and the top-15 importances."""
    f, model, points = _propensity(spark, d)
    auc = ML.held_out_auc(model, f.where("split = 'test'"), "label", points)
    return ML.importances(model, f).withColumn("test_auc", F.lit(auc))


@query("batch_score")
def batch_score(spark, d):
    """Score every order with the fitted model, threshold, stamp, write
    and read back (stamp columns dropped)."""
    f, model, _ = _propensity(spark, d, trees=20, depth=6)
    root = scratch_dir(spark, "scores")
    scored = stamp(ML.score(f, model, 0.5, keep=["o_orderkey"]), "propensity", "1", "run")
    scored.write.mode("overwrite").parquet(root)
    return spark.read.parquet(root).drop("scored_at", "model_run_id")


LOOKUP_SPEC = {"key": "o_orderkey", "sources": [
    {"table": "orders", "on": {"o_orderkey": "o_orderkey"},
     "columns": {"o_orderstatus": "o_orderstatus", "o_totalprice": "o_totalprice", "month": "CAST(month(o_orderdate) AS DOUBLE)", "_cust": "o_custkey"}},
    {"table": "customer", "on": {"_cust": "c_custkey"}, "columns": {"c_mktsegment": "c_mktsegment", "c_acctbal": "c_acctbal"}}]}


@query("lookup_and_score")
def lookup_and_score(spark, d):
    """The model is saved with its lookup spec; scoring gets keys only
    and reads the tables and columns that the loaded spec names."""
    _, model, _ = _propensity(spark, d, trees=20, depth=6)
    root = scratch_dir(spark, "model")
    ML.save_with_lookup(spark, model, root, LOOKUP_SPEC)
    loaded, spec = ML.load_with_lookup(spark, root)
    keys = read(spark, d, "orders", [spec["key"]])
    return ML.score(ML.lookup_features(keys, spec, lambda t: read(spark, d, t)), loaded, 0.5, keep=[spec["key"]])


def _sensor_train_test(spark, d, hold: bool = True):
    ws = pos_weight(B.wide_sensors(spark, d), "is_failure")
    a = ML.assemble(ws, B.SENSOR_COLS).select("features", "is_failure", "weight", "u_split")
    a = ML.spread(a).persist() if hold else a
    return a, a.where("u_split < 0.8"), a.where("u_split >= 0.8")


@query("weighted_classifier")
def weighted_classifier(spark, d):
    """Three boosted-tree configs (shallow; deep + class weight;
    regularised), ranked by held-out average precision."""
    held, tr, te = _sensor_train_test(spark, d)
    configs = {"shallow": {"maxDepth": 3, "maxIter": 10},
               "deep_weighted": {"maxDepth": 6, "maxIter": 10, "weighted": True},
               "regularised": {"maxDepth": 4, "maxIter": 10, "stepSize": 0.05, "subsamplingRate": 0.8}}
    try:
        return ML.fit_compare(tr, te, "is_failure", configs, weight="weight")
    finally:
        held.unpersist()


def _rating_features(spark, d):
    r = entity_stats(joined_once(B.ratings(spark, d)), ["user_id", "item_id"], "rating")
    p = read(spark, d, "part", ["p_partkey", "p_name"]).withColumnRenamed("p_partkey", "item_id")
    r = S.multi_hot(r.join(p, "item_id", "left"), "p_name", GENRE_TERMS).drop("p_name")
    ts = F.timestamp_micros("ts_micros")
    return r.select("*", F.hour(ts).alias("hour"), F.dayofweek(ts).alias("dow"), F.month(ts).alias("month"),
                    F.year(ts).alias("year"))


COUNT_FEATURES_SQL = ENTITY_SQL.replace("FROM ratings r JOIN u USING (user_id) JOIN i USING (item_id)", """
FROM ratings r JOIN u USING (user_id) JOIN i USING (item_id) LEFT JOIN part ON p_partkey = r.item_id""").replace(
    "SELECT r.user_id,", "SELECT " + ", ".join(f"CAST(contains(p_name, '{t}') AS INTEGER) AS g_{t}" for t in GENRE_TERMS)
    + ", CAST(hour(make_timestamp(r.ts_micros)) AS INTEGER) AS hour,"
      " CAST(dayofweek(make_timestamp(r.ts_micros)) + 1 AS INTEGER) AS dow,"
      " CAST(month(make_timestamp(r.ts_micros)) AS INTEGER) AS month,"
      " CAST(year(make_timestamp(r.ts_micros)) AS INTEGER) AS year, r.user_id,", 1)


@query("count_entity_features", sql=COUNT_FEATURES_SQL)
def count_entity_features(spark, d):
    """Entity statistics + calendar parts + genre flags as one feature table."""
    return _rating_features(spark, d)


@query("rating_regressor")
def rating_regressor(spark, d):
    """Boosted trees on the entity features; RMSE and MAE held out."""
    f = _rating_features(spark, d).withColumn("u", hash_uniform("user_id", "item_id", "ts_micros", lane="split"))
    cols = ["user_id_avg", "user_id_cnt", "user_id_std", "item_id_avg", "item_id_cnt", "item_id_std",
            "hour", "dow", "month"] + [f"g_{t}" for t in GENRE_TERMS]
    held = f.select(*cols, "rating", "u").persist()  # columns take less room than vectors
    a = ML.assemble(held, cols).select("features", "rating", "u")
    try:
        return ML.fit_rating(a.where("u < 0.8"), a.where("u >= 0.8"), "rating", iters=10)
    finally:
        held.unpersist()


@query("isolation_forest")
def isolation_forest(spark, d):
    """Isolation forest (150 trees, 256-row samples) on band position
    and rolling z of the readings; top 2% flagged."""
    from mlframe.plans.sensors import scored
    z = scored(spark, d)
    t = B.dim_tag(spark, d).select("tag_id", "normal_low", "normal_high")
    feats = z.join(t, "tag_id").select("reading_id", "tag_id",
                                       S.band_pos("value", "normal_low", "normal_high").alias("band_pos"),
                                       F.col("z").alias("roll_z"))
    forest = IF.fit_iforest(feats, ["band_pos", "roll_z"], trees=150, sample_size=256, row_key="reading_id")
    return IF.flag_top(IF.score_iforest(feats, ["band_pos", "roll_z"], forest), contamination=0.02)


@query("param_search")
def param_search(spark, d):
    """Parallel trials over a small boosted-tree grid."""
    a, tr, _ = _sensor_train_test(spark, d, hold=False)  # the search holds its two parts itself
    return ML.search(tr, "is_failure", {"maxDepth": [2, 4], "stepSize": [0.1, 0.3]}, parallelism=4, rows=a.count())


# ---- fixed values that must equal the reference's: the search space and its trials
SEARCH_SPACE = {"maxDepth": ML.randint(1, 9), "minInstancesPerNode": ML.choice([1, 2, 3]), "subsamplingRate": ML.uniform(0.5, 1.0),
                "stepSize": ML.loguniform(1e-4, 1e-1)}
SEARCH_TRIALS = 10
# -----------------------------------------------------------------------------


@query("random_search")
def random_search(spark, d):
    """Ten random trials, halved twice while the number of trees doubles."""
    a, tr, te = _sensor_train_test(spark, d, hold=False)  # the search holds its two parts itself
    return ML.random_search(tr, te, "is_failure", SEARCH_SPACE, SEARCH_TRIALS, seed=17, whole=a.withColumn("_part", F.expr("u_split < 0.8")))


@query("group_forecast")
def group_forecast(spark, d):
    """A forecast with interval for every (brand, region) series."""
    return FC.group_forecast(filled_demand(spark, d))


@query("holt_winters_backtest")
def holt_winters_backtest(spark, d):
    """6-period holdout MAPE per series (additive, season 12)."""
    return FC.backtest(filled_demand(spark, d))


@query("lag_forecaster")
def lag_forecaster(spark, d):
    """Lag features -> one global boosted-tree regressor; holdout MAPE."""
    from pyspark.ml.regression import GBTRegressor
    from mlframe.operators.sampling import holdout
    f = holdout(W.lag_features(filled_demand(spark, d), ["brand", "region"], "ds", "y"),
                ["brand", "region"], "ds", 6)
    # one row per series and month, made by joins and windows over all sales: written once, as the fit reads it many times
    a = ML.assemble(f, ["lag_1", "lag_2", "lag_3", "lag_12", "month"]).checkpoint(eager=True)
    m = GBTRegressor(labelCol="y", featuresCol="features", maxIter=20, maxDepth=4, seed=42).fit(a.where("split = 'train'"))
    p = m.transform(a.where("split = 'holdout'"))
    return p.groupBy("brand", "region").agg(
        F.avg(F.when(F.col("y") != 0, F.abs(F.col("y") - F.col("prediction")) / F.abs("y"))).alias("mape"),
        F.count(F.lit(1)).alias("n"))


@query("baseline_classifiers")
def baseline_classifiers(spark, d):
    """Logistic regression and a 100-tree forest on three numerics."""
    f = _orders_features(spark, d)
    a = ML.assemble(f, ["o_totalprice", "c_acctbal", "month"]).select("features", "label", "split").persist()
    try:
        return ML.fit_baselines(a.where("split = 'train'"), a.where("split = 'test'"), "label")
    finally:
        a.unpersist()


KNN_SQL = f"""
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label,
                  {hash_uniform_sql('vec_id', 'knn')} < 0.8 AS is_train FROM embeddings),
tr AS (SELECT * FROM e WHERE is_train), te AS (SELECT * FROM e WHERE NOT is_train),
d AS (SELECT te.vec_id AS test_id, tr.vec_id AS nn_id, tr.label AS pred,
             list_sum(list_transform(list_zip(te.v, tr.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS dist
      FROM te, tr)
SELECT test_id, arg_min(nn_id, (dist, nn_id)) AS nn_id, arg_min(pred, (dist, nn_id)) AS pred,
       {R('min(dist)', 4)} AS dist
FROM d GROUP BY test_id
"""


@query("knn1", sql=KNN_SQL)
def knn1(spark, d):
    """Exact 1-NN label for the 20% test embeddings (ties: lowest id)."""
    e = read(spark, d, "embeddings").withColumn("u", hash_uniform("vec_id", lane="knn"))
    out = ML.knn1(e.where("u < 0.8"), e.where("u >= 0.8"), "vec_id", "embedding", "label")
    return out.select("test_id", "nn_id", "pred", F.round("dist", 4).alias("dist"))


@query("knn1_accuracy", sql="WITH k AS (" + KNN_SQL.strip().replace("WITH e AS", "WITH e AS", 1) + f""")
SELECT count(*) AS n, {R('avg(CAST(k.pred = e.label AS DOUBLE))')} AS accuracy FROM k JOIN embeddings e ON e.vec_id = k.test_id
""")
def knn1_accuracy(spark, d):
    """Share of the test embeddings whose neighbour has their label."""
    e = read(spark, d, "embeddings", ["vec_id", "label"]).withColumnRenamed("vec_id", "test_id")
    return knn1(spark, d).join(e, "test_id").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg((F.col("pred") == F.col("label")).cast("double")), 6).alias("accuracy"))


PART_KNN_SQL = f"""
WITH e AS (SELECT p_partkey, 2.0 * p_size AS x, p_retailprice AS y, p_size, {hash_uniform_sql('p_partkey', 'knn')} < 0.8 AS is_train FROM part),
d AS (SELECT te.p_partkey AS test_id, tr.p_partkey AS nn_id, tr.p_size AS pred,
             (te.x - tr.x) * (te.x - tr.x) + (te.y - tr.y) * (te.y - tr.y) AS dist
      FROM (SELECT * FROM e WHERE NOT is_train) te, (SELECT * FROM e WHERE is_train) tr)
"""


def _parts(spark, d):
    e = read(spark, d, "part", ["p_partkey", "p_size", "p_retailprice"]).withColumn("u", hash_uniform("p_partkey", lane="knn"))
    e = e.withColumn("v", F.array(2.0 * F.col("p_size"), F.col("p_retailprice")))
    return e.where("u < 0.8"), e.where("u >= 0.8"), "p_partkey", "v", "p_size", 64


@query("knn1_parts", sql=PART_KNN_SQL + f"""
SELECT test_id, arg_min(nn_id, (dist, nn_id)) AS nn_id, arg_min(pred, (dist, nn_id)) AS pred, {R('min(dist)', 4)} AS dist FROM d GROUP BY test_id
""")
def knn1_parts(spark, d):
    """J14 on two columns: the part of the nearest size and price, where most blocks of training rows are ruled out."""
    return ML.knn1(*_parts(spark, d)).select("test_id", "nn_id", "pred", F.round("dist", 4).alias("dist"))


@query("knn1_work", sql=PART_KNN_SQL + "SELECT count(*) AS pairs, TRUE AS most_skipped FROM d")
def knn1_work(spark, d):
    """Pairs of ``knn1_parts``; fewer than half of them are compared."""
    return ML.knn1_work(*_parts(spark, d)).select("pairs", (F.col("skipped_share") > 0.5).alias("most_skipped"))
