"""Properties of the queries whose exact rows no SQL can give (iterative fits,
sketches, clock-dependent logs): one row per query, counted from its whole
result, against what must hold."""

from __future__ import annotations

from pyspark.sql import functions as F

from mlframe.operators import aggs as A
from mlframe.operators import ml as ML
from mlframe.plans import REGISTRY, query
from mlframe.plans.aggregates import monthly_demand_df
from mlframe.plans.analytics import DEMAND
from mlframe.sources.tables import read


def _of(key, spark, d):
    return REGISTRY[key].fn(spark, d)


def _unit(c):
    return F.every(F.col(c).between(0.0, 1.0))


def _n():
    return F.count(F.lit(1)).alias("n")


@query("daily_event_summary_properties", sql="""
SELECT count(*) AS n, TRUE AS counts_agree, TRUE AS within_bound
FROM (SELECT DISTINCT CAST(ts AS DATE), event_type, user_id % 4 FROM events)
""")
def daily_event_summary_properties(spark, d):
    """Every group is there with its exact event count, and the distinct
    count is within four standard errors of the sketch (5 %)."""
    e = read(spark, d, "events", ["ts", "event_type", "user_id"])
    exact = e.groupBy(F.to_date("ts").alias("event_date"), "event_type", (F.col("user_id") % 4).alias("region")).agg(
        F.count(F.lit(1)).alias("exact_n"), F.count_distinct("user_id").alias("exact"))
    j = _of("daily_event_summary", spark, d).join(exact, ["event_date", "event_type", "region"], "full")
    return j.agg(_n(), F.every(F.col("n_events").eqNullSafe(F.col("exact_n"))).alias("counts_agree"),
                 F.every(F.abs(F.col("approx_users") - F.col("exact")) <= 0.2 * F.col("exact") + 1).alias("within_bound"))


@query("weekly_users_properties", sql="""
SELECT CAST(date_trunc('week', ts) AS DATE) AS week, event_type, user_id % 4 AS region, count(*) AS n_events,
       count(DISTINCT user_id) AS exact_users, TRUE AS within_bound
FROM events GROUP BY ALL
""")
def weekly_users_properties(spark, d):
    """The merged counts of every week, and distinct users within four standard errors of the exact number."""
    e = read(spark, d, "events", ["ts", "event_type", "user_id"])
    exact = e.groupBy(F.to_date(F.date_trunc("week", "ts")).alias("week"), "event_type", (F.col("user_id") % 4).alias("region")).agg(
        F.count_distinct("user_id").alias("exact_users"))
    j = _of("weekly_users", spark, d).join(exact, ["week", "event_type", "region"], "full")
    error = 4 * 1.04 / 2 ** (A.SKETCH_LG / 2)
    near = F.abs(F.col("approx_users") - F.col("exact_users")) <= error * F.col("exact_users") + 1
    return j.select("week", "event_type", "region", "n_events", "exact_users", near.alias("within_bound"))


@query("pca_recon_score_properties", sql="SELECT count(*) AS n, TRUE AS nonnegative, TRUE AS share_is_unit, TRUE AS parts_add_up FROM lineitem")
def pca_recon_score_properties(spark, d):
    """M2: errors are squares, the kept share is a share, and the two
    coordinates and the errors add up to the rows' squared length."""
    p = _of("pca_recon_score", spark, d)
    from mlframe.plans.fits import _scaled_sensors
    z = _scaled_sensors(spark, d)
    cols = [c for c in z.columns if c.startswith("z_")]
    whole = z.agg(F.sum(sum(F.col(c) * F.col(c) for c in cols)).alias("whole"))
    got = p.agg(_n(), F.every(F.col("recon_error") >= -1e-9).alias("nonnegative"), _unit("explained_variance").alias("share_is_unit"),
                F.sum(F.col("pc1") ** 2 + F.col("pc2") ** 2 + len(cols) * F.col("recon_error")).alias("parts"))
    one = F.lit(1).alias("_one")
    both = got.select("*", one).join(whole.select("*", one), "_one")
    return both.select("n", "nonnegative", "share_is_unit", (F.abs(F.col("parts") - F.col("whole")) <= 1e-6 * F.col("whole")).alias("parts_add_up"))


@query("kmeans_sweep_properties", sql="SELECT CAST(9 AS BIGINT) AS n, TRUE AS all_k, TRUE AS inertia_falls, TRUE AS silhouette_in_range FROM embeddings LIMIT 1")
def kmeans_sweep_properties(spark, d):
    """M9: k = 2..10 once each; more clusters leave less inertia; silhouettes are in [-1, 1]."""
    s = _of("kmeans_sweep", spark, d)
    return s.agg(_n(), (F.array_sort(F.collect_set("k")) == F.array(*[F.lit(k) for k in range(2, 11)])).alias("all_k"),
                 (F.max_by("inertia", "k") < F.min_by("inertia", "k")).alias("inertia_falls"),
                 F.every(F.col("silhouette").between(-1.0, 1.0)).alias("silhouette_in_range"))


@query("cluster_table_properties", sql="SELECT count(*) AS n, CAST(4 AS BIGINT) AS n_clusters, CAST(4 AS BIGINT) AS n_centroids, TRUE AS centroids_are_means FROM lineitem")
def cluster_table_properties(spark, d):
    """Every row in one of four clusters, and the centroid table
    holds each cluster's mean log feature in original units."""
    from mlframe import bindings as B
    from mlframe.functions import scalar as S
    ws = S.log_columns(B.wide_sensors(spark, d), B.SENSOR_COLS)
    cols = [f"log_{c}" for c in B.SENSOR_COLS]
    rows, cents = ML.cluster_table(ws, cols, k=4, log_cols=cols)
    means = rows.groupBy("cluster").agg(*[F.expm1(F.avg(c)).alias(f"m_{c}") for c in cols])
    near = F.lit(True)
    for c in cols:  # k-means stops within its tolerance
        near = near & (F.abs(F.col(c) - F.col(f"m_{c}")) <= 0.05 * F.abs(F.col(f"m_{c}")) + 1)
    c = cents.join(means, "cluster").agg(F.count(F.lit(1)).alias("n_centroids"), F.every(near).alias("centroids_are_means"))
    r = rows.agg(_n(), F.count_distinct("cluster").alias("n_clusters"))
    one = F.lit(1).alias("_one")
    return r.select("*", one).join(c.select("*", one), "_one").drop("_one")


@query("cluster_centroids_properties", sql="SELECT CAST(4 AS BIGINT) AS n, TRUE AS whole_numbers, TRUE AS within_data FROM lineitem LIMIT 1")
def cluster_centroids_properties(spark, d):
    """Four centroids, rounded to whole numbers, each between the least and the greatest value of its column."""
    from mlframe import bindings as B
    c = _of("cluster_centroids", spark, d)
    span = B.wide_sensors(spark, d).agg(*[f(x).alias(f"{x}_{f.__name__}") for x in B.SENSOR_COLS for f in (F.min, F.max)])
    one = F.lit(1).alias("_one")
    j = c.select("*", one).join(span.select("*", one), "_one")
    cols = [f"log_{x}" for x in B.SENSOR_COLS]
    within = [F.col(f"log_{x}").between(F.col(f"{x}_min") - 1, F.col(f"{x}_max") + 1) for x in B.SENSOR_COLS]
    return j.agg(_n(), F.every(F.array_max(F.array(*[F.abs(F.col(x) - F.round(x, 0)) for x in cols])) == 0).alias("whole_numbers"),
                 F.every(F.forall(F.array(*within), lambda b: b)).alias("within_data"))


@query("propensity_model_properties", sql="SELECT TRUE AS has_features, TRUE AS shares, TRUE AS auc_in_range FROM orders LIMIT 1")
def propensity_model_properties(spark, d):
    """At most 15 features with importances that are shares, and an AUC."""
    p = _of("propensity_model", spark, d)
    return p.agg(F.count(F.lit(1)).between(1, 15).alias("has_features"),
                 (_unit("importance") & (F.sum("importance") <= 1.0 + 1e-9)).alias("shares"), _unit("test_auc").alias("auc_in_range"))


_SCORED = "SELECT count(*) AS n, count(DISTINCT o_orderkey) AS n_keys, TRUE AS scores, TRUE AS thresholded FROM orders"


def _scored(df):
    return df.agg(_n(), F.count_distinct("o_orderkey").alias("n_keys"), _unit("score").alias("scores"),
                  F.every(F.col("prediction") == (F.col("score") >= 0.5).cast("int")).alias("thresholded"))


@query("batch_score_properties", sql=_SCORED)
def batch_score_properties(spark, d):
    """Every order scored once, by the threshold."""
    return _scored(_of("batch_score", spark, d))


@query("lookup_and_score_properties", sql=_SCORED)
def lookup_and_score_properties(spark, d):
    """Every key scored once from the looked-up features."""
    return _scored(_of("lookup_and_score", spark, d))


@query("weighted_classifier_properties", sql="SELECT CAST(3 AS BIGINT) AS n, TRUE AS in_range, TRUE AS champion_is_best FROM lineitem LIMIT 1")
def weighted_classifier_properties(spark, d):
    """Three configurations with metrics in range; the one champion has the largest average precision and rank 1."""
    won = F.max(F.when(F.col("champion") & (F.col("rank") == 1), F.col("avg_precision")))
    return _of("weighted_classifier", spark, d).agg(_n(), (_unit("roc_auc") & _unit("avg_precision")).alias("in_range"),
                                                    ((won == F.max("avg_precision")) & (F.count_if("champion") == 1)).alias("champion_is_best"))


@query("rating_regressor_properties", sql="SELECT CAST(1 AS BIGINT) AS n, TRUE AS ordered, TRUE AS beats_the_range FROM lineitem LIMIT 1")
def rating_regressor_properties(spark, d):
    """RMSE is at least MAE, and both are below the ratings' range."""
    return _of("rating_regressor", spark, d).agg(_n(), F.every(F.col("rmse") >= F.col("mae")).alias("ordered"),
                                                 F.every((F.col("mae") > 0) & (F.col("rmse") < 5)).alias("beats_the_range"))


@query("isolation_forest_properties", sql="SELECT count(*) AS n, TRUE AS scores, TRUE AS top_share, TRUE AS flags_are_top FROM events")
def isolation_forest_properties(spark, d):
    """Every reading scored; about 2 % flagged; no unflagged score above a flagged one."""
    f = _of("isolation_forest", spark, d)
    high = F.min(F.when(F.col("is_anomaly") == 1, F.col("anomaly_score")))
    low = F.max(F.when(F.col("is_anomaly") == 0, F.col("anomaly_score")))
    share = F.count_if(F.col("is_anomaly") == 1) / F.count("anomaly_score")
    return f.agg(_n(), F.every(F.col("anomaly_score").isNull() | F.col("anomaly_score").between(0.0, 1.0)).alias("scores"),
                 share.between(0.02, 0.05).alias("top_share"), (high > low).alias("flags_are_top"))


@query("param_search_properties", sql="SELECT CAST(4 AS BIGINT) AS n, CAST(4 AS BIGINT) AS n_params, TRUE AS in_range FROM lineitem LIMIT 1")
def param_search_properties(spark, d):
    """Every grid point once with a metric in range."""
    return _of("param_search", spark, d).agg(_n(), F.count_distinct("params").alias("n_params"), _unit("area_under_pr").alias("in_range"))


@query("random_search_properties", sql="""
SELECT CAST(18 AS BIGINT) AS n, CAST(10 AS BIGINT) AS n_trials, TRUE AS drawn_from_the_seed, TRUE AS best_go_on, TRUE AS beats_chance FROM lineitem LIMIT 1
""")
def random_search_properties(spark, d):
    """Ten trials, then five, then three; parameters are the seed's; nobody who goes on is worse than one who
    does not; the winner's average precision is above the share of positives (what chance would give)."""
    import json

    from mlframe.plans import fits
    r = _of("random_search", spark, d)
    want = [json.dumps(p, sort_keys=True) for p in ML.draw_trials(fits.SEARCH_SPACE, fits.SEARCH_TRIALS, 17)]
    drawn = F.every(F.col("params") == F.get(F.array(*[F.lit(w) for w in want]), F.col("trial")))
    rungs = r.groupBy("rung").agg(F.min(F.when(F.col("stays"), F.col("area_under_pr"))).alias("low"), F.max(F.when(~F.col("stays"), F.col("area_under_pr"))).alias("high"))
    _, _, te = fits._sensor_train_test(spark, d, hold=False)  # one pass: nothing to hold
    share = te.agg(F.avg("is_failure").alias("share"))
    won = F.max(F.when((F.col("rung") == 2) & F.col("stays"), F.col("area_under_pr"))).alias("won")
    one = F.lit(1).alias("_one")
    out = (r.agg(_n(), F.count_distinct("trial").alias("n_trials"), drawn.alias("drawn_from_the_seed"), won).select("*", one)
           .join(rungs.agg(F.every(F.col("low") >= F.coalesce("high", F.lit(0.0))).alias("best_go_on")).select("*", one), "_one")
           .join(share.select("*", one), "_one"))
    return out.select("n", "n_trials", "drawn_from_the_seed", "best_go_on", (F.col("won") > F.col("share")).alias("beats_chance"))


_SERIES = DEMAND + """,
len AS (SELECT brand, region, CAST(date_diff('month', min(ds), max(ds)) + 1 AS BIGINT) AS n FROM demand GROUP BY ALL)
"""


@query("group_forecast_properties", sql=_SERIES + """
SELECT brand, region, CAST(CASE WHEN n >= 24 THEN 9 ELSE 1 END AS BIGINT) AS n_rows, n < 24 AS has_reason, TRUE AS inside, TRUE AS later FROM len
""")
def group_forecast_properties(spark, d):
    """Nine later months per series that has two years, one row with a
    reason for the others; the forecast lies in its interval."""
    f = _of("group_forecast", spark, d)
    last = monthly_demand_df(spark, d).groupBy("brand", "region").agg(F.max("ds").alias("last"))
    inside = F.col("forecast_cases").isNull() | ((F.col("forecast_lo") <= F.col("forecast_cases")) & (F.col("forecast_cases") <= F.col("forecast_hi")))
    return f.join(last, ["brand", "region"]).groupBy("brand", "region").agg(
        F.count(F.lit(1)).alias("n_rows"), F.every(F.col("reason").isNotNull()).alias("has_reason"), F.every(inside).alias("inside"),
        F.every(F.coalesce(F.col("forecast_month") > F.col("last"), F.lit(True))).alias("later"))


@query("holt_winters_backtest_properties", sql=_SERIES + "SELECT brand, region, n AS n_points, n < 30 AS too_short, TRUE AS nonnegative FROM len")
def holt_winters_backtest_properties(spark, d):
    """Every series with its gap-free length; those under 24 + 6 months say so."""
    b = _of("holt_winters_backtest", spark, d)
    return b.select("brand", "region", "n_points", F.coalesce(F.col("reason").endswith("needed"), F.lit(False)).alias("too_short"),
                    F.coalesce(F.col("mape") >= 0, F.lit(True)).alias("nonnegative"))


@query("smoothing_fit_properties", sql=_SERIES + "SELECT brand, region, TRUE AS in_the_cube, TRUE AS at_most_the_grid FROM len WHERE n >= 24")
def smoothing_fit_properties(spark, d):
    """Each series' fitted smoothing lies in the unit cube, and its squared error is at most that of the best of 21^3 points."""
    import numpy as np
    import pandas as pd

    from mlframe.operators import forecast as FC
    from mlframe.plans.windowed import filled_demand

    def judge(pdf):
        y = pdf.sort_values("ds")["y"].to_numpy(dtype=float)
        if len(y) < 24:
            return pd.DataFrame({"brand": [], "region": [], "in_the_cube": [], "at_most_the_grid": []}).astype({"in_the_cube": bool, "at_most_the_grid": bool})
        own = FC.fit_smoothing(y, 12)
        grid = np.stack(np.meshgrid(*[np.linspace(0, 1, 21)] * 3, indexing="ij")).reshape(3, -1)
        least = FC.smoothing_errors(y, 12, grid)[0].min()
        return pd.DataFrame({"brand": pdf["brand"].iloc[:1], "region": pdf["region"].iloc[:1], "in_the_cube": [bool(((own >= 0) & (own <= 1)).all())],
                             "at_most_the_grid": [bool(FC.smoothing_errors(y, 12, own[:, None])[0][0] <= least * (1 + 1e-9))]})

    f = filled_demand(spark, d)
    kind = {c: f.schema[c].dataType.simpleString() for c in ("brand", "region")}
    return f.groupBy("brand", "region").applyInPandas(judge, f"brand {kind['brand']}, region {kind['region']}, in_the_cube boolean, at_most_the_grid boolean")


@query("lag_forecaster_properties", sql=_SERIES + "SELECT brand, region, least(n - 12, 6) AS n, TRUE AS nonnegative FROM len WHERE n > 12")
def lag_forecaster_properties(spark, d):
    """The last six months with whole lags of each series are scored."""
    p = _of("lag_forecaster", spark, d)
    return p.select("brand", "region", "n", F.coalesce(F.col("mape") >= 0, F.lit(True)).alias("nonnegative"))


@query("baseline_classifiers_properties", sql="SELECT CAST(2 AS BIGINT) AS n, TRUE AS in_range FROM orders LIMIT 1")
def baseline_classifiers_properties(spark, d):
    """Two models with an AUC."""
    return _of("baseline_classifiers", spark, d).agg(_n(), _unit("roc_auc").alias("in_range"))


@query("freshness_kpi_properties", sql="SELECT CAST(3 AS BIGINT) AS n, TRUE AS ordered, TRUE AS after_events FROM events LIMIT 1")
def freshness_kpi_properties(spark, d):
    """One log row per micro-batch; percentiles in order; nothing is readable before it happened."""
    return _of("freshness_kpi", spark, d).select("n", ((F.col("p10") <= F.col("p50")) & (F.col("p50") <= F.col("p90")) & (F.col("p90") <= F.col("p99"))
                                                       & (F.col("p99") <= F.col("max"))).alias("ordered"), (F.col("p10") > 0).alias("after_events"))
