"""Analytics with exact oracles: scaling, thresholds, ranking metrics,
survival fits, seasonal forecasts, leaderboards and the graph roll-up
(M1, M3-M7, M18-M22, M26, M27, M29, U3)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from mlframe import bindings as B
from mlframe.operators import forecast as FC
from mlframe.operators import metrics as MT
from mlframe.operators import survival as SV
from mlframe.operators.graph import rollup
from mlframe.operators.models import fit_scaler
from mlframe.operators.sampling import holdout
from mlframe.plans import query
from mlframe.plans.aggregates import joined_once, monthly_demand_df, MONTHLY_DEMAND_SQL, SALES
from mlframe.plans.sql import R

WS = B.cte(ws=B.WIDE_SENSORS_SQL) + ", scores AS (" + B.SENSOR_SCORES_SQL + ")"


@query("standardize", sql=B.cte(ws=B.WIDE_SENSORS_SQL) + " " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {R(f'avg({c})')} AS mean, {R(f'stddev_pop({c})')} AS std FROM ws WHERE is_labeled = 0"
    for c in B.SENSOR_COLS))
def standardize(spark, d):
    """M1: scaler fitted on unlabeled rows only, population std."""
    sc = fit_scaler(B.wide_sensors(spark, d), B.SENSOR_COLS, where="is_labeled = 0")
    return sc.select("column", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


def _thresholds(sc):
    """Fitted thresholds (two numbers): 0.9 x the lowest labelled score, and
    the exact P99 of unlabeled scores found by bucketed order statistics."""
    from mlframe.operators.ranking import exact_quantile
    lo_lab = sc.agg(F.min(F.when(F.col("is_labeled") == 1, F.col("score")))).first()[0]
    p99 = exact_quantile(sc.where("is_labeled = 0"), "score", 0.99)
    return (lo_lab * 0.9 if lo_lab is not None else None), p99


THRESH_SQL = """,
thr AS (SELECT (SELECT min(score) FROM scores WHERE is_labeled = 1) * 0.9 AS fewshot,
               (SELECT quantile_cont(score, 0.99) FROM scores WHERE is_labeled = 0) AS baseline)
"""


@query("fewshot_threshold", sql=WS + THRESH_SQL + f"""
SELECT {R('fewshot')} AS fewshot_threshold, {R('baseline')} AS baseline_p99,
       (SELECT count(*) FROM scores WHERE is_labeled = 1) AS n_labeled FROM thr
""")
def fewshot_threshold(spark, d):
    """M3: 0.9 x the lowest score among labelled failures; baseline = P99 of
    unlabeled scores."""
    sc = B.sensor_scores(spark, d)
    few, base = _thresholds(sc)
    return sc.agg(F.round(F.lit(few).cast("double"), 6).alias("fewshot_threshold"),
                  F.round(F.lit(base).cast("double"), 6).alias("baseline_p99"),
                  F.count_if(F.col("is_labeled") == 1).alias("n_labeled"))


METRICS_SQL = """
SELECT '{name}' AS threshold_kind, count(*) FILTER (WHERE is_failure = 1 AND score >= t) AS tp,
  count(*) FILTER (WHERE is_failure <> 1 AND score >= t) AS fp,
  count(*) FILTER (WHERE is_failure = 1 AND NOT score >= t) AS fn, count(*) AS n,
  {prec} AS precision, {rec} AS recall, {f1} AS f1, {rate} AS alert_rate
FROM scores, (SELECT {col} AS t FROM thr) WHERE holdout = 1
"""


def _metrics_sql(name, col):
    tp = "count(*) FILTER (WHERE is_failure = 1 AND score >= t)"
    fp = "count(*) FILTER (WHERE is_failure <> 1 AND score >= t)"
    fn = "count(*) FILTER (WHERE is_failure = 1 AND NOT score >= t)"
    p = f"CASE WHEN {tp} + {fp} > 0 THEN {tp} / ({tp} + {fp}) ELSE 0 END"
    r = f"CASE WHEN {tp} + {fn} > 0 THEN {tp} / ({tp} + {fn}) ELSE 0 END"
    f1 = f"CASE WHEN ({p}) + ({r}) > 0 THEN 2 * ({p}) * ({r}) / (({p}) + ({r})) ELSE 0 END"
    return METRICS_SQL.format(name=name, col=col, prec=R(p), rec=R(r), f1=R(f1), rate=R(f"({tp} + {fp}) / count(*)"))


@query("threshold_metrics", sql=WS + THRESH_SQL + _metrics_sql("fewshot", "fewshot") + " UNION ALL "
       + _metrics_sql("baseline", "baseline"))
def threshold_metrics(spark, d):
    """M4: precision, recall, F1 and alert rate on held-out rows at both thresholds."""
    sc = B.sensor_scores(spark, d)
    few, base = _thresholds(sc)
    test = sc.where("holdout = 1")
    a = MT.threshold_metrics(test, "is_failure", F.col("score") >= few).withColumn("threshold_kind", F.lit("fewshot"))
    b = MT.threshold_metrics(test, "is_failure", F.col("score") >= base).withColumn("threshold_kind", F.lit("baseline"))
    return a.unionByName(b)


def _auc_sql(score, where="holdout = 1"):
    return f"""
(WITH sc AS (SELECT {score} AS s, CAST(count(*) FILTER (WHERE is_failure = 1) AS DOUBLE) AS pos,
                    CAST(count(*) FILTER (WHERE is_failure <> 1) AS DOUBLE) AS neg FROM scores WHERE {where} GROUP BY 1),
      cum AS (SELECT *, sum(pos) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS pos_cum,
                        sum(neg) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS neg_cum FROM sc),
      tot AS (SELECT sum(pos) AS P, sum(neg) AS N FROM sc)
 SELECT {R('sum(neg * (pos_cum - pos + pos / 2.0)) / (max(P) * max(N))')} AS roc_auc,
        {R('sum(CASE WHEN pos > 0 THEN pos_cum / (pos_cum + neg_cum) * pos END) / max(P)')} AS avg_precision
 FROM cum, tot)"""


@query("roc_pr_auc", sql=WS + " SELECT * FROM " + _auc_sql("score"))
def roc_pr_auc(spark, d):
    """M5: exact ROC-AUC (ties one half) and average precision on held-out rows."""
    sc = B.sensor_scores(spark, d).where("holdout = 1")
    return MT.ranking_metrics(sc, "is_failure", "score")


@query("pr_curve", sql=WS + f""",
sc AS (SELECT score AS s, CAST(count(*) FILTER (WHERE is_failure = 1) AS DOUBLE) AS pos,
              CAST(count(*) FILTER (WHERE is_failure <> 1) AS DOUBLE) AS neg FROM scores WHERE holdout = 1 GROUP BY 1),
cum AS (SELECT *, sum(pos) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS tp,
                  sum(neg) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS fp FROM sc),
tot AS (SELECT sum(pos) AS P, sum(neg) AS N FROM sc)
SELECT s AS threshold, tp, fp, {R('tp / (tp + fp)')} AS precision, {R('tp / P')} AS recall, {R('fp / N')} AS fpr
FROM cum, tot
""")
def pr_curve(spark, d):
    """M6: precision / recall / FPR at every distinct score (descending)."""
    sc = B.sensor_scores(spark, d).where("holdout = 1")
    cp = MT.curve_points(sc, "is_failure", "score")
    P, N = sc.agg(F.count_if(F.col("is_failure") == 1).cast("double"),
                  F.count_if(F.col("is_failure") != 1).cast("double")).first()
    return cp.select(F.col("s").alias("threshold"), F.col("pos_cum").alias("tp"), F.col("neg_cum").alias("fp"),
                     F.round(F.col("pos_cum") / (F.col("pos_cum") + F.col("neg_cum")), 6).alias("precision"),
                     F.round(F.col("pos_cum") / P, 6).alias("recall"), F.round(F.col("neg_cum") / N, 6).alias("fpr"))


@query("recall_by_mode", sql=WS + THRESH_SQL + f""",
flags AS (SELECT failure_mode, 'distance' AS model, CAST(score >= (SELECT fewshot FROM thr) AS INTEGER) AS hit FROM scores WHERE holdout = 1 AND is_failure = 1
          UNION ALL SELECT failure_mode, 'qty_rule', CAST(score_b >= 0.9 AS INTEGER) FROM scores WHERE holdout = 1 AND is_failure = 1)
SELECT failure_mode, model, count(*) AS n_failures, {R('avg(hit)', 6)} AS recall FROM flags GROUP BY ALL
""")
def recall_by_mode(spark, d):
    """M7: recall per failure mode and model on held-out failures."""
    sc = B.sensor_scores(spark, d)
    few, _ = _thresholds(sc)
    f = sc.where("holdout = 1 AND is_failure = 1").select(
        "failure_mode", (F.col("score") >= few).cast("int").alias("distance"),
        (F.col("score_b") >= 0.9).cast("int").alias("qty_rule"))
    long = f.unpivot(["failure_mode"], ["distance", "qty_rule"], "model", "hit")
    return long.groupBy("failure_mode", "model").agg(F.count(F.lit(1)).alias("n_failures"),
                                                      F.round(F.avg("hit"), 6).alias("recall"))


@query("model_leaderboard", sql=WS + """,
m AS (SELECT 'distance' AS model, * FROM """ + _auc_sql("score") + """
      UNION ALL SELECT 'qty_rule', * FROM """ + _auc_sql("score_b") + """)
SELECT model, roc_auc, avg_precision, model = (SELECT arg_max(model, avg_precision) FROM m) AS is_champion FROM m
""")
def model_leaderboard(spark, d):
    """Metrics per model, champion = best average precision."""
    sc = B.sensor_scores(spark, d).where("holdout = 1")
    a = MT.ranking_metrics(sc, "is_failure", "score").withColumn("model", F.lit("distance"))
    b = MT.ranking_metrics(sc, "is_failure", "score_b").withColumn("model", F.lit("qty_rule"))
    m = a.unionByName(b)
    champ = m.agg(F.max_by("model", "avg_precision")).first()[0]
    return m.select("model", "roc_auc", "avg_precision", (F.col("model") == champ).alias("is_champion"))


# ------------------------------------------------------------------ survival

LT = B.cte(lt=B.LIFETIMES_SQL) + """,
cnt AS (SELECT grp, CAST(t AS DOUBLE) AS t, failed AS f, CAST(count(*) AS DOUBLE) AS w FROM lt GROUP BY ALL)"""


def _mle_sql(cnt: str = "cnt", by: str = "grp", cap: float | None = None) -> str:
    def ll(b):
        if cap is None:
            return f"nf * ln({b}) - nf * ln(S / nf) + ({b} - 1) * L - nf"
        a = f"least(pow(S / nf, 1.0 / {b}), {cap!r})"
        return f"nf * ln({b}) - nf * {b} * ln({a}) + ({b} - 1) * L - S / pow({a}, {b})"
    c0, cs, cn = SV.COARSE
    nfine = int(2 * SV.FINE_HALF / SV.FINE_STEP) + 1
    alpha = "pow(S / nf, 1.0 / beta)" if cap is None else f"least(pow(S / nf, 1.0 / beta), {cap!r})"
    return f""",
coarse AS (SELECT {by}, beta, {ll('beta')} AS ll FROM (
  SELECT {by}, {c0!r}::DOUBLE + i * {cs!r}::DOUBLE AS beta, sum(w * f) AS nf, sum(w * f * ln(t)) AS L,
         sum(w * pow(t, {c0!r}::DOUBLE + i * {cs!r}::DOUBLE)) AS S
  FROM {cnt}, range(0, {cn}) r(i) GROUP BY ALL)),
best AS (SELECT {by}, arg_max(beta, ll) AS b0 FROM coarse GROUP BY ALL),
fine AS (SELECT *, {ll('beta')} AS ll FROM (
  SELECT c.{by.replace(', ', ', c.')}, (b0 - {SV.FINE_HALF!r}::DOUBLE) + j * {SV.FINE_STEP!r}::DOUBLE AS beta,
         sum(w * f) AS nf, sum(w * f * ln(t)) AS L, sum(w) AS n,
         sum(w * pow(t, (b0 - {SV.FINE_HALF!r}::DOUBLE) + j * {SV.FINE_STEP!r}::DOUBLE)) AS S
  FROM {cnt} c JOIN best USING ({by}), range(0, {nfine}) r(j)
  WHERE (b0 - {SV.FINE_HALF!r}::DOUBLE) + j * {SV.FINE_STEP!r}::DOUBLE > 0 GROUP BY ALL)),
res AS (SELECT {by}, arg_max(beta, ll) AS beta, arg_max({alpha}, ll) AS alpha, arg_max(nf, ll) AS nf,
               arg_max(n, ll) AS n FROM fine GROUP BY ALL)
"""


def _mle_select(by="grp", cap=None, min_failures=1):
    ok = f"nf >= {min_failures}"
    cols = (f"{by}, CASE WHEN {ok} THEN round(beta, 4) END AS beta, CASE WHEN {ok} THEN {R('alpha', 2)} END AS alpha, "
            f"CASE WHEN {ok} THEN {R(f'alpha * pow({math.log(2)!r}, 1.0 / beta)', 2)} END AS median_life, "
            f"CAST(n AS BIGINT) AS n, CAST(nf AS BIGINT) AS n_failed")
    if cap is not None:
        cols += f", CASE WHEN {ok} THEN {R('alpha', 2)} >= {cap!r} END AS on_cap"
    return f"SELECT {cols} FROM res"


@query("weibull_loglik", sql=LT + _mle_sql() + _mle_select())
def weibull_loglik(spark, d):
    """Censored Weibull MLE per order priority (profile likelihood over beta)."""
    return SV.weibull_mle(B.lifetimes(spark, d), "grp")


@query("weibull_bounded", sql=LT + _mle_sql(cap=30.0) + _mle_select(cap=30.0))
def weibull_bounded(spark, d):
    """Same with alpha capped at 30 (the data's unconstrained alpha is
    above it, so the cap binds and ``on_cap`` shows it)."""
    return SV.weibull_mle(B.lifetimes(spark, d), "grp", alpha_max=30.0)


def _bayes_sql():
    bl, bh, bn = SV.BAYES_BETA
    al, ah, an = SV.BAYES_ALPHA
    bstep, astep = (bh - bl) / (bn - 1), (ah - al) / (an - 1)
    c_beta = math.lgamma(SV.PRIOR_BETA_SHAPE) + SV.PRIOR_BETA_SHAPE * math.log(SV.PRIOR_BETA_SCALE)
    c_alpha = math.log(SV.PRIOR_LN_ALPHA_SD) + 0.5 * math.log(2 * math.pi)
    return f""",
st AS (SELECT grp, {bl!r}::DOUBLE + i * {bstep!r}::DOUBLE AS beta, sum(w * f) AS nf, sum(w * f * ln(t)) AS L,
              sum(w * pow(t, {bl!r}::DOUBLE + i * {bstep!r}::DOUBLE)) AS S
       FROM cnt, range(0, {bn}) r(i) GROUP BY ALL),
g AS (SELECT grp, beta, j, {al!r}::DOUBLE + j * {astep!r}::DOUBLE AS alpha, nf, L, S FROM st, range(0, {an}) r(j)),
lp AS (SELECT *, nf * ln(beta / alpha) + (beta - 1) * (L - nf * ln(alpha)) - S / pow(alpha, beta)
                 + ({SV.PRIOR_BETA_SHAPE - 1!r} * ln(beta) - beta / {SV.PRIOR_BETA_SCALE!r} - {c_beta!r})
                 + (-0.5 * ((ln(alpha) - {SV.PRIOR_LN_ALPHA_MU!r}) / {SV.PRIOR_LN_ALPHA_SD!r})
                         * ((ln(alpha) - {SV.PRIOR_LN_ALPHA_MU!r}) / {SV.PRIOR_LN_ALPHA_SD!r}) - {c_alpha!r}) AS lp FROM g),
u AS (SELECT lp.*, exp(lp - max(lp) OVER (PARTITION BY grp)) AS u FROM lp),
z AS (SELECT grp, sum(u) AS Z, sum(u * beta) AS sb, sum(u * alpha) AS sa FROM u GROUP BY grp),
marg AS (SELECT grp, j, alpha, sum(u) AS m FROM u GROUP BY ALL),
cdf AS (SELECT marg.*, sum(m) OVER (PARTITION BY grp ORDER BY j ROWS UNBOUNDED PRECEDING) / Z AS cdf FROM marg JOIN z USING (grp)),
ci AS (SELECT grp, arg_min(alpha, CASE WHEN cdf >= {SV.CI_LO!r} THEN j END) AS alpha_lo,
              arg_min(alpha, CASE WHEN cdf >= {SV.CI_HI!r} THEN j END) AS alpha_hi FROM cdf GROUP BY grp)
SELECT grp, {R('sb / Z', 3)} AS beta_mean, {R('sa / Z', 2)} AS alpha_mean, {R('alpha_lo', 2)} AS alpha_lo,
       {R('alpha_hi', 2)} AS alpha_hi
FROM z JOIN ci USING (grp)
"""


@query("weibull_bayes", sql=LT + _bayes_sql())
def weibull_bayes(spark, d):
    """Grid posterior (400 x 400) per group with the fixed priors."""
    return SV.weibull_bayes(B.lifetimes(spark, d), "grp")


SWEEP_TIMES = [10.0, 20.0, 30.0, 40.0]


SWEEP_CAP = 30.0
_KEYS = "grp, inspect_t"


def _part(ctes: str, select: str) -> str:
    return "(WITH " + ctes.strip().removeprefix(",") + select + ")"


def _sweep_sql() -> str:
    bounded = _mle_select(by=_KEYS, cap=SWEEP_CAP, min_failures=2).replace("AS beta,", "AS beta_bounded,").replace("AS alpha,", "AS alpha_bounded,")
    return B.cte(lt=B.LIFETIMES_SQL) + """,
x AS (SELECT grp, inspect_t, least(CAST(t AS DOUBLE), inspect_t) AS t,
             CAST(failed = 1 AND t <= inspect_t AS INTEGER) AS failed
      FROM lt, (SELECT unnest([""" + ", ".join(f"{v!r}::DOUBLE" for v in SWEEP_TIMES) + f"""]) AS inspect_t)),
cnt AS (SELECT grp, inspect_t, t, failed AS f, CAST(count(*) AS DOUBLE) AS w FROM x GROUP BY ALL)
SELECT m.*, c.beta_bounded, c.alpha_bounded, c.on_cap, y.beta_mean, y.alpha_mean, y.alpha_lo, y.alpha_hi
FROM {_part(_mle_sql(by=_KEYS), _mle_select(by=_KEYS, min_failures=2))} m
JOIN {_part(_mle_sql(by=_KEYS, cap=SWEEP_CAP), bounded)} c USING ({_KEYS})
JOIN {_part(_bayes_sql().replace("grp", _KEYS), "")} y USING ({_KEYS})
"""


@query("censor_sweep", sql=_sweep_sql())
def censor_sweep(spark, d):
    """Refit at each inspection time with the lifetimes censored there:
    maximum likelihood, scale bounded at 30, and Bayes with its interval."""
    return SV.censor_sweep(B.lifetimes(spark, d), "grp", SWEEP_TIMES, alpha_max=SWEEP_CAP)


# ------------------------------------------------------------------ forecasts

DEMAND = SALES + ", demand AS (" + MONTHLY_DEMAND_SQL.replace(
    "date_trunc('month', s.week) AS ds", "CAST(date_trunc('month', s.week) AS DATE) AS ds") + ")"

NAIVE_SQL = """,
start AS (SELECT CAST(date_trunc('month', max(ds)) + INTERVAL 1 MONTH AS DATE) AS st FROM demand),
ly AS (SELECT brand, region, month(ds) AS mo, avg(y) AS y_ly FROM demand, start
       WHERE ds >= st - INTERVAL 12 MONTH AND ds < st GROUP BY ALL),
fc AS (SELECT brand, region, CAST(st + to_months(CAST((mo - month(st) + 12) % 12 AS INTEGER)) AS DATE) AS forecast_month,
              y_ly AS forecast_cases FROM ly, start WHERE (mo - month(st) + 12) % 12 < 9)
"""


@query("seasonal_naive", sql=DEMAND + NAIVE_SQL + f"""
SELECT brand, region, forecast_month, {R('forecast_cases', 4)} AS forecast_cases,
       {R('forecast_cases * 0.8', 4)} AS forecast_p10, {R('forecast_cases * 1.2', 4)} AS forecast_p90,
       'seasonal_naive' AS method FROM fc
""")
def seasonal_naive(spark, d):
    """Last year's same-month mean, +-20% band, 9 months."""
    fc = FC.seasonal_naive(joined_once(monthly_demand_df(spark, d)), ["brand", "region"])
    return fc.select("brand", "region", "forecast_month", *[F.round(c, 4).alias(c) for c in
                                                            ("forecast_cases", "forecast_p10", "forecast_p90")], "method")


@query("tvf_forecast_demand", sql=DEMAND + NAIVE_SQL + f"""
SELECT brand, region, forecast_month, {R('forecast_cases', 4)} AS forecast_cases,
       {R('forecast_cases * 0.8', 4)} AS forecast_p10, {R('forecast_cases * 1.2', 4)} AS forecast_p90
FROM fc WHERE region = 'EUROPE' AND forecast_month < (SELECT min(forecast_month) FROM fc) + INTERVAL 6 MONTH
""")
def tvf_forecast_demand(spark, d):
    """The forecast behind a SQL table function with optional filters
    (null = all) and a horizon; called with region = EUROPE, 6 months."""
    from mlframe.functions.sql_functions import register_forecast_tvf
    fc = FC.seasonal_naive(joined_once(monthly_demand_df(spark, d)), ["brand", "region"])
    fc = fc.select("brand", "region", "forecast_month", *[F.round(c, 4).alias(c) for c in
                                                          ("forecast_cases", "forecast_p10", "forecast_p90")])
    register_forecast_tvf(spark, fc)
    return spark.sql("SELECT * FROM forecast_demand(region_filter => 'EUROPE', horizon_months => 6)")


@query("forecast_leaderboard", sql=DEMAND + f""",
r AS (SELECT *, row_number() OVER (PARTITION BY brand, region ORDER BY ds DESC) AS rn FROM demand),
tr AS (SELECT brand, region, arg_max(y, ds) AS naive_last, avg(y) AS train_mean FROM r WHERE rn > 6 GROUP BY ALL),
p AS (SELECT r.y, tr.naive_last, tr.train_mean FROM r JOIN tr USING (brand, region) WHERE rn <= 6),
l AS (SELECT y, 'naive_last' AS model, naive_last AS pred FROM p UNION ALL SELECT y, 'train_mean', train_mean FROM p)
SELECT model, {R('avg(CASE WHEN y <> 0 THEN abs(y - pred) / abs(y) END)')} AS mape,
       {R('sum(abs(y - pred)) / sum(abs(y))')} AS wmape, count(*) AS n
FROM l GROUP BY model
""")
def forecast_leaderboard(spark, d):
    """MAPE and WMAPE per model on the 6-month holdout of every series
    (models: last training value, training mean)."""
    dm = holdout(monthly_demand_df(spark, d), ["brand", "region"], "ds", 6)
    tr = dm.where("split = 'train'").groupBy("brand", "region").agg(
        F.max_by("y", "ds").alias("naive_last"), F.avg("y").alias("train_mean"))
    preds = dm.where("split = 'holdout'").join(tr, ["brand", "region"]).select("y", "naive_last", "train_mean")
    return FC.leaderboard(preds)


# ------------------------------------------------------------------ graph


@query("graph_rollup", sql="WITH RECURSIVE " + B.GRAPH_SQL.strip() + """,
paths(src, dst, depth) AS (SELECT src, dst, 1 FROM edges
                           UNION ALL SELECT p.src, e.dst, p.depth + 1 FROM paths p JOIN edges e ON p.dst = e.src)
SELECT v.id, """ + R("coalesce(v.reading, 0) + coalesce(sum(coalesce(s.reading, 0)), 0)", 4) + """ AS total
FROM vertices v LEFT JOIN paths p ON p.dst = v.id LEFT JOIN vertices s ON s.id = p.src
GROUP BY v.id, v.reading
""")
def graph_rollup(spark, d):
    """Readings pushed from customers and suppliers up through nations
    to regions (every path)."""
    v, e = B.graph(spark, d)
    out = rollup(v, e)
    return out.select("id", F.round("total", 4).alias("total"))
