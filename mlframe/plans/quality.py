"""Data quality, monitoring and provenance queries (2.K)."""

from __future__ import annotations

from pyspark.sql import functions as F

from mlframe import bindings as B
from mlframe.operators import drift as DR
from mlframe.operators import quality as Q
from mlframe.operators.metrics import threshold_metrics
from mlframe.operators.models import stamp
from mlframe.plans import query
from mlframe.plans.sql import R
from mlframe.session import scratch_dir
from mlframe.sources.tables import read

PAY = B.cte(payments=B.PAYMENTS_SQL)

RULES = [
    Q.Rule("positive_amount", "amount > 0", "warn"),
    Q.Rule("known_category", "category_code IN ('A', 'B', 'C', 'D', 'E')", "warn"),
    Q.Rule("has_timestamp", "event_ts IS NOT NULL", "drop"),
    Q.Rule("amount_below_99", "amount < 99", "drop"),
]


@query("expectations", sql=PAY + """
SELECT 'positive_amount' AS rule, 'warn' AS action, count(*) FILTER (WHERE NOT coalesce(amount > 0, false)) AS n_violations FROM payments
UNION ALL SELECT 'known_category', 'warn', count(*) FILTER (WHERE NOT coalesce(category_code IN ('A', 'B', 'C', 'D', 'E'), false)) FROM payments
UNION ALL SELECT 'has_timestamp', 'drop', count(*) FILTER (WHERE NOT coalesce(event_ts IS NOT NULL, false)) FROM payments
UNION ALL SELECT 'amount_below_99', 'drop', count(*) FILTER (WHERE NOT coalesce(amount < 99, false)) FROM payments
UNION ALL SELECT '_kept_rows', 'result', count(*) FROM payments WHERE event_ts IS NOT NULL AND amount < 99
""")
def expectations(spark, d):
    """Q1: per-rule violation counts plus the row count kept after drop rules."""
    p = B.payments(spark, d)
    counts = Q.violation_counts(p, RULES)
    kept = Q.expect(p, RULES).agg(F.lit("_kept_rows").alias("rule"), F.lit("result").alias("action"),
                                  F.count(F.lit(1)).alias("n_violations"))
    return counts.unionByName(kept)


@query("invariants", sql=B.cte(sales=B.SALES_SQL, account=B.DIM_ACCOUNT_SQL) + """
SELECT 'row_count_in_range' AS name, n BETWEEN 1000 AND 100000000 AS ok, CAST(n AS DOUBLE) AS value FROM (SELECT count(*) n FROM sales)
UNION ALL SELECT 'weeks_span_at_least_52', v >= 52, CAST(v AS DOUBLE) FROM (SELECT date_diff('day', min(week), max(week)) / 7 v FROM sales)
UNION ALL SELECT 'promo_fraction_between_20_80', v BETWEEN 0.2 AND 0.8, round(v, 6) FROM (SELECT avg(promo_flag) v FROM sales)
UNION ALL SELECT 'keys_complete', v = 0, CAST(v AS DOUBLE) FROM (SELECT count(*) FILTER (WHERE account_id IS NULL OR sku_id IS NULL) v FROM sales)
UNION ALL SELECT 'no_orphan_accounts', v = 0, CAST(v AS DOUBLE) FROM (SELECT count(*) v FROM sales s WHERE NOT EXISTS (SELECT 1 FROM account a WHERE a.account_id = s.account_id))
UNION ALL SELECT 'no_rows_before_launch', v = 0, CAST(v AS DOUBLE) FROM (SELECT count(*) v FROM sales WHERE week < DATE '1994-12-26')
UNION ALL SELECT 'positive_cases', v = 0, CAST(v AS DOUBLE) FROM (SELECT count(*) v FROM sales WHERE cases <= 0)
UNION ALL SELECT 'promo_price_below_regular', v < 1, v
FROM (SELECT round(sum(net_revenue) FILTER (WHERE promo_flag = 1) / sum(cases) FILTER (WHERE promo_flag = 1)
                   / (sum(net_revenue) FILTER (WHERE promo_flag = 0) / sum(cases) FILTER (WHERE promo_flag = 0)), 6) v FROM sales)
""")
def invariants(spark, d):
    """Q2: table-level checks as one (name, ok, value) frame; the fact is
    built and read once, with the accounts it may refer to joined on."""
    def price(flag):
        of = F.col("promo_flag") == flag
        return F.sum(F.when(of, F.col("net_revenue"))) / F.sum(F.when(of, F.col("cases")))
    known = B.dim_account(spark, d).select("account_id", F.lit(True).alias("known"))
    s = B.sales(spark, d).join(known, "account_id", "left")
    rules = [
        ("row_count_in_range", F.count(F.lit(1)), "value BETWEEN 1000 AND 100000000"),
        ("weeks_span_at_least_52", F.datediff(F.max("week"), F.min("week")) / 7, "value >= 52"),
        ("promo_fraction_between_20_80", F.round(F.avg("promo_flag"), 6), "value BETWEEN 0.2 AND 0.8"),
        ("keys_complete", F.count_if(F.col("account_id").isNull() | F.col("sku_id").isNull()), "value = 0"),
        ("no_orphan_accounts", F.count_if(F.col("known").isNull()), "value = 0"),
        ("no_rows_before_launch", F.count_if(F.col("week") < F.lit("1994-12-26").cast("date")), "value = 0"),
        ("positive_cases", F.count_if(F.col("cases") <= 0), "value = 0"),
        ("promo_price_below_regular", F.round(price(1) / price(0), 6), "value < 1"),
    ]
    return Q.invariants(s, rules)


@query("profile_metrics", sql=PAY + f""",
long AS (SELECT CAST(date_trunc('day', event_ts) AS TIMESTAMP) AS window_start, channel AS slice, 'amount' AS "column", CAST(amount AS DOUBLE) AS v FROM payments
         UNION ALL SELECT CAST(date_trunc('day', event_ts) AS TIMESTAMP), channel, 'blocked', CAST(blocked AS DOUBLE) FROM payments)
SELECT window_start, slice, "column", count(*) AS n, count(*) FILTER (WHERE v IS NULL) AS nulls,
       {R('avg(CAST(v IS NULL AS DOUBLE)) * 100', 4)} AS pct_null, {R('avg(v)', 10)} AS mean, count(DISTINCT v) AS distinct
FROM long GROUP BY ALL
UNION ALL
SELECT window_start, '*', "column", count(*), count(*) FILTER (WHERE v IS NULL),
       {R('avg(CAST(v IS NULL AS DOUBLE)) * 100', 4)}, {R('avg(v)', 10)}, count(DISTINCT v)
FROM long GROUP BY window_start, "column"
""")
def profile_metrics(spark, d):
    p = B.payments(spark, d)
    m = Q.profile(p, ["amount", "blocked"], "channel", "event_ts", "day")
    return m.withColumn("mean", F.round("mean", 10))


@query("drift_metrics", sql=PAY + f""",
h AS (SELECT date_trunc('day', event_ts) AS w,
             CASE WHEN amount IS NULL THEN -2 WHEN amount < 0 THEN -1 WHEN amount > 100 THEN 20
                  ELSE CAST(least(greatest(floor((amount - 0.0) / (100.0 - 0.0) * 20), 0), 19) AS INTEGER) END AS bin, count(*) AS c
      FROM payments GROUP BY ALL),
tot AS (SELECT w, sum(c) AS tot FROM h GROUP BY w),
pairs AS (SELECT w, lag(w) OVER (ORDER BY w) AS pw FROM tot),
p AS (SELECT h.w, bin, c / tot AS p FROM h JOIN tot USING (w)),
cur AS (SELECT p.w, pairs.pw, bin, p FROM p JOIN pairs ON p.w = pairs.w WHERE pairs.pw IS NOT NULL),
prv AS (SELECT pairs.w, pairs.pw, bin, p AS q FROM p JOIN pairs ON p.w = pairs.pw),
j AS (SELECT coalesce(cur.w, prv.w) AS w, coalesce(cur.pw, prv.pw) AS pw, coalesce(p, 0) AS p, coalesce(q, 0) AS q
      FROM cur FULL JOIN prv ON cur.w = prv.w AND cur.pw = prv.pw AND cur.bin = prv.bin),
js AS (SELECT w, pw, 0.5 * sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END)
                   + 0.5 * sum(CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) AS jsd FROM j GROUP BY ALL)
SELECT w AS window_start, pw AS prev_window, {R('sqrt(greatest(jsd, 0))', 6)} AS js_distance FROM js
""")
def drift_metrics(spark, d):
    p = B.payments(spark, d)
    return Q.js_drift(p, "amount", "event_ts", 0.0, 100.0, 20, "day")


_STEP, _FAR = DR._scale(DR.ACCURACY)
DRIFT_COLUMNS = ["amount", "blocked"]
DRIFT_REPORT_SQL = PAY + f""",
long AS (SELECT CAST(date_trunc('day', event_ts) AS TIMESTAMP) AS w, 'amount' AS col, CAST(amount AS DOUBLE) AS v FROM payments
         UNION ALL SELECT CAST(date_trunc('day', event_ts) AS TIMESTAMP), 'blocked', CAST(blocked AS DOUBLE) FROM payments),
sk AS (SELECT w, col, CASE WHEN v IS NULL THEN NULL WHEN v = 0 THEN 0
                           ELSE CAST(sign(v) AS BIGINT) * (CAST(ceil(ln(abs(v)) / {_STEP!r}) AS BIGINT) + {_FAR}) END AS key, count(*) AS n FROM long GROUP BY ALL),
bk AS (SELECT col, key, sum(n) AS n FROM sk WHERE w < (SELECT min(w) + INTERVAL 7 DAY FROM sk) GROUP BY ALL),
cum AS (SELECT col, key, sum(n) OVER (PARTITION BY col ORDER BY key) - n AS before, sum(n) OVER (PARTITION BY col) AS total FROM bk WHERE key IS NOT NULL),
edges AS (SELECT col, list(low ORDER BY low) AS lows, max(high) AS top
          FROM (SELECT col, (before * 20) // total AS b, min(key) AS low, max(key) AS high FROM cum GROUP BY ALL) GROUP BY col),
b0 AS (SELECT 'own' AS kind, w, col, key, n FROM sk UNION ALL SELECT 'base', NULL, col, key, n FROM bk),
b1 AS (SELECT kind, w, b0.col, n, CASE WHEN key IS NULL THEN -2 WHEN key < lows[1] THEN -1 WHEN key > top THEN 20
                                      ELSE len(list_filter(lows, lambda x: x <= key)) - 1 END AS bin FROM b0 JOIN edges USING (col)),
h AS (SELECT kind, w, col, bin, sum(n) / sum(sum(n)) OVER (PARTITION BY kind, w, col) AS p FROM b1 GROUP BY kind, w, col, bin),
own AS (SELECT DISTINCT w, col FROM h WHERE kind = 'own'),
pairs AS (SELECT w, col, 'consecutive' AS drift_type, lag(w) OVER (PARTITION BY col ORDER BY w) AS other FROM own
          UNION ALL SELECT w, col, 'baseline', NULL FROM own),
good AS (SELECT * FROM pairs WHERE drift_type = 'baseline' OR other IS NOT NULL),
grid AS (SELECT good.*, bin FROM good, range(-2, 21) r(bin)),
j AS (SELECT g.w, g.col, g.drift_type, g.other, coalesce(a.p, 0) AS p, coalesce(b.p, c.p, 0) AS q
      FROM grid g LEFT JOIN h a ON a.kind = 'own' AND a.w = g.w AND a.col = g.col AND a.bin = g.bin
      LEFT JOIN h b ON g.drift_type = 'consecutive' AND b.kind = 'own' AND b.w = g.other AND b.col = g.col AND b.bin = g.bin
      LEFT JOIN h c ON g.drift_type = 'baseline' AND c.kind = 'base' AND c.col = g.col AND c.bin = g.bin),
js AS (SELECT w, col, drift_type, other, 0.5 * sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END)
                                        + 0.5 * sum(CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) AS jsd FROM j GROUP BY ALL)
SELECT w AS window_start, col AS "column", drift_type, other AS compared_to, {R('sqrt(greatest(jsd, 0))', 6)} AS js_distance FROM js
"""


@query("drift_report", sql=DRIFT_REPORT_SQL)
def drift_report(spark, d):
    """Q4: the drift table of a monitored table: every day against the day
    before and against the stored profile of the first week, for a numeric
    column and a flag, in equal-mass bins of that profile."""
    root = scratch_dir(spark, "drift")
    sketches = DR.column_sketches(B.payments(spark, d), DRIFT_COLUMNS, "event_ts", "day")
    sketches.write.parquet(f"{root}/sketches")
    sketches = spark.read.parquet(f"{root}/sketches")
    week = sketches.agg((F.min("window_start") + F.expr("INTERVAL 7 DAYS")).alias("t"))
    DR.merge_sketches(sketches.where(F.col("window_start") < week.scalar())).write.parquet(f"{root}/baseline")
    return DR.drift_report(sketches, spark.read.parquet(f"{root}/baseline"), 20)


PRED_SQL = """
preds AS (
  SELECT 'order_value' AS model_name, '1' AS model_version, 'r1' AS model_run_id, o_orderdate AS scored_at FROM orders
  UNION ALL SELECT 'order_value', '2', 'r2', o_orderdate FROM orders WHERE o_orderstatus = 'F'
  UNION ALL SELECT 'line_risk', '1', 'r3', l_shipdate FROM lineitem WHERE l_returnflag = 'R')
"""


def _prediction_tables(spark, d):
    o = read(spark, d, "orders", ["o_orderkey", "o_orderdate", "o_orderstatus"])
    li = read(spark, d, "lineitem", ["l_orderkey", "l_shipdate", "l_returnflag"])
    t1 = stamp(o.select("o_orderkey", "o_orderdate"), "order_value", "1", "r1").withColumn("scored_at", F.col("o_orderdate"))
    t2 = stamp(o.where("o_orderstatus = 'F'").select("o_orderkey", "o_orderdate"), "order_value", "2", "r2") \
        .withColumn("scored_at", F.col("o_orderdate"))
    t3 = stamp(li.where("l_returnflag = 'R'").select("l_orderkey", "l_shipdate"), "line_risk", "1", "r3") \
        .withColumn("scored_at", F.col("l_shipdate"))
    return [t1, t2, t3]


@query("provenance_summary", sql="WITH " + PRED_SQL + """
SELECT model_name, model_version, model_run_id, count(*) AS n_rows, max(scored_at) AS last_scored_at FROM preds GROUP BY ALL
""")
def provenance_summary(spark, d):
    """Q5: rows and newest score time per model version and run across three
    prediction tables (their scored_at comes from the scored rows' dates so
    the check is exact)."""
    return Q.provenance(_prediction_tables(spark, d))


@query("lineage_sweep", sql="""
SELECT 'training_set' AS target, 'daily_cache' AS source, 1 AS depth, (SELECT count(DISTINCT (user_id, CAST(ts AS DATE))) FROM events) AS n_rows
UNION ALL SELECT 'training_set', 'customer', 1, (SELECT count(*) FROM customer)
UNION ALL SELECT 'training_set', 'events', 2, (SELECT count(*) FROM events)
""")
def lineage_sweep(spark, d):
    """Q6: two jobs log where their inputs came from; the sweep finds every
    table behind the training set, also those behind its inputs."""
    root = scratch_dir(spark, "lineage")
    events, customer = read(spark, d, "events"), read(spark, d, "customer")
    Q.log_lineage({"events": events}, "daily_cache", f"{root}/log")
    events.select("user_id", F.col("ts").cast("date").alias("day")).distinct().write.parquet(f"{root}/daily_cache")
    log = Q.log_lineage({"daily_cache": spark.read.parquet(f"{root}/daily_cache"), "customer": customer}, "training_set", f"{root}/log")
    return Q.upstream(log, "training_set").select("target", "source", "depth", "n_rows")


@query("quality_by_window", sql=PAY + f"""
SELECT time_bucket(INTERVAL 1 HOUR, event_ts) AS window_start,
  count(*) FILTER (WHERE outcome = 'hard_fail' AND amount > 50) AS tp,
  count(*) FILTER (WHERE outcome <> 'hard_fail' AND amount > 50) AS fp,
  count(*) FILTER (WHERE outcome = 'hard_fail' AND NOT amount > 50) AS fn, count(*) AS n,
  {R("CASE WHEN count(*) FILTER (WHERE amount > 50) > 0 THEN count(*) FILTER (WHERE outcome = 'hard_fail' AND amount > 50) / count(*) FILTER (WHERE amount > 50) ELSE 0 END")} AS precision,
  {R("CASE WHEN count(*) FILTER (WHERE outcome = 'hard_fail') > 0 THEN count(*) FILTER (WHERE outcome = 'hard_fail' AND amount > 50) / count(*) FILTER (WHERE outcome = 'hard_fail') ELSE 0 END")} AS recall,
  {R("count(*) FILTER (WHERE amount > 50) / count(*)")} AS alert_rate, {R('avg(amount)', 6)} AS mean_amount
FROM payments GROUP BY 1
""")
def quality_by_window(spark, d):
    """Q7: label-based quality of a rule (amount > 50 flags a failure) and the
    mean input per 1-hour window."""
    return _by_window(spark, d, "1 hour")


def _by_window(spark, d, grain):
    p = B.payments(spark, d).withColumn("label", (F.col("outcome") == "hard_fail").cast("int"))
    p = p.withColumn("window_start", F.window("event_ts", grain).start.cast("timestamp_ntz"))
    m = threshold_metrics(p, "label", F.col("amount") > 50, by="window_start")
    mean = p.groupBy("window_start").agg(F.round(F.avg("amount"), 6).alias("mean_amount"))
    return m.drop("f1").join(mean, "window_start")


@query("quality_by_5_minutes", sql=PAY + f"""
SELECT time_bucket(INTERVAL 5 MINUTE, event_ts) AS window_start,
  count(*) FILTER (WHERE outcome = 'hard_fail' AND amount > 50) AS tp,
  count(*) FILTER (WHERE outcome <> 'hard_fail' AND amount > 50) AS fp,
  count(*) FILTER (WHERE outcome = 'hard_fail' AND NOT amount > 50) AS fn, count(*) AS n,
  {R("CASE WHEN count(*) FILTER (WHERE amount > 50) > 0 THEN count(*) FILTER (WHERE outcome = 'hard_fail' AND amount > 50) / count(*) FILTER (WHERE amount > 50) ELSE 0 END")} AS precision,
  {R("CASE WHEN count(*) FILTER (WHERE outcome = 'hard_fail') > 0 THEN count(*) FILTER (WHERE outcome = 'hard_fail' AND amount > 50) / count(*) FILTER (WHERE outcome = 'hard_fail') ELSE 0 END")} AS recall,
  {R("count(*) FILTER (WHERE amount > 50) / count(*)")} AS alert_rate, {R('avg(amount)', 6)} AS mean_amount
FROM payments GROUP BY 1
""")
def quality_by_5_minutes(spark, d):
    """Q7 at the finer grain."""
    return _by_window(spark, d, "5 minutes")


@query("drift_by_hour", sql=PAY + f""",
h AS (SELECT time_bucket(INTERVAL 1 HOUR, event_ts) AS w,
             CASE WHEN amount IS NULL THEN -2 WHEN amount < 0 THEN -1 WHEN amount > 100 THEN 20
                  ELSE CAST(least(greatest(floor((amount - 0.0) / (100.0 - 0.0) * 20), 0), 19) AS INTEGER) END AS bin, count(*) AS c
      FROM payments GROUP BY ALL),
tot AS (SELECT w, sum(c) AS tot FROM h GROUP BY w),
pairs AS (SELECT w, lag(w) OVER (ORDER BY w) AS pw FROM tot),
p AS (SELECT h.w, bin, c / tot AS p FROM h JOIN tot USING (w)),
cur AS (SELECT p.w, pairs.pw, bin, p FROM p JOIN pairs ON p.w = pairs.w WHERE pairs.pw IS NOT NULL),
prv AS (SELECT pairs.w, pairs.pw, bin, p AS q FROM p JOIN pairs ON p.w = pairs.pw),
j AS (SELECT coalesce(cur.w, prv.w) AS w, coalesce(cur.pw, prv.pw) AS pw, coalesce(p, 0) AS p, coalesce(q, 0) AS q
      FROM cur FULL JOIN prv ON cur.w = prv.w AND cur.pw = prv.pw AND cur.bin = prv.bin),
js AS (SELECT w, pw, 0.5 * sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END)
                   + 0.5 * sum(CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) AS jsd FROM j GROUP BY ALL)
SELECT w AS window_start, pw AS prev_window, {R('sqrt(greatest(jsd, 0))', 6)} AS js_distance FROM js
""")
def drift_by_hour(spark, d):
    """Q7: drift of the input between consecutive 1-hour windows that have rows."""
    return Q.js_drift(B.payments(spark, d), "amount", "event_ts", 0.0, 100.0, 20, "1 hour")
