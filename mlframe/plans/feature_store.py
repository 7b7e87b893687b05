"""Feature-store queries: counters, caches, lookups, training set."""

from __future__ import annotations

from pyspark.sql import functions as F

from mlframe import bindings as B
from mlframe.functions import scalar as S
from mlframe.operators import features as FT
from mlframe.operators.joins import AsOfLookup, asof_join, full_universe, lookup
from mlframe.plans import query
from mlframe.plans.sql import R
from mlframe.sources.tables import read

PAY = B.cte(payments=B.PAYMENTS_SQL)

DAILY_SQL = f"""
SELECT account_id, count(*) AS acct_daily_cnt,
       {R('avg(amount)', 4)} AS acct_daily_avg_amount,
       {R('avg(CAST(blocked AS DOUBLE))', 4)} AS acct_daily_block_rate,
       count(*) FILTER (WHERE outcome = 'soft_fail') AS acct_daily_softfail_cnt,
       CAST(CAST(event_ts AS DATE) + INTERVAL 1 DAY AS TIMESTAMP) AS feature_ts
FROM payments GROUP BY account_id, CAST(event_ts AS DATE)
"""

MONTHLY_SQL = f"""
SELECT account_id, count(*) AS acct_monthly_cnt,
       {R('avg(amount)', 4)} AS acct_monthly_avg_amount,
       {R('avg(CAST(blocked AS DOUBLE))', 4)} AS acct_monthly_block_rate,
       CAST(date_trunc('month', event_ts) + INTERVAL 1 MONTH AS TIMESTAMP) AS feature_ts
FROM payments GROUP BY account_id, date_trunc('month', event_ts)
"""

COUNTERS_SQL = f"""
SELECT instrument_id, count(*) AS inst_txn_cnt,
       count(*) FILTER (WHERE outcome = 'hard_fail') AS inst_fail_cnt,
       count(DISTINCT account_id) AS inst_distinct_accounts,
       {R('avg(amount)', 2)} AS inst_avg_amount, max(amount) AS inst_max_amount,
       {R("count(*) FILTER (WHERE outcome = 'hard_fail') / count(*)", 4)} AS inst_fail_ratio
FROM payments GROUP BY instrument_id
"""

PROFILE_SQL = """
SELECT account_id, CAST(account_tier = 'premium' AS INTEGER) AS is_premium,
       CAST(replace(home_region, 'r', '') AS INTEGER) AS home_region_code, acct_balance
FROM profile_raw
"""

def odf_sql(a: str = "") -> str:
    return f"""
{R(f'ln(1 + coalesce({a}amount, 0))')} AS odf_log_amount,
coalesce(CAST(hour({a}event_ts) >= 23 OR hour({a}event_ts) < 6 AS INTEGER), 0) AS odf_is_night,
CAST(coalesce({a}amount, 0) > 500 AS INTEGER) AS odf_high_amount,
coalesce(list_position(['A','B','C','D','E'], {a}category_code) - 1, -1) AS odf_category_ordinal
"""


ODF_SQL = odf_sql()


def _round_odf(df):
    return df.withColumn("odf_log_amount", F.round("odf_log_amount", 6))


@query("scan_table", sql="SELECT l_orderkey, l_partkey, l_quantity, l_shipdate FROM lineitem WHERE l_quantity > 25")
def scan_table(spark, d):
    """Pruned scan; the filter and the 4-column ReadSchema reach parquet."""
    return read(spark, d, "lineitem", ["l_orderkey", "l_partkey", "l_quantity", "l_shipdate"]).where("l_quantity > 25")


@query("entity_counters", sql=PAY + ", p AS (SELECT * FROM payments)\n" + COUNTERS_SQL)
def entity_counters(spark, d):
    return FT.entity_counters(B.payments(spark, d))


@query("account_daily_cache", sql=PAY + DAILY_SQL)
def account_daily_cache(spark, d):
    return FT.periodic_cache(B.payments(spark, d), grain="day")


@query("account_monthly_cache", sql=PAY + MONTHLY_SQL)
def account_monthly_cache(spark, d):
    return FT.periodic_cache(B.payments(spark, d), grain="month")


@query("last_hour_counters", sql=PAY + f""",
recent AS (SELECT * FROM payments WHERE event_ts >= (SELECT max(event_ts) FROM payments) - INTERVAL 1 HOUR),
agg AS ({COUNTERS_SQL.replace('FROM payments', 'FROM recent')})
SELECT u.instrument_id, coalesce(inst_txn_cnt, 0) AS inst_txn_cnt, coalesce(inst_fail_cnt, 0) AS inst_fail_cnt,
       coalesce(inst_distinct_accounts, 0) AS inst_distinct_accounts, coalesce(inst_avg_amount, 0) AS inst_avg_amount,
       coalesce(inst_max_amount, 0) AS inst_max_amount, coalesce(inst_fail_ratio, 0) AS inst_fail_ratio
FROM (SELECT DISTINCT instrument_id FROM payments) u LEFT JOIN agg USING (instrument_id)
""")
def last_hour_counters(spark, d):
    return FT.rolling_counters(B.payments(spark, d))


@query("universe_reset", sql=PAY + f""",
agg AS (SELECT account_id, count(*) AS n_last_day, {R('sum(amount)', 2)} AS amount_last_day
        FROM payments WHERE event_ts >= TIMESTAMP '2024-01-30 00:00:00' GROUP BY account_id)
SELECT u.account_id, coalesce(n_last_day, 0) AS n_last_day, coalesce(amount_last_day, 0) AS amount_last_day
FROM (SELECT DISTINCT account_id FROM payments) u LEFT JOIN agg USING (account_id)
""")
def universe_reset(spark, d):
    p = B.payments(spark, d)
    agg = (p.where(F.col("event_ts") >= F.lit("2024-01-30 00:00:00").cast("timestamp_ntz"))
           .groupBy("account_id").agg(F.count(F.lit(1)).alias("n_last_day"),
                                      F.round(F.sum("amount"), 2).alias("amount_last_day")))
    return full_universe(p, agg, "account_id")


@query("asof_lookup", sql=PAY + f", daily AS ({DAILY_SQL})" + """
SELECT p.event_id, p.account_id, p.event_ts, d.acct_daily_cnt, d.acct_daily_avg_amount,
       d.acct_daily_block_rate, d.acct_daily_softfail_cnt
FROM payments p ASOF LEFT JOIN daily d ON p.account_id = d.account_id AND p.event_ts >= d.feature_ts
""")
def asof_lookup(spark, d):
    p = B.payments(spark, d).select("event_id", "account_id", "event_ts")
    daily = FT.periodic_cache(B.payments(spark, d), grain="day")
    return asof_join(p, [AsOfLookup(daily, ["account_id"], "feature_ts")], "event_ts", bucket="week")


@query("latest_lookup", sql=PAY + f", counters AS ({COUNTERS_SQL})" + """
SELECT p.event_id, c.inst_txn_cnt, c.inst_fail_cnt, c.inst_avg_amount
FROM payments p LEFT JOIN counters c ON p.instrument_id = c.instrument_id
""")
def latest_lookup(spark, d):
    p = B.payments(spark, d)
    counters = FT.entity_counters(p)
    return lookup(p.select("event_id", "instrument_id"), counters, "instrument_id",
                  ["inst_txn_cnt", "inst_fail_cnt", "inst_avg_amount"]).drop("instrument_id")


TRAINING_SQL = B.cte(payments=B.PAYMENTS_SQL, profile_raw=B.PROFILE_RAW_SQL) + f""",
spine AS (SELECT event_id, instrument_id, account_id, category_code, event_ts, amount,
                 CAST(outcome = 'hard_fail' AS INTEGER) AS label FROM payments),
daily AS ({DAILY_SQL}), monthly AS ({MONTHLY_SQL}), counters AS ({COUNTERS_SQL}), prof AS ({PROFILE_SQL})
SELECT s.event_id, s.amount, s.label,
       d.acct_daily_cnt, d.acct_daily_avg_amount, d.acct_daily_block_rate, d.acct_daily_softfail_cnt,
       m.acct_monthly_cnt, m.acct_monthly_avg_amount, m.acct_monthly_block_rate,
       c.inst_txn_cnt, c.inst_fail_cnt, c.inst_fail_ratio, c.inst_distinct_accounts, c.inst_avg_amount,
       c.inst_max_amount, pr.is_premium, pr.home_region_code, pr.acct_balance,
       {odf_sql('s.')}
FROM spine s
ASOF LEFT JOIN daily d ON s.account_id = d.account_id AND s.event_ts >= d.feature_ts
ASOF LEFT JOIN monthly m ON s.account_id = m.account_id AND s.event_ts >= m.feature_ts
LEFT JOIN counters c ON s.instrument_id = c.instrument_id
LEFT JOIN prof pr ON s.account_id = pr.account_id
"""


def training_set_df(spark, d, bucket: str = "month"):
    p = B.payments(spark, d)
    spine = p.select("event_id", "instrument_id", "account_id", "category_code", "event_ts", "amount",
                     (F.col("outcome") == "hard_fail").cast("int").alias("label"))
    prof = S.encode_profile(B.profile_raw(spark, d))
    out = FT.create_training_set(
        spine, instrument_counters=FT.entity_counters(p),
        daily=FT.periodic_cache(p, grain="day"), monthly=FT.periodic_cache(p, grain="month"),
        profile=prof, bucket=bucket)
    return _round_odf(out)


@query("training_set", sql=TRAINING_SQL)
def training_set(spark, d):
    """J9 flagship: point-in-time training set."""
    return training_set_df(spark, d)


@query("on_demand_features", sql=PAY + f"SELECT event_id, {ODF_SQL} FROM payments")
def on_demand_features(spark, d):
    p = B.payments(spark, d)
    return _round_odf(S.on_demand(p).select("event_id", "odf_log_amount", "odf_is_night",
                                            "odf_high_amount", "odf_category_ordinal"))


@query("sql_scalar_udf", sql=PAY + f"SELECT event_id, {ODF_SQL} FROM payments")
def sql_scalar_udf(spark, d):
    """U4: the on-demand features as registered SQL functions, called from SQL."""
    S.register_on_demand(spark)
    B.payments(spark, d).createOrReplaceTempView("payments_v")
    return spark.sql("""
        SELECT event_id, round(odf_log_amount(amount), 6) AS odf_log_amount,
               odf_is_night(event_ts) AS odf_is_night, odf_high_amount(amount) AS odf_high_amount,
               odf_category_ordinal(category_code) AS odf_category_ordinal
        FROM payments_v""")


@query("profile_encode", sql=B.cte(profile_raw=B.PROFILE_RAW_SQL) + PROFILE_SQL)
def profile_encode(spark, d):
    return S.encode_profile(B.profile_raw(spark, d)).select(
        "account_id", "is_premium", "home_region_code", "acct_balance")


@query("pit_counters", sql=PAY + f"""
SELECT event_id, instrument_id,
  count(*) OVER w AS pit_txn_cnt,
  CAST(coalesce(sum(CAST(outcome = 'hard_fail' AS INTEGER)) OVER w, 0) AS BIGINT) AS pit_fail_cnt,
  {R('avg(amount) OVER w', 4)} AS pit_avg_amount
FROM payments
WINDOW w AS (PARTITION BY instrument_id ORDER BY epoch_us(event_ts)
             RANGE BETWEEN 3600000000 PRECEDING AND 1 PRECEDING)
""")
def pit_counters(spark, d):
    p = B.payments(spark, d)
    return FT.pit_counters(p).select("event_id", "instrument_id", "pit_txn_cnt", "pit_fail_cnt", "pit_avg_amount")


@query("period_bounds", sql=PAY + """
SELECT event_id, CAST(event_ts AS DATE) AS day_start, CAST(event_ts AS DATE) + 1 AS next_day,
       CAST(date_trunc('month', event_ts) AS DATE) AS month_start,
       CAST(date_trunc('month', event_ts) + INTERVAL 1 MONTH AS DATE) AS next_month
FROM payments
""")
def period_bounds(spark, d):
    p = B.payments(spark, d)
    return p.select("event_id", S.period_start(F.col("event_ts"), "day").alias("day_start"),
                    S.period_end(F.col("event_ts"), "day").alias("next_day"),
                    S.period_start(F.col("event_ts"), "month").alias("month_start"),
                    S.period_end(F.col("event_ts"), "month").alias("next_month"))
