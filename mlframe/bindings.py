"""Data bindings: which driver table plays which role of the reference's
pipelines. Each binding has a DataFrame form and a DuckDB SQL twin used by
the oracles (``*_SQL`` strings, meant to be used as CTE bodies)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mlframe.functions.hashing import hash_uniform, hash_uniform_sql
from mlframe.operators.ranking import group_quantiles
from mlframe.sources.tables import read

# ---------------------------------------------------------------- payments
# instrument = user, account = user % 20, category letter A..F from the user,
# outcome from the event type (error -> hard_fail, signup -> soft_fail).


def payments(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events", ["event_id", "ts", "user_id", "event_type", "value", "props"])
    return e.select(
        F.col("event_id"),
        F.col("ts").alias("event_ts"),
        F.col("user_id").alias("instrument_id"),
        (F.col("user_id") % 20).alias("account_id"),
        F.element_at(F.array(*[F.lit(c) for c in "ABCDEF"]), (F.col("user_id") % 6 + 1).cast("int")).alias("category_code"),
        F.col("event_type").alias("channel"),
        F.col("value").alias("amount"),
        F.when(F.col("event_type") == "error", "hard_fail")
         .when(F.col("event_type") == "signup", "soft_fail").otherwise("pass").alias("outcome"),
        (F.col("event_type") == "error").cast("int").alias("blocked"),
        F.col("props"),
    )


PAYMENTS_SQL = """
SELECT event_id, ts AS event_ts, user_id AS instrument_id, user_id % 20 AS account_id,
       ['A','B','C','D','E','F'][CAST(user_id % 6 AS INTEGER) + 1] AS category_code,
       event_type AS channel, value AS amount,
       CASE WHEN event_type = 'error' THEN 'hard_fail'
            WHEN event_type = 'signup' THEN 'soft_fail' ELSE 'pass' END AS outcome,
       CAST(event_type = 'error' AS INTEGER) AS blocked, props
FROM events
"""

# ---------------------------------------------------------------- profile


def profile_raw(spark: SparkSession, d: str) -> DataFrame:
    c = read(spark, d, "customer", ["c_custkey", "c_nationkey", "c_acctbal"])
    return c.select(
        F.col("c_custkey").alias("account_id"),
        F.when(F.col("c_acctbal") > 5000, "premium").otherwise("standard").alias("account_tier"),
        F.concat(F.lit("r"), (F.col("c_nationkey") % 4 + 1).cast("string")).alias("home_region"),
        F.col("c_acctbal").alias("acct_balance"),
    )


PROFILE_RAW_SQL = """
SELECT c_custkey AS account_id,
       CASE WHEN c_acctbal > 5000 THEN 'premium' ELSE 'standard' END AS account_tier,
       'r' || CAST(c_nationkey % 4 + 1 AS VARCHAR) AS home_region,
       c_acctbal AS acct_balance
FROM customer
"""

# ---------------------------------------------------------------- sensor readings
# tag = event type x (user % 10): 50 series; quality codes from a hash lane.


def readings(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    u = hash_uniform("event_id", lane="quality")
    return e.select(
        F.col("event_id").alias("reading_id"),
        F.col("ts").alias("reading_ts"),
        F.concat_ws("_", "event_type", (F.col("user_id") % 10).cast("string")).alias("tag_id"),
        F.concat(F.lit("asset_"), (F.col("user_id") % 10).cast("string")).alias("asset_id"),
        F.col("value"),
        F.when(u < 0.001, "Bad").when(u < 0.004, "Uncertain").otherwise("Good").alias("quality_code"),
    )


READINGS_SQL = f"""
SELECT event_id AS reading_id, ts AS reading_ts,
       event_type || '_' || CAST(user_id % 10 AS VARCHAR) AS tag_id,
       'asset_' || CAST(user_id % 10 AS VARCHAR) AS asset_id, value,
       CASE WHEN {hash_uniform_sql('event_id', 'quality')} < 0.001 THEN 'Bad'
            WHEN {hash_uniform_sql('event_id', 'quality')} < 0.004 THEN 'Uncertain' ELSE 'Good' END AS quality_code
FROM events
"""


def dim_tag(spark: SparkSession, d: str) -> DataFrame:
    """Per tag normal band (P05, P95), warn (P97), crit (P99), exact, rounded 4."""
    r = readings(spark, d).select("tag_id", "asset_id", "value")
    q = group_quantiles(r, "tag_id", "value", [0.05, 0.95, 0.97, 0.99])
    bands = ("normal_low", "normal_high", "warn_threshold", "crit_threshold")
    return r.groupBy("tag_id").agg(F.min("asset_id").alias("asset_id")).join(q, "tag_id").select(
        "tag_id", "asset_id", *[F.round(F.col("q")[i], 4).alias(b) for i, b in enumerate(bands)])


DIM_TAG_SQL = """
SELECT tag_id, min(asset_id) AS asset_id,
       round(quantile_cont(value, 0.05), 4) AS normal_low,
       round(quantile_cont(value, 0.95), 4) AS normal_high,
       round(quantile_cont(value, 0.97), 4) AS warn_threshold,
       round(quantile_cont(value, 0.99), 4) AS crit_threshold
FROM readings GROUP BY tag_id
"""


def dim_asset(spark: SparkSession, d: str) -> DataFrame:
    """Asset hierarchy: one row per asset (site, area from the asset number)."""
    r = readings(spark, d).select("asset_id").distinct()
    n = F.regexp_extract("asset_id", r"(\d+)$", 1).cast("int")
    return r.select("asset_id",
                    F.lit("plant").alias("site"),
                    F.concat(F.lit("area_"), (n % 3).cast("string")).alias("area"),
                    F.concat(F.lit("wc_"), (n % 5).cast("string")).alias("work_center"))


DIM_ASSET_SQL = """
SELECT asset_id, 'plant' AS site,
       'area_' || CAST(CAST(regexp_extract(asset_id, '(\\d+)$', 1) AS INTEGER) % 3 AS VARCHAR) AS area,
       'wc_' || CAST(CAST(regexp_extract(asset_id, '(\\d+)$', 1) AS INTEGER) % 5 AS VARCHAR) AS work_center
FROM (SELECT DISTINCT asset_id FROM readings)
"""


def intervals(spark: SparkSession, d: str) -> DataFrame:
    """Labelled anomaly windows: per user and day drawn with p=.05, start at
    the first event of that day, end 6 hours later (closed)."""
    e = read(spark, d, "events", ["ts", "user_id", "event_type"])
    e = e.withColumn("day", F.to_date("ts"))
    picked = e.where(hash_uniform("user_id", "day", lane="interval") < 0.05)
    return (picked.groupBy("user_id", "day").agg(F.min("ts").alias("start_ts"))
            .select(F.col("user_id"), F.col("start_ts"),
                    (F.col("start_ts") + F.expr("INTERVAL 6 HOURS")).alias("end_ts"),
                    F.when(F.dayofweek("day") % 2 == 0, "drift").otherwise("spike").alias("anomaly_type")))


INTERVALS_SQL = f"""
SELECT user_id, min(ts) AS start_ts, min(ts) + INTERVAL 6 HOUR AS end_ts,
       CASE WHEN (dayofweek(CAST(ts AS DATE)) + 1) % 2 = 0 THEN 'drift' ELSE 'spike' END AS anomaly_type
FROM events
WHERE {hash_uniform_sql('user_id, CAST(ts AS DATE)', 'interval')} < 0.05
GROUP BY user_id, CAST(ts AS DATE), anomaly_type
"""

# ---------------------------------------------------------------- sales star


def sales(spark: SparkSession, d: str) -> DataFrame:
    """Depletion fact: one row per line item with account, sku, week, cases."""
    li = read(spark, d, "lineitem", ["l_orderkey", "l_partkey", "l_quantity", "l_extendedprice",
                                      "l_discount", "l_shipdate"])
    o = read(spark, d, "orders", ["o_orderkey", "o_custkey"])
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("o_custkey").alias("account_id"),
        F.col("l_partkey").alias("sku_id"),
        F.to_date(F.date_trunc("week", "l_shipdate")).alias("week"),
        F.col("l_quantity").alias("cases"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net_revenue"),
        (F.col("l_discount") >= 0.05).cast("int").alias("promo_flag"),
    )


SALES_SQL = """
SELECT o_custkey AS account_id, l_partkey AS sku_id,
       CAST(date_trunc('week', l_shipdate) AS DATE) AS week, l_quantity AS cases,
       l_extendedprice * (1 - l_discount) AS net_revenue,
       CAST(l_discount >= 0.05 AS INTEGER) AS promo_flag
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""


def dim_account(spark: SparkSession, d: str) -> DataFrame:
    c = read(spark, d, "customer", ["c_custkey", "c_nationkey", "c_mktsegment"])
    n = read(spark, d, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    r = read(spark, d, "region", ["r_regionkey", "r_name"])
    return (c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
            .select(F.col("c_custkey").alias("account_id"), F.col("c_mktsegment").alias("banner"),
                    F.col("n_name").alias("country"), F.col("r_name").alias("region")))


DIM_ACCOUNT_SQL = """
SELECT c_custkey AS account_id, c_mktsegment AS banner, n_name AS country, r_name AS region
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""


def dim_product(spark: SparkSession, d: str) -> DataFrame:
    p = read(spark, d, "part", ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"])
    return p.select(F.col("p_partkey").alias("sku_id"), F.col("p_brand").alias("brand"),
                    F.col("p_type").alias("category"), F.col("p_size").alias("pack_units"),
                    F.col("p_retailprice").alias("base_price"), F.col("p_name").alias("flavor"))


DIM_PRODUCT_SQL = """
SELECT p_partkey AS sku_id, p_brand AS brand, p_type AS category, p_size AS pack_units,
       p_retailprice AS base_price, p_name AS flavor
FROM part
"""

# ---------------------------------------------------------------- ratings


def ratings(spark: SparkSession, d: str) -> DataFrame:
    li = read(spark, d, "lineitem", ["l_orderkey", "l_partkey", "l_quantity"])
    o = read(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"),
        (F.col("l_quantity") / 10).alias("rating"),
        F.unix_micros(F.col("o_orderdate").cast("timestamp")).alias("ts_micros"))


RATINGS_SQL = """
SELECT o_custkey AS user_id, l_partkey AS item_id, l_quantity / 10 AS rating,
       epoch_us(o_orderdate) AS ts_micros
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""

# ---------------------------------------------------------------- wide sensors


def wide_sensors(spark: SparkSession, d: str) -> DataFrame:
    li = read(spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity",
                                      "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                                      "l_shipdate"])
    fail = (F.col("l_returnflag") == "R") & (F.col("l_quantity") >= 45)
    return li.select(
        F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"),
        F.col("l_shipdate").alias("event_time"),
        F.col("l_quantity").alias("s_qty"), F.col("l_extendedprice").alias("s_price"),
        F.col("l_discount").alias("s_disc"), F.col("l_tax").alias("s_tax"),
        fail.cast("int").alias("is_failure"),
        F.when(fail, F.concat(F.lit("mode_"), F.col("l_linestatus"))).otherwise("none").alias("failure_mode"),
        (fail & (hash_uniform("l_orderkey", "l_linenumber", "l_partkey", lane="label") < 0.002)).cast("int").alias("is_labeled"),
        hash_uniform("l_orderkey", "l_linenumber", "l_partkey", lane="holdout").alias("u_split"),
    )


WIDE_SENSORS_SQL = f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate AS event_time,
       l_quantity AS s_qty, l_extendedprice AS s_price, l_discount AS s_disc, l_tax AS s_tax,
       CAST(l_returnflag = 'R' AND l_quantity >= 45 AS INTEGER) AS is_failure,
       CASE WHEN l_returnflag = 'R' AND l_quantity >= 45 THEN 'mode_' || l_linestatus ELSE 'none' END AS failure_mode,
       CAST(l_returnflag = 'R' AND l_quantity >= 45
            AND {hash_uniform_sql('l_orderkey, l_linenumber, l_partkey', 'label')} < 0.002 AS INTEGER) AS is_labeled,
       {hash_uniform_sql('l_orderkey, l_linenumber, l_partkey', 'holdout')} AS u_split
FROM lineitem
"""

SENSOR_COLS = ["s_qty", "s_price", "s_disc", "s_tax"]


def sensor_scores(spark: SparkSession, d: str) -> DataFrame:
    """Wide sensors standardised on unlabeled rows (population std); score A
    = mean squared z (distance from the normal centre), score B = a one-column
    rule score. Rounded to 9 decimals so thresholds compare identical values."""
    from mlframe.operators.models import apply_scaler, fit_scaler
    ws = wide_sensors(spark, d)
    sc = fit_scaler(ws, SENSOR_COLS, where="is_labeled = 0")
    z = apply_scaler(ws, sc, SENSOR_COLS)
    score = sum(F.col("z_" + c) * F.col("z_" + c) for c in SENSOR_COLS) / len(SENSOR_COLS)
    return z.select("l_orderkey", "l_linenumber", "l_partkey", "is_failure", "failure_mode", "is_labeled",
                    (F.col("u_split") >= 0.8).cast("int").alias("holdout"),
                    F.round(score, 9).alias("score"), F.round(F.col("s_qty") / 50.0, 9).alias("score_b"))


SENSOR_SCORES_SQL = """
SELECT l_orderkey, l_linenumber, l_partkey, is_failure, failure_mode, is_labeled,
       CAST(u_split >= 0.8 AS INTEGER) AS holdout,
       round((pow((s_qty - m_qty) / d_qty, 2) + pow((s_price - m_price) / d_price, 2)
            + pow((s_disc - m_disc) / d_disc, 2) + pow((s_tax - m_tax) / d_tax, 2)) / 4, 9) AS score,
       round(s_qty / 50.0, 9) AS score_b
FROM ws, (SELECT avg(s_qty) m_qty, stddev_pop(s_qty) d_qty, avg(s_price) m_price, stddev_pop(s_price) d_price,
                 avg(s_disc) m_disc, stddev_pop(s_disc) d_disc, avg(s_tax) m_tax, stddev_pop(s_tax) d_tax
          FROM ws WHERE is_labeled = 0) sc
"""

# ---------------------------------------------------------------- lifetimes


def lifetimes(spark: SparkSession, d: str) -> DataFrame:
    li = read(spark, d, "lineitem", ["l_orderkey", "l_quantity", "l_returnflag"])
    o = read(spark, d, "orders", ["o_orderkey", "o_orderpriority"])
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("o_orderpriority").alias("grp"), F.col("l_quantity").alias("t"),
        (F.col("l_returnflag") == "R").cast("int").alias("failed"))


LIFETIMES_SQL = """
SELECT o_orderpriority AS grp, l_quantity AS t, CAST(l_returnflag = 'R' AS INTEGER) AS failed
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""

# ---------------------------------------------------------------- hierarchy graph


def graph(spark: SparkSession, d: str):
    """Vertices (id, reading) and edges (src -> dst, child to parent)."""
    c = read(spark, d, "customer", ["c_custkey", "c_nationkey", "c_acctbal"])
    s = read(spark, d, "supplier", ["s_suppkey", "s_nationkey", "s_acctbal"])
    n = read(spark, d, "nation", ["n_nationkey", "n_regionkey"])
    r = read(spark, d, "region", ["r_regionkey"])
    cid = F.concat(F.lit("c"), F.col("c_custkey").cast("string"))
    sid = F.concat(F.lit("s"), F.col("s_suppkey").cast("string"))
    nid = lambda col: F.concat(F.lit("n"), F.col(col).cast("string"))
    rid = lambda col: F.concat(F.lit("r"), F.col(col).cast("string"))
    vertices = (c.select(cid.alias("id"), F.col("c_acctbal").alias("reading"))
                .unionByName(s.select(sid.alias("id"), F.col("s_acctbal").alias("reading")))
                .unionByName(n.select(nid("n_nationkey").alias("id"), F.lit(None).cast("double").alias("reading")))
                .unionByName(r.select(rid("r_regionkey").alias("id"), F.lit(None).cast("double").alias("reading"))))
    edges = (c.select(cid.alias("src"), nid("c_nationkey").alias("dst"))
             .unionByName(s.select(sid.alias("src"), nid("s_nationkey").alias("dst")))
             .unionByName(n.select(nid("n_nationkey").alias("src"), rid("n_regionkey").alias("dst"))))
    return vertices, edges


GRAPH_SQL = """
vertices AS (
  SELECT 'c' || CAST(c_custkey AS VARCHAR) AS id, c_acctbal AS reading FROM customer
  UNION ALL SELECT 's' || CAST(s_suppkey AS VARCHAR), s_acctbal FROM supplier
  UNION ALL SELECT 'n' || CAST(n_nationkey AS VARCHAR), CAST(NULL AS DOUBLE) FROM nation
  UNION ALL SELECT 'r' || CAST(r_regionkey AS VARCHAR), CAST(NULL AS DOUBLE) FROM region),
edges AS (
  SELECT 'c' || CAST(c_custkey AS VARCHAR) AS src, 'n' || CAST(c_nationkey AS VARCHAR) AS dst FROM customer
  UNION ALL SELECT 's' || CAST(s_suppkey AS VARCHAR), 'n' || CAST(s_nationkey AS VARCHAR) FROM supplier
  UNION ALL SELECT 'n' || CAST(n_nationkey AS VARCHAR), 'r' || CAST(n_regionkey AS VARCHAR) FROM nation)
"""


def cte(**parts: str) -> str:
    """Build ``WITH a AS (...), b AS (...)`` from binding SQL bodies."""
    return "WITH " + ",\n".join(f"{k} AS ({v.strip()})" for k, v in parts.items()) + "\n"
