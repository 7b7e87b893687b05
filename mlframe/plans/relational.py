"""Projections, predicates, scalar functions, joins, set operations,
arrays and sampling (2.B, 2.C, 2.F, 2.G, 2.H)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from mlframe import bindings as B
from mlframe.functions import scalar as S
from mlframe.functions.hashing import hash_normal, hash_normal_sql, hash_uniform, hash_uniform_sql, lognormal_count
from mlframe.functions.text import SENTENCE_SQL, sentences
from mlframe.operators import joins as J
from mlframe.operators import sampling as L
from mlframe.plans import query
from mlframe.plans.sql import R
from mlframe.sources.tables import read

# ---- fixed values: the genre vocabulary is the set of words in part names --
GENRE_TERMS = ["anvil", "blue", "bolt", "cold", "gear", "gizmo", "hot", "large",
               "new", "old", "plate", "red", "ring", "rod", "small", "widget"]


# ------------------------------------------------------------------ 2.B


@query("project_alias", sql="""
SELECT l_orderkey AS order_key, CAST(l_quantity AS INTEGER) AS qty, l_extendedprice AS price,
       l_returnflag AS return_flag, CAST(l_shipdate AS DATE) AS ship_day
FROM lineitem
""")
def project_alias(spark, d):
    li = read(spark, d, "lineitem")
    return (li.drop("l_comment", "l_tax", "l_discount")
            .withColumnRenamed("l_returnflag", "return_flag")
            .select(F.col("l_orderkey").alias("order_key"), F.col("l_quantity").cast("int").alias("qty"),
                    F.col("l_extendedprice").alias("price"), "return_flag",
                    F.to_date("l_shipdate").alias("ship_day")))


FILTER_SQL = """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders
WHERE (o_orderpriority LIKE '1-%' OR (o_totalprice BETWEEN 100000 AND 200000 AND o_orderstatus IN ('F', 'O')))
  AND o_custkey IS NOT NULL AND o_orderdate < TIMESTAMP '1999-01-01 00:00:00'
"""


@query("filter_pred", sql=FILTER_SQL)
def filter_pred(spark, d):
    o = read(spark, d, "orders")
    return (o.where((F.col("o_orderpriority").like("1-%") |
                     (F.col("o_totalprice").between(100000, 200000) & F.col("o_orderstatus").isin("F", "O")))
                    & F.col("o_custkey").isNotNull()
                    & (F.col("o_orderdate") < F.lit("1999-01-01 00:00:00").cast("timestamp_ntz")))
            .select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"))


@query("case_buckets", sql="""
SELECT CASE WHEN l_quantity < 10 THEN 'small' WHEN l_quantity < 30 THEN 'medium' ELSE 'large' END AS size_band,
       CASE l_returnflag WHEN 'R' THEN 'returned' WHEN 'A' THEN 'accepted' ELSE 'none' END AS return_kind,
       count(*) AS n
FROM lineitem GROUP BY ALL
""")
def case_buckets(spark, d):
    li = read(spark, d, "lineitem", ["l_quantity", "l_returnflag"])
    size = (F.when(F.col("l_quantity") < 10, "small").when(F.col("l_quantity") < 30, "medium").otherwise("large"))
    kind = (F.when(F.col("l_returnflag") == "R", "returned").when(F.col("l_returnflag") == "A", "accepted")
            .otherwise("none"))
    return li.groupBy(size.alias("size_band"), kind.alias("return_kind")).agg(F.count(F.lit(1)).alias("n"))


@query("sentinel_to_null", sql="""
SELECT l_orderkey, l_linenumber, l_partkey, nullif(l_discount, 0.0) AS l_discount, nullif(l_tax, 0.0) AS l_tax
FROM lineitem
""")
def sentinel_to_null(spark, d):
    """P4 with the sentinel 0.0 (the value that occurs in this data)."""
    li = read(spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_discount", "l_tax"])
    return S.replace_sentinel(li, ["l_discount", "l_tax", "not_there"], 0.0)


@query("sanitize_columns", sql="""
SELECT c_custkey AS cust_key, c_acctbal AS bal_usd_, c_mktsegment AS seg_1_x FROM customer
""")
def sanitize_columns(spark, d):
    """P5: names with blanks, commas and braces become writer-safe."""
    c = read(spark, d, "customer").select(
        F.col("c_custkey").alias("cust key"), F.col("c_acctbal").alias("bal(usd)"),
        F.col("c_mktsegment").alias("seg=1;x"))
    return S.sanitize(c)


@query("regex_keys", sql="""
SELECT page_id, regexp_extract(url, '^https?://([^/]+)', 1) AS host,
       split_part(regexp_extract(url, '^https?://([^/]+)', 1), '.', 1) AS subdomain,
       regexp_extract(url, '/([a-z]{2})/', 1) AS lang,
       TRY_CAST(regexp_extract(url, '/([0-9]+)', 1) AS INTEGER) AS page_no,
       regexp_replace(regexp_extract(url, '/([a-z]{2})/', 1), '[xyz]$', '') AS lang_stem
FROM pages
""")
def regex_keys(spark, d):
    p = read(spark, d, "pages", ["page_id", "url"])
    host = F.regexp_extract("url", r"^https?://([^/]+)", 1)
    lang = F.regexp_extract("url", r"/([a-z]{2})/", 1)
    return p.select("page_id", host.alias("host"),
                    F.element_at(F.split(host, r"\."), 1).alias("subdomain"),
                    lang.alias("lang"),
                    F.expr(r"try_cast(regexp_extract(url, '/([0-9]+)', 1) AS INT)").alias("page_no"),
                    F.regexp_replace(lang, "[xyz]$", "").alias("lang_stem"))


@query("log_features", sql=f"""
SELECT c_custkey, {R('ln(1 + greatest(c_acctbal, 0))')} AS log_c_acctbal,
       {R('exp(ln(1 + greatest(c_acctbal, 0))) - 1', 4)} AS back_c_acctbal
FROM customer
""")
def log_features(spark, d):
    c = read(spark, d, "customer", ["c_custkey", "c_acctbal"])
    out = S.log_columns(c, ["c_acctbal"])
    return out.select("c_custkey", F.round("log_c_acctbal", 6).alias("log_c_acctbal"),
                      F.round(F.expm1("log_c_acctbal"), 4).alias("back_c_acctbal"))


@query("calendar_parts", sql="""
SELECT o_orderkey, CAST(hour(o_orderdate) AS INTEGER) AS hour, CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS dow,
       CAST(month(o_orderdate) AS INTEGER) AS month, CAST(year(o_orderdate) AS INTEGER) AS year,
       CAST(dayofyear(o_orderdate) AS INTEGER) AS doy, CAST(weekofyear(o_orderdate) AS INTEGER) AS iso_week,
       CAST(quarter(o_orderdate) AS INTEGER) AS quarter,
       epoch_ms(CAST(epoch_ms(o_orderdate) AS BIGINT)) AS from_ms
FROM orders
""")
def calendar_parts(spark, d):
    o = read(spark, d, "orders", ["o_orderkey", "o_orderdate"])
    out = S.calendar(o, "o_orderdate")
    ms = F.unix_millis(F.col("o_orderdate").cast("timestamp"))
    return out.select("o_orderkey", "hour", "dow", "month", "year", "doy", "iso_week", "quarter",
                      S.epoch_to_ts(ms, "ms").cast("timestamp_ntz").alias("from_ms"))


@query("holiday_factor", sql="SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_shipdate AS DATE) AS ship_day, (CASE "
       + " ".join(f"WHEN dayofyear(l_shipdate) BETWEEN {lo} AND {hi} THEN {f}" for lo, hi, f in S.HOLIDAY_BANDS)
       + " ELSE 1.0 END)::DOUBLE AS holiday_mult FROM lineitem")
def holiday_factor(spark, d):
    li = read(spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"])
    return li.select("l_orderkey", "l_linenumber", "l_partkey", F.to_date("l_shipdate").alias("ship_day"),
                     S.holiday_factor(F.col("l_shipdate")).alias("holiday_mult"))


@query("multi_hot", sql="SELECT p_partkey, " + ", ".join(
    f"CAST(contains(p_name, '{t}') AS INTEGER) AS g_{t}" for t in GENRE_TERMS) + " FROM part")
def multi_hot(spark, d):
    p = read(spark, d, "part", ["p_partkey", "p_name"])
    return S.multi_hot(p, "p_name", GENRE_TERMS).drop("p_name")


@query("json_roundtrip", sql="""
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       CAST(to_json({'event_id': event_id, 'k': CAST(json_extract_string(props, '$.k') AS INTEGER)}) AS VARCHAR) AS payload
FROM events
""")
def json_roundtrip(spark, d):
    e = read(spark, d, "events", ["event_id", "props"])
    parsed = e.select("event_id", F.from_json("props", "k INT").alias("t")).select("event_id", "t.*")
    return parsed.select("event_id", "k", F.to_json(F.struct("event_id", "k")).alias("payload"))


@query("hash_uniform", sql=f"""
SELECT o_orderkey, {R(hash_uniform_sql('o_orderkey', 'u'), 9)} AS u,
       CAST({hash_uniform_sql('o_orderkey', 'u')} < 0.5 AS INTEGER) AS coin
FROM orders
""")
def hash_uniform_q(spark, d):
    o = read(spark, d, "orders", ["o_orderkey"])
    u = hash_uniform("o_orderkey", lane="u")
    return o.select("o_orderkey", F.round(u, 9).alias("u"), (u < 0.5).cast("int").alias("coin"))


@query("hash_normal", sql=f"""
SELECT o_orderkey, {R(hash_normal_sql('o_orderkey'), 6)} AS z,
       CAST(round(20.0 * exp(0.35 * {hash_normal_sql('o_orderkey')})) AS BIGINT) AS cnt
FROM orders
""")
def hash_normal_q(spark, d):
    o = read(spark, d, "orders", ["o_orderkey"])
    z = hash_normal("o_orderkey")
    return o.select("o_orderkey", F.round(z, 6).alias("z"),
                    lognormal_count(F.lit(20.0), z).cast("long").alias("cnt"))


# ---- fixed values that must equal the reference's: temperature of the summer
# region (mean, amplitude, noise in deg F), promo lift, price at a promo, rate floor
TEMP_MEAN, TEMP_AMP, TEMP_NOISE = 62, 18, 2.5
PROMO_LIFT, RATE_FLOOR = 1.45, 0.05
# -----------------------------------------------------------------------------
SEASON_AMP, TREND, ELASTICITY, TEMP_COEF = 0.3, 0.05, 1.2, 0.2

_SEASON = f"(1 + {SEASON_AMP} * cos(2 * pi() * (dayofyear(s.week) - 200) / 365.0))"
_TREND = f"(1 + {TREND} * (date_diff('day', DATE '1995-01-02', s.week) / 7) / 52.0)"
_PRICE = f"pow((s.net_revenue / s.cases) / p.base_price, -{ELASTICITY})"
_TEMP = f"({TEMP_MEAN} + {TEMP_AMP} * cos(2 * pi() * (dayofyear(s.week) - 200) / 365.0) + {TEMP_NOISE} * {hash_normal_sql('s.account_id, s.sku_id, s.week', 'temp')})"
_PROMO = f"(CASE WHEN s.promo_flag = 1 THEN {PROMO_LIFT}::DOUBLE ELSE 1.0::DOUBLE END)"
_HOLIDAY = "(CASE " + " ".join(f"WHEN dayofyear(s.week) BETWEEN {lo} AND {hi} THEN {f}" for lo, hi, f in S.HOLIDAY_BANDS) + " ELSE 1.0 END)::DOUBLE"
SEASON_SQL = f"""
SELECT s.account_id, s.sku_id, s.week, s.cases, {R(_SEASON)} AS season_mult, {R(_TREND)} AS trend_mult, {R(_PRICE)} AS price_mult,
  {R(f'greatest({RATE_FLOOR}, {_SEASON})')} AS season_floor, {R(_TEMP, 4)} AS avg_temp_f, {_PROMO} AS promo_mult, {_HOLIDAY} AS holiday_mult,
  {R(f'greatest({RATE_FLOOR}, greatest({RATE_FLOOR}, {_SEASON}) * {_TREND} * {_PROMO} * {_PRICE} * (1 + {TEMP_COEF} * (({_TEMP} - 65) / 30.0)) * {_HOLIDAY})', 5)} AS rate
FROM sales s JOIN product p ON s.sku_id = p.sku_id
"""


@query("season_trend_terms", sql=B.cte(sales=B.SALES_SQL, product=B.DIM_PRODUCT_SQL) + SEASON_SQL)
def season_trend_terms(spark, d):
    """The demand model's terms and their product, floored, per unit of base demand."""
    s = B.sales(spark, d)
    p = B.dim_product(spark, d).select("sku_id", "base_price")
    wave = F.cos(2 * math.pi * (F.dayofyear("week") - 200) / 365.0)
    season = 1 + SEASON_AMP * wave
    trend = 1 + TREND * (F.datediff("week", F.lit("1995-01-02").cast("date")) / 7) / 52.0
    price = F.pow((F.col("net_revenue") / F.col("cases")) / F.col("base_price"), -ELASTICITY)
    temp = TEMP_MEAN + TEMP_AMP * wave + TEMP_NOISE * hash_normal("account_id", "sku_id", "week", lane="temp")
    promo = F.when(F.col("promo_flag") == 1, F.lit(PROMO_LIFT)).otherwise(F.lit(1.0))
    holiday = S.holiday_factor(F.col("week"))
    floor = F.greatest(F.lit(RATE_FLOOR), season)
    rate = F.greatest(F.lit(RATE_FLOOR), floor * trend * promo * price * (1 + TEMP_COEF * ((temp - 65) / 30.0)) * holiday)
    return s.join(p, "sku_id").select(
        "account_id", "sku_id", "week", "cases", F.round(season, 6).alias("season_mult"), F.round(trend, 6).alias("trend_mult"),
        F.round(price, 6).alias("price_mult"), F.round(floor, 6).alias("season_floor"), F.round(temp, 4).alias("avg_temp_f"),
        promo.alias("promo_mult"), holiday.alias("holiday_mult"), F.round(rate, 5).alias("rate"))


@query("fill_drop_null", sql="""
SELECT d.doc_id, coalesce(l.quality, 0) AS quality, coalesce(l.toxic, 0) AS toxic, d.lang
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE d.lang IS NOT NULL
""")
def fill_drop_null(spark, d):
    docs = read(spark, d, "documents", ["doc_id", "lang"])
    lab = read(spark, d, "labels")
    return docs.join(lab, "doc_id", "left").na.fill(0, ["quality", "toxic"]).na.drop(subset=["lang"])


@query("band_position", sql=B.cte(readings=B.READINGS_SQL) + ", dim_tag AS (" + B.DIM_TAG_SQL + ")" + f"""
SELECT r.reading_id, r.tag_id, {R('(r.value - t.normal_low) / nullif(t.normal_high - t.normal_low, 0)')} AS band_pos
FROM readings r JOIN dim_tag t ON r.tag_id = t.tag_id
""")
def band_position(spark, d):
    r = B.readings(spark, d)
    t = B.dim_tag(spark, d)
    return r.join(t, "tag_id").select("reading_id", "tag_id",
                                      F.round(S.band_pos("value", "normal_low", "normal_high"), 6).alias("band_pos"))


@query("stamp_provenance", sql=f"""
SELECT o_orderkey, {R('o_totalprice / 500000')} AS score, 'order_value' AS model_name, '1' AS model_version,
       'run-0' AS model_run_id FROM orders
""")
def stamp_provenance(spark, d):
    """P20: model name, version, run id and scoring time on every row (the
    scoring time is dropped from the returned frame so it can be compared)."""
    from mlframe.operators.models import stamp
    o = read(spark, d, "orders", ["o_orderkey", "o_totalprice"])
    scored = o.select("o_orderkey", F.round(F.col("o_totalprice") / 500000, 6).alias("score"))
    return stamp(scored, "order_value", "1", "run-0").drop("scored_at")


@query("sentence_split", sql=f"SELECT doc_id, {SENTENCE_SQL} AS sentences FROM documents")
def sentence_split(spark, d):
    docs = read(spark, d, "documents", ["doc_id", "text"])
    return docs.select("doc_id", sentences("text").alias("sentences"))


@query("columns_mean", sql=f"""
SELECT l_orderkey, l_linenumber, l_partkey, {R('(l_discount + l_tax + l_quantity / 100) / 3.0')} AS ensemble
FROM lineitem
""")
def columns_mean(spark, d):
    li = read(spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_discount", "l_tax", "l_quantity"])
    return li.select("l_orderkey", "l_linenumber", "l_partkey",
                     F.round(S.ensemble_mean(["l_discount", "l_tax", F.col("l_quantity") / 100]), 6).alias("ensemble"))


# ------------------------------------------------------------------ 2.C


@query("equi_join_star", sql=f"""
SELECT n_name, o_orderpriority, count(*) AS n_lines,
       {R('sum(l_extendedprice * (1 - l_discount))', 4)} AS revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY n_name, o_orderpriority
""")
def equi_join_star(spark, d):
    li = read(spark, d, "lineitem", ["l_orderkey", "l_extendedprice", "l_discount"])
    o = read(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderpriority"])
    c = read(spark, d, "customer", ["c_custkey", "c_nationkey"])
    n = read(spark, d, "nation", ["n_nationkey", "n_name"])
    j = (li.join(o, li.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey)
         .join(n, c.c_nationkey == n.n_nationkey))
    return j.groupBy("n_name", "o_orderpriority").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 4).alias("revenue"))


@query("dim_enrich_left", sql="""
SELECT o_orderkey, c_mktsegment, n_name
FROM orders LEFT JOIN (SELECT DISTINCT ON (c_custkey) c_custkey, c_mktsegment, c_nationkey FROM customer ORDER BY c_custkey) c
  ON o_custkey = c.c_custkey
LEFT JOIN nation ON c.c_nationkey = n_nationkey
""")
def dim_enrich_left(spark, d):
    o = read(spark, d, "orders", ["o_orderkey", "o_custkey"]).withColumnRenamed("o_custkey", "c_custkey")
    c = read(spark, d, "customer", ["c_custkey", "c_mktsegment", "c_nationkey"])
    n = read(spark, d, "nation", ["n_nationkey", "n_name"]).withColumnRenamed("n_nationkey", "c_nationkey")
    return J.enrich(J.enrich(o, c, "c_custkey"), n, "c_nationkey").select("o_orderkey", "c_mktsegment", "n_name")


@query("anti_join", sql="""
SELECT 'order_without_lines' AS kind, o_orderkey AS id FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
UNION ALL
SELECT 'customer_inactive_since_2001', c_custkey FROM customer
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderdate >= TIMESTAMP '2001-01-01 00:00:00')
""")
def anti_join(spark, d):
    o = read(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    li = read(spark, d, "lineitem", ["l_orderkey"])
    c = read(spark, d, "customer", ["c_custkey"])
    a = o.join(li, o.o_orderkey == li.l_orderkey, "left_anti").select(
        F.lit("order_without_lines").alias("kind"), F.col("o_orderkey").alias("id"))
    recent = o.where(F.col("o_orderdate") >= F.lit("2001-01-01 00:00:00").cast("timestamp_ntz"))
    b = c.join(recent, c.c_custkey == recent.o_custkey, "left_anti").select(
        F.lit("customer_inactive_since_2001").alias("kind"), F.col("c_custkey").alias("id"))
    return a.unionByName(b)


@query("theta_join", sql=B.cte(sales=B.SALES_SQL) + """,
starts AS (SELECT account_id, min(week) AS start_week FROM sales GROUP BY account_id),
last AS (SELECT max(week) AS end_week FROM sales)
SELECT account_id, CAST(unnest(generate_series(start_week, end_week, INTERVAL 7 DAY)) AS DATE) AS week
FROM starts, last
""")
def theta_join(spark, d):
    """Grid of every week from each series' start to the global end.

    Generated by ``sequence`` per series instead of an inequality join with a
    calendar: no join, no broadcast, and the output rows are the feature."""
    s = B.sales(spark, d)
    end = s.agg(F.max("week")).scalar()
    starts = s.groupBy("account_id").agg(F.min("week").alias("start_week"))
    return starts.select("account_id", F.explode(F.sequence("start_week", end, F.expr("INTERVAL 7 DAYS"))).alias("week"))


@query("interval_join", sql=B.cte(intervals=B.INTERVALS_SQL) + """
SELECT i.user_id, i.start_ts, count(e.event_id) AS n_points, count(DISTINCT e.event_type) AS n_types
FROM intervals i LEFT JOIN events e ON e.user_id = i.user_id AND e.ts BETWEEN i.start_ts AND i.end_ts
GROUP BY i.user_id, i.start_ts
""")
def interval_join(spark, d):
    iv = B.intervals(spark, d)
    e = read(spark, d, "events", ["event_id", "user_id", "ts", "event_type"])
    j = J.match_intervals(iv, e, "user_id", "ts")
    return j.groupBy(F.col("w.user_id").alias("user_id"), F.col("w.start_ts").alias("start_ts")).agg(
        F.count("p.event_id").alias("n_points"), F.count_distinct("p.event_type").alias("n_types"))


@query("expr_key_join", sql=f"""
WITH mo AS (SELECT month(o_orderdate) AS mo, avg(o_totalprice) AS avg_price FROM orders GROUP BY 1)
SELECT CAST(month(l_shipdate) AS INTEGER) AS ship_month, count(*) AS n_lines, {R('max(mo.avg_price)', 2)} AS month_avg_price
FROM lineitem JOIN mo ON month(l_shipdate) = mo.mo
GROUP BY 1
""")
def expr_key_join(spark, d):
    o = read(spark, d, "orders", ["o_orderdate", "o_totalprice"])
    mo = o.groupBy(F.month("o_orderdate").alias("mo")).agg(F.avg("o_totalprice").alias("avg_price"))
    li = read(spark, d, "lineitem", ["l_shipdate"])
    j = li.join(mo, F.month(li.l_shipdate) == mo.mo)
    return j.groupBy(F.month("l_shipdate").alias("ship_month")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.round(F.max("avg_price"), 2).alias("month_avg_price"))


@query("scalar_subquery", sql="""
SELECT o_orderkey, o_totalprice FROM orders
WHERE o_totalprice > (SELECT avg(o_totalprice) FROM orders)
  AND o_orderdate >= (SELECT max(o_orderdate) FROM orders) - INTERVAL 365 DAY
""")
def scalar_subquery(spark, d):
    o = read(spark, d, "orders", ["o_orderkey", "o_totalprice", "o_orderdate"])
    avg_p = o.agg(F.avg("o_totalprice")).scalar()
    newest = o.agg(F.max("o_orderdate")).scalar()
    return (o.where((F.col("o_totalprice") > avg_p) & (F.col("o_orderdate") >= newest - F.expr("INTERVAL 365 DAYS")))
            .select("o_orderkey", "o_totalprice"))


# ------------------------------------------------------------------ 2.G / 2.H


@query("union_by_name", sql="""
SELECT l_orderkey, l_partkey, l_quantity, 'returned' AS mode FROM lineitem WHERE l_returnflag = 'R'
UNION ALL
SELECT l_orderkey, l_partkey, l_quantity, 'kept' AS mode FROM lineitem WHERE l_returnflag <> 'R'
""")
def union_by_name(spark, d):
    from mlframe.operators.sets import union_all
    li = read(spark, d, "lineitem", ["l_orderkey", "l_partkey", "l_quantity", "l_returnflag"])
    a = li.where("l_returnflag = 'R'").select("l_quantity", "l_orderkey", "l_partkey", F.lit("returned").alias("mode"))
    b = li.where("l_returnflag <> 'R'").select(F.lit("kept").alias("mode"), "l_partkey", "l_orderkey", "l_quantity")
    return union_all([a, b])


@query("union_all_distinct", sql="""
SELECT 'orders' AS source, count(*) AS n_rows, count(DISTINCT o_custkey) AS n_keys FROM orders
UNION ALL
SELECT 'lineitem', count(*), count(DISTINCT l_orderkey) FROM lineitem
UNION ALL
SELECT 'keys', count(*), count(*) FROM (SELECT DISTINCT o_custkey FROM orders)
""")
def union_all_distinct(spark, d):
    o = read(spark, d, "orders", ["o_custkey"])
    li = read(spark, d, "lineitem", ["l_orderkey"])
    a = o.agg(F.lit("orders").alias("source"), F.count(F.lit(1)).alias("n_rows"), F.count_distinct("o_custkey").alias("n_keys"))
    b = li.agg(F.lit("lineitem").alias("source"), F.count(F.lit(1)).alias("n_rows"), F.count_distinct("l_orderkey").alias("n_keys"))
    k = o.select("o_custkey").distinct().agg(F.lit("keys").alias("source"), F.count(F.lit(1)).alias("n_rows"),
                                             F.count(F.lit(1)).alias("n_keys"))
    return a.unionByName(b).unionByName(k)


@query("date_spine", sql="""
WITH b AS (SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders)
SELECT CAST(unnest(generate_series(date_trunc('month', lo), date_trunc('month', hi), INTERVAL 1 MONTH)) AS DATE) AS month_start
FROM b
""")
def date_spine(spark, d):
    o = read(spark, d, "orders", ["o_orderdate"])
    b = o.agg(F.trunc(F.min("o_orderdate"), "month").alias("lo"), F.trunc(F.max("o_orderdate"), "month").alias("hi"))
    return b.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 MONTH"))).alias("month_start"))


@query("struct_fields", sql="""
SELECT c_custkey, c_name AS name, c_acctbal AS bal, c_mktsegment AS seg
FROM customer
""")
def struct_fields(spark, d):
    c = read(spark, d, "customer", ["c_custkey", "c_name", "c_acctbal", "c_mktsegment"])
    s = c.select("c_custkey", F.struct(F.col("c_name").alias("name"), F.col("c_acctbal").alias("bal"),
                                       F.col("c_mktsegment").alias("seg")).alias("info"))
    return s.select("c_custkey", "info.*")


# ------------------------------------------------------------------ 2.F


@query("top_k", sql="""
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey ASC LIMIT 20
""")
def top_k(spark, d):
    o = read(spark, d, "orders", ["o_orderkey", "o_totalprice"])
    return L.top_k(o, [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()], 20)


@query("random_split", sql=f"""
SELECT o_orderkey, CASE WHEN {hash_uniform_sql('o_orderkey', 'split')} < 0.8 THEN 'train' ELSE 'test' END AS split
FROM orders
""")
def random_split(spark, d):
    o = read(spark, d, "orders", ["o_orderkey"])
    return L.hash_split(o, "o_orderkey", 0.8)


@query("stratified_split", sql=f"""
WITH r AS (
  SELECT o_orderkey, o_orderstatus,
         row_number() OVER (PARTITION BY o_orderstatus ORDER BY {hash_uniform_sql('o_orderkey', 'strat')}, o_orderkey) AS pos,
         count(*) OVER (PARTITION BY o_orderstatus) AS n
  FROM orders)
SELECT o_orderkey, o_orderstatus, CASE WHEN pos <= round(n * 0.8) THEN 'train' ELSE 'test' END AS split FROM r
""")
def stratified_split(spark, d):
    o = read(spark, d, "orders", ["o_orderkey", "o_orderstatus"])
    return L.stratified_split(o, "o_orderkey", "o_orderstatus", 0.8)


@query("sample_rows", sql=f"""
SELECT o_orderkey, o_totalprice FROM orders WHERE {hash_uniform_sql('o_orderkey', 'sample')} < 0.25
""")
def sample_rows(spark, d):
    o = read(spark, d, "orders", ["o_orderkey", "o_totalprice"])
    return L.hash_sample(o, "o_orderkey", 0.25)


@query("time_split", sql="""
WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS pos,
                  count(*) OVER () AS n FROM orders)
SELECT o_orderkey, CASE WHEN pos <= round(n * 0.8) THEN 'train' ELSE 'valid' END AS split FROM r
""")
def time_split(spark, d):
    o = read(spark, d, "orders", ["o_orderkey", "o_orderdate"])
    return L.time_split(o, "o_orderdate", "o_orderkey", 0.8).select("o_orderkey", "split")
