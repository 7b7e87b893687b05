"""Aggregation and reshaping queries (2.D)."""

from __future__ import annotations

from pyspark.sql import functions as F

from mlframe import bindings as B
from mlframe.operators import aggs as A
from mlframe.plans import query
from mlframe.plans.sql import R
from mlframe.session import scratch_dir
from mlframe.sources.tables import read

RATINGS = B.cte(ratings=B.RATINGS_SQL)
SALES = B.cte(sales=B.SALES_SQL, product=B.DIM_PRODUCT_SQL, account=B.DIM_ACCOUNT_SQL)


def _std_sql(n, s, ss):
    return f"coalesce(sqrt(greatest(CASE WHEN {n} > 1 THEN ({ss} - {s} * {s} / {n}) / ({n} - 1) END, 0)), 0)"


ENTITY_SQL = RATINGS + f""",
u AS (SELECT user_id, count(rating) AS n, sum(rating) AS s, sum(rating * rating) AS ss FROM ratings GROUP BY 1),
i AS (SELECT item_id, count(rating) AS n, sum(rating) AS s, sum(rating * rating) AS ss FROM ratings GROUP BY 1)
SELECT r.user_id, r.item_id, r.rating, r.ts_micros,
  {R('u.s / u.n')} AS user_id_avg, u.n AS user_id_cnt, {R(_std_sql('u.n', 'u.s', 'u.ss'))} AS user_id_std,
  {R('i.s / i.n')} AS item_id_avg, i.n AS item_id_cnt, {R(_std_sql('i.n', 'i.s', 'i.ss'))} AS item_id_std
FROM ratings r JOIN u USING (user_id) JOIN i USING (item_id)
"""


def joined_once(df):
    """A derived table that several aggregates read: written once in the shared folder instead of joined for each."""
    return df.checkpoint(eager=True)


@query("entity_stats", sql=ENTITY_SQL)
def entity_stats(spark, d):
    return A.entity_stats(joined_once(B.ratings(spark, d)), ["user_id", "item_id"], "rating")


LOO_SQL = RATINGS + f""",
u AS (SELECT user_id, count(rating) AS n, sum(rating) AS s, sum(rating * rating) AS ss FROM ratings GROUP BY 1),
i AS (SELECT item_id, count(rating) AS n, sum(rating) AS s, sum(rating * rating) AS ss FROM ratings GROUP BY 1)
SELECT r.user_id, r.item_id, r.rating, r.ts_micros,
  {R('CASE WHEN u.n > 1 THEN (u.s - r.rating) / (u.n - 1) END', 4)} AS user_id_avg, u.n - 1 AS user_id_cnt,
  {R(_std_sql('(u.n - 1)', '(u.s - r.rating)', '(u.ss - r.rating * r.rating)'), 4)} AS user_id_std,
  {R('CASE WHEN i.n > 1 THEN (i.s - r.rating) / (i.n - 1) END', 4)} AS item_id_avg, i.n - 1 AS item_id_cnt,
  {R(_std_sql('(i.n - 1)', '(i.s - r.rating)', '(i.ss - r.rating * r.rating)'), 4)} AS item_id_std
FROM ratings r JOIN u USING (user_id) JOIN i USING (item_id)
"""


@query("loo_entity_stats", sql=LOO_SQL)
def loo_entity_stats(spark, d):
    return A.entity_stats(joined_once(B.ratings(spark, d)), ["user_id", "item_id"], "rating", leave_one_out=True, digits=4)


MONTHLY_DEMAND_SQL = f"""
SELECT p.brand, a.region, date_trunc('month', s.week) AS ds, {R('CAST(sum(s.cases) AS DOUBLE)', 4)} AS y
FROM sales s JOIN product p ON s.sku_id = p.sku_id JOIN account a ON s.account_id = a.account_id
GROUP BY ALL HAVING sum(s.cases) > 0
"""


def monthly_demand_df(spark, d):
    s = B.sales(spark, d)
    p = B.dim_product(spark, d).select("sku_id", "brand")
    a = B.dim_account(spark, d).select("account_id", "region")
    return (s.join(p, "sku_id").join(a, "account_id")
            .groupBy("brand", "region", F.trunc("week", "month").alias("ds"))
            .agg(F.sum("cases").cast("double").alias("y")).where("y > 0")
            .withColumn("y", F.round("y", 4)))


@query("monthly_demand", sql=SALES + MONTHLY_DEMAND_SQL.replace(
    "date_trunc('month', s.week) AS ds", "CAST(date_trunc('month', s.week) AS DATE) AS ds"))
def monthly_demand(spark, d):
    return monthly_demand_df(spark, d)


ASSORTMENT_SQL = """
SELECT account_id, sku_id, sum(cases) AS trailing_26w_cases, max(week) AS last_depletion_week
FROM sales WHERE week >= (SELECT max(week) FROM sales) - INTERVAL 182 DAY
GROUP BY account_id, sku_id HAVING sum(cases) >= 3
"""


def assortment_df(spark, d):
    s = B.sales(spark, d)
    newest = s.agg(F.max("week")).scalar()
    return (s.where(F.col("week") >= F.date_sub(newest, 182)).groupBy("account_id", "sku_id")
            .agg(F.sum("cases").alias("trailing_26w_cases"), F.max("week").alias("last_depletion_week"))
            .where("trailing_26w_cases >= 3"))


@query("assortment", sql=SALES + ASSORTMENT_SQL.replace("- INTERVAL 182 DAY", "- 182"))
def assortment(spark, d):
    return assortment_df(spark, d)


@query("carry_profile", sql=SALES + f", asst AS ({ASSORTMENT_SQL.replace('- INTERVAL 182 DAY', '- 182')})" + f"""
SELECT a.banner, {R('avg(n_skus)', 4)} AS avg_skus_per_store, count(DISTINCT x.account_id) AS n_stores
FROM (SELECT account_id, count(DISTINCT sku_id) AS n_skus FROM asst GROUP BY 1) x
JOIN account a ON x.account_id = a.account_id GROUP BY a.banner
""")
def carry_profile(spark, d):
    per_store = assortment_df(spark, d).groupBy("account_id").agg(F.count_distinct("sku_id").alias("n_skus"))
    a = B.dim_account(spark, d).select("account_id", "banner")
    return per_store.join(a, "account_id").groupBy("banner").agg(
        F.round(F.avg("n_skus"), 4).alias("avg_skus_per_store"), F.count_distinct("account_id").alias("n_stores"))


SITE_SQL = f"""
WITH chem AS (SELECT c_nationkey AS k, avg(c_acctbal) AS avg_chem, count(*) AS n_samples FROM customer GROUP BY 1),
phys AS (SELECT s_nationkey AS k, avg(s_acctbal) AS avg_phys FROM supplier GROUP BY 1),
cnt AS (SELECT c_nationkey AS k, c_mktsegment AS seg, count(*) AS c FROM customer GROUP BY 1, 2),
dom AS (SELECT k, seg AS dominant FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY c DESC, seg) AS r FROM cnt) WHERE r = 1)
SELECT n_nationkey, n_name, {R('avg_chem', 4)} AS avg_chem, {R('avg_phys', 4)} AS avg_phys, dominant,
       coalesce(n_samples, 0) AS n_samples
FROM nation LEFT JOIN chem ON n_nationkey = chem.k LEFT JOIN phys ON n_nationkey = phys.k
LEFT JOIN dom ON n_nationkey = dom.k
"""


@query("site_summary", sql=SITE_SQL)
def site_summary(spark, d):
    """A10: location enriched with three summaries; dominant class = mode."""
    c = read(spark, d, "customer", ["c_nationkey", "c_acctbal", "c_mktsegment"])
    s = read(spark, d, "supplier", ["s_nationkey", "s_acctbal"])
    n = read(spark, d, "nation", ["n_nationkey", "n_name"])
    chem = c.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(
        F.avg("c_acctbal").alias("avg_chem"), F.count(F.lit(1)).alias("n_samples"))
    phys = s.groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.avg("s_acctbal").alias("avg_phys"))
    dom = A.dominant(c.withColumnRenamed("c_nationkey", "n_nationkey"), "n_nationkey", "c_mktsegment")
    out = n.join(chem, "n_nationkey", "left").join(phys, "n_nationkey", "left").join(dom, "n_nationkey", "left")
    return out.select("n_nationkey", "n_name", F.round("avg_chem", 4).alias("avg_chem"),
                      F.round("avg_phys", 4).alias("avg_phys"), "dominant",
                      F.coalesce("n_samples", F.lit(0)).alias("n_samples"))


@query("group_counts", sql="""
SELECT o_orderpriority, o_orderstatus, count(*) AS n, count(DISTINCT o_custkey) AS n_customers
FROM orders GROUP BY ALL
""")
def group_counts(spark, d):
    o = read(spark, d, "orders", ["o_orderpriority", "o_orderstatus", "o_custkey"])
    o.createOrReplaceTempView("orders_v")
    return o.sparkSession.sql("""
        SELECT o_orderpriority, o_orderstatus, count(*) AS n, count(DISTINCT o_custkey) AS n_customers
        FROM orders_v GROUP BY ALL""")


@query("pivot_counts", sql="""
SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS F,
       count(*) FILTER (WHERE o_orderstatus = 'O') AS O, count(*) FILTER (WHERE o_orderstatus = 'P') AS P,
       count(*) FILTER (WHERE o_orderstatus IN ('F', 'O', 'P')) AS total
FROM orders GROUP BY 1
""")
def pivot_counts(spark, d):
    o = read(spark, d, "orders", ["o_orderpriority", "o_orderstatus"])
    return A.pivot_counts(o, "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


@query("null_rate", sql="""
SELECT d.lang, round(avg(CAST(l.quality IS NULL AS DOUBLE)), 3) AS null_quality,
       round(avg(CAST(l.toxic IS NULL AS DOUBLE)), 3) AS null_toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY d.lang
""")
def null_rate(spark, d):
    docs = read(spark, d, "documents", ["doc_id", "lang"])
    lab = read(spark, d, "labels")
    return A.null_rate(docs.join(lab, "doc_id", "left"), "lang", ["quality", "toxic"])


@query("unpivot_long", sql="""
SELECT * FROM (
  SELECT l_orderkey, l_linenumber, 'l_discount' AS element, nullif(l_discount, 0) AS value FROM lineitem
  UNION ALL
  SELECT l_orderkey, l_linenumber, 'l_tax', nullif(l_tax, 0) FROM lineitem) WHERE value IS NOT NULL
""")
def unpivot_long(spark, d):
    li = read(spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_discount", "l_tax"])
    wide = li.select("l_orderkey", "l_linenumber", F.nullif("l_discount", F.lit(0.0)).alias("l_discount"),
                     F.nullif("l_tax", F.lit(0.0)).alias("l_tax"))
    return A.to_long(wide, ["l_orderkey", "l_linenumber"], ["l_discount", "l_tax"])


CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("corr_matrix", sql=" UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, {R(f'corr({a}, {b})')} AS corr FROM lineitem"
    for i, a in enumerate(CORR_COLS) for b in CORR_COLS[i + 1:]))
def corr_matrix(spark, d):
    return A.corr_matrix(read(spark, d, "lineitem", CORR_COLS), CORR_COLS)


@query("histogram", sql=B.cte(ws=B.WIDE_SENSORS_SQL) + """
SELECT is_failure, CAST(CASE WHEN log10(s_price) < 2.0 THEN -1 WHEN log10(s_price) > 6.0 THEN 20 ELSE least(floor((log10(s_price) - 2.0) / (6.0 - 2.0) * 20), 19) END AS INTEGER) AS bin,
       count(*) AS n
FROM ws GROUP BY ALL
""")
def histogram(spark, d):
    ws = B.wide_sensors(spark, d)
    return A.histogram(ws, F.log10("s_price"), 2.0, 6.0, 20, by="is_failure")


@query("percentiles", sql=f"""
SELECT event_type, {R('quantile_cont(value, 0.1)', 4)} AS p10, {R('quantile_cont(value, 0.5)', 4)} AS p50,
       {R('quantile_cont(value, 0.9)', 4)} AS p90, {R('quantile_cont(value, 0.99)', 4)} AS p99,
       {R('avg(value)', 4)} AS mean, {R('max(value)', 4)} AS max, count(*) AS n,
       {R('count(*) / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6)', 4)} AS per_sec
FROM events GROUP BY event_type
""")
def percentiles(spark, d):
    e = read(spark, d, "events", ["event_type", "value", "ts"])
    return A.latency_summary(e, "value", ts="ts", by="event_type")


@query("percentile_nearest", sql=f"""
SELECT event_type, CAST(quantile_disc(value, 0.1) AS DOUBLE) AS p10, CAST(quantile_disc(value, 0.5) AS DOUBLE) AS p50,
       CAST(quantile_disc(value, 0.9) AS DOUBLE) AS p90, CAST(quantile_disc(value, 0.99) AS DOUBLE) AS p99,
       {R('avg(value)', 4)} AS mean, {R('max(value)', 4)} AS max, count(*) AS n
FROM events GROUP BY event_type
""")
def percentile_nearest(spark, d):
    e = read(spark, d, "events", ["event_type", "value"])
    return A.latency_summary(e, "value", by="event_type", method="nearest")


@query("median_impute", sql="""
WITH x AS (SELECT l_orderkey, l_linenumber, nullif(l_discount, 0) AS l_discount FROM lineitem)
SELECT l_orderkey, l_linenumber, coalesce(l_discount, (SELECT median(l_discount) FROM x)) AS l_discount FROM x
""")
def median_impute(spark, d):
    li = read(spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_discount"])
    x = li.select("l_orderkey", "l_linenumber", F.nullif("l_discount", F.lit(0.0)).alias("l_discount"))
    return A.impute_median(x, ["l_discount"])


@query("daily_event_summary")
def daily_event_summary(spark, d):
    """Count and approximate distinct users per date, type and region
    (HyperLogLog++, 5% relative error; rows-only check)."""
    e = read(spark, d, "events", ["ts", "event_type", "user_id"])
    return e.groupBy(F.to_date("ts").alias("event_date"), "event_type",
                     (F.col("user_id") % 4).alias("region")).agg(
        F.count(F.lit(1)).alias("n_events"), F.approx_count_distinct("user_id", 0.05).alias("approx_users"))


def stored_user_sketches(spark, d):
    """Daily sketches of the users per type and region, written one folder per date."""
    e = read(spark, d, "events", ["ts", "event_type", "user_id"])
    daily = A.distinct_sketches(e.select(F.to_date("ts").alias("event_date"), "event_type", (F.col("user_id") % 4).alias("region"), "user_id"),
                                ["event_date", "event_type", "region"], "user_id")
    path = f"{scratch_dir(spark, 'sketches')}/daily"
    daily.repartition("event_date").write.partitionBy("event_date").parquet(path)
    return spark.read.parquet(path).withColumn("event_date", F.col("event_date").cast("date"))


@query("weekly_users")
def weekly_users(spark, d):
    """Events and approximate distinct users per week, type and region, merged from the daily sketches."""
    s = stored_user_sketches(spark, d)
    return A.merge_sketches(s.withColumn("week", F.to_date(F.date_trunc("week", "event_date"))), ["week", "event_type", "region"])


@query("revenue_rollup", sql=SALES + f"""
SELECT a.region, s.week, count(*) AS n, {R('sum(s.net_revenue)', 4)} AS revenue,
       round(sum(s.net_revenue), 4) / count(s.net_revenue) AS avg_revenue
FROM sales s JOIN account a ON s.account_id = a.account_id GROUP BY a.region, s.week
""")
def revenue_rollup(spark, d):
    s = B.sales(spark, d)
    a = B.dim_account(spark, d).select("account_id", "region")
    return s.join(a, "account_id").groupBy("region", "week").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("net_revenue"), 4).alias("revenue"),
        A.exact_avg("net_revenue", 4).alias("avg_revenue"))


@query("usage_rollup", sql=f"""
SELECT user_id, {R('sum(value)', 4)} AS total, count(DISTINCT CAST(ts AS DATE)) AS active_days,
       {R('sum(value) / count(DISTINCT CAST(ts AS DATE))', 4)} AS per_active_day
FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY
GROUP BY user_id ORDER BY total DESC, user_id LIMIT 20
""")
def usage_rollup(spark, d):
    e = read(spark, d, "events", ["user_id", "value", "ts"])
    newest = e.agg(F.max("ts")).scalar()
    g = (e.where(F.col("ts") >= newest - F.expr("INTERVAL 7 DAYS")).groupBy("user_id")
         .agg(F.sum("value").alias("_t"), F.count_distinct(F.to_date("ts")).alias("active_days")))
    g = g.select("user_id", F.round("_t", 4).alias("total"), "active_days",
                 F.round(F.col("_t") / F.col("active_days"), 4).alias("per_active_day"))
    return g.orderBy(F.col("total").desc(), "user_id").limit(20)


DEVICE_SQL = B.cte(readings=B.READINGS_SQL) + ", dim_tag AS (" + B.DIM_TAG_SQL + ")" + f"""
SELECT r.asset_id, CAST(r.reading_ts AS DATE) AS day, round(sum(r.value), 2) / count(r.value) AS avg_value,
       CAST(sum(CASE WHEN r.value > t.crit_threshold THEN 1 ELSE 0 END) AS BIGINT) AS abnormal_cnt
FROM readings r JOIN dim_tag t ON r.tag_id = t.tag_id GROUP BY ALL
"""


def device_metrics_df(spark, d):
    r = B.readings(spark, d)
    t = B.dim_tag(spark, d).select("tag_id", "crit_threshold")
    return r.join(t, "tag_id").groupBy("asset_id", F.to_date("reading_ts").alias("day")).agg(
        A.exact_avg("value", 2).alias("avg_value"),
        F.sum(F.when(F.col("value") > F.col("crit_threshold"), 1).otherwise(0)).cast("long").alias("abnormal_cnt"))


@query("daily_device_metrics", sql=DEVICE_SQL)
def daily_device_metrics(spark, d):
    return device_metrics_df(spark, d)


@query("alert_review", sql=B.cte(ws=B.WIDE_SENSORS_SQL) + f"""
SELECT CAST(s_qty / 50.0 >= 0.9 AS INTEGER) AS alert, count(*) AS n, {R('avg(s_qty / 50.0)', 6)} AS avg_score,
       CAST(sum(is_failure) AS BIGINT) AS positives
FROM ws GROUP BY 1
""")
def alert_review(spark, d):
    ws = B.wide_sensors(spark, d).withColumn("score", F.col("s_qty") / 50.0)
    return ws.groupBy((F.col("score") >= 0.9).cast("int").alias("alert")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("score"), 6).alias("avg_score"),
        F.sum("is_failure").cast("long").alias("positives"))


@query("class_weights", sql=B.cte(ws=B.WIDE_SENSORS_SQL) + f"""
SELECT is_failure, count(*) AS n,
  {R("CASE WHEN is_failure = 1 THEN (SELECT count(*) FILTER (WHERE is_failure = 0) / count(*) FILTER (WHERE is_failure = 1) FROM ws) ELSE 1.0 END", 6)} AS weight
FROM ws GROUP BY is_failure
""")
def class_weights(spark, d):
    ws = A.pos_weight(B.wide_sensors(spark, d), "is_failure")
    return ws.groupBy("is_failure").agg(F.count(F.lit(1)).alias("n"), F.round(F.first("weight"), 6).alias("weight"))


@query("samples_per_location", sql="""
SELECT n_nationkey, n_name, coalesce(c, 0) AS n_suppliers
FROM nation LEFT JOIN (SELECT s_nationkey, count(*) AS c FROM supplier GROUP BY 1) x ON n_nationkey = s_nationkey
""")
def samples_per_location(spark, d):
    n = read(spark, d, "nation", ["n_nationkey", "n_name"])
    s = read(spark, d, "supplier", ["s_nationkey"]).groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(
        F.count(F.lit(1)).alias("c"))
    return n.join(s, "n_nationkey", "left").select("n_nationkey", "n_name", F.coalesce("c", F.lit(0)).alias("n_suppliers"))
