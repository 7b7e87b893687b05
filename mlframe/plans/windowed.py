"""Series window queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from mlframe import bindings as B
from mlframe.operators import windows as W
from mlframe.operators.ranking import positions, value_buckets
from mlframe.plans import query
from mlframe.plans.aggregates import MONTHLY_DEMAND_SQL, SALES, monthly_demand_df
from mlframe.plans.sql import R
from mlframe.sources.tables import read

DEMAND = SALES + ", demand AS (" + MONTHLY_DEMAND_SQL.replace(
    "date_trunc('month', s.week) AS ds", "CAST(date_trunc('month', s.week) AS DATE) AS ds") + ")"


FILLED = DEMAND + """,
bounds AS (SELECT brand, region, min(ds) AS lo, max(ds) AS hi FROM demand GROUP BY ALL),
grid AS (SELECT brand, region, CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS ds FROM bounds),
filled AS (SELECT grid.brand, grid.region, grid.ds, coalesce(demand.y, 0) AS y FROM grid LEFT JOIN demand USING (brand, region, ds))
"""


def filled_demand(spark, d):
    """Monthly demand per series with the months without sales as 0: lags and seasons count months."""
    return W.densify(monthly_demand_df(spark, d), ["brand", "region"], "ds", "y")


@query("lag_features", sql=FILLED + """
SELECT * FROM (
  SELECT brand, region, ds, y, lag(y, 1) OVER w AS lag_1, lag(y, 2) OVER w AS lag_2, lag(y, 3) OVER w AS lag_3,
         lag(y, 12) OVER w AS lag_12, CAST(month(ds) AS INTEGER) AS month
  FROM filled WINDOW w AS (PARTITION BY brand, region ORDER BY ds))
WHERE lag_1 IS NOT NULL AND lag_2 IS NOT NULL AND lag_3 IS NOT NULL AND lag_12 IS NOT NULL
""")
def lag_features(spark, d):
    return W.lag_features(filled_demand(spark, d), ["brand", "region"], "ds", "y")


DAILY_QTY_SQL = """
daily AS (SELECT l_returnflag AS flag, CAST(l_shipdate AS DATE) AS day, sum(l_quantity) AS qty
          FROM lineitem GROUP BY ALL)
"""


@query("lagged_rolling", sql="WITH " + DAILY_QTY_SQL + f"""
SELECT flag, day, qty, lag(qty, 1) OVER w AS lag1, lag(qty, 2) OVER w AS lag2, lag(qty, 3) OVER w AS lag3,
  lag(qty, 7) OVER w AS lag7, lag(qty, 14) OVER w AS lag14, lag(qty, 30) OVER w AS lag30, lag(qty, 360) OVER w AS lag360,
  {R('avg(qty) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 7 PRECEDING)')} AS expanding_mean_lag7,
  {R('avg(qty) OVER (w ROWS BETWEEN 20 PRECEDING AND 14 PRECEDING)')} AS rolling_mean_lag14_window_size7,
  {R('avg(qty) OVER (w ROWS BETWEEN 43 PRECEDING AND 30 PRECEDING)')} AS rolling_mean_lag30_window_size14
FROM daily WINDOW w AS (PARTITION BY flag ORDER BY day)
""")
def lagged_rolling(spark, d):
    li = read(spark, d, "lineitem", ["l_returnflag", "l_shipdate", "l_quantity"])
    daily = li.groupBy(F.col("l_returnflag").alias("flag"), F.to_date("l_shipdate").alias("day")).agg(
        F.sum("l_quantity").alias("qty"))
    out = W.lagged_rolling(daily, "flag", "day", "qty")
    for c in ("expanding_mean_lag7", "rolling_mean_lag14_window_size7", "rolling_mean_lag30_window_size14"):
        out = out.withColumn(c, F.round(c, 6))
    return out


@query("row_position", sql="""
SELECT * FROM (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS pos FROM orders)
WHERE pos IN (1, 10, 100, 1000, 5000)
""")
def row_position(spark, d):
    """Global positions without a single-partition window (buckets of about equal rows)."""
    o = read(spark, d, "orders", ["o_orderkey", "o_totalprice"])
    ranked = positions(o, [F.col("o_totalprice").desc(), F.col("o_orderkey")],
                       -value_buckets(o, "o_totalprice"))
    return ranked.where(F.col("pos").isin(1, 10, 100, 1000, 5000))


@query("top_n_per_group", sql=SALES + """,
rev AS (SELECT account_id, sku_id, round(sum(net_revenue), 4) AS revenue FROM sales GROUP BY ALL)
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY account_id ORDER BY revenue DESC, sku_id) AS INTEGER) AS rank FROM rev)
WHERE rank <= 5
""")
def top_n_per_group(spark, d):
    rev = B.sales(spark, d).groupBy("account_id", "sku_id").agg(F.round(F.sum("net_revenue"), 4).alias("revenue"))
    return W.top_n(rev, "account_id", [F.col("revenue").desc(), F.col("sku_id")], 5)


@query("time_index", sql=DEMAND + """
SELECT brand, region, ds, CAST(date_diff('month', min(ds) OVER (PARTITION BY brand, region), ds) AS INTEGER) AS time_idx
FROM demand
""")
def time_index(spark, d):
    return W.time_idx(monthly_demand_df(spark, d), ["brand", "region"], "ds").select("brand", "region", "ds", "time_idx")


@query("holdout_split", sql=DEMAND + """
SELECT brand, region, ds,
       CASE WHEN row_number() OVER (PARTITION BY brand, region ORDER BY ds DESC) <= 6 THEN 'holdout' ELSE 'train' END AS split
FROM demand
""")
def holdout_split(spark, d):
    from mlframe.operators.sampling import holdout
    return holdout(monthly_demand_df(spark, d), ["brand", "region"], "ds", 6).select("brand", "region", "ds", "split")


@query("gap_fill", sql=DEMAND + """,
b AS (SELECT brand, region, min(ds) AS lo, max(ds) AS hi FROM demand GROUP BY ALL),
g AS (SELECT brand, region, CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS ds FROM b)
SELECT g.brand, g.region, g.ds, coalesce(demand.y, 0) AS y
FROM g LEFT JOIN demand USING (brand, region, ds)
""")
def gap_fill(spark, d):
    return W.densify(monthly_demand_df(spark, d), ["brand", "region"], "ds", "y")


@query("sequence_windows", sql=DEMAND + """
SELECT * FROM (
  SELECT brand, region, ds,
         list(y ORDER BY ds) OVER (PARTITION BY brand, region ORDER BY ds ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS encoder,
         list(y ORDER BY ds) OVER (PARTITION BY brand, region ORDER BY ds ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING) AS target
  FROM demand)
WHERE len(encoder) >= 5 AND len(target) >= 2
""")
def sequence_windows(spark, d):
    return W.sequence_windows(monthly_demand_df(spark, d), ["brand", "region"], "ds", "y")


SPLIT_CUTOFF = "1997-06-01"


@query("sequence_windows_split", sql=DEMAND + f"""
SELECT brand, region, ds, encoder, target, CASE WHEN hi <= DATE '{SPLIT_CUTOFF}' THEN 'train' ELSE 'validation' END AS split FROM (
  SELECT brand, region, ds,
         list(y ORDER BY ds) OVER (PARTITION BY brand, region ORDER BY ds ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS encoder,
         list(y ORDER BY ds) OVER (PARTITION BY brand, region ORDER BY ds ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING) AS target,
         lead(ds) OVER (PARTITION BY brand, region ORDER BY ds) AS lo,
         max(ds) OVER (PARTITION BY brand, region ORDER BY ds ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING) AS hi
  FROM demand)
WHERE len(encoder) >= 5 AND len(target) >= 2 AND (hi <= DATE '{SPLIT_CUTOFF}' OR lo > DATE '{SPLIT_CUTOFF}')
""")
def sequence_windows_split(spark, d):
    """W14 split at a time: no training target lies after the cutoff."""
    return W.sequence_windows(monthly_demand_df(spark, d), ["brand", "region"], "ds", "y", cutoff=SPLIT_CUTOFF)
