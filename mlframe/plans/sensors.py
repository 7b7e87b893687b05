"""Sensor monitoring queries: rolling z-score, anomaly tiers, episodes,
dashboard slices and interval recall (W1-W4, W8, A26, M8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from mlframe import bindings as B
from mlframe.operators import windows as W
from mlframe.plans import query
from mlframe.plans.sql import R

SENSOR_CTE = B.cte(readings=B.READINGS_SQL) + ", dim_tag AS (" + B.DIM_TAG_SQL + ")"

ROLLING_SQL = """,
m AS (SELECT r.*, avg(value) OVER w AS roll_mean,
             CASE WHEN count(value) OVER w > 1 AND min(value) OVER w = max(value) OVER w THEN 0.0 ELSE stddev_samp(value) OVER w END AS roll_std
      FROM readings r
      WINDOW w AS (PARTITION BY tag_id ORDER BY reading_ts ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING)),
z AS (SELECT *, CASE WHEN roll_std IS NULL OR roll_std = 0 THEN 0.0 ELSE (value - roll_mean) / roll_std END AS z FROM m)
"""


BLOCK_ROWS = 100_000  # rows per (tag, block) task; a hot tag is spread over many blocks


def scored(spark, d, block_rows=BLOCK_ROWS):
    r = B.readings(spark, d)
    return W.rolling_z(r, "tag_id", "reading_ts", "value", 12, block_rows=block_rows)


@query("rolling_zscore", sql=SENSOR_CTE + ROLLING_SQL + f"""
SELECT reading_id, tag_id, {R('roll_mean')} AS roll_mean, {R('roll_std')} AS roll_std, {R('z')} AS z FROM z
""")
def rolling_zscore(spark, d):
    """W1 on the skew-safe plan (blocks of 2000 consecutive rows per tag with a 12-row halo)."""
    z = scored(spark, d, block_rows=2000)
    return z.select("reading_id", "tag_id", F.round("roll_mean", 6).alias("roll_mean"),
                    F.round("roll_std", 6).alias("roll_std"), F.round("z", 6).alias("z"))


GOLD_SQL = SENSOR_CTE + ROLLING_SQL + """,
j AS (SELECT z.*, t.crit_threshold, t.normal_low FROM z JOIN dim_tag t USING (tag_id))
SELECT reading_id, tag_id, reading_ts, value, round(z, 2) AS zscore,
  CASE WHEN coalesce(value > crit_threshold, false) THEN 'crit_threshold'
       WHEN abs(z) > 3 THEN 'zscore>3' {low_reason} END AS detect_reason
FROM j WHERE coalesce(value > crit_threshold, false) OR abs(z) > 3 {low_cond}
"""


def gold(spark, d, low_side=False):
    z = scored(spark, d)
    t = B.dim_tag(spark, d).select("tag_id", "crit_threshold", "normal_low")
    g = W.detect(z.join(t, "tag_id"), low_side=low_side)
    return g.select("reading_id", "tag_id", "reading_ts", "value", "zscore", "detect_reason")


@query("gold_anomalies", sql=GOLD_SQL.format(low_reason="", low_cond=""))
def gold_anomalies(spark, d):
    return gold(spark, d)


@query("two_sided_band", sql=GOLD_SQL.format(
    low_reason="WHEN coalesce(value < normal_low, false) THEN 'below_band'",
    low_cond="OR coalesce(value < normal_low, false)"))
def two_sided_band(spark, d):
    return gold(spark, d, low_side=True)


@query("named_window", sql=B.cte(readings=B.READINGS_SQL) + f"""
SELECT reading_id, tag_id, round(sum(value) OVER w, 2) / count(value) OVER w AS roll_avg,
       min(value) OVER w AS roll_min, max(value) OVER w AS roll_max, count(value) OVER w AS roll_n
FROM readings
WINDOW w AS (PARTITION BY tag_id ORDER BY reading_ts ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)
""")
def named_window(spark, d):
    """One named window reused by four functions (one Window node), over
    blocks of consecutive readings with a halo, so a hot tag is spread."""
    blocks = W.halo_blocks(B.readings(spark, d), "tag_id", [F.col("reading_ts")], 5, BLOCK_ROWS, F.date_trunc("hour", "reading_ts"))
    return spark.sql("""
        SELECT reading_id, tag_id, roll_avg, roll_min, roll_max, roll_n FROM (
          SELECT reading_id, tag_id, _halo, round(sum(value) OVER w, 2) / count(value) OVER w AS roll_avg,
                 min(value) OVER w AS roll_min, max(value) OVER w AS roll_max, count(value) OVER w AS roll_n
          FROM {blocks}
          WINDOW w AS (PARTITION BY tag_id, _blk ORDER BY reading_ts ROWS BETWEEN 5 PRECEDING AND CURRENT ROW))
        WHERE _halo = 0""", blocks=blocks)


@query("episodes", sql=SENSOR_CTE + """,
f AS (SELECT r.tag_id, r.reading_ts, CAST(r.value > t.normal_high AS INTEGER) AS flag
      FROM readings r JOIN dim_tag t USING (tag_id)),
g AS (SELECT *, row_number() OVER (PARTITION BY tag_id ORDER BY reading_ts)
              - row_number() OVER (PARTITION BY tag_id, flag ORDER BY reading_ts) AS grp FROM f),
runs AS (SELECT tag_id, min(reading_ts) AS start_ts, max(reading_ts) AS end_ts, count(*) AS n_rows
         FROM g WHERE flag = 1 GROUP BY tag_id, grp)
SELECT *, CAST(row_number() OVER (PARTITION BY tag_id ORDER BY start_ts) AS INTEGER) AS episode_no FROM runs
""")
def episodes(spark, d):
    r = B.readings(spark, d)
    t = B.dim_tag(spark, d).select("tag_id", "normal_high")
    f = r.join(t, "tag_id").withColumn("flag", (F.col("value") > F.col("normal_high")).cast("int"))
    return W.episodes(f, "tag_id", "reading_ts", "flag")


@query("monitor_slices", sql=GOLD_SQL.format(low_reason="", low_cond="").replace(
    "SELECT reading_id, tag_id, reading_ts, value, round(z, 2) AS zscore,", ", gold AS (SELECT reading_id, tag_id, reading_ts, value, round(z, 2) AS zscore,", 1)
    .rstrip() + """)
SELECT 'hour' AS slice, strftime(date_trunc('hour', reading_ts), '%Y-%m-%d %H:00') AS k, count(*) AS n FROM gold GROUP BY 2
UNION ALL SELECT 'area', 'area_' || CAST(CAST(regexp_extract(tag_id, '(\\d+)$', 1) AS INTEGER) % 3 AS VARCHAR), count(*) FROM gold GROUP BY 2
UNION ALL SELECT 'reason', detect_reason, count(*) FROM gold GROUP BY 2
UNION ALL SELECT 'tag', tag_id, count(*) FROM gold GROUP BY 2
""")
def monitor_slices(spark, d):
    """Dashboard slices over the anomaly table (per hour, area, reason,
    tag) in ONE aggregate: every anomaly emits its four (slice, key) pairs."""
    g = gold(spark, d)
    area = F.concat(F.lit("area_"), (F.regexp_extract("tag_id", r"(\d+)$", 1).cast("int") % 3).cast("string"))
    pairs = F.array(
        F.struct(F.lit("hour").alias("slice"), F.date_format(F.date_trunc("hour", "reading_ts"), "yyyy-MM-dd HH:00").alias("k")),
        F.struct(F.lit("area").alias("slice"), area.alias("k")),
        F.struct(F.lit("reason").alias("slice"), F.col("detect_reason").alias("k")),
        F.struct(F.lit("tag").alias("slice"), F.col("tag_id").alias("k")))
    return (g.select(F.explode(pairs).alias("p")).groupBy("p.slice", "p.k")
            .agg(F.count(F.lit(1)).alias("n")))


@query("monitor_newest", sql=GOLD_SQL.format(low_reason="", low_cond="") + " ORDER BY reading_ts DESC, reading_id LIMIT 20")
def monitor_newest(spark, d):
    """The newest 20 anomalies (top-k with a unique tie-break)."""
    return gold(spark, d).orderBy(F.col("reading_ts").desc(), "reading_id").limit(20)


@query("monitor_series", sql=SENSOR_CTE + ROLLING_SQL + f"""
SELECT reading_id, reading_ts, value, {R('roll_mean')} AS roll_mean, normal_low, normal_high, crit_threshold,
       coalesce(value > crit_threshold, false) OR abs(z) > 3 AS is_anomaly
FROM z JOIN dim_tag t USING (tag_id) WHERE z.tag_id = 'click_1'
""")
def monitor_series(spark, d, tag="click_1"):
    """One tag's series with its bands and anomalies; the tag filter is
    applied before the rolling window, so only that tag is windowed."""
    r = B.readings(spark, d).where(F.col("tag_id") == tag)
    z = W.rolling_z(r, "tag_id", "reading_ts", "value", 12, block_rows=BLOCK_ROWS)
    t = B.dim_tag(spark, d).select("tag_id", "normal_low", "normal_high", "crit_threshold")
    hit = F.coalesce(F.col("value") > F.col("crit_threshold"), F.lit(False)) | (F.abs("z") > 3)
    return z.join(t, "tag_id").select("reading_id", "reading_ts", "value", F.round("roll_mean", 6).alias("roll_mean"),
                                      "normal_low", "normal_high", "crit_threshold", hit.alias("is_anomaly"))


RECALL_SQL = B.cte(intervals=B.INTERVALS_SQL) + """,
det AS (SELECT e.event_id, e.user_id, e.ts FROM events e WHERE e.value > 90),
hit AS (SELECT i.user_id, i.start_ts, i.anomaly_type, count(det.event_id) AS n_hits
        FROM intervals i LEFT JOIN det ON det.user_id = i.user_id AND det.ts BETWEEN i.start_ts AND i.end_ts
        GROUP BY ALL)
SELECT anomaly_type, count(*) AS n_windows, count(*) FILTER (WHERE n_hits > 0) AS n_hit,
       round(count(*) FILTER (WHERE n_hits > 0) / count(*), 4) AS recall
FROM hit GROUP BY ROLLUP (anomaly_type)
"""


@query("window_recall", sql=RECALL_SQL.replace("GROUP BY ROLLUP (anomaly_type)", "GROUP BY anomaly_type") + """
UNION ALL
SELECT 'ALL', count(*), count(*) FILTER (WHERE n_hits > 0), round(count(*) FILTER (WHERE n_hits > 0) / count(*), 4)
FROM hit
""")
def window_recall(spark, d):
    """M8: share of labelled intervals hit at least once, by type and overall.
    Detections here are readings above 90 (a fixed rule, so the check is exact)."""
    from mlframe.operators.metrics import window_recall as wr
    from mlframe.sources.tables import read
    det = read(spark, d, "events", ["event_id", "user_id", "ts", "value"]).where("value > 90")
    return wr(B.intervals(spark, d), det, "user_id", "ts", "anomaly_type", "event_id")
