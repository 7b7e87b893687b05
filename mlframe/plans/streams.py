"""Streaming queries (2.I, S4, S6, S12, S16, J13). Each lands the given
tables as successive files in a fresh folder under the shared checkpoint
root, runs the stream to a drain (``availableNow``, one file per trigger)
and returns the sink read back; the oracle is the batch twin in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from mlframe import bindings as B
from mlframe.operators import windows as W
from mlframe.operators.quality import Rule
from mlframe.plans import query
from mlframe.plans.feature_store import COUNTERS_SQL, PAY
from mlframe.plans.sensors import GOLD_SQL, ROLLING_SQL, SENSOR_CTE
from mlframe.plans.sql import R
from mlframe.session import scratch_dir
from mlframe.sources.tables import read
from mlframe.streaming import operators as SO
from mlframe.streaming import progress as SP
from mlframe.streaming import sinks as SK
from mlframe.streaming import sources as SS

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])
READING_SCHEMA = T.StructType([
    T.StructField("reading_id", T.LongType()), T.StructField("reading_ts", T.TimestampNTZType()),
    T.StructField("tag_id", T.StringType()), T.StructField("asset_id", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("quality_code", T.StringType())])
N_PARTS = 3
FILE_ROWS = 100_000


def _parts(df, id_col):
    """Split rows into N_PARTS consecutive id ranges (ids grow with time)."""
    hi = df.agg(F.max(id_col)).first()[0] + 1
    return df.withColumn("_part", F.floor(F.col(id_col) * N_PARTS / F.lit(hi)).cast("int")), list(range(N_PARTS))


def _land_events(spark, d, fmt, extra_rescue=False, files=SS.FILES):
    root = scratch_dir(spark, "stream")
    e = read(spark, d, "events")
    if extra_rescue:  # a field the bronze schema does not know
        e = e.withColumn("k", F.when(F.col("event_type") == "signup", F.get_json_object("props", "$.k")))
    e, parts = _parts(e, "event_id")
    SS.land(e, f"{root}/landing", "_part", parts, fmt=fmt, files=files)
    return root


def _land_readings(spark, d, fmt="json"):
    root = scratch_dir(spark, "stream")
    r, parts = _parts(B.readings(spark, d), "reading_id")
    SS.land(r, f"{root}/landing", "_part", parts, fmt=fmt)
    return root


EVENTS_SQL = "SELECT event_id, ts, user_id, event_type, value, props FROM events"


@query("json_file_stream", sql="""
SELECT event_id, ts, user_id, event_type, value, props,
       CASE WHEN event_type = 'signup' THEN '{"k":"' || json_extract_string(props, '$.k') || '"}' END AS _rescued_data
FROM events
UNION ALL
SELECT CASE WHEN event_id % 2 = 0 THEN -event_id - 1 END, NULL, NULL, NULL, NULL, NULL,
       CASE WHEN event_id % 2 = 0 THEN '{"value":"n/a"}' ELSE '{"_corrupt_record":"broken ' || event_id || '"}' END
FROM events WHERE event_type = 'click'
""")
def json_file_stream(spark, d):
    """Bronze ingest of newline JSON with a rescue column: an unknown field,
    a value of the wrong type and a line that is no JSON, none of them lost."""
    root = _land_events(spark, d, "json", extra_rescue=True)
    e = read(spark, d, "events", ["event_id", "event_type"]).where("event_type = 'click'")
    odd = F.when(F.col("event_id") % 2 == 0, F.format_string('{"event_id":%d,"value":"n/a"}', -F.col("event_id") - 1)).otherwise(
        F.format_string("broken %d", "event_id"))
    e.select(odd.alias("value")).write.mode("append").text(f"{root}/landing")
    s = SS.bronze_json_stream(spark, f"{root}/landing", EVENT_SCHEMA, max_files=SS.FILES)
    SK.drain(SK.start_append(s, f"{root}/out", f"{root}/ckpt"))
    return spark.read.parquet(f"{root}/out").drop("_source_file", "_ingested_at")


@query("table_stream", sql=EVENTS_SQL)
def table_stream(spark, d):
    """A landing table read as a stream, appended to a scored table."""
    root = _land_events(spark, d, "parquet")
    s = SS.table_stream(spark, f"{root}/landing", EVENT_SCHEMA, max_files=SS.FILES)
    SK.drain(SK.start_append(s, f"{root}/out", f"{root}/ckpt"))
    return spark.read.parquet(f"{root}/out")


@query("csv_file_stream", sql=EVENTS_SQL)
def csv_file_stream(spark, d):
    """Headered CSV files ingested incrementally."""
    root = _land_events(spark, d, "csv")
    s = SS.csv_stream(spark, f"{root}/landing", EVENT_SCHEMA, max_files=SS.FILES)
    SK.drain(SK.start_append(s, f"{root}/out", f"{root}/ckpt"))
    return spark.read.parquet(f"{root}/out")


@query("stream_to_table", sql=EVENTS_SQL)
def stream_to_table(spark, d):
    """Checkpointed append; a second run from the same checkpoint after
    a new file lands adds only that file's rows (no duplicates)."""
    root = scratch_dir(spark, "stream")
    e, parts = _parts(read(spark, d, "events"), "event_id")
    SS.land(e, f"{root}/landing", "_part", parts[:-1])
    src = lambda: SS.table_stream(spark, f"{root}/landing", EVENT_SCHEMA, max_files=SS.FILES)
    SK.drain(SK.start_append(src(), f"{root}/out", f"{root}/ckpt"))
    SS.land(e, f"{root}/landing", "_part", parts[-1:])
    SK.drain(SK.start_append(src(), f"{root}/out", f"{root}/ckpt"))  # restart: same checkpoint
    return spark.read.parquet(f"{root}/out")


@query("drain_available", sql="SELECT event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1")
def drain_available(spark, d):
    """Process everything pending, then stop (availableNow)."""
    root = _land_events(spark, d, "parquet")
    s = SS.table_stream(spark, f"{root}/landing", EVENT_SCHEMA, max_files=SS.FILES)
    SK.drain(SK.start_append(s, f"{root}/out", f"{root}/ckpt", trigger="available_now"))
    out = spark.read.parquet(f"{root}/out")
    return out.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("micro_batch", sql=EVENTS_SQL)
def micro_batch(spark, d):
    """Fixed-interval trigger with a bounded run time; stops once the
    landed files are processed (rows-only check: timing-dependent batches)."""
    root = _land_events(spark, d, "parquet")
    s = SS.table_stream(spark, f"{root}/landing", EVENT_SCHEMA, max_files=SS.FILES)
    q = SK.start_append(s, f"{root}/out", f"{root}/ckpt", trigger="1 second")
    q.processAllAvailable()
    SK.run_for(q, 0.1)
    return spark.read.parquet(f"{root}/out")


def _nb_sql(source: str, x: str, label: str) -> str:
    """Gaussian naive Bayes of one feature from the moments of both classes: the posterior of class 1."""
    return f"""
m AS (SELECT ln(count(*) FILTER (WHERE {label} = 1) / count(*)) AS p1, ln(count(*) FILTER (WHERE {label} = 0) / count(*)) AS p0,
             avg({x}) FILTER (WHERE {label} = 1) AS m1, avg({x}) FILTER (WHERE {label} = 0) AS m0,
             var_pop({x}) FILTER (WHERE {label} = 1) AS v1, var_pop({x}) FILTER (WHERE {label} = 0) AS v0 FROM {source}),
s AS (SELECT t.*, 1.0 / (1.0 + exp((p0 - 0.5 * ln(v0) - ({x} - m0) * ({x} - m0) / (2 * v0))
                                   - (p1 - 0.5 * ln(v1) - ({x} - m1) * ({x} - m1) / (2 * v1)))) AS score FROM {source} t, m)"""


def fit_gaussian(df, x: str, label: str):
    """A fitted ``pyspark.ml`` pipeline: Gaussian naive Bayes of one numeric feature (null feature rows do not train)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.feature import VectorAssembler

    stages = [VectorAssembler(inputCols=[x], outputCol="features", handleInvalid="keep"),
              NaiveBayes(modelType="gaussian", labelCol=label, featuresCol="features")]
    return Pipeline(stages=stages).fit(df.dropna(subset=[x, label]))


@query("stream_score", sql=f"""
WITH e AS (SELECT event_id, value, CAST(event_type = 'purchase' AS INTEGER) AS label FROM events), {_nb_sql("e", "value", "label")}
SELECT event_id, {R('score')} AS score, CAST(score >= 0.2 AS INTEGER) AS alert FROM s
""")
def stream_score(spark, d):
    """Stateless scoring of a stream with a fitted model (is the event a
    purchase, by its value)."""
    root = _land_events(spark, d, "parquet")
    e = read(spark, d, "events", ["value", "event_type"])
    model = fit_gaussian(e.select("value", (F.col("event_type") == "purchase").cast("double").alias("label")), "value", "label")
    s = SS.table_stream(spark, f"{root}/landing", EVENT_SCHEMA, max_files=SS.FILES)
    scored = SO.score_stream(s, model, threshold=0.2).select("event_id", "score", "alert")
    SK.drain(SK.start_append(scored, f"{root}/out", f"{root}/ckpt"))
    return spark.read.parquet(f"{root}/out").withColumn("score", F.round("score", 6))


@query("score_and_produce", sql=PAY + ", p AS (SELECT *, CAST(outcome = 'hard_fail' AS INTEGER) AS label FROM payments), "
       + _nb_sql("p", "amount", "label") + f"""
SELECT CAST(account_id AS VARCHAR) AS key, event_id, account_id,
       CASE WHEN score >= 0.05 THEN 'blocked' ELSE 'pass' END AS decision, {R('score')} AS model_output, TRUE AS stamped
FROM s
""")
def score_and_produce(spark, d):
    """T4: per micro-batch score with a fitted model, decide and write keyed
    JSON messages by epoch; read back and decoded."""
    root = scratch_dir(spark, "stream")
    pay = B.payments(spark, d)
    model = fit_gaussian(pay.select("amount", (F.col("outcome") == "hard_fail").cast("double").alias("label")), "amount", "label")
    p, parts = _parts(pay.select("event_id", "account_id", "amount", "event_ts"), "event_id")
    SS.land(p, f"{root}/landing", "_part", parts)
    schema = "event_id long, account_id long, amount double, event_ts timestamp_ntz"
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", SS.FILES).parquet(f"{root}/landing")
    SK.drain(SK.for_each_batch(s, SO.produce_decisions(f"{root}/out", model, threshold=0.05), f"{root}/ckpt"))
    msgs = spark.read.parquet(f"{root}/out").select("key", F.col("value").cast("binary").alias("value"))
    dec = SS.decode(msgs, T.StructType.fromDDL("event_id long, account_id long, decision string, model_output double, scored_at timestamp"))
    return dec.select("key", "event_id", "account_id", "decision", "model_output", F.col("scored_at").isNotNull().alias("stamped"))


def _silver(spark, d, bronze):
    tags = B.dim_tag(spark, d).select("tag_id", "crit_threshold", "normal_low", "normal_high")
    assets = B.dim_asset(spark, d)
    return bronze.join(tags, "tag_id", "left").join(assets, "asset_id", "left")


@query("stream_static_enrich", sql=SENSOR_CTE + ", dim_asset AS (" + B.DIM_ASSET_SQL + ")" + """
SELECT r.reading_id, r.tag_id, r.asset_id, r.value, t.crit_threshold, t.normal_low, t.normal_high, a.area, a.work_center
FROM readings r LEFT JOIN dim_tag t ON r.tag_id = t.tag_id LEFT JOIN dim_asset a ON r.asset_id = a.asset_id
""")
def stream_static_enrich(spark, d):
    """Bronze stream left-joined to two static dimensions."""
    root = _land_readings(spark, d)
    bronze = SS.bronze_json_stream(spark, f"{root}/landing", READING_SCHEMA, max_files=SS.FILES, rescue=False)
    silver = _silver(spark, d, bronze).select("reading_id", "tag_id", "asset_id", "value", "crit_threshold",
                                               "normal_low", "normal_high", "area", "work_center")
    SK.drain(SK.start_append(silver, f"{root}/out", f"{root}/ckpt"))
    return spark.read.parquet(f"{root}/out")


def _gold_batch(silver):
    z = W.rolling_z(silver, "tag_id", "reading_ts", "value", 12)
    g = W.detect(z)
    return g.select("reading_id", "tag_id", "reading_ts", "value", "zscore", "detect_reason", "_old")


@query("medallion_stream", sql=GOLD_SQL.format(low_reason="", low_cond=""))
def medallion_stream(spark, d):
    """T5: bronze -> silver -> gold, appended per epoch: each batch reads the
    last 12 readings of each tag before it, which its rolling windows need."""
    root = _land_readings(spark, d)
    bronze = SS.bronze_json_stream(spark, f"{root}/landing", READING_SCHEMA, max_files=SS.FILES, rescue=False) \
        .drop("_source_file", "_ingested_at")
    tags = B.dim_tag(spark, d).select("tag_id", "crit_threshold", "normal_low")
    assets = B.dim_asset(spark, d)
    SK.drain(SO.medallion(spark, bronze, tags, assets, f"{root}/silver", f"{root}/gold", f"{root}/ckpt", _gold_batch))
    return spark.read.parquet(f"{root}/gold").drop("epoch")


@query("stream_rolling_z", sql=SENSOR_CTE + ROLLING_SQL + f"""
SELECT reading_id, tag_id, {R('roll_mean')} AS roll_mean, {R('roll_std')} AS roll_std, {R('z')} AS z FROM z
""")
def stream_rolling_z(spark, d):
    """Rolling z-score kept incrementally in per-tag state."""
    root = _land_readings(spark, d, fmt="parquet")
    s = spark.readStream.schema(READING_SCHEMA).option("maxFilesPerTrigger", SS.FILES).parquet(f"{root}/landing")
    with SK.rocksdb_state(spark):
        query = SK.start_append(SO.stream_rolling_z(s), f"{root}/out", f"{root}/ckpt")
    SK.drain(query)
    out = spark.read.parquet(f"{root}/out")
    return out.select("reading_id", "tag_id", F.round("roll_mean", 6).alias("roll_mean"),
                      F.round("roll_std", 6).alias("roll_std"), F.round("z", 6).alias("z"))


WINDOW_SQL = f"""
WITH w AS (
  SELECT user_id, value, time_bucket(INTERVAL 5 MINUTE, ts) - INTERVAL (k * 5) MINUTE AS window_start
  FROM events, range(0, 12) r(k))
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, user_id, count(value) AS value_count,
       round(sum(value), 2) / count(value) AS value_avg, round(sum(value), 2) AS value_sum,
       {R('stddev_pop(value)')} AS value_stddev_pop
FROM w GROUP BY ALL
"""


def _window_round(df):
    return df.select("window_start", "window_end", "user_id", "value_count",
                     (F.round("value_sum", 2) / F.col("value_count")).alias("value_avg"),
                     F.round("value_sum", 2).alias("value_sum"), F.round("value_stddev_pop", 6).alias("value_stddev_pop"))


@query("declared_window_feature", sql=WINDOW_SQL)
def declared_window_feature(spark, d):
    """Declared 1-hour / 5-minute sliding count, mean, sum and population
    stddev per user; update mode into an epoch log, newest version per key.

    A row enters twelve windows and a task groups the windows of its file, so a step has a file per ``FILE_ROWS`` rows."""
    files = max(SS.FILES, -(-read(spark, d, "events").count() // (N_PARTS * FILE_ROWS)))
    root = _land_events(spark, d, "parquet", files=files)
    s = SS.table_stream(spark, f"{root}/landing", EVENT_SCHEMA, max_files=files)
    spec = SO.WindowFeature(key="user_id", ts="ts", col="value")
    agg = SO.window_feature(s, spec)
    SK.drain(SK.for_each_batch(agg, SO.update_log_writer(f"{root}/out", ["window_start", "user_id"]), f"{root}/ckpt", output_mode="update"))
    return _window_round(SO.read_update_log(spark, f"{root}/out", ["window_start", "user_id"]))


@query("declared_window_batch", sql=WINDOW_SQL)
def declared_window_batch(spark, d):
    """T7's batch twin: the same declaration compiled on the table."""
    spec = SO.WindowFeature(key="user_id", ts="ts", col="value")
    return _window_round(SO.window_feature(read(spark, d, "events"), spec))


@query("running_counts", sql="SELECT user_id, count(*) AS n, max(ts) AS newest_ts FROM events GROUP BY user_id")
def running_counts(spark, d):
    """Running count and newest event time per key across micro-batches."""
    root = _land_events(spark, d, "parquet")
    s = SS.table_stream(spark, f"{root}/landing", EVENT_SCHEMA, max_files=SS.FILES)
    agg = SO.running_counts(s, "user_id", "ts")
    SK.drain(SK.for_each_batch(agg, SO.update_log_writer(f"{root}/out", "user_id", compact_every=2), f"{root}/ckpt", output_mode="update"))
    return SO.read_update_log(spark, f"{root}/out", "user_id")


@query("counter_refresh", sql=PAY + f""",
recent AS (SELECT * FROM payments WHERE event_ts >= (SELECT max(event_ts) FROM payments) - INTERVAL 1 HOUR),
agg AS ({COUNTERS_SQL.replace('FROM payments', 'FROM recent')})
SELECT u.instrument_id, coalesce(inst_txn_cnt, 0) AS inst_txn_cnt, coalesce(inst_fail_cnt, 0) AS inst_fail_cnt,
       coalesce(inst_distinct_accounts, 0) AS inst_distinct_accounts, coalesce(inst_avg_amount, 0) AS inst_avg_amount,
       coalesce(inst_max_amount, 0) AS inst_max_amount, coalesce(inst_fail_ratio, 0) AS inst_fail_ratio
FROM (SELECT DISTINCT instrument_id FROM payments) u LEFT JOIN agg USING (instrument_id)
""")
def counter_refresh(spark, d):
    """Two refresh ticks, then a second start that goes on from the last version."""
    root = scratch_dir(spark, "counters")
    SO.refresh_loop(spark, lambda: B.payments(spark, d), f"{root}/counters", every_s=0.0, max_ticks=2)
    paths = SO.refresh_loop(spark, lambda: B.payments(spark, d), f"{root}/counters", every_s=0.0, max_ticks=1)
    return spark.read.parquet(paths[-1])


@query("freshness_kpi")
def freshness_kpi(spark, d):
    """Per-batch freshness log and its percentiles (timing-dependent,
    rows-only check)."""
    from mlframe.operators.aggs import latency_summary
    root = _land_events(spark, d, "parquet")
    s = SS.table_stream(spark, f"{root}/landing", EVENT_SCHEMA, max_files=SS.FILES)
    SK.drain(SK.for_each_batch(s, SO.freshness_logger(f"{root}/log", "ts"), f"{root}/ckpt"))
    log = spark.read.parquet(f"{root}/log").withColumn(
        "freshness_s", F.unix_micros("available_at") / 1e6 - F.unix_micros("newest_event") / 1e6)
    return latency_summary(log, "freshness_s")


@query("stream_progress", sql=f"""
WITH parts AS (SELECT user_id, ts, CAST(floor(event_id * {N_PARTS} / (SELECT max(event_id) + 1 FROM events)) AS BIGINT) AS part FROM events),
batches AS (SELECT part AS batch_id, count(*) AS n_input_rows, max(ts) AS newest FROM parts GROUP BY part)
SELECT batch_id, n_input_rows,
       coalesce(date_trunc('millisecond', max(newest) OVER (ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) - INTERVAL 1 HOUR,
                TIMESTAMP '1970-01-01') AS watermark,
       (SELECT count(DISTINCT user_id) FROM parts WHERE part <= batch_id) AS state_rows
FROM batches
""")
def stream_progress(spark, d):
    """What a listener wrote about a running count, per micro-batch: its
    input rows, the watermark it ran with and the keys in its state."""
    root = _land_events(spark, d, "parquet")
    s = SS.table_stream(spark, f"{root}/landing", EVENT_SCHEMA, max_files=SS.FILES)
    agg = SO.running_counts(s.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", "1 hour"), "user_id", "ts")
    SP.logged(spark, f"{root}/progress", lambda: SK.drain(
        SK.for_each_batch(agg, SO.update_log_writer(f"{root}/out", "user_id"), f"{root}/ckpt", output_mode="update")))
    p = SP.read_progress(spark, f"{root}/progress").where("n_input_rows > 0")
    return p.select("batch_id", "n_input_rows", F.col("watermark").cast("timestamp_ntz").alias("watermark"), "state_rows")


STREAM_RULES = [Rule("has_id", "event_id IS NOT NULL", "fail"), Rule("positive_value", "value > 0", "warn"), Rule("known_type", "event_type IS NOT NULL", "drop"),
                Rule("value_below_99", "value < 99", "drop")]


@query("stream_expectations", sql=EVENTS_SQL + " WHERE coalesce(event_type IS NOT NULL, false) AND coalesce(value < 99, false)")
def stream_expectations(spark, d):
    """Expectation rules on a stream (counts in the progress metrics)."""
    root = _land_events(spark, d, "parquet")
    s = SS.table_stream(spark, f"{root}/landing", EVENT_SCHEMA, max_files=SS.FILES)
    kept = SO.expect_stream(s, STREAM_RULES)
    SK.drain(SK.start_append(kept, f"{root}/out", f"{root}/ckpt"))
    return spark.read.parquet(f"{root}/out")


@query("bus_envelope", sql=PAY + "SELECT CAST(account_id AS VARCHAR) AS key, event_id, account_id, category_code, amount FROM payments")
def bus_envelope(spark, d):
    """Encode (key + JSON value) and decode back to columns."""
    p = B.payments(spark, d)
    env = SS.encode(p, "account_id", ["event_id", "account_id", "category_code", "amount"])
    schema = T.StructType.fromDDL("event_id long, account_id long, category_code string, amount double")
    return SS.decode(env.select(F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value")), schema)
