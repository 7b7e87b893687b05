"""Data quality, profiling, drift and provenance (Q1-Q7)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from mlframe.operators.aggs import bin_index
from mlframe.operators.drift import js_distance


@dataclass(frozen=True)
class Rule:
    """Named row rule; ``action`` is ``warn`` (keep), ``drop`` or ``fail``."""

    name: str
    condition: str
    action: str = "warn"

    def ok(self) -> Column:
        # a null condition counts as a violation
        return F.coalesce(F.expr(self.condition), F.lit(False))


class ExpectationFailed(Exception):
    pass


def violation_counts(df: DataFrame, rules) -> DataFrame:
    """Q1: per-rule violation counts in one aggregate, long form."""
    agg = df.agg(*[F.count_if(~r.ok()).alias(f"_v{i}") for i, r in enumerate(rules)])
    stack = ", ".join(f"'{r.name}', '{r.action}', _v{i}" for i, r in enumerate(rules))
    return agg.selectExpr(f"stack({len(rules)}, {stack}) AS (rule, action, n_violations)")


def expect(df: DataFrame, rules, observation: Observation | None = None) -> DataFrame:
    """Apply rules to rows. ``drop`` rules filter, ``warn`` rules are
    only counted, ``fail`` rules raise. Counts are collected with
    ``observe`` as the rows flow (works on batch and streaming frames).
    ``fail`` rules are checked by one aggregate before a batch is returned; on
    a stream the first violating row ends the query."""
    fails = [r for r in rules if r.action == "fail"]
    if fails and not df.isStreaming:
        bad = df.agg(*[F.count_if(~r.ok()).alias(r.name) for r in fails]).first()
        hit = {k: v for k, v in bad.asDict().items() if v}
        if hit:
            raise ExpectationFailed(f"expectations failed: {hit}")
    out = df
    if observation is not None:
        out = out.observe(observation, *[F.count_if(~r.ok()).alias(r.name) for r in rules])
    if df.isStreaming:
        out = fail_rows(out, rules)
    keep = [r.ok() for r in rules if r.action == "drop"]
    for k in keep:
        out = out.where(k)
    return out


def fail_rows(df: DataFrame, rules) -> DataFrame:
    """The rows, with an error as soon as one violates a ``fail`` rule."""
    for r in rules:
        if r.action == "fail":
            df = df.where(F.when(r.ok(), F.lit(True)).otherwise(
                F.raise_error(F.lit(f"expectation failed: {r.name}")).cast("boolean")))
    return df


def invariants(df: DataFrame, checks) -> DataFrame:
    """Q2: each check is (name, aggregate over ``df``, predicate SQL on
    ``value``); all of them are one aggregate over one scan. The result is
    (name, ok, value); a check without a value (an empty table) is not ok."""
    one = df.agg(*[c.cast("double").alias(f"_v{i}") for i, (_, c, _) in enumerate(checks)])
    rows = one.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("name"), F.lit(i).alias("i"), F.col(f"_v{i}").alias("value")) for i, (n, _, _) in enumerate(checks)])).alias("r")).select("r.*")
    ok = F.lit(False)
    for i, (_, _, pred) in enumerate(checks):
        ok = F.when(F.col("i") == i, F.coalesce(F.expr(pred), F.lit(False))).otherwise(ok)
    return rows.select("name", ok.alias("ok"), "value")


def profile(df: DataFrame, cols, slice_col: str | None, ts: str, window: str = "day") -> DataFrame:
    """Q3: per time window, slice ("*" = all rows) and column: count, nulls,
    % null, mean and distinct count. Columns are unpivoted once so a single
    aggregate (with a grouping set for the all-slices row) does the work."""
    long = df.select(F.date_trunc(window, ts).cast("timestamp_ntz").alias("window_start"),
                     (F.col(slice_col) if slice_col else F.lit("*")).alias("slice"),
                     *[F.col(c).cast("double").alias(c) for c in cols]) \
        .unpivot(["window_start", "slice"], list(cols), "column", "v")
    aggs = [F.count(F.lit(1)).alias("n"), F.count_if(F.col("v").isNull()).alias("nulls"),
            F.round(F.avg(F.col("v").isNull().cast("double")) * 100, 4).alias("pct_null"),
            F.avg("v").alias("mean"), F.count_distinct("v").alias("distinct")]
    if slice_col:  # each value counts for its slice and for "*": one aggregate, one shuffle
        long = long.withColumn("slice", F.explode(F.array(F.col("slice"), F.lit("*"))))
    return long.groupBy("window_start", "slice", "column").agg(*aggs)


def js_drift(df: DataFrame, col: str, ts: str, lo: float, hi: float, bins: int = 20,
             window: str = "day", digits: int = 6) -> DataFrame:
    """Q4: Jensen-Shannon distance (base 2, sqrt of the divergence) between
    the binned distribution of ``col`` in each window and the previous one.
    ``window`` is a ``date_trunc`` unit or an interval such as "5 minutes".
    Values below ``lo`` and from ``hi`` on have bins of their own (-1 and
    ``bins``), so a drift out of the range shows; a null value has bin -2.

    The histogram is built once; each window's is one small map, and a lag
    over the windows pairs them."""
    bin_ = F.coalesce(bin_index(col, lo, hi, bins), F.lit(-2))
    w = F.window(ts, window).start if " " in window else F.date_trunc(window, ts)
    counts = df.groupBy(w.cast("timestamp_ntz").alias("window_start"), bin_.alias("bin")).agg(F.count(F.lit(1)).alias("c"))
    hist = counts.groupBy("window_start").agg(F.map_from_entries(F.collect_list(F.struct("bin", "c"))).alias("h"), F.sum("c").alias("total"))
    before = F.lag(F.struct(F.col("window_start").alias("at"), "h", "total")).over(Window.orderBy("window_start"))
    pairs = hist.withColumn("o", before).where("o IS NOT NULL")
    distance = js_distance(F.col("h"), F.col("total"), F.col("o.h"), F.col("o.total"), bins)
    return pairs.select("window_start", F.col("o.at").alias("prev_window"), F.round(distance, digits).alias("js_distance"))


def provenance(tables) -> DataFrame:
    """Q5: rows and newest score time per (model, version, run) across prediction
    tables (a union of partial aggregates)."""
    keys = ("model_name", "model_version", "model_run_id")
    parts = [t.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), F.max("scored_at").alias("last_scored_at")) for t in tables]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy(*keys).agg(F.sum("n_rows").alias("n_rows"), F.max("last_scored_at").alias("last_scored_at"))


LOG = "event_id string, target string, source string, last_seen timestamp, n_rows long, n_files long"


def log_lineage(sources: dict, target: str, log: str) -> DataFrame:
    """Q6, write side: append one event per upstream table of ``target`` to the
    lineage log: its rows, files and newest file time, counted from the rows
    themselves (the file-source metadata column; no data column is read)."""
    parts = [df.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_modification_time").alias("m"))
             .agg(F.max("m").alias("last_seen"), F.count(F.lit(1)).alias("n_rows"), F.count_distinct("f").alias("n_files"))
             .select(F.expr("uuid()").alias("event_id"), F.lit(target).alias("target"), F.lit(name).alias("source"), "last_seen", "n_rows", "n_files")
             for name, df in sources.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out.write.mode("append").parquet(log)
    return out.sparkSession.read.schema(LOG).parquet(log)


def upstream(log: DataFrame, target: str) -> DataFrame:
    """Q6, read side: every table that ``target`` comes from, directly or over
    other targets, with its distance, newest event and rows as logged last.
    Cycles in the log end where nothing new appears."""
    edges = log.select("target", "source").distinct()
    found = edges.where(F.col("target") == target).select("source").withColumn("depth", F.lit(1)).checkpoint()
    step = found
    depth = 1
    while not step.isEmpty():
        depth += 1
        step = (step.select(F.col("source").alias("target")).join(edges, "target").select("source").distinct()
                .join(found.select("source"), "source", "left_anti").withColumn("depth", F.lit(depth)).checkpoint())
        found = found.unionByName(step)
    last = log.groupBy("source").agg(F.max("last_seen").alias("last_seen"), F.max_by("n_rows", "last_seen").alias("n_rows"),
                                     F.count(F.lit(1)).alias("n_events"))
    return found.join(last, "source").select(F.lit(target).alias("target"), "source", "depth", "last_seen", "n_rows", "n_events")
