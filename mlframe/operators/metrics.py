"""Evaluation operators (M3-M8, M26, M27): every metric is an aggregate over
the scored table, never a collect of scores to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mlframe.operators.joins import match_intervals
from mlframe.operators.ranking import ROWS_EACH, running_sums, value_buckets
from mlframe.session import ensure_checkpoint_dir


def window_recall(intervals: DataFrame, detections: DataFrame, key: str, ts: str, kind: str,
                  det_id: str, digits: int = 4) -> DataFrame:
    """M8: per interval, did any detection fall inside it (closed); recall by
    interval type plus an overall ``ALL`` row."""
    j = match_intervals(intervals, detections, key, ts)
    per = j.groupBy(F.col(f"w.{key}").alias(key), F.col("w.start_ts").alias("start_ts"),
                    F.col(f"w.{kind}").alias(kind)).agg(F.count(F.col(f"p.{det_id}")).alias("n_hits"))
    agg = [F.count(F.lit(1)).alias("n_windows"), F.count_if(F.col("n_hits") > 0).alias("n_hit")]
    by_kind = per.groupBy(kind).agg(*agg)
    total = per.agg(F.lit("ALL").alias(kind), *agg)
    out = by_kind.unionByName(total)
    return out.withColumn("recall", F.round(F.col("n_hit") / F.col("n_windows"), digits))


def threshold_metrics(df: DataFrame, label: str, flag, by=(), digits: int = 6) -> DataFrame:
    """M4: precision, recall, F1 and alert rate in one conditional aggregate;
    a zero denominator gives 0."""
    by = [by] if isinstance(by, str) else list(by)
    f = F.col(flag) if isinstance(flag, str) else flag
    y = F.col(label) == 1
    tp = F.count_if(y & f)
    fp = F.count_if(~y & f)
    fn = F.count_if(y & ~f)
    n = F.count(F.lit(1))
    out = df.groupBy(*by).agg(tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), n.alias("n"))
    prec = F.when(F.col("tp") + F.col("fp") > 0, F.col("tp") / (F.col("tp") + F.col("fp"))).otherwise(0.0)
    rec = F.when(F.col("tp") + F.col("fn") > 0, F.col("tp") / (F.col("tp") + F.col("fn"))).otherwise(0.0)
    f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(0.0)
    rate = (F.col("tp") + F.col("fp")) / F.col("n")
    return out.select(*by, "tp", "fp", "fn", "n", F.round(prec, digits).alias("precision"),
                      F.round(rec, digits).alias("recall"), F.round(f1, digits).alias("f1"),
                      F.round(rate, digits).alias("alert_rate"))


def score_counts(df: DataFrame, label: str, score: str, by=(), rows: str | None = None) -> DataFrame:
    """Positives and negatives per distinct score (the sufficient statistic
    for every ranking metric); a partial aggregate, so ties collapse before
    the shuffle. A row counts as many as its column ``rows`` says."""
    by = [by] if isinstance(by, str) else list(by)
    n_if = F.count_if if rows is None else lambda c: F.sum(F.when(c, F.col(rows)).otherwise(0))
    return df.groupBy(*by, F.col(score).alias("s")).agg(
        n_if(F.col(label) == 1).cast("double").alias("pos"),
        n_if(F.col(label) != 1).cast("double").alias("neg"))


def curve_points(df: DataFrame, label: str, score: str, by=(), rows_each: int = ROWS_EACH, rows: str | None = None) -> DataFrame:
    """M6: at each distinct score threshold (descending), cumulative TP and FP.

    Running sums go by buckets of about equal numbers of distinct scores, so
    no single task orders all scores, however they pile up."""
    by = [by] if isinstance(by, str) else list(by)
    # the distinct-score table feeds three passes (bounds, running sums,
    # totals): materialise it once in the shared checkpoint folder
    ensure_checkpoint_dir(df.sparkSession)
    sc = score_counts(df, label, score, by, rows).checkpoint(eager=True)
    return running_sums(sc, "s", ["pos", "neg"], value_buckets(sc, "s", rows_each), partition=by, descending=True)


def ranking_metrics(df: DataFrame, label: str, score: str, by=(), digits: int = 6, rows: str | None = None) -> DataFrame:
    """M5: exact ROC-AUC (ties count one half) and average precision.

    AUC = sum over distinct scores of neg * (positives ranked above + pos/2),
    divided by P*N; AP = sum over thresholds of precision * delta recall.
    Null where it is not defined: AUC without positives or negatives, AP
    without positives. A row counts as many as its column ``rows`` says."""
    by = [by] if isinstance(by, str) else list(by)
    cp = curve_points(df, label, score, by, rows=rows)
    tp_above = F.col("pos_cum") - F.col("pos")
    auc_term = F.col("neg") * (tp_above + F.col("pos") / 2.0)
    prec = F.col("pos_cum") / (F.col("pos_cum") + F.col("neg_cum"))
    agg = cp.groupBy(*by).agg(F.sum(auc_term).alias("_auc"), F.sum(F.when(F.col("pos") > 0, prec * F.col("pos"))).alias("_ap"),
                              F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return agg.select(*by, F.round(F.try_divide(F.col("_auc"), F.col("P") * F.col("N")), digits).alias("roc_auc"),
                      F.round(F.try_divide(F.col("_ap"), F.col("P")), digits).alias("avg_precision"))
