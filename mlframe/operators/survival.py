"""Grouped Weibull fits for right-censored lifetimes.

Everything is computed from sufficient statistics per group: the data are
first reduced to (group, lifetime, failed) counts by a partial aggregate, then
every grid point needs only n_failed, sum(ln t) over failures and
sum(t^beta) over all units. Tasks sum those powers in numpy over their own
rows, so what is shuffled is groups x grid points, never rows x grid.

For a fixed shape beta the scale that maximises the censored likelihood is
closed form: alpha^beta = sum(t^beta) / n_failed, so the MLE is a 1-D search
over beta (coarse grid, then a fine grid around the best coarse point).
"""

from __future__ import annotations

import math
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mlframe.operators.ranking import _left, _same
from mlframe.session import ensure_checkpoint_dir

# ---- fixed values that must equal the reference's --------------------------
# Bayesian grid: beta in linspace(0.3, 8.0, 400), alpha in linspace(10, 400, 400);
# priors beta ~ Gamma(shape 4, scale 0.5), ln(alpha) ~ Normal(ln 70, 0.6)
# (density of ln(alpha), no 1/alpha Jacobian); 90% interval from the alpha
# marginal's cumulative sum at 0.05 and 0.95 (first grid point reaching it).
BAYES_BETA = (0.3, 8.0, 400)
BAYES_ALPHA = (10.0, 400.0, 400)
PRIOR_BETA_SHAPE, PRIOR_BETA_SCALE = 4.0, 0.5
PRIOR_LN_ALPHA_MU, PRIOR_LN_ALPHA_SD = math.log(70.0), 0.6
CI_LO, CI_HI = 0.05, 0.95
# -----------------------------------------------------------------------------

# MLE search grid (ours): coarse beta 0.05..10 step 0.05, then +-0.05 step 0.0005.
# A best point at the coarse grid's end moves the grid on with a wider step, and
# the fine grid is as wide as the step that found it.
COARSE = (0.05, 0.05, 200)      # start, step, points
FINE_HALF, FINE_STEP = 0.05, 0.0005
FINE_POINTS = 201
WIDER = 8.0
FRAME_ROWS = 200_000            # rows that a task hands on at once
WIDEST_BETA = 1e6               # equal lifetimes have no finite optimum: given up here


def lifetime_counts(df: DataFrame, by, t: str = "t", failed: str = "failed") -> DataFrame:
    """Distinct (group, lifetime, failed) with multiplicity ``w``."""
    by = [by] if isinstance(by, str) else list(by)
    return df.groupBy(*by, F.col(t).cast("double").alias("t"), F.col(failed).cast("int").alias("f")) \
        .agg(F.count(F.lit(1)).cast("double").alias("w"))


def _power_sums(cnt: DataFrame, by, points: int) -> DataFrame:
    """Per (group, grid point i): beta = start + i * step, S = sum w * (t / tm)^beta.

    ``cnt`` has the columns _start, _step and _tm (the group's longest
    lifetime, so that no power overflows). Tasks sum their rows in numpy and
    hand on groups x points numbers, so the grid never multiplies rows.
    """
    keys = cnt.select(*by).schema
    order = [f"_k{i}" for i in range(len(by))]
    d = cnt.select(*[F.col(k).alias(o) for k, o in zip(by, order)], "t", "w", "_start", "_step", "_tm")
    schema = T.StructType([*[T.StructField(o, f.dataType) for o, f in zip(order, keys)], T.StructField("i", T.IntegerType()),
                           T.StructField("beta", T.DoubleType()), T.StructField("S", T.DoubleType())])

    def run(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            code, _ = pd.factorize(pd.MultiIndex.from_frame(pdf[order].astype(object).where(pdf[order].notna(), None)), use_na_sentinel=False)
            first = pd.Series(np.arange(len(pdf))).groupby(code).first().to_numpy()
            start, step = pdf["_start"].to_numpy(), pdf["_step"].to_numpy()
            w, log_u = pdf["w"].to_numpy(), np.log(pdf["t"].to_numpy() / pdf["_tm"].to_numpy())
            keys, n = pdf.iloc[first][order], len(first)
            for lo in range(0, points, max(1, FRAME_ROWS // n)):  # many points a frame, few where a batch holds many groups
                at = range(lo, min(points, lo + max(1, FRAME_ROWS // n)))
                part = keys.take(np.tile(np.arange(n), len(at)))
                part["i"] = np.repeat(np.array(at, dtype="int32"), n)
                part["beta"] = np.concatenate([start[first] + i * step[first] for i in at])
                part["S"] = np.concatenate([np.bincount(code, weights=w * np.exp((start + i * step) * log_u), minlength=n) for i in at])
                yield part

    sums = d.where("t > 0").mapInPandas(run, schema).groupBy(*order, "i").agg(F.first("beta").alias("beta"), F.sum("S").alias("S"))
    return sums.select(*[F.col(o).alias(k) for k, o in zip(by, order)], "i", "beta", "S")


def _group_stats(cnt: DataFrame, by) -> DataFrame:
    """Per group: n, failures nf, L = sum ln t over failures, longest lifetime _tm."""
    return cnt.groupBy(*by).agg(F.sum("w").alias("n"), F.sum(F.col("w") * F.col("f")).alias("nf"),
                                F.sum(F.when(F.col("f") == 1, F.col("w") * F.log("t"))).alias("L"), F.max("t").alias("_tm"))


def _grid_pass(cnt: DataFrame, by, state: DataFrame, points: int, alpha_max: float | None) -> DataFrame:
    """Log likelihood ``ll`` and ``alpha`` at every grid point of the groups in ``state`` (stats, _start, _step)."""
    st = _left(_power_sums(_same(cnt, state, by), by, points), state, by).where("beta > 0")
    nf, S, b, tm = F.col("nf"), F.col("S"), F.col("beta"), F.col("_tm")
    a_hat = tm * F.pow(F.try_divide(S, nf), 1.0 / b)
    if alpha_max is None:
        ll = nf * F.log(b) - nf * (F.log(F.try_divide(S, nf)) + b * F.log(tm)) + (b - 1) * F.col("L") - nf
        return st.withColumn("alpha", a_hat).withColumn("ll", ll)
    a = F.least(a_hat, F.lit(alpha_max))
    ll = nf * F.log(b) - nf * b * F.log(a) + (b - 1) * F.col("L") - S * F.exp(b * (F.log(tm) - F.log(a)))
    return st.withColumn("alpha", a).withColumn("ll", ll)


def reduce_lifetimes(df: DataFrame, by, t: str = "t", failed: str = "failed") -> tuple[DataFrame, DataFrame]:
    """(counts, statistics) that any number of fits of the same groups can share."""
    by = [by] if isinstance(by, str) else list(by)
    ensure_checkpoint_dir(df.sparkSession)
    cnt = lifetime_counts(df, by, t, failed).checkpoint(eager=True)  # read by every pass
    return cnt, _group_stats(cnt, by).checkpoint(eager=True)


def weibull_mle(df: DataFrame, by, t: str = "t", failed: str = "failed", alpha_max: float | None = None,
                min_failures: int = 1, reduced: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Per group beta, alpha, median life (alpha * ln2^(1/beta)),
    n and failures; null estimates when failures < ``min_failures`` (a group
    without failures included) or when the likelihood has no finite optimum
    (all failures at the longest lifetime).
    With ``alpha_max`` the scale is capped (for a fixed beta the likelihood is
    unimodal in alpha, so the capped optimum is min(alpha_hat, cap)) and
    ``on_cap`` flags a fit pinned to the bound. ``reduced`` is the result of
    ``reduce_lifetimes`` on the same arguments, if there is one."""
    by = [by] if isinstance(by, str) else list(by)
    cnt, stats = reduced or reduce_lifetimes(df, by, t, failed)
    start, step, points = COARSE
    state = stats.where("nf > 0").select("*", F.lit(start).alias("_start"), F.lit(step).alias("_step"))
    found = []
    while True:
        coarse = _grid_pass(cnt, by, state, points, alpha_max)
        best = coarse.groupBy(*by, "_step").agg(F.max_by(F.struct("beta", "i"), "ll").alias("b")).checkpoint(eager=True)
        inside = (F.col("b.i") < points - 1) if alpha_max is None else (F.col("b.i") < points - 1) | (F.col("b.beta") >= WIDEST_BETA)
        found.append(best.where(inside).select(*by, "_step", F.col("b.beta").alias("_b0")))
        on = best.where(~inside & (F.col("b.beta") < WIDEST_BETA)).select(*by, F.col("_step").alias("_old"), F.col("b.beta").alias("_edge"))
        if on.isEmpty():
            break
        state = _same(stats, on, by).select(*stats.columns, (F.col("_edge") - F.col("_old")).alias("_start"),
                                            (F.col("_old") * WIDER).alias("_step"))
    peak = found[0]
    for more in found[1:]:
        peak = peak.unionByName(more)
    fine_in = _same(stats, peak, by).select(*stats.columns, (F.col("_b0") - F.col("_step")).alias("_start"),
                                            (F.col("_step") / 100).alias("_step"))
    fine = _grid_pass(cnt, by, fine_in, FINE_POINTS, alpha_max)
    res = fine.groupBy(*by).agg(F.max_by(F.struct("beta", "alpha"), "ll").alias("m"))
    res = _left(stats, res, by)
    ok = (F.col("nf") >= min_failures) & F.col("m").isNotNull()
    out = res.select(*by,
                     F.when(ok, F.round("m.beta", 4)).alias("beta"),
                     F.when(ok, F.round("m.alpha", 2)).alias("alpha"),
                     F.when(ok, F.round(F.col("m.alpha") * F.pow(F.lit(math.log(2)), 1.0 / F.col("m.beta")), 2)).alias("median_life"),
                     F.col("n").cast("long").alias("n"), F.col("nf").cast("long").alias("n_failed"))
    if alpha_max:
        out = out.withColumn("on_cap", F.col("alpha") >= alpha_max)
    return out


def weibull_bayes(df: DataFrame, by, t: str = "t", failed: str = "failed",
                  reduced: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Grid posterior over (beta, alpha); posterior means of beta and
    alpha and the 90% interval of alpha's marginal. The power sums of the
    beta points are all that is shuffled; the grid of a group lives in one
    task's arrays (points x points, whatever the data)."""
    by = [by] if isinstance(by, str) else list(by)
    cnt, stats = reduced or reduce_lifetimes(df, by, t, failed)
    bl, bh, bn = BAYES_BETA
    al, ah, an = BAYES_ALPHA
    stats = stats.select("*", F.lit(bl).alias("_start"), F.lit((bh - bl) / (bn - 1)).alias("_step"))
    grid = _left(_power_sums(_same(cnt, stats, by), by, bn), stats, by)
    names = [f"_k{i}" for i in range(len(by))]
    grid = grid.select(*[F.col(k).alias(n) for k, n in zip(by, names)], "i", "beta", "S", "nf", F.coalesce("L", F.lit(0.0)).alias("L"), "_tm")
    const_b = math.lgamma(PRIOR_BETA_SHAPE) + PRIOR_BETA_SHAPE * math.log(PRIOR_BETA_SCALE)
    const_a = math.log(PRIOR_LN_ALPHA_SD) + 0.5 * math.log(2 * math.pi)

    def posterior(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("i")  # one group: the grid's beta points
        b = pdf["beta"].to_numpy()[:, None]
        a = (al + np.arange(an) * ((ah - al) / (an - 1)))[None, :]
        nf, L, tm, S = pdf["nf"].iloc[0], pdf["L"].iloc[0], pdf["_tm"].iloc[0], pdf["S"].to_numpy()[:, None]
        lp = nf * np.log(b / a) + (b - 1) * (L - nf * np.log(a)) - S * np.exp(b * (math.log(tm) - np.log(a)))
        lp = lp + (PRIOR_BETA_SHAPE - 1) * np.log(b) - b / PRIOR_BETA_SCALE - const_b
        lp = lp - 0.5 * ((np.log(a) - PRIOR_LN_ALPHA_MU) / PRIOR_LN_ALPHA_SD) ** 2 - const_a
        u = np.exp(lp - lp.max())
        cdf = np.cumsum(u.sum(axis=0)) / u.sum()
        at = lambda q: float(a[0, min(int(np.searchsorted(cdf, q)), an - 1)])
        out = pdf[names].iloc[:1].copy()
        out["beta_mean"], out["alpha_mean"] = float((u * b).sum() / u.sum()), float((u * a).sum() / u.sum())
        out["alpha_lo"], out["alpha_hi"] = at(CI_LO), at(CI_HI)
        return out

    kinds = df.select(*by).schema
    schema = T.StructType([*[T.StructField(n, f.dataType) for n, f in zip(names, kinds)],
                           *[T.StructField(c, T.DoubleType()) for c in ("beta_mean", "alpha_mean", "alpha_lo", "alpha_hi")]])
    post = grid.groupBy(*names).applyInPandas(posterior, schema)
    return post.select(*[F.col(n).alias(k) for n, k in zip(names, by)], F.round("beta_mean", 3).alias("beta_mean"),
                       *[F.round(c, 2).alias(c) for c in ("alpha_mean", "alpha_lo", "alpha_hi")])


def censor_sweep(df: DataFrame, by, times, t: str = "t", failed: str = "failed", alpha_max: float | None = None,
                 min_failures: int = 2) -> DataFrame:
    """Cap lifetimes at each inspection time (units alive then are
    censored) and refit; the inspection list is exploded per distinct
    lifetime, so every (group, time) is one more group of the same search.

    Per inspection time the maximum-likelihood estimate (null below
    ``min_failures``), the bounded one if ``alpha_max`` is given
    (beta_bounded, alpha_bounded, on_cap), and the Bayes means with the
    scale's interval, which are defined without any failure, too."""
    by = [by] if isinstance(by, str) else list(by)
    x = df.select(*by, F.col(t).cast("double").alias("_t"), F.col(failed).cast("int").alias("_f"),
                  F.explode(F.array(*[F.lit(float(v)) for v in times])).alias("inspect_t"))
    x = x.select(*by, "inspect_t", F.least("_t", "inspect_t").alias("t"),
                 (F.col("_f").cast("boolean") & (F.col("_t") <= F.col("inspect_t"))).cast("int").alias("failed"))
    keys = [*by, "inspect_t"]
    reduced = reduce_lifetimes(x, keys)
    fits = [lambda: weibull_mle(x, keys, min_failures=min_failures, reduced=reduced),
            lambda: weibull_mle(x, keys, alpha_max=alpha_max, min_failures=min_failures, reduced=reduced)]
    with ThreadPool(2) as pool:  # the searches' rounds run side by side
        out, *bounded = pool.map(inheritable_thread_target(df.sparkSession)(lambda fit: fit()), fits if alpha_max else fits[:1])
    if bounded:
        out = _left(out, bounded[0].select(*keys, F.col("beta").alias("beta_bounded"), F.col("alpha").alias("alpha_bounded"), "on_cap"), keys)
    return _left(out, weibull_bayes(x, keys, reduced=reduced), keys)
