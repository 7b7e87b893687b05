"""Per-series forecasting.

Every series is forecast in parallel: the seasonal-naive baseline is pure
column arithmetic, Holt-Winters runs per series inside ``applyInPandas``
(one series = one bounded group of periods), and the evaluation metrics are
aggregates. Nothing is collected to the driver.
"""

from __future__ import annotations

from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# seasonal-naive band: forecast x 0.8 and x 1.2
BAND_LO, BAND_HI = 0.8, 1.2


def seasonal_naive(df: DataFrame, keys, ts: str = "ds", y: str = "y", horizon: int = 9,
                   start=None) -> DataFrame:
    """Forecast month m = mean of the same calendar month over the last
    12 months before ``start`` (default: the month after the newest data),
    band x0.8 / x1.2, for ``horizon`` months of any number: months beyond a
    year repeat the season. Each last-year month generates its own horizon
    months; nothing is joined."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    start_c = F.add_months(F.trunc(df.agg(F.max(ts)).scalar(), "month"), 1) if start is None else F.lit(start).cast("date")
    ly = (df.where((F.col(ts) >= F.add_months(start_c, -12)) & (F.col(ts) < start_c))
          .groupBy(*keys, F.month(ts).alias("mo")).agg(F.avg(y).alias("y_ly")))
    first = (F.col("mo") - F.month(start_c) + 12) % 12
    steps = F.when(first < horizon, F.sequence(first, F.lit(horizon - 1), F.lit(12)))
    out = ly.select(*keys, "y_ly", F.explode(steps).alias("_k")).select(
        *keys, F.add_months(start_c, F.col("_k")).alias("forecast_month"), F.col("y_ly").alias("forecast_cases"))
    return out.select("*", (F.col("forecast_cases") * BAND_LO).alias("forecast_p10"),
                      (F.col("forecast_cases") * BAND_HI).alias("forecast_p90"),
                      F.lit("seasonal_naive").alias("method"))


#: Where the search for the smoothing (level, trend, season) begins: all pairs of steps of a tenth, the trend closer to 0.
_STARTS = np.stack(np.meshgrid(np.linspace(0, 1, 11), np.array([0, 0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.75, 1.0]), np.linspace(0, 1, 11),
                               indexing="ij")).reshape(3, -1)
_CORNERS = np.stack(np.meshgrid(*[np.array([-1.0, -0.5, 0.0, 0.5, 1.0])] * 3, indexing="ij")).reshape(3, -1)


def smoothing_errors(y: np.ndarray, season: int, abc: np.ndarray):
    """One pass of additive Holt-Winters over many smoothings at once.

    ``abc`` is (3, m): level, trend, season. Returns the squared one-step
    errors after the first season (m), and the last level, trend, seasonal
    values and errors, with a column per smoothing."""
    a, b, g = abc
    m = abc.shape[1]
    level = np.full(m, y[:season].mean())
    trend = np.full(m, (y[season:2 * season].mean() - y[:season].mean()) / season)
    seas = np.repeat((y[:season] - y[:season].mean())[:, None], m, axis=1)
    err = np.zeros((len(y), m))
    for t, now in enumerate(y):
        s = seas[t % season].copy()
        err[t] = now - (level + trend + s)
        prev = level
        level = a * (now - s) + (1 - a) * (level + trend)
        trend = b * (level - prev) + (1 - b) * trend
        seas[t % season] = g * (now - level) + (1 - g) * s
    return (err[season:] ** 2).sum(axis=0), level, trend, seas, err


def fit_smoothing(y: np.ndarray, season: int, keep: int = 8, rounds: int = 14) -> np.ndarray:
    """The smoothing in [0, 1]^3 with the smallest squared one-step errors.

    A bounded search that runs many points as one array: from a coarse grid
    the ``keep`` best points that are not neighbours of a better one, around
    each a box of 5^3 points that moves to its best point and halves when
    that is its centre. The best point seen is returned, so it is never
    worse than the grid. About 1,089 + rounds * keep * 125 evaluations."""
    sse = smoothing_errors(y, season, _STARTS)[0]
    sse = np.where(np.isfinite(sse), sse, np.inf)
    order, centres = np.argsort(sse, kind="stable"), []
    for i in order:
        p = _STARTS[:, i]
        if all(np.abs(p - c).max() > 0.11 for c in centres):
            centres.append(p)
        if len(centres) == keep:
            break
    centres = np.stack(centres, axis=1)
    size = np.tile(np.array([[0.1], [0.1], [0.1]]), centres.shape[1])
    for _ in range(rounds):
        trial = np.clip(centres[:, :, None] + size[:, :, None] * _CORNERS[:, None, :], 0.0, 1.0)
        value = smoothing_errors(y, season, trial.reshape(3, -1))[0].reshape(trial.shape[1:])
        value = np.where(np.isfinite(value), value, np.inf)
        at = value.argmin(axis=1)
        moved = trial[:, np.arange(len(at)), at]
        stays = np.abs(moved - centres).max(axis=0) < 0.75 * size.max(axis=0)  # inside the box: look closer
        centres, size = moved, np.where(stays, size / 2, size)
    every = np.concatenate([centres, _STARTS[:, order[:1]]], axis=1)
    return every[:, int(np.nan_to_num(smoothing_errors(y, season, every)[0], nan=np.inf).argmin())]


def _holt_winters(y: np.ndarray, season: int, horizon: int, smoothing=None):
    """Additive Holt-Winters; returns forecast, residual sd and the smoothing.

    ``smoothing`` (level, trend, season) is fitted to the series by
    :func:`fit_smoothing` if it is not given."""
    abc = np.array(smoothing if smoothing is not None else fit_smoothing(y, season), dtype=float)[:, None]
    _, level, trend, seas, err = smoothing_errors(y, season, abc)
    sd = float(np.std(err[season:, 0], ddof=1)) if len(y) > season + 1 else 0.0
    fc = np.array([level[0] + (h + 1) * trend[0] + seas[(len(y) + h) % season, 0] for h in range(horizon)])
    return fc, sd, tuple(abc[:, 0])


def _seasonal_repeat(y: np.ndarray, season: int, horizon: int, smoothing=None):
    """Last season's values again; the sd is that of the season-on-season changes."""
    change = y[season:] - y[:-season]
    sd = float(np.std(change, ddof=1)) if len(change) > 1 else 0.0
    return np.array([y[len(y) - season + h % season] for h in range(horizon)]), sd, None


METHODS = {"holt_winters": (_holt_winters, 2), "seasonal_repeat": (_seasonal_repeat, 1)}


def _key_fields(df: DataFrame, keys) -> list[T.StructField]:
    return [T.StructField(k, df.schema[k].dataType) for k in keys]


def group_forecast(df: DataFrame, keys=("brand", "region"), ts: str = "ds", y: str = "y", horizon: int = 9, season: int = 12,
                   level: float = 0.95, method: str = "holt_winters", smoothing=None, grain: str = "MONTH") -> DataFrame:
    """A forecast with interval for every series in one call, for any keys.

    ``grain`` is the step of ``ts`` (DAY, WEEK, MONTH, QUARTER or YEAR).

    ``method`` is the same for all series; one that is too short for it (two
    seasons for Holt-Winters, one for ``seasonal_repeat``) comes back as one
    row with null forecasts and a reason. Series must be regular: fill gaps
    first (:func:`mlframe.operators.windows.densify`). The interval is the
    normal one of ``level`` from the one-step errors, widening with the root
    of the horizon."""
    keys = list(keys)
    run, seasons = METHODS[method]
    step = {"DAY": {"days": 1}, "WEEK": {"weeks": 1}, "MONTH": {"months": 1}, "QUARTER": {"months": 3}, "YEAR": {"years": 1}}[grain.upper()]
    z = NormalDist().inv_cdf(0.5 + level / 2)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(ts)
        vals = pdf[y].to_numpy(dtype=float)
        own = {k: pdf[k].iloc[0] for k in keys}
        if len(vals) < seasons * season:
            return pd.DataFrame([{**own, "forecast_month": None, "forecast_cases": None, "forecast_lo": None, "forecast_hi": None,
                                  "method": method, "reason": f"{len(vals)} periods, {seasons * season} needed"}])
        last = pd.Timestamp(pdf[ts].iloc[-1])
        fc, sd, _ = run(vals, season, horizon, smoothing)
        width = z * sd * np.sqrt(np.arange(1, horizon + 1))
        return pd.DataFrame({**own, "forecast_month": [(last + pd.DateOffset(**{k: v * (h + 1) for k, v in step.items()})).date() for h in range(horizon)],
                             "forecast_cases": fc, "forecast_lo": fc - width, "forecast_hi": fc + width, "method": method, "reason": None})

    schema = T.StructType([*_key_fields(df, keys), T.StructField("forecast_month", T.DateType()),
                           *[T.StructField(c, T.DoubleType()) for c in ("forecast_cases", "forecast_lo", "forecast_hi")],
                           T.StructField("method", T.StringType()), T.StructField("reason", T.StringType())])
    return df.select(*keys, ts, y).groupBy(*keys).applyInPandas(fit, schema)


def backtest(df: DataFrame, keys=("brand", "region"), ts: str = "ds", y: str = "y", holdout: int = 6, season: int = 12,
             method: str = "holt_winters", smoothing=None) -> DataFrame:
    """Hold out the last ``holdout`` periods of each (regular) series, fit
    the rest, MAPE per series over the held-out periods that are not 0. A
    series that is too short has a null MAPE and a reason."""
    keys = list(keys)
    run, seasons = METHODS[method]

    def test(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(ts)
        vals = pdf[y].to_numpy(dtype=float)
        mape, reason = None, None
        if len(vals) < seasons * season + holdout:
            reason = f"{len(vals)} periods, {seasons * season + holdout} needed"
        else:
            fc, _, _ = run(vals[:-holdout], season, holdout, smoothing)
            act = vals[-holdout:]
            ok = act != 0
            mape = float(np.mean(np.abs((act[ok] - fc[ok]) / act[ok]))) if ok.any() else None
            reason = None if ok.any() else "all held-out periods are 0"
        return pd.DataFrame([{**{k: pdf[k].iloc[0] for k in keys}, "n_points": len(vals), "mape": mape, "reason": reason}])

    schema = T.StructType([*_key_fields(df, keys), T.StructField("n_points", T.LongType()), T.StructField("mape", T.DoubleType()),
                           T.StructField("reason", T.StringType())])
    return df.select(*keys, ts, y).groupBy(*keys).applyInPandas(test, schema)


def leaderboard(preds: DataFrame, actual: str = "y", models=("naive_last", "train_mean"),
                digits: int = 6) -> DataFrame:
    """MAPE per model over all holdout rows (actual 0 rows skipped),
    WMAPE = sum|err| / sum|actual|, ranked best first with nulls last."""
    long = preds.unpivot([actual], list(models), "model", "pred")
    a, p = F.col(actual), F.col("pred")
    agg = long.groupBy("model").agg(
        F.avg(F.when(a != 0, F.abs(a - p) / F.abs(a))).alias("mape"),
        F.try_divide(F.sum(F.abs(a - p)), F.sum(F.abs(a))).alias("wmape"),
        F.count(F.lit(1)).alias("n"))
    return agg.select("model", F.round("mape", digits).alias("mape"), F.round("wmape", digits).alias("wmape"), "n")
