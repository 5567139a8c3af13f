"""Trend + seasonality regression per series (the decomposable-model role).

Model (after Taylor & Letham 2018, point estimates only): with t scaled to
[0, 1] over the series' own training range,

    trend g(t) = k0 + k1·t + Σ_j δ_j · max(0, t − c_j)      c_j uniform in the first 80 %
    season s(t) = Σ Fourier pairs of period 365.25 d (order 10) and 7 d (order 3)

Gaussian (ridge) priors replace the library's Laplace prior on δ: penalties
``1/changepoint_prior_scale²`` on the hinges and ``1/seasonality_prior_scale²``
on the Fourier terms, none on k0, k1, on y scaled by max |y|.
``multiplicative``: fit g first, then regress ``y/g − 1`` on the Fourier terms;
forecast ``g·(1 + s)``.  A series whose fitted trend is ≤ 0 somewhere falls
back to additive (``mode`` column says which was used).

Execution: design columns are built-in expressions; partial Gram matrices
``XᵀX, Xᵀy`` are formed per partition and series in numpy (map-side combine),
summed by a Spark aggregation on ``(series, index)``; the p×p solve per series
runs in ``applyInPandas`` on p² + p numbers.  No rows of a series are gathered.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..schema import DEFAULT_COLS, SeriesCols
from ..session import cut_lineage
from . import grid

# Model defaults (changepoints, prior scales, seasonalities).
N_CHANGEPOINTS = 10
CHANGEPOINT_RANGE = 0.8
CHANGEPOINT_PRIOR_SCALE = 0.05
SEASONALITY_PRIOR_SCALE = 10.0
YEARLY = (365.25, 10)
WEEKLY = (7.0, 3)
#: Periods that a series must span for a season to take part.
MIN_CYCLES = 2.0


def _trend_cols(t: Column, n_cp: int) -> list[Column]:
    cps = [CHANGEPOINT_RANGE * (j + 1) / (n_cp + 1) for j in range(n_cp)]
    return [F.lit(1.0), t] + [F.greatest(t - F.lit(c), F.lit(0.0)) for c in cps]


def _season_cols(days: Column, seasonalities) -> list[Column]:
    out = []
    for period, order in seasonalities:
        out += list(cal.fourier_columns(days, order, period).values())
    return out


def _penalties(n_trend: int, n_season: int, cps: float, sps: float) -> np.ndarray:
    return np.concatenate([[0.0, 0.0], np.full(n_trend - 2, 1.0 / cps ** 2),
                           np.full(n_season, 1.0 / sps ** 2)])


def _gram_fn(p: int):
    def fn(it):
        for pdf in it:
            if pdf.empty:
                continue
            rows = []
            for sid, g in pdf.groupby("series_id", sort=False):
                X = np.vstack(g["x"].to_numpy())
                y = g["y"].to_numpy(dtype=float)
                vals = np.concatenate([(X.T @ X).ravel(), X.T @ y, [float(y @ y), float(len(y))]])
                rows.append((sid, vals))
            yield pd.DataFrame({"series_id": [r[0] for r in rows],
                                "g": [r[1] for r in rows]})
    return fn


def _solve_fn(p: int, penalty: np.ndarray):
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        v = np.zeros(p * p + p + 2)
        v[pdf["idx"].to_numpy()] = pdf["val"].to_numpy()
        XtX = v[:p * p].reshape(p, p)
        Xty = v[p * p:p * p + p]
        try:
            beta = np.linalg.solve(XtX + np.diag(penalty), Xty)
        except np.linalg.LinAlgError:
            beta = np.linalg.lstsq(XtX + np.diag(penalty), Xty, rcond=None)[0]
        return pd.DataFrame({"series_id": [pdf["series_id"].iloc[0]], "beta": [list(beta)]})
    return fn


def _fit_ridge(rows: DataFrame, p: int, penalty: np.ndarray) -> DataFrame:
    """``rows(series_id, x array<double>, y)`` → ``(series_id, beta array<double>)``."""
    partial = rows.mapInPandas(_gram_fn(p), "series_id string, g array<double>")
    summed = (partial.select("series_id", F.posexplode("g").alias("idx", "val"))
                     .groupBy("series_id", "idx").agg(F.sum("val").alias("val")))
    return summed.groupBy("series_id").applyInPandas(_solve_fn(p, penalty),
                                                     "series_id string, beta array<double>")


def _dot(x: Column, beta: Column) -> Column:
    return F.aggregate(F.zip_with(x, beta, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)


def _scaled(cols: SeriesCols, ts: Column) -> tuple[Column, Column]:
    days = cal.days_since(ts, F.col("t_min"))
    span = F.greatest(F.timestamp_diff("MICROSECOND", F.col("t_min"), F.col("t_max")),
                      F.lit(1)).cast("double") / F.lit(cal.MICROS_PER_DAY)
    return days / span, days


def fit(df: DataFrame, cols: SeriesCols = DEFAULT_COLS, mode: str = "multiplicative",
        n_changepoints: int = N_CHANGEPOINTS, cps: float = CHANGEPOINT_PRIOR_SCALE,
        sps: float = SEASONALITY_PRIOR_SCALE, seasonalities=(YEARLY, WEEKLY), min_cycles: float = MIN_CYCLES) -> DataFrame:
    """Per-series parameters: ``(series_id, t_min, t_max, y_scale, beta_trend, beta_season, mode)``.

    A season takes part in a series that spans ``min_cycles`` of its periods; its coefficients are 0 in all others.
    """
    s, t, v = cols.series, cols.ts, cols.value
    stats = df.groupBy(s).agg(F.min(t).alias("t_min"), F.max(t).alias("t_max"),
                              F.max(F.abs(v)).alias("y_scale"))
    d = (df.select(F.col(s).alias("series_id"), F.col(t).alias("ts"), F.col(v).alias("y0"))
           .join(stats.withColumnRenamed(s, "series_id"), "series_id")
           .withColumn("y", F.col("y0") / F.when(F.col("y_scale") > 0, F.col("y_scale"))
                       .otherwise(F.lit(1.0))))
    ts_scaled, days = _scaled(cols, F.col("ts"))
    trend = F.array(*_trend_cols(ts_scaled, n_changepoints))
    span = F.timestamp_diff("MICROSECOND", F.col("t_min"), F.col("t_max")) / F.lit(cal.MICROS_PER_DAY)
    season = F.array(*[x * (span >= min_cycles * one[0]).cast("double") for one in seasonalities for x in _season_cols(days, (one,))])
    p_t = n_changepoints + 2
    p_s = sum(2 * o for _, o in seasonalities)
    base = d.select("series_id", "ts", "y", trend.alias("xt"), season.alias("xs"))
    pen_all = _penalties(p_t, p_s, cps, sps)
    if mode == "additive":
        beta = _fit_ridge(base.select("series_id", F.concat("xt", "xs").alias("x"), "y"),
                          p_t + p_s, pen_all)
        out = beta.select("series_id", F.slice("beta", 1, p_t).alias("beta_trend"),
                          F.slice("beta", p_t + 1, p_s).alias("beta_season"),
                          F.lit("additive").alias("mode"))
        return out.join(stats.withColumnRenamed(s, "series_id"), "series_id")
    # multiplicative: trend first, then relative seasonal deviation
    # per-series coefficients (one row per series) are reused by three branches
    bt = cut_lineage(_fit_ridge(base.select("series_id", F.col("xt").alias("x"), "y"), p_t, pen_all[:p_t]))
    g = base.join(bt, "series_id").withColumn("g", _dot(F.col("xt"), F.col("beta")))
    ok = g.groupBy("series_id").agg(F.min("g").alias("g_min"))
    rel = g.where(F.col("g") > 0).select("series_id", F.col("xs").alias("x"),
                                         (F.col("y") / F.col("g") - 1.0).alias("y"))
    bs = _fit_ridge(rel, p_s, pen_all[p_t:])
    # additive fallback only for series whose trend is not positive everywhere
    ok = cut_lineage(ok)
    bad = ok.where(F.col("g_min") <= 0).select("series_id")
    if bad.limit(1).count():
        add = _fit_ridge(base.join(bad, "series_id", "left_semi")
                             .select("series_id", F.concat("xt", "xs").alias("x"), "y"),
                         p_t + p_s, pen_all).withColumnRenamed("beta", "beta_add")
    else:
        add = ok.select("series_id", F.lit(None).cast("array<double>").alias("beta_add"))
    out = (bt.join(bs.withColumnRenamed("beta", "beta_s"), "series_id", "left")
             .join(ok, "series_id").join(add, "series_id", "left"))
    use_add = (F.col("g_min") <= 0) | F.col("beta_s").isNull()
    out = out.select(
        "series_id",
        F.when(use_add, F.slice("beta_add", 1, p_t)).otherwise(F.col("beta")).alias("beta_trend"),
        F.when(use_add, F.slice("beta_add", p_t + 1, p_s)).otherwise(F.col("beta_s"))
         .alias("beta_season"),
        F.when(use_add, F.lit("additive")).otherwise(F.lit("multiplicative")).alias("mode"))
    return out.join(stats.withColumnRenamed(s, "series_id"), "series_id")


def predict(params: DataFrame, at: DataFrame, ts_col: str = "timestamp",
            n_changepoints: int = N_CHANGEPOINTS, seasonalities=(YEARLY, WEEKLY)) -> DataFrame:
    """Point forecast at the rows of ``at`` (``series_id``, ``ts_col``, …): adds ``forecast``."""
    j = at.join(params, "series_id")
    ts_scaled, days = _scaled(DEFAULT_COLS, F.col(ts_col))
    g = _dot(F.array(*_trend_cols(ts_scaled, n_changepoints)), F.col("beta_trend"))
    sv = _dot(F.array(*_season_cols(days, seasonalities)), F.col("beta_season"))
    y = F.when(F.col("mode") == "multiplicative", g * (1.0 + sv)).otherwise(g + sv)
    scale = F.when(F.col("y_scale") > 0, F.col("y_scale")).otherwise(F.lit(1.0))
    return j.withColumn("forecast", y * scale).drop(
        "t_min", "t_max", "y_scale", "beta_trend", "beta_season", "mode")


def forecast(params: DataFrame, horizon: int, freq: str = "D") -> DataFrame:
    """``(series_id, step, timestamp, forecast)`` for the steps after each series' end."""
    spine = params.select("series_id", F.col("t_max").alias("_last")).withColumn(
        "step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    spine = spine.select("series_id", "step",
                         grid.shift(F.col("_last"), freq, F.col("step")).alias("timestamp"))
    return predict(params, spine).select("series_id", "step", "timestamp", "forecast")

