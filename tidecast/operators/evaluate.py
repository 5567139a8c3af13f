"""Scoring, ranking and cross-validation summaries of forecasts.

A forecast frame has group columns (``model``, ``series_id``, maybe ``fold``),
a ``step`` (1-based position in the horizon), the ``actual`` and the
``forecast``.  Prediction ↔ actual alignment and truncation to the common
length are an inner join on ``(series_id, step)`` done by the caller.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.metrics import INF, METRICS, metric_aggs, round_half_away
from ..session import written

STEP = "step"


def residuals(fc: DataFrame, actual: str = "actual", forecast: str = "forecast") -> DataFrame:
    """Residual frame: ``actual − forecast`` for every aligned row."""
    return fc.withColumn("residual", F.col(actual) - F.col(forecast))


def attach_previous(fc: DataFrame, keys: list[str], actual: str = "actual",
                    forecast: str = "forecast", step: str = STEP) -> DataFrame:
    """Add the previous step's actual and forecast (equi-join on ``step - 1``)."""
    prev = fc.select(*keys, (F.col(step) + 1).alias(step),
                     F.col(actual).alias("actual_prev"), F.col(forecast).alias("forecast_prev"))
    return fc.join(prev, keys + [step], "left")


def forecast_metrics(fc: DataFrame, by=("model", "series_id"), actual: str = "actual",
                     forecast: str = "forecast", step: str = STEP,
                     digits: int | None = 4) -> DataFrame:
    """RMSE, MAE, MAPE %, SMAPE %, R², directional accuracy % per group (+ ``n``)."""
    by = list(by)
    # the step before is looked up in the same rows: what leads to them runs once
    rows = written(fc.select(*by, step, actual, forecast), "forecasts")
    d = attach_previous(rows, by, actual, forecast, step)
    aggs = metric_aggs(actual, forecast)
    out = d.groupBy(*by).agg(*[v.alias(k) for k, v in aggs.items()])
    if digits is not None:
        out = out.withColumns({m: round_half_away(F.col(m), digits) for m in METRICS})
    return out.withColumn("n", F.col("n").cast("long"))


def rank_models(metrics: DataFrame, sort_by: str = "rmse", ascending: bool = True,
                partition=("series_id",), model: str = "model") -> DataFrame:
    """``rank`` 1..k of models by a metric (NULL/NaN last, name breaks ties).

    An unknown metric ranks by model name (the reference keeps input order).
    """
    part = [c for c in partition if c in metrics.columns]
    if sort_by in metrics.columns:
        c = F.col(sort_by)
        key = F.when(F.isnan(c), None).otherwise(c)
        order = [key.asc_nulls_last() if ascending else key.desc_nulls_last(), F.col(model)]
    else:
        order = [F.col(model)]
    w = Window.partitionBy(*part).orderBy(*order) if part else Window.orderBy(*order)
    return metrics.withColumn("rank", F.row_number().over(w))


def cv_summary(fold_metrics: DataFrame, by=("model", "series_id"), digits: int = 4) -> DataFrame:
    """Mean and sample standard deviation of every metric across folds."""
    by = [c for c in by if c in fold_metrics.columns]
    aggs = []
    for m in METRICS:
        aggs.append(round_half_away(F.avg(m), digits).alias(f"{m}_mean"))
        aggs.append(round_half_away(F.stddev_samp(m), digits).alias(f"{m}_std"))
    return fold_metrics.groupBy(*by).agg(*aggs, F.count(F.lit(1)).alias("n_folds"))


def aggregate_cv(fold_metrics: DataFrame, by=("model", "series_id"), digits: int = 4) -> DataFrame:
    """Mean of every metric across folds, rounded (``fold`` itself excluded)."""
    by = [c for c in by if c in fold_metrics.columns]
    return fold_metrics.groupBy(*by).agg(
        *[round_half_away(F.avg(m), digits).alias(m) for m in METRICS])


def best_model(metrics: DataFrame, by=("series_id",), metric: str = "rmse",
               model: str = "model") -> DataFrame:
    """Model with the least metric per group (missing → +inf; name breaks ties)."""
    by = [c for c in by if c in metrics.columns]
    key = F.coalesce(F.when(~F.isnan(F.col(metric)), F.col(metric)), F.lit(INF))
    return metrics.groupBy(*by).agg(
        F.min_by(F.col(model), F.struct(key, F.col(model))).alias("best_model"),
        F.min(key).alias(f"best_{metric}"))


def append_history(history: DataFrame | None, metrics: DataFrame, run_id: int) -> DataFrame:
    """Append a run's metric rows to the evaluation history."""
    rows = metrics.withColumn("run_id", F.lit(run_id).cast("int"))
    return rows if history is None else history.unionByName(rows)


def latest_per_model(history: DataFrame, by=("model", "series_id")) -> DataFrame:
    """Latest run's row per group (``max_by`` over ``run_id``: one partial aggregation)."""
    by = list(by)
    rest = [c for c in history.columns if c not in by]
    latest = history.groupBy(*by).agg(F.max_by(F.struct(*rest), F.col("run_id")).alias("_r"))
    return latest.select(*by, *[F.col("_r." + c).alias(c) for c in rest])


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
