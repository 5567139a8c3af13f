"""Ensembles of forecast frames.

An ensemble is a function of the constituents' forecast frames
``(model, <keys>, step, forecast)``: a model that failed simply has no rows.
Weights live in a small ``(model, weight)`` table (one row per model).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

METHODS = ("weighted_average", "simple_average", "median")
MIN_ERROR = 1e-8


def align_to_shortest(fc: DataFrame, keys=("series_id",), model: str = "model",
                      step: str = "step") -> DataFrame:
    """Keep steps every surviving model of a group produced (truncate to the shortest).

    Survivors are the models with at least one row for the group; the common
    horizon is the minimum over them of their last step.
    """
    keys = list(keys)
    per_model = fc.groupBy(*keys, model).agg(F.max(step).alias("_last"))
    common = per_model.groupBy(*keys).agg(F.min("_last").alias("_h"))
    return fc.join(common, keys).where(F.col(step) <= F.col("_h")).drop("_h")


def normalise_weights(weights: DataFrame, models: DataFrame | None = None,
                      model: str = "model", weight: str = "weight") -> DataFrame:
    """Scale weights of the known models to sum to 1 (a zero sum leaves them unchanged).

    A known model without a weight gets 0.
    """
    w = weights if models is None else models.select(model).distinct().join(weights, model, "left").withColumn(
        weight, F.coalesce(weight, F.lit(0.0)))
    total = w.agg(F.sum(weight)).scalar()
    return w.select(model, F.when(total > 0, F.col(weight) / total)
                    .otherwise(F.col(weight)).alias(weight))


def inverse_error_weights(metrics: DataFrame, error: str = "rmse", by=(),
                          model: str = "model") -> DataFrame:
    """``1/max(err, 1e-8)`` normalised to sum 1 (per group ``by``, or over all rows)."""
    by = list(by)
    inv = metrics.select(*by, model, (1.0 / F.greatest(F.col(error), F.lit(MIN_ERROR))).alias("_inv"))
    if by:
        tot = inv.groupBy(*by).agg(F.sum("_inv").alias("_tot"))
        return inv.join(tot, by).select(*by, model, (F.col("_inv") / F.col("_tot")).alias("weight"))
    total = inv.agg(F.sum("_inv")).scalar()
    return inv.select(model, (F.col("_inv") / total).alias("weight"))


def combine(fc: DataFrame, method: str = "weighted_average", weights: DataFrame | None = None,
            keys=("series_id",), model: str = "model", step: str = "step",
            forecast: str = "forecast", align: bool = True) -> DataFrame:
    """Combine model forecasts per ``(keys, step)``.

    NULL and NaN forecasts count as absent.
    ``weighted_average``: missing weight = ``1/k`` (k = models that have forecasts in the group of ``keys``),
    renormalised over the models present at each step; weights may be global
    ``(model, weight)`` or per group ``(keys…, model, weight)``.
    ``simple_average``: mean.  ``median``: exact, even count → mean of the middle two.
    """
    if method not in METHODS:
        raise ValueError(f"unknown ensemble method {method!r}; choose from {METHODS}")
    keys = list(keys)
    fc = fc.where(F.col(forecast).isNotNull() & ~F.isnan(F.col(forecast).cast("double")))
    d = align_to_shortest(fc, keys, model, step) if align else fc
    group = keys + [step]
    f = F.col(forecast)
    if method == "simple_average":
        return d.groupBy(*group).agg(F.avg(f).alias(forecast))
    if method == "median":
        return d.groupBy(*group).agg(F.median(f).alias(forecast))
    if weights is None:
        d = d.withColumn("_w", F.lit(1.0))  # equal weights; the average below divides by their sum
    else:
        wkeys = [c for c in keys if c in weights.columns] + [model]
        members = fc.groupBy(*keys).agg(F.count_distinct(model).alias("_k"))
        d = (d.join(weights.select(*wkeys, F.col("weight").alias("_w0")), wkeys, "left").join(members, keys)
              .withColumn("_w", F.coalesce(F.col("_w0"), 1.0 / F.col("_k"))))
    return d.groupBy(*group).agg((F.sum(F.col("_w") * f) / F.sum("_w")).alias(forecast))
