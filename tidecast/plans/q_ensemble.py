"""Registered queries: ensembles and their weights."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ensemble as ens
from ..sources import tables
from . import fixtures
from .q_eval import HOLDOUT, METRICS_HOLDOUT, _holdout_metrics
from .registry import r4, register, sql_round

# The demo's ensemble weights (decomposable model 0.4, boosted trees 0.6),
# assigned here to the two fixture forecasters.
DEMO_WEIGHTS = (("naive", 0.4), ("seasonal_naive", 0.6))
W_SQL = "w AS (SELECT * FROM (VALUES ('naive', CAST('0.4' AS DOUBLE)), ('seasonal_naive', CAST('0.6' AS DOUBLE))) t(model, weight))"


def _fc(spark, d):
    return fixtures.holdout_forecasts(tables.daily_orders(spark, d), 28).drop("timestamp", "actual")


def _out(df):
    return df.select("series_id", "step", r4("forecast").alias("forecast"))


@register("ensemble_weighted", sql=HOLDOUT + ",\n" + W_SQL + f"""
SELECT series_id, step, {sql_round('sum(w.weight * fc.forecast) / sum(w.weight)')} AS forecast
FROM fc JOIN w USING (model) GROUP BY series_id, step""")
def q_ensemble_weighted(spark, d):
    w = spark.createDataFrame(list(DEMO_WEIGHTS), "model string, weight double")
    return _out(ens.combine(_fc(spark, d), "weighted_average", w))


@register("ensemble_simple", sql=HOLDOUT + f"""
SELECT series_id, step, {sql_round('avg(forecast)')} AS forecast FROM fc GROUP BY series_id, step""")
def q_ensemble_simple(spark, d):
    return _out(ens.combine(_fc(spark, d), "simple_average"))


@register("ensemble_median", sql=HOLDOUT + f"""
SELECT series_id, step, {sql_round('median(forecast)')} AS forecast FROM fc GROUP BY series_id, step""")
def q_ensemble_median(spark, d):
    return _out(ens.combine(_fc(spark, d), "median"))


@register("inverse_error_weights", sql=HOLDOUT + ",\n" + METRICS_HOLDOUT + f""",
inv AS (SELECT series_id, model, 1.0 / greatest(rmse, CAST('1e-08' AS DOUBLE)) AS inv FROM metrics)
SELECT i.series_id, i.model, {sql_round('i.inv / t.tot')} AS weight
FROM inv i JOIN (SELECT series_id, sum(inv) AS tot FROM inv GROUP BY series_id) t USING (series_id)""")
def q_inverse_error_weights(spark, d):
    w = ens.inverse_error_weights(_holdout_metrics(spark, d), "rmse", by=("series_id",))
    return w.select("series_id", "model", r4("weight").alias("weight"))


@register("ensemble_weights_normalised", sql=HOLDOUT + ",\n" + METRICS_HOLDOUT + f""",
raw AS (SELECT model, avg(directional_accuracy) AS weight FROM metrics GROUP BY model)
SELECT model, {sql_round('CASE WHEN (SELECT sum(weight) FROM raw) > 0 THEN weight / (SELECT sum(weight) FROM raw) ELSE weight END')} AS weight
FROM raw""")
def q_ensemble_weights_normalised(spark, d):
    raw = (_holdout_metrics(spark, d).groupBy("model")
           .agg(F.avg("directional_accuracy").alias("weight")))
    return ens.normalise_weights(raw).select("model", r4("weight").alias("weight"))


@register("ensemble_with_missing_model", sql=HOLDOUT + ",\n" + W_SQL + """,
kept AS (SELECT * FROM fc WHERE NOT (model = 'seasonal_naive' AND series_id = '5-LOW')
                            AND NOT (model = 'naive' AND series_id = '1-URGENT' AND step > 20)),
h AS (SELECT series_id, min(last) AS h FROM (SELECT series_id, model, max(step) AS last FROM kept
      GROUP BY 1, 2) GROUP BY 1)
SELECT k.series_id, k.step, """ + sql_round("sum(w.weight * k.forecast) / sum(w.weight)") + """ AS forecast
FROM kept k JOIN h ON h.series_id = k.series_id AND k.step <= h.h JOIN w USING (model)
GROUP BY k.series_id, k.step""")
def q_ensemble_with_missing_model(spark, d):
    fc = _fc(spark, d)
    kept = fc.where(~((F.col("model") == "seasonal_naive") & (F.col("series_id") == "5-LOW")) &
                    ~((F.col("model") == "naive") & (F.col("series_id") == "1-URGENT") &
                      (F.col("step") > 20)))
    w = spark.createDataFrame(list(DEMO_WEIGHTS), "model string, weight double")
    return _out(ens.combine(kept, "weighted_average", w))
