"""Closed-form metric cases (the reference's evaluation tests, on Spark)."""

import math

import pytest
from pyspark.sql import functions as F

from tidecast.operators import evaluate as ev


def _metrics(spark, actual, predicted):
    n = min(len(actual), len(predicted))
    a = spark.createDataFrame([(i + 1, float(x)) for i, x in enumerate(actual)], "step int, actual double")
    p = spark.createDataFrame([(i + 1, float(x)) for i, x in enumerate(predicted)], "step int, forecast double")
    fc = a.join(p, "step").withColumn("model", F.lit("m")).withColumn("series_id", F.lit("s"))
    row = ev.forecast_metrics(fc).first().asDict()
    assert row["n"] == n
    return row


def test_perfect(spark):
    m = _metrics(spark, [1, 2, 3, 4, 5], [1, 2, 3, 4, 5])
    assert m["rmse"] == 0 and m["mae"] == 0 and m["r2"] == 1 and m["mape"] == 0 and m["smape"] == 0


def test_offset(spark):
    m = _metrics(spark, [10, 20, 30, 40, 50], [15, 25, 35, 45, 55])
    assert m["rmse"] == pytest.approx(5) and m["mae"] == pytest.approx(5)
    assert m["mape"] > 0 and m["r2"] > 0


def test_reversed_r2_negative(spark):
    assert _metrics(spark, [1, 2, 3, 4, 5], [5, 4, 3, 2, 1])["r2"] < 0


def test_direction(spark):
    assert _metrics(spark, [1, 2, 3, 4, 5], [1.5, 2.5, 3.5, 4.5, 5.5])["directional_accuracy"] == 100
    assert _metrics(spark, [1, 2, 3, 4, 5], [5, 4, 3, 2, 1])["directional_accuracy"] == 0


def test_zero_actuals_skipped_in_mape(spark):
    m = _metrics(spark, [0, 1, 2, 0, 3], [0.1, 1.1, 2.1, 0.1, 3.1])
    assert math.isfinite(m["mape"]) and m["mape"] > 0


def test_truncation_to_common_length(spark):
    assert _metrics(spark, [1, 2, 3], [1, 2, 3, 4, 5])["rmse"] == 0


def test_all_zero_actuals_mape_inf(spark):
    assert _metrics(spark, [0, 0, 0], [1, 2, 3])["mape"] == float("inf")


def test_single_point(spark):
    m = _metrics(spark, [3], [4])
    assert m["directional_accuracy"] == 0 and math.isnan(m["r2"])


def test_rank_and_best(spark):
    rows = [("Prophet", "s", 10.0, 8.0), ("LightGBM", "s", 5.0, 4.0), ("Ensemble", "s", None, 1.0)]
    m = spark.createDataFrame(rows, "model string, series_id string, rmse double, mae double")
    r = {x.model: x.rank for x in ev.rank_models(m, "rmse").collect()}
    assert r == {"LightGBM": 1, "Prophet": 2, "Ensemble": 3}
    r = {x.model: x.rank for x in ev.rank_models(m, "mae", ascending=False).collect()}
    assert r["Prophet"] == 1
    assert ev.best_model(m).first().best_model == "LightGBM"


def test_cv_summary_sample_std(spark):
    rows = [("m", "s", f, float(f), 1.0, 1.0, 1.0, 0.5, 50.0) for f in (1, 2, 3)]
    fm = spark.createDataFrame(rows, "model string, series_id string, fold int, rmse double, "
                               "mae double, mape double, smape double, r2 double, "
                               "directional_accuracy double")
    r = ev.cv_summary(fm).first()
    assert r.rmse_mean == 2.0 and r.rmse_std == 1.0 and r.n_folds == 3
