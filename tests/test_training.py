"""Training plan on gapped series whose ids hold the separator of fold keys."""

import datetime as dt
import math

from pyspark.sql import functions as F

from tidecast.operators import evaluate as ev
from tidecast.operators import features as feat
from tidecast.plans import training


DAY = dt.datetime(2024, 1, 1)


def gapped(spark, at=lambda i: DAY + dt.timedelta(days=i)):
    rows = [(s, at(i).isoformat(sep=" "), k * 100 + 2.0 * i + 10 * math.sin(i * 2 * math.pi / 7))
            for k, s in enumerate(("a|b", "a|3"), 1) for i in range(160) if i % 11 != 5]
    return spark.createDataFrame(rows, "series_id string, t string, value double").selectExpr("series_id", "cast(t as timestamp_ntz) as timestamp", "value")


CFG = dict(spec=feat.FeatureSpec(), n_folds=2, gbt_params=dict(n_estimators=3, learning_rate=0.3, max_depth=3))
MODELS = ("holt_winters", "trend_season", "gbt", "ensemble")


def test_every_member_is_scored_in_every_fold(spark):
    """Series ids that hold the separator of fold keys, and gaps."""
    res = training.run(gapped(spark), training.TrainingConfig(**CFG))
    out = training.summary(res).collect()
    assert {(r.model, r.series_id) for r in out} == {(m, s) for m in MODELS for s in ("a|b", "a|3")}
    assert all(r.cv_rmse_mean is not None and r.n_unmatched == 0 for r in out)
    folds = {(r.model, r.series_id, r.fold) for r in res.cv_metrics.collect()}
    assert folds == {(m, s, f) for m in MODELS for s in ("a|b", "a|3") for f in (1, 2)}
    assert res.failures.count() == 0
    # scored by row number a forecast would be 2 units off for every gap before it
    rmse = {(r.model, r.series_id): r.rmse for r in out}
    assert all(rmse["holt_winters", s] < 3.5 for s in ("a|b", "a|3")), rmse
    assert all(rmse["trend_season", s] < 8 for s in ("a|b", "a|3")), rmse


def test_a_member_that_raises_is_listed_and_rows_off_the_grid_are_scored(spark, monkeypatch):
    fit = training.gbt.fit

    def broken(train, *a, **kw):
        if train.count() < 100:
            raise RuntimeError("too few rows for this one")
        return fit(train, *a, **kw)

    monkeypatch.setattr(training.gbt, "fit", broken)
    # observations some minutes off the daily grid
    res = training.run(gapped(spark, lambda i: DAY + dt.timedelta(days=i, minutes=(7 * i) % 50 if i else 0)), training.TrainingConfig(**CFG))
    assert [(r.model, r.fold, "too few rows" in r.error) for r in res.failures.collect()] == [("gbt", 1, True)]
    cv = {(r.model, r.fold) for r in res.cv_metrics.collect()}
    assert cv == {(m, f) for m in MODELS for f in (1, 2)} - {("gbt", 1)}  # the ensemble goes on with the others
    final = {(r.model, r.series_id): r for r in res.final_metrics.collect()}
    n = {r["n"] for r in final.values()}
    assert len(final) == 8 and len(n) == 1 and all(r.n_unmatched == 0 for r in final.values())


def test_best_model_forecasts_the_days_after_the_last(spark):
    raw = gapped(spark)
    cfg = training.TrainingConfig(**CFG)
    for model in ("holt_winters", "gbt", "ensemble"):
        metrics = spark.createDataFrame([(m, s, 1.0 if m == model else 2.0) for m in MODELS for s in ("a|b", "a|3")], "model string, series_id string, rmse double")
        got = training.best_forecast(raw, metrics, 5, cfg).orderBy("series_id", "step").collect()
        assert [(r.series_id, r.step, r.model, r.timestamp) for r in got] == [
            (s, h, model, DAY + dt.timedelta(days=158 + h)) for s in ("a|3", "a|b") for h in range(1, 6)]
        assert all(r.forecast is not None for r in got)


def test_a_short_series_has_no_folds(spark):
    raw = gapped(spark).where("timestamp < '2024-02-20'")
    metrics, failures = training.cross_validate(raw.withColumn("lag_1", F.lit(1.0)), training.TrainingConfig(**CFG))
    assert metrics.count() == 0 and failures.count() == 0
