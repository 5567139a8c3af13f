"""Features that are known at the origin, and forecasts on them."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidecast.operators import features as feat
from tidecast.operators import gbt, grid, horizon

SPEC = feat.FeatureSpec(lags=(1, 2, 7), windows=(3,), fourier_order=1)
DAY = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def daily(spark):
    rows = [(s, i, float(i * i % 17 + k)) for k, s in enumerate("ab") for i in range(30 + 3 * k)]
    return spark.createDataFrame(rows, "series_id string, i int, value double").selectExpr(
        "series_id", "cast(timestampadd(DAY, i, timestamp'2024-01-01') as timestamp_ntz) as timestamp", "value")


def test_the_past_is_seen_from_the_last_row_of_the_block_before(daily):
    values = {(r.series_id, r.timestamp): r.value for r in daily.collect()}
    rows = horizon.training_frame(daily, 5, SPEC, block_rows=8).collect()
    assert len(rows) == 63 - 2 * 5 and {r.step for r in rows} == {1, 2, 3, 4, 5}
    for r in rows:
        at = lambda k: values[r.series_id, r.timestamp - dt.timedelta(days=k)]
        assert [r.lag_1, r.lag_2, r.lag_7] == [at(k) if k >= r.step and (r.timestamp - DAY).days >= k else None for k in (1, 2, 7)]
        window = [at(r.step + j) for j in range(3)]
        assert r.rolling_mean_3 == pytest.approx(sum(window) / 3) and r.rolling_max_3 == max(window)
        assert r.day_of_month == r.timestamp.day


def test_the_future_has_the_columns_of_the_past(daily):
    past, future = horizon.training_frame(daily, 9, SPEC), horizon.future_frame(daily, 9, SPEC)
    assert [c for c in past.columns if c != "value"] == future.columns
    values = {(r.series_id, r.timestamp): r.value for r in daily.collect()}
    rows = future.collect()
    assert {(r.series_id, r.step, r.timestamp) for r in rows} == {
        (s, h, DAY + dt.timedelta(days=n - 1 + h)) for s, n in (("a", 30), ("b", 33)) for h in range(1, 10)}
    for r in rows:
        assert [r.lag_1, r.lag_2, r.lag_7] == [values.get((r.series_id, r.timestamp - dt.timedelta(days=k))) for k in (1, 2, 7)]
        window = [values[r.series_id, r.timestamp - dt.timedelta(days=r.step + j)] for j in range(3)]
        assert r.rolling_min_3 == min(window) and r.rolling_mean_3 == pytest.approx(sum(window) / 3)


def test_what_is_known_ahead_meets_its_day(daily):
    known = daily.select("series_id", F.expr("timestampadd(DAY, 3, timestamp)").alias("timestamp"), (F.col("value") * 2).alias("promo"))
    future = {(r.series_id, r.step): r.promo for r in horizon.future_frame(daily, 5, SPEC, known=known).collect()}
    value = {(r.series_id, r.timestamp): r.value for r in daily.collect()}
    last = {"a": DAY + dt.timedelta(days=29), "b": DAY + dt.timedelta(days=32)}
    assert future == {(s, h): 2 * value[s, last[s] + dt.timedelta(days=h - 3)] if h <= 3 else None for s in "ab" for h in range(1, 6)}
    assert horizon.training_frame(daily, 5, SPEC, known=known).where("promo is not null").count() > 0


def test_short_series_and_empty_tables(spark, daily):
    one = daily.where("series_id = 'a' and timestamp < '2024-01-02'")
    rows = horizon.future_frame(one, 3, SPEC).orderBy("step").collect()
    assert [r.lag_1 for r in rows] == [0.0, None, None] and [r.rolling_max_3 for r in rows] == [0.0] * 3
    assert horizon.training_frame(one, 3, SPEC).count() == 0
    assert horizon.future_frame(one.limit(0), 3, SPEC).count() == 0


def test_steps_without_features_are_forecast_at_zero(spark, daily):
    past = horizon.training_frame(daily, 5, SPEC)
    with pytest.raises(ValueError, match="no rows"):
        gbt.fit(past.limit(0), n_estimators=2)
    model = gbt.fit(past, n_estimators=4, max_depth=3, row_fraction=0.9, feature_fraction=0.5, validation_share=0.2)
    assert "step" in model.feature_columns and "value" not in model.feature_columns
    spine = grid.future_spine(daily, 5, freq="D")
    future = horizon.future_frame(daily, 5, SPEC)
    got = {(r.series_id, r.step): (r.forecast, r.naive) for r in model.forecast(spine, future.where("step < 4")).collect()}
    zero = {r.forecast for r in model.forecast(spine).collect()}
    assert len(zero) == 1 and len(got) == 10
    assert all(n == (h >= 4) and (h < 4 or f in zero) for (_, h), (f, n) in got.items())
    with pytest.raises(ValueError, match="lacks"):
        model.forecast(spine, future.drop("lag_1"))
