"""Models: Holt-Winters block composition, trend+season, ensembles, splits."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidecast.operators import ensemble as ens
from tidecast.operators import holtwinters as hw
from tidecast.operators import split
from tidecast.operators import trendseason as tsr


def _direct(y, a, b, g, m):
    if m > 1:
        l, tr, s = np.mean(y[:m]), 0.0, list(y[:m] - np.mean(y[:m]))
        start = m
    else:
        l, tr, s, start = y[0], 0.0, [], 1
    sse = 0.0
    for yt in y[start:]:
        if m > 1:
            e = yt - (l + tr + s[0])
            nl = a * (yt - s[0]) + (1 - a) * (l + tr)
            nb = b * (nl - l) + (1 - b) * tr
            s = s[1:] + [g * (yt - l - tr) + (1 - g) * s[0]]
        else:
            e = yt - (l + tr)
            nl = a * yt + (1 - a) * (l + tr)
            nb = b * (nl - l) + (1 - b) * tr
        sse += e * e
        l, tr = nl, nb
    return l, tr, s, sse


@pytest.mark.parametrize("m", [7, 0])
def test_block_composition_equals_recursion(m):
    rng = np.random.default_rng(1)
    y = 100 + np.arange(200) * 0.5 + 10 * np.sin(np.arange(200)) + rng.normal(0, 1, 200)
    params = hw.fixed(0.3, 0.1, 0.2 if m else 0.0)
    start = m if m > 1 else 1
    k = m + 2 if m > 1 else 2
    parts = [hw.block_summary(y[start + i:start + i + 37], params, m) for i in range(0, 200 - start, 37)]
    M, Q = hw.compose([(p[0][0], p[1][0]) for p in parts], k)
    l, tr, s, sse = _direct(y, 0.3, 0.1, 0.2, m)
    x0 = [np.mean(y[:m]), 0.0] + list(y[:m] - np.mean(y[:m])) if m > 1 else [y[0], 0.0]
    z = np.append(x0, 1.0)
    x = M @ z
    assert x[0] == pytest.approx(l, rel=1e-9) and x[1] == pytest.approx(tr, rel=1e-6, abs=1e-9)
    assert z @ Q @ z == pytest.approx(sse, rel=1e-8)
    if m > 1:
        assert np.allclose(x[2:], s, rtol=1e-8, atol=1e-8)


def test_hw_fit_forecast(spark, sample_daily_df):
    fit = hw.fit(sample_daily_df, 7, block_rows=64, fanout=3)
    r = fit.first()
    assert r.model == "holt_winters" and len(r.season) == 7 and r.n_obs == 365
    fc = hw.forecast(fit, 14).toPandas()
    assert len(fc) == 14 and fc["forecast"].notna().all()
    # multi-level tree reduction equals a single level
    fit1 = hw.fit(sample_daily_df, 7, params=hw.fixed(0.2, 0.1, 0.1), block_rows=32, fanout=2)
    fit2 = hw.fit(sample_daily_df, 7, params=hw.fixed(0.2, 0.1, 0.1), block_rows=4096)
    assert fit1.first().level == pytest.approx(fit2.first().level, rel=1e-9)


def test_hw_short_series_uses_linear(spark, short_daily_df):
    fit = hw.fit(short_daily_df.where("timestamp < '2024-01-10'"), 7)
    assert fit.first().model == "holt_linear"


def test_trend_season_forecast(spark, sample_daily_df):
    params = tsr.fit(sample_daily_df)
    fc = tsr.forecast(params, 14).toPandas()
    assert len(fc) == 14 and fc["forecast"].notna().all()
    # the series grows ~0.3/day: the forecast level should be near the last values
    assert 450 < fc["forecast"].mean() < 800


def test_inverse_error_weights(spark):
    m = spark.createDataFrame([("Prophet", 10.0), ("LightGBM", 5.0)], "model string, rmse double")
    w = {r.model: r.weight for r in ens.inverse_error_weights(m).collect()}
    assert w["LightGBM"] > w["Prophet"]
    assert w["LightGBM"] == pytest.approx(2 / 3) and sum(w.values()) == pytest.approx(1.0)


def test_ensemble_methods(spark):
    rows = [(m, "s", st, float(v)) for m, vals in (("a", [1, 2, 3]), ("b", [3, 4]), ("c", [5, 9, 9]))
            for st, v in enumerate(vals, 1)]
    fc = spark.createDataFrame(rows, "model string, series_id string, step int, forecast double")
    med = {r.step: r.forecast for r in ens.combine(fc, "median").collect()}
    assert med == {1: 3.0, 2: 4.0}  # truncated to the shortest surviving model
    avg = {r.step: r.forecast for r in ens.combine(fc, "simple_average").collect()}
    assert avg[1] == pytest.approx(3.0)
    w = spark.createDataFrame([("a", 2.0), ("b", 1.0)], "model string, weight double")
    wa = {r.step: r.forecast for r in ens.combine(fc, "weighted_average", w).collect()}
    # c has no weight → 1/3; renormalised over present models
    assert wa[1] == pytest.approx((2 * 1 + 1 * 3 + (1 / 3) * 5) / (2 + 1 + 1 / 3))
    nw = {r.model: r.weight for r in ens.normalise_weights(w).collect()}
    assert nw == {"a": pytest.approx(2 / 3), "b": pytest.approx(1 / 3)}


def test_split_and_folds(spark, sample_daily_df):
    s = split.chrono_split(sample_daily_df, 0.8)
    counts = {r.split: r["count"] for r in s.groupBy("split").count().collect()}
    assert counts == {"train": 292, "test": 73}
    f = split.expanding_folds(sample_daily_df, 3)
    rows = f.groupBy("fold", "role").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("lo"),
                                         F.max("pos").alias("hi")).collect()
    got = {(r.fold, r.role): (r.n, r.lo, r.hi) for r in rows}
    z = 365 // 4
    for i in (1, 2, 3):
        assert got[(i, "train")] == (z * i, 1, z * i)
        assert got[(i, "val")] == (z, z * i + 1, z * (i + 1))


def test_fold_reduction_for_short_series(spark, short_daily_df):
    f = split.expanding_folds(short_daily_df.where("timestamp < '2024-02-15'"), 5)
    assert f.agg(F.max("fold")).first()[0] == 44 // 10 - 1


def test_null_forecast_and_missing_weight_take_no_part(spark):
    from tidecast.operators import ensemble

    fc = spark.createDataFrame([("a", "s", 1, 10.0), ("b", "s", 1, None)], "model string, series_id string, step int, forecast double")
    w = spark.createDataFrame([("a", 0.4), ("b", 0.6)], "model string, weight double")
    assert ensemble.combine(fc, weights=w).first()["forecast"] == 10.0
    both = spark.createDataFrame([("a", "s", 1, 10.0), ("b", "s", 1, 20.0)], fc.schema)
    own = ensemble.normalise_weights(w.where("model = 'a'"), both)
    assert ensemble.combine(both, weights=own).first()["forecast"] == 10.0


def test_one_observation_is_the_level(spark):
    rows = [("a", f"2024-01-{d:02d}", float(d)) for d in range(1, 11)] + [("one", "2024-01-05", 42.0)]
    df = spark.createDataFrame(rows, "series_id string, t string, value double").selectExpr(
        "series_id", "cast(t as timestamp_ntz) as timestamp", "value")
    for params in (hw.fixed(0.3, 0.1), None):
        got = {(r.series_id, r.step): r.forecast for r in hw.forecast(hw.fit(df, 7, params), 2).collect()}
        assert got[("one", 1)] == got[("one", 2)] == 42.0 and ("a", 2) in got
