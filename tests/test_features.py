"""Feature generation (the reference's feature tests) and window invariants."""

import math

from pyspark.sql import functions as F

from tidecast.operators import features as feat
from tidecast.operators import windows
from tidecast.sources import tables
from smalltables import SMALL


def _pd(df):
    return df.orderBy("timestamp").toPandas()


def test_lag_columns_and_values(sample_daily_df):
    p = _pd(feat.lag_features(sample_daily_df))
    for k in feat.DEFAULT_LAGS:
        assert f"lag_{k}" in p.columns
    assert p["lag_1"][1] == p["value"][0]
    assert math.isnan(p["lag_1"][0]) or p["lag_1"][0] is None


def test_rolling_min_le_max(sample_daily_df):
    p = _pd(feat.rolling_features(sample_daily_df, (7, 14)))
    assert (p["rolling_min_7"] <= p["rolling_max_7"]).all()
    assert p["rolling_std_7"].isna()[0]  # one observation → no sample std


def test_calendar_flags(sample_daily_df):
    p = _pd(feat.calendar_features(sample_daily_df))
    assert set(p["is_weekend"].unique()) <= {0, 1}
    assert p["day_of_week"][0] == 6  # 2023-01-01 is a Sunday (Monday = 0)
    assert p["week_of_year"][0] == 52  # ISO week


def test_fourier_count_and_bounds(sample_daily_df):
    p = _pd(feat.fourier_features(sample_daily_df, order=3))
    cols = [c for c in p.columns if c.startswith(("sin_", "cos_"))]
    assert len(cols) == 6
    assert ((p[cols] >= -1) & (p[cols] <= 1)).all().all()
    assert p["sin_1"][0] == 0.0 and p["cos_1"][0] == 1.0


def test_all_features_no_nulls(sample_daily_df):
    out = feat.all_features(sample_daily_df)
    p = out.toPandas()
    assert not p.isna().any().any()
    assert len(p) >= 365 - 90
    assert len(feat.feature_columns(out)) == 6 + 16 + 8 + 10


def test_explicit_empty_groups(sample_daily_df):
    spec = feat.FeatureSpec(lags=(), windows=(), fourier_order=0, calendar=False)
    out = feat.all_features(sample_daily_df, spec)
    assert out.columns == sample_daily_df.columns


def test_halo_blocks_equal_plain_window(spark):
    d = tables.daily_orders(spark, SMALL)
    spec = feat.FeatureSpec(lags=(1, 7, 28), windows=(7, 30), fourier_order=0, calendar=False,
                            exact_scale=2)
    blocked = feat.all_features(d, spec, drop_na=False, block_rows=40)
    plain = feat.all_features(d, spec, drop_na=False, block_rows=None)
    cols = sorted(blocked.columns)
    a = blocked.select(cols).exceptAll(plain.select(cols)).count()
    b = plain.select(cols).exceptAll(blocked.select(cols)).count()
    assert a == 0 and b == 0 and blocked.count() == d.count()


def test_positions_match_row_number(spark):
    d = tables.daily_orders(spark, SMALL)
    p1 = windows.with_position(d, with_count=True)
    p2 = windows.with_position(d, scan=False, with_count=True)
    assert p1.exceptAll(p2.select(p1.columns)).count() == 0


def test_last_n(spark):
    d = tables.daily_orders(spark, SMALL)
    out = windows.last_n_rows(d, 3)
    assert out.groupBy("series_id").count().where(F.col("count") != 3).count() == 0


def test_plan_evaluates_fourier_origin_once(spark):
    """The scalar subquery must not be re-planned per sin/cos term or per NULL check; besides it the orders are not read again."""
    import re
    import __spark_entry__ as entry
    df = entry.queries()["all_features"](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"orders\.parquet", plan)) == 1
    # column pruning: only the order date is read for the origin
    assert "o_totalprice" not in plan


def test_global_positions_split_a_hot_time_and_number_all_rows(spark):
    d = spark.range(4000).selectExpr("concat('s', cast(id % 5 as string)) as series_id",
                                     "cast(timestamp_seconds(least(id, 3000) * 3600) as timestamp_ntz) as timestamp", "cast(id as double) as value")
    got = windows.with_position(d.repartition(16), over_all=True, with_count=True, tie_break=["series_id", "value"])
    want = windows.with_position(d, over_all=True, with_count=True, tie_break=["series_id", "value"], scan=False)
    assert got.exceptAll(want.select(got.columns)).count() == 0
    assert windows.with_position(d.limit(0), with_count=True).count() == 0


def test_infer_frequency_non_strict_uses_most_common_gap(spark):
    from tidecast.operators import grid
    d = tables.daily_orders(spark, SMALL)
    strict = {r.series_id: r.freq for r in grid.infer_frequency(d).collect()}
    loose = {r.series_id: r.freq for r in grid.infer_frequency(d, strict=False).collect()}
    assert set(strict.values()) == {"D"} and set(loose) == set(strict)
    h = tables.hourly_events(spark, SMALL)
    assert {r.freq for r in grid.infer_frequency(h, strict=False).collect()} <= {"H", "2H", "3H"}


def test_hot_series_is_split_and_exact(spark):
    """One series holds ~90 % of the rows: blocked features equal the plain window,
    and the hot series is spread over many (series, block) window groups."""
    hot = spark.range(3000).select(F.lit("hot").alias("series_id"),
                                   F.timestamp_seconds(F.col("id") * 3600).cast("timestamp_ntz")
                                   .alias("timestamp"),
                                   (F.sin(F.col("id")) * 100).alias("value"))
    cold = spark.range(300).select((F.col("id") % 3).cast("string").alias("series_id"),
                                   F.timestamp_seconds(F.col("id") * 86400).cast("timestamp_ntz")
                                   .alias("timestamp"),
                                   F.col("id").cast("double").alias("value"))
    d = hot.unionByName(cold)
    spec = feat.FeatureSpec(lags=(1, 24), windows=(24, 48), fourier_order=0, calendar=False)
    blocked = feat.all_features(d, spec, drop_na=False, block_rows=200)
    plain = feat.all_features(d, spec, drop_na=False, block_rows=None)
    cols = sorted(blocked.columns)
    assert blocked.select(cols).exceptAll(plain.select(cols)).count() == 0
    assert plain.select(cols).exceptAll(blocked.select(cols)).count() == 0
    pos = windows.with_position(d)
    groups = (pos.where("series_id = 'hot'")
                 .select(((F.col("pos") - 1) / F.lit(200)).cast("long").alias("b")).distinct().count())
    assert groups == 15
