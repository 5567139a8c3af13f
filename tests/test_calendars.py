"""Business days and anchored calendars: infer, regularise, extend."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidecast.operators import grid


def frame(spark, stamps, values=None):
    rows = [("s", str(t), float(i) if values is None else values[i]) for i, t in enumerate(stamps)]
    return spark.createDataFrame(rows, "series_id string, t string, value double").selectExpr(
        "series_id", "cast(t as timestamp_ntz) as timestamp", "value")


def freq_of(spark, stamps, strict=True):
    return grid.infer_frequency(frame(spark, stamps), strict=strict).first().freq


def test_weekdays_are_business_days(spark):
    days = pd.date_range("2024-01-03", periods=30, freq="B")
    assert freq_of(spark, days) == "B" and freq_of(spark, days, False) == "B"
    assert freq_of(spark, days.delete([4, 11])) == "D" and freq_of(spark, days.delete([4, 11]), False) == "B"
    assert freq_of(spark, pd.date_range("2024-01-08", periods=5, freq="D")) == "D"  # one week without a weekend
    assert freq_of(spark, pd.date_range("2024-01-01", periods=30, freq="D"), False) == "D"


def test_month_starts_with_gaps(spark):
    months = pd.date_range("2023-01-01", periods=24, freq="MS").delete([3, 9, 10])
    assert freq_of(spark, months) == "D" and freq_of(spark, months, False) == "MS"


@pytest.mark.parametrize("freq,pandas", [("B", "B"), ("2B", "2B"), ("W-WED", "W-WED"), ("QS-FEB", "QS-FEB"), ("A-JUN", "YE-JUN"), ("Q-NOV", "QE-NOV"), ("AS-APR", "YS-APR")])
def test_grids_of_codes(spark, freq, pandas):
    """A grid from any day of two weeks, and from several months, is pandas' own."""
    starts = [f"2024-05-{d:02d}" for d in range(1, 15, 2)] + [f"2024-{m:02d}-28" for m in (7, 9, 11, 12)]
    end = {x: pd.Timestamp(x) + pd.Timedelta(days=900) for x in starts}
    rows = [(x, str(t), 1.0) for x in starts for t in (x, end[x].date())]
    df = spark.createDataFrame(rows, "series_id string, t string, value double").selectExpr("series_id", "cast(t as timestamp_ntz) as timestamp", "value")
    got = {}
    for r in grid.regularise(df, freq).orderBy("series_id", "timestamp").collect():
        got.setdefault(r.series_id, []).append(r.timestamp)
    for x in starts:
        # pandas counts pairs of business days from the first one as well
        want = pd.date_range(x, end[x], freq="B")[::2] if freq == "2B" else pd.date_range(x, end[x], freq=pandas)
        assert got[x] == [t.to_pydatetime() for t in want], (freq, x)


def test_business_grid_carries_over_the_weekend(spark):
    # Thursday, Saturday, the Wednesday after
    rows = grid.regularise(frame(spark, ["2024-01-04 08:00", "2024-01-06 10:00", "2024-01-10 08:00"], [1.0, 2.0, 3.0]), "B").orderBy("timestamp").collect()
    assert [(r.timestamp.day, r.timestamp.hour, r.value, r.filled) for r in rows] == [(4, 8, 1.0, 0), (5, 8, 1.0, 1), (8, 8, 2.0, 1), (9, 8, 2.0, 1), (10, 8, 3.0, 0)]


def test_future_business_days(spark):
    df = frame(spark, pd.date_range("2024-01-01", periods=25, freq="B"))  # ends on Friday 2 February
    want = [t.to_pydatetime() for t in pd.date_range("2024-02-05", periods=7, freq="B")]
    for spine in (grid.future_spine(df, 7, "B"), grid.future_spine(df, 7, freq_df=grid.infer_frequency(df))):
        assert [r.timestamp for r in spine.orderBy("step").collect()] == want
    step = df.limit(1).select(grid.step_at_or_after(F.lit("2024-01-05 09:00").cast("timestamp_ntz"), F.lit("2024-01-07 08:00").cast("timestamp_ntz"), "B")).first()[0]
    assert step == 1


def test_unknown_anchors(spark):
    for bad in ("W-JAN", "D-MON", "MS-FEB", "QS-MON", "X"):
        with pytest.raises(ValueError):
            grid.parse_freq(bad)


def test_each_series_has_its_own_season(spark):
    """Daily, hourly, monthly and business-daily waves in one call: each repeats by its own season."""
    from tidecast.operators import holtwinters as hw
    from tidecast.operators import seasonal

    kinds = {"daily": ("D", 7, "D"), "hourly": ("h", 24, "H"), "monthly": ("MS", 12, "MS"), "weekdays": ("B", 7, "B")}
    rows, want = [], {}
    for name, (freq, m, code) in kinds.items():
        stamps = pd.date_range("2020-01-01", periods=6 * m + 14, freq=freq)
        rows += [(name, str(t), float(100 + i % m)) for i, t in enumerate(stamps[:6 * m])]
        want[name] = [(code, t.to_pydatetime(), float(100 + (6 * m + i) % m)) for i, t in enumerate(stamps[6 * m:])]
    df = spark.createDataFrame(rows, "series_id string, t string, value double").selectExpr("series_id", "cast(t as timestamp_ntz) as timestamp", "value")
    got = {}
    for r in seasonal.holt_winters(df, 14, params=hw.fixed(0.2, 0.1, 0.1)).orderBy("series_id", "step").collect():
        got.setdefault(r.series_id, []).append((r.freq, r.timestamp, round(r.forecast, 6)))
    assert got == want
    assert seasonal.holt_winters(df.limit(0), 3).count() == 0
