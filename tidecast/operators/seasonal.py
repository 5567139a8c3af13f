"""Forecasts of series of different frequencies in one call: grid, season and state size follow each series.

Series are put into groups of one frequency code and season length; a group is fitted together, so there are as many
fits as different calendars, however many series there are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import DEFAULT_COLS, SeriesCols
from ..session import written
from . import grid
from . import holtwinters as hw

#: Different frequency codes of one call; more are an error (a code is a calendar, not a property of a single series).
MOST_CODES = 64


def calendars(df: DataFrame, strict: bool = False, cols: SeriesCols = DEFAULT_COLS) -> DataFrame:
    """``(series_id, freq, seasonal_period)`` of every series, written."""
    return written(grid.infer_frequency(df, cols, strict=strict).select(cols.series, "freq", "seasonal_period"), "calendars")


def holt_winters(df: DataFrame, horizon: int, calendar: DataFrame | None = None, cols: SeriesCols = DEFAULT_COLS, **kw) -> DataFrame:
    """``(series_id, freq, model, step, timestamp, forecast)``: each series on its own grid and with its own season.

    ``calendar (series_id, freq, seasonal_period)`` is inferred where not given; other arguments go to :func:`holtwinters.fit`.
    """
    s = cols.series
    rows = written(df.select(s, cols.ts, cols.value), "series")
    calendar = calendars(rows, cols=cols) if calendar is None else calendar
    codes = calendar.select("freq", "seasonal_period").distinct().orderBy("freq", "seasonal_period").limit(MOST_CODES + 1).collect()
    if len(codes) > MOST_CODES:
        raise ValueError(f"more than {MOST_CODES} different frequencies")
    parts = []
    for code in codes:
        own = calendar.where((F.col("freq") == code.freq) & (F.col("seasonal_period") == code.seasonal_period)).select(s)
        reg = written(grid.regularise(rows.join(own, s, "left_semi"), code.freq, cols, with_position=True).drop("filled"), "grid")
        fit = hw.fit(reg, code.seasonal_period, **kw)
        parts.append(hw.forecast(fit, horizon, code.freq).withColumn("freq", F.lit(code.freq)))
    if not parts:
        empty = rows.limit(0)
        return empty.select(s, F.lit("").alias("freq"), F.lit("").alias("model"), F.lit(0).alias("step"), cols.ts, F.lit(0.0).alias("forecast"))
    return reduce(DataFrame.unionByName, parts).select(s, "freq", "model", "step", "timestamp", "forecast")
