"""Calendar, Fourier and frequency expressions (all built-in, codegen friendly)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000.0

CALENDAR_COLUMNS = ("day_of_week", "day_of_month", "month", "quarter", "week_of_year",
                    "is_weekend", "is_month_start", "is_month_end")


def _c(ts: str | Column) -> Column:
    return F.col(ts) if isinstance(ts, str) else ts


def day_of_week(ts) -> Column:
    """Monday = 0 … Sunday = 6."""
    return F.weekday(_c(ts)).cast("int")


def week_of_year(ts) -> Column:
    """ISO-8601 week number."""
    return F.weekofyear(_c(ts)).cast("int")


def is_weekend(ts) -> Column:
    return (F.weekday(_c(ts)) >= 5).cast("int")


def is_month_start(ts) -> Column:
    return (F.dayofmonth(_c(ts)) == 1).cast("int")


def is_month_end(ts) -> Column:
    c = _c(ts)
    return (F.to_date(c) == F.last_day(c)).cast("int")


def calendar_columns(ts) -> dict[str, Column]:
    c = _c(ts)
    return {
        "day_of_week": day_of_week(c),
        "day_of_month": F.dayofmonth(c).cast("int"),
        "month": F.month(c).cast("int"),
        "quarter": F.quarter(c).cast("int"),
        "week_of_year": week_of_year(c),
        "is_weekend": is_weekend(c),
        "is_month_start": is_month_start(c),
        "is_month_end": is_month_end(c),
    }


def days_since(ts, origin) -> Column:
    """Fractional days between ``origin`` and ``ts`` (time-zone free)."""
    return F.timestamp_diff("MICROSECOND", _c(origin), _c(ts)) / F.lit(MICROS_PER_DAY)


def fourier_columns(days: Column, order: int, period: float,
                    prefix: str = "") -> dict[str, Column]:
    """``sin_k``/``cos_k`` for k = 1..order of ``2πk·days/period``, in pair order."""
    out: dict[str, Column] = {}
    for k in range(1, order + 1):
        arg = F.lit(2.0 * math.pi * k / period) * days
        out[f"{prefix}sin_{k}"] = F.sin(arg)
        out[f"{prefix}cos_{k}"] = F.cos(arg)
    return out


def seasonal_period(freq: Column) -> Column:
    """Season length for a frequency code.

    Fixed values: H → 24, D → 7, W → 52, month codes (M, MS) → 12, anything else → 7.
    Minute codes fall to the default 7.
    """
    f = F.upper(freq)
    return (F.when(f.startswith("H"), 24)
             .when(f.startswith("D"), 7)
             .when(f.startswith("W"), 52)
             .when(f.isin("M", "MS", "ME"), 12)
             .otherwise(7)).cast("int")
