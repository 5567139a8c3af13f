"""Registered queries: feature generation (lags, rolling, calendar, Fourier)."""

from __future__ import annotations

import math

from ..operators import features as feat
from ..sources import tables
from . import oracle_views as ov
from .registry import r4, register, sql_double, sql_round

LAGS = feat.DEFAULT_LAGS
WINDOWS = feat.DEFAULT_WINDOWS
ORDER = feat.DEFAULT_FOURIER_ORDER
PERIOD = feat.DEFAULT_FOURIER_PERIOD

# ---------------------------------------------------------------- SQL pieces

W_SQL = 'OVER (PARTITION BY series_id ORDER BY "timestamp"{frame})'


def _lag_sql(lags=LAGS) -> list[str]:
    return [f"lag(value, {k}) {W_SQL.format(frame='')} AS lag_{k}" for k in lags]


def _rolling_sql(sizes=WINDOWS) -> list[str]:
    """Exact decimal moments, as ``rolling_columns(exact_scale=2)``."""
    out = []
    x = "CAST(value AS DECIMAL(38,2))"
    for n in sizes:
        fr = W_SQL.format(frame=f" ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW")
        cnt, s1, s2 = f"count(value) {fr}", f"sum({x}) {fr}", f"sum({x} * {x}) {fr}"
        mean = f"CASE WHEN {cnt} > 0 THEN CAST({s1} AS DOUBLE) / CAST({cnt} AS DOUBLE) END"
        std = (f"CASE WHEN {cnt} > 1 THEN sqrt(greatest(CAST({cnt} * {s2} - {s1} * {s1} AS DOUBLE), 0.0)"
               f" / CAST({cnt} * ({cnt} - 1) AS DOUBLE)) END")
        out += [f"{sql_round(mean)} AS rolling_mean_{n}",
                f"{sql_round(std)} AS rolling_std_{n}",
                f"min(value) {fr} AS rolling_min_{n}",
                f"max(value) {fr} AS rolling_max_{n}"]
    return out


CAL_SQL = [
    'CAST(isodow("timestamp") - 1 AS INTEGER) AS day_of_week',
    'CAST(day("timestamp") AS INTEGER) AS day_of_month',
    'CAST(month("timestamp") AS INTEGER) AS month',
    'CAST(quarter("timestamp") AS INTEGER) AS quarter',
    'CAST(weekofyear("timestamp") AS INTEGER) AS week_of_year',
    'CAST(isodow("timestamp") >= 6 AS INTEGER) AS is_weekend',
    'CAST(day("timestamp") = 1 AS INTEGER) AS is_month_start',
    'CAST(CAST("timestamp" AS DATE) = last_day("timestamp") AS INTEGER) AS is_month_end',
]


def _fourier_sql(order=ORDER, period=PERIOD, origin="t0.t0") -> list[str]:
    days = f'(CAST(epoch_us("timestamp") - epoch_us({origin}) AS DOUBLE) / {sql_double(8.64e10)})'
    out = []
    for k in range(1, order + 1):
        c = sql_double(2.0 * math.pi * k / period)
        out += [f"{sql_round(f'sin({c} * {days})')} AS sin_{k}",
                f"{sql_round(f'cos({c} * {days})')} AS cos_{k}"]
    return out


def _rolling_round(df):
    """Report rolling mean/std and Fourier terms at 4 decimals."""
    out = {c: r4(c) for c in df.columns
           if c.startswith(("rolling_mean_", "rolling_std_", "sin_", "cos_"))}
    return df.withColumns(out)


# ---------------------------------------------------------------- queries

@register("lag_features", sql=ov.with_views(ov.DAILY_ORDERS) +
          f"SELECT series_id, \"timestamp\", value, {', '.join(_lag_sql())} FROM daily_orders")
def q_lag_features(spark, d):
    return feat.lag_features(tables.daily_orders(spark, d), LAGS)


@register("rolling_features", sql=ov.with_views(ov.DAILY_ORDERS) +
          f"SELECT series_id, \"timestamp\", value, {', '.join(_rolling_sql())} FROM daily_orders")
def q_rolling_features(spark, d):
    return _rolling_round(feat.rolling_features(tables.daily_orders(spark, d), WINDOWS,
                                                exact_scale=2))


@register("calendar_features", sql=ov.with_views(ov.DAILY_ORDERS) +
          f"SELECT series_id, \"timestamp\", value, {', '.join(CAL_SQL)} FROM daily_orders")
def q_calendar_features(spark, d):
    return feat.calendar_features(tables.daily_orders(spark, d))


@register("fourier_features", sql=ov.with_views(ov.DAILY_ORDERS) +
          f"SELECT series_id, \"timestamp\", value, {', '.join(_fourier_sql())} "
          f"FROM daily_orders, (SELECT min(\"timestamp\") AS t0 FROM daily_orders) t0")
def q_fourier_features(spark, d):
    return _rolling_round(feat.fourier_features(tables.daily_orders(spark, d), ORDER, PERIOD))


def _all_features_sql(view: str, views: tuple[str, ...], lags=LAGS, sizes=WINDOWS,
                      order=ORDER, period=PERIOD) -> str:
    inner = (f"SELECT series_id, \"timestamp\", value, {', '.join(_lag_sql(lags))}, "
             f"{', '.join(_rolling_sql(sizes))}, {', '.join(CAL_SQL)}, "
             f"{', '.join(_fourier_sql(order, period))} "
             f"FROM {view}, (SELECT min(\"timestamp\") AS t0 FROM {view}) t0")
    cols = ([f"lag_{k}" for k in lags] +
            [f"rolling_{s}_{n}" for n in sizes for s in ("mean", "std", "min", "max")])
    cond = " AND ".join(f"{c} IS NOT NULL" for c in cols) or "TRUE"
    return ov.with_views(*views) + f"SELECT * FROM ({inner}) f WHERE {cond}"


DAILY_SPEC = feat.FeatureSpec(exact_scale=2)


@register("all_features", sql=_all_features_sql("daily_orders", (ov.DAILY_ORDERS,)))
def q_all_features(spark, d):
    return _rolling_round(feat.all_features(tables.daily_orders(spark, d), DAILY_SPEC))


HOURLY_SPEC = feat.FeatureSpec(lags=(1, 24), windows=(24,), fourier_order=2, fourier_period=1.0,
                               calendar=False, exact_scale=2)


@register("drop_incomplete",
          sql=_all_features_sql("hourly_events", (ov.HOURLY_EVENTS,), lags=(1, 24), sizes=(24,),
                                order=2, period=1.0).replace(", " + ", ".join(CAL_SQL), ""))
def q_drop_incomplete(spark, d):
    return _rolling_round(feat.all_features(tables.hourly_events(spark, d), HOURLY_SPEC))
