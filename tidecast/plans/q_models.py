"""Registered queries: Holt-Winters / Holt linear on regularised daily series."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import grid
from ..operators import holtwinters as hw
from ..sources import tables
from . import oracle_views as ov
from .registry import r4, register, sql_double

HORIZON = 14
SEASON = 7
# Smoothing parameters of the fixed-parameter checks.
HW_FIXED = (0.2, 0.1, 0.1)
LINEAR_FIXED = (0.5, 0.1)

REG_DAILY_SQL = """
bounds AS (SELECT series_id, min("timestamp") AS lo, max("timestamp") AS hi FROM daily_orders GROUP BY 1),
g AS (SELECT series_id, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS TIMESTAMP) AS "timestamp" FROM bounds),
j AS (SELECT g.series_id, g."timestamp", m.value FROM g LEFT JOIN daily_orders m
      ON m.series_id = g.series_id AND m."timestamp" = g."timestamp"),
reg AS (SELECT series_id, "timestamp", last_value(value IGNORE NULLS) OVER (PARTITION BY series_id
          ORDER BY "timestamp" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value FROM j),
p AS (SELECT series_id, value, row_number() OVER (PARTITION BY series_id ORDER BY "timestamp") AS pos,
             max("timestamp") OVER (PARTITION BY series_id) AS last_ts FROM reg)"""


def _hw_sql(a: float, b: float, g: float) -> str:
    A, B, G = sql_double(a), sql_double(b), sql_double(g)
    nl = f"({A} * (p.value - h.s[1]) + (1 - {A}) * (h.l + h.b))"
    return ov.with_views(ov.DAILY_ORDERS, REG_DAILY_SQL).replace("WITH ", "WITH RECURSIVE ", 1) + f""",
init AS (SELECT series_id, avg(value) AS l0, list(value ORDER BY pos) AS ys FROM p WHERE pos <= {SEASON}
         GROUP BY series_id),
hw(series_id, t, l, b, s) AS (
  SELECT series_id, {SEASON}, l0, CAST(0.0 AS DOUBLE), list_transform(ys, lambda x: x - l0) FROM init
  UNION ALL
  SELECT h.series_id, h.t + 1, {nl}, {B} * ({nl} - h.l) + (1 - {B}) * h.b,
         list_append(h.s[2:], {G} * (p.value - h.l - h.b) + (1 - {G}) * h.s[1])
  FROM hw h JOIN p ON p.series_id = h.series_id AND p.pos = h.t + 1),
fin AS (SELECT h.* FROM hw h JOIN (SELECT series_id, max(pos) AS n FROM p GROUP BY 1) x
        ON x.series_id = h.series_id AND x.n = h.t),
lt AS (SELECT DISTINCT series_id, last_ts FROM p)
SELECT f.series_id, CAST(k.range AS INTEGER) AS step,
       CAST(lt.last_ts + to_days(CAST(k.range AS INTEGER)) AS TIMESTAMP) AS "timestamp",
       round(f.l + k.range * f.b + f.s[((k.range - 1) % {SEASON}) + 1], 2) + 0.0 AS forecast
FROM fin f JOIN lt USING (series_id), range(1, {HORIZON + 1}) k"""


def _linear_sql(a: float, b: float) -> str:
    A, B = sql_double(a), sql_double(b)
    nl = f"({A} * p.value + (1 - {A}) * (h.l + h.b))"
    return ov.with_views(ov.DAILY_ORDERS, REG_DAILY_SQL).replace("WITH ", "WITH RECURSIVE ", 1) + f""",
hw(series_id, t, l, b) AS (
  SELECT series_id, 1, value, CAST(0.0 AS DOUBLE) FROM p WHERE pos = 1
  UNION ALL
  SELECT h.series_id, h.t + 1, {nl}, {B} * ({nl} - h.l) + (1 - {B}) * h.b
  FROM hw h JOIN p ON p.series_id = h.series_id AND p.pos = h.t + 1),
fin AS (SELECT h.* FROM hw h JOIN (SELECT series_id, max(pos) AS n FROM p GROUP BY 1) x
        ON x.series_id = h.series_id AND x.n = h.t),
lt AS (SELECT DISTINCT series_id, last_ts FROM p)
SELECT f.series_id, CAST(k.range AS INTEGER) AS step,
       CAST(lt.last_ts + to_days(CAST(k.range AS INTEGER)) AS TIMESTAMP) AS "timestamp",
       round(f.l + k.range * f.b, 2) + 0.0 AS forecast
FROM fin f JOIN lt USING (series_id), range(1, {HORIZON + 1}) k"""


def _calendar_sql(view: str, freq: str, season: int, unit: str, start: str) -> str:
    """Holt-Winters with fixed parameters of all series of a view on the grid of ``unit`` (for series of one season at least)."""
    A, B, G = (sql_double(x) for x in HW_FIXED)
    nl = f"({A} * (p.value - h.s[1]) + (1 - {A}) * (h.l + h.b))"
    v = view
    return f"""
{v}_b AS (SELECT series_id, {start} AS lo, max("timestamp") AS hi FROM {v} GROUP BY 1),
{v}_g AS (SELECT series_id, CAST(unnest(generate_series(lo, hi, INTERVAL 1 {unit})) AS TIMESTAMP) AS "timestamp" FROM {v}_b),
{v}_r AS (SELECT g.series_id, g."timestamp", last_value(m.value IGNORE NULLS) OVER (PARTITION BY g.series_id ORDER BY g."timestamp"
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value
          FROM {v}_g g LEFT JOIN {v} m ON m.series_id = g.series_id AND m."timestamp" = g."timestamp"),
{v}_p AS (SELECT series_id, value, row_number() OVER (PARTITION BY series_id ORDER BY "timestamp") AS pos,
             max("timestamp") OVER (PARTITION BY series_id) AS last_ts FROM {v}_r),
{v}_i AS (SELECT series_id, avg(value) AS l0, list(value ORDER BY pos) AS ys FROM {v}_p WHERE pos <= {season} GROUP BY series_id),
{v}_h(series_id, t, l, b, s) AS (
  SELECT series_id, {season}, l0, CAST(0.0 AS DOUBLE), [x - l0 for x in ys] FROM {v}_i
  UNION ALL
  SELECT h.series_id, h.t + 1, {nl}, {B} * ({nl} - h.l) + (1 - {B}) * h.b,
         list_append(h.s[2:], {G} * (p.value - h.l - h.b) + (1 - {G}) * h.s[1])
  FROM {v}_h h JOIN {v}_p p ON p.series_id = h.series_id AND p.pos = h.t + 1),
{v}_f AS (SELECT h.*, x.last_ts FROM {v}_h h JOIN (SELECT series_id, max(pos) AS n, max(last_ts) AS last_ts FROM {v}_p GROUP BY 1) x
          ON x.series_id = h.series_id AND x.n = h.t),
{v}_o AS (SELECT f.series_id, '{freq}' AS freq, CAST(k.range AS INTEGER) AS step,
                 CAST(f.last_ts + to_{unit.lower()}s(CAST(k.range AS INTEGER)) AS TIMESTAMP) AS "timestamp",
                 round(f.l + k.range * f.b + f.s[((k.range - 1) % {season}) + 1], 2) + 0.0 AS forecast
          FROM {v}_f f, range(1, {HORIZON + 1}) k)"""


_FIRST = 'min("timestamp")'


@register("hw_by_frequency", sql=ov.with_views(ov.DAILY_ORDERS, ov.MONTHLY_NATION, ov.HOURLY_EVENTS).replace("WITH ", "WITH RECURSIVE ", 1) + "," + ",".join([
    _calendar_sql("daily_orders", "D", 7, "DAY", _FIRST), _calendar_sql("monthly_nation", "MS", 12, "MONTH", _FIRST),
    _calendar_sql("hourly_events", "H", 24, "HOUR", _FIRST)]) + """
SELECT * FROM daily_orders_o UNION ALL SELECT * FROM monthly_nation_o UNION ALL SELECT * FROM hourly_events_o""")
def q_hw_by_frequency(spark, d):
    """Daily, monthly and hourly series in one call; the frequencies and seasons are inferred."""
    from ..operators import seasonal
    every = tables.daily_orders(spark, d).unionByName(tables.monthly_nation(spark, d)).unionByName(tables.hourly_events(spark, d))
    fc = seasonal.holt_winters(every, HORIZON, params=hw.fixed(*HW_FIXED))
    return fc.select("series_id", "freq", F.col("step").cast("int").alias("step"), "timestamp", r4("forecast", 2).alias("forecast"))


def _regular_daily(spark, d):
    return grid.regularise(tables.daily_orders(spark, d), "D", with_position=True).drop("filled")


def _fc_out(fc):
    return fc.select("series_id", F.col("step").cast("int").alias("step"), "timestamp",
                     r4("forecast", 2).alias("forecast"))


@register("hw_fixed", sql=_hw_sql(*HW_FIXED))
def q_hw_fixed(spark, d):
    fit = hw.fit(_regular_daily(spark, d), SEASON, params=hw.fixed(*HW_FIXED))
    return _fc_out(hw.forecast(fit, HORIZON, "D"))


@register("hw_linear_fixed", sql=_linear_sql(*LINEAR_FIXED))
def q_hw_linear_fixed(spark, d):
    fit = hw.fit(_regular_daily(spark, d), 0, params=hw.fixed(*LINEAR_FIXED))
    return _fc_out(hw.forecast(fit, HORIZON, "D"))


@register("hw_search", note="grid search of (α, β, γ) by SSE; rows-only check")
def q_hw_search(spark, d):
    fit = hw.fit(_regular_daily(spark, d), SEASON)
    fc = hw.forecast(fit, HORIZON, "D")
    return fc.join(fit.select("series_id", "alpha", "beta", "gamma"), "series_id").select(
        "series_id", "step", "timestamp", r4("forecast", 2).alias("forecast"),
        "alpha", "beta", "gamma")


# ---------------------------------------------------------------- trend + season, GBT

@register("trend_season", note="ridge trend + Fourier seasonality per series; rows-only check")
def q_trend_season(spark, d):
    from ..operators import trendseason as tsr
    params = tsr.fit(tables.daily_orders(spark, d), mode="multiplicative")
    fc = tsr.forecast(params, HORIZON, "D")
    return fc.select("series_id", F.col("step").cast("int").alias("step"), "timestamp",
                     r4("forecast", 2).alias("forecast"))


# The demo's boosted-tree settings (300 trees, learning rate 0.05, unlimited depth).  Here the
# boosting may end sooner: once the latest tenth of the rows gains nothing.
GBT_DEMO = dict(n_estimators=300, learning_rate=0.05, max_depth=-1, validation_share=0.1)


def _horizon_sql(kind: str) -> str:
    from . import q_features as qf
    lags, sizes = qf.LAGS, qf.WINDOWS
    rolled = [f"rolling_{x}_{n}" for n in sizes for x in ("mean", "std", "min", "max")]
    views = ov.with_views(ov.DAILY_ORDERS, f"""
r AS (SELECT series_id, "timestamp", value, {', '.join(qf._rolling_sql())},
             row_number() OVER (PARTITION BY series_id ORDER BY "timestamp") AS pos, count(*) OVER (PARTITION BY series_id) AS n
      FROM daily_orders)""")
    joins = " ".join(f"LEFT JOIN r l{k} ON l{k}.series_id = b.series_id AND l{k}.pos = b.target - {k} AND {k} >= b.step" for k in lags)
    if kind == "future":
        base = f"""SELECT r.series_id, CAST(r."timestamp" + to_days(CAST(k.range AS INTEGER)) AS TIMESTAMP) AS "timestamp",
                          CAST(k.range AS INTEGER) AS step, r.n + k.range AS target, {', '.join(rolled)}
                   FROM r, range(1, {HORIZON + 1}) k WHERE r.pos = r.n"""
        value = ""
    else:
        base = f"""SELECT t.series_id, t."timestamp", t.value, CAST((t.pos - 1) % {HORIZON} + 1 AS INTEGER) AS step, t.pos AS target,
                          {', '.join('r.' + x for x in rolled)}
                   FROM r t JOIN r ON r.series_id = t.series_id AND r.pos = t.pos - ((t.pos - 1) % {HORIZON} + 1)"""
        value = "b.value, "
    return views + f"""SELECT x.*, {', '.join(qf.CAL_SQL)}, {', '.join(qf._fourier_sql())}
FROM (SELECT b.series_id, b."timestamp", {value}b.step, {', '.join(f'l{k}.value AS lag_{k}' for k in lags)}, {', '.join('b.' + x for x in rolled)}
      FROM ({base}) b {joins}) x, (SELECT min("timestamp") AS t0 FROM daily_orders) t0"""


def _daily(spark, d):
    from .q_features import DAILY_SPEC
    return tables.daily_orders(spark, d), DAILY_SPEC


@register("gbt_future_features", sql=_horizon_sql("future"))
def q_gbt_future_features(spark, d):
    from ..operators import horizon
    from .q_features import _rolling_round
    daily, spec = _daily(spark, d)
    return _rolling_round(horizon.future_frame(daily, HORIZON, spec, "D"))


@register("gbt_training_features", sql=_horizon_sql("training"))
def q_gbt_training_features(spark, d):
    from ..operators import horizon
    from .q_features import _rolling_round
    daily, spec = _daily(spark, d)
    return _rolling_round(horizon.training_frame(daily, HORIZON, spec))


def _gbt_model(spark, d):
    """The boosted trees for the next ``HORIZON`` days, and the days."""
    from ..operators import gbt, horizon
    daily, spec = _daily(spark, d)
    seen = horizon.training_frame(daily, HORIZON, spec)
    return gbt.fit(seen, **GBT_DEMO), grid.future_spine(daily, HORIZON, freq="D")


@register("gbt_forecast", note="boosted trees on the features known at the origin, for the days after the last one")
def q_gbt_forecast(spark, d):
    from ..operators import horizon
    daily, spec = _daily(spark, d)
    model, spine = _gbt_model(spark, d)
    out = model.forecast(spine, horizon.future_frame(daily, HORIZON, spec, "D"))
    return out.select("series_id", "step", "timestamp", "naive", r4("forecast", 2).alias("forecast"))


@register("gbt_importance", note="feature importances of the boosted trees")
def q_gbt_importance(spark, d):
    model, _ = _gbt_model(spark, d)
    return model.importance(spark).select("feature", r4("importance", 6).alias("importance"))


@register("naive_zero_vector", note="boosted trees' prediction at the zero feature vector over a 14-step spine")
def q_naive_zero_vector(spark, d):
    model, spine = _gbt_model(spark, d)
    return model.forecast(spine).select("series_id", "step", "timestamp", r4("forecast", 2).alias("forecast"))


def _training(spark, d):
    from . import training
    daily, spec = _daily(spark, d)
    cfg = training.TrainingConfig(spec=spec, gbt_params=GBT_DEMO)
    return daily, cfg, training.run(daily, cfg)


@register("train_and_score", note="features → split → CV of all members → final fit → test metrics")
def q_train_and_score(spark, d):
    from . import training
    return training.summary(_training(spark, d)[2])


@register("best_trained_forecast", note="the 14 days after the last one by each series' best trained model")
def q_best_trained_forecast(spark, d):
    from . import training
    daily, spec = _daily(spark, d)
    cfg = training.TrainingConfig(spec=spec, gbt_params=GBT_DEMO, run_cv=False)
    out = training.best_forecast(daily, training.run(daily, cfg).final_metrics, HORIZON, cfg)
    return out.select("series_id", F.col("step").cast("int").alias("step"), "timestamp", "model", r4("forecast", 2).alias("forecast"))
