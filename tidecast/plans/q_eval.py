"""Registered queries: split, folds, metrics, ranking, CV summaries, history."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluate as ev
from ..operators import features as feat
from ..operators import split
from ..session import cut_lineage
from ..sources import tables
from . import fixtures
from . import oracle_views as ov
from .q_features import DAILY_SPEC, _all_features_sql
from .registry import register, sql_round

METRIC_NAMES = ("rmse", "mae", "mape", "smape", "r2", "directional_accuracy")

# ---------------------------------------------------------------- SQL builders

POS_SQL = """
pos AS (
  SELECT series_id, "timestamp", value,
         row_number() OVER (PARTITION BY series_id ORDER BY "timestamp", value) AS pos,
         count(*) OVER (PARTITION BY series_id) AS n
  FROM daily_orders)"""


def _two_models_sql(targets: str, keys: str) -> str:
    """naive / seasonal-naive forecasts joined from ``pos`` for rows of ``targets``."""
    return f"""
  SELECT 'naive' AS model, t.series_id, {keys} t.step, t.actual, s.value AS forecast
  FROM {targets} t JOIN pos s ON s.series_id = t.series_id AND s.pos = t.train_end
  UNION ALL
  SELECT 'seasonal_naive' AS model, t.series_id, {keys} t.step, t.actual, s.value AS forecast
  FROM {targets} t JOIN pos s ON s.series_id = t.series_id
       AND s.pos = t.train_end - 7 + ((t.step - 1) % 7) + 1"""


def holdout_sql(horizon: int) -> str:
    return f""",
test AS (
  SELECT series_id, "timestamp", value AS actual, CAST(pos - (n - {horizon}) AS INTEGER) AS step,
         n - {horizon} AS train_end
  FROM pos WHERE pos > n - {horizon}),
fc AS ({_two_models_sql('test', 't."timestamp",')})"""


FOLDS_SQL = """,
nf AS (
  SELECT *, CASE WHEN n // 4 < 10 THEN greatest(1, n // 10 - 1) ELSE 3 END AS folds FROM pos),
nz AS (SELECT *, n // (folds + 1) AS z FROM nf),
fo AS (
  SELECT nz.*, CAST(f.range AS INTEGER) AS fold, z * f.range AS train_end
  FROM nz, range(1, 100) f WHERE f.range <= folds AND z > 0),
val AS (
  SELECT series_id, fold, value AS actual, CAST(pos - train_end AS INTEGER) AS step, train_end
  FROM fo WHERE pos > train_end AND pos <= least(train_end + z, n)),
fc AS (""" + _two_models_sql("val", "t.fold,") + ")"


def metrics_sql(src: str, by: list[str]) -> str:
    """SELECT computing the six metrics per ``by`` over forecast rows in ``src``."""
    keys = ", ".join(by)
    on = " AND ".join(f"p.{k} = f.{k}" for k in by)
    err = "(actual - forecast)"
    n = "count(*)"
    ss_res = f"sum({err} * {err})"
    ss_tot = f"(var_pop(actual) * {n})"
    r2 = (f"CASE WHEN {n} < 2 THEN CAST('nan' AS DOUBLE) WHEN {ss_tot} = 0 THEN "
          f"CASE WHEN {ss_res} = 0 THEN 1.0 ELSE 0.0 END ELSE 1.0 - {ss_res} / {ss_tot} END")
    mape = (f"coalesce(avg(CASE WHEN actual <> 0 THEN abs({err} / actual) END) * 100.0, "
            f"CAST('inf' AS DOUBLE))")
    smape = (f"avg(CASE WHEN abs(actual) + abs(forecast) = 0 THEN 0.0 "
             f"ELSE 2.0 * abs({err}) / (abs(actual) + abs(forecast)) END) * 100.0")
    da = (f"coalesce(avg(CASE WHEN actual_prev IS NOT NULL THEN CAST(((actual - actual_prev) > 0) = "
          f"((forecast - forecast_prev) > 0) AS DOUBLE) END) * 100.0, 0.0)")
    exprs = {"rmse": f"sqrt(avg({err} * {err}))", "mae": f"avg(abs({err}))", "mape": mape,
             "smape": smape, "r2": r2, "directional_accuracy": da}
    sel = ", ".join(f"{sql_round(v)} AS {k}" for k, v in exprs.items())
    return (f"SELECT {keys}, {sel}, CAST({n} AS BIGINT) AS n FROM ("
            f"SELECT f.*, p.actual AS actual_prev, p.forecast AS forecast_prev FROM {src} f "
            f"LEFT JOIN {src} p ON {on} AND p.step = f.step - 1) GROUP BY {keys}")


HOLDOUT = ov.with_views(ov.DAILY_ORDERS, POS_SQL).rstrip("\n") + holdout_sql(28)
FOLDS = ov.with_views(ov.DAILY_ORDERS, POS_SQL).rstrip("\n") + FOLDS_SQL
METRICS_HOLDOUT = f"metrics AS ({metrics_sql('fc', ['model', 'series_id'])})"
METRICS_FOLDS = f"fold_metrics AS ({metrics_sql('fc', ['model', 'series_id', 'fold'])})"


def _holdout_metrics(spark, d, horizon=28):
    fc = fixtures.holdout_forecasts(tables.daily_orders(spark, d), horizon)
    return ev.forecast_metrics(fc, by=("model", "series_id"))


def _fold_metrics(spark, d):
    fc = fixtures.fold_forecasts(tables.daily_orders(spark, d), n_folds=3)
    return ev.forecast_metrics(fc, by=("model", "series_id", "fold"))


# ---------------------------------------------------------------- split / folds

FEATURES_SUB = "(" + _all_features_sql("daily_orders", (ov.DAILY_ORDERS,)) + ")"


@register("chrono_split", sql=f"""
SELECT series_id, "timestamp", pos, n_rows,
       CASE WHEN pos <= floor(CAST(n_rows AS DOUBLE) * CAST('0.8' AS DOUBLE)) THEN 'train' ELSE 'test' END AS split
FROM (SELECT series_id, "timestamp",
             row_number() OVER (PARTITION BY series_id ORDER BY "timestamp", value) AS pos,
             count(*) OVER (PARTITION BY series_id) AS n_rows
      FROM {FEATURES_SUB} f)""")
def q_chrono_split(spark, d):
    f = feat.all_features(tables.daily_orders(spark, d), DAILY_SPEC)
    return split.chrono_split(f, 0.8).select("series_id", "timestamp", "pos", "n_rows", "split")


@register("chrono_split_global", sql=f"""
SELECT series_id, "timestamp", pos, n_rows,
       CASE WHEN pos <= floor(CAST(n_rows AS DOUBLE) * CAST('0.8' AS DOUBLE)) THEN 'train' ELSE 'test' END AS split
FROM (SELECT series_id, "timestamp",
             row_number() OVER (ORDER BY "timestamp", series_id) AS pos,
             count(*) OVER () AS n_rows
      FROM {FEATURES_SUB} f)""")
def q_chrono_split_global(spark, d):
    f = feat.all_features(tables.daily_orders(spark, d), DAILY_SPEC)
    return (split.chrono_split(f, 0.8, scope="global")
                 .select("series_id", "timestamp", "pos", "n_rows", "split"))


@register("expanding_folds", sql=f"""
WITH tr AS (
  SELECT series_id, "timestamp", value FROM (
    SELECT series_id, "timestamp", value,
           row_number() OVER (PARTITION BY series_id ORDER BY "timestamp", value) AS pos,
           count(*) OVER (PARTITION BY series_id) AS n
    FROM {FEATURES_SUB} f) WHERE pos <= floor(CAST(n AS DOUBLE) * CAST('0.8' AS DOUBLE))),
p AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY "timestamp", value) AS pos,
             count(*) OVER (PARTITION BY series_id) AS n FROM tr),
nf AS (SELECT *, CASE WHEN n // 4 < 10 THEN greatest(1, n // 10 - 1) ELSE 3 END AS folds FROM p),
nz AS (SELECT *, n // (folds + 1) AS z FROM nf),
fo AS (SELECT nz.*, CAST(f.range AS INTEGER) AS fold, z * f.range AS te FROM nz, range(1, 100) f
       WHERE f.range <= folds AND z > 0),
r AS (SELECT *, CASE WHEN pos <= te THEN 'train' WHEN pos <= least(te + z, n) THEN 'val' END AS role FROM fo)
SELECT series_id, fold, role, count(*) AS n_rows, min("timestamp") AS first_ts, max("timestamp") AS last_ts
FROM r WHERE role IS NOT NULL GROUP BY series_id, fold, role""")
def q_expanding_folds(spark, d):
    f = feat.all_features(tables.daily_orders(spark, d), DAILY_SPEC)
    train = split.chrono_split(f, 0.8).where(F.col("split") == "train").drop("pos", "n_rows", "split")
    folds = split.expanding_folds(train, n_folds=3)
    return folds.groupBy("series_id", "fold", "role").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("timestamp").alias("first_ts"),
        F.max("timestamp").alias("last_ts"))


@register("fold_reduction", sql=ov.with_views(ov.MONTHLY_NATION) + """,
p AS (SELECT series_id, value, row_number() OVER (PARTITION BY series_id ORDER BY "timestamp", value) AS pos,
             count(*) OVER (PARTITION BY series_id) AS n FROM monthly_nation),
nf AS (SELECT *, CASE WHEN n // 10 < 10 THEN greatest(1, n // 10 - 1) ELSE 9 END AS folds FROM p),
nz AS (SELECT *, n // (folds + 1) AS z FROM nf),
fo AS (SELECT nz.*, CAST(f.range AS INTEGER) AS fold, z * f.range AS te FROM nz, range(1, 100) f WHERE f.range <= folds AND z > 0),
r AS (SELECT *, CASE WHEN pos <= te THEN 'train' WHEN pos <= least(te + z, n) THEN 'val' END AS role FROM fo)
SELECT series_id, fold, role, count(*) AS n_rows, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS sum_value
FROM r WHERE role IS NOT NULL GROUP BY series_id, fold, role""")
def q_fold_reduction(spark, d):
    """Nine folds are asked for; series of some eighty months have fewer."""
    folds = split.expanding_folds(tables.monthly_nation(spark, d), n_folds=9)
    return folds.groupBy("series_id", "fold", "role").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("sum_value"))


@register("train_folds", sql=f"""
WITH tr AS (
  SELECT series_id, "timestamp", value, lag_7, rolling_max_30 FROM (
    SELECT series_id, "timestamp", value, lag_7, rolling_max_30,
           row_number() OVER (PARTITION BY series_id ORDER BY "timestamp", value) AS pos,
           count(*) OVER (PARTITION BY series_id) AS n
    FROM {FEATURES_SUB} f) WHERE pos <= floor(CAST(n AS DOUBLE) * CAST('0.8' AS DOUBLE))),
p AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY "timestamp", value) AS pos,
             count(*) OVER (PARTITION BY series_id) AS n FROM tr),
nf AS (SELECT *, CASE WHEN n // 4 < 10 THEN greatest(1, n // 10 - 1) ELSE 3 END AS folds FROM p),
nz AS (SELECT *, n // (folds + 1) AS z FROM nf),
fo AS (SELECT nz.*, CAST(f.range AS INTEGER) AS fold, z * f.range AS te FROM nz, range(1, 100) f
       WHERE f.range <= folds AND z > 0),
r AS (SELECT *, CASE WHEN pos <= te THEN 'train' WHEN pos <= least(te + z, n) THEN 'val' END AS role FROM fo)
SELECT series_id, fold, role, count(*) AS n_rows, min("timestamp") AS first_ts, max("timestamp") AS last_ts,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS sum_value, CAST(sum(CAST(lag_7 AS DECIMAL(18,2))) AS DOUBLE) AS sum_lag_7,
       CAST(sum(CAST(rolling_max_30 AS DECIMAL(18,2))) AS DOUBLE) AS sum_max_30
FROM r WHERE role IS NOT NULL AND n > 50 GROUP BY series_id, fold, role""")
def q_train_folds(spark, d):
    """The rows and features that every member is trained and validated on in each fold."""
    from . import training
    f = cut_lineage(feat.all_features(tables.daily_orders(spark, d), DAILY_SPEC))
    train = cut_lineage(split.chrono_split(f, 0.8).where(F.col("split") == "train").drop("pos", "n_rows", "split"))
    folds = training.cv_frame(train, training.TrainingConfig(spec=DAILY_SPEC))
    cents = lambda c: F.sum(F.col(c).cast("decimal(18,2)")).cast("double")
    return folds.groupBy("series_id", "fold", "role").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("timestamp").alias("first_ts"), F.max("timestamp").alias("last_ts"),
        cents("value").alias("sum_value"), cents("lag_7").alias("sum_lag_7"), cents("rolling_max_30").alias("sum_max_30"))


# ---------------------------------------------------------------- metrics / ranking

@register("forecast_metrics", sql=HOLDOUT + ",\n" + METRICS_HOLDOUT + "\nSELECT * FROM metrics")
def q_forecast_metrics(spark, d):
    return _holdout_metrics(spark, d)


@register("metrics_by_fold", sql=FOLDS + ",\n" + METRICS_FOLDS + "\nSELECT * FROM fold_metrics")
def q_metrics_by_fold(spark, d):
    return _fold_metrics(spark, d)


def _cv_summary_sql() -> str:
    parts = []
    for m in METRIC_NAMES:
        parts.append(f"{sql_round(f'avg({m})')} AS {m}_mean")
        parts.append(f"{sql_round(f'stddev_samp({m})')} AS {m}_std")
    return (FOLDS + ",\n" + METRICS_FOLDS + f"\nSELECT model, series_id, {', '.join(parts)}, "
            f"count(*) AS n_folds FROM fold_metrics GROUP BY model, series_id")


@register("cv_summary", sql=_cv_summary_sql())
def q_cv_summary(spark, d):
    return ev.cv_summary(_fold_metrics(spark, d))


@register("aggregate_cv", sql=FOLDS + ",\n" + METRICS_FOLDS + "\nSELECT model, series_id, " +
          ", ".join(f"{sql_round(f'avg({m})')} AS {m}" for m in METRIC_NAMES) +
          " FROM fold_metrics GROUP BY model, series_id")
def q_aggregate_cv(spark, d):
    return ev.aggregate_cv(_fold_metrics(spark, d))


@register("rank_models", sql=HOLDOUT + ",\n" + METRICS_HOLDOUT + """
SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY
         CASE WHEN isnan(rmse) THEN NULL ELSE rmse END ASC NULLS LAST, model) AS rank
FROM metrics""")
def q_rank_models(spark, d):
    return ev.rank_models(_holdout_metrics(spark, d), "rmse", ascending=True)


@register("best_model", sql=HOLDOUT + ",\n" + METRICS_HOLDOUT + """,
k AS (SELECT series_id, model, coalesce(CASE WHEN isnan(rmse) THEN NULL ELSE rmse END,
                                       CAST('inf' AS DOUBLE)) AS key FROM metrics)
SELECT series_id, arg_min(model, (key, model)) AS best_model, min(key) AS best_rmse
FROM k GROUP BY series_id""")
def q_best_model(spark, d):
    return ev.best_model(_holdout_metrics(spark, d))


@register("eval_history", sql=ov.with_views(ov.DAILY_ORDERS, POS_SQL).rstrip("\n") +
          holdout_sql(14) + ",\n" + METRICS_HOLDOUT +
          "\nSELECT *, CAST(2 AS INTEGER) AS run_id FROM metrics")
def q_eval_history(spark, d):
    h = ev.append_history(None, _holdout_metrics(spark, d, 28), run_id=1)
    h = ev.append_history(h, _holdout_metrics(spark, d, 14), run_id=2)
    return ev.latest_per_model(h)


@register("forecast_residuals", sql=HOLDOUT + f"""
SELECT model, series_id, step, {sql_round('actual - forecast')} AS residual FROM fc""")
def q_forecast_residuals(spark, d):
    fc = fixtures.holdout_forecasts(tables.daily_orders(spark, d), 28)
    r = ev.residuals(fc)
    return r.select("model", "series_id", "step", ev.round_half_away(F.col("residual"), 4)
                    .alias("residual"))


@register("best_model_forecast", sql=HOLDOUT + ",\n" + METRICS_HOLDOUT + """,
best AS (SELECT series_id, arg_min(model, (CASE WHEN isnan(rmse) THEN CAST('inf' AS DOUBLE) ELSE rmse END, model)) AS model
         FROM metrics GROUP BY series_id),
last AS (SELECT series_id, max(pos) AS n, max("timestamp") AS last_ts FROM pos GROUP BY series_id),
spine AS (SELECT b.series_id, b.model, l.n, l.last_ts, CAST(k.range AS INTEGER) AS step
          FROM best b JOIN last l USING (series_id), range(1, 15) k)
SELECT s.series_id, s.model, s.step, CAST(s.last_ts + to_days(s.step) AS DATE) AS date,
       round(p.value, 2) + 0.0 AS forecast
FROM spine s JOIN pos p ON p.series_id = s.series_id
 AND p.pos = CASE WHEN s.model = 'naive' THEN s.n ELSE s.n - 7 + ((s.step - 1) % 7) + 1 END""")
def q_best_model_forecast(spark, d):
    """Best fixture model per series by holdout RMSE, its next 14 days, shown as date + cents."""
    from ..operators import grid, windows
    series = tables.daily_orders(spark, d)
    best = ev.best_model(_holdout_metrics(spark, d)).select("series_id", F.col("best_model").alias("model"))
    pos = windows.with_position(series, with_count=True)
    spine = grid.future_spine(series, 14, freq="D").join(best, "series_id")
    ends = pos.where(F.col("pos") == F.col("n_rows")).select("series_id", F.col("pos").alias("_n"))
    src = (F.when(F.col("model") == "naive", F.col("_n"))
            .otherwise(F.col("_n") - fixtures.SEASON + ((F.col("step") - 1) % fixtures.SEASON) + 1))
    j = (spine.join(ends, "series_id").withColumn("_src", src)
              .join(pos.select("series_id", F.col("pos").alias("_src"), "value"), ["series_id", "_src"]))
    return j.select("series_id", "model", "step", F.to_date("timestamp").alias("date"),
                    ev.round_half_away(F.col("value"), 2).alias("forecast"))
