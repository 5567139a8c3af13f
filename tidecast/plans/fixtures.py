"""Reference forecasts used to exercise scoring, ensembles and CV on real tables.

Naive (last training value) and seasonal-naive (value one season before, from
the end of training) forecasts are pure relational plans: equi-joins on
``(series, position)``.  They are inputs for the evaluation queries, the
same role the hand-made arrays play in the reference's tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import split, windows
from ..schema import SERIES, TS, VALUE

SEASON = 7


def _sources(pos_df: DataFrame) -> DataFrame:
    return pos_df.select(SERIES, F.col(windows.POS).alias("_src"), F.col(VALUE).alias("forecast"))


def _two_models(targets: DataFrame, src: DataFrame, train_end: F.Column, season: int,
                keys: list[str]) -> DataFrame:
    step = F.col("step")
    t = targets.withColumn("_naive", train_end).withColumn(
        "_seasonal", train_end - season + ((step - 1) % season) + 1)
    out = []
    for model, col in (("naive", "_naive"), ("seasonal_naive", "_seasonal")):
        j = t.join(src, (t[SERIES] == src[SERIES]) & (F.col(col) == src["_src"]))
        out.append(j.select(F.lit(model).alias("model"), t[SERIES], *keys, "step",
                            F.col("actual"), F.col("forecast")))
    return out[0].unionByName(out[1])


def holdout_forecasts(series: DataFrame, horizon: int = 28, season: int = SEASON) -> DataFrame:
    """``(model, series_id, step, timestamp, actual, forecast)`` on the last ``horizon`` rows."""
    d = windows.with_position(series, with_count=True)
    n_train = F.col(windows.N_ROWS) - horizon
    test = (d.where(F.col(windows.POS) > n_train)
             .select(SERIES, TS, F.col(VALUE).alias("actual"),
                     (F.col(windows.POS) - n_train).cast("int").alias("step"),
                     n_train.alias("_train_end")))
    return _two_models(test, _sources(d), F.col("_train_end"), season, [TS])


def fold_forecasts(series: DataFrame, n_folds: int = 3, season: int = SEASON) -> DataFrame:
    """``(model, series_id, fold, step, actual, forecast)`` on every validation block."""
    d = windows.with_position(series, with_count=True)
    f = split.expanding_folds(d, n_folds)
    val = (f.where(F.col(split.ROLE) == "val")
            .select(SERIES, split.FOLD, F.col(VALUE).alias("actual"),
                    (F.col(windows.POS) - F.col("train_end")).cast("int").alias("step"),
                    F.col("train_end").alias("_train_end")))
    return _two_models(val, _sources(d), F.col("_train_end"), season, [split.FOLD])
