"""Features for forecasting several steps ahead: only what is known at the origin.

A row stands for a target time ``step`` grid steps after its origin, the last observation that counts as known:

* ``lag_k`` is the value k rows before the target, NULL where that lies after the origin (k < step);
* rolling statistics are frozen: those of the window that ends at the origin;
* calendar parts and Fourier terms are those of the target time;
* ``known`` adds columns that are known ahead for the target time, joined on (series, timestamp).

:func:`training_frame` deals the past into blocks of ``horizon`` rows, each seen from the last row of the block
before, so every row is a target once and all steps occur equally often.  :func:`future_frame` has the same columns
for the steps after the last observation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import calendar as cal
from . import features as feat
from . import grid, windows

STEP = "step"


def _time_columns(df: DataFrame, spec: feat.FeatureSpec, origin, known: DataFrame | None) -> DataFrame:
    c = spec.cols
    if known is not None:
        df = df.join(known, [c.series, c.ts], "left")
    if spec.calendar:
        df = df.withColumns(cal.calendar_columns(c.ts))
    if spec.fourier_order > 0:
        df = feat.fourier_features(df, spec.fourier_order, spec.fourier_period, c, origin=origin)
    return df


def _rolling(spec: feat.FeatureSpec, w) -> dict:
    return feat.rolling_columns(w, spec.cols.value, spec.windows, True, spec.exact_scale)


def training_frame(df: DataFrame, horizon: int, spec: feat.FeatureSpec = feat.FeatureSpec(), known: DataFrame | None = None,
                   **kw) -> DataFrame:
    """``(series, timestamp, value, step, lag_*, rolling_*, ...)`` for every row after the first ``horizon`` of its series.

    Rows follow each other without regard to gaps, as in :func:`features.lag_features`.
    """
    c, pos = spec.cols, F.col(windows.POS)
    step = (pos - 1) % horizon + 1
    narrow = df.select(c.series, c.ts, c.value)
    back = max([*spec.lags, *[n - 1 for n in spec.windows], 0])
    d = windows.halo_window(narrow, lambda w: feat.lag_columns(w, c.value, spec.lags) | _rolling(spec, w), back, c, keep_pos=True, **kw)
    rolled = list(_rolling(spec, Window.orderBy(c.ts)))
    # the origin of a row is the last row of the block before; its statistics are carried over the block
    carried = F.when(pos % horizon == 0, F.struct(*rolled)) if rolled else F.lit(None)
    d = windows.halo_window(d, lambda w: {"_origin": F.last(carried, ignorenulls=True).over(w.rowsBetween(-horizon, -1))}, horizon, c, **kw)
    out = d.where(pos > horizon).select(
        c.series, c.ts, c.value, step.cast("int").alias(STEP), *[F.when(step <= k, F.col(f"lag_{k}")).alias(f"lag_{k}") for k in spec.lags],
        *[F.col(f"_origin.{r}").alias(r) for r in rolled])
    return _time_columns(out, spec, feat.fourier_origin(df, c), known)


def future_frame(df: DataFrame, horizon: int, spec: feat.FeatureSpec = feat.FeatureSpec(), freq: str | None = "D",
                 freq_df: DataFrame | None = None, known: DataFrame | None = None, **kw) -> DataFrame:
    """``(series, timestamp, step, lag_*, rolling_*, ...)`` for the ``horizon`` steps after each series' last row.

    ``freq`` is one frequency code for all series, ``freq_df`` the frequencies by series (:func:`grid.infer_frequency`).
    """
    c = spec.cols
    reach = max([*spec.lags, *spec.windows, 1])
    tail = windows.with_position(df.select(c.series, c.ts, c.value), c, with_count=True, **kw).withColumn(
        "_back", (F.col(windows.N_ROWS) - F.col(windows.POS)).cast("int")).where(F.col("_back") < reach)
    spine = grid.future_spine(df, horizon, freq, freq_df, c)
    out = spine.select(c.series, c.ts, F.col("step").cast("int").alias(STEP))
    if spec.lags:
        # the value `back` rows before the end is lag k of step k - back
        reached = tail.withColumn("_k", F.explode(F.array(*[F.lit(k) for k in spec.lags]))).withColumn(STEP, F.col("_k") - F.col("_back")).where(
            F.col(STEP).between(1, horizon))
        lags = reached.groupBy(c.series, STEP).agg(*[F.max(F.when(F.col("_k") == k, F.col(c.value))).alias(f"lag_{k}") for k in spec.lags])
        out = out.join(lags, [c.series, STEP], "left")
    rolled = []
    if spec.windows:
        # at most `reach` rows of a series are left here
        stats = _rolling(spec, Window.partitionBy(c.series).orderBy(c.ts, c.value))
        rolled = list(stats)
        out = out.join(tail.select(c.series, "_back", *[x.alias(n) for n, x in stats.items()]).where("_back = 0").drop("_back"), c.series)
    out = out.select(c.series, c.ts, STEP, *[f"lag_{k}" for k in spec.lags], *rolled)
    return _time_columns(out, spec, feat.fourier_origin(df, c), known)
