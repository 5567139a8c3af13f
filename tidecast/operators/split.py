"""Chronological train/test split and expanding-window cross-validation folds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import DEFAULT_COLS, SeriesCols
from . import windows

SPLIT = "split"
FOLD = "fold"
ROLE = "role"


def chrono_split(df: DataFrame, train_ratio: float = 0.8, cols: SeriesCols = DEFAULT_COLS,
                 scope: str = "series", **kw) -> DataFrame:
    """Label rows ``train``/``test``: the first ``floor(n·ratio)`` rows in time order.

    ``scope='series'`` cuts every series on its own (default).  ``scope='global'``
    cuts the whole frame at one position (the reference's behaviour on a stacked
    cuts the whole frame at one position (the reference's behaviour on a stacked
    frame), ties in time broken by series id: range partitions over (time, series), so no single task sees all rows.
    Adds ``pos`` and ``n_rows`` (per series or global) and ``split``.
    """
    if scope == "series":
        d = windows.with_position(df, cols, with_count=True, **kw)
    elif scope == "global":
        d = windows.with_position(df, cols, with_count=True, over_all=True, tie_break=[cols.series], **kw)
    else:
        raise ValueError(f"scope must be 'series' or 'global', not {scope!r}")
    cut = F.floor(F.col(windows.N_ROWS).cast("double") * F.lit(float(train_ratio)))
    return d.withColumn(SPLIT, F.when(F.col(windows.POS) <= cut, "train").otherwise("test"))


def fold_count(n: F.Column, n_folds: int) -> F.Column:
    """Folds actually used for a series of n rows (fewer when blocks would be < 10 rows)."""
    return F.when((n / (n_folds + 1)).cast("long") < 10,
                  F.greatest(F.lit(1).cast("long"), (n / 10).cast("long") - 1)
                  ).otherwise(F.lit(n_folds).cast("long"))


def expanding_folds(df: DataFrame, n_folds: int = 5, cols: SeriesCols = DEFAULT_COLS,
                    **kw) -> DataFrame:
    """Assign rows to expanding-window folds per series.

    With ``z = n div (F'+1)``: fold i (1..F') trains on positions ``≤ z·i`` and
    validates on ``z·i < pos ≤ min(z·(i+1), n)``; trailing remainder rows are
    unused.  Output: input columns + ``pos``, ``n_rows``, ``fold``, ``role``, ``train_end``.
    A row appears once per fold it takes part in.
    """
    d = df if windows.POS in df.columns and windows.N_ROWS in df.columns else \
        windows.with_position(df, cols, with_count=True, **kw)
    n = F.col(windows.N_ROWS)
    folds = fold_count(n, n_folds)
    z = (n / (folds + 1)).cast("long")
    d = d.withColumn("_z", z).withColumn(
        FOLD, F.explode(F.when(F.col("_z") > 0, F.sequence(F.lit(1).cast("long"), folds))
                         .otherwise(F.array().cast("array<bigint>"))))
    p, zi = F.col(windows.POS), F.col("_z") * F.col(FOLD)
    role = (F.when(p <= zi, "train")
             .when((p > zi) & (p <= F.least(zi + F.col("_z"), n)), "val"))
    return (d.withColumn(ROLE, role).where(F.col(ROLE).isNotNull())
             .withColumn("train_end", zi)
             .withColumn(FOLD, F.col(FOLD).cast("int")).drop("_z"))
