"""Feature generation: lags, rolling statistics, calendar parts, Fourier terms.

All groups are column expressions; lags and rolling statistics share one
window (one sort) evaluated by :func:`windows.halo_window`, so a long series is
split across tasks.  Column order of the full set: lags, per window
mean/std/min/max, calendar, sin/cos pairs.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import calendar as cal
from ..schema import DEFAULT_COLS, METADATA, SeriesCols
from . import windows

# Default lag orders, rolling windows, Fourier order and period.
DEFAULT_LAGS = (1, 2, 3, 7, 14, 28)
DEFAULT_WINDOWS = (7, 14, 30, 90)
DEFAULT_FOURIER_ORDER = 5
DEFAULT_FOURIER_PERIOD = 365.25


@dataclass(frozen=True)
class FeatureSpec:
    """What to generate.  An explicit empty tuple means "none of this group"."""

    lags: tuple[int, ...] = DEFAULT_LAGS
    windows: tuple[int, ...] = DEFAULT_WINDOWS
    fourier_order: int = DEFAULT_FOURIER_ORDER
    fourier_period: float = DEFAULT_FOURIER_PERIOD
    calendar: bool = True
    include_current: bool = True  # rolling frame ends at the current row (as the reference)
    exact_scale: int | None = None  # decimal places of the values: exact mean/std moments
    cols: SeriesCols = field(default_factory=SeriesCols)

    @property
    def halo(self) -> int:
        shift = 0 if self.include_current else 1
        back = [k for k in self.lags] + [w - 1 + shift for w in self.windows]
        return max(back, default=0)


def lag_columns(w: WindowSpec, value: str, lags) -> dict[str, Column]:
    return {f"lag_{k}": F.lag(F.col(value), k).over(w) for k in lags}


def rolling_columns(w: WindowSpec, value: str, sizes, include_current: bool = True,
                    exact_scale: int | None = None) -> dict[str, Column]:
    """``rolling_{mean,std,min,max}_w`` over the last w rows (``min_periods=1``).

    With ``exact_scale`` (values carry at most that many decimals, e.g. cents)
    mean and sample std are derived from exact DECIMAL moments
    ``n, Σx, Σx²``: ``std = sqrt((nΣx² − (Σx)²) / (n(n−1)))``.  The result is
    then independent of the order in which rows are added, i.e. of partitioning.
    """
    out: dict[str, Column] = {}
    end = 0 if include_current else -1
    v = F.col(value)
    for n in sizes:
        frame = w.rowsBetween(-(n - 1) + end, end)
        if exact_scale is None:
            mean, std = F.avg(v).over(frame), F.stddev_samp(v).over(frame)
        else:
            x = v.cast(f"decimal(18,{exact_scale})")
            cnt = F.count(v).over(frame)
            s1 = F.sum(x).over(frame)
            s2 = F.sum(x * x).over(frame)
            mean = F.when(cnt > 0, s1.cast("double") / cnt.cast("double"))
            num = (cnt * s2 - s1 * s1).cast("double")
            std = F.when(cnt > 1, F.sqrt(F.greatest(num, F.lit(0.0)) /
                                         (cnt * (cnt - 1)).cast("double")))
        out[f"rolling_mean_{n}"] = mean
        out[f"rolling_std_{n}"] = std
        out[f"rolling_min_{n}"] = F.min(v).over(frame)
        out[f"rolling_max_{n}"] = F.max(v).over(frame)
    return out


def lag_features(df: DataFrame, lags=DEFAULT_LAGS, cols: SeriesCols = DEFAULT_COLS,
                 **kw) -> DataFrame:
    """``lag_k``: value k rows earlier in the same series (row offset, not time)."""
    lags = tuple(lags)
    if not lags:
        return df
    return windows.halo_window(df, lambda w: lag_columns(w, cols.value, lags),
                               max(lags), cols, **kw)


def rolling_features(df: DataFrame, sizes=DEFAULT_WINDOWS, cols: SeriesCols = DEFAULT_COLS,
                     include_current: bool = True, exact_scale: int | None = None,
                     **kw) -> DataFrame:
    sizes = tuple(sizes)
    if not sizes:
        return df
    halo = max(sizes) - 1 + (0 if include_current else 1)
    return windows.halo_window(
        df, lambda w: rolling_columns(w, cols.value, sizes, include_current, exact_scale),
        halo, cols, **kw)


def calendar_features(df: DataFrame, cols: SeriesCols = DEFAULT_COLS) -> DataFrame:
    return df.withColumns(cal.calendar_columns(cols.ts))


def fourier_origin(df: DataFrame, cols: SeriesCols = DEFAULT_COLS) -> Column:
    """Minimum timestamp of the whole frame as a scalar subquery (computed once)."""
    return df.agg(F.min(cols.ts)).scalar()


def fourier_features(df: DataFrame, order: int = DEFAULT_FOURIER_ORDER,
                     period: float = DEFAULT_FOURIER_PERIOD, cols: SeriesCols = DEFAULT_COLS,
                     origin=None) -> DataFrame:
    """``sin_k``/``cos_k`` of days since ``origin`` (default: minimum timestamp of ``df``)."""
    if order <= 0:
        return df
    t0 = fourier_origin(df, cols) if origin is None else (
        origin if isinstance(origin, Column) else F.lit(origin).cast("timestamp_ntz"))
    # The day offset is projected once: a scalar subquery referenced by every sin/cos
    # term would otherwise be planned (and executed) once per term.
    with_days = df.select("*", cal.days_since(cols.ts, t0).alias("_fourier_days"))
    terms = cal.fourier_columns(F.col("_fourier_days"), order, period)
    return with_days.select(*df.columns, *[c.alias(k) for k, c in terms.items()])


def all_features(df: DataFrame, spec: FeatureSpec = FeatureSpec(), drop_na: bool = True,
                 origin=None, **kw) -> DataFrame:
    """Lags → rolling → drop incomplete rows → calendar → Fourier, in one plan.

    Lags and rolling statistics are evaluated in a single window pass.
    """
    c = spec.cols
    lags, sizes = tuple(spec.lags), tuple(spec.windows)

    def build(w: WindowSpec) -> dict[str, Column]:
        out = lag_columns(w, c.value, lags)
        out.update(rolling_columns(w, c.value, sizes, spec.include_current, spec.exact_scale))
        return out

    out = df
    if lags or sizes:
        out = windows.halo_window(df, build, spec.halo, c, **kw)
    # Calendar and Fourier terms are never NULL for a non-NULL timestamp, so incomplete
    # rows are dropped before they are added: the same rows go, and the NULL filter is
    # not pushed through (and does not duplicate) the Fourier origin subquery.
    if drop_na:
        out = drop_incomplete(out)
    if spec.calendar:
        out = calendar_features(out, c)
    if spec.fourier_order > 0:
        t0 = fourier_origin(df, c) if origin is None else origin
        out = fourier_features(out, spec.fourier_order, spec.fourier_period, c, origin=t0)
    return out


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Drop rows with a NULL (or NaN) in any column."""
    return df.na.drop("any")


def feature_columns(df: DataFrame, cols: SeriesCols = DEFAULT_COLS,
                    numeric_only: bool = True) -> list[str]:
    """Generated feature columns in frame order (everything but ts/value/series/metadata).

    Non-numeric pass-through columns are rejected unless ``numeric_only=False``.
    """
    excl = cols.excluded() | {METADATA}
    out = []
    for f in df.schema.fields:
        if f.name in excl:
            continue
        if numeric_only and not isinstance(f.dataType, T.NumericType):
            continue
        out.append(f.name)
    return out


def numeric_feature_columns(df: DataFrame, target: str, cols: SeriesCols = DEFAULT_COLS
                            ) -> list[str]:
    excl = cols.excluded() | {target}
    return [f.name for f in df.schema.fields
            if f.name not in excl and isinstance(f.dataType, T.NumericType)]
