"""Forecast error metrics as aggregate expressions.

Input columns: ``actual``, ``forecast`` and, for directional accuracy, the
previous step's ``actual_prev``/``forecast_prev`` (attached by an equi-join on
``step - 1``, not by a window over the group).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

METRICS = ("rmse", "mae", "mape", "smape", "r2", "directional_accuracy")
INF = float("inf")


def metric_aggs(a: str = "actual", p: str = "forecast", a_prev: str = "actual_prev",
                p_prev: str = "forecast_prev") -> dict[str, Column]:
    """Aggregates producing the six metrics (unrounded) plus ``n``."""
    A, P = F.col(a), F.col(p)
    err = A - P
    n = F.count(F.lit(1))
    ss_res = F.sum(err * err)
    ss_tot = F.var_pop(A) * n
    denom = F.abs(A) + F.abs(P)
    up_a = (A - F.col(a_prev)) > 0
    up_p = (P - F.col(p_prev)) > 0
    has_prev = F.col(a_prev).isNotNull()
    r2 = (F.when(n < 2, F.lit(float("nan")))
           .when(ss_tot == 0, F.when(ss_res == 0, 1.0).otherwise(0.0))
           .otherwise(1.0 - ss_res / ss_tot))
    return {
        "rmse": F.sqrt(F.avg(err * err)),
        "mae": F.avg(F.abs(err)),
        # only rows with a non-zero actual; none → +inf
        "mape": F.coalesce(F.avg(F.when(A != 0, F.abs(err / A))) * 100.0, F.lit(INF)),
        # zero denominator counts as a zero term, the row stays in the mean
        "smape": F.avg(F.when(denom == 0, F.lit(0.0))
                        .otherwise(2.0 * F.abs(err) / denom)) * 100.0,
        "r2": r2,
        # consecutive pairs: up in actual == up in forecast (flat = not up); n ≤ 1 → 0
        "directional_accuracy": F.coalesce(
            F.avg(F.when(has_prev, (up_a == up_p).cast("double"))) * 100.0, F.lit(0.0)),
        "n": n,
    }


def round_half_away(x: Column, digits: int = 4) -> Column:
    """``round(x·10^d)/10^d`` half away from zero (report precision of the metrics)."""
    scale = F.lit(float(10 ** digits))
    return F.round(x * scale) / scale
