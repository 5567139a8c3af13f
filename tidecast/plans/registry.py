"""Registry of named queries (Spark plan + optional DuckDB oracle SQL)."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.metrics import round_half_away

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass
class Query:
    name: str
    fn: QueryFn
    sql: str | None
    note: str = ""


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None, note: str = ""):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, note)
        return fn
    return deco


def r4(c: Column | str, digits: int = 4) -> Column:
    """Round to 4 decimals (reporting precision, as the reference's metrics).

    Computed as ``round(x·10^d) / 10^d`` on the double, half away from zero:
    the same IEEE operations as DuckDB's ``round`` so reports are comparable bit
    for bit (rounding the shortest decimal repr differs at binary near-ties).
    """
    return round_half_away(F.col(c) if isinstance(c, str) else c, digits)


def sql_round(expr: str, digits: int = 4) -> str:
    """DuckDB rounding that, like Spark's decimal rounding, never yields -0.0."""
    return f"(round({expr}, {digits}) + 0.0)"


def sql_double(x: float) -> str:
    """A float literal DuckDB reads as the same IEEE double."""
    return f"CAST('{x!r}' AS DOUBLE)"
