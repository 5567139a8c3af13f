"""Canonical observation schema and column-name bundle."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

SERIES = "series_id"
TS = "timestamp"
VALUE = "value"
METADATA = "metadata"

# Canonical observation table: key ((series_id), timestamp), clustered by time.
OBSERVATION_SCHEMA = T.StructType([
    T.StructField(SERIES, T.StringType(), False),
    T.StructField(TS, T.TimestampNTZType(), False),
    T.StructField(VALUE, T.DoubleType(), True),
    T.StructField(METADATA, T.MapType(T.StringType(), T.StringType()), True),
])


@dataclass(frozen=True)
class SeriesCols:
    """Names of the time, value and series columns of a frame."""

    ts: str = TS
    value: str = VALUE
    series: str = SERIES

    def excluded(self) -> set[str]:
        return {self.ts, self.value, self.series, METADATA}


DEFAULT_COLS = SeriesCols()
