"""Registered queries: store scans/writes, stacking, row operators, grid."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import grid, windows
from ..session import scratch_path
from ..sources import store as st
from ..sources import tables
from . import oracle_views as ov
from .registry import register

SCAN_SERIES = "3-MEDIUM"
RANGE = ("1997-01-01 00:00:00", "1997-12-31 00:00:00")
CANON = ["series_id", "timestamp", "value"]


def _store_with(spark, *frames):
    s = st.SeriesStore(spark, scratch_path(spark, "store"), n_buckets=16)
    for f in frames:
        s.append(f)
    return s


@register("canonicalise", sql=(
    "SELECT CAST(event_type AS VARCHAR) AS series_id, CAST(ts AS TIMESTAMP) AS \"timestamp\", "
    "CAST(value AS DOUBLE) AS value, json_extract_string(props, '$.k') AS meta_k FROM events"))
def q_canonicalise(spark, d):
    e = tables.table(spark, d, "events")
    c = st.canonicalise(e, "event_type", "ts", "value", metadata_col="props")
    return c.select(*CANON, F.col("metadata")["k"].alias("meta_k"))


@register("append_rows", sql=ov.with_views(ov.SHIPMENTS) +
          "SELECT series_id, \"timestamp\", value, (SELECT count(*) FROM shipments) AS n_written "
          "FROM shipments")
def q_append_rows(spark, d):
    s = st.SeriesStore(spark, scratch_path(spark, "store"), n_buckets=16)
    n = s.append(tables.shipments_raw(spark, d), series_col="flag", ts_col="ship_day",
                 value_col="qty")
    return s.read().select(*CANON, F.lit(n).cast("long").alias("n_written"))


@register("series_scan", sql=ov.with_views(ov.DAILY_ORDERS) +
          f"SELECT series_id, \"timestamp\", value FROM daily_orders WHERE series_id = '{SCAN_SERIES}'")
def q_series_scan(spark, d):
    s = _store_with(spark, tables.daily_orders(spark, d))
    return s.query_series(SCAN_SERIES).select(*CANON)


@register("range_scan", sql=ov.with_views(ov.DAILY_ORDERS) +
          f"SELECT series_id, \"timestamp\", value FROM daily_orders WHERE series_id = '{SCAN_SERIES}' "
          f"AND \"timestamp\" BETWEEN TIMESTAMP '{RANGE[0]}' AND TIMESTAMP '{RANGE[1]}'")
def q_range_scan(spark, d):
    s = _store_with(spark, tables.daily_orders(spark, d))
    return s.query_range(SCAN_SERIES, *RANGE).select(*CANON)


@register("upsert_last_wins", sql=ov.with_views(ov.DAILY_ORDERS) +
          "SELECT series_id, \"timestamp\", CASE WHEN year(\"timestamp\") = 1998 THEN value * 2 "
          "ELSE value END AS value FROM daily_orders")
def q_upsert_last_wins(spark, d):
    base = tables.daily_orders(spark, d)
    s = _store_with(spark, base)
    s.upsert(base.where(F.year("timestamp") == 1998).withColumn("value", F.col("value") * 2))
    return s.read().select(*CANON)


@register("compact_then_upsert", sql=ov.with_views(ov.DAILY_ORDERS) + """
SELECT series_id, "timestamp", CASE WHEN year("timestamp") = 1997 THEN value * 3 WHEN year("timestamp") > 1997 THEN value * 2 ELSE value END AS value
FROM daily_orders""")
def q_compact_then_upsert(spark, d):
    """Append, update, compact into a base, update again: the base is merged with the newer write only."""
    base = tables.daily_orders(spark, d)
    s = _store_with(spark, base)
    s.upsert(base.where(F.year("timestamp") >= 1997).withColumn("value", F.col("value") * 2))
    s.compact()
    s.vacuum()
    s.upsert(base.where(F.year("timestamp") == 1997).withColumn("value", F.col("value") * 3))
    return s.read().select(*CANON)


@register("stack_series", sql=ov.with_views(ov.DAILY_ORDERS, ov.SHIPMENTS) +
          "SELECT * FROM daily_orders UNION ALL SELECT * FROM shipments")
def q_stack_series(spark, d):
    return st.stack(tables.daily_orders(spark, d), tables.shipments(spark, d))


@register("list_series", sql=ov.with_views(ov.DAILY_ORDERS, ov.SHIPMENTS, ov.MONTHLY_NATION) +
          "SELECT DISTINCT series_id FROM (SELECT series_id FROM daily_orders UNION ALL "
          "SELECT series_id FROM shipments UNION ALL SELECT series_id FROM monthly_nation)")
def q_list_series(spark, d):
    s = _store_with(spark, tables.daily_orders(spark, d), tables.shipments(spark, d),
                    tables.monthly_nation(spark, d))
    return s.list_series()


@register("row_count", sql=ov.with_views(ov.DAILY_ORDERS, ov.SHIPMENTS) +
          "SELECT series_id, count(*) AS n_rows FROM (SELECT * FROM daily_orders UNION ALL "
          "SELECT * FROM shipments) GROUP BY series_id")
def q_row_count(spark, d):
    s = _store_with(spark, tables.daily_orders(spark, d), tables.shipments(spark, d))
    return s.row_count()


@register("last_n_rows", sql=ov.with_views(ov.DAILY_ORDERS) +
          "SELECT series_id, \"timestamp\", value FROM (SELECT *, row_number() OVER "
          "(PARTITION BY series_id ORDER BY \"timestamp\" DESC) AS rn FROM daily_orders) WHERE rn <= 14")
def q_last_n_rows(spark, d):
    return windows.last_n_rows(tables.daily_orders(spark, d), 14)


@register("drop_duplicates", sql=ov.with_views(ov.DAILY_ORDERS) +
          "SELECT DISTINCT series_id, \"timestamp\", value FROM daily_orders")
def q_drop_duplicates(spark, d):
    base = tables.daily_orders(spark, d)
    tail = windows.last_n_rows(base, 90)
    return st.drop_duplicates(st.stack(base, tail))


# ---------------------------------------------------------------- grid

_FREQ_SQL = """,
gaps AS (
  SELECT series_id, "timestamp" AS ts,
         epoch("timestamp") - epoch(lag("timestamp") OVER w) AS gap,
         (year("timestamp") * 12 + month("timestamp")) -
           (year(lag("timestamp") OVER w) * 12 + month(lag("timestamp") OVER w)) AS mdiff,
         day("timestamp") = 1 AND CAST(CAST("timestamp" AS DATE) AS TIMESTAMP) = "timestamp" AS ms,
         CAST("timestamp" AS DATE) = last_day("timestamp")
           AND CAST(CAST("timestamp" AS DATE) AS TIMESTAMP) = "timestamp" AS me
  FROM all_series WINDOW w AS (PARTITION BY series_id ORDER BY "timestamp")),
agg AS (
  SELECT series_id, count(*) AS n_obs, min(gap) AS gmin, max(gap) AS gmax,
         min(mdiff) AS mmin, max(mdiff) AS mmax, bool_and(ms) AS all_ms, bool_and(me) AS all_me
  FROM gaps GROUP BY series_id),
coded AS (
  SELECT series_id, n_obs,
    CASE WHEN n_obs < 3 THEN 'D'
         WHEN (all_ms OR all_me) AND mmin = mmax AND mmin IN (1, 3, 12) THEN
              CASE mmin WHEN 1 THEN CASE WHEN all_ms THEN 'MS' ELSE 'M' END
                        WHEN 3 THEN CASE WHEN all_ms THEN 'QS' ELSE 'Q' END
                        ELSE CASE WHEN all_ms THEN 'AS' ELSE 'A' END END
         WHEN gmin = gmax AND gmin > 0 THEN
              CASE WHEN gmin % 604800 = 0 THEN CASE WHEN gmin = 604800 THEN 'W' ELSE CAST(CAST(gmin / 604800 AS BIGINT) AS VARCHAR) || 'W' END
                   WHEN gmin % 86400 = 0 THEN CASE WHEN gmin = 86400 THEN 'D' ELSE CAST(CAST(gmin / 86400 AS BIGINT) AS VARCHAR) || 'D' END
                   WHEN gmin % 3600 = 0 THEN CASE WHEN gmin = 3600 THEN 'H' ELSE CAST(CAST(gmin / 3600 AS BIGINT) AS VARCHAR) || 'H' END
                   WHEN gmin % 60 = 0 THEN CASE WHEN gmin = 60 THEN 'T' ELSE CAST(CAST(gmin / 60 AS BIGINT) AS VARCHAR) || 'T' END
                   ELSE CASE WHEN gmin = 1 THEN 'S' ELSE CAST(gmin AS VARCHAR) || 'S' END END
         ELSE 'D' END AS freq
  FROM agg)
SELECT series_id, freq,
  CAST(CASE WHEN upper(freq) LIKE 'H%' THEN 24 WHEN upper(freq) LIKE 'D%' THEN 7
            WHEN upper(freq) LIKE 'W%' THEN 52 WHEN upper(freq) IN ('M', 'MS', 'ME') THEN 12
            ELSE 7 END AS INTEGER) AS seasonal_period,
  CAST(n_obs AS BIGINT) AS n_obs
FROM coded"""

_ALL_SERIES = """
all_series AS (
  SELECT * FROM daily_orders UNION ALL SELECT * FROM monthly_nation
  UNION ALL SELECT * FROM hourly_events UNION ALL SELECT * FROM month_regular)"""

# A strictly regular monthly series: the total over all nations per month.
_MONTH_REGULAR = """
month_regular AS (
  SELECT 'all_nations' AS series_id, "timestamp", sum(value) AS value
  FROM monthly_nation GROUP BY 2)"""


def _all_series(spark, d):
    mn = tables.monthly_nation(spark, d)
    regular = (mn.groupBy("timestamp").agg(F.sum("value").alias("value"))
                 .select(F.lit("all_nations").alias("series_id"), "timestamp", "value"))
    return st.stack(tables.daily_orders(spark, d), mn, tables.hourly_events(spark, d), regular)


@register("infer_frequency", sql=ov.with_views(ov.DAILY_ORDERS, ov.MONTHLY_NATION, ov.HOURLY_EVENTS,
                                               _MONTH_REGULAR, _ALL_SERIES).rstrip("\n") + _FREQ_SQL)
def q_infer_frequency(spark, d):
    return grid.infer_frequency(_all_series(spark, d))


@register("regularise_ffill", sql=ov.with_views(ov.MONTHLY_NATION) + """,
bounds AS (SELECT series_id, min("timestamp") AS lo, max("timestamp") AS hi FROM monthly_nation GROUP BY 1),
g AS (SELECT series_id, CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS TIMESTAMP) AS "timestamp" FROM bounds),
j AS (SELECT g.series_id, g."timestamp", m.value FROM g LEFT JOIN monthly_nation m
      ON m.series_id = g.series_id AND m."timestamp" = g."timestamp")
SELECT series_id, "timestamp",
       last_value(value IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY "timestamp"
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value,
       CAST(value IS NULL AS INTEGER) AS filled
FROM j""")
def q_regularise_ffill(spark, d):
    return grid.regularise(tables.monthly_nation(spark, d), "MS", block=12)


@register("regularise_hourly", sql=ov.with_views(ov.HOURLY_EVENTS) + """,
bounds AS (SELECT series_id, min("timestamp") AS lo, max("timestamp") AS hi FROM hourly_events GROUP BY 1),
g AS (SELECT series_id, CAST(unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS TIMESTAMP) AS "timestamp" FROM bounds),
j AS (SELECT g.series_id, g."timestamp", m.value FROM g LEFT JOIN hourly_events m
      ON m.series_id = g.series_id AND m."timestamp" = g."timestamp")
SELECT series_id, "timestamp",
       last_value(value IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY "timestamp"
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value,
       CAST(value IS NULL AS INTEGER) AS filled
FROM j""")
def q_regularise_hourly(spark, d):
    return grid.regularise(tables.hourly_events(spark, d), "H", block=100)


@register("future_spine", sql=ov.with_views(ov.DAILY_ORDERS, ov.MONTHLY_NATION) + """
SELECT series_id, CAST(s.range AS INTEGER) AS step, CAST(last + to_days(CAST(s.range AS INTEGER)) AS TIMESTAMP) AS "timestamp"
FROM (SELECT series_id, max("timestamp") AS last FROM daily_orders GROUP BY 1), range(1, 15) s
UNION ALL
SELECT series_id, CAST(s.range AS INTEGER) AS step, CAST(last + to_months(CAST(s.range AS INTEGER)) AS TIMESTAMP) AS "timestamp"
FROM (SELECT series_id, max("timestamp") AS last FROM monthly_nation GROUP BY 1), range(1, 15) s""")
def q_future_spine(spark, d):
    a = grid.future_spine(tables.daily_orders(spark, d), 14, freq="D")
    b = grid.future_spine(tables.monthly_nation(spark, d), 14, freq="MS")
    return a.unionByName(b)


# ---------------------------------------------------------------- streaming ingest

@register("stream_append", sql=(
    "SELECT CAST(event_type AS VARCHAR) AS series_id, CAST(ts AS TIMESTAMP) AS \"timestamp\", "
    "CAST(value AS DOUBLE) AS value FROM events"))
def q_stream_append(spark, d):
    from ..streaming import ingest
    s = st.SeriesStore(spark, scratch_path(spark, "stream-store"), n_buckets=16)
    schema = tables.table(spark, d, "events").schema
    q = ingest.ingest(spark, d, schema, s, series_col="event_type", ts_col="ts",
                      value_col="value", metadata_col="props", glob="events.parquet")
    q.awaitTermination()
    return s.read().select(*CANON)
