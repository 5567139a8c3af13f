"""SQL text of the series views, for the DuckDB oracle.

These mirror :mod:`tidecast.sources.tables` and are used only to build the
independent oracle SQL that checks the Spark plans.
"""

from __future__ import annotations

DAILY_ORDERS = """
daily_orders AS (
  SELECT o_orderpriority AS series_id,
         CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS "timestamp",
         CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value
  FROM orders GROUP BY 1, 2)"""

MONTHLY_NATION = """
monthly_nation AS (
  SELECT n_name AS series_id,
         CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS "timestamp",
         CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value
  FROM orders JOIN customer ON o_custkey = c_custkey
              JOIN nation ON c_nationkey = n_nationkey
  GROUP BY 1, 2)"""

HOURLY_EVENTS = """
hourly_events AS (
  SELECT event_type AS series_id,
         CAST(date_trunc('hour', ts) AS TIMESTAMP) AS "timestamp",
         CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value
  FROM events GROUP BY 1, 2)"""

SHIPMENTS = """
shipments AS (
  SELECT l_returnflag AS series_id,
         CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS "timestamp",
         CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS value
  FROM lineitem GROUP BY 1, 2)"""

GEO_EDGES = """
geo_edges AS (
  SELECT 'total' AS parent, r_name AS child FROM region
  UNION ALL
  SELECT r_name AS parent, n_name AS child
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

# Monthly revenue of every hierarchy node as exact decimals.
LEVELS = """
leaf_m AS (
  SELECT n_name, n_regionkey,
         CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS ts,
         SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS amount
  FROM orders JOIN customer ON o_custkey = c_custkey
              JOIN nation ON c_nationkey = n_nationkey
  GROUP BY 1, 2, 3),
levels AS (
  SELECT n_name AS node, 'nation' AS level, ts, amount FROM leaf_m
  UNION ALL
  SELECT r_name AS node, 'region' AS level, ts, SUM(amount) AS amount
  FROM leaf_m JOIN region ON n_regionkey = r_regionkey GROUP BY r_name, ts
  UNION ALL
  SELECT 'total' AS node, 'total' AS level, ts, SUM(amount) AS amount
  FROM leaf_m GROUP BY ts)"""

BASE_FORECASTS = """
base_forecasts AS (
  SELECT g.node, g.step,
         CAST(COALESCE(l.amount, CAST(0 AS DECIMAL(18,2))) *
              CASE g.level WHEN 'total' THEN CAST('1.05' AS DECIMAL(3,2))
                           WHEN 'region' THEN CAST('0.95' AS DECIMAL(3,2))
                           ELSE CAST('1.00' AS DECIMAL(3,2)) END AS DOUBLE) AS forecast
  FROM (SELECT DISTINCT node, level FROM levels) n
  CROSS JOIN (SELECT CAST(range AS INTEGER) AS step FROM range(1, 13)) s
  CROSS JOIN (SELECT max(ts) AS t_last FROM levels) m
  CROSS JOIN LATERAL (SELECT n.node, n.level, s.step,
                              CAST(m.t_last + to_months(s.step - 12) AS TIMESTAMP) AS ts) g
  LEFT JOIN levels l ON l.node = g.node AND l.ts = g.ts)"""

BASE_RESIDUALS = """
base_residuals AS (
  SELECT g.node, g.t,
         CAST(COALESCE(c.amount, CAST(0 AS DECIMAL(18,2))) -
              COALESCE(p.amount, CAST(0 AS DECIMAL(18,2))) AS DOUBLE) AS residual
  FROM (SELECT n.node, CAST(r.range AS INTEGER) AS t,
               CAST(m.t_last + to_months(CAST(r.range - m.n AS INTEGER)) AS TIMESTAMP) AS mm
        FROM (SELECT DISTINCT node FROM levels) n
        CROSS JOIN (SELECT max(ts) AS t_last, date_diff('month', min(ts), max(ts)) - 11 AS n FROM levels) m
        CROSS JOIN LATERAL (SELECT unnest(range(1, m.n + 1)) AS range) r) g
  LEFT JOIN levels c ON c.node = g.node AND c.ts = g.mm
  LEFT JOIN levels p ON p.node = g.node AND p.ts = CAST(g.mm - to_months(12) AS TIMESTAMP))"""


def with_views(*views: str) -> str:
    """``WITH`` clause from view snippets (list dependencies first)."""
    return "WITH " + ",\n".join(v.strip() for v in views) + "\n"
