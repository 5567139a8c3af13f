"""Registered queries: hierarchy structure and reconciliation on the geography tree."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import reconcile as rc
from ..sources import tables
from . import oracle_views as ov
from .registry import r4, register, sql_round


def _rec_out(df, digits: int = 4):
    return df.select("node", F.col("step").cast("int").alias("step"),
                     r4("forecast", digits).alias("forecast"))


# ---------------------------------------------------------------- SQL pieces
STRUCT_SQL = """
down(ancestor, node, depth) AS (
  SELECT parent, child, 1 FROM geo_edges
  UNION ALL
  SELECT d.ancestor, x.child, d.depth + 1 FROM down d JOIN geo_edges x ON d.node = x.parent
  WHERE d.depth < 64),
leaves AS (SELECT DISTINCT child AS node FROM geo_edges WHERE child NOT IN (SELECT parent FROM geo_edges)),
roots AS (SELECT DISTINCT parent AS node FROM geo_edges WHERE parent NOT IN (SELECT child FROM geo_edges)),
closure AS (SELECT DISTINCT ancestor, node AS leaf FROM down WHERE node NOT IN (SELECT parent FROM geo_edges)),
S AS (SELECT ancestor AS node, leaf FROM closure UNION SELECT node, node AS leaf FROM leaves)"""


def _with(*views, recursive=True):
    w = ov.with_views(*views)
    return w.replace("WITH ", "WITH RECURSIVE ", 1) if recursive else w


BASE = (ov.GEO_EDGES, ov.LEVELS, ov.BASE_FORECASTS, STRUCT_SQL)

AGG_UP_SQL = """,
up AS (SELECT s.node, lf.step, sum(lf.forecast) AS forecast FROM S s JOIN lf ON s.leaf = lf.leaf GROUP BY 1, 2),
grid AS (SELECT DISTINCT s.node, CAST(r.range AS INTEGER) AS step FROM S s, range(1, (SELECT h FROM hz) + 1) r)
SELECT g.node, g.step, """ + sql_round("coalesce(up.forecast, 0.0)") + """ AS forecast
FROM grid g LEFT JOIN up ON up.node = g.node AND up.step = g.step"""

HZ = "hz AS (SELECT coalesce(min(n), 1) AS h FROM (SELECT node, max(step) AS n FROM bf GROUP BY node))"


def _bf(truncate: bool) -> str:
    if not truncate:
        return "bf AS (SELECT * FROM base_forecasts)"
    return ("bf AS (SELECT * FROM base_forecasts WHERE NOT (node = (SELECT min(node) FROM leaves) "
            "AND step > 9))")


def _truncated(base, edges):
    first_leaf = rc.leaves(edges).agg(F.min("node")).scalar()
    return base.where(~((F.col("node") == first_leaf) & (F.col("step") > 9)))


# ---------------------------------------------------------------- structure

@register("hierarchy_closure", sql=_with(ov.GEO_EDGES, STRUCT_SQL) + "SELECT ancestor, leaf FROM closure")
def q_hierarchy_closure(spark, d):
    return rc.closure(tables.geo_edges(spark, d))


@register("summing_matrix", sql=_with(ov.GEO_EDGES, STRUCT_SQL) + "SELECT node, leaf FROM S")
def q_summing_matrix(spark, d):
    return rc.summing_matrix(tables.geo_edges(spark, d))


@register("hierarchy_order", sql=_with(ov.GEO_EDGES, """
walk(node, path, depth) AS (
  SELECT r.parent, [r.parent], 0 FROM (SELECT DISTINCT parent FROM geo_edges) r
  WHERE r.parent NOT IN (SELECT child FROM geo_edges)
  UNION ALL
  SELECT x.child, list_concat(w.path, [x.child]), w.depth + 1
  FROM walk w JOIN geo_edges x ON w.node = x.parent WHERE w.depth < 64),
p AS (SELECT node, min(path) AS path, CAST(min(depth) AS INTEGER) AS depth FROM walk GROUP BY node),
lv AS (SELECT DISTINCT child AS node FROM geo_edges WHERE child NOT IN (SELECT parent FROM geo_edges))""") + """
SELECT node, CAST(row_number() OVER (ORDER BY is_leaf, CASE WHEN is_leaf THEN [node] ELSE path END) AS INTEGER) AS node_order,
       is_leaf, depth
FROM (SELECT p.*, lv.node IS NOT NULL AS is_leaf FROM p LEFT JOIN lv ON lv.node = p.node)""")
def q_hierarchy_order(spark, d):
    o = rc.node_order(tables.geo_edges(spark, d))
    return o.withColumn("node_order", F.col("node_order").cast("int"))


@register("hierarchy_order_given", sql=_with(ov.GEO_EDGES, """
o AS (SELECT parent, child, CASE WHEN parent = 'total' THEN r_regionkey ELSE n_nationkey END AS ordinal
      FROM geo_edges LEFT JOIN region ON r_name = child LEFT JOIN nation ON n_name = child AND parent <> 'total'),
walk(node, path, depth) AS (
  SELECT r.parent, [{'ordinal': CAST(0 AS BIGINT), 'node': r.parent}], 0 FROM (SELECT DISTINCT parent FROM o) r WHERE r.parent NOT IN (SELECT child FROM o)
  UNION ALL
  SELECT x.child, list_concat(w.path, [{'ordinal': CAST(-x.ordinal AS BIGINT), 'node': x.child}]), w.depth + 1
  FROM walk w JOIN o x ON w.node = x.parent WHERE w.depth < 64),
lv AS (SELECT DISTINCT child AS node FROM geo_edges WHERE child NOT IN (SELECT parent FROM geo_edges))""") + """
SELECT node, CAST(row_number() OVER (ORDER BY is_leaf, CASE WHEN is_leaf THEN [{'ordinal': CAST(0 AS BIGINT), 'node': node}] ELSE path END) AS INTEGER) AS node_order,
       is_leaf, CAST(depth AS INTEGER) AS depth
FROM (SELECT walk.*, lv.node IS NOT NULL AS is_leaf FROM walk LEFT JOIN lv ON lv.node = walk.node)""")
def q_hierarchy_order_given(spark, d):
    """Siblings in the given order: regions and nations by descending key."""
    e = tables.geo_edges(spark, d)
    keys = tables.table(spark, d, "region").select(F.col("r_name").alias("child"), F.lit("total").alias("parent"), (-F.col("r_regionkey")).alias("ordinal")).unionByName(
        tables.table(spark, d, "nation").join(tables.table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(
            F.col("n_name").alias("child"), F.col("r_name").alias("parent"), (-F.col("n_nationkey")).alias("ordinal")))
    o = rc.node_order(e.join(keys, ["parent", "child"]))
    return o.withColumn("node_order", F.col("node_order").cast("int"))


# ---------------------------------------------------------------- reconciliation

@register("bottom_up", sql=_with(*BASE) + ",\n" + _bf(False) + ",\n" + HZ + """,
lf AS (SELECT b.node AS leaf, b.step, b.forecast FROM bf b JOIN leaves l ON b.node = l.node
       WHERE b.step <= (SELECT h FROM hz))""" + AGG_UP_SQL)
def q_bottom_up(spark, d):
    e = tables.geo_edges(spark, d)
    return _rec_out(rc.bottom_up(e, tables.base_forecasts(spark, d)))


_TD_SQL = """,
rf AS (SELECT r.node AS root, CAST(g.range AS INTEGER) AS step, coalesce(b.forecast, 0.0) AS rf
       FROM roots r CROSS JOIN range(1, (SELECT h FROM hz) + 1) g
       LEFT JOIN bf b ON b.node = r.node AND b.step = g.range),
np AS (SELECT l.node, coalesce(p.proportion, 1.0 / (SELECT count(*) FROM leaves)) AS proportion
       FROM leaves l LEFT JOIN props p ON p.node = l.node),
lf AS (SELECT s.leaf, rf.step, rf.rf * np.proportion AS forecast
       FROM S s JOIN roots r ON s.node = r.node JOIN rf ON rf.root = r.node JOIN np ON np.node = s.leaf)"""

_HIST_PROPS = """,
props AS (SELECT node, CAST(a AS DOUBLE) / CAST((SELECT sum(a) FROM (SELECT node, sum(amount) AS a FROM levels
          WHERE level = 'nation' GROUP BY node)) AS DOUBLE) AS proportion
          FROM (SELECT node, sum(amount) AS a FROM levels WHERE level = 'nation' GROUP BY node))"""

_DERIVED_PROPS = """,
pm AS (SELECT l.node, coalesce(m.m, 1.0) AS m FROM leaves l
       LEFT JOIN (SELECT node, avg(abs(forecast)) AS m FROM bf GROUP BY node) m ON m.node = l.node),
props AS (SELECT node, m / (SELECT CASE WHEN sum(m) = 0 THEN 1.0 ELSE sum(m) END FROM pm) AS proportion FROM pm)"""


@register("top_down_given", sql=_with(*BASE) + ",\n" + _bf(False) + ",\n" + HZ + _HIST_PROPS
          + _TD_SQL + AGG_UP_SQL)
def q_top_down_given(spark, d):
    e = tables.geo_edges(spark, d)
    props = tables.historical_proportions(spark, d)
    return _rec_out(rc.top_down(e, tables.base_forecasts(spark, d), props))


@register("top_down_derived", sql=_with(*BASE) + ",\n" + _bf(True) + ",\n" + HZ + _DERIVED_PROPS
          + _TD_SQL + AGG_UP_SQL)
def q_top_down_derived(spark, d):
    e = tables.geo_edges(spark, d)
    base = _truncated(tables.base_forecasts(spark, d), e)
    return _rec_out(rc.top_down(e, base))


@register("residual_covariance", sql=_with(ov.LEVELS, ov.BASE_RESIDUALS, recursive=False) + """,
x AS (SELECT a.node AS node_i, b.node AS node_j, CAST(a.residual AS DECIMAL(38,2)) AS x,
             CAST(b.residual AS DECIMAL(38,2)) AS y FROM base_residuals a JOIN base_residuals b ON a.t = b.t),
m AS (SELECT node_i, node_j, count(*) AS n, sum(x) AS sx, sum(y) AS sy, sum(x * y) AS sxy FROM x GROUP BY 1, 2)
SELECT node_i, node_j, """ + sql_round(
    "CASE WHEN n > 1 THEN CAST(n * sxy - sx * sy AS DOUBLE) / CAST(n * (n - 1) AS DOUBLE) END") + """ AS cov
FROM m""")
def q_residual_covariance(spark, d):
    c = rc.residual_covariance(tables.base_residuals(spark, d), exact_scale=2)
    return c.select("node_i", "node_j", r4("cov").alias("cov"))


@register("residual_covariance_siblings", sql=_with(ov.GEO_EDGES, ov.LEVELS, ov.BASE_RESIDUALS, recursive=False) + """,
pairs AS (SELECT a.child AS node_i, b.child AS node_j FROM geo_edges a JOIN geo_edges b ON a.parent = b.parent AND a.child <= b.child
          UNION SELECT parent, parent FROM geo_edges),
x AS (SELECT p.node_i, p.node_j, CAST(a.residual AS DECIMAL(38,2)) AS x, CAST(b.residual AS DECIMAL(38,2)) AS y
      FROM pairs p JOIN base_residuals a ON a.node = p.node_i JOIN base_residuals b ON b.node = p.node_j AND a.t = b.t),
m AS (SELECT node_i, node_j, count(*) AS n, sum(x) AS sx, sum(y) AS sy, sum(x * y) AS sxy FROM x GROUP BY 1, 2)
SELECT node_i, node_j, """ + sql_round(
    "CASE WHEN n > 1 THEN CAST(n * sxy - sx * sy AS DOUBLE) / CAST(n * (n - 1) AS DOUBLE) END") + """ AS cov
FROM m""")
def q_residual_covariance_siblings(spark, d):
    pairs = rc.sibling_pairs(tables.geo_edges(spark, d))
    c = rc.residual_covariance(tables.base_residuals(spark, d), exact_scale=2, pairs=pairs)
    return c.select("node_i", "node_j", r4("cov").alias("cov"))


def _two_level_sql(weights: str) -> str:
    if weights == "ols":
        w = "w AS (SELECT node, 1.0 AS w FROM nodes)"
    else:
        w = """w AS (SELECT node, CASE WHEN n > 1 THEN CAST(n * ss - s * s AS DOUBLE) / CAST(n * (n - 1) AS DOUBLE) END
                        + CAST('1e-08' AS DOUBLE) AS w
             FROM (SELECT node, count(*) AS n, sum(CAST(residual AS DECIMAL(38,2))) AS s,
                          sum(CAST(residual AS DECIMAL(38,2)) * CAST(residual AS DECIMAL(38,2))) AS ss
                   FROM base_residuals GROUP BY node))"""
    return (_with(ov.GEO_EDGES, ov.LEVELS, ov.BASE_FORECASTS, ov.BASE_RESIDUALS, recursive=False)
            + f""",
e AS (SELECT DISTINCT parent AS root, child AS node FROM geo_edges WHERE parent <> 'total'),
nodes AS (SELECT root AS node FROM e UNION SELECT node FROM e),
bf AS (SELECT * FROM base_forecasts),
{HZ},
{w},
b AS (SELECT n.node, CAST(g.range AS INTEGER) AS step, coalesce(f.forecast, 0.0) AS f,
             coalesce(w.w, 1.0) AS w
      FROM nodes n CROSS JOIN range(1, (SELECT h FROM hz) + 1) g
      LEFT JOIN bf f ON f.node = n.node AND f.step = g.range LEFT JOIN w ON w.node = n.node),
leaf AS (SELECT e.root, b.* FROM e JOIN b ON b.node = e.node),
agg AS (SELECT root, step, CAST(sum(CAST(f AS DECIMAL(20,4))) AS DOUBLE) AS sb, sum(w) AS sw
        FROM leaf GROUP BY 1, 2),
adj AS (SELECT a.root, a.step, (r.f - a.sb) / (r.w + a.sw) AS k
        FROM agg a JOIN b r ON r.node = a.root AND r.step = a.step),
rl AS (SELECT l.root, l.node, l.step, l.f + l.w * adj.k AS forecast
       FROM leaf l JOIN adj ON adj.root = l.root AND adj.step = l.step),
rec AS (SELECT node, step, forecast FROM rl
        UNION ALL SELECT root AS node, step, sum(forecast) AS forecast FROM rl GROUP BY root, step)
""")


REC_OUT = f"SELECT node, step, {sql_round('forecast')} AS forecast FROM rec"
# OLS divides by (children + 1): exact ties at 4 decimals, none at 6.
REC_OUT6 = f"SELECT node, step, {sql_round('forecast', 6)} AS forecast FROM rec"


@register("mint_ols_two_level", sql=_two_level_sql("ols") + REC_OUT6)
def q_mint_ols_two_level(spark, d):
    e = tables.region_edges(spark, d)
    return _rec_out(rc.mint_two_level(e, tables.base_forecasts(spark, d), weights="ols",
                                      exact_scale=2), digits=6)


@register("mint_diag_two_level", sql=_two_level_sql("diag") + REC_OUT)
def q_mint_diag_two_level(spark, d):
    e = tables.region_edges(spark, d)
    return _rec_out(rc.mint_two_level(e, tables.base_forecasts(spark, d),
                                      tables.base_residuals(spark, d), weights="diag",
                                      exact_scale=2))


def _mint_sql(cov: str) -> str:
    """The normal equations of the constraints, solved directly by elimination over nested lists."""
    weight, alpha = {"shrink": ("0.5 * v.var", "0.5"), "sample": ("CAST('1e-08' AS DOUBLE)", "1.0")}[cov]
    return _with(*BASE, ov.BASE_RESIDUALS) + f""",
bf AS (SELECT * FROM base_forecasts),
{HZ},
nodes AS (SELECT DISTINCT node FROM S),
y AS (SELECT n.node, CAST(g.range AS INTEGER) AS step, coalesce(f.forecast, 0.0) AS f
      FROM nodes n CROSS JOIN range(1, (SELECT h FROM hz) + 1) g LEFT JOIN bf f ON f.node = n.node AND f.step = g.range),
C AS (SELECT DISTINCT parent AS p, parent AS node, 1 AS c FROM geo_edges UNION ALL SELECT parent, child, -1 FROM geo_edges),
rr AS (SELECT n.node, g.range AS t, coalesce(b.residual, 0.0) AS r
       FROM nodes n CROSS JOIN range(1, (SELECT max(t) FROM base_residuals) + 1) g
       LEFT JOIN base_residuals b ON b.node = n.node AND b.t = g.range),
v AS (SELECT node, avg(r) AS mean, var_samp(r) AS var FROM rr GROUP BY node),
w AS (SELECT v.node, {weight} AS w FROM v),
a AS (SELECT {alpha} / (max(t) - 1) AS a FROM rr),
ue AS (SELECT p, t, CAST(sum(c * CAST(r AS DECIMAL(18,2))) AS DOUBLE) AS u FROM C JOIN rr ON rr.node = C.node GROUP BY p, t),
u AS (SELECT p, t, u - avg(u) OVER (PARTITION BY p) AS u FROM ue),
num AS (SELECT p, row_number() OVER (ORDER BY p) AS i FROM (SELECT DISTINCT p FROM C)),
K AS (SELECT p, q, sum(k) AS k FROM (
        SELECT a.p, b.p AS q, sum(a.c * b.c * w.w) AS k FROM C a JOIN C b ON a.node = b.node JOIN w ON w.node = a.node GROUP BY 1, 2
        UNION ALL SELECT a.p, b.p, (SELECT a FROM a) * sum(a.u * b.u) FROM u a JOIN u b ON a.t = b.t GROUP BY 1, 2) GROUP BY p, q),
g AS (SELECT C.p, y.step, sum(c * f) AS g FROM C JOIN y ON y.node = C.node GROUP BY 1, 2),
cells AS (SELECT a.i, b.i AS j, coalesce(K.k, 0.0) AS x FROM num a CROSS JOIN num b LEFT JOIN K ON K.p = a.p AND K.q = b.p
          UNION ALL SELECT num.i, (SELECT count(*) FROM num) + g.step, g.g FROM g JOIN num ON num.p = g.p),
rows_ AS (SELECT i, list(x ORDER BY j) AS x FROM cells GROUP BY i),
gauss(k, m) AS (
  SELECT 0, list(x ORDER BY i) FROM rows_
  UNION ALL
  SELECT k + 1, [CASE WHEN i = k + 1 THEN pr ELSE [m[i][j] - m[i][k + 1] * pr[j] FOR j IN range(1, len(pr) + 1)] END FOR i IN range(1, len(m) + 1)]
  FROM (SELECT k, m, [x / m[k + 1][k + 1] FOR x IN m[k + 1]] AS pr FROM gauss WHERE k < len(m))),
l AS (SELECT num.p, h.range AS step, m[num.i][len(m) + h.range] AS l
      FROM gauss CROSS JOIN num CROSS JOIN range(1, (SELECT h FROM hz) + 1) h WHERE k = len(m)),
z AS (SELECT C.node, l.step, sum(c * l) AS z FROM C JOIN l ON l.p = C.p GROUP BY 1, 2),
st AS (SELECT u.t, l.step, sum(u * l) AS s FROM u JOIN l ON l.p = u.p GROUP BY 1, 2),
com AS (SELECT rr.node, st.step, (SELECT a FROM a) * sum((r - mean) * s) AS x
        FROM rr JOIN v ON v.node = rr.node JOIN st ON st.t = rr.t GROUP BY 1, 2),
lf AS (SELECT y.node, y.step, f - w * z - x AS forecast FROM y JOIN leaves USING (node) JOIN w USING (node) JOIN z USING (node, step) JOIN com USING (node, step)),
rec AS (SELECT S.node, step, sum(forecast) AS forecast FROM S JOIN lf ON lf.node = S.leaf GROUP BY 1, 2)
"""


REC_OUT2 = f"SELECT node, step, {sql_round('forecast', 2)} AS forecast FROM rec"


@register("mint_shrink", sql=_mint_sql("shrink") + REC_OUT2)
def q_mint_shrink(spark, d):
    e = tables.geo_edges(spark, d)
    rec = rc.mint(e, tables.base_forecasts(spark, d), tables.base_residuals(spark, d), cov="shrink")
    return _rec_out(rec, 2)


@register("mint_sample", sql=_mint_sql("sample") + REC_OUT2)
def q_mint_sample(spark, d):
    e = tables.geo_edges(spark, d)
    rec = rc.mint(e, tables.base_forecasts(spark, d), tables.base_residuals(spark, d), cov="sample")
    return _rec_out(rec, 2)


@register("clamp_non_negative", sql=_with(ov.GEO_EDGES, ov.LEVELS, ov.BASE_RESIDUALS, STRUCT_SQL)
          + """,
bf AS (SELECT node, t AS step, residual AS forecast FROM base_residuals),
""" + HZ + """,
lf AS (SELECT b.node AS leaf, b.step, b.forecast FROM bf b JOIN leaves l ON b.node = l.node
       WHERE b.step <= (SELECT h FROM hz)),
up AS (SELECT s.node, lf.step, sum(lf.forecast) AS forecast FROM S s JOIN lf ON s.leaf = lf.leaf GROUP BY 1, 2),
grid AS (SELECT DISTINCT s.node, CAST(r.range AS INTEGER) AS step FROM S s, range(1, (SELECT h FROM hz) + 1) r)
SELECT g.node, g.step, """ + sql_round("greatest(coalesce(up.forecast, 0.0), 0.0)") + """ AS forecast
FROM grid g LEFT JOIN up ON up.node = g.node AND up.step = g.step""")
def q_clamp_non_negative(spark, d):
    e = tables.geo_edges(spark, d)
    res = tables.base_residuals(spark, d).select("node", F.col("t").alias("step"),
                                                  F.col("residual").alias("forecast"))
    return _rec_out(rc.clamp_non_negative(rc.bottom_up(e, res)))


@register("coherence_check", sql=_two_level_sql("ols") + f"""
SELECT p.node, {sql_round('max(abs(c.s - p.forecast))')} AS max_abs_gap
FROM (SELECT e.root AS node, r.step, sum(r.forecast) AS s FROM e JOIN rec r ON r.node = e.node
      GROUP BY 1, 2) c
JOIN rec p ON p.node = c.node AND p.step = c.step GROUP BY p.node""")
def q_coherence_check(spark, d):
    e = tables.region_edges(spark, d)
    rec = rc.mint_two_level(e, tables.base_forecasts(spark, d), weights="ols", exact_scale=2)
    return rc.coherence(e, rec).select("node", r4("max_abs_gap").alias("max_abs_gap"))


@register("reconcile_dispatch", sql=_mint_sql("shrink") + f"SELECT node, step, {sql_round('greatest(forecast, 0.0)', 2)} AS forecast FROM rec")
def q_reconcile_dispatch(spark, d):
    e = tables.geo_edges(spark, d)
    rec = rc.reconcile(e, tables.base_forecasts(spark, d), tables.base_residuals(spark, d),
                       method="mint", non_negative=True)
    return _rec_out(rec, 2)
