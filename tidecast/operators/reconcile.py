"""Hierarchical forecast reconciliation.

Inputs are long frames: hierarchy edges ``(parent, child)``, base forecasts
``(node, step, forecast)`` and in-sample residuals ``(node, t, residual)``.

* Structure (closure, leaves, roots, order, summing matrix S as ``(node, leaf)``)
  comes from joining the known pairs with themselves until nothing changes.
* Bottom-up / top-down are joins with S plus ``groupBy(node, step)``.
* MinT for a forest of two-level trees (a root over leaves) with a diagonal W has a closed form that is
  evaluated as plain aggregations:
  ``b̃_j = b̂_j + w_j / (w_root + Σ_i w_i) · (ŷ_root − Σ_i b̂_i)``.
* MinT for any hierarchy moves the base forecasts onto the constraints ``C y = 0`` ("a parent is the sum of its
  children"): ``ỹ = ŷ − W Cᵀ (C W Cᵀ)⁻¹ C ŷ``.  The multipliers come from preconditioned conjugate gradients.  W is a diagonal
  plus the residual matrix times its transpose and is never formed: a product with C, with W or with the residuals is a
  join and a ``groupBy``; only a few sums for each forecast step reach the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, discard, written
from . import windows

METHODS = ("bottom_up", "top_down", "mint")
COV_METHODS = ("ols", "shrink", "sample", "diag")
SHRINK_ALPHA = 0.5  # fixed shrinkage toward the diagonal
DIAG_EPS = 1e-8
#: Variances below this share of the largest count as none, as in a pseudo-inverse.
VARIANCE_CUT = 1e-15
#: Conjugate gradients: share of the first residual at which a step is solved, the share that must be reached where
#: rounding stops the descent, and the rounds without half the residual that show it (below and above that share).
SOLVED, ACCEPTED, PATIENCE, MAX_ROUNDS = 1e-13, 1e-8, (5, 200), 2000
#: Forecast steps that are solved together, each in a column of its own.
STEP_BLOCK = 12


def materialise(df: DataFrame) -> DataFrame:
    """Write a hierarchy-sized input once (reliable checkpoint in the shared folder).

    Base forecasts, residuals and S are read by several branches and scalar
    subqueries of one reconciliation; materialising them keeps their upstream
    plan (e.g. a join over the fact table) from being evaluated once per reference.
    """
    return cut_lineage(df)


# ---------------------------------------------------------------- structure
def leaves(edges: DataFrame) -> DataFrame:
    """Bottom series: children that are never parents (``node``)."""
    ch = edges.select(F.col("child").alias("node")).distinct()
    return ch.join(edges.select(F.col("parent").alias("node")), "node", "left_anti")


def roots(edges: DataFrame) -> DataFrame:
    """Top series: parents that are never children (``node``)."""
    pa = edges.select(F.col("parent").alias("node")).distinct()
    return pa.join(edges.select(F.col("child").alias("node")), "node", "left_anti")


def _descend(edges: DataFrame, paths: bool = False) -> DataFrame:
    """``(ancestor, node)``: every node below every parent, at any depth.

    Known pairs are joined with themselves until nothing changes, which doubles the depth
    reached by each round.  ``paths`` adds the first path below the ancestor (siblings by ``ordinal``, where the
    edges have one, then by name) and the least depth.  A cycle is an error.
    """
    now = edges.select(F.col("parent").alias("ancestor"), F.col("child").alias("node")).distinct()
    if paths:
        place = F.col("ordinal").cast("long") if "ordinal" in edges.columns else F.lit(0).cast("long")
        now = edges.groupBy(F.col("parent").alias("ancestor"), F.col("child").alias("node")).agg(
            F.min(F.array(F.struct(place.alias("ordinal"), F.col("child").alias("node")))).alias("path")).withColumn("depth", F.lit(1))
    mark = None
    while True:
        now = materialise(now)
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*now.columns).cast("decimal(38,0)")),
                        F.max(F.when(F.col("ancestor") == F.col("node"), F.col("node")))).first()
        if state[2] is not None:
            raise ValueError(f"hierarchy has a cycle through {state[2]!r}")
        if state == mark:
            return now
        mark = state
        upper = now.withColumnsRenamed({"node": "_mid", "path": "_path", "depth": "_depth"})
        far = upper.join(now.withColumnRenamed("ancestor", "_mid"), "_mid")
        if paths:
            far = far.select("ancestor", "node", F.concat("_path", "path").alias("path"),
                             (F.col("_depth") + F.col("depth")).alias("depth"))
            now = now.unionByName(far).groupBy("ancestor", "node").agg(
                F.min("path").alias("path"), F.min("depth").alias("depth"))
        else:
            now = now.unionByName(far.select("ancestor", "node")).distinct()


def closure(edges: DataFrame) -> DataFrame:
    """``(ancestor, leaf)``: every bottom series below every parent, however deep."""
    parents = edges.select(F.col("parent").alias("node")).distinct()
    return (_descend(edges).join(parents, "node", "left_anti")
            .select("ancestor", F.col("node").alias("leaf")))


def summing_matrix(edges: DataFrame) -> DataFrame:
    """S as ``(node, leaf)`` pairs (coefficient 1): closure ∪ each leaf to itself."""
    c = closure(edges).select(F.col("ancestor").alias("node"), "leaf")
    own = leaves(edges).select("node", F.col("node").alias("leaf"))
    return c.unionByName(own).distinct()


def node_order(edges: DataFrame) -> DataFrame:
    """``(node, node_order, is_leaf, depth)``: parents in depth-first pre-order, then leaves alphabetically.

    Roots are alphabetical; siblings follow the ``ordinal`` of their edge where ``edges`` has that column, else their names.
    A node below several parents stands at its first path.  The numbering is by range partitions of the paths.
    """
    own = F.struct(F.lit(0).cast("long").alias("ordinal"), F.col("node").alias("node"))
    top = roots(edges)
    below = (_descend(edges, paths=True).join(top.select(F.col("node").alias("ancestor")), "ancestor")
             .select("node", F.concat(F.array(F.struct(F.lit(0).cast("long").alias("ordinal"), F.col("ancestor").alias("node"))), "path").alias("path"), "depth"))
    start = top.select("node", F.array(own).alias("path"), F.lit(0).alias("depth"))
    paths = start.unionByName(below).groupBy("node").agg(F.min("path").alias("path"),
                                                         F.min("depth").alias("depth"))
    lv = leaves(edges).withColumn("is_leaf", F.lit(True))
    p = (paths.join(lv, "node", "left")
              .withColumn("is_leaf", F.coalesce("is_leaf", F.lit(False))))
    key = F.when(F.col("is_leaf"), F.array(own)).otherwise(F.col("path"))
    placed = windows.numbered(p.select("node", "is_leaf", F.col("depth").cast("int").alias("depth"), key.alias("_key")),
                              [F.col("is_leaf"), F.col("_key")], "node_order")
    return placed.select("node", "node_order", "is_leaf", "depth")


# ---------------------------------------------------------------- helpers
def common_horizon(base: DataFrame) -> F.Column:
    """Minimum forecast length over the nodes that have one (scalar subquery; none → 1)."""
    h = base.groupBy("node").agg(F.max("step").alias("_n")).agg(F.min("_n")).scalar()
    return F.coalesce(h, F.lit(1))


def _grid(nodes: DataFrame, h: F.Column) -> DataFrame:
    return nodes.select("node").distinct().withColumn("step", F.explode(F.sequence(F.lit(1), h)))


def _aggregate_up(s: DataFrame, leaf_fc: DataFrame, h: F.Column) -> DataFrame:
    """Every node of S = sum of its leaves' forecasts; missing leaves count 0."""
    lf = leaf_fc.select(F.col("node").alias("leaf"), "step", "forecast")
    up = s.join(lf, "leaf").groupBy("node", "step").agg(F.sum("forecast").alias("forecast"))
    return (_grid(s, h).join(up, ["node", "step"], "left")
            .select("node", "step", F.coalesce("forecast", F.lit(0.0)).alias("forecast")))


# ---------------------------------------------------------------- methods
def bottom_up(edges: DataFrame, base: DataFrame, s: DataFrame | None = None) -> DataFrame:
    """Leaves keep their forecasts; every parent is the sum of its leaves."""
    s = materialise(summing_matrix(edges)) if s is None else s
    base = materialise(base)
    h = common_horizon(base)
    lf = base.join(leaves(edges), "node").where(F.col("step") <= h)
    return _aggregate_up(s, lf, h)


def derived_proportions(edges: DataFrame, base: DataFrame) -> DataFrame:
    """``(node, proportion)`` of every leaf: mean |forecast| over its full horizon
    (a leaf without forecasts counts 1.0) divided by the total (0 → 1)."""
    lv = leaves(edges)
    m = base.groupBy("node").agg(F.avg(F.abs("forecast")).alias("_m"))
    per = lv.join(m, "node", "left").select("node", F.coalesce("_m", F.lit(1.0)).alias("_m"))
    total = per.agg(F.sum("_m")).scalar()
    tot = F.when(total == 0, F.lit(1.0)).otherwise(total)
    return per.select("node", (F.col("_m") / tot).alias("proportion"))


def top_down(edges: DataFrame, base: DataFrame, proportions: DataFrame | None = None,
             s: DataFrame | None = None) -> DataFrame:
    """Each root's forecast is split over its own leaves by proportion, then summed up.

    Missing root forecast → 0; a leaf without a given proportion → ``1/n_leaves``.
    """
    s = materialise(summing_matrix(edges)) if s is None else s
    base = materialise(base)
    h = common_horizon(base)
    lv = leaves(edges)
    if proportions is None:
        proportions = derived_proportions(edges, base)
    proportions = materialise(proportions)
    n_leaves = lv.agg(F.count(F.lit(1))).scalar()
    props = (lv.join(proportions.select("node", "proportion"), "node", "left")
               .select("node", F.coalesce("proportion", F.lit(1.0) / n_leaves).alias("proportion")))
    rt = roots(edges)
    root_fc = (_grid(rt, h).join(base, ["node", "step"], "left")
               .select(F.col("node").alias("root"), "step",
                       F.coalesce("forecast", F.lit(0.0)).alias("_rf")))
    root_leaf = s.join(rt.select(F.col("node").alias("root")), F.col("node") == F.col("root"))
    leaf_fc = (root_leaf.select("root", "leaf").join(root_fc, "root")
               .join(props, F.col("leaf") == props.node)
               .select(F.col("leaf").alias("node"), "step",
                       (F.col("_rf") * F.col("proportion")).alias("forecast")))
    return _aggregate_up(s, leaf_fc, h)


# ---------------------------------------------------------------- covariance
def dense_residuals(nodes: DataFrame, residuals: DataFrame) -> DataFrame:
    """Residual vectors zero-padded to the longest one: ``(node, t, residual)``."""
    t_max = residuals.agg(F.max("t")).scalar()
    grid = nodes.select("node").distinct().withColumn("t", F.explode(F.sequence(F.lit(1), t_max)))
    return (grid.join(residuals.select("node", "t", "residual"), ["node", "t"], "left")
                .select("node", "t", F.coalesce("residual", F.lit(0.0)).alias("residual")))


def sibling_pairs(edges: DataFrame) -> DataFrame:
    """``(node_i, node_j)``: nodes of one parent, each pair once and every node with itself."""
    e = edges.select("parent", "child").distinct()
    pairs = e.withColumnRenamed("child", "node_i").join(e.withColumnRenamed("child", "node_j"), "parent").where("node_i <= node_j")
    own = _all_nodes(edges).select(F.col("node").alias("node_i"), F.col("node").alias("node_j"))
    return pairs.select("node_i", "node_j").unionByName(own).distinct()


def _all_nodes(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("parent").alias("node")).unionByName(edges.select(F.col("child").alias("node"))).distinct()


def residual_covariance(residuals: DataFrame, exact_scale: int | None = None, pairs: DataFrame | None = None) -> DataFrame:
    """Sample covariance ``(node_i, node_j, cov)`` of residual vectors.

    ``pairs (node_i, node_j)`` names the pairs that are wanted, e.g. :func:`sibling_pairs`: only their rows are joined.  Without
    it all pairs are returned (a self-join on t, as large as the square of the nodes).
    ``exact_scale``: residuals carry that many decimals; moments are exact
    DECIMAL sums so the result does not depend on evaluation order.
    """
    a = residuals.select(F.col("node").alias("node_i"), "t", F.col("residual").alias("x"))
    b = residuals.select(F.col("node").alias("node_j"), "t", F.col("residual").alias("y"))
    j = a.join(b, "t") if pairs is None else pairs.join(a, "node_i").join(b, ["node_j", "t"])
    if exact_scale is None:
        return j.groupBy("node_i", "node_j").agg(F.covar_samp("x", "y").alias("cov"))
    dec = f"decimal(18,{exact_scale})"
    x, y = F.col("x").cast(dec), F.col("y").cast(dec)
    m = j.groupBy("node_i", "node_j").agg(F.count(F.lit(1)).alias("_n"), F.sum(x).alias("_sx"),
                                          F.sum(y).alias("_sy"), F.sum(x * y).alias("_sxy"))
    num = (F.col("_n") * F.col("_sxy") - F.col("_sx") * F.col("_sy")).cast("double")
    cov = F.when(F.col("_n") > 1, num / (F.col("_n") * (F.col("_n") - 1)).cast("double"))
    return m.select("node_i", "node_j", cov.alias("cov"))


def node_variance(residuals: DataFrame, exact_scale: int | None = None, population=False):
    """Per-node residual variance ``(node, var)`` (sample, or population)."""
    if exact_scale is None:
        f = F.var_pop if population else F.var_samp
        return residuals.groupBy("node").agg(f("residual").alias("var"))
    x = F.col("residual").cast(f"decimal(18,{exact_scale})")
    m = residuals.groupBy("node").agg(F.count(F.lit(1)).alias("_n"), F.sum(x).alias("_s"),
                                      F.sum(x * x).alias("_ss"))
    num = (F.col("_n") * F.col("_ss") - F.col("_s") * F.col("_s")).cast("double")
    den = (F.col("_n") * F.col("_n")) if population else (F.col("_n") * (F.col("_n") - 1))
    return m.select("node", F.when(den > 0, num / den.cast("double")).alias("var"))


# ---------------------------------------------------------------- MinT
def mint_two_level(edges: DataFrame, base: DataFrame, residuals: DataFrame | None = None,
                   weights: str = "ols", exact_scale: int | None = None) -> DataFrame:
    """Closed-form MinT for a forest of two-level trees with diagonal W.

    ``weights='ols'``: W = I.  ``'diag'``: W = diag(var_samp(residual) + 1e-8).
    Every root's children must be leaves.  Output covers roots and leaves.
    """
    base = materialise(base)
    h = common_horizon(base)
    e = edges.select(F.col("parent").alias("root"), F.col("child").alias("node")).distinct()
    if weights == "ols":
        w = None
    elif weights == "diag":
        if residuals is None:
            raise ValueError("weights='diag' needs residuals")
        w = node_variance(materialise(residuals), exact_scale).select(
            "node", (F.coalesce("var", F.lit(0.0)) + DIAG_EPS).alias("w"))
    else:
        raise ValueError("two-level MinT supports weights 'ols' or 'diag'")
    nodes = e.select("root").withColumnRenamed("root", "node").unionByName(e.select("node"))
    b = (_grid(nodes, h).join(base, ["node", "step"], "left")
         .select("node", "step", F.coalesce("forecast", F.lit(0.0)).alias("f")))
    if w is None:
        b = b.withColumn("w", F.lit(1.0))
    else:
        b = b.join(w, "node", "left").withColumn("w", F.coalesce("w", F.lit(1.0 + DIAG_EPS)))
    leaf = e.join(b, "node")
    root = b.withColumnRenamed("node", "root").select("root", "step", F.col("f").alias("y0"),
                                                      F.col("w").alias("w0"))
    fsum = F.col("f") if exact_scale is None else F.col("f").cast(f"decimal(20,{exact_scale + 2})")
    agg = leaf.groupBy("root", "step").agg(F.sum(fsum).cast("double").alias("sb"),
                                           F.sum("w").alias("sw"))
    adj = agg.join(root, ["root", "step"]).select(
        "root", "step", ((F.col("y0") - F.col("sb")) / (F.col("w0") + F.col("sw"))).alias("k"))
    rec_leaf = leaf.join(adj, ["root", "step"]).select(
        "root", "node", "step", (F.col("f") + F.col("w") * F.col("k")).alias("forecast"))
    rec_root = rec_leaf.groupBy("root", "step").agg(F.sum("forecast").alias("forecast")) \
                       .withColumnRenamed("root", "node")
    return rec_leaf.select("node", "step", "forecast").unionByName(rec_root)


def _constraints(edges: DataFrame) -> tuple[DataFrame, bool]:
    """Entries ``(p, node, c)`` of C, and whether the hierarchy is a forest.

    In a forest the row of a parent has 1 for itself and -1 for its children; where a node has
    two parents, -1 for every leaf below, each counted once.
    """
    e = edges.select("parent", "child").distinct()
    tree = e.groupBy("child").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").isEmpty()
    below = e if tree else closure(edges).toDF("parent", "child")
    own = e.select(F.col("parent").alias("p"), F.col("parent").alias("node"), F.lit(1.0).alias("c")).distinct()
    return own.unionByName(below.select(F.col("parent").alias("p"), F.col("child").alias("node"), F.lit(-1.0).alias("c"))), tree


def _contracted(edges: DataFrame, free: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Constraints of a forest without the ``free`` nodes, and ``(leaf, p)``: the constraint that a free leaf is left to.

    A free parent is passed over: its children go to the next ancestor that is not free.  A constraint with a free
    leaf binds nothing, since the leaf takes what is left.
    """
    e = edges.select("parent", "child").distinct()
    over = e.join(free.select(F.col("node").alias("child")), "child").select(F.col("child").alias("parent"), F.col("parent").alias("_next")).unionByName(
        roots(edges).join(free, "node").select(F.col("node").alias("parent"), F.lit(None).cast("string").alias("_next")))
    over = materialise(over)
    up = e
    while not up.join(over, "parent", "left_semi").isEmpty():
        up = materialise(up.join(over.withColumn("_free", F.lit(True)), "parent", "left").select(
            F.when(F.col("_free"), F.col("_next")).otherwise(F.col("parent")).alias("parent"), "child"))
    marked = up.join(free.select(F.col("node").alias("child"), F.lit(True).alias("free")), "child", "left").join(
        leaves(edges).select(F.col("node").alias("child"), F.lit(True).alias("leaf")), "child", "left")
    left = materialise(marked.where("free and leaf").select(F.col("child").alias("leaf"), F.col("parent").alias("p")))
    below = marked.where("parent is not null and free is null").select(F.col("parent").alias("p"), F.col("child").alias("node"), F.lit(-1.0).alias("c"))
    own = below.select("p").unionByName(left.where("p is not null").select("p")).distinct().select("p", F.col("p").alias("node"), F.lit(1.0).alias("c"))
    return own.unionByName(below), left


def _products(entries: DataFrame, weights: DataFrame, factors: DataFrame | None, alpha: float, v: DataFrame, k: int) -> DataFrame:
    """``C W Cᵀ v`` for the ``k`` columns of ``v (p, v0, v1, ...)``: ``(p, q0, q1, ...)``."""
    up = entries.join(v, "p").groupBy("node").agg(*[F.sum(F.col("c") * F.col(f"v{i}")).alias(f"z{i}") for i in range(k)])
    own = entries.join(up.join(weights, "node"), "node").groupBy("p").agg(
        *[F.sum(F.col("c") * F.col("w") * F.col(f"z{i}")).alias(f"q{i}") for i in range(k)])
    if factors is None:
        return own
    by_time = factors.join(v, "p").groupBy("t").agg(*[F.sum(F.col("u") * F.col(f"v{i}")).alias(f"s{i}") for i in range(k)])
    common = factors.join(by_time, "t").groupBy("p").agg(*[F.sum(F.col("u") * F.col(f"s{i}")).alias(f"_q{i}") for i in range(k)])
    return own.join(common, "p", "left").select(
        "p", *[(F.col(f"q{i}") + alpha * F.coalesce(F.col(f"_q{i}"), F.lit(0.0))).alias(f"q{i}") for i in range(k)])


def _multipliers(entries: DataFrame, weights: DataFrame, factors: DataFrame | None, alpha: float, gaps: DataFrame, k: int) -> DataFrame:
    """``(p, v0, v1, ...)``: solutions of ``C W Cᵀ v = gap`` by conjugate gradients, scaled by the matrix's diagonal.

    Every forecast step is a right-hand side of its own.  One round is one written table with the state and the
    product, and four sums for each step.  Raises where the descent ends above ``ACCEPTED``.
    """
    size = entries.join(weights, "node").groupBy("p").agg(F.sum(F.col("c") * F.col("c") * F.col("w")).alias("m"))
    if factors is not None:
        common = factors.groupBy("p").agg((alpha * F.sum(F.col("u") * F.col("u"))).alias("_m"))
        size = size.join(common, "p", "left").select("p", (F.col("m") + F.coalesce("_m", F.lit(0.0))).alias("m"))
    each = range(k)
    state = gaps.join(size, "p").select("p", "m", *[F.lit(0.0).alias(f"x{i}") for i in each], *[F.col(f"g{i}").alias(f"r{i}") for i in each],
                                        *[(F.col(f"g{i}") / F.col("m")).alias(f"d{i}") for i in each])
    first, best, since, last = None, math.inf, 0, None
    state = written(state, "mint")
    for _ in range(MAX_ROUNDS):
        v = state.select("p", *[F.col(f"d{i}").alias(f"v{i}") for i in each])
        now = written(state.join(_products(entries, weights, factors, alpha, v, k), "p"), "mint")
        discard(last if last is not None else state)
        last = now
        sums = now.agg(*[F.sum(x).alias(f"{n}{i}") for i in each for n, x in (
            ("dq", F.col(f"d{i}") * F.col(f"q{i}")), ("rr", F.col(f"r{i}") * F.col(f"r{i}") / F.col("m")),
            ("rq", F.col(f"r{i}") * F.col(f"q{i}") / F.col("m")), ("qq", F.col(f"q{i}") * F.col(f"q{i}") / F.col("m")))]).first()
        rr = [sums[f"rr{i}"] or 0.0 for i in each]
        first = first or rr
        share = max((math.sqrt(a / b) for a, b in zip(rr, first) if b > 0), default=0.0)
        best, since = (share, 0) if share < 0.5 * best else (best, since + 1)
        if share <= SOLVED or since >= PATIENCE[best > ACCEPTED]:
            break
        a, b = [0.0] * k, [0.0] * k
        for i in each:
            if rr[i] > 0 and (sums[f"dq{i}"] or 0.0) > 0:
                a[i] = rr[i] / sums[f"dq{i}"]
                b[i] = max(rr[i] - 2 * a[i] * sums[f"rq{i}"] + a[i] ** 2 * sums[f"qq{i}"], 0.0) / rr[i]
        rest = [F.col(f"r{i}") - F.lit(a[i]) * F.col(f"q{i}") for i in each]
        state = now.select("p", "m", *[(F.col(f"x{i}") + F.lit(a[i]) * F.col(f"d{i}")).alias(f"x{i}") for i in each],
                           *[rest[i].alias(f"r{i}") for i in each], *[(rest[i] / F.col("m") + F.lit(b[i]) * F.col(f"d{i}")).alias(f"d{i}") for i in each])
    if share > ACCEPTED:
        raise ArithmeticError(f"conjugate gradients ended at {share:.1e} of the first residual")
    return last.select("p", *[F.col(f"x{i}").alias(f"v{i}") for i in each])


def mint(edges: DataFrame, base: DataFrame, residuals: DataFrame | None = None, cov: str = "shrink") -> DataFrame:
    """MinT for any hierarchy: the coherent forecasts nearest to ``base`` in the metric of W (see the module).

    ``cov``: 'ols' (W = I, also used when residuals are absent), 'shrink' (covariance of the residuals, off-diagonal × 0.5;
    fewer than 3 residuals → diag(var_pop) + 1e-8), 'sample' (covariance + 1e-8 I), 'diag' (diag(var_samp) + 1e-8).
    Missing forecasts and residuals count as 0.  With 'shrink' a node whose residuals never vary has no say: its
    forecast is what the others leave it; several such leaves below one parent share the rest equally, and one
    below no other node gets 0 (where a node has two parents, such nodes get a million times the largest variance).
    Differences between a parent's residual and its children's that are within rounding are none.
    """
    if cov not in COV_METHODS:
        raise ValueError(f"unknown covariance method {cov!r}")
    s = materialise(summing_matrix(edges))
    base = materialise(base)
    nodes = s.select("node").distinct()
    h = base.groupBy("node").agg(F.max("step").alias("_n")).agg(F.min("_n")).first()[0] or 1
    entries, tree = _constraints(edges)
    left, factors, alpha, centred = None, None, 0.0, None
    if residuals is None or cov == "ols":
        weights = nodes.withColumn("w", F.lit(1.0))
    else:
        dense = materialise(dense_residuals(nodes, materialise(residuals)))
        times = dense.agg(F.max("t")).first()[0] or 0
        short = cov == "shrink" and times < 3
        var = materialise(nodes.join(node_variance(dense, population=short), "node", "left").select("node", F.coalesce("var", F.lit(0.0)).alias("var")))
        weights = var.select("node", (F.col("var") + DIAG_EPS).alias("w"))
        if not short and cov != "diag":
            alpha = (SHRINK_ALPHA if cov == "shrink" else 1.0) / max(times - 1, 1)
            means = dense.groupBy("node").agg(F.avg("residual").alias("_mean"))
            centred = written(dense.join(means, "node").select("node", "t", (F.col("residual") - F.col("_mean")).alias("x"), F.abs("residual").alias("_abs")), "residuals")
            weights = var.select("node", F.lit(DIAG_EPS).alias("w"))
        if not short and cov == "shrink":
            top = var.agg(F.max("var")).first()[0] or 0.0
            free = materialise(var.where(F.col("var") <= VARIANCE_CUT * top).select("node"))
            weights = var.select("node", ((1 - SHRINK_ALPHA) * F.col("var")).alias("w"))
            if not free.isEmpty():
                if tree:
                    entries, left = _contracted(edges, free)
                    # constraints with a free leaf are no part of the system
                    entries = materialise(entries)
                    bound = entries.join(left.where("p is not null").select("p").distinct(), "p", "left_anti")
                else:
                    weights = var.select("node", F.when(F.col("var") > VARIANCE_CUT * top, (1 - SHRINK_ALPHA) * F.col("var")).otherwise(1e6 * (top or 1.0)).alias("w"))
    # written, so that small tables are known to be small
    weights = written(weights, "weights")
    entries = written(entries, "constraints")
    bound = entries if left is None else written(bound, "constraints")
    if centred is not None:
        # sums that cancel but for rounding are zero
        u = bound.join(centred, "node").groupBy("p", "t").agg(F.sum(F.col("c") * F.col("x")).alias("u"), F.sum("_abs").alias("_abs"))
        factors = written(u.where(F.abs("u") > 1e-12 * F.col("_abs")).select("p", "t", "u"), "factors")
    forecasts = materialise(_grid(nodes, F.lit(h)).join(base, ["node", "step"], "left").select(
        "node", "step", F.coalesce("forecast", F.lit(0.0)).alias("forecast")))
    moved = None
    for lo in range(1, h + 1, STEP_BLOCK):
        steps = range(lo, min(lo + STEP_BLOCK, h + 1))
        k = len(steps)
        wide = written(forecasts.groupBy("node").agg(*[F.max(F.when(F.col("step") == x, F.col("forecast"))).alias(f"f{i}") for i, x in enumerate(steps)]), "base")
        gaps = bound.join(wide, "node").groupBy("p").agg(*[F.sum(F.col("c") * F.col(f"f{i}")).alias(f"g{i}") for i in range(k)])
        if bound.isEmpty():
            parts = wide.select("node", *[F.col(f"f{i}").alias(f"y{i}") for i in range(k)])
        else:
            v = _multipliers(bound, weights, factors, alpha, gaps, k)
            up = bound.join(v, "p").groupBy("node").agg(*[F.sum(F.col("c") * F.col(f"v{i}")).alias(f"z{i}") for i in range(k)])
            parts = wide.join(weights, "node").join(up, "node", "left")
            pull = [F.col("w") * F.coalesce(F.col(f"z{i}"), F.lit(0.0)) for i in range(k)]
            if factors is not None:
                by_time = factors.join(v, "p").groupBy("t").agg(*[F.sum(F.col("u") * F.col(f"v{i}")).alias(f"s{i}") for i in range(k)])
                common = centred.join(by_time, "t").groupBy("node").agg(*[F.sum(F.col("x") * F.col(f"s{i}")).alias(f"c{i}") for i in range(k)])
                parts = parts.join(common, "node", "left")
                pull = [p + alpha * F.coalesce(F.col(f"c{i}"), F.lit(0.0)) for i, p in enumerate(pull)]
            parts = parts.select("node", *[(F.col(f"f{i}") - pull[i]).alias(f"y{i}") for i in range(k)])
        long = parts.select("node", F.explode(F.arrays_zip(F.array(*[F.lit(x) for x in steps]).alias("step"), F.array(*[F.col(f"y{i}") for i in range(k)]).alias(
            "forecast"))).alias("_s")).select("node", F.col("_s.step").alias("step"), F.col("_s.forecast").alias("forecast"))
        moved = long if moved is None else moved.unionByName(long)
    moved = materialise(moved)
    bottom = moved.join(leaves(edges), "node")
    if left is not None:
        rest = entries.join(moved, "node").groupBy("p", "step").agg(F.sum(F.col("c") * F.col("forecast")).alias("_rest"))
        shares = left.groupBy("p").agg(F.count(F.lit(1)).alias("_n"))
        given = left.join(shares, "p").join(rest, "p").select(F.col("leaf").alias("node"), "step", (F.col("_rest") / F.col("_n")).alias("forecast"))
        # a free leaf below no other node is missing here and counts 0 in the sums
        bottom = bottom.join(left.select(F.col("leaf").alias("node")), "node", "left_anti").unionByName(given)
    return _aggregate_up(s, bottom, F.lit(h))


# ---------------------------------------------------------------- post-processing
def clamp_non_negative(rec: DataFrame, col: str = "forecast") -> DataFrame:
    """``max(x, 0)`` elementwise; NULL stays NULL.  (Breaks additivity, as the reference.)"""
    return rec.withColumn(col, F.when(F.col(col).isNotNull(), F.greatest(F.col(col), F.lit(0.0))))


def clamp_leaves(edges: DataFrame, rec: DataFrame) -> DataFrame:
    """Coherent alternative: clamp the leaves, then sum up again."""
    lf = clamp_non_negative(rec.join(leaves(edges), "node"))
    return _aggregate_up(summing_matrix(edges), lf, common_horizon(rec))


def coherence(edges: DataFrame, rec: DataFrame) -> DataFrame:
    """``(node, max_abs_gap)``: largest |sum of leaves − node| over steps, per parent."""
    s = summing_matrix(edges)
    parents = edges.select(F.col("parent").alias("node")).distinct()
    lf = rec.select(F.col("node").alias("leaf"), "step", F.col("forecast").alias("_f"))
    sums = (s.join(parents, "node").join(lf, "leaf")
             .groupBy("node", "step").agg(F.sum("_f").alias("_sum")))
    return (sums.join(rec, ["node", "step"])
                .groupBy("node").agg(F.max(F.abs(F.col("_sum") - F.col("forecast")))
                                     .alias("max_abs_gap")))


def reconcile(edges: DataFrame, base: DataFrame, residuals: DataFrame | None = None,
              method: str = "mint", non_negative: bool = True, cov: str = "shrink",
              proportions: DataFrame | None = None, clamp: str = "all") -> DataFrame:
    """Dispatcher: ``bottom_up`` | ``top_down`` | ``mint``, then optional clamp.

    ``clamp='all'`` clamps every node (reference behaviour, may break additivity);
    ``clamp='leaves'`` clamps the leaves and re-aggregates (coherent).
    """
    if method == "bottom_up":
        rec = bottom_up(edges, base)
    elif method == "top_down":
        rec = top_down(edges, base, proportions)
    elif method == "mint":
        rec = mint(edges, base, residuals, cov if residuals is not None else "ols")
    else:
        raise ValueError(f"method must be one of {METHODS}, not {method!r}")
    if not non_negative:
        return rec
    return clamp_leaves(edges, rec) if clamp == "leaves" else clamp_non_negative(rec)
