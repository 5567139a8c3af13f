"""Reconciliation invariants on the reference's six-node hierarchy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidecast.operators import reconcile as rc


def _base(spark):
    rng = np.random.default_rng(789)
    ranges = {"total": (2000, 3000), "region_A": (1200, 1800), "region_B": (500, 900),
              "store_1": (600, 1000), "store_2": (400, 800), "store_3": (500, 900)}
    rows = [(n, h + 1, float(v)) for n, (lo, hi) in ranges.items()
            for h, v in enumerate(rng.uniform(lo, hi, 10))]
    return spark.createDataFrame(rows, "node string, step int, forecast double")


def _residuals(spark):
    rng = np.random.default_rng(5)
    nodes = ["total", "region_A", "region_B", "store_1", "store_2", "store_3"]
    return spark.createDataFrame([(n, t, float(rng.normal(0, 10))) for n in nodes for t in range(1, 25)],
                                 "node string, t int, residual double")


def test_structure(spark, tree_edges):
    assert {r.node for r in rc.leaves(tree_edges).collect()} == {"store_1", "store_2", "store_3"}
    assert [r.node for r in rc.roots(tree_edges).collect()] == ["total"]
    s = {(r.node, r.leaf) for r in rc.summing_matrix(tree_edges).collect()}
    assert ("total", "store_3") in s and ("region_A", "store_3") not in s and len(s) == 3 + 2 + 1 + 3
    order = [r.node for r in rc.node_order(tree_edges).orderBy("node_order").collect()]
    assert order == ["total", "region_A", "region_B", "store_1", "store_2", "store_3"]


def _check_coherent(edges, rec, tol=1e-6):
    gaps = rc.coherence(edges, rec).agg(F.max("max_abs_gap")).first()[0]
    assert gaps <= tol


@pytest.mark.parametrize("method,cov", [("bottom_up", None), ("top_down", None), ("mint", "ols"),
                                        ("mint", "shrink"), ("mint", "sample"), ("mint", "diag")])
def test_coherent(spark, tree_edges, method, cov):
    base = _base(spark)
    res = _residuals(spark)
    if method == "mint":
        rec = rc.mint(tree_edges, base, res, cov=cov)
    elif method == "top_down":
        rec = rc.top_down(tree_edges, base)
    else:
        rec = rc.bottom_up(tree_edges, base)
    assert rec.count() == 6 * 10
    _check_coherent(tree_edges, rec)


def test_bottom_up_keeps_leaves(spark, tree_edges):
    base = _base(spark)
    rec = {(r.node, r.step): r.forecast for r in rc.bottom_up(tree_edges, base).collect()}
    b = {(r.node, r.step): r.forecast for r in base.collect()}
    assert rec[("store_3", 4)] == b[("store_3", 4)]
    assert rec[("total", 2)] == pytest.approx(b[("store_1", 2)] + b[("store_2", 2)] + b[("store_3", 2)])


def _dense_mint(edges, base, residuals, cov, horizon):
    """``S (Sᵀ W⁺ S)⁺ Sᵀ W⁺ ŷ`` with numpy, for small trees."""
    parents = {}
    for p, c in edges:
        parents.setdefault(c, set()).add(p)
    nodes = sorted({n for e in edges for n in e})
    bottom = [n for n in nodes if n not in {p for p, _ in edges}]

    def above(n):
        return {n}.union(*(above(p) for p in parents.get(n, ())))

    s = np.array([[float(n in above(b)) for b in bottom] for n in nodes])
    y = np.array([[base.get((n, h), 0.0) for h in range(1, horizon + 1)] for n in nodes])
    t = max((k for _, k in residuals), default=1)
    r = np.array([[residuals.get((n, k), 0.0) for k in range(1, t + 1)] for n in nodes])
    if cov == "ols":
        w = np.eye(len(nodes))
    elif cov == "diag":
        w = np.diag(np.var(r, axis=1, ddof=1) + 1e-8)
    elif cov == "shrink":
        c = np.cov(r)
        w = np.diag(np.var(r, axis=1) + 1e-8) if t < 3 else 0.5 * c + 0.5 * np.diag(np.diag(c))
    else:
        w = np.cov(r) + 1e-8 * np.eye(len(nodes))
    wi = np.linalg.pinv(w)
    out = s @ np.linalg.pinv(s.T @ wi @ s) @ s.T @ wi @ y
    return {(n, h + 1): out[i, h] for i, n in enumerate(nodes) for h in range(horizon)}


def _random_tree(rng, n):
    names = [f"n{i:02d}" for i in range(n)]
    return [(names[rng.integers(max(0, i - 6), i)], names[i]) for i in range(1, n)]


@pytest.mark.parametrize("cov", ["ols", "diag", "shrink", "sample", "short", "still", "two parents"])
def test_mint_equals_the_dense_formula(spark, cov, monkeypatch):
    monkeypatch.setattr(rc, "STEP_BLOCK", 3 if cov == "shrink" else 12)
    monkeypatch.setattr(rc, "SOLVED", 1e-11)
    rng = np.random.default_rng(17)
    edges = _random_tree(rng, 14)
    if cov == "two parents":
        edges += [("n00", "x"), ("n01", "x"), ("x", "y"), ("x", "z")]
    nodes = sorted({n for e in edges for n in e})
    base = {(n, h): float(rng.uniform(50, 150)) for n in nodes for h in range(1, 5) if n != "n05"}
    common = rng.normal(size=40)
    t = 2 if cov == "short" else 40
    residuals = {(n, k): float(common[k - 1] * 3 + rng.normal() * (1 + i % 5)) for i, n in enumerate(nodes) for k in range(1, t + 1)}
    if cov == "still":  # inner nodes, leaves and the root without any variance
        parents = {p for p, _ in edges}
        inner = [n for n in nodes if n in parents][1:4:2]
        bottom = [n for n in nodes if n not in parents][::4]
        residuals = {k: v for k, v in residuals.items() if k[0] not in {*inner, *bottom, "n00"}}
    method = {"short": "shrink", "still": "shrink", "two parents": "shrink"}.get(cov, cov)
    want = _dense_mint(edges, base, residuals, method, 4)
    rec = rc.mint(spark.createDataFrame(edges, "parent string, child string"),
                  spark.createDataFrame([(n, h, v) for (n, h), v in base.items()], "node string, step int, forecast double"),
                  spark.createDataFrame([(n, k, v) for (n, k), v in residuals.items()], "node string, t int, residual double"), cov=method)
    got = {(r.node, r.step): r.forecast for r in rec.collect()}
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k], rel=1e-6, abs=1e-6), k


def test_mint_sample_of_coherent_residuals_is_the_plain_projection(spark):
    edges = [("r", "a"), ("r", "b"), ("a", "c"), ("a", "d"), ("b", "e"), ("b", "f")]
    rng = np.random.default_rng(4)
    leaf = {n: np.round(rng.normal(size=30) * 1e6, 2) for n in "cdef"}
    every = leaf | {"a": leaf["c"] + leaf["d"], "b": leaf["e"] + leaf["f"]}
    every["r"] = every["a"] + every["b"]
    base = {(n, 1): float(rng.uniform(1e6, 2e6)) for n in every}
    frame = spark.createDataFrame([(n, h, v) for (n, h), v in base.items()], "node string, step int, forecast double")
    res = spark.createDataFrame([(n, k + 1, float(x)) for n, v in every.items() for k, x in enumerate(v)], "node string, t int, residual double")
    got = {(r.node, r.step): r.forecast for r in rc.mint(spark.createDataFrame(edges, "parent string, child string"), frame, res, cov="sample").collect()}
    want = _dense_mint(edges, base, {}, "ols", 1)
    for k in want:
        assert got[k] == pytest.approx(want[k], rel=1e-9)


def test_mint_of_a_large_tree(spark, monkeypatch):
    """20,000 nodes, five levels: more than any matrix of nodes by nodes could hold on a driver."""
    monkeypatch.setattr(rc, "SOLVED", 1e-9)
    n = 20_000
    e = spark.range(1, n).selectExpr("concat('n', cast((id - 1) div 8 as string)) as parent", "concat('n', cast(id as string)) as child")
    nodes = spark.range(n).selectExpr("concat('n', cast(id as string)) as node", "id")
    base = nodes.selectExpr("node", "1 as step", "100.0D + pmod(xxhash64(id), 1000) / 10 as forecast")
    res = nodes.selectExpr("node", "explode(sequence(1, 12)) as t", "id").selectExpr("node", "t", "pmod(xxhash64(id, t), 2001) / 100 - 10.0D as residual")
    rec = rc.materialise(rc.mint(e, base, res, cov="shrink"))
    assert rec.count() == n
    # the solution's condition: W⁻¹(ŷ - ỹ) sums to nothing over the path of every leaf; and the sums hold
    _check_coherent(e, rec, 1e-5)
    before, after = (dict(zip(*[list(x) for x in zip(*d.select("node", "forecast").collect())])) for d in (base, rec))
    r = np.zeros((n, 12))
    for row in res.collect():
        r[int(row.node[1:]), row.t - 1] = row.residual
    r -= r.mean(axis=1, keepdims=True)
    gap = np.array([before[f"n{i}"] - after[f"n{i}"] for i in range(n)])
    d, a = 0.5 * (r ** 2).sum(axis=1) / 11, 0.5 / 11
    inner = np.linalg.solve(np.eye(12) / a + r.T @ (r / d[:, None]), r.T @ (gap / d))
    pull = gap / d - (r / d[:, None]) @ inner  # W⁻¹ gap
    total = pull.copy()
    for i in range(1, n):
        total[i] += total[(i - 1) // 8]
    bottom = np.arange((n - 2) // 8 + 1, n)
    assert np.abs(total[bottom]).max() < 1e-6 * np.abs(pull).max()


def test_mint_ols_two_level_closed_form_matches_general(spark):
    edges = spark.createDataFrame([("r", "a"), ("r", "b"), ("r", "c")], "parent string, child string")
    base = spark.createDataFrame([("r", 1, 10.0), ("a", 1, 2.0), ("b", 1, 3.0), ("c", 1, 4.0)],
                                 "node string, step int, forecast double")
    g = {r.node: r.forecast for r in rc.mint(edges, base, None, cov="ols").collect()}
    c = {r.node: r.forecast for r in rc.mint_two_level(edges, base).collect()}
    for k in g:
        assert g[k] == pytest.approx(c[k], rel=1e-9)
    assert g["a"] == pytest.approx(2 + (10 - 9) / 4)


def test_clamp(spark, tree_edges):
    base = spark.createDataFrame([("store_1", 1, 5.0), ("store_2", 1, -3.0), ("store_3", 1, 1.0)],
                                 "node string, step int, forecast double")
    rec = rc.bottom_up(tree_edges, base)
    cl = {r.node: r.forecast for r in rc.clamp_non_negative(rec).collect()}
    assert cl["store_2"] == 0.0 and cl["region_A"] == 2.0  # additivity broken, as the reference
    cl2 = {r.node: r.forecast for r in rc.clamp_leaves(tree_edges, rec).collect()}
    assert cl2["region_A"] == 5.0


def test_unknown_method(spark, tree_edges):
    with pytest.raises(ValueError):
        rc.reconcile(tree_edges, _base(spark), method="magic")


def test_mint_shrink_short_residuals_uses_diagonal(spark, tree_edges):
    # fewer than 3 residuals per node: diag(var_pop) + 1e-8 (small-sample branch)
    res = spark.createDataFrame([(n, t, float(v)) for n in ("total", "region_A", "region_B",
                                                              "store_1", "store_2", "store_3")
                                 for t, v in ((1, 1.0 + len(n)), (2, -2.0))],
                                "node string, t int, residual double")
    rec = rc.mint(tree_edges, _base(spark), res, cov="shrink")
    _check_coherent(tree_edges, rec)


def test_deep_chain_keeps_every_ancestor(spark):
    edges = spark.createDataFrame([(f"n{i:02d}", f"n{i + 1:02d}") for i in range(80)], "parent string, child string")
    assert {tuple(r) for r in rc.closure(edges).collect()} == {(f"n{i:02d}", "n80") for i in range(80)}
    order = {r.node: (r.node_order, r.depth) for r in rc.node_order(edges).collect()}
    assert order == {f"n{i:02d}": (i + 1, i) for i in range(81)}


def test_a_node_below_two_parents_takes_its_first_path(spark):
    edges = spark.createDataFrame([("r", "a"), ("r", "b"), ("a", "c"), ("b", "d"), ("c", "d"), ("r", "d"), ("d", "x")],
                                  "parent string, child string")
    order = {r.node: (r.node_order, r.depth) for r in rc.node_order(edges).collect()}
    assert order == {"r": (1, 0), "a": (2, 1), "c": (3, 2), "d": (4, 1), "b": (5, 1), "x": (6, 2)}


def test_a_cycle_is_an_error(spark):
    edges = spark.createDataFrame([("r", "a"), ("a", "b"), ("b", "c"), ("c", "a"), ("c", "x")], "parent string, child string")
    for f in (rc.closure, rc.node_order):
        with pytest.raises(ValueError, match="cycle"):
            f(edges)


def test_siblings_follow_their_ordinal(spark):
    edges = spark.createDataFrame([("r", "b", 1), ("r", "a", 2), ("r", "z", 0), ("b", "y", 1), ("b", "x", 0), ("a", "q", 0), ("y", "y2", 0), ("x", "x2", 0)],
                                  "parent string, child string, ordinal int")
    order = [r.node for r in rc.node_order(edges).orderBy("node_order").collect()]
    assert order == ["r", "b", "x", "y", "a", "q", "x2", "y2", "z"]


def test_covariance_of_siblings_only(spark, tree_edges):
    res = _residuals(spark)
    every = {(r.node_i, r.node_j): r.cov for r in rc.residual_covariance(res).collect()}
    some = {(r.node_i, r.node_j): r.cov for r in rc.residual_covariance(res, pairs=rc.sibling_pairs(tree_edges)).collect()}
    assert some.keys() == {(n, n) for n in ("total", "region_A", "region_B", "store_1", "store_2", "store_3")} | {("region_A", "region_B"), ("store_1", "store_2")}
    assert all(some[k] == pytest.approx(every[k]) for k in some)
