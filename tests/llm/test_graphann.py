"""op13: recall against brute force, exact distances, and the index itself."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.llm import graphann

ROWS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType()))])


def table(spark, rows):
    df = spark.createDataFrame(rows, ROWS)
    for name in ("id", "rid", "v", "node", "score", "part", "dim"):
        df = df.withColumn(name, F.lit("clash"))
    return df


def found(spark, rows, every=10, **more):
    out = {}
    for q, r, v, s in graphann.nearest(table(spark, rows), F.col("vec_id") % every == 0, **more).orderBy("query_id", "rank").collect():
        out.setdefault(q, []).append((r, v, s))
    return out


def recall(x, got, every=10, k=10):
    hit = total = 0
    for q in range(0, len(x), every):
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        d[q] = np.inf
        true = np.sort(d)[:k]
        assert [g[0] for g in got[q]] == list(range(1, k + 1))
        assert np.allclose([g[2] for g in got[q]], [d[g[1]] for g in got[q]], rtol=1e-12, atol=0)
        assert [(g[2], g[1]) for g in got[q]] == sorted((g[2], g[1]) for g in got[q])
        hit += sum(g[2] <= true[-1] * (1 + 1e-12) for g in got[q])
        total += k
    return hit / total


@pytest.mark.parametrize("kind", ["uniform", "clusters", "line"])
def test_recall(spark, kind):
    rng = np.random.default_rng(3)
    if kind == "uniform":
        x = rng.normal(size=(2500, 32))
    elif kind == "clusters":  # tight groups of many near copies
        x = rng.normal(size=(25, 32))[rng.integers(25, size=2500)] + rng.normal(size=(2500, 32)) * 1e-3
    else:
        x = np.outer(np.arange(1, 2501), np.ones(4)) + rng.normal(size=(2500, 4)) * 1e-3
    got = found(spark, [(i, [float(c) for c in v]) for i, v in enumerate(x)], shard_nodes=900)
    assert recall(x, got) >= 0.95


def test_small_tables_are_exact(spark):
    """Copies of a vector, ties, repeated ids: with fewer rows than the beam nothing is missed."""
    rng = np.random.default_rng(5)
    rows = [(i, [float(v) for v in rng.integers(1, 3, size=3)]) for i in range(60)] + [(10, [1.0, 1.0, 1.0]), (10, [9.0, 9.0, 9.0])]
    got = sorted(tuple(r) for r in graphann.nearest(table(spark, rows), F.col("vec_id") % 10 == 0).collect())
    want = []
    for n, (q, v) in enumerate(rows):
        if q % 10 == 0:
            near = sorted((float(np.sqrt(sum((a - b) ** 2 for a, b in zip(v, w)))), j) for m, (j, w) in enumerate(rows) if m != n)[:10]
            want += [(q, r, j, d) for r, (d, j) in enumerate(near, 1)]
    assert got == sorted(want)


def test_odd_rows(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 0.0]), (3, None), (4, []), (5, [None, 1.0]), (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]),
            (None, [1.0, 1.0]), (10, [1.0, 2.0, 3.0]), (20, [1e200, -1e200]), (30, [1e-300, 1e-300])]
    got = found(spark, rows)
    assert [g[1] for g in got[0]] == [30, 1, 20] and got[0][2][2] == pytest.approx(np.sqrt(2) * 1e200)
    assert 10 not in got  # no other row of its length
    assert {g[1] for g in got[20]} == {0, 1, 30}
    assert found(spark, []) == {} and found(spark, [(0, [1.0])]) == {}


def test_a_vector_of_a_third_of_all_rows(spark):
    rng = np.random.default_rng(8)
    x = np.where((np.arange(1500) % 3 == 0)[:, None], 1.0, rng.normal(size=(1500, 16)))
    index = graphann.build_index(table(spark, [(i, [float(c) for c in v]) for i, v in enumerate(x)]).select(
        F.col("vec_id").alias("rid"), F.col("vec_id").alias("id"), F.lit(16).alias("dim"), F.col("embedding").alias("v")), keep=11)
    assert index.count() == 1001 and index.agg(F.max(F.size("members"))).first()[0] == 11
    got = found(spark, [(i, [float(c) for c in v]) for i, v in enumerate(x)])
    assert [g[1] for g in got[0]] == [3, 6, 9, 12, 15, 18, 21, 24, 27, 30] and recall(x, got) >= 0.95


def test_pruned_edges_are_diverse():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 8))
    graph = graphann.Graph(x, degree=12).build(beam=32)
    assert (graph.links >= 0).sum(axis=1).max() <= 12
    seen, todo = {graph.entry}, [graph.entry]  # every node can be reached from the entry
    while todo:
        for n in graph.links[todo.pop()].tolist():
            if n >= 0 and n not in seen:
                seen.add(n)
                todo.append(n)
    assert len(seen) == 600
    kept = graph.prune(np.array([0]), np.arange(600)[None, :], 1.2)[0]
    kept = kept[kept >= 0]
    d = lambda a, b: float(((x[a] - x[b]) ** 2).sum())
    for i, c in enumerate(kept):
        assert all(1.44 * d(b, c) > d(0, c) * (1 - 1e-5) for b in kept[:i])
