"""op12: hard negatives against a plain computation with Python's integers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.llm import negatives

ROWS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("label", T.IntegerType()),
                     T.StructField("embedding", T.ArrayType(T.DoubleType()))])


def brute(rows, positives=5, negs=3):
    """All anchors (ids divisible by 5) against all rows."""
    def usable(r):
        return r[0] is not None and r[1] is not None and r[2] and all(x is not None and math.isfinite(x) for x in r[2])

    own = [(n, i, lab, [math.floor(256 * x) for x in v]) for n, (i, lab, v) in enumerate(r for r in rows if usable(r))]
    out = []
    for n, i, lab, v in own:
        if i % 5:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j, m, other) for m, j, other, w in own if m != n and len(w) == len(v)]
        for s, j, _, _ in sorted(x for x in scored if x[3] == lab)[:positives]:
            fit = sorted(x for x in scored if x[3] != lab and 50 * -s <= 100 * -x[0] <= 95 * -s)[:negs]
            out += [(i, j, r, f[1], -s, -f[0]) for r, f in enumerate(fit, 1)]
    return sorted(out)


def got(spark, rows, **more):
    df = spark.createDataFrame(rows, ROWS)
    for name in ("id", "rid", "v", "shard", "slot", "score", "part"):
        df = df.withColumn(name, F.lit("clash"))
    return sorted(tuple(r) for r in negatives.hard_negatives(df, F.col("vec_id") % 5 == 0, F.col("label"), **more).collect())


@pytest.mark.parametrize("dim", [3, 20, 64])
def test_equals_brute_force(spark, dim):
    rng = np.random.default_rng(dim)
    centres = rng.normal(size=(4, dim))
    rows = [(i, int(i % 4), [float(x) for x in centres[rng.integers(4)] * (i % 3 > 0) + rng.normal(size=dim) * 0.5]) for i in range(300)]
    want = brute(rows)
    assert len(want) > 100
    assert got(spark, rows) == want


def test_odd_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, i % 2, [round(float(x), 1) for x in rng.normal(size=8)]) for i in range(40)]
    rows += rows[:10]  # repeated rows and ties
    rows += [(5, 1, [1.0] * 8), (5, 0, [1.0] * 8), (10, 0, [2.0] * 3), (12, 1, [2.0] * 3), (13, 0, [2.0] * 3), (15, 1, [1e6] * 8), (16, 1, [1e6] * 8),
             (17, 0, [0.8e6] * 8)]  # products beyond the exact doubles
    rows += [(None, 1, [1.0] * 8), (20, None, [1.0] * 8), (25, 1, None), (30, 1, []), (35, 1, [None] * 8), (40, 1, [float("nan")] * 8),
             (45, 0, [float("inf")] + [0.0] * 7), (50, 0, [0.0] * 8), (55, 0, [0.0] * 8)]
    assert got(spark, rows) == brute(rows)


def test_empty_and_single(spark):
    assert got(spark, []) == []
    assert got(spark, [(0, 1, [1.0, 2.0])]) == []


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(0)
    x = rng.integers(-100, 100, size=(50, 64))
    y = np.repeat(rng.integers(-100, 100, size=(50, 16)), 4, axis=1)  # constant in short segments: the bound is the score
    exact = x @ y.T
    for length in (16, 4):
        (am, ad), (bm, bd) = negatives.summaries(x, length), negatives.summaries(y, length)
        assert (am @ bm.T + ad @ bd.T >= exact - 1e-6).all() and (am @ bm.T - ad @ bd.T <= exact + 1e-6).all()
    assert np.allclose(am @ bm.T, exact) and np.allclose(bd, 0)


def test_many_shards_and_salts(spark, monkeypatch):
    monkeypatch.setattr(negatives, "LEAST_ROWS", 20)
    monkeypatch.setattr(negatives, "PART_ROWS", 15)
    monkeypatch.setattr(negatives, "CHUNK", 4)
    rng = np.random.default_rng(9)
    # one label and one vector hold a third of all rows each
    rows = [(i, 0 if i % 3 else int(i % 5), [1.0, 0.5, -0.5, 2.0] if i % 3 == 1 else [float(x) for x in rng.normal(size=4)]) for i in range(240)]
    assert got(spark, rows) == brute(rows)
