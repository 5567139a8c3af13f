"""Exact top-k by inner product: a ball tree per shard, branch and bound.

Rows are ordered by the signs of their leading components and cut into shards, so a shard is a part of space.  Every
shard's vectors are split at medians into balls.  A ball of centre c and radius r holds no inner product with q above
``q.c + r |q|``.  A query visits a shard's leaves in descending order of that bound and stops when the bound falls below
its current k-th score.  A query first searches the shard it lies in; the k-th score found there goes with it: of all other
shards only those whose root ball reaches it are visited, and searched with that score from the root on.  A shard
is sent once, to the task that handles all queries that visit it.
"""

from __future__ import annotations

import pickle

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import staged
from .streamed import met

SHARD_ROWS, LEAF_ROWS, BLOCK_QUERIES = 8192, 256, 512
#: Queries of a shard that one task handles; leading components whose signs order the rows.
PART_QUERIES, SIGNS = 65536, 16
#: Sums of products below this are exact in doubles, and leave room for a rank within the shard.
_EXACT = 1 << 47
_NONE = np.int64(-(1 << 62))


def quantised(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) of every component as long array; null for vectors that take no part:
    null or empty ones, and those with a null or non-finite component."""
    bad = F.exists(vector, lambda x: F.coalesce(F.isnan(x) | (F.abs(x.cast("double")) == float("inf")), F.lit(True)))
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))
    return F.when((F.size(vector) > 0) & ~bad, whole)


def build_tree(x: np.ndarray, leaf: int = LEAF_ROWS) -> dict:
    """Ball tree over the rows of ``x`` (sorted by id): order of rows, and per node centre, radius, range, children."""
    order = np.arange(len(x))
    nodes: list[list] = []

    def grow(lo: int, hi: int) -> int:
        own = x[order[lo:hi]].astype(np.float64)
        centre = own.mean(axis=0)
        far = ((own - centre) ** 2).sum(axis=1)
        me = len(nodes)
        nodes.append([centre, np.sqrt(far.max()) * (1 + 1e-12), lo, hi, -1, -1])
        if hi - lo > leaf:
            a = own[far.argmax()]
            b = own[((own - a) ** 2).sum(axis=1).argmax()]
            mid = (hi - lo) // 2
            part = np.argpartition(own @ (b - a), mid)
            order[lo:hi] = order[lo:hi][part]
            nodes[me][4] = grow(lo, lo + mid)
            nodes[me][5] = grow(lo + mid, hi)
        return me

    if len(x):
        grow(0, len(x))
    return {"order": order, "centre": np.array([n[0] for n in nodes]), "radius": np.array([n[1] for n in nodes]),
            "span": np.array([n[2:6] for n in nodes], dtype=np.int64)}


def search(tree: dict, x: np.ndarray, rids: np.ndarray, q: np.ndarray, q_rids: np.ndarray, kth: np.ndarray, k: int):
    """For every query its best ``k`` of the shard at least as good as ``kth``: scores and row ranks.

    The rows are sorted by id, so a smaller rank wins ties; ``rids`` are their row numbers, a query's own row is left out.
    """
    n, m = len(x), len(q)
    unit = 1 << max(1, (n - 1).bit_length())
    norms = np.sqrt((q.astype(np.float64) ** 2).sum(axis=1))
    qf, order, span = q.astype(np.float64), tree["order"], tree["span"]
    slack = 1e-9 * (1 + norms * np.abs(tree["centre"]).max()) * q.shape[1]
    bound = qf @ tree["centre"].T + norms[:, None] * tree["radius"][None, :] + slack[:, None]
    live = np.zeros((m, len(span)), dtype=bool)
    live[:, 0] = bound[:, 0] >= kth
    for v, (_, _, left, right) in enumerate(span):  # children come after their parent
        if left >= 0:
            for c in (left, right):
                live[:, c] = live[:, v] & (bound[:, c] >= kth)
    leaves = np.flatnonzero(span[:, 2] < 0)
    limit = np.where(live[:, leaves], bound[:, leaves], -np.inf)
    turn = np.argsort(-limit, axis=1, kind="stable")
    xf = [x[order[span[v, 0]:span[v, 1]]].astype(np.float64) for v in leaves]
    top = np.full((m, k), _NONE, dtype=np.int64)
    by_rid = np.argsort(rids)
    own = by_rid[np.minimum(np.searchsorted(rids, q_rids, sorter=by_rid), n - 1)]
    own = np.where(rids[own] == q_rids, own, -1)
    worst = kth.copy()
    active = np.arange(m)
    for r in range(len(leaves)):
        nxt = turn[active, r]
        ok = limit[active, nxt] >= worst[active]
        ok &= limit[active, nxt] > -np.inf
        active, nxt = active[ok], nxt[ok]
        if not len(active):
            break
        for leaf in np.unique(nxt):
            mine = active[nxt == leaf]
            rows = order[span[leaves[leaf], 0]:span[leaves[leaf], 1]]
            key = (qf[mine] @ xf[leaf].T).astype(np.int64) * unit + (unit - 1 - rows)[None, :]
            key[rows[None, :] == own[mine][:, None]] = _NONE
            both = np.concatenate([top[mine], key], axis=1)
            top[mine] = np.partition(both, both.shape[1] - k, axis=1)[:, both.shape[1] - k:]
        low = top[active].min(axis=1)
        worst[active] = np.where(low > _NONE, np.maximum(worst[active], np.floor_divide(low, unit)), worst[active])
    top = -np.sort(-top, axis=1)
    score = np.floor_divide(top, unit)
    rank = unit - 1 - (top - score * unit)
    return np.where(top > _NONE, score, 0), np.where(top > _NONE, rank, -1)


def _narrow(x: np.ndarray) -> np.ndarray:
    big = int(np.abs(x).max(initial=0))
    return x.astype(np.int8 if big < 128 else np.int16 if big < 1 << 15 else np.int32 if big < 1 << 31 else np.int64)


def _pack(rows: pd.DataFrame) -> pd.DataFrame:
    """A shard's rows with their tree, and its root ball."""
    rows = rows.sort_values(["id", "rid"])
    x = _narrow(np.array(rows["v"].tolist(), dtype=np.int64))
    tree = build_tree(x)
    data = pickle.dumps({"ids": rows["id"].values.astype(np.int64), "rids": rows["rid"].values.astype(np.int64), "x": x, "tree": tree}, protocol=5)
    return pd.DataFrame({"dim": [x.shape[1]], "shard": [rows["shard"].iloc[0]], "centre": [tree["centre"][0]], "radius": [tree["radius"][0]], "data": [data]})


def _plain(s: dict, rids: list, q: np.ndarray, k: int):
    """Products that doubles do not hold, with Python's integers."""
    for rid, v in zip(rids, q.tolist()):
        every = [(-sum(a * b for a, b in zip(v, w)), j, r) for j, w, r in zip(s["ids"].tolist(), s["x"].tolist(), s["rids"].tolist()) if r != rid]
        yield [(max(-(1 << 63), min((1 << 63) - 1, -p)), j, r) for p, j, r in sorted(every)[:k]]


def _answer(k: int):
    def answer(s: dict, rows: pd.DataFrame) -> pd.DataFrame:
        q = np.array(rows["v"].tolist(), dtype=np.int64)
        rids, ids = rows["rid"].to_numpy(np.int64), rows["id"].to_numpy(np.int64)
        kth = rows["kth"].to_numpy(np.float64)
        big = int(np.abs(s["x"].astype(np.int64)).max()) * int(np.abs(q).max()) * q.shape[1]
        if big >= _EXACT:
            found = [(a, b, j, r, p) for a, b, of in zip(rids.tolist(), ids.tolist(), _plain(s, rids.tolist(), q, k)) for p, j, r in of]
            return pd.DataFrame(found, columns=["query", "query_id", "id", "rid", "score"])
        score, rank = search(s["tree"], s["x"], s["rids"], q, rids, np.where(np.isnan(kth), -np.inf, kth), k)
        row, col = np.nonzero(rank >= 0)
        at = rank[row, col]
        return pd.DataFrame({"query": rids[row], "query_id": ids[row], "id": s["ids"][at], "rid": s["rids"][at], "score": score[row, col]})

    return answer


def top_k(df: DataFrame, queries: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: int = 64) -> DataFrame:
    """Rows ``(query_id, rank, vec_id, score)``: the ``k`` largest integer inner products of each query.

    Vectors become ``floor(scale * x)``.  Queries are the rows where ``queries`` holds; candidates are all other
    rows of the same length.  Rows are told apart by place, not by id: those that repeat an id are candidates and queries of
    their own.  Ties go to the smaller id.  Rows with a null id and vectors that are null, empty or have a null or non-finite
    component take no part.  Products over a long's range are held at its ends.  An empty table gives no rows.
    """
    taken = df.select(F.col(id_col).cast("long").alias("id"), quantised(F.col(vector_col), scale).alias("v"), F.coalesce(
        queries, F.lit(False)).alias("asks")).where("id is not null and v is not null")
    rows = staged(taken.select(F.monotonically_increasing_id().alias("rid"), "*", F.size("v").alias("dim")), "vectors")
    n, asked = rows.agg(F.count("*"), F.count_if("asks")).first()
    signs = F.aggregate(F.slice("v", 1, SIGNS), F.lit(0), lambda t, x: t * 2 + (x >= 0).cast("int"))
    dealt = staged(rows.withColumn("_cell", signs).repartitionByRange(max(1, -(-n // SHARD_ROWS)), "dim", "_cell", "rid").drop("_cell").withColumn(
        "shard", F.spark_partition_id().cast("long")), "dealt")
    shards = (dealt.agg(F.max("shard")).first()[0] or 0) + 1
    trees = staged(dealt.groupBy("dim", "shard").applyInPandas(_pack, "dim int, shard long, centre array<double>, radius double, data binary"), "trees")
    salts = max(1, -(-asked // PART_QUERIES))
    part = F.concat_ws(":", "dim", "shard", "salt").alias("part")
    balls = trees.drop("data")
    kept = trees.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).select(part, F.lit(0).cast("long").alias("rid"), "data")
    asks = dealt.where("asks").withColumn("salt", F.pmod(F.xxhash64("rid"), F.lit(salts)))
    schema = "query long, query_id long, id long, rid long, score long"

    def visit(asking: DataFrame) -> DataFrame:
        return met(kept, asking.select(part, "rid", "id", "v", "kth"), lambda own: pickle.loads(own["data"].iloc[0]), _answer(k), schema, BLOCK_QUERIES)

    home = staged(visit(asks.withColumn("kth", F.lit(None).cast("double"))), "home")
    # the k-th score of those that have so many already
    least = home.groupBy("query").agg(F.count("*").alias("_n"), F.min("score").alias("_kth")).where(F.col("_n") >= k).select(
        F.col("query").alias("rid"), F.col("_kth").cast("double").alias("kth"))
    others = asks.join(least, "rid", "left").withColumnRenamed("shard", "_home").withColumn(
        "shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")))).where("shard <> _home").join(balls, ["dim", "shard"])
    dot = F.aggregate(F.zip_with("v", "centre", lambda a, b: a * b), F.lit(0.0), lambda t, x: t + x)
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda t, x: t + x.cast("double") * x.cast("double")))
    slack = F.lit(1e-9) * (1 + norm * (F.array_max(F.transform("centre", lambda c: F.abs(c))) + F.col("radius"))) * F.col("dim")
    found = home.union(visit(others.where(F.col("kth").isNull() | (dot + norm * F.col("radius") + slack >= F.col("kth")))))
    w = Window.partitionBy("query").orderBy(F.col("score").desc(), "id", "rid")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score")
