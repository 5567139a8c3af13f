"""Approximate nearest neighbours: one robust-pruned directed graph per shard, searched with a beam.

Index.  Equal vectors are one node.  Nodes are dealt by hash to shards of about ``SHARD_NODES``.  Inside a shard
they are inserted in batches of doubling size: a greedy search from the entry point proposes a node's
neighbours, relaxed distance pruning keeps a candidate only if no kept one is nearer to it by the factor ``alpha``
(the kept edges point in different directions), and every kept edge is offered to its far end as well, which
prunes again if it has too many.  A second round over all nodes uses the finished graph.

Search.  Every query goes through every shard with a beam: the nearest open candidate is expanded until all
candidates in the beam are.  The shards' answers are ranked again by the distance of the original vectors in doubles.

The index is a table with one row for each node: ``shard, node, members, data, links``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import staged
from .streamed import met

SHARD_NODES = 4096
DEGREE, BUILD_BEAM, SEARCH_BEAM, ALPHA = 32, 64, 128, 1.2
#: Queries of a shard that one task handles, and those searched at once.
PART_ROWS, CHUNK = 65536, 128
_FAR = np.float32(np.inf)


class Graph:
    """Vectors of a shard and the directed edges between them; unused edge places hold -1."""

    def __init__(self, x: np.ndarray, links: np.ndarray | None = None, degree: int = DEGREE):
        # scaled by the usual size of a vector, so that single precision holds the distances; far outliers are held at its ends
        self.unit = float(np.median(np.abs(x).max(axis=1))) if len(x) else 1.0
        self.x = self.scaled(x)
        self.norm = np.einsum("ij,ij->i", self.x, self.x)
        self.links = np.full((len(self.x), degree), -1, dtype=np.int32) if links is None else links
        # the node nearest to the mean is where all searches begin
        self.entry = int(((self.x - self.x.mean(axis=0)) ** 2).sum(axis=1).argmin()) if len(self.x) else -1

    def scaled(self, x: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return np.clip(np.asarray(x, dtype=np.float64) / self.unit, -1e15, 1e15).astype(np.float32)

    def beam(self, q: np.ndarray, width: int, expand: int = 1):
        """Nodes and squared distances of the ``width`` best found for each scaled query, nearest first (-1: none)."""
        m, n = len(q), len(self.x)
        q2 = np.einsum("ij,ij->i", q, q)
        node = np.full((m, width), -1, dtype=np.int32)
        dist = np.full((m, width), _FAR, dtype=np.float32)
        done = np.ones((m, width), dtype=bool)
        node[:, 0], done[:, 0] = self.entry, False
        dist[:, 0] = self.norm[self.entry] - 2 * (q @ self.x[self.entry]) + q2
        seen = np.zeros((m, n), dtype=bool)
        seen[:, self.entry] = True
        stamp = np.zeros((m, n), dtype=np.int32)
        rows = np.arange(m)
        while len(rows):
            # the nearest open candidates come first in the sorted beam
            open_at = np.argsort(done[rows], axis=1, kind="stable")[:, :expand]
            here = rows[:, None]
            fresh = ~done[here, open_at]
            at = np.where(fresh, node[here, open_at], 0)
            done[here, open_at] = True
            next_ = np.where(fresh[:, :, None], self.links[at], -1).reshape(len(rows), -1)
            r, c = np.nonzero(next_ >= 0)
            v = next_[r, c]
            own = rows[r]
            new = ~seen[own, v]
            r, c, v, own = r[new], c[new], v[new], own[new]
            stamp[own, v] = c
            first = stamp[own, v] == c  # one of several equal neighbours
            r, c, v, own = r[first], c[first], v[first], own[first]
            seen[own, v] = True
            far = np.full(next_.shape, _FAR, dtype=np.float32)
            far[r, c] = self.norm[v] - 2 * np.einsum("ij,ij->i", q[own], self.x[v]) + q2[own]
            d = np.concatenate([dist[rows], far], axis=1)
            best = np.argpartition(d, width - 1, axis=1)[:, :width]
            turn = np.argsort(np.take_along_axis(d, best, axis=1), axis=1, kind="stable")
            best = np.take_along_axis(best, turn, axis=1)
            dist[rows] = np.take_along_axis(d, best, axis=1)
            both = np.concatenate([node[rows], next_], axis=1)
            shut = np.concatenate([done[rows], far == _FAR], axis=1)
            shut[:, :width] |= node[rows] < 0
            got = np.take_along_axis(both, best, axis=1)
            node[rows] = np.where(dist[rows] < _FAR, got, -1)
            done[rows] = np.take_along_axis(shut, best, axis=1)
            rows = rows[~done[rows].all(axis=1)]
        return node, dist

    def prune(self, of: np.ndarray, cand: np.ndarray, alpha: float) -> np.ndarray:
        """Edges kept for each node of ``of`` out of its candidates (-1: none): the nearest one, then the nearest
        that no kept one is closer to by ``alpha``, and so on."""
        degree = self.links.shape[1]
        cand = np.where(cand == of[:, None], -1, cand)
        cand = -np.sort(-cand, axis=1)
        cand[:, 1:][cand[:, 1:] == cand[:, :-1]] = -1
        x = self.x[cand]
        d = self.norm[cand] - 2 * np.einsum("bcd,bd->bc", x, self.x[of]) + self.norm[of][:, None]
        d = np.where(cand >= 0, np.maximum(d, 0), _FAR)
        turn = np.argsort(d, axis=1, kind="stable")
        cand, d = np.take_along_axis(cand, turn, axis=1), np.take_along_axis(d, turn, axis=1)
        x = np.take_along_axis(x, turn[:, :, None], axis=1)
        between = self.norm[cand][:, :, None] + self.norm[cand][:, None, :] - 2 * np.matmul(x, x.transpose(0, 2, 1))
        alive = cand >= 0
        kept = np.full((len(of), degree), -1, dtype=np.int32)
        row = np.arange(len(of))
        for k in range(degree):
            pick = alive.argmax(axis=1)
            some = alive[row, pick]
            if not some.any():
                break
            kept[some, k] = cand[row, pick][some]
            alive &= ~((alpha * alpha * between[row, pick] <= d) & some[:, None])
            alive[row, pick] = False
        return kept

    def link(self, of: np.ndarray, beam: int, alpha: float) -> None:
        """Propose, prune and set the edges of ``of``, then offer them to their far ends."""
        found, _ = self.beam(self.x[of], beam, 2)
        kept = self.prune(of, np.concatenate([found, self.links[of]], axis=1), alpha)
        self.links[of] = kept
        a, k = np.nonzero(kept >= 0)
        head, tail = kept[a, k], of[a].astype(np.int32)
        turn = np.argsort(head, kind="stable")
        head, tail = head[turn], tail[turn]
        ends, first, count = np.unique(head, return_index=True, return_counts=True)
        for lo in range(0, len(ends), 256):
            e, f, c = ends[lo:lo + 256], first[lo:lo + 256], count[lo:lo + 256]
            own = np.full((len(e), int(c.max())), -1, dtype=np.int32)
            r = np.repeat(np.arange(len(e)), c)
            p = np.arange(len(r)) - np.repeat(np.cumsum(c) - c, c)
            own[r, p] = tail[np.repeat(f, c) + p]
            both = np.concatenate([self.links[e], own], axis=1)
            room = (both >= 0).sum(axis=1) <= self.links.shape[1]
            easy = -np.sort(-both, axis=1)
            easy[:, 1:][easy[:, 1:] == easy[:, :-1]] = -1
            easy = -np.sort(-easy, axis=1)[:, :self.links.shape[1]]
            self.links[e[room]] = easy[room]
            if (~room).any():
                self.links[e[~room]] = self.prune(e[~room], both[~room], alpha)

    def build(self, beam: int = BUILD_BEAM, alpha: float = ALPHA, batch: int = 256, seed: int = 42) -> Graph:
        order = np.random.default_rng(seed).permutation(len(self.x))
        order = np.concatenate([[self.entry], order[order != self.entry]]) if len(order) else order
        at = 1
        while at < len(order):
            step = min(batch, at)
            self.link(order[at:at + step], beam, 1.0)
            at += step
        for lo in range(0, len(order), batch):
            self.link(order[lo:lo + batch], beam, alpha)
        return self


def usable(vector: Column) -> Column:
    """The components as doubles; null for vectors that take no part: null, empty or zero ones, and those with a null or
    non-finite component."""
    whole = F.transform(vector, lambda x: x.cast("double"))
    bad = F.exists(whole, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when((F.size(vector) > 0) & ~bad & F.exists(whole, lambda x: x != 0), whole)


def _matrix(data) -> np.ndarray:
    return np.frombuffer(b"".join(data), dtype="<f8").reshape(len(data), -1)


def _build(degree: int, beam: int, alpha: float):
    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("first").reset_index(drop=True)
        x = np.stack(rows["v"].tolist()).astype("<f8")
        graph = Graph(x, degree=degree).build(beam, alpha)
        return pd.DataFrame({"dim": rows["dim"], "shard": rows["shard"], "node": np.arange(len(rows), dtype=np.int64), "members": rows["members"],
                             "member_rids": rows["member_rids"], "data": [v.tobytes() for v in x], "links": list(graph.links)})

    return build


def build_index(vectors: DataFrame, keep: int, shard_nodes: int = SHARD_NODES, degree: int = DEGREE, beam: int = BUILD_BEAM,
                alpha: float = ALPHA) -> DataFrame:
    """The index of ``vectors`` ``(rid, id, dim, v)``: a row for each different vector, with its shard, its place there, its edges
    and the ``keep`` smallest of the ids that have it (enough for searches of ``keep - 1`` neighbours)."""
    order = Window.partitionBy("v").orderBy("id", "rid")
    # a vector that many rows share is cut down to `keep` rows before it is shuffled
    nodes = staged(vectors.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= keep).groupBy("v").agg(
        F.first("dim").alias("dim"), F.sort_array(F.collect_list(F.struct("id", "rid"))).alias("m")).select(
        "dim", "v", F.col("m")[0]["rid"].alias("first"), F.col("m.id").alias("members"), F.col("m.rid").alias("member_rids")), "nodes")
    shards = max(1, -(-nodes.count() // shard_nodes))
    return staged(nodes.withColumn("shard", F.pmod(F.xxhash64("v"), F.lit(shards))).groupBy("dim", "shard").applyInPandas(
        _build(degree, beam, alpha), "dim int, shard long, node long, members array<long>, member_rids array<long>, data binary, links array<int>"), "graph")


def _open(rows: pd.DataFrame) -> dict:
    rows = rows.sort_values("node")
    x = _matrix(rows["data"].tolist())
    return {"x": x, "graph": Graph(x, np.stack(rows["links"].tolist()).astype(np.int32)), "members": rows["members"].tolist(), "rids": rows["member_rids"].tolist()}


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows; scaled where squares would leave the doubles' range."""
    off = np.abs(a - b)
    most = off.max(axis=1, initial=0)
    plain = (most < 1e150) & (most > 1e-150) | (most == 0)
    unit = np.where(plain, 1.0, most)
    return np.sqrt(((off / unit[:, None]) ** 2).sum(axis=1)) * unit


def _search(k: int, width: int):
    def answer(s: dict, rows: pd.DataFrame) -> pd.DataFrame:
        q = _matrix(rows["data"].tolist())
        node, _ = s["graph"].beam(s["graph"].scaled(q), max(width, k + 1), 2)
        out = []
        for i, (rid, query) in enumerate(zip(rows["rid"], rows["id"])):
            found = node[i][node[i] >= 0]
            d = _distance(s["x"][found], q[i][None, :])
            best = np.argsort(d, kind="stable")
            # all nodes as near as the last one counted: equal distances go by id
            best = best[d[best] <= d[best[min(k, len(best) - 1)]]] if len(best) else best
            near = sorted((d[b], j, r) for b in best for j, r in zip(s["members"][found[b]], s["rids"][found[b]]) if r != rid)[:k]
            out += [(rid, query, j, r, x) for x, j, r in near]
        return pd.DataFrame(out, columns=["query", "query_id", "id", "rid", "score"])

    return answer


def nearest(df: DataFrame, queries: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", width: int = SEARCH_BEAM,
            shard_nodes: int = SHARD_NODES, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA) -> DataFrame:
    """Rows ``(query_id, rank, vec_id, score)``: each query's ``k`` nearest rows found, by Euclidean distance in doubles.

    Queries are the rows where ``queries`` holds; candidates are all rows of the same length but the query's own (rows that
    repeat an id or a vector are candidates).  Ties go to the smaller id.  Rows with a null id, and vectors that are null, empty,
    zero or have a null or non-finite component, take no part.  An empty table gives no rows.  ``width`` is the
    beam: more of it finds more of the true neighbours.
    """
    taken = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(queries, F.lit(False)).alias("asks"), usable(F.col(vector_col)).alias("v")).where(
        "id is not null and v is not null")
    rows = staged(taken.select(F.monotonically_increasing_id().alias("rid"), "*", F.size("v").alias("dim")), "vectors")
    index = build_index(rows.select("rid", "id", "dim", "v"), k + 1, shard_nodes, degree, beam, alpha)
    shards, asked = (index.agg(F.max("shard")).first()[0] or 0) + 1, rows.where("asks").count()
    salts = max(1, -(-asked // PART_ROWS))
    part = F.concat_ws(":", "dim", "shard", "salt")
    kept = index.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).select(
        part.alias("part"), "node", "members", "member_rids", "data", "links")

    def as_bytes(batches):
        for b in batches:
            yield pd.DataFrame({"rid": b["rid"], "id": b["id"], "dim": b["dim"], "data": [np.asarray(v, dtype="<f8").tobytes() for v in b["v"]]})

    asking = rows.where("asks").select("rid", "id", "dim", "v").mapInPandas(as_bytes, "rid long, id long, dim int, data binary").withColumn(
        "salt", F.pmod(F.xxhash64("rid"), F.lit(salts))).withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")))).select(
        part.alias("part"), F.col("rid").alias("node"), "rid", "id", "data")
    found = met(kept, asking, _open, _search(k, width), "query long, query_id long, id long, rid long, score double", CHUNK, "node")
    order = Window.partitionBy("query").orderBy("score", "id", "rid")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score")
