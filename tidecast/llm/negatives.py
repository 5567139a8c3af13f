"""Hard negatives by segment summaries.

A vector is cut into segments of 16 and of 4 components.  With the mean m and the deviation d of a segment of length L,
the product of two segments lies within ``L (m m' - d d')`` and ``L (m m' + d d')``; the sums over the segments bound the
score.  An anchor meets a shard of candidates in three steps: bounds from the long segments, bounds from the short
segments for the candidates that are left, exact integer products for the rest.

1. Positives.  An anchor visits the shards that hold its label.  The k-th largest lower bound drops every candidate
   whose upper bound is below it.
2. Negatives.  Each positive asks for the best scores within an interval.  Shards whose envelope of summaries cannot
   reach the anchor's intervals are not visited, candidates whose bounds do not are dropped.

Rows are ordered by label and by the signs of their long segments' means before they are cut into shards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import staged
from .streamed import met
from .topk import quantised

LONG, SHORT = 16, 4
#: Rows of a shard: as few as keep ``SHARDS`` of them, between these bounds.
LEAST_ROWS, MOST_ROWS, SHARDS = 2048, 65536, 64
#: Asking rows of a shard that one task handles, and those multiplied at once.
PART_ROWS, CHUNK = 65536, 64
#: Sums of products below this are exact in doubles.
_EXACT = 1 << 53


def summaries(x: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations of the segments, each times the root of the length, so that plain products bound scores."""
    parts = x.reshape(len(x), -1, length).astype(np.float64)
    mean = parts.mean(axis=2)
    # the deviation from the mean as rounded, so that the bounds hold
    dev = np.sqrt(((parts - mean[:, :, None]) ** 2).mean(axis=2))
    root = np.sqrt(length)
    return mean * root, dev * root


def _summarise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Padded components as bytes, the long segments' means and deviations, and the signs of the means."""
    for batch in batches:
        data, means, devs, cells = [], [], [], []
        for v in batch["v"]:
            x = np.zeros((1, -(-len(v) // LONG) * LONG), dtype=np.int64)
            x[0, :len(v)] = v
            mean, dev = summaries(x, LONG)
            data.append(x.tobytes())
            means.append(mean[0])
            devs.append(dev[0])
            cells.append(int("".join("1" if s else "0" for s in (mean[0, :16] > 0)), 2))
        yield pd.DataFrame({"rid": batch["rid"], "id": batch["id"], "label": batch["label"], "asks": batch["asks"],
                            "dim": batch["dim"], "data": data, "mean": means, "dev": devs, "cell": cells})


def _matrix(data) -> np.ndarray:
    return np.frombuffer(b"".join(data), dtype="<i8").reshape(len(data), -1)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    most = max(1, int(np.abs(a.astype(np.float64)).max(initial=0))) * max(1, int(np.abs(b.astype(np.float64)).max(initial=0)))
    if most * a.shape[1] * 2 < _EXACT:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    whole = a.astype(object) @ b.T.astype(object)  # Python's integers, held at the ends of a long
    return np.minimum(np.maximum(whole, -(1 << 63)), (1 << 63) - 1).astype(np.int64)


def _prepare(rows: pd.DataFrame) -> dict:
    rows = rows.sort_values(["id", "rid"], kind="stable")
    x = _matrix(rows["data"].tolist())
    f = x.astype(np.float64)
    return {"id": rows["id"].to_numpy(np.int64), "rid": rows["rid"].to_numpy(np.int64), "label": rows["label"].to_numpy(np.int64),
            "x": x, "levels": [summaries(x, LONG), summaries(x, SHORT)], "norm": np.sqrt((f * f).sum(axis=1))}


def _bounds(a, s: dict, level: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the scores of anchors with the candidates ``at``."""
    (am, ad), (cm, cd) = a["levels"][level], s["levels"][level]
    mid, off = am @ cm[at].T, ad @ cd[at].T
    off += 1e-9 * np.outer(a["norm"], s["norm"][at]) + 1e-9
    return mid - off, mid + off


def _best(row: np.ndarray, col: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of each row's ``k`` highest scores, ties to the smaller column."""
    turn = np.lexsort((col, -score, row))
    r = row[turn]
    start = np.flatnonzero(np.concatenate(([True], r[1:] != r[:-1]))) if len(r) else np.zeros(0, dtype=int)
    place = np.arange(len(r)) - np.repeat(start, np.diff(np.append(start, len(r))))
    return turn[place < k]


def _positives(k: int):
    def answer(s: dict, rows: pd.DataFrame) -> pd.DataFrame:
        a = _prepare(rows)
        alive = (a["label"][:, None] == s["label"][None, :]) & (a["rid"][:, None] != s["rid"][None, :])
        for level in (0, 1):
            at = np.flatnonzero(alive.any(axis=0))
            low, high = _bounds(a, s, level, at)
            if len(at) > k:
                low = np.where(alive[:, at], low, -np.inf)
                least = np.partition(low, len(at) - k, axis=1)[:, len(at) - k]
                alive[:, at] &= high >= least[:, None]
        at = np.flatnonzero(alive.any(axis=0))
        score = _products(a["x"], s["x"][at])
        row, col = np.nonzero(alive[:, at])
        best = _best(row, col, score[row, col], k)
        row, col = row[best], col[best]
        return pd.DataFrame({"anchor": a["rid"][row], "anchor_id": a["id"][row], "rid": s["rid"][at][col], "id": s["id"][at][col],
                             "score": score[row, col]})

    return answer


def _negatives(k: int):
    def answer(s: dict, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["id", "rid"], kind="stable")
        a = _prepare(rows)
        spans = [[(int(w["lo"]), int(w["hi"]), int(w["slot"])) for w in of] for of in rows["wants"]]
        least = np.array([min(w[0] for w in of) for of in spans], dtype=np.float64)
        most = np.array([max(w[1] for w in of) for of in spans], dtype=np.float64)
        alive = a["label"][:, None] != s["label"][None, :]
        for level in (0, 1):
            at = np.flatnonzero(alive.any(axis=0))
            low, high = _bounds(a, s, level, at)
            alive[:, at] &= (high >= least[:, None]) & (low <= most[:, None])
        at = np.flatnonzero(alive.any(axis=0))
        score = _products(a["x"], s["x"][at])
        row, col = np.nonzero(alive[:, at])
        value = score[row, col]
        turn = np.lexsort((col, -value, row))
        row, col, value = row[turn], col[turn], value[turn]
        edge = np.searchsorted(row, np.arange(len(spans) + 1))
        out = []
        for i, of in enumerate(spans):
            own = value[edge[i]:edge[i + 1]]
            for lo, hi, slot in of:
                first = int(np.searchsorted(-own, -hi, side="left"))
                for j in range(first, min(first + k, len(own))):
                    if own[j] < lo:
                        break
                    c = at[col[edge[i] + j]]
                    out.append((a["rid"][i], slot, s["rid"][c], s["id"][c], own[j]))
        return pd.DataFrame(out, columns=["anchor", "slot", "rid", "id", "score"])

    return answer


def _envelope(rows: pd.DataFrame) -> pd.DataFrame:
    """Range of the means and greatest deviations over a shard's rows, by long segment."""
    mean, dev = np.stack(rows["mean"].tolist()), np.stack(rows["dev"].tolist())
    norm = np.sqrt((mean ** 2 + dev ** 2).sum(axis=1)).max()
    return pd.DataFrame({"dim": [rows["dim"].iloc[0]], "shard": [rows["shard"].iloc[0]], "low": [mean.min(axis=0)], "high": [mean.max(axis=0)],
                         "wide": [dev.max(axis=0)], "norm": [norm]})


def _reach(sign: int) -> Column:
    """Largest (1) or smallest (-1) score that the anchor may have with any row of the shard."""
    pick = F.greatest if sign > 0 else F.least
    parts = F.arrays_zip("mean", "dev", "low", "high", "wide")
    return F.aggregate(parts, F.lit(0.0), lambda t, p: t + pick(p["mean"] * p["low"], p["mean"] * p["high"]) + sign * p["dev"] * p["wide"])


def hard_negatives(df: DataFrame, anchors: Column, label: Column, positives: int = 5, negatives: int = 3, lower: int = 50, upper: int = 95,
                   id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """Rows ``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    A score is the integer inner product of the vectors ``floor(scale * x)``.  ``anchors`` says which rows are anchors, ``label``
    gives the (whole-numbered) label.  An anchor's positives are its best ``positives`` other rows of its label; for each
    positive of score p the best ``negatives`` rows of other labels with a score s such that ``lower * p <= 100 * s <= upper * p``
    are returned.  Ties go to the smaller id.  Rows with a null id, label or vector, an empty vector, or a null or non-finite
    component take no part.  Rows are told apart by place, not by id: rows that repeat an id are candidates
    and anchors of their own.  Vectors of another length are no candidates.  Scaled components and scores beyond a long are
    held at its ends.  Anchors without a positive, and positives without a negative, give no rows.
    """
    spark = df.sparkSession
    taken = df.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), F.coalesce(anchors, F.lit(False)).alias("asks"),
                      quantised(F.col(vector_col), scale).alias("v")).where("id is not null and label is not null and v is not null")
    numbered = taken.select(F.monotonically_increasing_id().alias("rid"), "*", F.size("v").alias("dim"))
    rows = staged(numbered.mapInPandas(_summarise, "rid long, id long, label long, asks boolean, dim int, data binary, "
                                       "mean array<double>, dev array<double>, cell long"), "rows")
    n, asked = rows.agg(F.count("*"), F.count_if("asks")).first()
    shards = max(1, -(-n // MOST_ROWS), min(SHARDS, -(-n // LEAST_ROWS)))
    dealt = staged(rows.repartitionByRange(shards, "dim", "label", "cell", "rid").withColumn("shard", F.spark_partition_id().cast("long")), "dealt")
    shards = (dealt.agg(F.max("shard")).first()[0] or 0) + 1
    salts = max(1, -(-asked // PART_ROWS))
    part = F.concat_ws(":", "dim", "shard", "salt")
    kept = dealt.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).select(part.alias("part"), "rid", "id", "label", "data")
    asking = dealt.where("asks").withColumn("salt", F.pmod(F.xxhash64("rid"), F.lit(salts))).drop("shard")

    # the shards that hold an anchor's label lie side by side
    span = dealt.groupBy("dim", "label").agg(F.min("shard").alias("lo"), F.max("shard").alias("hi"))
    first = asking.join(span, ["dim", "label"]).withColumn("shard", F.explode(F.sequence("lo", "hi"))).select(
        part.alias("part"), "rid", "id", "label", "data")
    found = met(kept, first, _prepare, _positives(positives), "anchor long, anchor_id long, rid long, id long, score long", CHUNK)
    order = Window.partitionBy("anchor").orderBy(F.col("score").desc(), "id", "rid")
    best = staged(found.withColumn("slot", F.row_number().over(order)).where(F.col("slot") <= positives), "positives")

    low = F.ceil(F.col("score").cast("decimal(38,0)") * lower / 100).cast("decimal(20,0)")
    high = F.floor(F.col("score").cast("decimal(38,0)") * upper / 100).cast("decimal(20,0)")
    wants = best.select("anchor", "slot", low.cast("long").alias("lo"), high.cast("long").alias("hi")).where("lo <= hi").groupBy(
        F.col("anchor").alias("rid")).agg(F.collect_list(F.struct("lo", "hi", "slot")).alias("wants"))
    envelopes = staged(dealt.groupBy("dim", "shard").applyInPandas(
        _envelope, "dim int, shard long, low array<double>, high array<double>, wide array<double>, norm double"), "envelopes")
    slack = F.sqrt(F.aggregate(F.arrays_zip("mean", "dev"), F.lit(0.0), lambda t, p: t + p["mean"] * p["mean"] + p["dev"] * p["dev"])) * F.col("norm") * 1e-9 + 1e-9
    second = asking.join(wants, "rid").withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")))).join(
        envelopes, ["dim", "shard"]).where((_reach(1) + slack >= F.array_min(F.col("wants.lo"))) & (_reach(-1) - slack <= F.array_max(F.col("wants.hi")))).select(
        part.alias("part"), "rid", "id", "label", "data", "wants")
    got = met(kept, second, _prepare, _negatives(negatives), "anchor long, slot int, rid long, id long, score long", CHUNK)
    order = Window.partitionBy("anchor", "slot").orderBy(F.col("score").desc(), "id", "rid")
    ranked = got.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives).select(
        "anchor", "slot", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return best.select("anchor", "slot", "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")).join(
        ranked, ["anchor", "slot"]).select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
