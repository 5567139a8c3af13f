"""Balanced shards of indivisible groups by Karmarkar-Karp differencing.

A partial partition is a vector of bin sums.  Differencing takes the two partial
partitions of the largest spread (largest minus smallest bin) and adds them in opposite
order, largest bin to smallest; the last one left is the partition.  Groups are hashed
into blocks of bounded size; each task differences one block down to one partial
partition, and the blocks' partial partitions are differenced again, level by level,
until one is left.  Only bin sums go up, and only bin renamings come down.
"""

from __future__ import annotations

import heapq
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import staged

#: Groups (first level) or partial partitions (other levels) that one task differences.
BLOCK_GROUPS, BLOCK_PARTS = 4096, 1024
#: Rows that one window numbers when slots are dealt.
SLOT_ROWS = 8192


def difference(sums: list[list[int]]) -> list[list[int]]:
    """Of each partial partition, the final bin of each of its bins."""
    k = len(sums[0])
    made: list[tuple] = []  # (left, right, bins of the left, bins of the right)
    n = len(sums)
    heap = []
    for i, s in enumerate(sums):
        order = sorted(range(k), key=lambda b: (-s[b], b))
        ranked = [s[b] for b in order]
        heap.append((ranked[-1] - ranked[0], i, ranked, order))
    heapq.heapify(heap)
    orders = {i: order for _, i, _, order in heap}
    while len(heap) > 1:
        _, i, a, _ = heapq.heappop(heap)
        _, j, b, _ = heapq.heappop(heap)
        total = [x + y for x, y in zip(a, reversed(b))]
        order = sorted(range(k), key=lambda x: (-total[x], x))
        ranked = [total[x] for x in order]
        made.append((i, j))
        orders[n + len(made) - 1] = order
        heapq.heappush(heap, (ranked[-1] - ranked[0], n + len(made) - 1, ranked, None))
    # ranked bin r of the last partition is final bin r; go down from there
    final: dict[int, list[int]] = {heap[0][1]: list(range(k))}
    for t in range(len(made) - 1, -1, -1):
        own, order = final.pop(n + t), orders[n + t]
        at = [0] * k  # unranked bin -> final bin
        for r, x in enumerate(order):
            at[x] = own[r]
        i, j = made[t]
        final[i], final[j] = at, at[::-1]
    out = []
    for i in range(n):
        own, order = final[i], orders[i]
        at = [0] * k
        for r, x in enumerate(order):
            at[x] = own[r]
        out.append(at)
    return out


def _first_level(shards: int):
    def place(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["bytes", "grp"], ascending=[False, True])
        bins = difference([[int(b)] + [0] * (shards - 1) for b in pdf["bytes"]])
        return pd.DataFrame({"grp": pdf["grp"].values, "block": pdf["block"].values, "bin": [b[0] for b in bins], "bytes": pdf["bytes"].values})

    return place


def _next_level():
    def place(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block")
        bins = difference([[int(x) for x in s] for s in pdf["sums"]])
        k = len(bins[0])
        return pd.DataFrame({"block": pdf["block"].repeat(k).values, "bin": [b for _ in bins for b in range(k)],
                             "up": pdf["up"].repeat(k).values, "to": [x for b in bins for x in b],
                             "bytes": [int(x) for s in pdf["sums"] for x in s]})

    return place


def balanced_groups(groups: DataFrame, shards: int) -> DataFrame:
    """Rows ``(grp, shard)`` of groups ``(grp, bytes)``, each of one row."""
    n = groups.count()
    blocks = max(1, -(-n // BLOCK_GROUPS))
    placed = staged(groups.withColumn("block", F.pmod(F.xxhash64("grp"), F.lit(blocks))).groupBy("block").applyInPandas(
        _first_level(shards), "grp binary, block long, bin int, bytes long"), "kk")
    sums, maps = placed.groupBy("block", "bin").agg(F.sum("bytes").alias("bytes")), []
    while blocks > 1:
        blocks = -(-blocks // BLOCK_PARTS)
        parts = sums.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("bin", "bytes"))).alias("m")).select(
            "block", F.array(*[F.coalesce(F.try_element_at("m", F.lit(b)), F.lit(0)).cast("long") for b in range(shards)]).alias("sums"),
            F.floor(F.col("block") / BLOCK_PARTS).alias("up"))
        up = staged(parts.groupBy("up").applyInPandas(_next_level(), "block long, bin int, up long, to int, bytes long"), "kk-up")
        maps.append(up)
        sums = up.groupBy(F.col("up").alias("block"), F.col("to").alias("bin")).agg(F.sum("bytes").alias("bytes"))
    # bins are renamed from the top down, on the small tables
    if not maps:
        return placed.select("grp", F.col("bin").alias("shard"))
    rename = reduce(lambda top, m: m.join(top.select(F.col("block").alias("up"), F.col("bin").alias("to"), F.col("shard")), ["up", "to"]).select(
        "block", "bin", "shard"), reversed(maps[:-1]), maps[-1].select("block", "bin", F.col("to").alias("shard")))
    return placed.join(rename, ["block", "bin"]).select("grp", "shard")


def text_key(text: Column) -> Column:
    """256-bit digest that stands for a text; null and empty texts are the same."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def shard_by_bytes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 16) -> DataFrame:
    """Rows ``(id_col, size, text_crc32, shard, slot)``, one per row of ``df``.

    Shard sizes are near equal in bytes; equal texts share a shard (a null text counts
    as empty).  ``size`` is the UTF-8 bytes plus 1.  ``slot`` numbers each shard's rows from 0
    without gaps, in an order of hashed ids.  Rows that repeat are rows of their own.
    One group larger than a shard's share keeps its shard to itself, as far as it can.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    docs = staged(df.select(F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                            F.crc32(text.cast("binary")).alias("text_crc32"), text_key(F.col(text_col)).alias("grp")), "sizes")
    placed = balanced_groups(docs.groupBy("grp").agg(F.sum("size").alias("bytes")), shards)
    rows = docs.join(placed, "grp").select("id", "size", "text_crc32", F.col("shard").cast("int").alias("shard"), F.hex("grp").alias("grp"))
    n = docs.count()
    subs = max(1, -(-n // (SLOT_ROWS * shards)))
    rows = staged(rows.withColumn("sub", F.pmod(F.xxhash64("id", "grp"), F.lit(subs))), "sharded")
    # a text with very many copies under one id would fill a sub-range; ids are distinct in all but odd tables
    before = Window.partitionBy("shard").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)
    base = rows.groupBy("shard", "sub").agg(F.count("*").alias("c")).withColumn(
        "base", F.coalesce(F.sum("c").over(before), F.lit(0))).drop("c")
    own = Window.partitionBy("shard", "sub").orderBy("id", "grp")
    return rows.withColumn("r", F.row_number().over(own) - 1).join(F.broadcast(base) if subs * shards <= 100_000 else base, ["shard", "sub"]).select(
        F.col("id").alias(id_col), "size", "text_crc32", "shard", (F.col("base") + F.col("r")).cast("long").alias("slot"))
