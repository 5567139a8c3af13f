"""SimHash near-duplicates: segment-popcount embedding and a grid range join.

A fingerprint is cut into 32 segments of two bits; the vector of their popcounts
(0..2 each) is its embedding.  The Manhattan distance of two embeddings never
exceeds the Hamming distance of the fingerprints.  The 32 coordinates are cut into
``max_distance + 2`` blocks; within Manhattan distance ``max_distance`` at least two
blocks are equal, so the grid cells are the pairs of blocks, and a range join only
compares fingerprints that share a cell: first by Manhattan distance, then exactly.

Cells with more than ``CELL_ROWS`` fingerprints are not compared pairwise.  Their
fingerprints emit every value within ``ceil(max_distance / 2)`` bit flips; two
fingerprints within the distance always share such a value, and a value has at most
65 (for 2 bits) fingerprints around it, so the work stays linear however large the cell.
"""

from __future__ import annotations

from functools import partial
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, staged

#: Pairs inside a cell are compared directly up to this many fingerprints.
CELL_ROWS = 256
_ODD = 0x5555555555555555


def _hash_text(raw: bytes, shingle: int) -> int:
    import xxhash

    words = raw.lower().split()  # bytes: lower-cases A-Z, splits at ASCII white space only
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    n = max(1, len(words) - shingle + 1)
    h = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=42), grams), dtype="<u8", count=n)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, n, 65536):  # a very long text never needs more than 4 MB of bits
        bits = np.unpackbits(h[i:i + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprint(text: Column, shingle: int = 3) -> Column:
    """64-bit SimHash of the word shingles of ``text`` as a signed long.

    Null, empty and word-less texts give 0; fewer words than ``shingle`` give one
    shingle of all words; repeated shingles count as often as they occur.
    """
    @F.pandas_udf("long")
    def simhash(raw: pd.Series) -> pd.Series:
        return pd.Series([_hash_text(r, shingle) if r else 0 for r in raw], dtype="int64")

    return simhash(text.cast("binary"))


def _embedding(fp: Column) -> Column:
    """The 32 popcounts of two-bit segments, packed two bits each."""
    low = fp.bitwiseAND(F.lit(_ODD))
    high = F.shiftrightunsigned(fp, 1).bitwiseAND(F.lit(_ODD))
    return low.bitwiseXOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))


def _manhattan(a: Column, b: Column) -> Column:
    """Of two packed embeddings: lanes differ by 1 where the low bits differ, else by 2."""
    x = a.bitwiseXOR(b)
    odd = x.bitwiseAND(F.lit(_ODD))
    two = F.shiftrightunsigned(x, 1).bitwiseAND(F.lit(_ODD)).bitwiseAND(F.bitwise_not(odd))
    return F.bit_count(odd) + 2 * F.bit_count(two)


def _cells(fps: DataFrame, max_distance: int) -> DataFrame:
    """One row ``(fp, cell)`` for each pair of blocks."""
    lanes = np.array_split(np.arange(32), max_distance + 2)
    keys = []
    for k, pair in enumerate(combinations(lanes, 2)):
        mask = sum(3 << int(2 * i) for lane in pair for i in lane)
        mask -= (mask >> 63) << 64
        keys.append(F.xxhash64(F.lit(k), F.col("e").bitwiseAND(F.lit(mask))))
    return fps.withColumn("e", _embedding(F.col("fp"))).select("fp", F.explode(F.array(*keys)).alias("cell"))


def _forest(max_distance: int):
    """Of each row's fingerprints, the verified links of a spanning forest."""
    odd = np.uint64(_ODD)

    def embed(x):
        low, high = x & odd, (x >> np.uint64(1)) & odd
        return (low ^ high) | ((low & high) << np.uint64(1))

    def links(batches):
        for pdf in batches:
            src, dst = [], []
            for m in pdf["members"]:
                x = np.asarray(m, dtype=np.int64).view(np.uint64)
                e, todo = embed(x), np.ones(len(x), dtype=bool)
                for i in range(len(x)):
                    if not todo[i]:
                        continue
                    todo[i], queue = False, [i]
                    while queue:
                        j = queue.pop()
                        rest = np.flatnonzero(todo)
                        d = e[rest] ^ e[j]
                        near = d & odd
                        far = (d >> np.uint64(1)) & odd & ~near
                        bound = np.bitwise_count(near).astype(int) + 2 * np.bitwise_count(far).astype(int)
                        rest = rest[bound <= max_distance]
                        rest = rest[np.bitwise_count(x[rest] ^ x[j]) <= max_distance]
                        todo[rest] = False
                        src += [int(x[j].view(np.int64))] * len(rest)
                        dst += x[rest].view(np.int64).tolist()
                        queue += rest.tolist()
            yield pd.DataFrame({"src": np.array(src, dtype=np.int64), "dst": np.array(dst, dtype=np.int64)})

    return links


def links(fps: DataFrame, max_distance: int = 2, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Links ``(src, dst)`` that connect all of the distinct fingerprints ``fp`` within
    ``max_distance`` bits; inside a cell only a spanning forest is given."""
    cells = _cells(fps, max_distance)
    stats = staged(cells.groupBy("cell").agg(
        F.count("*").alias("n"), F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("n > 1"), "cells")
    two = stats.where("n = 2").where(
        _manhattan(_embedding(F.col("lo")), _embedding(F.col("hi"))) <= max_distance).where(
        F.bit_count(F.col("lo").bitwiseXOR(F.col("hi"))) <= max_distance).select("lo", "hi").toDF("src", "dst")
    of = lambda c: cells.join(stats.where(c).select("cell"), "cell")
    # grouped by another expression of the cell, so that the join is a stage whose skew Spark may split
    mid = of(f"n between 3 and {cell_rows}").groupBy(F.xxhash64("cell").alias("c")).agg(
        F.collect_set("fp").alias("members")).select("members")
    around = of(f"n > {cell_rows}").select("fp").distinct().withColumn("key", F.col("fp"))
    flips = F.array(F.col("key"), *[F.col("key").bitwiseXOR(F.lit((1 << i) - ((1 << 64) if i == 63 else 0))) for i in range(64)])
    for _ in range((max_distance + 1) // 2):
        around = around.select("fp", F.explode(flips).alias("key")).distinct()
    crowd = around.groupBy("key").agg(F.collect_list("fp").alias("members")).where("size(members) > 1").select("members")
    many = mid.union(crowd).mapInPandas(_forest(max_distance), "src long, dst long")
    return two.union(many)


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    max_distance: int = 2, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Rows ``(id_col, fp, component)``: one per row of ``df``.

    ``fp`` is the signed fingerprint, ``component`` the smallest id that links of at
    most ``max_distance`` differing bits reach.  Repeated rows and rows that share an
    id are kept as they come; a null id is never the smallest unless all are null.
    An empty table gives no rows.
    """
    docs = staged(df.select(F.col(id_col).alias("id"), fingerprint(F.col(text_col), shingle).alias("fp")), "simhash")
    nodes = staged(docs.groupBy("fp").agg(F.min("id").alias("first")), "fps")
    comp = components(links(nodes.select("fp"), max_distance, cell_rows))
    rooted = nodes.join(comp, nodes.fp == comp.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component"))
    named = rooted.join(least, "root").select("fp", "component")
    return docs.join(named, "fp").select(F.col("id").alias(id_col), "fp", "component")


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         shingle: int = 3, max_distance: int = 2) -> DataFrame:
    """``df`` with one document, that of the smallest id, of each group.

    Rows that share an id are one document: they stay if any of them is its group's
    smallest, and go together otherwise.  Rows with a null id stay.
    """
    found = near_duplicates(df, id_col, text_col, shingle, max_distance)
    gone = found.groupBy(id_col).agg(F.max(F.col(id_col) == F.col("component")).alias("_stays")).where(
        ~F.col("_stays")).select(id_col)
    return df.join(gone, id_col, "left_anti")
