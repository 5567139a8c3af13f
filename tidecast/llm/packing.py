"""Conflict-constrained best-fit packing.

Documents are packed into bins of ``capacity`` units, largest first.  Bins stand in the order of
their residual room, and each carries a bitmap of the sources and one of the duplicate clusters in it.  A
document starts at the least residual that holds it and moves to the successor until a bin has
neither its source nor its cluster; that is the tightest compatible bin.  If there is none it
opens a bin.  A document longer than a bin fills bins of its own; its rest is packed.

Rows are dealt by hash into groups of bounded size, each packed by one task, so a source that holds a third
of all rows is spread over all groups.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged

GROUP_ROWS = 4096


class Bins:
    """Open bins by residual room, in runs of at most ``RUN`` with the conflicts that all of a run share."""

    RUN = 64

    def __init__(self):
        self.runs: list[list[tuple[int, int]]] = []  # (residual, bin), ascending over all runs
        self.shared: list[tuple[int, int]] = []
        self.sources: list[int] = []
        self.clusters: list[int] = []

    def _share(self, r: int) -> None:
        source = cluster = -1
        for _, b in self.runs[r]:
            source &= self.sources[b]
            cluster &= self.clusters[b]
        self.shared[r] = source, cluster

    def place(self, size: int, source: int, cluster: int, capacity: int) -> tuple[int, int]:
        """The bin, and the room that was taken before. ``source``, ``cluster``: one bit each, or 0."""
        at = (size, -1)
        for r, run in enumerate(self.runs):
            if run[-1] < at or self.shared[r][0] & source or self.shared[r][1] & cluster:
                continue
            for i in range(bisect_left(run, at), len(run)):
                room, b = run[i]
                if not (self.sources[b] & source or self.clusters[b] & cluster):
                    del run[i]
                    if run:
                        self._share(r)
                    else:
                        del self.runs[r], self.shared[r]
                    self._put(room - size, b, source, cluster)
                    return b, capacity - room
        b = len(self.sources)
        self.sources.append(0)
        self.clusters.append(0)
        self._put(capacity - size, b, source, cluster)
        return b, 0

    def _put(self, room: int, b: int, source: int, cluster: int) -> None:
        self.sources[b] |= source
        self.clusters[b] |= cluster
        if room <= 0:
            return
        item = (room, b)
        r = next((r for r, run in enumerate(self.runs) if run[-1] > item), len(self.runs) - 1)
        if r < 0:
            self.runs.append([item])
            self.shared.append((self.sources[b], self.clusters[b]))
            return
        run = self.runs[r]
        insort(run, item)
        if len(run) > self.RUN:
            self.runs[r:r + 1] = [run[:len(run) // 2], run[len(run) // 2:]]
            self.shared[r:r + 1] = [(0, 0), (0, 0)]
            self._share(r + 1)
        self._share(r)


def _pack(capacity: int):
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["rest", "id", "row"], ascending=[False, True, True], na_position="last", kind="stable")
        source_bit = {s: 1 << i for i, s in enumerate(dict.fromkeys(x for x in pdf["source"] if x is not None))}
        often = pdf["cluster"].value_counts()
        cluster_bit = {c: 1 << i for i, c in enumerate(sorted(often.index[often > 1]))}
        bins, out = Bins(), []
        # bins of whole pieces stand beside the packed ones
        whole = 0
        for row, size, rest, source, cluster in zip(pdf["row"], pdf["size"], pdf["rest"], pdf["source"], pdf["cluster"]):
            full = (size - rest) // capacity
            for piece in range(full):
                out.append((row, piece, -1 - whole, 0, capacity))
                whole += 1
            if rest:
                b, at = bins.place(rest, source_bit.get(source, 0), cluster_bit.get(cluster, 0), capacity)
                out.append((row, full, b, at, rest))
        grp = int(pdf["grp"].iloc[0])
        return pd.DataFrame([(grp, row, piece, 2 * b if b >= 0 else -2 * b - 1, at, n) for row, piece, b, at, n in out],
                            columns=["grp", "row", "piece", "local", "offset", "length"])

    return pack


def pack(df: DataFrame, size: str, capacity: int, id_col: str = "doc_id", source_col: str = "source",
         cluster: str | None = None, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Rows ``(id_col, piece, bin, offset, length)``: where each piece of each row of ``df`` lies.

    ``size`` is an SQL expression of the units a row takes (null or below 1: the row takes no room and is not packed);
    ``cluster`` one of its duplicate cluster.  No bin holds two rows of one source or one cluster (a null source or
    cluster conflicts with none), but for the pieces of one long row, which fill bins alone.
    ``bin`` is unique over the table, ``offset`` counts units from the bin's start.
    Repeated rows are packed as rows of their own.  An empty table gives no rows.
    """
    # the row number tells repeated rows apart; it is fixed by being written
    rows = staged(df.select(
        F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), F.expr(size).cast("long").alias("size"),
        (F.expr(cluster) if cluster else F.lit(None)).cast("string").alias("cluster"),
        F.monotonically_increasing_id().alias("row")).where("size >= 1"), "sizes")
    groups = max(1, -(-rows.count() // group_rows))
    dealt = rows.withColumn("grp", F.pmod(F.xxhash64("id", "row"), F.lit(groups))).withColumn("rest", F.col("size") % capacity)
    placed = dealt.groupBy("grp").applyInPandas(_pack(capacity), "grp long, row long, piece int, local long, offset long, length long")
    return placed.join(rows.select("row", "id"), "row").select(
        F.col("id").alias(id_col), "piece", (F.col("grp") * (1 << 32) + F.col("local")).alias("bin"), "offset", "length")


def text_cluster(text_col: str = "text") -> str:
    """SQL for the cluster of equal texts; empty and null texts are in none."""
    return f"case when {text_col} <> '' then sha2({text_col}, 256) end"
