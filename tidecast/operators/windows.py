"""Positional windows that do not put a whole series into one task.

``Window.partitionBy(series).orderBy(ts)`` sends every row of a series to one
task.  When one series holds a large share of all rows that task becomes the
job.  The two helpers here avoid it:

``with_position``
    1-based row position of each observation inside its series.  The rows are written once as range
    partitions of the order (series, time); a row's place in its partition is known from the write.  One count
    for each (partition, series), summed up over the partitions, gives the offsets.  No task holds
    more than a range partition, however long a series is, and no table is larger than the number of partitions
    and series.

``halo_window``
    Evaluates row-frame window expressions whose frame reaches at most ``halo``
    rows back.  Rows are cut into blocks of ``block_rows`` positions; the last
    ``halo`` rows of each block are copied into the next block, the window runs
    per ``(series, block)`` ordered by position, and the copies are dropped.
    The result equals the plain per-series window exactly.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..schema import DEFAULT_COLS, SeriesCols
from ..session import discard, written

POS = "pos"
N_ROWS = "n_rows"
DEFAULT_BLOCK_ROWS = 4096

_PART = "_part"
_AT = "_at"
_RB = "_rblock"
_HALO = "_is_halo"


def ordered_scan(df: DataFrame, order: list[Column]) -> DataFrame:
    """``df`` as range partitions of ``order``, written, with the partition ``_part`` and the place ``_at`` in it (from 0).

    ``df`` is evaluated once: it is written before the ranges are sampled.
    """
    base = written(df, "scan")
    ranged = base.repartitionByRange(*order).sortWithinPartitions(*order)
    # partition number in the upper 31 bits, row number in the lower 33
    out = written(ranged.withColumn(_AT, F.monotonically_increasing_id()), "ordered")
    discard(base)
    return out.withColumn(_PART, F.shiftright(_AT, 33)).withColumn(_AT, F.col(_AT).bitwiseAND(F.lit((1 << 33) - 1)))


def numbered(df: DataFrame, order: list[Column], col: str) -> DataFrame:
    """``df`` with the 1-based place ``col`` of each row in ``order``; offsets come from one count a partition."""
    rows = ordered_scan(df, order)
    parts = rows.groupBy(_PART).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(_PART, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return rows.join(offsets, _PART).select(*df.columns, (F.col("_off") + F.col(_AT) + 1).cast("long").alias(col))


def with_position(df: DataFrame, cols: SeriesCols = DEFAULT_COLS, *, scan: bool = True,
                  with_count: bool = False, pos_col: str = POS,
                  count_col: str = N_ROWS, tie_break: list[str] | None = None, over_all: bool = False) -> DataFrame:
    """Add the 1-based time-ordered row position per series (and the series length).

    Ties on the timestamp are broken by ``tie_break`` columns (default: value)
    so the result is deterministic.  ``over_all`` numbers the rows of all series together.
    ``scan=False`` uses the plain per-series window (one task per series).
    """
    s, t, v = cols.series, cols.ts, cols.value
    if tie_break is None:
        tie_break = [v] if v in df.columns else []
    key = [] if over_all else [s]
    order = [F.col(t)] + [F.col(c) for c in tie_break]
    if not scan:
        w = Window.partitionBy(*key).orderBy(*order)
        out = df.withColumn(pos_col, F.row_number().over(w).cast("long"))
        if with_count:
            out = out.withColumn(count_col, F.count(F.lit(1)).over(Window.partitionBy(*key)))
        return out
    rows = ordered_scan(df, [F.col(c) for c in key] + order)
    parts = rows.groupBy(_PART, *key).agg(F.count(F.lit(1)).alias("_n"), F.min(_AT).alias("_first"))
    # a row for each partition that a series lies in
    by_key = Window.partitionBy(*key)
    running = by_key.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(_PART, *key, "_first", F.coalesce(F.sum("_n").over(running), F.lit(0)).alias("_off"),
                           *([F.sum("_n").over(by_key).alias(count_col)] if with_count else []))
    joined = rows.join(offsets, [_PART, *key])
    return joined.select(*df.columns, *([count_col] if with_count else []),
                         (F.col("_off") + F.col(_AT) - F.col("_first") + 1).cast("long").alias(pos_col))


def halo_window(df: DataFrame, build: Callable[[WindowSpec], dict[str, Column]], halo: int,
                cols: SeriesCols = DEFAULT_COLS, *, block_rows: int | None = DEFAULT_BLOCK_ROWS,
                pos_col: str = POS,
                keep_pos: bool = False) -> DataFrame:
    """Apply window expressions ``build(W)`` whose frames reach ``≤ halo`` rows back.

    ``build`` receives the ordered window spec and returns ``{name: expression}``.
    With ``block_rows=None`` the plain ``partitionBy(series).orderBy(ts)`` is used.
    """
    s, t = cols.series, cols.ts
    if block_rows is None:
        w = Window.partitionBy(s).orderBy(t)
        return df.withColumns(build(w))

    had_pos = pos_col in df.columns
    d = df if had_pos else with_position(df, cols, pos_col=pos_col)
    b = max(int(block_rows), 2 * int(halo), 1)
    p0 = F.col(pos_col) - 1
    own = F.struct((p0 / b).cast("long").alias(_RB), F.lit(False).alias(_HALO))
    nxt = F.struct(((p0 / b).cast("long") + 1).alias(_RB), F.lit(True).alias(_HALO))
    copy_forward = ((p0 % b) >= (b - halo)) if halo > 0 else F.lit(False)
    keep = [c for c in d.columns if (had_pos or keep_pos or c != pos_col)]
    d = (d.select("*", F.inline(F.when(copy_forward, F.array(own, nxt))
                                 .otherwise(F.array(own)))))
    w = Window.partitionBy(s, _RB).orderBy(pos_col)
    exprs = build(w)
    return (d.select(*keep, *[e.alias(k) for k, e in exprs.items()], F.col(_HALO))
             .where(~F.col(_HALO)).select(*keep, *exprs.keys()))


def last_n_rows(df: DataFrame, n: int, cols: SeriesCols = DEFAULT_COLS) -> DataFrame:
    """The last ``n`` observations of every series (tail per series)."""
    d = with_position(df, cols, with_count=True)
    return d.where(F.col(POS) > F.col(N_ROWS) - n).drop(POS, N_ROWS)
