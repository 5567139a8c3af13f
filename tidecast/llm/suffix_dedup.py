"""Repeated-substring removal by threshold-bounded interval expansion.

Every byte covered by a ``min_len``-byte string that also starts elsewhere goes.

1. Routing.  Each window of ``min_len`` bytes is assigned to its minimiser: the leftmost smallest hash of its 16-byte
   grams.  Equal windows have equal minimisers at equal offsets, so no repeat ever crosses two anchors.  Consecutive
   windows with one minimiser position make a run.  Anchors that occur once hold no repeat.  Equal runs repeat as a whole;
   of them one stays, so that other runs can be compared with it.
2. Splitting.  An anchor with more than ``GROUP`` different runs (a passage that many documents share, between texts that
   differ) is split by the offset of the anchor in the window, into four ranges of offsets.  The bytes that all
   windows of a range share name its group: equal windows meet in one group.  A group of one run holds no repeat,
   parts of runs that are equal repeat as a whole, and what is still crowded is split again, down to single offsets.
   Each split makes rows by runs, not by windows.
3. Expansion of each group.  The windows start as one interval; each step extends all intervals backwards by one symbol (four
   bytes): positions are stably ordered by (preceding symbol, rank of their interval), which is the LF mapping of the
   Burrows-Wheeler order, and an interval ends where neighbours differ.  Intervals of one position are dropped; common
   prefixes thus come by increasing length, and the expansion stops at ``min_len``.  What is left repeats.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import discard, staged

#: At most so many different runs are expanded together; more are split by offset, into so many ranges at a time.
GROUP, FAN = 128, 4
GRAM = 16
#: Bytes of text hashed at once; longer texts are cut with an overlap.
PIECE, BATCH = 1 << 19, 1 << 20
_POS = np.uint64((1 << 24) - 1)
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _gram_hashes(buf: bytes, n: int) -> np.ndarray:
    """Of the 16-byte grams at 0 .. n - 16 of ``buf`` (eight spare bytes follow)."""
    w = np.ndarray((n - 7,), dtype="<u8", buffer=buf, strides=(1,))
    h = w[:n - GRAM + 1] * _M1
    h ^= h >> np.uint64(29)
    g = w[8:n - 7] * _M2
    g ^= g >> np.uint64(31)
    h += g
    h *= _M1
    h ^= h >> np.uint64(32)
    return h


def window_runs(parts: list[bytes], min_len: int):
    """Runs of windows with one minimiser: (part, first window, windows, anchor, its offset in the first window, digest).

    Each part has ``min_len`` bytes at least.
    """
    buf = b"".join(parts)
    n = len(buf)
    if n < min_len:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(6))
    grams = min_len - GRAM + 1
    h = _gram_hashes(buf + b"\0" * 8, n)
    m = (h & ~_POS) | np.arange(len(h), dtype=np.uint64)
    width = 1
    while 2 * width <= grams:
        m = np.minimum(m[:-width], m[width:])
        width *= 2
    if width < grams:
        m = np.minimum(m[:len(m) - (grams - width)], m[grams - width:])
    size = np.array([len(p) for p in parts], dtype=np.int64)
    start = np.concatenate(([0], np.cumsum(size)[:-1]))
    step = np.zeros(len(m) + 1, dtype=np.int32)  # windows may not cross two parts
    step[start] += 1
    step[start + size - min_len + 1] -= 1
    valid = np.cumsum(step[:-1]) > 0
    at = (m & _POS).astype(np.int64)
    change = np.empty(len(m), dtype=bool)
    change[0] = True
    change[1:] = (at[1:] != at[:-1]) | (valid[1:] != valid[:-1])
    edge = np.flatnonzero(change)
    end = np.append(edge[1:], len(m))
    keep = valid[edge]
    edge, end = edge[keep], end[keep]
    part = np.searchsorted(start, edge, side="right") - 1
    digest = np.fromiter((int.from_bytes(hashlib.blake2b(buf[a:b], digest_size=8).digest(), "little", signed=True)
                          for a, b in zip(edge.tolist(), (end + min_len - 1).tolist())), dtype=np.int64, count=len(edge))
    return part, edge - start[part], end - edge, h[at[edge]].view(np.int64), at[edge] - edge, digest


def _runs_of(min_len: int):
    columns = "doc long, th binary, i0 int, n int, anchor long, top int, run long"

    def flush(ids, ths, offs, parts):
        part, i0, n, anchor, top, run = window_runs(parts, min_len)
        return pd.DataFrame({"doc": pd.array([ids[p] for p in part], dtype="Int64"),
                             "th": pd.Series([ths[p] for p in part], dtype=object),
                             "i0": (i0 + np.array(offs, dtype=np.int64)[part] if len(part) else i0).astype(np.int32),
                             "n": n.astype(np.int32), "anchor": anchor, "top": top.astype(np.int32), "run": run})

    def runs(batches):
        for batch in batches:
            ids, ths, offs, parts, size = [], [], [], [], 0
            for doc, th, raw in zip(batch["doc"], batch["th"], batch["raw"]):
                if raw is None or len(raw) < min_len:
                    continue
                doc = None if pd.isna(doc) else int(doc)
                for off in range(0, len(raw) - min_len + 1, PIECE):
                    piece = raw[off:off + PIECE + min_len - 1]
                    if size and size + len(piece) > BATCH:
                        yield flush(ids, ths, offs, parts)
                        ids, ths, offs, parts, size = [], [], [], [], 0
                    ids.append(doc)
                    ths.append(bytes(th))
                    offs.append(off)
                    parts.append(piece)
                    size += len(piece)
            if parts:
                yield flush(ids, ths, offs, parts)

    return runs, columns


def repeated_windows(runs: list[bytes], weight: np.ndarray, min_len: int):
    """Backward interval expansion: which windows of the runs repeat, and each window's run.

    ``weight`` says how many equal copies a run stands for.
    """
    size = np.array([len(r) for r in runs], dtype=np.int64)
    windows = size - min_len + 1
    of = np.repeat(np.arange(len(runs)), windows)
    first = np.concatenate(([0], np.cumsum(size)[:-1]))
    ahead = np.concatenate(([0], np.cumsum(windows)[:-1]))
    at = np.arange(len(of)) - ahead[of] + first[of]
    buf = b"".join(runs) + b"\0" * 4
    word = np.ndarray((len(buf) - 3,), dtype="<u4", buffer=buf, strides=(1,))
    active, rank = np.arange(len(of)), np.zeros(len(of), dtype=np.uint64)
    copies = np.asarray(weight, dtype=np.int64)[of]
    depth = 0
    while depth < min_len and len(active):
        step = (min_len % 4 or 4) if depth == 0 else 4
        depth += step
        symbol = word[at[active] + (min_len - depth)].astype(np.uint64)
        if step < 4:
            symbol &= np.uint64((1 << 8 * step) - 1)
        key = (symbol << np.uint64(32)) | rank
        order = np.argsort(key, kind="stable")
        key, active = key[order], active[order]
        new = np.empty(len(key), dtype=bool)
        new[0] = True
        np.not_equal(key[1:], key[:-1], out=new[1:])
        head = np.flatnonzero(new)
        alive = np.add.reduceat(copies[active], head) > 1
        interval = np.cumsum(new) - 1
        keep = alive[interval]
        active = active[keep]
        rank = (np.cumsum(alive) - 1)[interval[keep]].astype(np.uint64)
    repeated = np.zeros(len(of), dtype=bool)
    repeated[active] = True
    return repeated, of


def _expand(min_len: int):
    """Of parts of runs sorted by group, the ranges ``[a, b)`` of windows that repeat; parts already settled (``done``) only take part."""
    def found(rows):
        anchors, runs, first, data, copies, done = zip(*rows)
        repeated, of = repeated_windows(list(data), np.array(copies), min_len)
        repeated &= ~np.array(done, dtype=bool)[of]
        windows = np.bincount(of, minlength=len(data))
        ahead = np.concatenate(([0], np.cumsum(windows)[:-1])) - np.array(first, dtype=np.int64)
        inside = repeated[1:] & repeated[:-1] & (of[1:] == of[:-1])
        a = np.flatnonzero(repeated & ~np.concatenate(([False], inside)))
        b = np.flatnonzero(repeated & ~np.concatenate((inside, [False]))) + 1
        run = of[a]
        return pd.DataFrame({"anchor": np.array(anchors, dtype=np.int64)[run], "run": np.array(runs, dtype=np.int64)[run],
                             "a": (a - ahead[run]).astype(np.int32), "b": (b - ahead[run]).astype(np.int32)})

    def expand(batches):
        rows, last, size = [], None, 0
        for batch in batches:
            core = [None if c is None else bytes(c) for c in batch["core"]]
            for anchor, p, c, *row in zip(batch["anchor"], batch["p"], core, batch["run"], batch["first"], batch["data"], batch["copies"], batch["done"]):
                if size > 250_000 and (anchor, p, c) != last:
                    yield found(rows)
                    rows, size = [], 0
                rows.append((anchor, *row))
                last, size = (anchor, p, c), size + len(row[2]) - min_len + 1
        if rows:
            yield found(rows)

    return expand


def _cut_out(min_len: int):
    """The bytes of the runs asked for."""
    def cut(batches):
        for batch in batches:
            out = [(w["anchor"], w["run"], w["copies"], w["top"], w["n"], bytes(raw[w["i0"]:w["i0"] + w["n"] + min_len - 1]))
                   for raw, want in zip(batch["raw"], batch["want"]) for w in want]
            yield pd.DataFrame(out, columns=["anchor", "run", "copies", "top", "n", "data"])

    return cut


def _digest(data: Column) -> Column:
    return F.unhex(F.md5(data))


def repeated_ranges(data: DataFrame, min_len: int, group: int = GROUP) -> DataFrame:
    """Rows ``(anchor, run, a, b)``: ranges of windows of the different runs ``(anchor, run, copies, top, n, data)`` that repeat.

    ``top`` is the anchor's offset in the first window.  A part covers the windows of offsets ``hi`` to ``lo`` of a run, in a
    group that has the offsets ``p`` to ``q``.
    """
    found = [data.where("copies > 1").select("anchor", "run", F.lit(0).alias("a"), F.col("n").alias("b"))]
    keys = ["anchor", "p", "core"]
    parts = data.select("anchor", F.lit(0).alias("p"), F.lit(min_len - GRAM).alias("q"), F.lit(b"").alias("core"), "run", "top", F.col("top").alias("hi"),
                        (F.col("top") - F.col("n") + 1).alias("lo"), "copies", (F.col("copies") > 1).alias("done"), "data")
    gone, ranges, width = [], [], min_len - GRAM + 1
    while True:
        # where the copies add up to one nothing repeats; where all is settled nothing is asked
        groups = parts.groupBy(*keys).agg(F.count("*").alias("rows"), F.sum("copies").alias("_c"), F.count_if(~F.col("done")).alias("_open")).where(
            "_c > 1 and _open > 0").drop("_c", "_open")
        sized = staged(parts.join(groups, keys), "sized")
        few = sized.where(F.col("rows") <= group).withColumn("first", F.col("top") - F.col("hi"))
        ranges.append(staged(few.repartition(*keys).sortWithinPartitions(*keys).select(*keys, "run", "first", "data", "copies", "done").mapInPandas(
            _expand(min_len), "anchor long, run long, a int, b int"), "ranges"))
        found.append(ranges[-1])
        most = sized.agg(F.max("rows")).first()[0] or 0
        if most <= group:
            break
        width = -(-width // FAN)
        start = F.col("p") + F.col("_k") * width
        pieces = sized.where(F.col("rows") > group).withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(FAN - 1)))).withColumn("_p", start).withColumn(
            "_q", F.least("q", start + (width - 1))).withColumn("_hi", F.least("hi", "_q")).withColumn("_lo", F.greatest("lo", "_p")).where("_lo <= _hi")
        cut = lambda a, n: F.substring("data", a + 1, n)
        pieces = pieces.select(
            "anchor", F.col("_p").alias("p"), F.col("_q").alias("q"), _digest(cut(F.col("hi") - F.col("_p"), F.col("_p") - F.col("_q") + min_len)).alias("core"),
            "run", "top", F.col("_hi").alias("hi"), F.col("_lo").alias("lo"), "copies", "done",
            cut(F.col("hi") - F.col("_hi"), F.col("_hi") - F.col("_lo") + min_len).alias("data")).withColumn("whole", _digest(F.col("data")))
        same = ["anchor", "p", "hi", "lo", "whole"]
        equal = pieces.groupBy(*same).agg(F.sum("copies").alias("_c"), F.min("run").alias("_one"))
        both = staged(pieces.join(equal, same), "pieces")
        found.append(both.where("_c > 1 and not done").select("anchor", "run", (F.col("top") - F.col("hi")).alias("a"), (F.col("top") - F.col("lo") + 1).alias("b")))
        parts = both.where("_c = 1 or run = _one").withColumn("copies", F.col("_c")).withColumn("done", F.col("_c") > 1).drop("_c", "_one", "whole")
        discard(sized)
        gone.append(both)
    out = staged(functools.reduce(DataFrame.union, found), "found")
    discard(sized, *gone, *ranges)
    return out


def text_digest(text_col: str) -> Column:
    """128 bits of the text's SHA-256; a null text is empty.  Rows of one id are told apart by it."""
    return F.substring(F.unhex(F.sha2(F.coalesce(text_col, F.lit("")), 256)), 1, 16)


def repeated_spans(docs: DataFrame, min_len: int = 200, group: int = GROUP) -> DataFrame:
    """Rows ``(doc, th, s, e)``: byte ranges covered by repeated windows; they may overlap.

    ``docs`` has ``doc`` (long), ``th`` (:func:`text_digest`, tells rows of one id apart) and ``raw``.
    """
    find, columns = _runs_of(min_len)
    runs = staged(docs.mapInPandas(find, columns), "runs")
    # written, so that the join below is of two plain shuffles, whose hot anchors Spark may split
    anchors = staged(runs.groupBy("anchor").agg(F.count("*").alias("runs"), (F.min("run") == F.max("run")).alias("same")).where("runs > 1"), "anchors")
    marked = staged(runs.join(anchors, "anchor").drop("runs"), "marked")
    discard(runs, anchors)
    whole = marked.where("same").select("doc", "th", F.col("i0").alias("s"), (F.col("i0") + F.col("n") + (min_len - 1)).alias("e"))
    mixed = marked.where("not same")
    # one place where the bytes of each differing run can be had
    reps = mixed.groupBy("anchor", "run").agg(F.min(F.struct("doc", "th", "i0", "n", "top")).alias("at"), F.count("*").alias("copies"))
    want = reps.groupBy(F.col("at.doc").alias("doc"), F.col("at.th").alias("th")).agg(
        F.collect_list(F.struct("anchor", "run", "copies", "at.top", "at.i0", "at.n")).alias("want"))
    some = docs.alias("x").join(want.alias("w"), F.col("x.doc").eqNullSafe(F.col("w.doc")) & (F.col("x.th") == F.col("w.th")))
    data = staged(some.select("raw", "want").mapInPandas(
        _cut_out(min_len), "anchor long, run long, copies long, top int, n int, data binary"), "mixed")
    found = repeated_ranges(data, min_len, group)
    discard(data)
    part = mixed.join(found, ["anchor", "run"]).select(
        "doc", "th", (F.col("i0") + F.col("a")).alias("s"), (F.col("i0") + F.col("b") + (min_len - 1)).alias("e"))
    return whole.union(part)


def _strip(spans, raw: bytes):
    """Kept bytes, removed bytes, maximal removed runs."""
    kept, gone, n_spans, at = [], 0, 0, 0
    end = -1
    for s, e in spans:
        if s > end:
            if end >= 0:
                n_spans += 1
            kept.append(raw[max(end, 0):s])
            gone += e - s
            end = e
        elif e > end:
            gone += e - end
            end = e
    n_spans += end >= 0
    kept.append(raw[max(end, 0):])
    return b"".join(kept), gone, n_spans


def _spans() -> Column:
    """A document's ranges as whole numbers, start in the upper half: in Python an array each, no object for every range."""
    return F.collect_set(F.shiftleft(F.col("s").cast("long"), 32).bitwiseOR(F.col("e").cast("long")))


def _pairs(spans) -> list[tuple[int, int]]:
    x = np.sort(np.asarray(spans, dtype=np.int64))
    return list(zip((x >> 32).tolist(), (x & 0xFFFFFFFF).tolist()))


def _result(batches):
    for batch in batches:
        out = []
        for i, raw, spans in zip(batch["rid"], batch["raw"], batch["spans"]):
            raw = bytes(raw or b"")
            pairs = _pairs(spans) if spans is not None else []
            kept, gone, n = _strip(pairs, raw)
            out.append((None if pd.isna(i) else int(i), len(raw), gone, n, hashlib.sha256(kept).hexdigest(), kept))
        yield pd.DataFrame(out, columns=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]).astype({"id": "Int64"})


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_len: int = 200,
                   group: int = GROUP) -> DataFrame:
    """One row per row of ``df``: ``id_col, n_bytes, n_removed, n_spans, kept_sha256, kept`` (bytes).

    Every byte covered by a ``min_len``-byte string that starts at another place too, in the
    same or another row, is removed; strings are judged on the input and never cross rows.
    A null text is empty; shorter texts lose nothing; repeated rows remove each other, rows
    that share an id but not the text are separate documents.
    """
    if min_len <= GRAM:
        raise ValueError(f"min_len must be over {GRAM}")
    docs = df.select(F.col(id_col).cast("long").alias("doc"), text_digest(text_col).alias("th"),
                     F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("raw"))
    spans = repeated_spans(docs, min_len, group).groupBy("doc", "th").agg(_spans().alias("spans"))
    return docs.alias("x").join(
        spans.alias("y"), F.col("x.doc").eqNullSafe(F.col("y.doc")) & (F.col("x.th") == F.col("y.th")), "left").select(
        F.col("x.doc").alias("rid"), "raw", "spans").mapInPandas(
        _result, "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    ).withColumnRenamed("id", id_col)


def cut_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_len: int = 200, group: int = GROUP) -> DataFrame:
    """``df`` with the repeated bytes cut out of its text, without the rows of which nothing is left.

    Rows without a repeat keep their text as it is (null stays null).  Bytes of a character that a cut parts go too.
    """
    th = text_digest(text_col)
    raw = df.select(F.col(id_col).cast("long").alias("doc"), th.alias("th"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("raw"))
    spans = repeated_spans(raw, min_len, group).groupBy("doc", "th").agg(_spans().alias("_spans"))

    @F.pandas_udf("string")
    def kept(text: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for t, s in zip(text, spans):
            if s is not None and t is not None:
                t = _strip(_pairs(s), t.encode())[0].decode("utf-8", "ignore")
            out.append(t)
        return pd.Series(out, dtype=object)

    rows = df.withColumn("_th", th)
    joined = rows.join(spans.select(F.col("doc").alias("_doc"), F.col("th").alias("_sth"), "_spans"),
                       F.col(id_col).eqNullSafe(F.col("_doc")) & (F.col("_th") == F.col("_sth")), "left")
    # else the filter below would run it a second time
    cut = joined.withColumn("_kept", kept.asNondeterministic()(F.col(text_col), F.col("_spans")))
    return cut.where(F.col("_spans").isNull() | (F.col("_kept") != "")).withColumn(text_col, F.col("_kept")).select(*df.columns)
