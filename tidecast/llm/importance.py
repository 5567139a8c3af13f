"""Target-distribution importance resampling over hashed word runs, with a head-tail vocabulary.

Features are runs of one to three words; a feature's bucket is the CRC-32 of its bytes modulo the number of buckets.
The CRC of a run continues the CRC of its beginning: ``crc(a + b) = shift(crc(a), len(b)) ^ crc(b)``, where ``shift``
is linear and comes from tables by length.

* Head: the CRC states of the most frequent words of all documents (of ``HEAD_BYTES`` at most), and the states of the most
  frequent pairs of the first of them, both broadcast in tables of a stated size.
* Tail: words outside the head take a direct CRC of their bytes; runs that are no frequent pair are continued word by word.

Both give the exact bucket of every feature, so the head changes the time and never the result.  Bucket totals are
counted in each task and added up; no feature is ever a row.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import staged

BUCKETS = 10_000
#: Sizes of the broadcast head: words, their bytes (two machine words), those of them that form pairs, and pairs.
HEAD_WORDS, HEAD_BYTES, PAIR_WORDS, HEAD_PAIRS = 8192, 16, 512, 65_536
#: Longest word that the shift tables know; longer ones are continued byte by byte.
SHIFT_BYTES = 64
#: Bytes of text taken at once, and different words counted before they are passed on.
SLICE, VOCABULARY = 1 << 22, 1_000_000
#: Lower-cases A-Z; bytes that are no digit, letter a-z or part of a longer character become a space.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_SLOTS = 1 << 16
_MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_LOW = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)


def _crc_table() -> np.ndarray:
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = np.where(one & 1, (one >> 1) ^ np.uint32(0xEDB88320), one >> 1).astype(np.uint32)
    return one


_ONE = _crc_table()


def _shift_tables() -> np.ndarray:
    """Entry ``(length, byte place, byte)``: what that byte of a CRC becomes when so many zero bytes follow."""
    out = np.empty((SHIFT_BYTES + 2, 4, 256), dtype=np.uint32)
    out[0] = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for n in range(1, len(out)):
        out[n] = (out[n - 1] >> 8) ^ _ONE[out[n - 1] & 255]
    return out


@dataclass
class Words:
    """Words of some texts: where each begins in ``raw``, its bytes, its text, and how many words of the text stand before
    it (2 at most).  Words that the slice before has had already are there for the runs they begin, with place -1."""

    raw: bytes
    start: np.ndarray
    size: np.ndarray
    of: np.ndarray
    place: np.ndarray

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """The first 16 bytes of each word as two numbers."""
        every = np.ndarray((len(self.raw) - 7,), dtype="<u8", buffer=self.raw, strides=(1,))
        return (every[self.start] & _LOW[np.minimum(self.size, 8)], every[self.start + 8] & _LOW[np.clip(self.size - 8, 0, 8)])

    def word(self, i: int) -> bytes:
        return self.raw[self.start[i]:self.start[i] + self.size[i]]


def slices(texts) -> Iterator[Words]:
    """Words of the texts in slices of about ``SLICE`` bytes.  A text that goes on in the next slice hands over its last two words."""
    parts: list[tuple[int, bytes, int]] = []  # text, folded bytes, words that were there before
    size = 0

    def flush() -> Words:
        raw = b" ".join(p[1] for p in parts) + b" " * 17
        mask = np.frombuffer(raw, dtype=np.uint8) != 32
        edge = np.flatnonzero(mask[1:] != mask[:-1]) + 1
        if mask[0]:
            edge = np.concatenate(([0], edge))
        start, end = edge[0::2], edge[1::2]
        length = np.array([len(p[1]) + 1 for p in parts], dtype=np.int64)
        begin = np.cumsum(length) - length
        part = np.searchsorted(begin, start, side="right") - 1
        place = np.arange(len(start)) - np.searchsorted(start, begin)[part]
        again = np.array([p[2] for p in parts], dtype=np.int64)[part]
        return Words(raw, start, end - start, np.array([p[0] for p in parts], dtype=np.int64)[part], np.where(place < again, -1, np.minimum(place, 2)))

    for no, text in enumerate(texts):
        if text is None:
            continue
        raw, at, before = text.encode("utf-8", "surrogatepass"), 0, []
        while at < len(raw):
            end = at + SLICE
            part = raw[at:end].translate(_FOLD)
            if end < len(raw):  # cut behind the last whole word
                cut = part.rfind(b" ")
                while cut < 0 and end < len(raw):
                    end += SLICE
                    part = raw[at:end].translate(_FOLD)
                    cut = part.rfind(b" ")
                if end < len(raw):
                    end = at + cut + 1
                    part = part[:cut]
            parts.append((no, b" ".join([*before, part]), len(before)))
            if end < len(raw):
                before = (before + part.rsplit(None, 2)[-2:])[-2:]
            size += len(part)
            at = end
            if size >= SLICE:
                yield flush()
                parts, size = [], 0
    if parts:
        yield flush()


class Head:
    """CRC states of the frequent words and pairs; all else is computed from the bytes."""

    def __init__(self, words: list[bytes], pairs: list[int]):
        self.shift = _shift_tables().reshape(-1)
        self.key = np.zeros((2, _SLOTS), dtype=np.uint64)
        self.no = np.full(_SLOTS, -1, dtype=np.int64)
        self.crc = np.array([zlib.crc32(w) for w in words] or [0], dtype=np.uint32)
        self.probes = 0
        for i, w in enumerate(words):
            k = [np.uint64(int.from_bytes(w[a:a + 8], "little")) for a in (0, 8)]
            slot, n = int(self._slot(*[np.array([x]) for x in k])[0]), 1
            while self.no[slot] >= 0:
                slot, n = (slot + 1) % _SLOTS, n + 1
            self.key[:, slot], self.no[slot], self.probes = k, i, max(self.probes, n)
        # a word behind a space: the space's CRC moved on by the word's length
        space = np.full(SHIFT_BYTES + 1, zlib.crc32(b" "), dtype=np.uint32)
        self.space = self._moved(space, np.arange(SHIFT_BYTES + 1))
        self.pairs = np.zeros(PAIR_WORDS * PAIR_WORDS, dtype=np.uint32)
        self.known = np.zeros(PAIR_WORDS * PAIR_WORDS, dtype=bool)
        for p in pairs:
            self.pairs[p] = zlib.crc32(words[p // PAIR_WORDS] + b" " + words[p % PAIR_WORDS])
            self.known[p] = True

    @staticmethod
    def _slot(k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        return (((k1 * _MIX[0]) ^ (k2 * _MIX[1])) * _MIX[0] >> np.uint64(48)).astype(np.int64)

    def _moved(self, state: np.ndarray, size: np.ndarray) -> np.ndarray:
        base, t = size.astype(np.int64) * 1024, self.shift
        return t[base + (state & 255)] ^ t[base + 256 + ((state >> 8) & 255)] ^ t[base + 512 + ((state >> 16) & 255)] ^ t[base + 768 + (state >> 24)]

    def numbers(self, w: Words) -> np.ndarray:
        """Place of each word in the head, -1 for the tail."""
        out = np.full(len(w.start), -1, dtype=np.int64)
        if not len(out):
            return out
        k1, k2 = w.keys()
        rest = np.flatnonzero(w.size <= HEAD_BYTES)
        slot = self._slot(k1[rest], k2[rest])
        for _ in range(self.probes):
            no = self.no[slot]
            hit = (self.key[0, slot] == k1[rest]) & (self.key[1, slot] == k2[rest]) & (no >= 0)
            out[rest[hit]] = no[hit]
            on = ~hit & (no >= 0)
            rest, slot = rest[on], (slot[on] + 1) % _SLOTS
        return out

    def states(self, w: Words, no: np.ndarray) -> np.ndarray:
        """CRC of every word: from the head, else from its bytes."""
        out = self.crc[no]
        at = np.flatnonzero(no < 0)
        raw = np.frombuffer(w.raw, dtype=np.uint8)
        for i in at[w.size[at] > SHIFT_BYTES].tolist():
            out[i] = zlib.crc32(w.word(i))
        at = at[w.size[at] <= SHIFT_BYTES]
        at = at[np.argsort(-w.size[at], kind="stable")]
        start, size = w.start[at], w.size[at]
        state = np.full(len(at), 0xFFFFFFFF, dtype=np.uint32)
        for j in range(int(size[0]) if len(size) else 0):
            n = int(np.searchsorted(-size, -j, side="left"))  # words of more than j bytes come first
            state[:n] = (state[:n] >> 8) ^ _ONE[(state[:n] ^ raw[start[:n] + j]) & 255]
        out[at] = ~state
        return out

    def _continued(self, state: np.ndarray, w: Words, at: np.ndarray, crc: np.ndarray) -> np.ndarray:
        """CRC of what ``state`` stands for, a space and the word ``at``."""
        size = w.size[at]
        short = np.minimum(size, SHIFT_BYTES)
        out = self._moved(state, short + 1) ^ self.space[short] ^ crc[at]
        for i in np.flatnonzero(size > SHIFT_BYTES).tolist():
            out[i] = zlib.crc32(b" " + w.word(at[i]), int(state[i]))
        return out

    def buckets(self, w: Words, modulus: int) -> tuple[np.ndarray, np.ndarray]:
        """Bucket of every feature, and the word that ends it."""
        no, place = self.numbers(w), w.place
        single = self.states(w, no)
        one, two, three = (np.flatnonzero(place >= n) for n in (0, 1, 2))
        pair = np.zeros(len(no), dtype=np.uint32)
        head = (no[two - 1] >= 0) & (no[two - 1] < PAIR_WORDS) & (no[two] >= 0) & (no[two] < PAIR_WORDS)
        key = np.where(head, no[two - 1] * PAIR_WORDS + no[two], 0)
        head &= self.known[key]
        pair[two[head]] = self.pairs[key[head]]
        # the two words handed over from the slice before form a pair that was counted there and goes on here
        again = np.flatnonzero((place[1:] == -1) & (place[:-1] == -1) & (w.of[1:] == w.of[:-1])) + 1
        rest = np.concatenate([two[~head], again])
        pair[rest] = self._continued(single[rest - 1], w, rest, single)
        triple = self._continued(pair[three - 1], w, three, single)
        return np.concatenate([single[one], pair[two], triple]) % np.uint32(modulus), np.concatenate([one, two, three])


def _count_words(batches):
    held, size = [], 0

    def merged(parts):
        k1, k2, n = (np.concatenate(x) for x in zip(*parts))
        # words of equal mixed keys are next to each other; a clash of two words only parts their counts
        turn = np.argsort((k1 * _MIX[0]) ^ (k2 * _MIX[1]))
        k1, k2, n = k1[turn], k2[turn], n[turn]
        new = np.flatnonzero(np.concatenate(([True], (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]))))
        return k1[new], k2[new], np.add.reduceat(n, new)

    def out(parts):
        k1, k2, n = merged(parts)
        return pd.DataFrame({"k1": k1.view(np.int64), "k2": k2.view(np.int64), "n": n})

    for batch in batches:
        for w in slices(batch["text"]):
            own = (w.place >= 0) & (w.size <= HEAD_BYTES)
            if not own.any():
                continue
            k1, k2 = w.keys()
            held.append(merged([(k1[own], k2[own], np.ones(int(own.sum()), dtype=np.int64))]))
            size += len(held[-1][0])
            if size > VOCABULARY:
                held = [merged(held)]
                size = len(held[0][0])
                if size > VOCABULARY // 2:
                    yield out(held)
                    held, size = [], 0
    if held:
        yield out(held)


def _count_pairs(head: list[bytes]):
    def count(batches):
        table, totals = Head(head[:PAIR_WORDS], []), np.zeros(PAIR_WORDS * PAIR_WORDS, dtype=np.int64)
        for batch in batches:
            for w in slices(batch["text"]):
                no = table.numbers(w)
                both = (no[1:] >= 0) & (no[:-1] >= 0) & (w.place[1:] >= 1)
                totals += np.bincount(no[:-1][both] * PAIR_WORDS + no[1:][both], minlength=len(totals))
        some = np.flatnonzero(totals)
        yield pd.DataFrame({"pair": some, "n": totals[some]})

    return count


def vocabulary(docs: DataFrame, text_col: str) -> tuple[list[bytes], list[int]]:
    """The head: frequent words by count over all documents, and pairs ``first * PAIR_WORDS + second`` of the first of them."""
    texts = docs.select(F.col(text_col).alias("text"))
    words = texts.mapInPandas(_count_words, "k1 long, k2 long, n long").groupBy("k1", "k2").agg(F.sum("n").alias("n"))
    # the best of each share first, so that what reaches the driver does not grow with the partitions
    order = [F.col("n").desc(), F.col("k1"), F.col("k2")]
    best = words.withColumn("_no", F.row_number().over(Window.partitionBy(F.pmod(F.xxhash64("k1", "k2"), F.lit(16))).orderBy(*order))).where(
        F.col("_no") <= HEAD_WORDS)
    rows = best.orderBy(*order).limit(HEAD_WORDS).collect()
    head = [b"".join((k % (1 << 64)).to_bytes(8, "little") for k in (r.k1, r.k2)).rstrip(b"\0") for r in rows]
    pairs = texts.mapInPandas(_count_pairs(head), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    return head, [r.pair for r in pairs.orderBy(F.col("n").desc(), "pair").limit(HEAD_PAIRS).collect()]


def bucket_totals(docs: DataFrame, text_col: str, head: list[bytes], pairs: list[int], buckets: int = BUCKETS) -> DataFrame:
    """``(bucket, n)``: how many features of all texts fall into each bucket that has some."""
    def count(batches):
        table, totals = Head(head, pairs), np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for w in slices(batch["text"]):
                totals += np.bincount(table.buckets(w, buckets)[0], minlength=buckets)
        some = np.flatnonzero(totals)
        yield pd.DataFrame({"bucket": some, "n": totals[some]})

    return docs.select(F.col(text_col).alias("text")).mapInPandas(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(spark, raw: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """A whole number for each bucket: 1000 times the log of its smoothed share in the target over that in the raw texts."""
    both = staged(spark.range(buckets).withColumnRenamed("id", "bucket").join(raw.withColumnRenamed("n", "s"), "bucket", "left").join(
        target.withColumnRenamed("n", "t"), "bucket", "left").na.fill(0), "buckets")
    total = both.agg(F.sum("s").cast("double"), F.sum("t").cast("double")).first()
    up = (F.col("t") + 1.0) * F.lit(total[0] + buckets)
    down = (F.col("s") + 1.0) * F.lit(total[1] + buckets)
    rows = both.select("bucket", F.floor(F.lit(1000.0) * F.log(up / down)).alias("g")).collect()
    out = np.zeros(buckets, dtype=np.int64)
    out[[r.bucket for r in rows]] = [r.g for r in rows]
    return out


def _weigh(head: list[bytes], pairs: list[int], gain: np.ndarray):
    def weigh(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        table = Head(head, pairs)
        for texts in batches:
            total = np.zeros((3, len(texts)), dtype=np.int64)
            for w in slices(texts):
                bucket, at = table.buckets(w, len(gain))
                total[0] += np.bincount(w.of[w.place >= 0], minlength=len(texts))
                total[1] += np.bincount(w.of[at], minlength=len(texts))
                total[2] += np.bincount(w.of[at], weights=gain[bucket], minlength=len(texts)).astype(np.int64)
            yield pd.DataFrame({"n_words": total[0], "n_features": total[1], "weight": total[2]})

    return F.pandas_udf(weigh, "n_words long, n_features long, weight long")


def noise(key: Column, seed: int) -> Column:
    """Gumbel noise in thousandths from the digest of ``seed:key``; whole numbers, the same in every run."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), key), 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def ranked(rows: DataFrame, order: list[Column], limit: Column) -> DataFrame:
    """``rows`` with ``rank`` (1, 2, ... in ``order``, null beyond ``limit``); no window holds more than a range partition."""
    dealt = staged(rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranges")
    base = dealt.groupBy("_part").agg(F.count("*").alias("_n")).withColumn(
        "_base", F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))).select("_part", F.coalesce("_base", F.lit(0)).alias("_base"))
    placed = dealt.join(base, "_part")
    inside = placed.where(F.col("_base") < limit).withColumn("rank", F.col("_base") + F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    return inside.withColumn("rank", F.when(F.col("rank") <= limit, F.col("rank"))).unionByName(
        placed.where(F.col("_base") >= limit).withColumn("rank", F.lit(None).cast("long"))).drop("_part", "_base")


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, seed: int = 42, buckets: int = BUCKETS,
             id_col: str = "doc_id", text_col: str = "text", target_text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id_col, n_words, n_features, weight, score, rank``.

    ``weight`` is the sum of the gains of the document's features, ``score`` adds the noise of its id, ``rank`` numbers the
    drawn ones: of the documents with at least ``least_words`` words the ``percent`` in a hundred (rounded down) of highest
    score, ties to the smaller id, then to the fewer features; null for all others.  A null or empty text has no features and
    weight 0; a null id counts as an empty one for the noise and comes last in ties.  Rows that share an id or a text are rows of
    their own.  With an empty table there are no rows; with an empty target every feature's share there is equal.
    """
    spark = docs.sparkSession
    head, pairs = vocabulary(docs, text_col)
    gain = gains(spark, bucket_totals(docs, text_col, head, pairs, buckets), bucket_totals(target, target_text, head, pairs, buckets), buckets)
    weighed = docs.select(F.col(id_col).cast("long").alias("_id"), _weigh(head, pairs, gain)(F.col(text_col)).alias("w"))
    key = F.coalesce(F.col("_id").cast("string"), F.lit(""))
    scored = staged(weighed.select("_id", "w.*").withColumn("score", F.col("weight") + noise(key, seed)).withColumn(
        "_row", F.monotonically_increasing_id()), "scored")
    able = F.col("n_words") >= least_words
    drawn = scored.agg(F.floor(F.count_if(able) * percent / 100)).first()[0]
    order = [F.col("score").desc(), F.col("_id").asc_nulls_last(), F.col("n_features"), F.col("_row")]
    out = ranked(scored.where(able), order, F.lit(drawn)).unionByName(scored.where(~able).withColumn("rank", F.lit(None).cast("long")))
    return out.select(F.col("_id").alias(id_col), "n_words", "n_features", "weight", "score", "rank")
