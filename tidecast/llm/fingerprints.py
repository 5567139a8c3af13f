"""One-permutation MinHash fingerprints, with DataFrame functions only.

Every word shingle is hashed once; the top bits choose one of ``BINS`` bins and the bin
keeps its smallest hash.  An empty bin takes the value of a full one by optimal
densification: it tries bins in an order drawn from its own number until one is
full, so the choice does not depend on the neighbours.  Of every value the
low ``BITS`` bits are stored, packed as hexadecimal digits; the share of equal values is
corrected for the chance that unequal values agree in these bits.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import let

BINS, BITS, SHINGLE = 128, 8, 5


def _shingle_hashes(text: Column, n: int) -> Column:
    """Hashes of the shingles of lower-cased words between ASCII white space."""
    words = F.filter(F.split(F.lower(text), r"[ \t-\r]+"), lambda w: w != F.lit(""))
    hashes = F.transform(words, lambda w: F.xxhash64(w))

    def grams(h: Column) -> Column:
        many = F.transform(F.sequence(F.lit(0), F.size(h) - n), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(n)]))
        few = F.when(F.size(h) > 0, F.array(F.xxhash64(F.concat_ws(" ", F.transform(h, lambda x: x.cast("string")))))).otherwise(
            F.array().cast("array<bigint>"))
        return F.when(F.size(h) >= n, many).otherwise(few)

    return let(hashes, grams)


_LOW = (1 << (64 - BINS.bit_length() + 1)) - 1  # the bits below the bin's


def _bin(h: Column) -> Column:
    return F.shiftrightunsigned(h, 64 - (BINS.bit_length() - 1)).cast("int")


def _longs(values: list[int]) -> Column:
    return F.array(*[F.lit(v - (1 << 64) if v >> 63 else v).cast("bigint") for v in values])


def minhash(text: Column, shingle: int = SHINGLE) -> Column:
    """The packed fingerprint of ``text``: ``BINS * BITS / 4`` hexadecimal digits.

    Fewer words than ``shingle`` make one shingle; a null, empty or word-less
    text has the empty fingerprint.
    """
    # the largest value of every bin is added as its mark: then each bin has a first value, and a mark means empty
    marks = _longs([(b << (64 - BINS.bit_length() + 1)) | _LOW for b in range(BINS)])
    # an empty bin tries the bins (start + t * stride) for t = 0, 1, ...: with an odd stride each comes once
    draw = random.Random(9)  # fixed numbers: literal arrays, so that no expression is evaluated for them
    starts = F.array(*[F.lit(draw.randrange(BINS)) for _ in range(BINS)])
    strides = F.array(*[F.lit(draw.randrange(BINS) | 1) for _ in range(BINS)])

    def densify(bins: Column) -> Column:
        def value(i: Column) -> Column:
            def first(tries: int) -> Column:
                return F.get(F.filter(F.transform(F.sequence(F.lit(0), F.lit(tries - 1)), lambda t: F.get(
                    bins, (F.get(starts, i) + t * F.get(strides, i)).bitwiseAND(F.lit(BINS - 1)))), lambda v: v.isNotNull()), F.lit(0))

            found = F.coalesce(F.get(bins, i), first(min(16, BINS)), first(BINS))
            return F.substring(F.hex(found.bitwiseAND(F.lit((1 << BITS) - 1)) + (1 << BITS)), 2, BITS // 4)

        return F.lower(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), value), ""))

    def first_of_bins(h: Column) -> Column:  # sorted: a bin's hashes stand together, the smallest first
        return F.filter(h, lambda x, i: (i == 0) | (_bin(x) != _bin(F.get(h, F.greatest(i - 1, F.lit(0))))))

    def packed(h: Column) -> Column:
        return F.when(F.size(h) == 0, "").otherwise(let(F.sort_array(F.concat(h, marks)), lambda every: let(F.transform(
            first_of_bins(every), lambda v: F.when(v.bitwiseAND(F.lit(_LOW)) != F.lit(_LOW), v)), densify)))

    return let(_shingle_hashes(F.coalesce(text, F.lit("")), shingle), packed)


def likeness(a: Column, b: Column) -> Column:
    """Estimated similarity (0 to 1) of two fingerprints, corrected for chance agreement.

    Two empty fingerprints are alike (1); one empty, one not: 0.
    """
    step = BITS // 4
    equal = F.size(F.filter(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda i: F.substring(a, i * step + 1, F.lit(step)) == F.substring(b, i * step + 1, F.lit(step))))
    chance = 2.0 ** -BITS
    share = F.greatest(F.lit(0.0), (equal / F.lit(float(BINS)) - chance) / (1 - chance))
    return F.when(a == b, 1.0).when((a == "") | (b == ""), 0.0).otherwise(share)


def with_next(df: DataFrame, id_col: str, columns: list[str], ranges: int, derive) -> DataFrame:
    """``df`` with ``next_<column>`` of the next row by descending id; after the last comes the first.

    Ids are cut into ranges at approximate quantiles (``ranges`` of them, however many rows), each range is a
    window, and the first row of every range is also dealt, as a copy, to the end of the range
    before.  Null ids come last; rows of one id are ordered by ``columns``.
    ``derive`` adds the columns that are costly, once copies are few.
    """
    low = F.coalesce(F.col(id_col), F.lit(-(1 << 63)))
    cut = sorted(set(df.select(F.percentile_approx(low, [i / ranges for i in range(1, ranges)], 10 * ranges)).first()[0] or []))
    # number of cuts below the id, by halving
    n, bound = len(cut), F.array(*[F.lit(c) for c in cut]).cast("array<bigint>")
    halves = F.array(*[F.lit(1 << k) for k in reversed(range(max(1, n.bit_length())))])
    below = let(F.struct(bound.alias("b"), low.alias("x")), lambda s: F.aggregate(
        halves, F.lit(0), lambda acc, k: F.when(F.coalesce(F.get(s["b"], acc + k - 1) < s["x"], F.lit(False)), acc + k).otherwise(acc)))
    rows = df.withColumn("_range", -below).withColumn("_copy", F.lit(0))
    order = [F.col(id_col).desc_nulls_last(), *[F.col(c) for c in columns]]
    heads = rows.groupBy("_range").agg(F.max(F.struct(low.alias("i"))).getField("i").alias("_head"))
    every = Window.orderBy("_range")
    before = heads.select("_range", "_head", F.coalesce(F.lag("_range").over(every), F.max("_range").over(
        every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("_to"))
    copies = rows.withColumn("_low", low).join(F.broadcast(before), "_range").where("_low = _head").drop("_low", "_head")
    copies = copies.withColumn("_range", F.col("_to")).drop("_to").withColumn("_copy", F.lit(1))
    w = Window.partitionBy("_range").orderBy("_copy", *order)
    both = derive(rows.unionByName(copies))
    for c in columns:
        both = both.withColumn(f"next_{c}", F.lead(c).over(w))
    return both.where("_copy = 0").drop("_range", "_copy")


def edited_fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """Fingerprints of every text and of its edited text, one row per row of ``df``.

    The edited text has its last ``floor(n_chars / 2)`` code points replaced by the first as
    many (or all) of the next document by descending id; after the last comes the first.
    Columns: ``id_col, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next``.  A null text is empty.  A single row is its own next one.
    """
    ranges = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    docs = with_next(docs, "id", ["text", "fp"], ranges, lambda d: d.withColumn("fp", minhash(F.col("text"), shingle)))
    half = F.floor(F.char_length("text") / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.char_length("text") - half), F.substring(F.col("next_text"), F.lit(1), half))
    docs = docs.select("id", F.char_length("text").cast("long").alias("n_chars"), "fp", "next_fp", edited.alias("edited"))
    docs = docs.withColumn("edited_fp", minhash(F.col("edited"), shingle))
    return docs.select(
        F.col("id").alias(id_col), "n_chars", F.sha2("edited", 256).alias("edited_sha256"), F.col("fp").alias("fingerprint"),
        F.col("edited_fp").alias("edited_fingerprint"), likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))
