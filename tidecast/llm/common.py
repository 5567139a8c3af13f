"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import sys

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    The written table cuts the lineage: a lost executor costs the reader nothing,
    and an expensive Python pass never runs twice.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete staged tables that nothing reads any more (what was made of them must be written by now)."""
    for df in frames:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.staged_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def process_cache() -> dict:
    """A dictionary that lasts as long as this Python process.

    The package is shipped to workers by value, so a module's globals begin anew with each task.
    """
    return sys.__dict__.setdefault("_tidecast_llm_cache", {})


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` (a one-element transform)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def prefix_sums(df: DataFrame, order: str, value: str, out: str, width: int = 4096) -> DataFrame:
    """Exclusive running sum of ``value`` by the long column ``order`` (0, 1, 2, ... distinct).

    Two levels: inside blocks of ``width`` consecutive positions, then over the
    block totals, so that no window holds more than a block or the block totals.
    """
    blocks = df.withColumn("_b", F.floor(F.col(order) / width))
    inner = Window.partitionBy("_b").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    totals = blocks.groupBy("_b").agg(F.sum(value).alias("_t")).select(
        "_b", F.coalesce(F.sum("_t").over(outer), F.lit(0)).alias("_base"))
    return (blocks.withColumn("_in", F.coalesce(F.sum(value).over(inner), F.lit(0)))
            .join(totals, "_b").withColumn(out, F.col("_base") + F.col("_in"))
            .drop("_b", "_in", "_base"))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of long pairs ``(src, dst)``: rows ``(node, root)``.

    ``root`` is the smallest node of the component.  Alternates large-star and
    small-star steps on staged edge tables until the edges no longer change.
    Nodes without an edge are not listed.
    """
    def stars(e: DataFrame, large: bool) -> DataFrame:
        if large:
            near = e.union(e.select("dst", "src")).toDF("u", "v")
        else:
            near = e.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v"))
        low = near.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        both = near.join(low, "u")
        if large:
            out = both.where("v > u").select(F.col("v").alias("src"), F.col("m").alias("dst"))
        else:
            out = both.select(F.col("v").alias("src"), F.col("m").alias("dst")).union(low)
        return out.where("src <> dst").distinct()

    def digest(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first()

    now = staged(edges.select("src", "dst").where("src <> dst").distinct(), "cc")
    mark = digest(now)
    while mark[0]:
        now = staged(stars(stars(now, True), False), "cc")
        new = digest(now)
        if new == mark:
            break
        mark = new
    return now.select(F.col("src").alias("node"), F.col("dst").alias("root")).union(
        now.select("dst", "dst")).distinct()
