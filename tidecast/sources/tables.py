"""Base tables and the series views derived from them.

Every series view returns the canonical columns ``series_id STRING,
timestamp TIMESTAMP_NTZ, value DOUBLE``.  Money and quantities are summed as
DECIMAL(18,2) so that the result does not depend on the order in which a
distributed aggregation adds its partial sums; the sum is cast to DOUBLE once.

Joins against dimension tables are left to Catalyst/AQE: the optimizer
broadcasts a side only when its measured size is below
``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import SERIES, TS, VALUE

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

# Level factors that make the seasonal-naive base forecasts of the
# geography hierarchy deliberately incoherent (total, region, nation).
LEVEL_FACTORS = {"total": "1.05", "region": "0.95", "nation": "1.00"}
TOTAL_NODE = "total"
SEASON_MONTHS = 12
FORECAST_HORIZON = 12


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _money_sum(col: str) -> F.Column:
    return F.sum(F.col(col).cast("decimal(18,2)")).cast("double")


def _day(col: str) -> F.Column:
    return F.to_date(col).cast("timestamp_ntz")


def _month(col: str) -> F.Column:
    return F.trunc(F.to_date(col), "MM").cast("timestamp_ntz")


def _hour(col: str) -> F.Column:
    c = F.col(col)
    return F.make_timestamp_ntz(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c),
                                F.lit(0), F.lit(0))


def daily_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order revenue per priority and day (5 series)."""
    o = table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderdate", "o_totalprice")
    return (o.groupBy(F.col("o_orderpriority").alias(SERIES), _day("o_orderdate").alias(TS))
             .agg(_money_sum("o_totalprice").alias(VALUE)))


def monthly_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order revenue per customer nation and month (25 series, with gaps)."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = (o.join(c, o.o_custkey == c.c_custkey)
          .join(n, F.col("c_nationkey") == n.n_nationkey))
    return (j.groupBy(F.col("n_name").alias(SERIES), _month("o_orderdate").alias(TS))
             .agg(_money_sum("o_totalprice").alias(VALUE)))


def hourly_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event value per event type and hour (5 series, with gaps)."""
    e = table(spark, sf_dir, "events").select("event_type", "ts", "value")
    return (e.groupBy(F.col("event_type").alias(SERIES), _hour("ts").alias(TS))
             .agg(_money_sum("value").alias(VALUE)))


def shipments_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shipped quantity per return flag and day, under non-canonical names."""
    li = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_shipdate", "l_quantity")
    return (li.groupBy(F.col("l_returnflag").alias("flag"), _day("l_shipdate").alias("ship_day"))
              .agg(_money_sum("l_quantity").alias("qty")))


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = shipments_raw(spark, sf_dir)
    return r.select(F.col("flag").alias(SERIES), F.col("ship_day").alias(TS),
                    F.col("qty").alias(VALUE))


def geo_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hierarchy edges total → region → nation as ``(parent, child)``."""
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    n = table(spark, sf_dir, "nation").select("n_name", "n_regionkey")
    top = r.select(F.lit(TOTAL_NODE).alias("parent"), F.col("r_name").alias("child"))
    low = (n.join(r, n.n_regionkey == r.r_regionkey)
            .select(F.col("r_name").alias("parent"), F.col("n_name").alias("child")))
    return top.unionByName(low)


def region_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-level forest region → nation (one tree per region)."""
    return geo_edges(spark, sf_dir).where(F.col("parent") != F.lit(TOTAL_NODE))


def _levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly revenue of every node of the geography hierarchy, exact decimals.

    One aggregation with ``rollup(ts, region, nation)`` (a single pass over the
    orders) yields the nation, region and total levels.
    Columns ``node, level, ts, amount DECIMAL``.
    """
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    j = (o.join(c, o.o_custkey == c.c_custkey)
          .join(n, F.col("c_nationkey") == n.n_nationkey)
          .join(r, F.col("n_regionkey") == r.r_regionkey)
          .select(_month("o_orderdate").alias("ts"), "r_name", "n_name",
                  F.col("o_totalprice").cast("decimal(18,2)").alias("p")))
    g = (j.rollup("ts", "r_name", "n_name")
          .agg(F.sum("p").alias("amount"), F.grouping_id().alias("_gid")))
    # grouping_id bits (ts, r_name, n_name): 0 = nation, 1 = region, 3 = total, 7 = grand total
    lvl = (F.when(F.col("_gid") == 0, "nation").when(F.col("_gid") == 1, "region")
            .when(F.col("_gid") == 3, "total"))
    node = (F.when(F.col("_gid") == 0, F.col("n_name")).when(F.col("_gid") == 1, F.col("r_name"))
             .otherwise(F.lit(TOTAL_NODE)))
    return (g.where(F.col("_gid").isin(0, 1, 3))
             .select(node.alias("node"), lvl.alias("level"), "ts", "amount"))


def _factor() -> F.Column:
    return (F.when(F.col("level") == "total", F.lit(LEVEL_FACTORS["total"]).cast("decimal(3,2)"))
             .when(F.col("level") == "region", F.lit(LEVEL_FACTORS["region"]).cast("decimal(3,2)"))
             .otherwise(F.lit(LEVEL_FACTORS["nation"]).cast("decimal(3,2)")))


def base_forecasts(spark: SparkSession, sf_dir: str, horizon: int = FORECAST_HORIZON) -> DataFrame:
    """Seasonal-naive base forecasts of every hierarchy node, scaled per level.

    ``forecast(node, h) = factor(level) * y(node, last + h - 12 months)``, missing → 0.
    Columns ``node STRING, step INT, forecast DOUBLE``.  ``last`` is a scalar
    subquery (computed once, shipped as a literal), the step grid an
    ``explode(sequence(1, horizon))`` per node.
    """
    lv = _levels(spark, sf_dir)
    t_last = lv.agg(F.max("ts")).scalar()
    grid = (lv.select("node", "level").distinct()
              .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
              .withColumn("ts", F.add_months(t_last, F.col("step") - SEASON_MONTHS)
                          .cast("timestamp_ntz")))
    j = grid.join(lv.select("node", "ts", "amount"), ["node", "ts"], "left")
    return j.select("node", "step",
                    (F.coalesce(F.col("amount"), F.lit(0).cast("decimal(18,2)")) * _factor())
                    .cast("double").alias("forecast"))


def base_residuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In-sample seasonal-naive residuals of every node, over all months that have one 12 months earlier.

    ``residual(node, t) = y(node, m_t) - y(node, m_t - 12)`` on a dense node × t grid
    (missing observations count as 0).  Columns ``node STRING, t INT, residual DOUBLE``.
    """
    lv = _levels(spark, sf_dir)
    span = lv.agg(F.max("ts").alias("_last"),
                  (F.months_between(F.max("ts"), F.min("ts")).cast("int") - SEASON_MONTHS + 1).alias("_months"))
    t_last, months = span.select("_last").scalar(), span.select("_months").scalar()
    grid = (lv.select("node").distinct()
              .withColumn("t", F.explode(F.when(months > 0, F.sequence(F.lit(1), months))))
              .withColumn("m", F.add_months(t_last, F.col("t") - months).cast("timestamp_ntz"))
              .withColumn("m12", F.add_months(F.col("m"), -SEASON_MONTHS).cast("timestamp_ntz")))
    cur = lv.select("node", F.col("ts").alias("m"), F.col("amount").alias("a_cur"))
    prv = lv.select("node", F.col("ts").alias("m12"), F.col("amount").alias("a_prev"))
    zero = F.lit(0).cast("decimal(18,2)")
    j = grid.join(cur, ["node", "m"], "left").join(prv, ["node", "m12"], "left")
    return j.select("node", "t",
                    (F.coalesce("a_cur", zero) - F.coalesce("a_prev", zero)).cast("double")
                    .alias("residual"))


def historical_proportions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of each nation in the all-time total revenue: ``(node, proportion)``."""
    lv = _levels(spark, sf_dir).where(F.col("level") == "nation")
    per = lv.groupBy("node").agg(F.sum("amount").alias("a"))
    total = per.agg(F.sum("a")).scalar()
    return per.select("node", (F.col("a").cast("double") / total.cast("double"))
                      .alias("proportion"))
