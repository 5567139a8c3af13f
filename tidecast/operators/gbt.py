"""Gradient-boosted trees over feature frames (one global model for all series).

Spark ML ``GBTRegressor`` trains distributed over all rows; the reference's
defaults map to ``maxIter = n_estimators``, ``stepSize = learning_rate``,
``maxDepth = unlimited_depth`` when unlimited (-1), ``subsamplingRate = row_fraction`` and
``featureSubsetStrategy = feature_fraction``.  ``num_leaves`` has no counterpart.

A round of boosting is a handful of jobs, so the rows are packed into as few partitions as
``ROWS_PER_PARTITION`` allows: small frames would spend their time on starting tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import DEFAULT_COLS, SeriesCols
from ..session import discard, written
from . import features as feat
from . import grid

# Defaults of the boosted-tree forecaster.
N_ESTIMATORS = 500
LEARNING_RATE = 0.05
MAX_DEPTH = -1
DEPTH_WHEN_UNLIMITED = 5
ROWS_PER_PARTITION = 50_000
#: Least relative gain on the validation rows that keeps the boosting going.
VALIDATION_TOLERANCE = 1e-4


@dataclass
class GBTForecaster:
    model: PipelineModel
    feature_columns: list[str]
    target: str

    def predict(self, future: DataFrame, horizon: int | None = None,
                cols: SeriesCols = DEFAULT_COLS) -> DataFrame:
        """Direct prediction on supplied feature rows; keeps the first ``horizon`` per series.

        A missing feature column is an error (the reference silently narrowed the matrix).
        """
        missing = [c for c in self.feature_columns if c not in future.columns]
        if missing:
            raise ValueError(f"future frame lacks feature columns {missing}")
        out = self.model.transform(_filled(future, self.feature_columns)).withColumnRenamed("prediction", "forecast")
        out = out.drop("_features")
        if horizon is not None:
            from . import windows
            d = windows.with_position(out, cols)
            out = d.where(F.col(windows.POS) <= horizon).drop(windows.POS)
        return out

    def forecast(self, spine: DataFrame, future: DataFrame | None = None, cols: SeriesCols = DEFAULT_COLS) -> DataFrame:
        """``spine`` with ``forecast``: the features of ``future`` meet the horizon on (series, timestamp).

        Steps without features get the prediction at the zero vector (``naive`` is 1 there), as does every step without ``future``.
        """
        if future is None:
            return self.predict_zero(spine.sparkSession, spine).withColumn("naive", F.lit(1))
        missing = [c for c in self.feature_columns if c not in future.columns]
        if missing:
            raise ValueError(f"future frame lacks feature columns {missing}")
        keys = [cols.series, cols.ts]
        given = future.select(*keys, *[F.col(c).alias(f"_f{i}") for i, c in enumerate(self.feature_columns)], F.lit(0).alias("_given"))
        rows = spine.join(given, keys, "left")
        named = rows.select(F.struct(*spine.columns).alias("_row"), F.coalesce("_given", F.lit(1)).alias("naive"),
                            *[F.col(f"_f{i}").alias(c) for i, c in enumerate(self.feature_columns)])
        out = self.model.transform(_filled(named, self.feature_columns))
        return out.select("_row.*", F.col("prediction").alias("forecast"), "naive")

    def predict_zero(self, spark: SparkSession, spine: DataFrame) -> DataFrame:
        """Fallback without future features: the prediction at the zero vector, repeated."""
        zero = spark.range(1).select(*[F.lit(0.0).alias(c) for c in self.feature_columns])
        value = self.model.transform(zero).select("prediction").first()[0]
        return spine.withColumn("forecast", F.lit(float(value)))

    def importance(self, spark: SparkSession) -> DataFrame:
        """``(feature, importance)`` by descending importance."""
        gbt = self.model.stages[-1]
        imp = gbt.featureImportances.toArray().tolist()
        rows = list(zip(self.feature_columns, map(float, imp)))
        return (spark.createDataFrame(rows, "feature string, importance double")
                .orderBy(F.col("importance").desc(), F.col("feature")))


def _filled(df: DataFrame, columns: list[str]) -> DataFrame:
    """A feature that is not known counts 0 (``step`` tells which lags cannot be)."""
    return df.withColumns({c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None)), F.lit(0.0)) for c in columns})


def fit(train: DataFrame, feature_columns: list[str] | None = None, target: str = "value",
        n_estimators: int = N_ESTIMATORS, learning_rate: float = LEARNING_RATE,
        max_depth: int = MAX_DEPTH, seed: int = 42, cols: SeriesCols = DEFAULT_COLS, row_fraction: float = 1.0,
        feature_fraction: float = 1.0, unlimited_depth: int = DEPTH_WHEN_UNLIMITED, validation_share: float = 0.0) -> GBTForecaster:
    """Train one boosted-tree model on all rows of ``train``.

    With ``validation_share`` the latest share of the rows does not teach but ends the boosting once its error stops falling.
    """
    fc = feature_columns if feature_columns is not None else \
        feat.numeric_feature_columns(train, target, cols)
    depth = unlimited_depth if max_depth in (-1, None) else max_depth
    assembler = VectorAssembler(inputCols=fc, outputCol="_features", handleInvalid="keep")
    gbt = GBTRegressor(featuresCol="_features", labelCol=target, predictionCol="prediction",
                       maxIter=n_estimators, stepSize=learning_rate, subsamplingRate=row_fraction,
                       featureSubsetStrategy="all" if feature_fraction >= 1 else str(feature_fraction),
                       maxDepth=depth, seed=seed, checkpointInterval=10, cacheNodeIds=True)
    rows = _filled(train.where(F.col(target).isNotNull()), fc)
    keep = ["_features", target]
    if validation_share > 0:
        cut = rows.agg(F.percentile_approx(F.unix_micros(F.col(cols.ts).cast("timestamp")), 1 - validation_share, 10_000)).first()[0]
        rows = rows.withColumn("_late", F.unix_micros(F.col(cols.ts).cast("timestamp")) > F.lit(cut))
        gbt = gbt.setParams(validationIndicatorCol="_late", validationTol=VALIDATION_TOLERANCE)
        keep.append("_late")
    # MLlib persists the assembled instances itself (the input is not cached here) and
    # scans them once per boosting iteration.
    vectors = written(assembler.transform(rows).select(*keep), "gbt")
    n = vectors.count()
    if n == 0:
        raise ValueError("no rows to train on")
    fitted = gbt.fit(vectors.coalesce(max(1, -(-n // ROWS_PER_PARTITION))))
    discard(vectors)
    return GBTForecaster(PipelineModel(stages=[assembler, fitted]), fc, target)


def future_spine(df: DataFrame, horizon: int, freq: str = "D",
                 cols: SeriesCols = DEFAULT_COLS) -> DataFrame:
    return grid.future_spine(df, horizon, freq=freq, cols=cols)

