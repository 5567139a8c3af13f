"""Training plan: features → split → CV → final fit → test scoring.

Every step is a Spark job over all series at once:

* features are computed once and checkpointed (they feed split, CV and fit);
* the split and the folds are per-series positional predicates;
* for the per-series models (Holt-Winters, trend + season) the fold is part of
  the series key, so one job fits every fold × series;
* the boosted-tree model is global: one fit for each fold, on the folds' rows of the one written feature table;
* the ensemble combines the members' forecasts, in every fold as in the test part;
* a member that raises is listed with its fold, and the rest goes on;
* scoring starts from the actual rows: each meets the forecast of the grid step that it belongs to, and
  rows that meet none are counted.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import ensemble as ens
from ..operators import evaluate as ev
from ..operators import features as feat
from ..operators import gbt, grid, split, windows
from ..operators import horizon as hz
from ..operators import holtwinters as hw
from ..operators import trendseason as tsr
from ..schema import SERIES, TS, VALUE
from ..session import cut_lineage

MIN_TRAIN_FOR_CV = 50
_KEY_SEP = "|"


@dataclass
class TrainingConfig:
    spec: feat.FeatureSpec = field(default_factory=feat.FeatureSpec)
    train_ratio: float = 0.8
    n_folds: int = 3
    season: int = 7
    freq: str = "D"
    gbt_params: dict = field(default_factory=lambda: dict(n_estimators=300, learning_rate=0.05,
                                                           max_depth=-1))
    # The demo ensemble weights (decomposable model 0.4, boosted trees 0.6).
    ensemble_weights: tuple = (("trend_season", 0.4), ("gbt", 0.6))
    run_cv: bool = True
    # CV scores the same Holt-Winters search as the final fit
    cv_refine: bool = True


@dataclass
class TrainingResult:
    cv_metrics: DataFrame | None
    final_metrics: DataFrame
    train: DataFrame
    test: DataFrame
    gbt_model: gbt.GBTForecaster | None
    #: ``(model, fold, error)``; fold 0 is the final fit.
    failures: DataFrame = None


FORECASTS = "model string, series_id string, fold int, step int, actual double, forecast double"
PER_SERIES = ("holt_winters", "trend_season")


def _series_forecasts(model: str, reg: DataFrame, rows: DataFrame, horizon: int, cfg: TrainingConfig, refine: bool) -> DataFrame:
    """``(series_id, step, timestamp, forecast)`` of a per-series model; ``reg`` is ``rows`` on the grid."""
    if model == "holt_winters":
        return hw.forecast(hw.fit(reg, cfg.season, refine=refine), horizon, cfg.freq).select(SERIES, "step", TS, "forecast")
    return tsr.forecast(tsr.fit(rows.select(SERIES, TS, VALUE)), horizon, cfg.freq).select(SERIES, "step", TS, "forecast")


def on_steps(actual: DataFrame, fc: DataFrame, freq: str) -> DataFrame:
    """``actual`` rows with the ``forecast`` of the step at or after them, counted from the origin of the forecasts (NULL: none)."""
    first = fc.where("step = 1").select(SERIES, grid.shift(F.col(TS), freq, -1).alias("_origin"))
    placed = actual.join(first, SERIES, "left").withColumn("_step", grid.step_at_or_after(F.col("_origin"), F.col(TS), freq))
    return placed.join(fc.select(SERIES, F.col("step").cast("long").alias("_step"), "forecast"), [SERIES, "_step"], "left").drop("_origin", "_step")


class _Members:
    """Runs members one by one; keeps what they forecast and what they raise."""

    def __init__(self, spark):
        self.spark, self.frames, self.errors = spark, [], []

    def run(self, model: str, folds: list[int], make) -> None:
        try:
            out = make().select(F.lit(model).alias("model"), SERIES, F.col(split.FOLD).cast("int").alias(split.FOLD), F.col("step").cast("int").alias("step"),
                                F.col("actual").cast("double").alias("actual"), F.col("forecast").cast("double").alias("forecast"))
            self.frames.append(cut_lineage(out))
        except Exception as e:  # a member may fail in any way; the others go on
            self.errors += [(model, f, f"{type(e).__name__}: {str(e)[:500]}") for f in folds]

    def scored(self, weights) -> tuple[DataFrame, DataFrame]:
        """Metrics by (model, series, fold) with the ensemble, and the failures."""
        members = ev.union_all(self.frames) if self.frames else self.spark.createDataFrame([], FORECASTS)
        w = self.spark.createDataFrame(list(weights), "model string, weight double")
        keys = (SERIES, split.FOLD)
        chosen = members.join(w.select("model"), "model", "left_semi")
        blend = ens.combine(chosen, "weighted_average", w, keys=keys, align=False)
        actual = members.groupBy(*keys, "step").agg(F.max("actual").alias("actual"))
        blend = blend.join(actual, [*keys, "step"]).select(F.lit("ensemble").alias("model"), *keys, "step", "actual", "forecast")
        every = members.unionByName(blend)
        by = ("model", *keys)
        metrics = ev.forecast_metrics(every.where(F.col("forecast").isNotNull()), by=by)
        missed = every.groupBy(*by).agg(F.count_if(F.col("forecast").isNull()).alias("n_unmatched"))
        return metrics.join(missed, list(by)), self.spark.createDataFrame(self.errors, "model string, fold int, error string")


def _horizon(train: DataFrame, later: DataFrame, freq: str) -> int:
    """Steps of ``freq`` from the end of each series' train rows to the last of ``later``, the most of all series."""
    ends = train.groupBy(SERIES).agg(F.max(TS).alias("_lo")).join(later.groupBy(SERIES).agg(F.max(TS).alias("_hi")), SERIES)
    # one more, as the train rows need not end on the grid
    return int(ends.agg(F.max(grid.step_at_or_after(F.col("_lo"), F.col("_hi"), freq))).first()[0] or 0) + 1


def cv_frame(train: DataFrame, cfg: TrainingConfig) -> DataFrame:
    """Folds of the train part with all its feature columns; series of ``MIN_TRAIN_FOR_CV`` rows or fewer have none."""
    big = train.groupBy(SERIES).count().where(F.col("count") > MIN_TRAIN_FOR_CV).select(SERIES)
    return split.expanding_folds(train.join(big, SERIES, "left_semi"), cfg.n_folds)


def cross_validate(train: DataFrame, cfg: TrainingConfig) -> tuple[DataFrame, DataFrame]:
    """Metrics per ``(model, series_id, fold)`` over expanding folds of the train part, and ``(model, fold, error)`` of what failed."""
    folds = cut_lineage(cv_frame(train, cfg))
    numbers = [r[0] for r in folds.select(split.FOLD).distinct().orderBy(split.FOLD).collect()]  # n_folds at most
    members = _Members(train.sparkSession)
    # the fold comes first: it holds no separator, a series id may
    key = F.concat_ws(_KEY_SEP, F.col(split.FOLD).cast("string"), F.col(SERIES))
    fold_train = folds.where(F.col(split.ROLE) == "train")
    fold_val = folds.where(F.col(split.ROLE) == "val").withColumn("step", (F.col(windows.POS) - F.col("train_end")).cast("int"))
    keyed = fold_train.select(key.alias(SERIES), TS, VALUE)
    val = fold_val.select(key.alias(SERIES), TS, "step", F.col(VALUE).alias("actual"))
    if numbers:
        # the fits read the grid many times: written once, their plans stay small
        reg = cut_lineage(grid.regularise(keyed, cfg.freq, with_position=True).drop("filled"))
        horizon = _horizon(keyed, val, cfg.freq)
    parts = F.split(F.col(SERIES), r"\|", 2)
    for model in PER_SERIES if numbers else ():
        members.run(model, numbers, lambda: on_steps(val, _series_forecasts(model, reg, keyed, horizon, cfg, cfg.cv_refine), cfg.freq).withColumn(
            split.FOLD, F.element_at(parts, 1).cast("int")).withColumn(SERIES, F.element_at(parts, 2)))
    features = gbt_columns(train)
    for n in numbers:
        members.run("gbt", [n], lambda: gbt.fit(fold_train.where(F.col(split.FOLD) == n), features, **cfg.gbt_params).predict(
            fold_val.where(F.col(split.FOLD) == n)).withColumn("actual", F.col(VALUE)))
    return members.scored(cfg.ensemble_weights)


def run(raw: DataFrame, cfg: TrainingConfig = TrainingConfig(),
        gbt_model: gbt.GBTForecaster | None = None) -> TrainingResult:
    features = cut_lineage(feat.all_features(raw, cfg.spec))
    labelled = cut_lineage(split.chrono_split(features, cfg.train_ratio))
    n_train = F.floor(F.col(windows.N_ROWS).cast("double") * F.lit(cfg.train_ratio))
    train = labelled.where(F.col(split.SPLIT) == "train").drop(split.SPLIT, windows.POS,
                                                               windows.N_ROWS)
    test = (labelled.where(F.col(split.SPLIT) == "test")
                    .withColumn("step", (F.col(windows.POS) - n_train).cast("int"))
                    .drop(split.SPLIT, windows.POS, windows.N_ROWS))
    cv, failed = cross_validate(train, cfg) if cfg.run_cv else (None, None)

    members = _Members(raw.sparkSession)
    actual = test.select(SERIES, TS, "step", F.col(VALUE).alias("actual")).withColumn(split.FOLD, F.lit(0))
    rows = train.select(SERIES, TS, VALUE)
    reg = cut_lineage(grid.regularise(rows, cfg.freq, with_position=True).drop("filled"))
    horizon = _horizon(train, test, cfg.freq)
    for model in PER_SERIES:
        members.run(model, [0], lambda: on_steps(actual, _series_forecasts(model, reg, rows, horizon, cfg, True), cfg.freq))
    model = [gbt_model]

    def boosted():
        model[0] = gbt_model or gbt.fit(train, gbt_columns(train), **cfg.gbt_params)
        return model[0].predict(test).withColumn("actual", F.col(VALUE)).withColumn(split.FOLD, F.lit(0))

    members.run("gbt", [0], boosted)
    final, errors = members.scored(cfg.ensemble_weights)
    return TrainingResult(None if cv is None else cut_lineage(cv), cut_lineage(final.drop(split.FOLD)), train, test, model[0],
                          errors if failed is None else failed.unionByName(errors))


def summary(result: TrainingResult) -> DataFrame:
    """Final test metrics per (model, series) with the CV mean RMSE alongside."""
    out = result.final_metrics
    if result.cv_metrics is not None:
        cvm = result.cv_metrics.groupBy("model", SERIES).agg(
            ev.round_half_away(F.avg("rmse"), 4).alias("cv_rmse_mean"))
        out = out.join(cvm, ["model", SERIES], "left")
    else:
        out = out.withColumn("cv_rmse_mean", F.lit(None).cast("double"))
    return out


def best_forecast(raw: DataFrame, metrics: DataFrame, horizon: int, cfg: TrainingConfig = TrainingConfig()) -> DataFrame:
    """``(series_id, step, timestamp, model, forecast)``: the ``horizon`` steps after the last row by each series' best model.

    ``metrics`` are those of :func:`run`; the models are fitted again on all rows.  The boosted trees see the horizon through
    :mod:`operators.horizon`; only models that are some series' best (or members of the ensemble) are fitted.
    """
    rows = cut_lineage(raw.select(SERIES, TS, VALUE))
    best = cut_lineage(ev.best_model(metrics).select(SERIES, F.col("best_model").alias("model")))
    asked = {r[0] for r in best.select("model").distinct().collect()}  # of the few models
    weights = dict(cfg.ensemble_weights)
    needed = asked | (set(weights) if "ensemble" in asked else set())
    # all models answer for the same steps: those of the grid
    spine = cut_lineage(grid.future_spine(rows, horizon, freq=cfg.freq))
    parts = []
    reg = cut_lineage(grid.regularise(rows, cfg.freq, with_position=True).drop("filled")) if "holt_winters" in needed else None
    for model in PER_SERIES:
        if model in needed:
            parts.append(_series_forecasts(model, reg, rows, horizon, cfg, True).select(F.lit(model).alias("model"), SERIES, F.col("step").cast("int").alias("step"), "forecast"))
    if "gbt" in needed:
        seen = hz.training_frame(rows, horizon, cfg.spec)
        trees = gbt.fit(seen, gbt_columns(seen), **cfg.gbt_params)
        parts.append(trees.forecast(spine, hz.future_frame(rows, horizon, cfg.spec, cfg.freq)).select(F.lit("gbt").alias("model"), SERIES, "step", "forecast"))
    members = cut_lineage(ev.union_all(parts))
    if "ensemble" in asked:
        w = raw.sparkSession.createDataFrame(list(cfg.ensemble_weights), "model string, weight double")
        blend = ens.combine(members.join(w.select("model"), "model", "left_semi"), "weighted_average", w)
        members = members.unionByName(blend.select(F.lit("ensemble").alias("model"), SERIES, "step", "forecast"))
    return members.join(best, ["model", SERIES]).join(spine, [SERIES, "step"]).select(SERIES, "step", TS, "model", "forecast")


def gbt_columns(frame: DataFrame) -> list[str]:
    return feat.numeric_feature_columns(frame, VALUE)
