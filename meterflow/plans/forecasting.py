"""Forecast routing, the model ladder and the end-to-end job."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.operators.clean import interpolate_flagged
from meterflow.operators.features import base_features
from meterflow.operators.forecast import (additive_forecast, boosted_forecast, seasonal_naive,
                                          window_regression_forecast)
from meterflow.operators.metrics import compare_to_floor, forecast_scorecard
from meterflow.operators.ordering import ensure_row_index
from meterflow.operators.splits import forecast_split
from meterflow.plans.detection import attach_flags, detect, row_key
from meterflow.plans.ledger import StageLedger, files_fingerprint
from meterflow.session import materialize, scratch_path
from meterflow.sources.readings import read_clean, read_readings
from meterflow.sources.sinks import write_predictions
from meterflow.spec import DEFAULT_LAYOUT, Layout, SeriesSpec

# Model names in ladder order. The last two are served by Spark's own learners.
MODELS = ("naive", "prophet", "xgboost", "lstm")


def run_forecast(df: DataFrame, spec: SeriesSpec, model: str = "naive", layout: Layout = DEFAULT_LAYOUT,
                 trees: int = 100) -> DataFrame:
    """Test predictions of one model on a clean table, each with its own preparation.

    Naive and additive models split the rows themselves; lag and window models first build their
    samples on the whole series and then split those, so their test parts are a little shorter.
    """
    key = model.strip().lower()
    if key not in MODELS:
        raise ValueError(f"Unsupported model {model!r}; use one of {MODELS}")
    indexed = ensure_row_index(df, spec, layout)
    if key == "naive":
        return seasonal_naive(forecast_split(indexed, spec, layout=layout), spec, layout=layout)
    if key == "prophet":
        return additive_forecast(forecast_split(indexed, spec, layout=layout), spec, layout=layout)
    if key == "xgboost":
        return boosted_forecast(indexed, spec, trees, layout)
    return window_regression_forecast(indexed, spec, layout=layout)


def collect_predictions(df: DataFrame, spec: SeriesSpec, models: Sequence[str] = MODELS,
                        layout: Layout = DEFAULT_LAYOUT, trees: int = 100) -> DataFrame:
    """Predictions of all models in one table with a ``model`` column."""
    clean = materialize(ensure_row_index(df, spec, layout))
    frames = [run_forecast(clean, spec, m, layout, trees).withColumn("model", F.lit(m)) for m in models]
    return reduce(DataFrame.unionByName, frames)


def prediction_ranges(predictions: DataFrame, spec: SeriesSpec) -> DataFrame:
    return predictions.groupBy("model").agg(F.count(F.lit(1)).alias("rows"), F.min(spec.ts).alias("start_ts"),
                                            F.max(spec.ts).alias("end_ts"))


def ladder(df: DataFrame, spec: SeriesSpec, models: Sequence[str] = MODELS, layout: Layout = DEFAULT_LAYOUT,
           trees: int = 100) -> DataFrame:
    """Scorecard of all models with their verdict against the naive floor."""
    scores = materialize(forecast_scorecard(collect_predictions(df, spec, models, layout, trees)))
    verdict = compare_to_floor(scores).select("model", "mae_vs_floor", "rmse_vs_floor", "beats_floor")
    return scores.join(verdict, "model", "left")


def ladder_from_artefact(spark: SparkSession, path: str, spec: SeriesSpec = SeriesSpec(),
                         file_format: str = "parquet", trees: int = 100, models: Sequence[str] = MODELS,
                         ledger: StageLedger | None = None, layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """Scorecard of the models over a clean artefact; a ledger keeps the numbered rows and the predictions of each model."""
    ledger = ledger or StageLedger(spark, scratch_path(spark, "ladder"))
    settings = (spec, layout, file_format)
    clean = ledger.stage("clean-rows", [files_fingerprint(spark, path)], settings, lambda: ensure_row_index(
        read_clean(spark, path, target=spec.target, file_format=file_format), spec, layout))

    def predicted(model: str) -> DataFrame:
        return ledger.stage(f"predicted-{model}", [clean.mark], (settings, trees), lambda: run_forecast(
            clean.table, spec, model, layout, trees).withColumn("model", F.lit(model))).table

    scores = materialize(forecast_scorecard(reduce(DataFrame.unionByName, [predicted(m) for m in models])))
    verdict = compare_to_floor(scores).select("model", "mae_vs_floor", "rmse_vs_floor", "beats_floor")
    return scores.join(verdict, "model", "left")


def detect_clean_forecast(df: DataFrame, spec: SeriesSpec, model: str = "naive", detector: str = "isolation_forest",
                          layout: Layout = DEFAULT_LAYOUT, trees: int = 100, **settings: object) -> DataFrame:
    """Features, flags, interpolation, split and forecast in one go; returns test predictions."""
    features = materialize(base_features(df, spec, layout))
    clean = materialize(_cleaned(features, spec, detector, layout, settings))
    return run_forecast(clean, spec, model, layout, trees)


def _cleaned(features: DataFrame, spec: SeriesSpec, detector: str, layout: Layout, settings: dict[str, object]) -> DataFrame:
    flagged = detect(features, spec, detector, layout=layout, **settings)
    marked = attach_flags(features, flagged.select(*row_key(spec), "is_anomaly"), spec)
    return interpolate_flagged(marked, spec, layout=layout).drop("is_anomaly")


def run_job(spark: SparkSession, source: str, predictions_path: str, model: str = "naive", spec: SeriesSpec = SeriesSpec(),
            layout: Layout = DEFAULT_LAYOUT, detector: str = "isolation_forest", trees: int = 100,
            ledger: StageLedger | None = None, **settings: object) -> DataFrame:
    """Readings file to predictions file; returns the scorecard of the predictions.

    Features, clean rows and predictions are stages of a ledger: give the same folder again to go on with a job that was cut off.
    """
    ledger = ledger or StageLedger(spark, scratch_path(spark, "job"))
    plan = (spec, layout)
    features = ledger.stage("features", [files_fingerprint(spark, source)], plan, lambda: base_features(read_readings(spark, source), spec, layout))
    clean = ledger.stage("clean", [features.mark], (plan, detector, sorted(settings.items())), lambda: _cleaned(features.table, spec, detector, layout, settings))
    predicted = ledger.stage("predictions", [clean.mark], (model, trees), lambda: run_forecast(clean.table, spec, model, layout, trees))
    write_predictions(predicted.table, predictions_path, ts=spec.ts)
    return forecast_scorecard(predicted.table.withColumn("model", F.lit(model)))
