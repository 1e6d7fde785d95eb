"""Detector routing and detection profiles: from features to a flag on every scored row."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.functions.checks import require_columns
from meterflow.operators.density import density_noise
from meterflow.operators.features import base_features, encode_labels, enhanced_features
from meterflow.operators.forest import contamination_flag, contamination_offset, fit_forest
from meterflow.operators.matrix import ModelMatrix, model_matrix
from meterflow.operators.splits import tuning_split
from meterflow.operators.thresholds import best_threshold, ensemble_flag, flag_at, min_max
from meterflow.session import materialize
from meterflow.spec import DEFAULT_LAYOUT, LABEL, Layout, SeriesSpec


@dataclass(frozen=True)
class ForestConfig:
    """Isolation forest settings. ``threshold`` flags at a fixed score; ``tune_threshold`` finds the
    cut-off with the best F1 on the validation split; otherwise ``contamination`` decides."""

    contamination: float = 0.05
    trees: int = 100
    max_features: float | int = 1.0
    scale: bool = False
    drop_weather: bool = False
    threshold: float | None = None
    tune_threshold: bool = False
    fit_on: str | None = None
    seed: int = 42


@dataclass(frozen=True)
class DensityConfig:
    eps: float = 0.5
    min_samples: int = 5
    metric: str = "euclidean"
    scale: bool = False
    drop_weather: bool = False
    fit_on: str | None = None


@dataclass(frozen=True)
class EnsembleConfig:
    strategy: str = "intersection"
    alpha: float = 0.7


# The tuned settings of the published study. Its score threshold belongs to another
# forest implementation's score scale, so here the cut-off is searched on the validation split.
TUNED_FOREST = ForestConfig(contamination=0.03, trees=200, max_features=0.6, scale=True)
TUNED_FOREST_NO_WEATHER = ForestConfig(contamination=0.03, trees=200, max_features=1.0, scale=True,
                                       drop_weather=True)
TUNED_DENSITY = DensityConfig(eps=10.0, min_samples=10, metric="manhattan", scale=True)
TUNED_ENSEMBLE = EnsembleConfig(strategy="union", alpha=0.7)

PROFILES = ("legacy", "legacy_threshold", "enhanced")


def row_key(spec: SeriesSpec) -> list[str]:
    return [*spec.series, spec.ts, *spec.tiebreak]


def forest_scores(matrix: ModelMatrix, spec: SeriesSpec, config: ForestConfig,
                  layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """Matrix rows with ``score`` shifted so that 0 is the contamination cut-off, checkpointed."""
    fit_rows = matrix.rows.where(F.col("split") == config.fit_on) if config.fit_on else matrix.rows
    forest = fit_forest(fit_rows, matrix.inputs, row_key(spec), trees=config.trees,
                        max_features=config.max_features, seed=config.seed)
    scored = materialize(forest.score(matrix.rows))
    fitted = scored.where(F.col("split") == config.fit_on) if config.fit_on else scored
    offset = contamination_offset(fitted, "score", config.contamination, layout)
    return scored.withColumn("score", F.round(F.col("score") - offset, 12))


def detect_forest(df: DataFrame, spec: SeriesSpec, config: ForestConfig = ForestConfig(),
                  layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """Complete rows of a feature table with ``score`` and ``is_anomaly``."""
    if config.tune_threshold and config.fit_on is None:
        config = replace(config, fit_on="train")
    matrix = model_matrix(df, spec, scale=config.scale, drop_weather=config.drop_weather,
                          fit_on=config.fit_on, layout=layout)
    scored = forest_scores(matrix, spec, config, layout)
    if config.threshold is not None:
        return scored.withColumn("is_anomaly", flag_at("score", config.threshold))
    if config.tune_threshold:
        validation = encode_labels(scored.where(F.col("split") == "val"))
        cut = best_threshold(validation, "score", layout=layout).first()["threshold"]
        return scored.withColumn("is_anomaly", flag_at("score", cut))
    return scored.withColumn("is_anomaly", contamination_flag("score", 0.0))


def detect_density(df: DataFrame, spec: SeriesSpec, config: DensityConfig = DensityConfig(),
                   layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """Complete rows of a feature table with ``is_anomaly`` set for density noise."""
    matrix = model_matrix(df, spec, scale=config.scale, drop_weather=config.drop_weather,
                          fit_on=config.fit_on, layout=layout)
    return density_noise(matrix.rows, matrix.inputs, config.eps, config.min_samples, config.metric, layout=layout)


def detect_ensemble(df: DataFrame, spec: SeriesSpec, forest: ForestConfig = ForestConfig(scale=True),
                    density: DensityConfig = DensityConfig(scale=True), ensemble: EnsembleConfig = EnsembleConfig(),
                    layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """Forest and density flags of every complete row, combined by the chosen strategy."""
    flagged = detect_forest(df, spec, forest, layout)
    inputs = [c for c in flagged.columns if c.endswith("_scaled") or c == "hour_zscore"]
    same_matrix = (forest.scale, forest.drop_weather, forest.fit_on) == \
        (density.scale, density.drop_weather, density.fit_on)
    if same_matrix and density.scale:
        both = density_noise(flagged, inputs, density.eps, density.min_samples, density.metric, "density_flag", layout)
    else:
        noise = detect_density(df, spec, density, layout)
        key = F.struct(*row_key(spec))
        both = (flagged.withColumn("_key", key)
                .join(noise.select(key.alias("_key"), F.col("is_anomaly").alias("density_flag")), "_key")
                .drop("_key"))
    both = min_max(both.withColumnRenamed("is_anomaly", "forest_flag"), "score")
    return both.withColumn("is_anomaly", ensemble_flag(
        ensemble.strategy, "forest_flag", "density_flag", "score_norm", ensemble.alpha))


def detect(df: DataFrame, spec: SeriesSpec, model: str = "isolation_forest",
           feature_builder: Callable[[DataFrame], DataFrame] | None = None, layout: Layout = DEFAULT_LAYOUT,
           **settings: object) -> DataFrame:
    """Route to a detector by name; features are built when ``hour`` is missing or a builder is given."""
    if feature_builder is not None:
        df = feature_builder(df)
    elif "hour" not in df.columns:
        df = base_features(df, spec, layout)
    detectors = {"isolation_forest": detect_forest, "dbscan": detect_density, "ensemble": detect_ensemble}
    key = model.strip().lower()
    if key not in detectors:
        raise ValueError(f"Unsupported model {model!r}; use one of {sorted(detectors)}")
    return detectors[key](df, spec, layout=layout, **settings)


def profile_flags(df: DataFrame, spec: SeriesSpec, profile: str = "legacy",
                  layout: Layout = DEFAULT_LAYOUT) -> tuple[DataFrame, DataFrame]:
    """Feature table of a profile and the flags (series keys, time, is_anomaly) of its scored rows."""
    if profile not in PROFILES:
        raise ValueError(f"Unsupported profile {profile!r}; use one of {PROFILES}")
    build = enhanced_features if profile == "enhanced" else base_features
    features = materialize(build(df, spec, layout))
    if profile == "legacy":
        flagged = detect_forest(features, spec, ForestConfig(), layout)
    elif profile == "legacy_threshold":
        flagged = detect_forest(features, spec, ForestConfig(fit_on="train", tune_threshold=True), layout)
    else:
        # Scaler and forest see all rows here; only the cut-off is chosen on validation labels.
        scored = detect_forest(features, spec, TUNED_FOREST, layout)
        require_columns(scored, [LABEL], ValueError)
        split = tuning_split(scored, spec, layout=layout)
        cut = best_threshold(encode_labels(split.where(F.col("split") == "val")), "score",
                             layout=layout).first()["threshold"]
        flagged = scored.withColumn("is_anomaly", flag_at("score", cut))
    return features, flagged.select(*row_key(spec), "is_anomaly")


def attach_flags(features: DataFrame, flags: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Put the flags of the scored rows on all rows; warm-up rows get NULL."""
    key = F.struct(*row_key(spec))
    return (features.drop("is_anomaly").withColumn("_key", key)
            .join(flags.select(key.alias("_key"), "is_anomaly"), "_key", "left").drop("_key"))
