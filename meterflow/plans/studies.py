"""Detector studies: parameter grids, ensemble sweep and the comparison board."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.functions.literals import double_rows
from meterflow.operators.density import density_noise, density_noise_grid
from meterflow.operators.features import base_features, encode_labels, enhanced_features
from meterflow.operators.forest import contamination_flag, contamination_offset, fit_forest
from meterflow.operators.matrix import ModelMatrix, model_matrix, tuning_bundle
from meterflow.operators.metrics import detection_scorecard
from meterflow.operators.quantiles import exact_quantiles
from meterflow.operators.splits import tuning_split
from meterflow.operators.thresholds import best_threshold, ensemble_flag, flag_at, min_max, threshold_curves
from meterflow.plans.detection import (TUNED_DENSITY, TUNED_FOREST, DensityConfig, ForestConfig, forest_scores,
                                       row_key)
from meterflow.session import materialize
from meterflow.spec import DEFAULT_LAYOUT, Layout, SeriesSpec

# The parameter grids of the published study.
CONTAMINATION_GRID = (0.03, 0.04, 0.05, 0.06, 0.07, 0.08)
TREES_GRID = (100, 200, 300)
MAX_FEATURES_GRID = (1.0, 0.8, 0.6)
LEGACY_EPS_GRID = (0.1, 0.3, 0.5, 0.7)
LEGACY_MIN_SAMPLES_GRID = (5, 10, 20)
EPS_GRID = (0.5, 0.75, 1.0, 1.25, 1.5, 2.0, 2.5, 3.0, 4.0, 5.0, 6.0, 8.0, 10.0)
MIN_SAMPLES_GRID = (3, 5, 10, 15, 20)
METRIC_GRID = ("euclidean", "manhattan")
ALPHA_GRID = (0.5, 0.6, 0.7, 0.8, 0.9)


def forest_grid(df: DataFrame, spec: SeriesSpec, *, contaminations: Sequence[float] = CONTAMINATION_GRID,
                trees: Sequence[int] = TREES_GRID, max_features: Sequence[float] = MAX_FEATURES_GRID,
                drop_weather: bool = False, seed: int = 42, layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """Validation F1 of every setting with a searched threshold and with the contamination cut-off.

    Trees do not depend on contamination, and a smaller forest is the start of a larger one, so one
    forest per feature share serves the whole grid; all scores are computed in one pass each. The
    result has one row per setting, best first (ties keep grid order).
    """
    bundle = tuning_bundle(df, spec, scale=True, drop_weather=drop_weather, layout=layout)
    forests = [(share, count) for share in max_features for count in trees]
    long = _grid_scores(bundle, spec, trees, max_features, seed)
    val = long.where(F.col("split") == "val")
    ladders = _candidates_by_forest(val, len(forests), layout)
    curves = threshold_curves(val, "score", ladders, "forest")
    best = curves.groupBy("forest").agg(F.max_by(F.struct("threshold", "f1"), F.struct("f1", -F.col("threshold"))).alias("b"))
    searched = {r["forest"]: r["b"] for r in best.collect()}
    cut = exact_quantiles(long.where(F.col("split") == "train"), "score", [1.0 - c for c in contaminations],
                          ["forest"], layout)
    offsets = {r["forest"]: r["quantiles"] for r in cut.collect()}
    f1_cut = _f1_at_offsets(val, [offsets[i] for i in range(len(forests))], len(contaminations))

    rows = []
    for i, contamination in enumerate(contaminations):
        for count in trees:
            for share in max_features:
                forest = forests.index((share, count))
                threshold, f1 = searched[forest]
                by_cut = f1_cut[forest][i]
                rows.append((len(rows), contamination, count, share, threshold if f1 >= by_cut else None,
                             "threshold" if f1 >= by_cut else "contamination", f1, by_cut, max(f1, by_cut)))
    schema = ("grid_order int, contamination double, trees int, max_features double, threshold double, "
              "mode string, f1_threshold double, f1_contamination double, val_f1 double")
    return df.sparkSession.createDataFrame(rows, schema).orderBy(F.desc("val_f1"), "grid_order")


def forest_winner(df: DataFrame, spec: SeriesSpec, *, drop_weather: bool = False, seed: int = 42,
                  layout: Layout = DEFAULT_LAYOUT, **grid: Sequence[float]) -> DataFrame:
    """Scores per split of the grid's best setting, fitted again on the train rows and flagged in its winning mode."""
    best = forest_grid(df, spec, drop_weather=drop_weather, seed=seed, layout=layout, **grid).first()
    bundle = tuning_bundle(df, spec, scale=True, drop_weather=drop_weather, layout=layout)
    train = bundle.rows.where(F.col("split") == "train")
    forest = fit_forest(train, bundle.inputs, row_key(spec), trees=best["trees"], max_features=best["max_features"], seed=seed)
    scored = materialize(forest.score(bundle.rows).select("split", "label", F.round("score", 12).alias("score")))
    if best["mode"] == "threshold":
        flag = flag_at("score", best["threshold"])
    else:
        flag = contamination_flag("score", contamination_offset(scored.where(F.col("split") == "train"), "score", best["contamination"], layout))
    settings = [F.lit(best[c]).alias(c) for c in ("contamination", "trees", "max_features", "mode")]
    return detection_scorecard(scored.withColumn("is_anomaly", flag), ["split"]).select(*settings, "*")


def winner_by_split(scores: DataFrame, grid: Mapping[str, Sequence]) -> DataFrame:
    """The rows of all splits of the setting with the best validation F1.

    ``grid`` names the setting columns and their values in grid order, the slowest first; F1 that agree to six
    digits are a tie, which the first setting wins. ``scores`` should be stored: it is read twice.
    """
    place = F.struct(*[-F.array_position(F.array(*[F.lit(v) for v in values]), F.col(c)) for c, values in grid.items()])
    best = scores.where(F.col("split") == "val").agg(F.max_by(F.struct(*grid), F.struct(F.round("f1", 6), place)).alias("b")).first()["b"]
    if best is None:
        return scores.limit(0)
    return scores.where(reduce(lambda a, b: a & b, [F.col(c) == best[c] for c in grid]))


def _grid_scores(bundle: ModelMatrix, spec: SeriesSpec, trees: Sequence[int], max_features: Sequence[float],
                 seed: int) -> DataFrame:
    """One row per scored row and forest; forests are numbered by feature share, then by trees."""
    rows = bundle.rows
    train = rows.where(F.col("split") == "train")
    for i, share in enumerate(max_features):
        forest = fit_forest(train, bundle.inputs, row_key(spec), trees=max(trees), max_features=share, seed=seed)
        rows = forest.score(rows, f"_s{i}", prefixes=list(trees))
    scores = F.concat(*[F.col(f"_s{i}") for i in range(len(max_features))])
    return materialize(rows.select("label", "split", F.posexplode(scores).alias("forest", "score"))
                       .withColumn("score", F.round("score", 12)))


def _candidates_by_forest(val: DataFrame, forests: int, layout: Layout, count: int = 100) -> list[list[float]]:
    """Distinct scores where a forest has few of them, else evenly spaced quantiles."""
    step = 0.98 / (count - 1)
    spread = exact_quantiles(val, "score", [0.01 + i * step for i in range(count)], ["forest"], layout)
    ladders = {r["forest"]: sorted(set(r["quantiles"])) for r in spread.collect()}
    distinct = val.select("forest", "score").distinct()
    few = distinct.groupBy("forest").count().where(F.col("count") <= count).select("forest")
    values = distinct.join(few, "forest").groupBy("forest").agg(F.sort_array(F.collect_list("score")).alias("v"))
    ladders |= {r["forest"]: list(r["v"]) for r in values.collect()}
    return [ladders[i] for i in range(forests)]


def _f1_at_offsets(val: DataFrame, offsets: Sequence[Sequence[float]], cuts: int) -> dict[int, list[float]]:
    """F1 of the contamination flags of every forest and cut-off, from one aggregation."""
    own = double_rows(offsets)[F.col("forest")]
    label = F.col("label")
    parts = []
    for i in range(cuts):
        flag = (F.col("score") - own[i] > 0).cast("int")
        parts += [F.count_if((label == 1) & (flag == 1)).alias(f"t{i}"), F.count_if(label != flag).alias(f"e{i}")]
    found = {}
    for row in val.groupBy("forest").agg(*parts).collect():
        found[row["forest"]] = [2 * row[f"t{i}"] / (2 * row[f"t{i}"] + row[f"e{i}"]) if row[f"t{i}"] else 0.0
                                for i in range(cuts)]
    return found


def density_grid(df: DataFrame, spec: SeriesSpec, *, eps: Sequence[float] = EPS_GRID,
                 min_samples: Sequence[int] = MIN_SAMPLES_GRID, metrics: Sequence[str] = METRIC_GRID,
                 scale: bool = True, layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """Scores per setting and split (``scale``: fitted on train) or over all rows (unscaled)."""
    if scale:
        bundle = tuning_bundle(df, spec, scale=True, layout=layout)
    else:
        plain = model_matrix(df, spec, scale=False, layout=layout)
        bundle = ModelMatrix(encode_labels(plain.rows).withColumn("split", F.lit("all")), plain.inputs, None)
    configs = [(float(e), int(m)) for e in eps for m in min_samples]
    return reduce(DataFrame.unionByName,
                  [density_grid_scores(bundle.rows, bundle.inputs, configs, m, layout) for m in metrics])


def density_grid_scores(rows: DataFrame, inputs: Sequence[str], configs: Sequence[tuple[float, int]], metric: str,
                        layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """Scores of every setting and split from one set of distances."""
    flagged = density_noise_grid(rows, inputs, configs, metric, "_noise", layout)
    names = F.array(*[F.struct(F.lit(e).alias("eps"), F.lit(m).alias("min_samples")) for e, m in configs])
    long = (flagged.select("split", "label", F.explode(F.arrays_zip(
        names.alias("config"), F.col("_noise").alias("flag"))).alias("_c"))
            .select("split", "label", "_c.config.eps", "_c.config.min_samples", F.col("_c.flag").alias("is_anomaly")))
    scores = detection_scorecard(long, ["eps", "min_samples", "split"])
    return scores.withColumn("metric", F.lit(metric)).withColumn("flagged", F.col("tp") + F.col("fp"))


def density_winner(df: DataFrame, spec: SeriesSpec, *, eps: Sequence[float] = EPS_GRID, min_samples: Sequence[int] = MIN_SAMPLES_GRID,
                   metrics: Sequence[str] = METRIC_GRID, layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """Scores per split of the best setting of the scaled density grid."""
    scores = materialize(density_grid(df, spec, eps=eps, min_samples=min_samples, metrics=metrics, layout=layout))
    return winner_by_split(scores, {"metric": metrics, "eps": [float(e) for e in eps], "min_samples": min_samples})


def ensemble_winner(sweep: DataFrame, alphas: Sequence[float] = ALPHA_GRID, alpha: float = 0.7) -> DataFrame:
    """Scores per split of the best row of an ensemble sweep."""
    return winner_by_split(materialize(sweep), {"strategy": ("intersection", "union", "weighted"), "alpha": sorted({alpha, *alphas})})


def ensemble_sweep(rows: DataFrame, forest_flag: str, density_flag: str, forest_norm: str,
                   alphas: Sequence[float] = ALPHA_GRID, alpha: float = 0.7) -> DataFrame:
    """Scores per strategy, alpha and split; ``rows`` carry both flags, the label and the split."""
    settings = [("intersection", alpha), ("union", alpha), *(("weighted", a) for a in alphas)]
    options = F.array(*[F.struct(
        F.lit(s).alias("strategy"), F.lit(float(a)).alias("alpha"),
        ensemble_flag(s, forest_flag, density_flag, forest_norm, a).alias("is_anomaly")) for s, a in settings])
    long = rows.select("split", "label", F.explode(options).alias("_o")).select("split", "label", "_o.*")
    return detection_scorecard(long, ["strategy", "alpha", "split"])


def tuned_forest_rows(bundle: ModelMatrix, spec: SeriesSpec, forest: ForestConfig = TUNED_FOREST, layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """Rows of an enhanced bundle with the score and ``forest_flag`` of a train-fitted forest, cut at the validation threshold."""
    fitted = ForestConfig(contamination=forest.contamination, trees=forest.trees, max_features=forest.max_features,
                          scale=True, fit_on="train", seed=forest.seed)
    scored = forest_scores(bundle, spec, fitted, layout)
    cut = best_threshold(scored.where(F.col("split") == "val"), "score", layout=layout).first()["threshold"]
    return scored.withColumn("forest_flag", flag_at("score", cut))


def tuned_ensemble_rows(df: DataFrame, spec: SeriesSpec, forest: ForestConfig = TUNED_FOREST,
                        density: DensityConfig = TUNED_DENSITY, layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """Train-fitted rows of an enhanced feature table with both flags and the normalised score."""
    bundle = tuning_bundle(df, spec, scale=True, layout=layout)
    flagged = tuned_forest_rows(bundle, spec, forest, layout)
    noise = density_noise(flagged, bundle.inputs, density.eps, density.min_samples, density.metric,
                          "density_flag", layout)
    return materialize(min_max(noise, "score").select(
        *row_key(spec), "hour", "is_weekend", "label", "split", "score", "score_norm", "forest_flag",
        "density_flag"))


ENHANCED_FOREST = "enhanced forest, test"


def _labelled(base: DataFrame, spec: SeriesSpec, layout: Layout) -> ModelMatrix:
    matrix = model_matrix(base, spec, scale=False, layout=layout)
    return ModelMatrix(encode_labels(tuning_split(matrix.rows, spec, layout=layout)), matrix.inputs, None)


def _scope(rows: DataFrame, name: str, flag: Column, test_only: bool) -> DataFrame:
    kept = rows.where(F.col("split") == "test") if test_only else rows
    return kept.select(F.lit(name).alias("detector"), "label", flag.alias("is_anomaly"))


def _base_forests(whole: ModelMatrix, spec: SeriesSpec, layout: Layout) -> list[DataFrame]:
    full = forest_scores(whole, spec, ForestConfig(), layout)
    fitted = forest_scores(whole, spec, ForestConfig(fit_on="train"), layout)
    cut = best_threshold(fitted.where(F.col("split") == "val"), "score", layout=layout).first()["threshold"]
    return [
        _scope(full, "base forest, all rows", contamination_flag("score", 0.0), False),
        _scope(fitted, "base forest, test", contamination_flag("score", 0.0), True),
        _scope(fitted, "base forest, test, validation threshold", flag_at("score", cut), True),
    ]


def comparison_board(df: DataFrame, spec: SeriesSpec, layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """Scores of eight detectors: base and enhanced forests, density noise and ensembles."""
    whole = _labelled(materialize(base_features(df, spec, layout)), spec, layout)
    enhanced = materialize(enhanced_features(df, spec, layout))
    noise = density_noise(whole.rows, whole.inputs, 0.5, 5, "euclidean", "density_flag", layout)
    tuned = tuned_ensemble_rows(enhanced, spec, layout=layout)
    union = ensemble_flag("union", "forest_flag", "density_flag")
    both = ensemble_flag("intersection", "forest_flag", "density_flag")
    parts = [
        *_base_forests(whole, spec, layout),
        _scope(tuned, ENHANCED_FOREST, F.col("forest_flag"), True),
        _scope(tuned, "enhanced density, test", F.col("density_flag"), True),
        _scope(tuned, "enhanced union, test", union, True),
        _scope(tuned, "enhanced intersection, test", both, True),
        _scope(noise, "base density, all rows", F.col("density_flag"), False),
    ]
    return detection_scorecard(reduce(DataFrame.unionByName, parts), ["detector"])


def enhanced_forest_splits(df: DataFrame, spec: SeriesSpec, layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """Train, validation and test scores of the enhanced forest of the comparison board."""
    enhanced = materialize(enhanced_features(df, spec, layout))
    rows = tuned_forest_rows(tuning_bundle(enhanced, spec, scale=True, layout=layout), spec, layout=layout)
    return detection_scorecard(rows.withColumn("is_anomaly", F.col("forest_flag")), ["split"])


def fair_comparison(df: DataFrame, spec: SeriesSpec, layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """Model and F1 of the forests of the comparison board; no other detector is run."""
    whole = _labelled(materialize(base_features(df, spec, layout)), spec, layout)
    enhanced = materialize(enhanced_features(df, spec, layout))
    tuned = tuned_forest_rows(tuning_bundle(enhanced, spec, scale=True, layout=layout), spec, layout=layout)
    parts = [*_base_forests(whole, spec, layout), _scope(tuned, ENHANCED_FOREST, F.col("forest_flag"), True)]
    board = detection_scorecard(reduce(DataFrame.unionByName, parts), ["detector"])
    return board.select(F.col("detector").alias("model"), F.col("f1").alias("test_f1"))
