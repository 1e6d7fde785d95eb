"""Forecasters: seasonal naive, additive trend and seasonality, boosted trees, window regression."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.functions.calendar import epoch_exact
from meterflow.functions.checks import require_columns
from meterflow.operators.boosting import BoostConfig, BoostedTrees, fit_boosted
from meterflow.operators.features import supervised_lags
from meterflow.operators.joins import series_lookup
from meterflow.operators.ordering import CHUNK, chunk_key, chunk_number, chunk_size, ensure_row_index, windowed, with_halo
from meterflow.operators.shrinkage import optimality, shrunk_weights
from meterflow.operators.splits import VAL_ROWS, forecast_split
from meterflow.session import materialize
from meterflow.spec import (CALENDAR_COLUMNS, DEFAULT_LAYOUT, HUMIDITY, LAGS, ROW, ROWS, SEASON, SEQUENCE_FEATURES,
                            SEQUENCE_LENGTH, TEMPERATURE, Layout, SeriesSpec)


def boosted_features(target: str) -> list[str]:
    """Predictors of the boosted trees: three lags, two weather columns, four calendar columns."""
    return [*(f"{target}_lag_{k}" for k in LAGS), TEMPERATURE, HUMIDITY, *CALENDAR_COLUMNS]


def prediction_frame(df: DataFrame, spec: SeriesSpec, prediction: str | Column) -> DataFrame:
    """Standard columns: series keys, time, y_true, y_pred."""
    p = F.col(prediction) if isinstance(prediction, str) else prediction
    return df.select(*spec.series, spec.ts, F.col(spec.target).cast("double").alias("y_true"),
                     p.cast("double").alias("y_pred"))


def seasonal_naive(df: DataFrame, spec: SeriesSpec, season: int = SEASON, history: str = "train_test",
                   layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """Test rows with the value seen ``season`` rows earlier.

    With ``history="train_test"`` the look-back runs over train followed directly by test, so the
    first ``season`` predictions repeat the end of train; ``"all"`` looks back over every row.
    True test values serve as history and predictions never do. A series whose train part is
    shorter than the season fails the job.
    """
    if season < 1:
        raise ValueError(f"season must be at least 1, got {season}")
    if history not in ("train_test", "all"):
        raise ValueError("history must be 'train_test' or 'all'")
    require_columns(df, [spec.ts, spec.target, "split", VAL_ROWS, ROW, ROWS])
    slim = df.select(*spec.series, spec.ts, spec.target, "split", VAL_ROWS, ROW, ROWS)
    if history == "train_test":
        slim = _close_validation_gap(slim)
    lagged = windowed(slim, spec, {"_past": lambda w: F.lag(spec.target, season).over(w)}, season, layout)
    short = F.raise_error(F.concat(F.lit(f"train part is shorter than the season of {season}; row "),
                                   F.col(ROW).cast("string"))).cast("double")
    past = F.when(F.col(ROW) < season, short).otherwise(F.col("_past"))
    return prediction_frame(lagged.where(F.col("split") == "test"), spec, past)


def _close_validation_gap(df: DataFrame) -> DataFrame:
    """Leave validation out and renumber: test rows move up by the validation rows of their series."""
    moved = F.when(F.col("split") == "test", F.col(ROW) - F.col(VAL_ROWS)).otherwise(F.col(ROW))
    return df.where(F.col("split") != "val").withColumns({ROW: moved, ROWS: F.col(ROWS) - F.col(VAL_ROWS)})


def training_frame(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Time as ``ds`` and target as ``y``."""
    require_columns(df, [spec.ts, spec.target])
    return df.select(*spec.series, F.col(spec.ts).alias("ds"), F.col(spec.target).alias("y"))


def future_frame(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Times to forecast as ``ds``."""
    require_columns(df, [spec.ts])
    return df.select(*spec.series, F.col(spec.ts).alias("ds"))


@dataclass(frozen=True)
class AdditiveModel:
    """Design of the additive forecaster: hinge trend with few changes, and Fourier seasonality.

    Follows Taylor and Letham, "Forecasting at Scale" (2018): trend changes have a double exponential prior of scale
    ``change_prior``, which sets most of them to zero, seasonal terms a normal one of scale ``season_prior``, both on the
    target in units of its root mean square. Daily and weekly orders 4 and 3, 25 possible changes in the
    first 80 % of the training range. The noise variance is half the mean squared difference of neighbouring rows.
    """

    changepoints: int = 25
    change_range: float = 0.8
    daily_order: int = 4
    weekly_order: int = 3
    change_prior: float = 0.05
    season_prior: float = 10.0

    @property
    def shrinkage(self) -> tuple[list[float], list[float]]:
        """Absolute and squared penalty of each term, for a noise variance of one."""
        seasons = 2 * (self.daily_order + self.weekly_order)
        return ([0.0, 0.0, *[1 / self.change_prior] * self.changepoints, *[0.0] * seasons],
                [0.0, 1e-9, *[0.0] * self.changepoints, *[1 / self.season_prior ** 2] * seasons])

    def design(self, seconds: Column, start: Column, span: Column) -> Column:
        """Design vector of a time: intercept, trend, trend changes, seasonal waves."""
        t = (seconds - start) / span
        knots = [self.change_range * j / self.changepoints for j in range(1, self.changepoints + 1)]
        terms = [F.lit(1.0), t, *[F.greatest(t - F.lit(k), F.lit(0.0)) for k in knots]]
        for period, order in ((86400.0, self.daily_order), (7 * 86400.0, self.weekly_order)):
            for k in range(1, order + 1):
                angle = seconds % F.lit(period) * F.lit(2 * math.pi * k / period)
                terms += [F.sin(angle), F.cos(angle)]
        return F.array(*terms)


def additive_forecast(df: DataFrame, spec: SeriesSpec, model: AdditiveModel = AdditiveModel(),
                      layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """Fit each series on its train rows and predict its test rows.

    Least squares needs only sums of products, so chunks of rows are reduced to a small moment
    matrix each, the matrices of a series are added up, and one small system per series is
    solved. No task ever holds a series.
    """
    require_columns(df, [spec.ts, spec.target, "split", ROW, ROWS])
    seconds = epoch_exact(spec.ts)
    train_seconds = F.when(F.col("split") == "train", seconds)
    ranges = df.groupBy(*spec.series).agg(
        F.min(train_seconds).alias("_start"),
        F.greatest(F.max(train_seconds) - F.min(train_seconds), F.lit(1.0)).alias("_span"),
        F.first(ROWS).alias(ROWS))
    slim = df.where(F.col("split") != "val").select(*spec.series, spec.ts, spec.target, "split", ROW, ROWS)
    scaled = (series_lookup(slim, ranges, spec.series)
              .withColumn("_x", model.design(seconds, F.col("_start"), F.col("_span"))))
    train = scaled.where((F.col("split") == "train") & F.col(spec.target).isNotNull())
    weights = additive_weights(train, spec, model, layout)
    test = series_lookup(scaled.where(F.col("split") == "test"), weights, spec.series)
    products = F.zip_with("_x", "_weights", lambda a, b: a * b)
    return prediction_frame(test, spec, F.aggregate(products, F.lit(0.0), lambda a, b: a + b))


def additive_weights(train: DataFrame, spec: SeriesSpec, model: AdditiveModel, layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """Weights per series, and how far each term is from its optimality condition, from the sums of its chunks' moment matrices."""
    lasso, ridge = (np.array(p) for p in model.shrinkage)
    width = len(lasso)
    upper = np.triu_indices(width + 1)

    def moments(chunk: pd.DataFrame) -> pd.DataFrame:
        chunk = chunk.sort_values(ROW)
        rows = np.column_stack([np.stack(chunk["_x"].to_numpy()), chunk["_y"].to_numpy(float)])
        pair = chunk[ROW].to_numpy() // 2
        steps = np.diff(rows[:, -1])[pair[1:] == pair[:-1]]
        return pd.DataFrame({CHUNK: chunk[CHUNK].iloc[:1], ROWS: chunk[ROWS].iloc[:1],
                             "_m": [np.append((rows.T @ rows)[upper], [steps @ steps, len(steps)])]})

    pairs_together = F.floor(F.floor(F.col(ROW) / 2) / chunk_size(layout)).cast("long")
    chunked = train.select(chunk_key(spec, pairs_together).alias(CHUNK), ROW, ROWS, "_x",
                           F.col(spec.target).cast("double").alias("_y"))
    kind = chunked.schema[CHUNK].dataType.simpleString()
    partial = chunked.groupBy(CHUNK).applyInPandas(moments, f"{CHUNK} {kind}, {ROWS} long, _m array<double>")
    series = [F.col(CHUNK)[c].alias(c) for c in spec.series]
    sums = (partial.select(*series, ROWS, F.posexplode("_m").alias("_i", "_v"))
            .groupBy(*spec.series, "_i").agg(F.sum("_v").alias("_v"), F.first(ROWS).alias(ROWS))
            .groupBy(*spec.series).agg(F.array_sort(F.collect_list(F.struct("_i", "_v"))).alias("_s"),
                                       F.first(ROWS).alias(ROWS)))

    @F.pandas_udf("struct<weights:array<double>,gaps:array<double>>")
    def solve(batch: pd.Series) -> pd.DataFrame:
        out = []
        for flat in batch:
            full = np.zeros((width + 1, width + 1))
            full[upper] = flat[:-2]
            full += np.triu(full, 1).T
            size = math.sqrt(full[width, width] / full[0, 0]) or 1.0
            noise = flat[-2] / (2 * max(flat[-1], 1)) / size ** 2
            problem = full[:width, :width], full[:width, width] / size, noise * lasso, noise * ridge
            weights = shrunk_weights(*problem)
            out.append((weights * size, optimality(*problem, weights)))
        return pd.DataFrame(out, columns=["weights", "gaps"])

    solved = sums.select(*spec.series, ROWS, solve(F.transform("_s", lambda s: s["_v"])).alias("_w"))
    return solved.select(*spec.series, ROWS, F.col("_w.weights").alias("_weights"), F.col("_w.gaps").alias("_gaps"))


def boosted_frame(df: DataFrame, spec: SeriesSpec, layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """Lag table with its own chronological split, checkpointed for the training passes."""
    return materialize(forecast_split(supervised_lags(df, spec, layout=layout), spec, layout=layout))


def boosted_forecast(df: DataFrame, spec: SeriesSpec, trees: int | BoostConfig = 100, layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """One boosted model over all series, trained on lag tables; predictions of the test rows."""
    lags = boosted_frame(df, spec, layout)
    model = boosted_fit(lags, spec, trees, layout)
    return prediction_frame(model.predict(lags.where(F.col("split") == "test")), spec, "prediction")


def boosted_fit(lags: DataFrame, spec: SeriesSpec, trees: int | BoostConfig = 100, layout: Layout = DEFAULT_LAYOUT) -> BoostedTrees:
    """The model of the training rows of a ``boosted_frame``."""
    config = trees if isinstance(trees, BoostConfig) else BoostConfig(trees)
    return fit_boosted(lags.where(F.col("split") == "train"), boosted_features(spec.target), spec.target, config, layout)


@dataclass(frozen=True)
class WindowRegression:
    """Elastic-net weights of the last ``length`` rows (oldest first) by feature, and the intercept."""

    features: tuple[str, ...]
    weights: np.ndarray  # (length, features)
    intercept: float


def window_samples(df: DataFrame, spec: SeriesSpec, features: Sequence[str], length: int, layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """Chunks of rows with their halo, feature values and ``_part``: the split of the sample that a row ends, at home only.

    A sample is a row with ``length`` rows before it; samples are split by their own number.
    """
    if length < 1:
        raise ValueError(f"length must be at least 1, got {length}")
    require_columns(df, [spec.ts, *features])
    indexed = ensure_row_index(df, spec, layout)
    plain = indexed.where(F.col(ROWS) > length).select(*spec.series, spec.ts, ROW, ROWS, *(F.col(c).cast("double").alias(f"_f{i}") for i, c in enumerate(features)))
    samples = plain.withColumns({ROW: F.col(ROW) - length, ROWS: F.col(ROWS) - length})
    split = forecast_split(samples, spec, layout=layout)
    rows = split.select(*spec.series, spec.ts, (F.col(ROW) + length).alias(ROW), (F.col(ROWS) + length).alias(ROWS), "split",
                        *(f"_f{i}" for i in range(len(features))))
    own = (F.col(CHUNK)["_no"] == chunk_number(layout, length)) & (F.col(ROW) >= length)
    return with_halo(rows, spec, length, layout).withColumn("_part", F.when(own, F.col("split"))).drop("split")


def _lagged_moments(x: np.ndarray, first: int, last: int, length: int) -> np.ndarray:
    """Sums of products of the windows before the rows ``first`` to ``last`` (exclusive), the rows' first feature and 1.

    Products of two lags depend on their distance but for the rows at the edges: a step of both lags adds the
    row that enters and takes away the one that leaves. So no window is ever laid out.
    """
    f = x.shape[1]
    size = length * f
    full = np.zeros((size + 2, size + 2))
    begin, end = first - length, last - length
    for distance in range(length + 1):
        block = x[begin:end].T @ x[begin + distance:end + distance]
        for a in range(length - distance + 1):
            if a:
                block = (block + np.outer(x[end + a - 1], x[end + a - 1 + distance])
                         - np.outer(x[begin + a - 1], x[begin + a - 1 + distance]))
            b = a + distance
            if b < length:
                full[a * f:(a + 1) * f, b * f:(b + 1) * f] = block
            elif a < length:  # the row itself: its first feature is the target
                full[a * f:(a + 1) * f, size] = block[:, 0]
            else:
                full[size, size] = block[0, 0]
    sums = np.cumsum(np.vstack([np.zeros(f), x]), axis=0)
    for a in range(length):
        full[a * f:(a + 1) * f, size + 1] = sums[end + a] - sums[begin + a]
    full[size, size + 1] = sums[last][0] - sums[first][0]
    full[size + 1, size + 1] = last - first
    upper = np.triu(full)
    return upper + np.triu(upper, 1).T


def window_regression_fit(samples: DataFrame, features: Sequence[str], length: int, penalty: float = 0.01, mix: float = 0.5) -> WindowRegression:
    """Least squares on standardised inputs and target with penalty ``penalty * (mix |w| + (1 - mix) / 2 w^2)`` a sample.

    Each chunk is reduced to a moment matrix of its lags; only their sum, of fixed size, reaches the driver.
    """
    count = len(features)
    size = length * count
    upper = np.triu_indices(size + 2)

    def moments(chunk: pd.DataFrame) -> pd.DataFrame:
        chunk = chunk.sort_values(ROW)
        wanted = np.flatnonzero((chunk["_part"] == "train").to_numpy())
        if not len(wanted):
            return pd.DataFrame({"_m": pd.Series([], dtype=object)})
        first, last = wanted[0], wanted[-1] + 1  # the train rows of a chunk are consecutive
        x = chunk[[f"_f{i}" for i in range(count)]].to_numpy(float)
        if np.isnan(x[first - length:last]).any():
            raise ValueError("a window holds a missing value")
        return pd.DataFrame({"_m": [_lagged_moments(x, first, last, length)[upper]]})

    partial = samples.groupBy(CHUNK).applyInPandas(moments, "_m array<double>")
    found = partial.select(F.posexplode("_m").alias("_i", "_v")).groupBy("_i").agg(F.sum("_v").alias("_v")).collect()
    if not found:
        raise ValueError("no training windows")
    full = np.zeros((size + 2, size + 2))
    flat = np.zeros(len(upper[0]))
    for i, v in found:
        flat[i] = v
    full[upper] = flat
    full += np.triu(full, 1).T
    n = full[size + 1, size + 1]
    mean = full[:size + 1, size + 1] / n
    centred = full[:size + 1, :size + 1] - n * np.outer(mean, mean)
    spread = np.sqrt(np.maximum(np.diag(centred), 0.0) / max(n - 1, 1))
    spread[spread < 1e-9 * (1 + np.abs(mean))] = 0.0  # constant inputs
    scale = np.where(spread > 0, spread, 1.0)
    gram = np.where(np.outer(spread, spread) > 0, centred / np.outer(scale, scale) / n, 0.0)
    strength = penalty / scale[size]
    w = shrunk_weights(gram[:size, :size], gram[:size, size], np.full(size, mix * strength), np.full(size, (1 - mix) * strength))
    weights = w * scale[size] / scale[:size]
    return WindowRegression(tuple(features), weights.reshape(length, count), float(mean[size] - weights @ mean[:size]))


def window_regression_predict(samples: DataFrame, spec: SeriesSpec, model: WindowRegression) -> DataFrame:
    """Predictions of the test samples: every chunk is weighted lag by lag."""
    length, count = model.weights.shape
    weights, intercept, ts = model.weights, model.intercept, spec.ts
    keys = list(spec.series)

    def apply(chunk: pd.DataFrame) -> pd.DataFrame:
        chunk = chunk.sort_values(ROW)
        at = np.flatnonzero((chunk["_part"] == "test").to_numpy())
        x = chunk[[f"_f{i}" for i in range(count)]].to_numpy(float)
        y = np.full(len(at), intercept)
        for a in range(length):
            y += x[at - length + a] @ weights[a]
        return chunk.iloc[at][[*keys, ts]].assign(y_true=x[at, 0], y_pred=y)

    kinds = [f"{c} {samples.schema[c].dataType.simpleString()}" for c in (*keys, ts)]
    return samples.groupBy(CHUNK).applyInPandas(apply, ", ".join([*kinds, "y_true double", "y_pred double"]))


def window_regression_forecast(df: DataFrame, spec: SeriesSpec, features: Sequence[str] = SEQUENCE_FEATURES,
                               length: int = SEQUENCE_LENGTH, penalty: float = 0.01, mix: float = 0.5,
                               layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """Next-step regression on the last ``length`` rows, elastic-net shrunk; the target is the first feature."""
    samples = materialize(window_samples(df, spec, features, length, layout))
    return window_regression_predict(samples, spec, window_regression_fit(samples, features, length, penalty, mix))
