"""Calendar, rolling, lag, derivative and sequence features."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from meterflow.functions import calendar as cal
from meterflow.functions.checks import require_columns
from meterflow.operators.joins import series_lookup
from meterflow.operators.ordering import ensure_row_index, windowed, with_row_index
from meterflow.spec import (DEFAULT_LAYOUT, LABEL, LABEL_CODES, LAGS, ROLLING_WINDOWS, ROW, ROWS,
                            SEQUENCE_FEATURES, SEQUENCE_LENGTH, WEATHER_COLUMNS, Layout, SeriesSpec)

WindowColumn = Callable[[WindowSpec], Column]


def add_calendar(df: DataFrame, spec: SeriesSpec = SeriesSpec()) -> DataFrame:
    """hour, day_of_week (Monday = 0), month and is_weekend."""
    require_columns(df, [spec.ts])
    return df.withColumns(cal.calendar(spec.ts))


def add_cyclical(df: DataFrame) -> DataFrame:
    """Sine and cosine of hour and weekday."""
    require_columns(df, ["hour", "day_of_week"])
    return df.withColumns(cal.cyclical())


def add_day_names(df: DataFrame, spec: SeriesSpec = SeriesSpec()) -> DataFrame:
    """hour, day_of_week, day_name (sort by day_of_week) and a boolean weekend flag."""
    require_columns(df, [spec.ts])
    weekday = F.weekday(spec.ts)
    return df.withColumns({
        "hour": F.hour(spec.ts),
        "day_of_week": weekday,
        "day_name": F.date_format(spec.ts, "EEEE"),
        "is_weekend": weekday >= 5,
    })


def rolling_mean(target: str, rows: int, partial: bool = False) -> WindowColumn:
    """Mean of the last ``rows`` rows, NULL until that many values exist unless ``partial``."""
    def make(w: WindowSpec) -> Column:
        frame = w.rowsBetween(1 - rows, 0)
        mean = F.avg(target).over(frame)
        return mean if partial else F.when(F.count(target).over(frame) == rows, mean)
    return make


def rolling_std(target: str, rows: int) -> WindowColumn:
    """Sample standard deviation of the last ``rows`` rows, NULL until that many values exist."""
    def make(w: WindowSpec) -> Column:
        frame = w.rowsBetween(1 - rows, 0)
        return F.when(F.count(target).over(frame) == rows, F.stddev_samp(target).over(frame))
    return make


def _rolling_columns(target: str) -> dict[str, WindowColumn]:
    columns: dict[str, WindowColumn] = {}
    for name, rows in ROLLING_WINDOWS.items():
        columns[f"rolling_mean_{name}"] = rolling_mean(target, rows)
        columns[f"rolling_std_{name}"] = rolling_std(target, rows)
    return columns


def _difference(target: str) -> WindowColumn:
    return lambda w: F.col(target) - F.lag(target, 1).over(w)


def add_rolling(df: DataFrame, spec: SeriesSpec = SeriesSpec(), layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """Row based rolling mean and standard deviation over 6 and 48 rows."""
    require_columns(df, [spec.ts, spec.target])
    indexed = ensure_row_index(df, spec, layout)
    back = max(ROLLING_WINDOWS.values()) - 1
    return windowed(indexed, spec, _rolling_columns(spec.target), back, layout)


def add_rolling_overlay(df: DataFrame, spec: SeriesSpec = SeriesSpec(), rows: int = 48,
                        layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """Rolling mean that also covers the partial windows at the start of a series."""
    require_columns(df, [spec.ts, spec.target])
    indexed = ensure_row_index(df, spec, layout)
    return windowed(indexed, spec, {"rolling_overlay": rolling_mean(spec.target, rows, partial=True)},
                    rows - 1, layout)


def add_derivatives(df: DataFrame, spec: SeriesSpec = SeriesSpec(), layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """Change since the previous row and distance to the 24 h rolling mean."""
    require_columns(df, [spec.ts, spec.target, "rolling_mean_24h"])
    indexed = ensure_row_index(df, spec, layout)
    return (windowed(indexed, spec, {"consumption_diff": _difference(spec.target)}, 1, layout)
            .withColumn("consumption_residual_24h", F.col(spec.target) - F.col("rolling_mean_24h")))


def base_features(df: DataFrame, spec: SeriesSpec = SeriesSpec(), layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """Calendar and rolling features; rows keep their numbers for later steps."""
    return add_rolling(add_calendar(df, spec), spec, layout)


def enhanced_features(df: DataFrame, spec: SeriesSpec = SeriesSpec(),
                      layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """Base, cyclical and derivative features, with all window columns on one exchange."""
    require_columns(df, [spec.ts, spec.target])
    indexed = ensure_row_index(add_calendar(df, spec), spec, layout)
    columns = _rolling_columns(spec.target) | {"consumption_diff": _difference(spec.target)}
    back = max(ROLLING_WINDOWS.values()) - 1
    return (windowed(add_cyclical(indexed), spec, columns, back, layout)
            .withColumn("consumption_residual_24h", F.col(spec.target) - F.col("rolling_mean_24h")))


def drop_weather(df: DataFrame, drop: bool = True) -> DataFrame:
    """Leave out the weather columns for ablation studies."""
    return df.drop(*WEATHER_COLUMNS) if drop else df


def encode_labels(df: DataFrame, column: str = LABEL, out: str = "label") -> DataFrame:
    """Map label texts to 0 and 1; an unknown or missing text fails the job, naming it."""
    require_columns(df, [column])
    text = F.col(column)
    code = F.raise_error(F.concat(F.lit("Unmapped label values: "),
                                  F.coalesce(text, F.lit("NULL")))).cast("int")
    for name, value in LABEL_CODES.items():
        code = F.when(text == name, F.lit(value)).otherwise(code)
    return df.withColumn(out, code)


def supervised_lags(df: DataFrame, spec: SeriesSpec = SeriesSpec(), lags: Sequence[int] = LAGS,
                    layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """Lags of the target; rows without a full set are dropped and the rest renumbered."""
    require_columns(df, [spec.ts, spec.target])
    names = {k: f"{spec.target}_lag_{k}" for k in lags}
    indexed = ensure_row_index(df, spec, layout)
    columns: dict[str, WindowColumn] = {
        name: (lambda w, k=k: F.lag(spec.target, k).over(w)) for k, name in names.items()}
    lagged = windowed(indexed, spec, columns, max(lags), layout)
    return with_row_index(lagged.dropna(subset=list(names.values())), spec, layout)


def sequences(df: DataFrame, spec: SeriesSpec = SeriesSpec(), features: Sequence[str] = SEQUENCE_FEATURES,
              length: int = SEQUENCE_LENGTH, layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """One sample per row that has ``length`` rows before it.

    ``sequence`` holds the feature vectors of those rows, oldest first, and ``next_step`` the
    vector of the row itself, whose time is the time being forecast.
    """
    if length < 1:
        raise ValueError(f"length must be at least 1, got {length}")
    require_columns(df, [spec.ts, *features])
    indexed = ensure_row_index(df, spec, layout)
    vector = F.array(*[F.col(c).cast("double") for c in features])
    slim = indexed.select(*spec.series, spec.ts, ROW, ROWS, vector.alias("next_step"))
    past: WindowColumn = lambda w: F.collect_list("next_step").over(w.rowsBetween(-length, -1))
    return (windowed(slim, spec, {"sequence": past}, length, layout)
            .where(F.col(ROW) >= length)
            .withColumns({ROW: F.col(ROW) - length, ROWS: F.col(ROWS) - length}))


def time_deltas(df: DataFrame, spec: SeriesSpec = SeriesSpec(), layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """Seconds since the previous row of the series."""
    require_columns(df, [spec.ts])
    indexed = ensure_row_index(df, spec, layout)
    seconds = cal.epoch_exact(spec.ts)
    return windowed(indexed, spec, {"delta_seconds": lambda w: seconds - F.lag(seconds, 1).over(w)},
                    1, layout)


def around_middle_flag(df: DataFrame, spec: SeriesSpec, flag: str, reach: int = 24,
                       layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """Rows within ``reach`` rows before and after the middle flagged row of each series."""
    indexed = ensure_row_index(df, spec, layout)
    flagged = indexed.where(F.col(flag) == 1).select(
        *spec.series, spec.ts, *spec.tiebreak, F.col(ROW).alias("_center"), F.col(ROWS).alias("_all"))
    ranked = with_row_index(flagged, spec, layout)
    middle = (ranked.where(F.col(ROW) == F.floor(F.col(ROWS) / 2))
              .select(*spec.series, "_center", F.col("_all").alias(ROWS)))
    near = (F.col(ROW) >= F.col("_center") - reach) & (F.col(ROW) < F.col("_center") + reach)
    return series_lookup(indexed, middle, spec.series).where(near).drop("_center")
