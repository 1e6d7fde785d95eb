"""Feature matrices for detectors: complete rows, train-fitted scaling, hourly z-scores."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.functions.checks import require_columns
from meterflow.functions.literals import doubles
from meterflow.operators.features import drop_weather as without_weather
from meterflow.operators.features import encode_labels
from meterflow.operators.ordering import with_row_index
from meterflow.operators.splits import VAL_ROWS, tuning_split
from meterflow.session import materialize
from meterflow.spec import DEFAULT_LAYOUT, LABEL, ROW, ROWS, WEATHER_COLUMNS, Layout, SeriesSpec

HOUR_ZSCORE = "hour_zscore"
_NOT_FEATURES = (LABEL, ROW, ROWS, VAL_ROWS, "split", "label", "is_anomaly")


def feature_columns(df: DataFrame, spec: SeriesSpec, drop_weather: bool = False) -> list[str]:
    """Every column that is neither time, series key, label nor bookkeeping."""
    left_out = {spec.ts, *spec.series, *spec.tiebreak, *_NOT_FEATURES}
    if drop_weather:
        left_out |= set(WEATHER_COLUMNS)
    return [c for c in df.columns if c not in left_out]


def evaluable_rows(df: DataFrame, spec: SeriesSpec, layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """Rows with a complete feature vector, renumbered; hour, target and label stay on the row."""
    complete = df.dropna(subset=feature_columns(df, spec))
    return with_row_index(complete, spec, layout)


def aligned_context(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Hour and target of the evaluable rows."""
    require_columns(df, ["hour", spec.target])
    return df.dropna(subset=feature_columns(df, spec)).select(*spec.series, spec.ts, "hour", spec.target)


@dataclass(frozen=True)
class MatrixScaler:
    """Means and population deviations of the fit rows, and hourly target statistics.

    The fitted state is a row of numbers per feature and at most 24 hours, so it travels as
    literals instead of joins.
    """

    columns: tuple[str, ...]
    means: tuple[float, ...]
    scales: tuple[float, ...]
    target: str
    hours: tuple[tuple[int, float, float], ...]
    hour_zscore: bool

    @staticmethod
    def fit(df: DataFrame, columns: Sequence[str], target: str, hour_zscore: bool = True) -> MatrixScaler:
        """Fit on all rows of ``df``; a constant column or hour gets the divisor 1."""
        require_columns(df, [*columns, "hour", target])
        row = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
                     *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)]).first()
        if row["m0"] is None:
            raise ValueError("no rows to fit the scaler on")
        hours = ()
        if hour_zscore:
            stats = df.groupBy("hour").agg(F.avg(target).alias("m"), F.stddev_pop(target).alias("s"))
            hours = tuple(sorted((r["hour"], r["m"], r["s"] or 1.0) for r in stats.collect()))
        return MatrixScaler(
            tuple(columns), tuple(row[f"m{i}"] for i in range(len(columns))),
            tuple(row[f"s{i}"] or 1.0 for i in range(len(columns))), target, hours, hour_zscore)

    @property
    def outputs(self) -> list[str]:
        names = [f"{c}_scaled" for c in self.columns]
        return names + [HOUR_ZSCORE] if self.hour_zscore else names

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``<feature>_scaled`` columns and the hourly z-score (0 for hours never fitted)."""
        scaled = {f"{c}_scaled": (F.col(c) - m) / s
                  for c, m, s in zip(self.columns, self.means, self.scales, strict=True)}
        if self.hour_zscore:
            by_hour = {h: (m, s) for h, m, s in self.hours}
            means = doubles(by_hour.get(h, (None, None))[0] for h in range(24))
            spreads = doubles(by_hour.get(h, (None, None))[1] for h in range(24))
            z = (F.col(self.target) - means[F.col("hour")]) / spreads[F.col("hour")]
            scaled[HOUR_ZSCORE] = F.coalesce(z, F.lit(0.0))
        return df.withColumns(scaled)


@dataclass(frozen=True)
class ModelMatrix:
    """Rows with their model inputs; ``inputs`` names the columns a detector reads."""

    rows: DataFrame
    inputs: list[str]
    scaler: MatrixScaler | None


def model_matrix(df: DataFrame, spec: SeriesSpec, *, scale: bool, drop_weather: bool = False,
                 fit_on: str | None = None, layout: Layout = DEFAULT_LAYOUT) -> ModelMatrix:
    """Complete rows with optional scaling fitted on one split (``fit_on``) or on all rows.

    The rows are checkpointed once because fitting and scoring both read them. The features are
    checked for completeness before weather is left out, so ablation keeps the same rows.
    """
    names = feature_columns(df, spec, drop_weather)
    rows = evaluable_rows(df, spec, layout)
    if drop_weather:
        rows = without_weather(rows)
    rows = materialize(tuning_split(rows, spec, layout=layout) if fit_on else rows)
    if not scale:
        if rows.isEmpty():
            raise ValueError("no complete rows")
        return ModelMatrix(rows, names, None)
    fit_rows = rows.where(F.col("split") == fit_on) if fit_on else rows
    scaler = MatrixScaler.fit(fit_rows, names, spec.target)
    return ModelMatrix(scaler.transform(rows), scaler.outputs, scaler)


def tuning_bundle(df: DataFrame, spec: SeriesSpec, *, scale: bool = True, drop_weather: bool = False,
                  layout: Layout = DEFAULT_LAYOUT) -> ModelMatrix:
    """Train-fitted matrix with ``label`` and ``split`` on every row."""
    matrix = model_matrix(df, spec, scale=scale, drop_weather=drop_weather, fit_on="train", layout=layout)
    return ModelMatrix(encode_labels(matrix.rows), matrix.inputs, matrix.scaler)
