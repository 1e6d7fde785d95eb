"""Scores for forecasts and detectors, overall and by segment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.functions.checks import require_columns

MAPE_FLOOR = 1e-8


def mae(y: str = "y_true", p: str = "y_pred") -> Column:
    return F.avg(F.abs(F.col(y) - F.col(p)))


def rmse(y: str = "y_true", p: str = "y_pred") -> Column:
    error = F.col(y) - F.col(p)
    return F.sqrt(F.avg(error * error))


def mape(y: str = "y_true", p: str = "y_pred", floor: float = MAPE_FLOOR) -> Column:
    """Percent error with a floor under the denominator."""
    if floor <= 0:
        raise ValueError("floor must be positive")
    return F.avg(F.abs(F.col(y) - F.col(p)) / F.greatest(F.abs(F.col(y)), F.lit(floor))) * 100


def forecast_scorecard(df: DataFrame, by: Sequence[str] = ("model",), y: str = "y_true",
                       p: str = "y_pred") -> DataFrame:
    """rows, mae, rmse and mape per group, in one partially aggregated pass."""
    require_columns(df, [*by, y, p])
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), mae(y, p).alias("mae"),
                               rmse(y, p).alias("rmse"), mape(y, p).alias("mape"))


def assert_scorable(df: DataFrame, y: str = "y_true", p: str = "y_pred") -> DataFrame:
    """``df`` unchanged, or ValueError when it is empty or a value is missing."""
    rows, blanks = df.agg(F.count(F.lit(1)), F.count_if(F.col(y).isNull() | F.col(p).isNull())).first()
    if rows == 0:
        raise ValueError("nothing to score")
    if blanks:
        raise ValueError(f"{blanks} rows lack a true or predicted value")
    return df


def compare_to_floor(scorecard: DataFrame, floor_model: str = "naive") -> DataFrame:
    """Put every model beside the floor model: beats, above or matches, and an overall verdict.

    A scorecard has one row per model, so the floor is a scalar subquery, not a join.
    """
    floor = (scorecard.where(F.col("model") == floor_model)
             .agg(F.struct(F.first("mae").alias("mae"), F.first("rmse").alias("rmse")).alias("f")).scalar())

    def word(metric: str) -> Column:
        base = floor.getField(metric)
        return (F.when(F.col(metric) < base, "beats").when(F.col(metric) > base, "above")
                .otherwise("matches"))

    both = (F.col("mae") < floor.getField("mae")) & (F.col("rmse") < floor.getField("rmse"))
    return (scorecard.where(F.col("model") != floor_model)
            .select("model", "mae", "rmse", word("mae").alias("mae_vs_floor"),
                    word("rmse").alias("rmse_vs_floor"), both.alias("beats_floor")))


def _confusion(label: str, flag: str) -> list[Column]:
    y, p = F.col(label), F.col(flag)
    valid = y.isin(0, 1) & p.isin(0, 1)
    fault = F.raise_error(F.lit("labels and flags must be 0 or 1")).cast("int")
    cell = F.when(F.coalesce(valid, F.lit(False)), y * 2 + p).otherwise(fault)
    return [F.count_if(cell == code).alias(name) for code, name in enumerate(("tn", "fp", "fn", "tp"))]


def ratio(part: Column, whole: Column) -> Column:
    """0 where the denominator is 0."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def with_rates(counts: DataFrame) -> DataFrame:
    """Precision, recall and F1 of the abnormal class from tn, fp, fn, tp."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.withColumns({
        "precision": ratio(tp, tp + fp),
        "recall": ratio(tp, tp + fn),
        "f1": ratio(2 * tp, 2 * tp + fp + fn),
    })


def detection_scorecard(df: DataFrame, by: Sequence[str] = (), label: str = "label",
                        flag: str = "is_anomaly") -> DataFrame:
    """Confusion counts and rates per group; values other than 0 and 1 fail the job."""
    require_columns(df, [*by, label, flag])
    return with_rates(df.groupBy(*by).agg(*_confusion(label, flag)))


def assert_detectable(df: DataFrame) -> DataFrame:
    if df.isEmpty():
        raise ValueError("labels and flags must be non-empty")
    return df


def confusion_by_hour(df: DataFrame, label: str = "label", flag: str = "is_anomaly") -> DataFrame:
    """Confusion counts per hour of the test rows, hours present only."""
    require_columns(df, ["hour", "split", label, flag])
    test = df.where(F.col("split") == "test")
    return test.groupBy("hour").agg(*_confusion(label, flag), F.count(F.lit(1)).alias("n"))


def false_positives_by_hour(df: DataFrame, label: str = "label", flag: str = "is_anomaly") -> DataFrame:
    """Hourly false positives against normal rows; the rate is NULL where an hour has none."""
    normal = F.col("tn") + F.col("fp")
    rate = F.try_divide(F.col("fp").cast("double"), normal.cast("double"))
    return confusion_by_hour(df, label, flag).select(
        "hour", "fp", normal.alias("normal_rows"), rate.alias("fp_rate"), "fn", "tp", "n")


def top_false_positive_hours(df: DataFrame, k: int = 5, label: str = "label",
                             flag: str = "is_anomaly") -> DataFrame:
    return false_positives_by_hour(df, label, flag).orderBy(F.desc("fp"), "hour").limit(k)


def segment_table(df: DataFrame, global_recall: float | None = None, min_rows: int = 30,
                  label: str = "label", flag: str = "is_anomaly") -> DataFrame:
    """Test scores by hour and by weekday/weekend, both segmentations in one grouping-sets pass.

    ``flag_low_recall`` compares with ``global_recall``, by default the recall of all test rows.
    """
    require_columns(df, ["hour", "is_weekend", "split", label, flag])
    test = df.where(F.col("split") == "test")
    if global_recall is None:
        overall = detection_scorecard(test, (), label, flag).select("recall").scalar()
    else:
        overall = F.lit(float(global_recall))
    sets = test.groupingSets([[F.col("hour")], [F.col("is_weekend")]], F.col("hour"), F.col("is_weekend"))
    counts = sets.agg(*_confusion(label, flag), F.count(F.lit(1)).alias("n"),
                      F.grouping("hour").alias("_by_day"))
    day = F.when(F.col("is_weekend") == 0, "weekday").otherwise("weekend")
    return (with_rates(counts).where(F.col("n") >= min_rows)
            .select(F.when(F.col("_by_day") == 0, "hour").otherwise("day_kind").alias("segmentation"),
                    F.when(F.col("_by_day") == 0, F.col("hour").cast("string")).otherwise(day).alias("segment"),
                    "n", "precision", "recall", "f1", "fp", "fn",
                    (F.col("recall") < overall).alias("flag_low_recall")))


def flag_counts(df: DataFrame, flag: str = "is_anomaly", before: str | None = None,
                after: str | None = None) -> DataFrame:
    """Scored and flagged rows and, given both columns, rows that cleaning changed."""
    columns = [F.count(flag).alias("scored"), F.sum(F.col(flag).cast("long")).alias("flagged")]
    if before and after:
        columns.append(F.count_if(~F.col(before).eqNullSafe(F.col(after))).alias("changed"))
    return df.agg(*columns)
