"""Chronological train, validation and test labels computed from row numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.operators.ordering import ensure_row_index
from meterflow.spec import (DEFAULT_LAYOUT, FORECAST_SPLIT, ROW, ROWS, TUNING_SPLIT, Layout, SeriesSpec)


VAL_ROWS = "val_rows"


def cut_points(rows: int, train: float, val: float) -> tuple[int, int]:
    """Ends of train and validation, truncating IEEE double products."""
    return int(rows * train), int(rows * (train + val))


def _label(train: float, val: float) -> tuple[Column, Column, Column]:
    rows = F.col(ROWS).cast("double")
    train_end = F.floor(rows * F.lit(float(train)))
    val_end = F.floor(rows * F.lit(float(train + val)))
    label = (F.when(F.col(ROW) < train_end, "train")
             .when(F.col(ROW) < val_end, "val")
             .otherwise("test"))
    return label, train_end, val_end


def forecast_split(df: DataFrame, spec: SeriesSpec, train: float = FORECAST_SPLIT[0],
                   val: float = FORECAST_SPLIT[1], layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """Add ``split`` and ``val_rows``; a series too short to fill all three parts fails the job.

    ``val_rows``, the size of the validation part, lets later steps close that gap without a join.
    """
    if not (0 < train < 1 and 0 < val < 1 and train + val < 1):
        raise ValueError(f"need 0 < train, val and train + val < 1, got {train} and {val}")
    label, train_end, val_end = _label(train, val)
    empty = (train_end == 0) | (val_end == train_end) | (val_end >= F.col(ROWS))
    message = F.concat(F.lit("empty split part for a series of rows: "), F.col(ROWS).cast("string"))
    return ensure_row_index(df, spec, layout).withColumns({
        "split": F.when(empty, F.raise_error(message).cast("string")).otherwise(label),
        VAL_ROWS: val_end - train_end})


def tuning_split(df: DataFrame, spec: SeriesSpec, train: float = TUNING_SPLIT[0],
                 val: float = TUNING_SPLIT[1], layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """Add ``split`` for detector tuning; parts may be empty."""
    if train + val >= 1:
        raise ValueError("train + val must be less than 1")
    return ensure_row_index(df, spec, layout).withColumn("split", _label(train, val)[0])
