"""Writers for cleaned readings and predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.functions.checks import require_columns
from meterflow.spec import TIMESTAMP, TIMESTAMP_FORMAT


def write_clean(df: DataFrame, path: str, *, ts: str = TIMESTAMP, file_format: str = "parquet",
                by_date: bool = True, mode: str = "overwrite") -> str:
    """Write a cleaned artefact. Parquet is partitioned by day so that time filters prune files.

    Rows are first gathered by day (many tasks per day when a day is large), which keeps the
    number of files per partition small.
    """
    if file_format == "csv":
        text = df.withColumn(ts, F.date_format(ts, TIMESTAMP_FORMAT))
        text.write.mode(mode).option("header", True).csv(path)
        return path
    if not by_date:
        df.write.mode(mode).format(file_format).save(path)
        return path
    dated = df.withColumn("date", F.to_date(ts)).hint("rebalance", "date")
    dated.write.mode(mode).partitionBy("date").format(file_format).save(path)
    return path


def write_predictions(df: DataFrame, path: str, *, ts: str = TIMESTAMP, file_format: str = "csv") -> str:
    """Write time, truth and prediction (plus any key columns) of scored rows."""
    require_columns(df, [ts, "y_true", "y_pred"])
    out = df.withColumn(ts, F.date_format(ts, TIMESTAMP_FORMAT)) if file_format == "csv" else df
    writer = out.write.mode("overwrite")
    (writer.option("header", True).csv(path) if file_format == "csv"
     else writer.format(file_format).save(path))
    return path
