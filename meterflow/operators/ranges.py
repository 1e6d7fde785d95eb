"""Features of a time range of a stored table, without reading the rest of it.

A filter on time does not pass below a window, so the days to read are settled beforehand: the table is stored by day
together with its row counts a series and day. These tell how many days before the range hold the rows that the
windows look back on (the halo), and how many rows precede them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterflow.operators.joins import lookup
from meterflow.operators.ordering import with_row_index
from meterflow.sources.sinks import write_clean
from meterflow.spec import DEFAULT_LAYOUT, ROW, ROWS, SEASON, Layout, SeriesSpec

FeatureBuilder = Callable[[DataFrame], DataFrame]


def write_ranged(df: DataFrame, path: str, spec: SeriesSpec) -> str:
    """Store rows by day and their counts, for ``rows_between`` and ``features_between``. Row numbers are not stored."""
    write_clean(df.drop(ROW, ROWS), f"{path}/rows", ts=spec.ts)
    stored = df.sparkSession.read.parquet(f"{path}/rows")
    stored.groupBy(*spec.series, "date").agg(F.count("*").alias("rows")).write.mode("overwrite").parquet(f"{path}/counts")
    return path


def _first_days(counts: DataFrame, spec: SeriesSpec, start: dt.datetime, end: dt.datetime, back: int) -> DataFrame:
    """Per series with rows in the range: the first day to read, the rows before it, and all its rows.

    Counts are a row a series and day, so a window over a series is as long as its days.
    """
    key = F.struct(*spec.series, F.lit(0))
    earlier = Window.partitionBy("_series").orderBy(F.col("date").desc()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("_series")
    wanted = F.col("date").between(F.lit(start.date()), F.lit(end.date()))
    days = (counts.withColumn("_series", key)
            .withColumn("_used", F.max(wanted).over(whole))
            .withColumn("_all", F.sum("rows").over(whole))
            .withColumn("_later", F.coalesce(F.sum(F.when(F.col("date") < F.lit(start.date()), F.col("rows"))).over(earlier), F.lit(0))))
    # a day is read if it is in the range, or if the days between it and the range hold too few rows
    read = (F.col("date") >= F.lit(start.date())) | (F.col("_later") < back)
    return (days.where("_used").groupBy("_series")
            .agg(F.min(F.when(read, F.col("date"))).alias("_day"), F.coalesce(F.sum(F.when(~read, F.col("rows"))), F.lit(0)).alias("_skipped"),
                 F.first("_all").alias("_all"), F.sum(F.when(read & (F.col("date") <= F.lit(end.date())), F.col("rows"))).alias("_weight")))


def rows_between(spark: SparkSession, path: str, spec: SeriesSpec, start: dt.datetime, end: dt.datetime, back: int = SEASON,
                 layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """Numbered rows of the range ``[start, end)`` and at least ``back`` rows before it a series, where it has so many.

    Only the days from the earliest first day of any series on are opened; rows keep the numbers they have in the whole table.
    """
    days = _first_days(spark.read.parquet(f"{path}/counts"), spec, start, end, back)
    first = days.agg(F.min("_day")).first()[0] or start.date()
    rows = spark.read.parquet(f"{path}/rows").where(F.col("date").between(F.lit(first), F.lit(end.date()))).where(F.col(spec.ts) < F.lit(end).cast("timestamp_ntz"))
    keyed = lookup(rows.withColumn("_series", F.struct(*spec.series, F.lit(0))), days, "_series", "_weight").where(F.col("date") >= F.col("_day"))
    numbered = with_row_index(keyed, spec, layout)
    return (numbered.withColumns({ROW: F.col(ROW) + F.col("_skipped"), ROWS: F.col("_all")})
            .drop("_series", "_day", "_skipped", "_all", "date"))


def features_between(spark: SparkSession, path: str, spec: SeriesSpec, start: dt.datetime, end: dt.datetime, build: FeatureBuilder,
                     back: int = SEASON, layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """What ``build`` makes of the whole table, for the rows of ``[start, end)``. ``build`` looks back ``back`` rows at most."""
    made = build(rows_between(spark, path, spec, start, end, back, layout))
    return made.where((F.col(spec.ts) >= F.lit(start).cast("timestamp_ntz")) & (F.col(spec.ts) < F.lit(end).cast("timestamp_ntz")))
