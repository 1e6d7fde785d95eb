"""Readers for raw readings and for cleaned artefacts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterflow.functions.checks import missing_to_null, require_columns
from meterflow.spec import (CALENDAR_COLUMNS, CYCLICAL_COLUMNS, DERIVATIVE_COLUMNS, LABEL, READING_COLUMNS,
                            ROLLING_WINDOWS, TARGET, TIMESTAMP, TIMESTAMP_FORMAT)


def readings_schema(series: tuple[str, ...] = ()) -> T.StructType:
    """Canonical columns; the time arrives as text so that its format can be enforced."""
    kinds = {TIMESTAMP: T.StringType(), LABEL: T.StringType()}
    return T.StructType(
        [T.StructField(s, T.StringType()) for s in series]
        + [T.StructField(c, kinds.get(c, T.DoubleType())) for c in READING_COLUMNS])


def clean_schema(series: tuple[str, ...] = ()) -> T.StructType:
    """Canonical columns plus the derived ones a cleaned CSV may carry."""
    derived = [T.StructField(c, T.IntegerType()) for c in CALENDAR_COLUMNS]
    rolling = [f"rolling_{kind}_{name}" for name in ROLLING_WINDOWS for kind in ("mean", "std")]
    derived += [T.StructField(c, T.DoubleType())
                for c in (*rolling, *CYCLICAL_COLUMNS, *DERIVATIVE_COLUMNS)]
    return T.StructType(readings_schema(series).fields + derived)


def _parse_time(df: DataFrame, fmt: str) -> DataFrame:
    if isinstance(df.schema[TIMESTAMP].dataType, T.StringType):
        # ANSI parsing fails the job on the first text that breaks the format.
        df = df.withColumn(TIMESTAMP, F.to_timestamp_ntz(F.col(TIMESTAMP), F.lit(fmt)))
    doubles = [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: missing_to_null(c) for c in doubles})


def read_readings(
    spark: SparkSession,
    path: str | list[str],
    *,
    schema: T.StructType | None = None,
    fmt: str = TIMESTAMP_FORMAT,
    mode: str = "FAILFAST",
) -> DataFrame:
    """Read header CSV readings from a path, folder or glob; order is left to the operators.

    Every file is read by its own header, so files may hold the columns in different orders; a column that
    a file lacks is NULL there. ``schema`` defaults to the canonical one; each header must have the time
    column. A text that is no number in a number column fails the job unless ``mode`` is ``PERMISSIVE``.
    """
    known = {f.name: f for f in (schema or readings_schema())}
    tables = []
    for header, files in _headers(spark, path).items():
        by_header = T.StructType([known.get(c, T.StructField(c, T.StringType())) for c in header])
        reader = spark.read.option("header", True).option("enforceSchema", False).option("mode", mode).schema(by_header)
        tables.append(reader.csv(files))
    return _parse_time(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables), fmt)


def _headers(spark: SparkSession, path: str | list[str]) -> dict[tuple[str, ...], list[str]]:
    """Files by header. A header line holds the time column's name among its fields."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    names = F.transform(F.split("value", ","), lambda c: F.trim(F.regexp_replace(c, '"', "")))
    first = (lines.where((F.col("block") == 0) & F.array_contains(names, TIMESTAMP)).groupBy("file").agg(F.min("value").alias("header")))
    by_header: dict[tuple[str, ...], list[str]] = {}
    for row in first.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("header").collect():
        columns = tuple(spark.read.option("header", True).csv(row["files"][0]).columns)
        by_header.setdefault(columns, []).extend(row["files"])
    read = sum(map(len, by_header.values()))
    all_files = lines.where("block = 0").select("file").distinct().count()
    if not by_header or read < all_files:
        raise ValueError(f"Column {TIMESTAMP!r} not found in the header of {all_files - read or 'any'} file of {path}")
    return by_header


def read_clean(spark: SparkSession, path: str, *, target: str = TARGET, fmt: str = TIMESTAMP_FORMAT,
               file_format: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    """Read a cleaned artefact (Parquet or CSV) and insist on its time and target columns."""
    if file_format == "csv":
        df = read_readings(spark, path, schema=schema or clean_schema(), fmt=fmt)
    else:
        df = spark.read.format(file_format).load(path)
        require_columns(df, [TIMESTAMP], ValueError)
        df = _parse_time(df, fmt)
    require_columns(df, [target], ValueError)
    return df
