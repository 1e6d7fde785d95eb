"""Readings derived from the shared test tables, and the same derivation in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.operators.joins import series_lookup
from meterflow.operators.ordering import windowed, with_row_index
from meterflow.operators.quantiles import exact_quantiles
from meterflow.sources.grid import to_interval_grid
from meterflow.spec import (HUMIDITY, LABEL, PAST, ROWS, SEASON, TARGET, TEMPERATURE, WIND, SeriesSpec)

ONE = SeriesSpec(one_per_slot=True)
TYPED = SeriesSpec(series=("event_type",), one_per_slot=True)
DAILY = SeriesSpec(series=("o_orderpriority",), step="1 day", one_per_slot=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def six(c: str | Column) -> Column:
    return F.round(c, 6)


def coarse(c: Column) -> Column:
    """Nearest 64th. Sums of such numbers are exact, so no order of addition changes a result."""
    return F.round(c * 64) / 64


def grid(spark: SparkSession, sf_dir: str, spec: SeriesSpec = ONE) -> DataFrame:
    """Half-hour slots of the events: target, three companion measures."""
    level = F.regexp_extract("props", r'"k": *([0-9.]+)', 1).cast("double")
    return to_interval_grid(table(spark, sf_dir, "events"), "ts", {
        TARGET: coarse(F.avg("value")),
        TEMPERATURE: coarse(F.avg(level)),
        HUMIDITY: F.count(F.lit(1)).cast("double"),
        WIND: coarse(F.max("value") - F.min("value")),
    }, step=spec.step, series=spec.series)


def readings(spark: SparkSession, sf_dir: str, spec: SeriesSpec = ONE) -> DataFrame:
    """Grid plus the mean of the previous day and a label from the 95th percentile, numbered."""
    slots = grid(spark, sf_dir, spec)
    past = windowed(with_row_index(slots, spec), spec,
                    {PAST: lambda w: coarse(F.avg(TARGET).over(w.rowsBetween(-SEASON, -1)))}, SEASON)
    high = exact_quantiles(slots, TARGET, [0.95], spec.series).select(
        *spec.series, six(F.col("quantiles")[0]).alias("_p95"), F.col("rows").alias(ROWS))
    label = F.when(F.col(TARGET) > F.col("_p95"), "Abnormal").otherwise("Normal")
    return series_lookup(past, high, spec.series).withColumn(LABEL, label).drop("_p95")


def orders_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily order value per priority: a second cadence."""
    return to_interval_grid(table(spark, sf_dir, "orders"), "o_orderdate", {
        TARGET: coarse(F.avg("o_totalprice")), "orders": F.count(F.lit(1))},
        step=DAILY.step, series=DAILY.series)


# --- SQL side -------------------------------------------------------------------------------

def grid_sql(keys: str = "") -> str:
    k = f"{keys}, " if keys else ""
    group = "1, 2" if keys else "1"
    return f"""grid AS (
  SELECT {k}time_bucket(INTERVAL '30 minutes', ts) AS "Timestamp",
         round(avg(value) * 64) / 64 AS "Electricity_Consumed",
         round(avg(CAST(regexp_extract(props, '"k": *([0-9.]+)', 1) AS DOUBLE)) * 64) / 64 AS "Temperature",
         CAST(count(*) AS DOUBLE) AS "Humidity",
         round((max(value) - min(value)) * 64) / 64 AS "Wind_Speed"
  FROM events GROUP BY {group})"""


def readings_sql(keys: str = "") -> str:
    part = f"PARTITION BY {keys} " if keys else ""
    k = f"{keys}, " if keys else ""
    on = f"USING ({keys})" if keys else "ON TRUE"
    group = f"GROUP BY {keys}" if keys else ""
    return f"""{grid_sql(keys)},
p95 AS (
  SELECT {k}round(quantile_cont("Electricity_Consumed", 0.95::DOUBLE), 6) AS p FROM grid
  {group}),
readings AS (
  SELECT {k}"Timestamp", "Electricity_Consumed", "Temperature", "Humidity", "Wind_Speed",
         round(avg("Electricity_Consumed") OVER ({part}ORDER BY "Timestamp"
               ROWS BETWEEN 48 PRECEDING AND 1 PRECEDING) * 64) / 64 AS "Avg_Past_Consumption",
         CASE WHEN "Electricity_Consumed" > p THEN 'Abnormal' ELSE 'Normal' END AS "Anomaly_Label",
         row_number() OVER ({part}ORDER BY "Timestamp") - 1 AS row_idx,
         count(*) OVER ({part}) AS series_rows
  FROM grid JOIN p95 {on})"""


def features_sql(keys: str = "") -> str:
    """Readings with all base and enhanced features, unrounded."""
    part = f"PARTITION BY {keys} " if keys else ""

    def roll(fn: str, n: int) -> str:
        over = f'OVER ({part}ORDER BY "Timestamp" ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)'
        return (f'CASE WHEN count("Electricity_Consumed") {over} = {n} '
                f'THEN {fn}("Electricity_Consumed") {over} END')

    return f"""{readings_sql(keys)},
calendar AS (
  SELECT *, CAST(hour("Timestamp") AS INTEGER) AS hour,
         CAST(isodow("Timestamp") - 1 AS INTEGER) AS day_of_week,
         CAST(month("Timestamp") AS INTEGER) AS month,
         CASE WHEN isodow("Timestamp") >= 6 THEN 1 ELSE 0 END AS is_weekend
  FROM readings),
rolled AS (
  SELECT *,
         {roll("avg", 6)} AS rolling_mean_3h, {roll("stddev_samp", 6)} AS rolling_std_3h,
         {roll("avg", 48)} AS rolling_mean_24h, {roll("stddev_samp", 48)} AS rolling_std_24h,
         sin(2 * pi() * hour / 24) AS hour_sin, cos(2 * pi() * hour / 24) AS hour_cos,
         sin(2 * pi() * day_of_week / 7) AS dow_sin, cos(2 * pi() * day_of_week / 7) AS dow_cos,
         "Electricity_Consumed" - lag("Electricity_Consumed") OVER ({part}ORDER BY "Timestamp") AS consumption_diff
  FROM calendar),
features AS (
  SELECT *, "Electricity_Consumed" - rolling_mean_24h AS consumption_residual_24h FROM rolled)"""


def split_sql(source: str, train: float, val: float, keys: str = "", name: str = "parted") -> str:
    """``source`` renumbered and labelled with a chronological split, in doubles as in Python."""
    part = f"PARTITION BY {keys} " if keys else ""
    both = train + val
    return f"""{name}_n AS (
  SELECT * EXCLUDE (row_idx, series_rows),
         row_number() OVER ({part}ORDER BY "Timestamp") - 1 AS row_idx,
         count(*) OVER ({part}) AS series_rows
  FROM {source}),
{name} AS (
  SELECT *, CASE WHEN row_idx < floor(series_rows * {train!r}::DOUBLE) THEN 'train'
                 WHEN row_idx < floor(series_rows * {both!r}::DOUBLE) THEN 'val' ELSE 'test' END AS split
  FROM {name}_n)"""
