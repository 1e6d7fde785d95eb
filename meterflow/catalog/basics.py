"""Queries over sources, quality reports, features, splits and matrices."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.catalog.registry import query
from meterflow.catalog.tables import (DAILY, ONE, TYPED, features_sql, grid, grid_sql, orders_by_day, readings,
                                      readings_sql, six, split_sql, table)
from meterflow.operators import features as ft
from meterflow.operators import matrix as mx
from meterflow.operators import quality as ql
from meterflow.operators.ordering import with_row_index
from meterflow.operators.ranges import features_between, write_ranged
from meterflow.operators.splits import forecast_split, tuning_split
from meterflow.session import materialize, scratch_path
from meterflow.sources.readings import read_clean, read_readings
from meterflow.sources.sinks import write_clean
from meterflow.spec import FORECAST_SPLIT, READING_COLUMNS, ROW, ROWS, TARGET, TIMESTAMP, TUNING_SPLIT, SeriesSpec

READING_LIST = ('"Timestamp", "Electricity_Consumed", "Temperature", "Humidity", "Wind_Speed", '
                '"Avg_Past_Consumption", "Anomaly_Label"')


# --- Sources and sinks ------------------------------------------------------------------------

@query("s1_csv_readings", f"WITH {readings_sql()} SELECT {READING_LIST} FROM readings")
def s1(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_clean(readings(spark, sf_dir).select(*READING_COLUMNS), scratch_path(spark, "csv"), file_format="csv")
    return read_readings(spark, path)


@query("s1_csv_mixed_headers", f"WITH {readings_sql()} SELECT {READING_LIST} FROM readings")
def s1_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One folder, two orders of columns."""
    rows, path = readings(spark, sf_dir).select(*READING_COLUMNS), scratch_path(spark, "csv")
    early = F.col(TIMESTAMP) < "2024-01-15"
    write_clean(rows.where(early), path, file_format="csv")
    write_clean(rows.where(~early).select(*reversed(READING_COLUMNS)), path, file_format="csv", mode="append")
    return read_readings(spark, path)


@query("s2_clean_artefact", f"WITH {readings_sql()} SELECT {READING_LIST} FROM readings")
def s2(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = readings(spark, sf_dir).select(*READING_COLUMNS)
    path = write_clean(source, scratch_path(spark, "clean"), by_date=False)
    return read_clean(spark, path)


@query("s3_clean_by_date", f"""WITH {readings_sql()}
SELECT strftime("Timestamp", '%Y-%m-%d') AS date, count(*) AS rows, round(avg("Electricity_Consumed"), 6) AS mean
FROM readings WHERE "Timestamp" >= TIMESTAMP '2024-01-10' AND "Timestamp" < TIMESTAMP '2024-01-20' GROUP BY 1""")
def s3(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = readings(spark, sf_dir).select(*READING_COLUMNS)
    path = write_clean(source, scratch_path(spark, "clean"))
    # The day partitions are pruned by this filter before any file is opened.
    return (read_clean(spark, path).where(F.col("date").between("2024-01-10", "2024-01-19"))
            .groupBy(F.col("date").cast("string").alias("date")).agg(F.count(F.lit(1)).alias("rows"), six(F.avg(TARGET)).alias("mean")))


GRID_LIST = '"Timestamp", "Electricity_Consumed", "Temperature", "Humidity", "Wind_Speed"'


@query("s5_interval_grid", f"WITH {grid_sql()} SELECT {GRID_LIST} FROM grid")
def s5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid(spark, sf_dir)


@query("s5_interval_grid_by_type", f"WITH {grid_sql('event_type')} SELECT event_type, {GRID_LIST} FROM grid")
def s5_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid(spark, sf_dir, TYPED)


@query("s5_daily_orders", """
SELECT o_orderpriority, time_bucket(INTERVAL '1 day', o_orderdate) AS "Timestamp",
       round(avg(o_totalprice) * 64) / 64 AS "Electricity_Consumed", count(*) AS orders
FROM orders GROUP BY 1, 2""")
def s5_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_by_day(spark, sf_dir)


@query("row_index_by_type", f"""WITH {readings_sql('event_type')}
SELECT event_type, "Timestamp", row_idx, series_rows FROM readings""")
def row_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_row_index(grid(spark, sf_dir, TYPED), TYPED).select("event_type", TIMESTAMP, ROW, ROWS)


@query("row_index_raw_events", """
SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS row_idx,
       count(*) OVER (PARTITION BY event_type) AS series_rows FROM events""")
def row_index_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = SeriesSpec(ts="ts", target="value", series=("event_type",), tiebreak=("event_id",))
    return with_row_index(table(spark, sf_dir, "events"), spec).select("event_type", "event_id", ROW, ROWS)


# --- Quality ----------------------------------------------------------------------------------

_TYPES = (("Timestamp", "timestamp_ntz"), ("Electricity_Consumed", "double"), ("Temperature", "double"),
          ("Humidity", "double"), ("Wind_Speed", "double"), ("Avg_Past_Consumption", "double"),
          ("Anomaly_Label", "string"))


@query("q1_schema_summary", f"WITH {readings_sql()} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", '{t}' AS dtype, count(*) - count("{c}") AS nulls, count(*) AS rows FROM readings"""
    for c, t in _TYPES))
def q1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ql.schema_summary(readings(spark, sf_dir).select(*READING_COLUMNS))


def _continuity_sql(keys: str = "", count_difference: bool = False) -> str:
    part = f"PARTITION BY {keys} " if keys else ""
    k = f"{keys}, " if keys else ""
    group = f"GROUP BY {keys}" if keys else ""
    return f"""{grid_sql(keys)},
deltas AS (SELECT {k}"Timestamp" AS t,
  "Timestamp" - lag("Timestamp") OVER ({part}ORDER BY "Timestamp") AS d FROM grid),
facts AS (
  SELECT {k}min(t) AS start_ts, max(t) AS end_ts, count(*) AS observed,
         CAST(floor((epoch(max(t)) - epoch(min(t))) / 1800) + 1 AS BIGINT) AS expected,
         count(*) - count(DISTINCT t) AS duplicates,
         CAST(sum(CASE WHEN d IS NOT NULL AND d <> INTERVAL '30 minutes' THEN 1 ELSE 0 END) AS BIGINT) AS irregular,
         count(DISTINCT t) AS times
  FROM deltas {group})"""


@query("q2_time_continuity", f"""WITH {_continuity_sql()}
SELECT start_ts, end_ts, observed, expected, expected - times AS missing, duplicates, irregular,
  CASE WHEN expected = times AND duplicates = 0 AND irregular = 0 THEN 'PASS' ELSE 'REVIEW' END AS verdict
FROM facts""")
def q2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ql.time_continuity(grid(spark, sf_dir), ONE)


@query("q2_time_continuity_by_type", f"""WITH {_continuity_sql('event_type')}
SELECT event_type, start_ts, end_ts, observed, expected, expected - times AS missing, duplicates, irregular,
  CASE WHEN expected = times AND duplicates = 0 AND irregular = 0 THEN 'PASS' ELSE 'REVIEW' END AS verdict
FROM facts""")
def q2_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ql.time_continuity(grid(spark, sf_dir, TYPED), TYPED)


@query("q2_time_continuity_orders", """
WITH times AS (SELECT o_orderpriority, o_orderdate AS t, count(*) AS copies FROM orders GROUP BY 1, 2),
deltas AS (SELECT *, t - lag(t) OVER (PARTITION BY o_orderpriority ORDER BY t) AS d,
           min(t) OVER (PARTITION BY o_orderpriority) AS first_t FROM times),
facts AS (
  SELECT o_orderpriority, min(t) AS start_ts, max(t) AS end_ts, CAST(sum(copies) AS BIGINT) AS observed,
         CAST(floor((epoch(max(t)) - epoch(min(t))) / 86400) + 1 AS BIGINT) AS expected,
         CAST(sum(copies) - count(*) AS BIGINT) AS duplicates,
         CAST(sum(CASE WHEN d IS NOT NULL AND d <> INTERVAL '1 day' THEN 1 ELSE 0 END) + sum(copies - 1) AS BIGINT)
           AS irregular,
         count(*) FILTER (WHERE (epoch(t) - epoch(first_t)) % 86400 = 0) AS on_grid
  FROM deltas GROUP BY 1)
SELECT o_orderpriority, start_ts, end_ts, observed, expected, expected - on_grid AS missing, duplicates, irregular,
  CASE WHEN expected = on_grid AND duplicates = 0 AND irregular = 0 THEN 'PASS' ELSE 'REVIEW' END AS verdict
FROM facts""")
def q2_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = SeriesSpec(ts="o_orderdate", target="o_totalprice", series=("o_orderpriority",), step="1 day")
    return ql.time_continuity(table(spark, sf_dir, "orders"), spec)


@query("q3_missing_slots", f"""WITH {grid_sql()},
expected AS (SELECT unnest(generate_series(min("Timestamp"), max("Timestamp"), INTERVAL '30 minutes')) AS missing_ts
             FROM grid)
SELECT missing_ts FROM expected WHERE missing_ts NOT IN (SELECT "Timestamp" FROM grid)
ORDER BY missing_ts LIMIT 10""")
def q3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ql.missing_slots(grid(spark, sf_dir), ONE)


@query("q3_missing_slots_by_type", f"""WITH {grid_sql('event_type')},
expected AS (SELECT event_type,
               unnest(generate_series(min("Timestamp"), max("Timestamp"), INTERVAL '30 minutes')) AS missing_ts
             FROM grid GROUP BY event_type),
absent AS (SELECT e.event_type, missing_ts,
             row_number() OVER (PARTITION BY e.event_type ORDER BY missing_ts) AS r
           FROM expected e LEFT JOIN grid g ON g.event_type = e.event_type AND g."Timestamp" = e.missing_ts
           WHERE g."Timestamp" IS NULL)
SELECT event_type, missing_ts FROM absent WHERE r <= 10""")
def q3_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ql.missing_slots(grid(spark, sf_dir, TYPED), TYPED)


@query("q4_readiness", f"""WITH {_continuity_sql()},
nulls AS (SELECT count(*) - count("Electricity_Consumed") AS target_nulls FROM grid)
SELECT observed AS rows, target_nulls, duplicates, irregular, expected - times AS missing,
  target_nulls = 0 AND duplicates = 0 AND irregular = 0 AND expected = times AS ready
FROM facts, nulls""")
def q4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ql.readiness(grid(spark, sf_dir), ONE)


@query("q5_feature_checks", f"""WITH {features_sql()}
SELECT bool_and(hour BETWEEN 0 AND 23) AS hour_ok, bool_and(day_of_week BETWEEN 0 AND 6) AS day_of_week_ok,
  bool_and(month BETWEEN 1 AND 12) AS month_ok, bool_and(is_weekend IN (0, 1)) AS is_weekend_ok,
  bool_and(row_idx >= 5 OR rolling_mean_3h IS NULL) AS warmup_3h_ok,
  bool_and(row_idx < series_rows - 5 OR (rolling_mean_3h IS NOT NULL AND rolling_std_3h IS NOT NULL)) AS tail_3h_ok,
  bool_and(row_idx >= 47 OR rolling_mean_24h IS NULL) AS warmup_24h_ok,
  bool_and(row_idx < series_rows - 5 OR (rolling_mean_24h IS NOT NULL AND rolling_std_24h IS NOT NULL)) AS tail_24h_ok,
  bool_and(hour_sin BETWEEN -1 AND 1) AS hour_sin_ok, bool_and(hour_cos BETWEEN -1 AND 1) AS hour_cos_ok,
  bool_and(dow_sin BETWEEN -1 AND 1) AS dow_sin_ok, bool_and(dow_cos BETWEEN -1 AND 1) AS dow_cos_ok,
  bool_and(row_idx > 0 OR consumption_diff IS NULL) AS first_diff_ok,
  bool_and(row_idx < series_rows - 5 OR consumption_residual_24h IS NOT NULL) AS tail_residual_ok
FROM features""")
def q5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ql.feature_checks(ft.enhanced_features(readings(spark, sf_dir), ONE), ONE)


def _adjacency_sql(keys: str = "") -> str:
    k = f"{keys}, " if keys else ""
    group = f"GROUP BY {keys}" if keys else ""
    parts = ",\n".join(
        f"""count(*) FILTER (WHERE split = '{p}') AS {p}_rows, min("Timestamp") FILTER (WHERE split = '{p}') AS {p}_start,
  max("Timestamp") FILTER (WHERE split = '{p}') AS {p}_end""" for p in ("train", "val", "test"))
    return f"""WITH {readings_sql(keys)}, {split_sql("readings", *FORECAST_SPLIT, keys=keys)},
sizes AS (SELECT {k}{parts} FROM parted {group})
SELECT *, epoch(val_start) - epoch(train_end) = 1800 AS train_val_adjacent,
  epoch(test_start) - epoch(val_end) = 1800 AS val_test_adjacent FROM sizes"""


@query("q6_split_adjacency", _adjacency_sql())
def q6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ql.split_adjacency(forecast_split(grid(spark, sf_dir), ONE), ONE)


@query("q6_split_adjacency_by_type", _adjacency_sql("event_type"))
def q6_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ql.split_adjacency(forecast_split(grid(spark, sf_dir, TYPED), TYPED), TYPED)


@query("q7_lag_frame_check", f"""WITH {readings_sql('event_type')},
lags AS (SELECT event_type, lag("Electricity_Consumed", 48) OVER (PARTITION BY event_type ORDER BY "Timestamp") AS l
         FROM readings)
SELECT event_type, count(*) AS rows_before, count(l) AS rows_after, count(*) - count(l) AS rows_dropped,
  count(*) - count(l) = 48 AS drop_ok FROM lags GROUP BY 1""")
def q7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ql.lag_frame_check(materialize(grid(spark, sf_dir, TYPED)), TYPED)


@query("q8_sequence_shape", f"""WITH {readings_sql('event_type')}
SELECT event_type, least(count(*), 200) - 24 AS samples, 24 AS steps, 7 AS features FROM readings GROUP BY 1""")
def q8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ql.sequence_shape_check(ft.add_calendar(grid(spark, sf_dir, TYPED)), TYPED)


# --- Features ---------------------------------------------------------------------------------

def rounded(df: DataFrame, *columns: str) -> DataFrame:
    doubles = {f.name for f in df.schema if f.dataType.simpleString() == "double"}
    return df.select(*[six(c).alias(c) if c in doubles else F.col(c) for c in columns])


def rounded_sql(doubles: tuple[str, ...], others: tuple[str, ...] = ()) -> str:
    return ", ".join([*(f'"{c}"' for c in others), *(f'round("{c}", 6) AS "{c}"' for c in doubles)])


CALENDAR = ("hour", "day_of_week", "month", "is_weekend")
ROLLING = ("rolling_mean_3h", "rolling_std_3h", "rolling_mean_24h", "rolling_std_24h")
CYCLICAL = ("hour_sin", "hour_cos", "dow_sin", "dow_cos")
DERIVED = ("consumption_diff", "consumption_residual_24h")
BASE_DOUBLES = ("Electricity_Consumed", "Temperature", "Humidity", "Wind_Speed", "Avg_Past_Consumption", *ROLLING)
ENHANCED_DOUBLES = (*BASE_DOUBLES, *CYCLICAL, *DERIVED)
KEEP = ("Timestamp", "Anomaly_Label", *CALENDAR)


@query("f1_calendar", f"""WITH {features_sql()}
SELECT "Timestamp", hour, day_of_week, month, is_weekend FROM features""")
def f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ft.add_calendar(grid(spark, sf_dir)).select(TIMESTAMP, *CALENDAR)


@query("f2_cyclical", f"WITH {features_sql()} SELECT {rounded_sql(CYCLICAL, ('Timestamp',))} FROM features")
def f2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ft.add_cyclical(ft.add_calendar(grid(spark, sf_dir))), TIMESTAMP, *CYCLICAL)


@query("f3_derivatives", f"WITH {features_sql()} SELECT {rounded_sql(DERIVED, ('Timestamp',))} FROM features")
def f3(spark: SparkSession, sf_dir: str) -> DataFrame:
    rolled = ft.add_rolling(grid(spark, sf_dir), ONE)
    return rounded(ft.add_derivatives(rolled, ONE), TIMESTAMP, *DERIVED)


@query("f4_day_names", f"""WITH {grid_sql()}
SELECT "Timestamp", CAST(hour("Timestamp") AS INTEGER) AS hour, CAST(isodow("Timestamp") - 1 AS INTEGER) AS day_of_week,
  dayname("Timestamp") AS day_name, isodow("Timestamp") >= 6 AS is_weekend FROM grid""")
def f4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ft.add_day_names(grid(spark, sf_dir)).select(TIMESTAMP, "hour", "day_of_week", "day_name", "is_weekend")


@query("f5_base_features", f"WITH {features_sql()} SELECT {rounded_sql(BASE_DOUBLES, KEEP)} FROM features")
def f5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ft.base_features(readings(spark, sf_dir), ONE), *KEEP, *BASE_DOUBLES)


@query("f5_base_features_by_type", f"""WITH {features_sql('event_type')}
SELECT {rounded_sql(BASE_DOUBLES, ('event_type', *KEEP))} FROM features""")
def f5_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ft.base_features(readings(spark, sf_dir, TYPED), TYPED), "event_type", *KEEP, *BASE_DOUBLES)


@query("f6_enhanced_features", f"WITH {features_sql()} SELECT {rounded_sql(ENHANCED_DOUBLES, KEEP)} FROM features")
def f6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ft.enhanced_features(readings(spark, sf_dir), ONE), *KEEP, *ENHANCED_DOUBLES)


_ABLATED = ("Electricity_Consumed", "Avg_Past_Consumption", *ROLLING)


@query("f7_weather_ablation", f"""WITH {features_sql()}
SELECT {rounded_sql(_ABLATED, KEEP)} FROM features WHERE rolling_std_24h IS NOT NULL""")
def f7(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = mx.evaluable_rows(ft.base_features(readings(spark, sf_dir), ONE), ONE)
    return rounded(ft.drop_weather(kept).drop(ROW, ROWS), *KEEP, *_ABLATED)


@query("f8_label_codes", f"""WITH {readings_sql()}
SELECT "Timestamp", CASE "Anomaly_Label" WHEN 'Normal' THEN 0 WHEN 'Abnormal' THEN 1 END AS label FROM readings""")
def f8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ft.encode_labels(readings(spark, sf_dir)).select(TIMESTAMP, "label")


@query("f10_rolling", f"WITH {features_sql()} SELECT {rounded_sql(ROLLING, ('Timestamp',))} FROM features")
def f10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ft.add_rolling(grid(spark, sf_dir), ONE), TIMESTAMP, *ROLLING)


@query("f10_rolling_by_type", f"""WITH {features_sql('event_type')}
SELECT {rounded_sql(ROLLING, ('event_type', 'Timestamp'))} FROM features""")
def f10_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ft.add_rolling(grid(spark, sf_dir, TYPED), TYPED), "event_type", TIMESTAMP, *ROLLING)


@query("f10_rolling_daily_orders", """
WITH grid AS (SELECT o_orderpriority, time_bucket(INTERVAL '1 day', o_orderdate) AS "Timestamp",
                round(avg(o_totalprice) * 64) / 64 AS y FROM orders GROUP BY 1, 2)
SELECT o_orderpriority, "Timestamp",
  round(CASE WHEN count(y) OVER w6 = 6 THEN avg(y) OVER w6 END, 4) AS rolling_mean_3h,
  round(CASE WHEN count(y) OVER w48 = 48 THEN avg(y) OVER w48 END, 4) AS rolling_mean_24h
FROM grid
WINDOW w6 AS (PARTITION BY o_orderpriority ORDER BY "Timestamp" ROWS BETWEEN 5 PRECEDING AND CURRENT ROW),
  w48 AS (PARTITION BY o_orderpriority ORDER BY "Timestamp" ROWS BETWEEN 47 PRECEDING AND CURRENT ROW)""")
def f10_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    rolled = ft.add_rolling(orders_by_day(spark, sf_dir), DAILY)
    return rolled.select("o_orderpriority", TIMESTAMP, F.round("rolling_mean_3h", 4).alias("rolling_mean_3h"),
                         F.round("rolling_mean_24h", 4).alias("rolling_mean_24h"))


RANGE = (dt.datetime(2024, 1, 15, 7, 0), dt.datetime(2024, 1, 17, 12, 30))
_IN_RANGE = f""""Timestamp" >= TIMESTAMP '{RANGE[0]}' AND "Timestamp" < TIMESTAMP '{RANGE[1]}'"""


def _ranged(spark: SparkSession, sf_dir: str, spec: SeriesSpec) -> str:
    return write_ranged(readings(spark, sf_dir, spec), scratch_path(spark, "ranged"), spec)


@query("f10_features_between", f"""WITH {features_sql()}
SELECT {rounded_sql(ROLLING, ('Timestamp', 'hour', 'row_idx'))} FROM features WHERE {_IN_RANGE}""")
def f10_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = features_between(spark, _ranged(spark, sf_dir, ONE), ONE, *RANGE, lambda df: ft.base_features(df, ONE))
    return rounded(rows, TIMESTAMP, "hour", ROW, *ROLLING)


@query("f10_features_between_by_type", f"""WITH {features_sql('event_type')}
SELECT {rounded_sql(ROLLING, ('event_type', 'Timestamp', 'hour', 'row_idx'))} FROM features WHERE {_IN_RANGE}""")
def f10_between_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = features_between(spark, _ranged(spark, sf_dir, TYPED), TYPED, *RANGE, lambda df: ft.base_features(df, TYPED))
    return rounded(rows, "event_type", TIMESTAMP, "hour", ROW, *ROLLING)


@query("f11_rolling_overlay", f"""WITH {grid_sql()}
SELECT "Timestamp", "Electricity_Consumed", round(avg("Electricity_Consumed") OVER (
  ORDER BY "Timestamp" ROWS BETWEEN 47 PRECEDING AND CURRENT ROW), 6) AS rolling_overlay FROM grid""")
def f11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ft.add_rolling_overlay(grid(spark, sf_dir), ONE), TIMESTAMP, TARGET, "rolling_overlay")


def lags_sql(keys: str = "") -> str:
    part = f"PARTITION BY {keys} " if keys else ""
    cols = ", ".join(f'lag("Electricity_Consumed", {k}) OVER ({part}ORDER BY "Timestamp") AS "Electricity_Consumed_lag_{k}"'
                     for k in (1, 2, 48))
    return f"""{features_sql(keys)},
all_lags AS (SELECT *, {cols} FROM features),
lags AS (SELECT * FROM all_lags WHERE "Electricity_Consumed_lag_48" IS NOT NULL)"""


LAG_COLUMNS = tuple(f"Electricity_Consumed_lag_{k}" for k in (1, 2, 48))


@query("f12_supervised_lags", f"""WITH {lags_sql()}
SELECT "Timestamp", "Electricity_Consumed", {", ".join(f'"{c}"' for c in LAG_COLUMNS)}, row_idx - 48 AS row_idx FROM lags""")
def f12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ft.supervised_lags(grid(spark, sf_dir), ONE).select(TIMESTAMP, TARGET, *LAG_COLUMNS, ROW)


@query("f12_supervised_lags_by_type", f"""WITH {lags_sql('event_type')}
SELECT event_type, "Timestamp", "Electricity_Consumed", {", ".join(f'"{c}"' for c in LAG_COLUMNS)},
  row_idx - 48 AS row_idx FROM lags""")
def f12_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ft.supervised_lags(grid(spark, sf_dir, TYPED), TYPED).select(
        "event_type", TIMESTAMP, TARGET, *LAG_COLUMNS, ROW)


@query("f12_lags_between", f"""WITH {lags_sql()}
SELECT "Timestamp", "Electricity_Consumed", {", ".join(f'"{c}"' for c in LAG_COLUMNS)} FROM lags WHERE {_IN_RANGE}""")
def f12_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = features_between(spark, _ranged(spark, sf_dir, ONE), ONE, *RANGE, lambda df: ft.supervised_lags(df, ONE))
    return rows.select(TIMESTAMP, TARGET, *LAG_COLUMNS)


@query("f13_sequences", f"""WITH {features_sql()},
pairs AS (SELECT a."Timestamp", a.row_idx, a."Electricity_Consumed" AS next_target, b.row_idx - a.row_idx + 25 AS weight,
            b."Electricity_Consumed" AS y, b."Temperature" AS t, b.hour AS h
          FROM features a JOIN features b ON b.row_idx BETWEEN a.row_idx - 24 AND a.row_idx - 1 WHERE a.row_idx >= 24)
SELECT "Timestamp", row_idx - 24 AS row_idx, round(any_value(next_target), 6) AS next_target, count(*) AS steps,
  round(sum(weight * y), 4) AS weighted_target, round(sum(weight * t), 4) AS weighted_temperature,
  CAST(sum(weight * h) AS DOUBLE) AS weighted_hour
FROM pairs GROUP BY "Timestamp", row_idx""")
def f13(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = ft.sequences(ft.add_calendar(grid(spark, sf_dir)), ONE)

    # A position-weighted sum per feature shows content and order of the arrays at once.
    def weighted(i: int) -> F.Column:
        terms = F.transform("sequence", lambda v, k: v[i] * (k + 1))
        return F.aggregate(terms, F.lit(0.0), lambda a, b: a + b)

    return samples.select(
        TIMESTAMP, ROW, six(F.col("next_step")[0]).alias("next_target"), F.size("sequence").cast("long").alias("steps"),
        F.round(weighted(0), 4).alias("weighted_target"), F.round(weighted(1), 4).alias("weighted_temperature"),
        weighted(3).alias("weighted_hour"))


@query("f14_time_deltas", f"""WITH {grid_sql('event_type')}
SELECT event_type, "Timestamp", CAST(epoch("Timestamp") - epoch(lag("Timestamp") OVER (
  PARTITION BY event_type ORDER BY "Timestamp")) AS DOUBLE) AS delta_seconds FROM grid""")
def f14(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ft.time_deltas(grid(spark, sf_dir, TYPED), TYPED).select("event_type", TIMESTAMP, "delta_seconds")


def _middle_sql(keys: str = "") -> str:
    part = f"PARTITION BY {keys} " if keys else ""
    k = f"{keys}, " if keys else ""
    on = f"USING ({keys})" if keys else "ON TRUE"
    return f"""WITH {readings_sql(keys)},
flagged AS (SELECT {k}row_idx AS center, row_number() OVER ({part}ORDER BY row_idx) - 1 AS r, count(*) OVER ({part}) AS c
            FROM readings WHERE "Anomaly_Label" = 'Abnormal'),
middle AS (SELECT {k}center FROM flagged WHERE r = floor(c / 2))
SELECT {k}"Timestamp", "Electricity_Consumed", "Anomaly_Label" FROM readings JOIN middle {on}
WHERE row_idx >= center - 24 AND row_idx < center + 24"""


@query("f15_around_middle_flag", _middle_sql())
def f15(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = ft.encode_labels(materialize(readings(spark, sf_dir)))
    return ft.around_middle_flag(coded, ONE, "label").select(TIMESTAMP, TARGET, "Anomaly_Label")


@query("f15_around_middle_flag_by_type", _middle_sql("event_type"))
def f15_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = ft.encode_labels(materialize(readings(spark, sf_dir, TYPED)))
    return ft.around_middle_flag(coded, TYPED, "label").select("event_type", TIMESTAMP, TARGET, "Anomaly_Label")


# --- Splits -----------------------------------------------------------------------------------

@query("p1_forecast_split", f"""WITH {readings_sql()}, {split_sql("readings", *FORECAST_SPLIT)}
SELECT "Timestamp", row_idx, split FROM parted""")
def p1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast_split(grid(spark, sf_dir), ONE).select(TIMESTAMP, ROW, "split")


@query("p1_forecast_split_by_type", f"""WITH {readings_sql('event_type')},
{split_sql("readings", *FORECAST_SPLIT, keys="event_type")}
SELECT event_type, "Timestamp", row_idx, split FROM parted""")
def p1_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast_split(grid(spark, sf_dir, TYPED), TYPED).select("event_type", TIMESTAMP, ROW, "split")


EVALUABLE = f"""{features_sql()},
evaluable AS (SELECT * FROM features WHERE rolling_std_24h IS NOT NULL AND "Avg_Past_Consumption" IS NOT NULL)"""


@query("p2_tuning_split", f"""WITH {EVALUABLE}, {split_sql("evaluable", *TUNING_SPLIT)}
SELECT "Timestamp", row_idx, split FROM parted""")
def p2(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mx.evaluable_rows(materialize(ft.base_features(readings(spark, sf_dir), ONE)), ONE)
    return tuning_split(rows, ONE).select(TIMESTAMP, ROW, "split")


@query("p3_sequence_split", f"""WITH {readings_sql('event_type')},
samples AS (SELECT * FROM readings WHERE row_idx >= 24), {split_sql("samples", *FORECAST_SPLIT, keys="event_type")}
SELECT event_type, split, count(*) AS samples, min("Timestamp") AS first_ts, max("Timestamp") AS last_ts
FROM parted GROUP BY 1, 2""")
def p3(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = ft.sequences(ft.add_calendar(grid(spark, sf_dir, TYPED)), TYPED)
    return forecast_split(samples, TYPED).groupBy("event_type", "split").agg(
        F.count(F.lit(1)).alias("samples"), F.min(TIMESTAMP).alias("first_ts"), F.max(TIMESTAMP).alias("last_ts"))


@query("p4_native_test_sizes", f"""WITH {readings_sql()},
lagged AS (SELECT * FROM readings WHERE row_idx >= 48), samples AS (SELECT * FROM readings WHERE row_idx >= 24),
{split_sql("readings", *FORECAST_SPLIT, name="plain")}, {split_sql("lagged", *FORECAST_SPLIT, name="lag_rows")},
{split_sql("samples", *FORECAST_SPLIT, name="windows")}
SELECT 'rows' AS preparation, split, count(*) AS rows FROM plain GROUP BY 2
UNION ALL SELECT 'lags', split, count(*) FROM lag_rows GROUP BY 2
UNION ALL SELECT 'windows', split, count(*) FROM windows GROUP BY 2""")
def p4(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = materialize(with_row_index(ft.add_calendar(grid(spark, sf_dir)), ONE))

    def sizes(df: DataFrame, name: str) -> DataFrame:
        return (forecast_split(df, ONE).groupBy("split").agg(F.count(F.lit(1)).alias("rows"))
                .withColumn("preparation", F.lit(name)))

    return (sizes(rows, "rows").unionByName(sizes(ft.supervised_lags(rows, ONE), "lags"))
            .unionByName(sizes(ft.sequences(rows, ONE), "windows")))


# --- Matrices ---------------------------------------------------------------------------------

MATRIX = ("Electricity_Consumed", "Temperature", "Humidity", "Wind_Speed", "Avg_Past_Consumption", *CALENDAR, *ROLLING)


_AS_DOUBLES = ", ".join(f'round(CAST("{c}" AS DOUBLE), 6) AS "{c}"' for c in MATRIX)


@query("m1_feature_matrix", f"""WITH {EVALUABLE} SELECT "Timestamp", {_AS_DOUBLES} FROM evaluable""")
def m1(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mx.evaluable_rows(ft.base_features(readings(spark, sf_dir), ONE), ONE)
    return rows.select(TIMESTAMP, *[six(F.col(c).cast("double")).alias(c) for c in mx.feature_columns(rows, ONE)])


@query("m2_aligned_context", f"""WITH {EVALUABLE} SELECT "Timestamp", hour, "Electricity_Consumed" FROM evaluable""")
def m2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mx.aligned_context(ft.base_features(readings(spark, sf_dir), ONE), ONE)


def scaled_sql(columns: tuple[str, ...], source: str, fit: str, name: str = "matrix") -> str:
    """``source`` with scaled features and the hourly z-score, fitted where ``fit`` holds."""
    stats = ", ".join(f'avg("{c}") AS "m_{c}", coalesce(nullif(stddev_pop("{c}"), 0), 1) AS "s_{c}"' for c in columns)
    scaled = ", ".join(f'("{c}" - "m_{c}") / "s_{c}" AS "{c}_scaled"' for c in columns)
    return f"""stats AS (SELECT {stats} FROM {source} WHERE {fit}),
hours AS (SELECT hour, avg("Electricity_Consumed") AS hm, coalesce(nullif(stddev_pop("Electricity_Consumed"), 0), 1) AS hs
          FROM {source} WHERE {fit} GROUP BY hour),
{name} AS (SELECT e.*, {scaled}, coalesce(("Electricity_Consumed" - hm) / hs, 0.0) AS hour_zscore
           FROM {source} e CROSS JOIN stats LEFT JOIN hours USING (hour))"""


SCALED = tuple(f"{c}_scaled" for c in MATRIX)
PARTED = f"""{EVALUABLE}, {split_sql("evaluable", *TUNING_SPLIT)}"""


@query("m3_train_scaler", f"""WITH {PARTED}, {scaled_sql(MATRIX, "parted", "split = 'train'")}
SELECT {rounded_sql(SCALED, ('Timestamp', 'split'))} FROM matrix""")
def m3(spark: SparkSession, sf_dir: str) -> DataFrame:
    matrix = mx.model_matrix(ft.base_features(readings(spark, sf_dir), ONE), ONE, scale=True, fit_on="train")
    return rounded(matrix.rows, TIMESTAMP, "split", *SCALED)


@query("m4_hour_zscore", f"""WITH {PARTED}, {scaled_sql(MATRIX, "parted", "split = 'train'")}
SELECT "Timestamp", hour, round(hour_zscore, 6) AS hour_zscore FROM matrix""")
def m4(spark: SparkSession, sf_dir: str) -> DataFrame:
    matrix = mx.model_matrix(ft.base_features(readings(spark, sf_dir), ONE), ONE, scale=True, fit_on="train")
    return rounded(matrix.rows, TIMESTAMP, "hour", "hour_zscore")


_DRY = tuple(c for c in MATRIX if c not in ("Temperature", "Humidity", "Wind_Speed"))


@query("m5_matrix_without_weather", f"""WITH {EVALUABLE}, {scaled_sql(_DRY, "evaluable", "TRUE")}
SELECT {rounded_sql((*(f"{c}_scaled" for c in _DRY), "hour_zscore"), ('Timestamp',))} FROM matrix""")
def m5(spark: SparkSession, sf_dir: str) -> DataFrame:
    matrix = mx.model_matrix(ft.base_features(readings(spark, sf_dir), ONE), ONE, scale=True, drop_weather=True)
    return rounded(matrix.rows, TIMESTAMP, *matrix.inputs)


ENHANCED = (*MATRIX, *CYCLICAL, *DERIVED)


@query("m6_tuning_bundle", f"""WITH {PARTED}, {scaled_sql(ENHANCED, "parted", "split = 'train'")}
SELECT {rounded_sql((*(f"{c}_scaled" for c in ENHANCED), "hour_zscore"), ('Timestamp', 'split'))},
  CASE "Anomaly_Label" WHEN 'Abnormal' THEN 1 ELSE 0 END AS label FROM matrix""")
def m6(spark: SparkSession, sf_dir: str) -> DataFrame:
    bundle = mx.tuning_bundle(ft.enhanced_features(readings(spark, sf_dir), ONE), ONE)
    return rounded(bundle.rows, TIMESTAMP, "split", "label", *bundle.inputs)
