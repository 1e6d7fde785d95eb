"""Queries over exploratory aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.catalog.registry import query
from meterflow.catalog.tables import ONE, grid, grid_sql, readings, readings_sql, six
from meterflow.operators import eda
from meterflow.operators.features import add_day_names
from meterflow.session import materialize
from meterflow.spec import NUMERIC_COLUMNS, READING_COLUMNS, TARGET

_HOURS = f"""{grid_sql()},
hourly AS (SELECT CAST(hour("Timestamp") AS INTEGER) AS hour, avg("Electricity_Consumed") AS mean FROM grid GROUP BY 1)"""


@query("d1_hourly_means", f"WITH {_HOURS} SELECT hour, round(mean, 6) AS mean FROM hourly")
def d1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eda.hourly_means(grid(spark, sf_dir), ONE).withColumn("mean", six("mean"))


@query("d1_peak_hour", f"WITH {_HOURS} SELECT hour, round(mean, 6) AS mean FROM hourly ORDER BY hourly.mean DESC, hour LIMIT 1")
def d1_peak(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eda.peak_hour(grid(spark, sf_dir), ONE).withColumn("mean", six("mean"))


@query("d1_top_hours", f"WITH {_HOURS} SELECT hour, round(mean, 6) AS mean FROM hourly ORDER BY hourly.mean DESC, hour LIMIT 3")
def d1_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eda.hourly_means(grid(spark, sf_dir), ONE, top=3).withColumn("mean", six("mean"))


@query("d2_weekend_means", f"""WITH {grid_sql()}
SELECT round(avg("Electricity_Consumed") FILTER (WHERE isodow("Timestamp") < 6), 6) AS weekday_mean,
  round(avg("Electricity_Consumed") FILTER (WHERE isodow("Timestamp") >= 6), 6) AS weekend_mean FROM grid""")
def d2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eda.weekend_means(grid(spark, sf_dir), ONE).withColumns(
        {c: six(c) for c in ("weekday_mean", "weekend_mean")})


@query("d3_day_of_week_means", f"""WITH {grid_sql()}
SELECT CAST(isodow("Timestamp") - 1 AS INTEGER) AS day_of_week, dayname("Timestamp") AS day_name,
  round(avg("Electricity_Consumed"), 6) AS mean FROM grid GROUP BY 1, 2""")
def d3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eda.day_of_week_means(grid(spark, sf_dir), ONE).withColumn("mean", six("mean"))


def _corr_rows(left: tuple[str, ...]) -> str:
    def value(a: str, b: str) -> str:
        return "1.0::DOUBLE" if a == b else f'(SELECT round(corr("{a}", "{b}"), 6) FROM readings)'

    return " UNION ALL ".join(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {value(a, b)} AS corr"
                              for a in left for b in NUMERIC_COLUMNS)


@query("d4_correlations", f"WITH {readings_sql()} {_corr_rows(NUMERIC_COLUMNS)}")
def d4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eda.correlations(readings(spark, sf_dir)).withColumn("corr", six("corr"))


@query("d4_correlation_with_target", f"""WITH {readings_sql()}, c AS ({_corr_rows((TARGET,))})
SELECT feature_b AS feature, corr FROM c""")
def d4_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eda.correlation_with(readings(spark, sf_dir), TARGET).withColumn("corr", six("corr"))


@query("d5_label_distribution", f"""WITH {readings_sql()},
c AS (SELECT "Anomaly_Label" AS label, count(*) AS rows FROM readings GROUP BY 1)
SELECT label, rows, round(rows * 100.0::DOUBLE / sum(rows) OVER (), 6) AS percent,
  round(rows / (min(rows) OVER ())::DOUBLE, 6) AS ratio_to_rarest FROM c""")
def d5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eda.label_distribution(readings(spark, sf_dir)).withColumns(
        {c: six(c) for c in ("percent", "ratio_to_rarest")})


def _long_sql(features: tuple[str, ...]) -> str:
    return "long AS (" + " UNION ALL ".join(
        f"""SELECT '{f}' AS feature, "{f}" AS v FROM grid WHERE "{f}" IS NOT NULL""" for f in features) + ")"


@query("d6_histograms", f"""WITH {grid_sql()}, {_long_sql(eda.HISTOGRAM_FEATURES)},
b AS (SELECT feature, min(v) AS lo, max(v) AS hi, (max(v) - min(v)) / 30 AS w FROM long GROUP BY 1),
counted AS (SELECT feature, CAST(least(floor((v - lo) / w), 29) AS INTEGER) AS bin, count(*) AS rows
            FROM long JOIN b USING (feature) GROUP BY 1, 2),
bins AS (SELECT feature, CAST(unnest(range(30)) AS INTEGER) AS bin, lo, hi FROM b)
SELECT feature, bin, round(lo + bin * (hi - lo) / 30, 6) AS left_edge, round(lo + (bin + 1) * (hi - lo) / 30, 6) AS right_edge,
  coalesce(rows, 0) AS rows FROM bins LEFT JOIN counted USING (feature, bin)""")
def d6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eda.histograms(materialize(grid(spark, sf_dir))).withColumns(
        {c: six(c) for c in ("left_edge", "right_edge")})


@query("d7_densities", f"""WITH {grid_sql()}, {_long_sql(eda.HISTOGRAM_FEATURES)},
b AS (SELECT feature, min(v) AS lo, (max(v) - min(v)) / 199 AS step, count(*) AS n,
        stddev_samp(v) * pow(count(*), -0.2) AS h FROM long GROUP BY 1),
points AS (SELECT feature, CAST(unnest(range(200)) AS INTEGER) AS point, lo, step, n, h FROM b)
SELECT feature, point, round(any_value(lo + point * step), 6) AS x,
  round(sum(exp(-0.5 * pow((v - (lo + point * step)) / h, 2))) / any_value(n * h * sqrt(2 * pi())), 8) AS density
FROM points JOIN long USING (feature) GROUP BY 1, 2""")
def d7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eda.densities(materialize(grid(spark, sf_dir))).withColumns(
        {"x": six("x"), "density": F.round("density", 8)})


def _box_sql(group: str, name: str) -> str:
    return f"""WITH {grid_sql()},
v AS (SELECT {group} AS {name}, "Electricity_Consumed" AS y FROM grid),
q AS (SELECT {name}, quantile_cont(y, 0.25::DOUBLE) AS q1, quantile_cont(y, 0.5::DOUBLE) AS median,
        quantile_cont(y, 0.75::DOUBLE) AS q3 FROM v GROUP BY 1),
m AS (SELECT *, y BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM v JOIN q USING ({name}))
SELECT {name}, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
  round(min(y) FILTER (WHERE inside), 6) AS whisker_low, round(max(y) FILTER (WHERE inside), 6) AS whisker_high,
  count(*) FILTER (WHERE NOT inside) AS outliers, count(*) AS rows FROM m GROUP BY {name}, q1, median, q3"""


def _boxes(df: DataFrame, group: str) -> DataFrame:
    boxes = eda.box_statistics(add_day_names(df, ONE), group, TARGET)
    return boxes.withColumns({c: six(c) for c in ("q1", "median", "q3", "whisker_low", "whisker_high")})


@query("d8_boxes_by_hour", _box_sql('CAST(hour("Timestamp") AS INTEGER)', "hour"))
def d8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _boxes(grid(spark, sf_dir), "hour")


@query("d8_boxes_by_day", _box_sql('dayname("Timestamp")', "day_name"))
def d8_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _boxes(grid(spark, sf_dir), "day_name")


@query("d11_date_range", f"""WITH {readings_sql()}
SELECT min("Timestamp") AS start_ts, max("Timestamp") AS end_ts, count(*) AS rows,
  CAST(7 * count(*) - ({" + ".join(f'count("{c}")' for c in READING_COLUMNS)}) AS BIGINT) AS total_nulls FROM readings""")
def d11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eda.date_range(readings(spark, sf_dir).select(*READING_COLUMNS), ONE)
