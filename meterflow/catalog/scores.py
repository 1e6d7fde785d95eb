"""Queries over forecast and detector metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.catalog.basics import rounded
from meterflow.catalog.forecasts import NAIVE, naive_predictions
from meterflow.catalog.registry import query
from meterflow.catalog.rules import COUNTS, RATES, RULED, ruled
from meterflow.catalog.tables import six
from meterflow.operators import metrics as mt
from meterflow.operators.thresholds import flag_at
from meterflow.session import materialize

RATE_COLUMNS = ("precision", "recall", "f1")


def with_rounded_rates(df: DataFrame, *more: str) -> DataFrame:
    return df.withColumns({c: six(c) for c in (*RATE_COLUMNS, *more)})


_CARD = """count(*) AS rows, avg(abs(y_true - y_pred)) AS mae, sqrt(avg((y_true - y_pred) * (y_true - y_pred))) AS rmse,
  avg(abs(y_true - y_pred) / greatest(abs(y_true), 1e-8)) * 100 AS mape"""
_CARDS = f"{NAIVE}, cards AS (SELECT model, {_CARD} FROM predictions GROUP BY model)"


@query("e1_mae", f"WITH {NAIVE} SELECT model, round(avg(abs(y_true - y_pred)), 6) AS mae FROM predictions GROUP BY 1")
def e1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return naive_predictions(spark, sf_dir).groupBy("model").agg(six(mt.mae()).alias("mae"))


@query("e2_rmse", f"""WITH {NAIVE}
SELECT model, round(sqrt(avg((y_true - y_pred) ** 2)), 6) AS rmse FROM predictions GROUP BY 1""")
def e2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return naive_predictions(spark, sf_dir).groupBy("model").agg(six(mt.rmse()).alias("rmse"))


@query("e3_mape", f"""WITH {NAIVE}
SELECT model, round(avg(abs(y_true - y_pred) / greatest(abs(y_true), 1e-8)) * 100, 6) AS mape
FROM predictions GROUP BY 1""")
def e3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return naive_predictions(spark, sf_dir).groupBy("model").agg(six(mt.mape()).alias("mape"))


@query("e4_forecast_scorecard", f"""WITH {_CARDS}
SELECT model, rows, round(mae, 6) AS mae, round(rmse, 6) AS rmse, round(mape, 6) AS mape FROM cards""")
def e4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(mt.forecast_scorecard(naive_predictions(spark, sf_dir)), "model", "rows", "mae", "rmse", "mape")


@query("e5_compare_to_floor", f"""WITH {_CARDS}, f AS (SELECT mae AS fm, rmse AS fr FROM cards WHERE model = 'naive')
SELECT model, round(mae, 6) AS mae, round(rmse, 6) AS rmse,
  CASE WHEN mae < fm THEN 'beats' WHEN mae > fm THEN 'above' ELSE 'matches' END AS mae_vs_floor,
  CASE WHEN rmse < fr THEN 'beats' WHEN rmse > fr THEN 'above' ELSE 'matches' END AS rmse_vs_floor,
  mae < fm AND rmse < fr AS beats_floor FROM cards, f WHERE model <> 'naive'""")
def e5(spark: SparkSession, sf_dir: str) -> DataFrame:
    cards = materialize(mt.forecast_scorecard(naive_predictions(spark, sf_dir)))
    return mt.compare_to_floor(cards).withColumns({"mae": six("mae"), "rmse": six("rmse")})


@query("e6_detection_metrics", f"WITH {RULED}, c AS (SELECT {COUNTS} FROM ruled) SELECT tn, fp, fn, tp, {RATES} FROM c")
def e6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_rounded_rates(mt.detection_scorecard(ruled(spark, sf_dir)))


@query("e7_metrics_by_split", f"""WITH {RULED}, c AS (SELECT split, {COUNTS} FROM ruled GROUP BY split)
SELECT split, tn, fp, fn, tp, {RATES} FROM c""")
def e7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_rounded_rates(mt.detection_scorecard(ruled(spark, sf_dir), ["split"]))


_HOURLY = f"""{RULED}, c AS (SELECT hour, {COUNTS}, count(*) AS n FROM ruled WHERE split = 'test' GROUP BY hour)"""


@query("e8_confusion_by_hour", f"WITH {_HOURLY} SELECT hour, tn, fp, fn, tp, n FROM c")
def e8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mt.confusion_by_hour(ruled(spark, sf_dir))


@query("e9_false_positives_by_hour", f"""WITH {_HOURLY}
SELECT hour, fp, tn + fp AS normal_rows, round(fp / nullif(tn + fp, 0)::DOUBLE, 6) AS fp_rate, fn, tp, n FROM c""")
def e9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mt.false_positives_by_hour(ruled(spark, sf_dir)).withColumn("fp_rate", six("fp_rate"))


@query("e10_top_false_positive_hours", f"""WITH {_HOURLY}
SELECT hour, fp, tn + fp AS normal_rows, round(fp / nullif(tn + fp, 0)::DOUBLE, 6) AS fp_rate, fn, tp, n
FROM c ORDER BY fp DESC, hour LIMIT 5""")
def e10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mt.top_false_positive_hours(ruled(spark, sf_dir)).withColumn("fp_rate", six("fp_rate"))


@query("e11_segment_table", f"""WITH {RULED},
test AS (SELECT * FROM ruled WHERE split = 'test'),
overall AS (SELECT {COUNTS} FROM test),
seg AS (
  SELECT 'hour' AS segmentation, CAST(hour AS VARCHAR) AS segment, {COUNTS}, count(*) AS n FROM test GROUP BY 2
  UNION ALL
  SELECT 'day_kind', CASE WHEN is_weekend = 0 THEN 'weekday' ELSE 'weekend' END, {COUNTS}, count(*) FROM test GROUP BY 2)
SELECT segmentation, segment, n, {RATES}, fp, fn,
  coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0)
    < (SELECT coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0) FROM overall) AS flag_low_recall
FROM seg WHERE n >= 10""")
def e11(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The small table has about a dozen test rows per hour, hence a lower bound than the usual 30.
    return with_rounded_rates(mt.segment_table(materialize(ruled(spark, sf_dir)), min_rows=10))


@query("e12_detector_board", f"""WITH {RULED},
board AS (
  SELECT 'rule 1.5, all rows' AS detector, label, is_anomaly FROM ruled
  UNION ALL SELECT 'rule 1.5, test', label, is_anomaly FROM ruled WHERE split = 'test'
  UNION ALL SELECT 'rule 2.0, test', label, flag_b FROM ruled WHERE split = 'test'),
c AS (SELECT detector, {COUNTS} FROM board GROUP BY 1)
SELECT detector, tn, fp, fn, tp, {RATES} FROM c""")
def e12(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = materialize(ruled(spark, sf_dir))
    test = rows.where(F.col("split") == "test")

    def part(df: DataFrame, name: str, flag: str) -> DataFrame:
        return df.select(F.lit(name).alias("detector"), "label", F.col(flag).alias("is_anomaly"))

    board = (part(rows, "rule 1.5, all rows", "is_anomaly").unionByName(part(test, "rule 1.5, test", "is_anomaly"))
             .unionByName(part(test, "rule 2.0, test", "flag_b")))
    return with_rounded_rates(mt.detection_scorecard(board, ["detector"]))


@query("e14_flag_counts", f"""WITH {RULED}
SELECT count(is_anomaly) AS scored, CAST(sum(is_anomaly) AS BIGINT) AS flagged FROM ruled""")
def e14(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mt.flag_counts(ruled(spark, sf_dir).withColumn("is_anomaly", flag_at("score", 1.5)))
