"""A deterministic detector for the catalog: distance to the daily mean in daily deviations.

It stands in for a learned score wherever a query must agree with SQL row by row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.catalog.basics import PARTED
from meterflow.catalog.tables import ONE, readings
from meterflow.operators.features import base_features, encode_labels
from meterflow.operators.matrix import evaluable_rows
from meterflow.operators.splits import tuning_split
from meterflow.operators.thresholds import flag_at
from meterflow.session import materialize
from meterflow.spec import TARGET

CUT_A, CUT_B = 1.5, 2.0


def with_score(df: DataFrame) -> DataFrame:
    score = F.abs(F.col(TARGET) - F.col("rolling_mean_24h")) / F.col("rolling_std_24h")
    return df.withColumn("score", F.round(score, 9))


def ruled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluable rows with label, split, score and two flags."""
    rows = evaluable_rows(materialize(base_features(readings(spark, sf_dir), ONE)), ONE)
    scored = with_score(encode_labels(tuning_split(rows, ONE)))
    return scored.withColumns({"is_anomaly": flag_at("score", CUT_A), "flag_b": flag_at("score", CUT_B)})


RULED = f"""{PARTED},
scored AS (
  SELECT *, round(abs("Electricity_Consumed" - rolling_mean_24h) / rolling_std_24h, 9) AS score,
         CASE "Anomaly_Label" WHEN 'Abnormal' THEN 1 ELSE 0 END AS label FROM parted),
ruled AS (
  SELECT *, CASE WHEN score >= {CUT_A} THEN 1 ELSE 0 END AS is_anomaly,
         CASE WHEN score >= {CUT_B} THEN 1 ELSE 0 END AS flag_b FROM scored)"""

COUNTS = """count(*) FILTER (WHERE label = 0 AND is_anomaly = 0) AS tn,
  count(*) FILTER (WHERE label = 0 AND is_anomaly = 1) AS fp,
  count(*) FILTER (WHERE label = 1 AND is_anomaly = 0) AS fn,
  count(*) FILTER (WHERE label = 1 AND is_anomaly = 1) AS tp"""
RATES = """round(coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0), 6) AS precision,
  round(coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0), 6) AS recall,
  round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0), 6) AS f1"""
