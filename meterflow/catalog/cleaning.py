"""Queries over interpolation, cleaning profiles and artefact comparison."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.catalog.detectors import PLAIN_FOREST, profiles_sql
from meterflow.catalog.registry import query
from meterflow.catalog.rules import CUT_A, CUT_B, with_score
from meterflow.catalog.tables import ONE, TYPED, features_sql, grid, readings, readings_sql, six, split_sql
from meterflow.operators.clean import compare_artefacts, interpolate_flagged
from meterflow.operators.features import base_features
from meterflow.operators.metrics import flag_counts
from meterflow.operators.ordering import with_row_index
from meterflow.operators.thresholds import flag_at
from meterflow.plans import cleaning as plan
from meterflow.plans.detection import PROFILES
from meterflow.plans.forecasting import detect_clean_forecast, ladder_from_artefact, run_job
from meterflow.plans.ledger import StageLedger
from meterflow.session import materialize, scratch_path
from meterflow.sources.readings import read_clean
from meterflow.sources.sinks import write_clean
from meterflow.spec import FORECAST_SPLIT, READING_COLUMNS, ROW, ROWS, TARGET, TIMESTAMP


def fill_sql(source: str, flag: str, name: str, keys: str = "") -> str:
    """``source`` with the target masked where ``flag`` and filled in elapsed time, as column y_clean."""
    part = f"PARTITION BY {keys} " if keys else ""

    def known(fn: str, what: str, side: str) -> str:
        return f"{fn}({what} IGNORE NULLS) OVER ({part}ORDER BY \"Timestamp\" {side})"

    back = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    ahead = "ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING"
    return f"""{name}_m AS (
  SELECT *, CASE WHEN {flag} THEN NULL ELSE "Electricity_Consumed" END AS y, epoch("Timestamp") AS t,
         bool_or({flag}) OVER ({part}) AS any_flag FROM {source}),
{name}_k AS (
  SELECT *, CASE WHEN y IS NOT NULL THEN t END AS tk FROM {name}_m),
{name}_n AS (
  SELECT *, {known("last_value", "y", back)} AS y0, {known("last_value", "tk", back)} AS t0,
         {known("first_value", "y", ahead)} AS y1, {known("first_value", "tk", ahead)} AS t1 FROM {name}_k),
{name} AS (
  SELECT *, CASE WHEN NOT any_flag THEN "Electricity_Consumed"
                 ELSE coalesce(y, y0 + (y1 - y0) * ((t - t0) / nullif(t1 - t0, 0)), y0) END AS y_clean FROM {name}_n)"""


_RULE = f"""{features_sql()},
scored AS (SELECT *, round(abs("Electricity_Consumed" - rolling_mean_24h) / rolling_std_24h, 9) AS score FROM features)"""


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(with_score(base_features(readings(spark, sf_dir), ONE)))


@query("c1_interpolate", f"""WITH {_RULE}, {fill_sql("scored", f"coalesce(score >= {CUT_A}, FALSE)", "clean")}
SELECT "Timestamp", round(y_clean, 9) AS "Electricity_Consumed", "Wind_Speed" FROM clean""")
def c1(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = _scored(spark, sf_dir).withColumn("is_anomaly", flag_at("score", CUT_A))
    return interpolate_flagged(flagged, ONE).select(TIMESTAMP, F.round(TARGET, 9).alias(TARGET), "Wind_Speed")


_EDGES = "(row_idx % 7 < 3 OR row_idx >= series_rows - 5) AND event_type <> 'signup'"


@query("c1_interpolate_edges_by_type", f"""WITH {readings_sql('event_type')},
{fill_sql("readings", _EDGES, "clean", "event_type")}
SELECT event_type, "Timestamp", round(y_clean, 9) AS "Electricity_Consumed" FROM clean""")
def c1_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The first and last rows of each series are masked; one series has no flag and stays as it is.
    rows = materialize(with_row_index(grid(spark, sf_dir, TYPED), TYPED))
    masked = ((F.col(ROW) % 7 < 3) | (F.col(ROW) >= F.col(ROWS) - 5)) & (F.col("event_type") != "signup")
    filled = interpolate_flagged(rows.withColumn("is_anomaly", masked.cast("int")), TYPED)
    return filled.select("event_type", TIMESTAMP, F.round(TARGET, 9).alias(TARGET))


@query("c1_imputed_counts", f"""WITH {_RULE}, {fill_sql("scored", f"coalesce(score >= {CUT_A}, FALSE)", "clean")}
SELECT count(score) AS scored, count(*) FILTER (WHERE score >= {CUT_A}) AS flagged,
  count(*) FILTER (WHERE "Electricity_Consumed" IS DISTINCT FROM y_clean) AS changed FROM clean""")
def c1_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = _scored(spark, sf_dir).withColumn("is_anomaly", flag_at("score", CUT_A))
    return flag_counts(interpolate_flagged(flagged, ONE, out="y_clean"), before=TARGET, after="y_clean")


_PAIR = f"""{_RULE},
{fill_sql("scored", f"coalesce(score >= {CUT_A}, FALSE)", "clean_a")},
{fill_sql("scored", f"coalesce(score >= {CUT_B}, FALSE)", "clean_b")},
marked AS (
  SELECT a.hour, a.y_clean AS ya, b.y_clean AS yb,
         r."Electricity_Consumed" IS DISTINCT FROM a.y_clean AS ia, r."Electricity_Consumed" IS DISTINCT FROM b.y_clean AS ib
  FROM features r JOIN clean_a a USING ("Timestamp") JOIN clean_b b USING ("Timestamp")),
worst AS (SELECT hour, count(*) AS d FROM marked WHERE ia <> ib GROUP BY hour ORDER BY d DESC, hour LIMIT 1)"""


@query("c3_compare_artefacts", f"""WITH {_PAIR}
SELECT 'loose vs strict' AS pair, count(*) FILTER (WHERE ia) AS imputed_rows_a, count(*) FILTER (WHERE ib) AS imputed_rows_b,
  count(*) FILTER (WHERE ia <> ib) AS disagree_rows,
  round(count(*) FILTER (WHERE ia AND ib) / greatest(count(*) FILTER (WHERE ia OR ib), 1)::DOUBLE, 6) AS jaccard_imputed,
  round(coalesce(max(abs(ya - yb)) FILTER (WHERE ia AND ib), 0), 6) AS max_abs_diff_imputed,
  round(coalesce(avg(abs(ya - yb)) FILTER (WHERE ia AND ib), 0), 6) AS mean_abs_diff_imputed,
  (SELECT count(*) FROM features) - count(*) AS unmatched_rows,
  coalesce((SELECT hour FROM worst), -1) AS top_disagree_hour,
  coalesce((SELECT d FROM worst), 0) AS top_disagree_hour_count
FROM marked""")
def c3(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _scored(spark, sf_dir)
    a = interpolate_flagged(scored.withColumn("is_anomaly", flag_at("score", CUT_A)), ONE)
    b = interpolate_flagged(scored.withColumn("is_anomaly", flag_at("score", CUT_B)), ONE)
    pair = compare_artefacts(scored, a, b, ONE, "loose", "strict")
    return pair.withColumns({c: six(c) for c in ("jaccard_imputed", "max_abs_diff_imputed", "mean_abs_diff_imputed")})


def _cleaned_sql(profile: str, name: str) -> str:
    joined = f'{name}_f AS (SELECT f.*, coalesce({profile} = 1, FALSE) AS bad FROM features f LEFT JOIN profiles USING ("Timestamp"))'
    return f"""{joined}, {fill_sql(f"{name}_f", "bad", name)}"""


_LEGACY = f"""{PLAIN_FOREST}, profiles AS (SELECT "Timestamp", forest_flag AS legacy FROM flagged), {_cleaned_sql("legacy", "clean")}"""


@query("c2_legacy_profile", f"""WITH {_LEGACY} SELECT "Timestamp", round(y_clean, 6) AS "Electricity_Consumed", hour FROM clean""")
def c2(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = plan.clean_readings(readings(spark, sf_dir), ONE, "legacy")
    return clean.select(TIMESTAMP, six(TARGET).alias(TARGET), "hour")


@query("c2_clean_job_untouched_columns", f"""WITH {features_sql()}
SELECT "Timestamp", "Temperature", "Humidity", "Wind_Speed", "Avg_Past_Consumption", "Anomaly_Label", hour,
  round(rolling_mean_24h, 6) AS rolling_mean_24h, FALSE AS target_missing FROM features""")
def c2_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job from CSV to Parquet: every row kept, only the target changed, none missing."""
    raw = write_clean(readings(spark, sf_dir).select(*READING_COLUMNS), scratch_path(spark, "raw"), file_format="csv")
    path = plan.build_clean_artefact(spark, raw, scratch_path(spark, "artefact"), ONE)
    return read_clean(spark, path).select(
        TIMESTAMP, "Temperature", "Humidity", "Wind_Speed", "Avg_Past_Consumption", "Anomaly_Label", "hour",
        six("rolling_mean_24h").alias("rolling_mean_24h"), F.col(TARGET).isNull().alias("target_missing"))


def _compared_sql(a: str, b: str) -> str:
    n = f"{a}_{b}"
    return f"""{n}_m AS (SELECT r.hour, x.y_clean AS ya, y.y_clean AS yb, r."Electricity_Consumed" IS DISTINCT FROM x.y_clean AS ia,
    r."Electricity_Consumed" IS DISTINCT FROM y.y_clean AS ib
  FROM features r JOIN clean_{a} x USING ("Timestamp") JOIN clean_{b} y USING ("Timestamp")),
{n}_w AS (SELECT hour, count(*) AS d FROM {n}_m WHERE ia <> ib GROUP BY hour ORDER BY d DESC, hour LIMIT 1),
{n} AS (SELECT '{a} vs {b}' AS pair, count(*) FILTER (WHERE ia) AS imputed_rows_a, count(*) FILTER (WHERE ib) AS imputed_rows_b,
  count(*) FILTER (WHERE ia <> ib) AS disagree_rows,
  round(count(*) FILTER (WHERE ia AND ib) / greatest(count(*) FILTER (WHERE ia OR ib), 1)::DOUBLE, 6) AS jaccard_imputed,
  round(coalesce(max(abs(ya - yb)) FILTER (WHERE ia AND ib), 0), 6) AS max_abs_diff_imputed,
  round(coalesce(avg(abs(ya - yb)) FILTER (WHERE ia AND ib), 0), 6) AS mean_abs_diff_imputed,
  (SELECT count(*) FROM features) - count(*) AS unmatched_rows,
  coalesce((SELECT hour FROM {n}_w), -1) AS top_disagree_hour, coalesce((SELECT d FROM {n}_w), 0) AS top_disagree_hour_count FROM {n}_m)"""


_PAIRS = list(combinations(PROFILES, 2))


@query("x2_profile_comparison", f"""WITH {profiles_sql()}, {", ".join(_cleaned_sql(p, f"clean_{p}") for p in PROFILES)},
{", ".join(_compared_sql(a, b) for a, b in _PAIRS)} {" UNION ALL ".join(f"SELECT * FROM {a}_{b}" for a, b in _PAIRS)}""")
def x2(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = plan.compare_profiles(materialize(readings(spark, sf_dir)), ONE)
    return pairs.withColumns({c: six(c) for c in ("jaccard_imputed", "max_abs_diff_imputed", "mean_abs_diff_imputed")})


_NAIVE_AFTER_CLEANING = f"""{_LEGACY}, cleaned AS (SELECT * REPLACE (y_clean AS "Electricity_Consumed") FROM clean),
{split_sql("cleaned", *FORECAST_SPLIT, name="dealt")},
near AS (SELECT "Timestamp", split, "Electricity_Consumed" AS y_true, lag("Electricity_Consumed", 48) OVER (ORDER BY "Timestamp") AS y_pred
  FROM dealt WHERE split <> 'val'), tested AS (SELECT * FROM near WHERE split = 'test')"""
_SCORES = """round(avg(abs(y_true - y_pred)), 6) AS mae, round(sqrt(avg((y_true - y_pred) ** 2)), 6) AS rmse,
  round(avg(abs(y_true - y_pred) / greatest(abs(y_true), 1e-8)) * 100, 6) AS mape"""


@query("x1_detect_clean_forecast", f"""WITH {_NAIVE_AFTER_CLEANING}
SELECT "Timestamp", round(y_true, 6) AS y_true, round(y_pred, 6) AS y_pred FROM tested""")
def x1(spark: SparkSession, sf_dir: str) -> DataFrame:
    predictions = detect_clean_forecast(readings(spark, sf_dir), ONE, "naive")
    return predictions.withColumns({"y_true": six("y_true"), "y_pred": six("y_pred")})


@query("x1_job_from_files", f"""WITH {_NAIVE_AFTER_CLEANING} SELECT 'naive' AS model, count(*) AS rows, {_SCORES} FROM tested""")
def x1_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings file to predictions file through a ledger of stages, of which the second run finds all finished."""
    raw = write_clean(readings(spark, sf_dir).select(*READING_COLUMNS), scratch_path(spark, "raw"), file_format="csv")
    folder = scratch_path(spark, "ledger")
    run_job(spark, raw, scratch_path(spark, "first"), spec=ONE, ledger=StageLedger(spark, folder))
    card = run_job(spark, raw, scratch_path(spark, "predictions"), spec=ONE, ledger=StageLedger(spark, folder))
    return card.withColumns({c: six(c) for c in ("mae", "rmse", "mape")})


@query("x3_ladder_from_artefact", f"""WITH {_NAIVE_AFTER_CLEANING}
SELECT 'naive' AS model, count(*) AS rows, {_SCORES}, FALSE AS judged FROM tested""")
def x3_artefact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The floor of the ladder, from a clean artefact on disk; it is not judged against itself."""
    raw = write_clean(readings(spark, sf_dir).select(*READING_COLUMNS), scratch_path(spark, "raw"), file_format="csv")
    path = plan.build_clean_artefact(spark, raw, scratch_path(spark, "artefact"), ONE)
    cards = ladder_from_artefact(spark, path, ONE, models=("naive",))
    return cards.select("model", "rows", *(six(c).alias(c) for c in ("mae", "rmse", "mape")), F.col("beats_floor").isNotNull().alias("judged"))
