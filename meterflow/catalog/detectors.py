"""Queries over detectors, thresholds, ensembles and detector studies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.catalog.basics import CALENDAR, CYCLICAL, DERIVED, ENHANCED, EVALUABLE, MATRIX, PARTED, ROLLING, scaled_sql
from meterflow.catalog.forests import forest_sql, shifted_sql
from meterflow.catalog.registry import query
from meterflow.catalog.rules import COUNTS, CUT_A, RATES, RULED, ruled
from meterflow.catalog.scores import with_rounded_rates
from meterflow.catalog.tables import ONE, TYPED, features_sql, readings, six, table
from meterflow.operators import thresholds as th
from meterflow.operators.density import density_noise
from meterflow.operators.features import base_features, enhanced_features
from meterflow.operators.forest import contamination_offset, fit_forest
from meterflow.operators.matrix import model_matrix, tuning_bundle
from meterflow.operators.metrics import flag_counts, segment_table
from meterflow.plans import detection as dt
from meterflow.plans import studies
from meterflow.session import materialize
from meterflow.spec import NUMERIC_COLUMNS, TIMESTAMP

SCALED_INPUTS = (*(f"{c}_scaled" for c in MATRIX), "hour_zscore")


# --- Forest -----------------------------------------------------------------------------------

def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(base_features(readings(spark, sf_dir), ONE))


def enhanced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(enhanced_features(readings(spark, sf_dir), ONE))


STAMP = 'CAST("Timestamp" AS VARCHAR)'
PLAIN_FOREST = f"""{EVALUABLE}, {forest_sql("grown", "evaluable", STAMP, MATRIX)}, {shifted_sql("grown", 0.05, "flagged")}"""


@query("a1_isolation_forest", f"""WITH {PLAIN_FOREST} SELECT "Timestamp", round(score, 9) AS score, forest_flag AS is_anomaly FROM flagged""")
def a1(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = dt.detect_forest(base(spark, sf_dir), ONE)
    return flagged.select(TIMESTAMP, F.round("score", 9).alias("score"), "is_anomaly")


_TYPED_ROWS = """evaluable AS (SELECT * FROM features WHERE rolling_std_24h IS NOT NULL AND "Avg_Past_Consumption" IS NOT NULL)"""


@query("a1_isolation_forest_by_type", f"""WITH {features_sql("event_type")}, {_TYPED_ROWS},
{forest_sql("grown", "evaluable", f"event_type || '|' || {STAMP}", MATRIX)}, {shifted_sql("grown", 0.05, "flagged")}
SELECT event_type, "Timestamp", round(score, 9) AS score, forest_flag AS is_anomaly FROM flagged""")
def a1_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One forest over all series, each with its own window features."""
    flagged = dt.detect_forest(materialize(base_features(readings(spark, sf_dir, TYPED), TYPED)), TYPED)
    return flagged.select("event_type", TIMESTAMP, F.round("score", 9).alias("score"), "is_anomaly")


_TRAIN_SCALED = f"""{PARTED}, {scaled_sql(MATRIX, "parted", "split = 'train'")}"""


@query("a2_forest_scored_rows", f"""WITH {_TRAIN_SCALED}, {forest_sql("grown", "matrix", STAMP, SCALED_INPUTS, fit="split = 'train'")},
{shifted_sql("grown", 0.05, "flagged")} SELECT "Timestamp", split, round(raw, 9) AS raw, round(score, 9) AS score FROM flagged""")
def a2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all rows by a forest of the train rows, plain and shifted by the train rows' cut-off."""
    matrix = model_matrix(base(spark, sf_dir), ONE, scale=True, fit_on="train")
    train = matrix.rows.where(F.col("split") == "train")
    scored = materialize(fit_forest(train, matrix.inputs, [TIMESTAMP]).score(matrix.rows, "raw"))
    offset = contamination_offset(scored.where(F.col("split") == "train"), "raw", 0.05)
    return scored.select(TIMESTAMP, "split", F.round("raw", 9).alias("raw"), F.round(F.round(F.col("raw") - offset, 12), 9).alias("score"))


@query("a3_contamination_count", f"""WITH {PLAIN_FOREST} SELECT count(*) AS scored, sum(forest_flag)::BIGINT AS flagged FROM flagged""")
def a3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contamination cut-off flags the rows above the 95th percentile, strictly."""
    return flag_counts(dt.detect_forest(base(spark, sf_dir), ONE))


# --- Scores -----------------------------------------------------------------------------------

@query("a4_threshold_flags", f"""WITH {RULED} SELECT "Timestamp", score, is_anomaly FROM ruled""")
def a4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ruled(spark, sf_dir).select(TIMESTAMP, "score", th.flag_at("score", CUT_A).alias("is_anomaly"))


@query("a7_min_max_scores", f"""WITH {RULED}, b AS (SELECT min(score) AS lo, max(score) AS hi FROM ruled)
SELECT "Timestamp", round(CASE WHEN hi = lo THEN 0 ELSE (score - lo) / (hi - lo) END, 6) AS score_norm FROM ruled, b""")
def a7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return th.min_max(materialize(ruled(spark, sf_dir)), "score").select(TIMESTAMP, six("score_norm").alias("score_norm"))


_QUANTILES = ", ".join(repr(0.01 + i * (0.98 / 99)) + "::DOUBLE" for i in range(100))
_CURVE = f"""curve AS (
  SELECT threshold, count(*) FILTER (WHERE label = 0 AND score < threshold) AS tn,
    count(*) FILTER (WHERE label = 0 AND score >= threshold) AS fp,
    count(*) FILTER (WHERE label = 1 AND score < threshold) AS fn,
    count(*) FILTER (WHERE label = 1 AND score >= threshold) AS tp
  FROM validation CROSS JOIN candidates GROUP BY threshold)"""


@query("a8_best_threshold", f"""WITH {RULED},
validation AS (SELECT score, label FROM ruled WHERE split = 'val'),
spread AS (SELECT unnest(quantile_cont(score, [{_QUANTILES}])) AS threshold FROM validation),
candidates AS (
  SELECT DISTINCT threshold FROM (
    SELECT threshold FROM spread WHERE (SELECT count(DISTINCT score) FROM validation) > 100
    UNION ALL SELECT score FROM validation WHERE (SELECT count(DISTINCT score) FROM validation) <= 100)),
{_CURVE}
SELECT round(threshold, 6) AS threshold, tn, fp, fn, tp, {RATES} FROM curve
ORDER BY coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0) DESC, curve.threshold LIMIT 1""")
def a8(spark: SparkSession, sf_dir: str) -> DataFrame:
    validation = materialize(ruled(spark, sf_dir).where(F.col("split") == "val"))
    return with_rounded_rates(th.best_threshold(validation, "score")).withColumn("threshold", six("threshold"))


@query("a8_threshold_curve", f"""WITH {RULED},
validation AS (SELECT score, label FROM ruled),
candidates AS (SELECT unnest([0.5, 1.0, 1.5, 2.0, 2.5, 3.0]::DOUBLE[]) AS threshold),
{_CURVE}
SELECT threshold, tn, fp, fn, tp, {RATES} FROM curve""")
def a8_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_rounded_rates(th.threshold_curve(ruled(spark, sf_dir), "score", [0.5, 1.0, 1.5, 2.0, 2.5, 3.0]))


# --- Density ----------------------------------------------------------------------------------

def noise_sql(source: str, key: str, inputs: tuple[str, ...], eps: float, least: int, metric: str, name: str = "noise") -> str:
    """Brute force noise flags over all pairs, as table ``name``."""
    if metric == "euclidean":
        gap = "sqrt(" + " + ".join(f'pow(a."{c}" - b."{c}", 2)' for c in inputs) + ")"
    else:
        gap = " + ".join(f'abs(a."{c}" - b."{c}")' for c in inputs)
    return f"""{name}_near AS MATERIALIZED (SELECT a.{key} AS i, b.{key} AS j FROM {source} a JOIN {source} b ON {gap} <= {eps}),
{name}_core AS (SELECT i FROM {name}_near GROUP BY i HAVING count(*) >= {least}),
{name}_reached AS (SELECT DISTINCT i FROM {name}_near WHERE j IN (SELECT i FROM {name}_core)),
{name} AS (SELECT s.{key}, CASE WHEN s.{key} IN (SELECT i FROM {name}_reached) THEN 0 ELSE 1 END AS density_flag FROM {source} s)"""


def _density(spark: SparkSession, sf_dir: str, eps: float, least: int, metric: str) -> DataFrame:
    config = dt.DensityConfig(eps=eps, min_samples=least, metric=metric, scale=True, fit_on="train")
    return dt.detect_density(base(spark, sf_dir), ONE, config).select(TIMESTAMP, F.col("is_anomaly").alias("density_flag"))


@query("a5_density_euclidean", f"""WITH {_TRAIN_SCALED}, {noise_sql("matrix", '"Timestamp"', SCALED_INPUTS, 2.0, 5, "euclidean")}
SELECT "Timestamp", density_flag FROM noise""")
def a5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _density(spark, sf_dir, 2.0, 5, "euclidean")


@query("a5_density_manhattan", f"""WITH {_TRAIN_SCALED}, {noise_sql("matrix", '"Timestamp"', SCALED_INPUTS, 6.0, 10, "manhattan")}
SELECT "Timestamp", density_flag FROM noise""")
def a5_manhattan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _density(spark, sf_dir, 6.0, 10, "manhattan")


_ORDER_POINTS = """points AS (
  SELECT o_orderkey, o_totalprice / 1000.0 AS price, CAST(day(o_orderdate) AS DOUBLE) AS day FROM orders)"""


@query("a5_density_orders", f"""WITH {_ORDER_POINTS}, {noise_sql("points", "o_orderkey", ("price", "day"), 1.0, 8, "euclidean")}
SELECT o_orderkey, density_flag FROM noise""")
def a5_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two dimensions and many rows: here most points are settled by their own cell."""
    points = table(spark, sf_dir, "orders").select(
        "o_orderkey", (F.col("o_totalprice") / 1000.0).alias("price"), F.dayofmonth("o_orderdate").cast("double").alias("day"))
    return density_noise(points, ["price", "day"], 1.0, 8, out="density_flag").select("o_orderkey", "density_flag")


# --- Ensembles and routing --------------------------------------------------------------------

@query("a6_ensembles", f"""WITH {RULED}, {scaled_sql(MATRIX, "ruled", "split = 'train'")},
{noise_sql("matrix", '"Timestamp"', SCALED_INPUTS, 2.0, 5, "euclidean")},
b AS (SELECT min(score) AS lo, max(score) AS hi FROM ruled)
SELECT "Timestamp", greatest(is_anomaly, density_flag) AS union_flag, least(is_anomaly, density_flag) AS both_flag,
  CASE WHEN 0.7 * ((score - lo) / (hi - lo)) + 0.3 * density_flag >= 0.5 THEN 1 ELSE 0 END AS weighted_flag
FROM ruled JOIN noise USING ("Timestamp"), b""")
def a6(spark: SparkSession, sf_dir: str) -> DataFrame:
    matrix = model_matrix(base(spark, sf_dir), ONE, scale=True, fit_on="train")
    noise = density_noise(matrix.rows, matrix.inputs, 2.0, 5, out="density_flag").select(TIMESTAMP, "density_flag")
    both = th.min_max(materialize(ruled(spark, sf_dir)), "score").join(noise, TIMESTAMP)
    return both.select(TIMESTAMP, *[
        th.ensemble_flag(s, "is_anomaly", "density_flag", "score_norm").alias(name)
        for s, name in (("union", "union_flag"), ("intersection", "both_flag"), ("weighted", "weighted_flag"))])


@query("a9_routed_density", f"""WITH {EVALUABLE}, {noise_sql("evaluable", '"Timestamp"', MATRIX, 25.0, 5, "euclidean")}
SELECT "Timestamp", density_flag FROM noise""")
def a9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw readings in: the router builds the features because ``hour`` is missing."""
    found = dt.detect(materialize(readings(spark, sf_dir)), ONE, "dbscan", config=dt.DensityConfig(eps=25.0))
    return found.select(TIMESTAMP, F.col("is_anomaly").alias("density_flag"))


#: In the order of the feature table, which numbers the forest's predictors.
ENHANCED_INPUTS = (*(f"{c}_scaled" for c in (*NUMERIC_COLUMNS, *CALENDAR, *CYCLICAL, *ROLLING, *DERIVED)), "hour_zscore")
_TAG = "CASE \"Anomaly_Label\" WHEN 'Abnormal' THEN 1 ELSE 0 END AS label"


def best_cut_sql(name: str, source: str) -> str:
    """``{name}``: the lowest candidate threshold with the best F1 on the validation rows of ``source``."""
    return f"""{name}_v AS MATERIALIZED (SELECT score, label FROM {source} WHERE split = 'val'),
{name}_n AS (SELECT count(DISTINCT score) AS n FROM {name}_v),
{name}_c AS (SELECT DISTINCT threshold FROM (
  SELECT unnest(q) AS threshold FROM (SELECT quantile_cont(score, [{_QUANTILES}]) AS q FROM {name}_v), {name}_n WHERE n > 100
  UNION ALL SELECT score FROM {name}_v, {name}_n WHERE n <= 100)),
{name}_f AS (SELECT threshold, count(*) FILTER (WHERE label = 1 AND score >= threshold) AS tp,
  count(*) FILTER (WHERE (label = 1) <> (score >= threshold)) AS e FROM {name}_v, {name}_c GROUP BY threshold),
{name} AS MATERIALIZED (SELECT threshold FROM {name}_f ORDER BY coalesce(2 * tp / nullif(2 * tp + e, 0)::DOUBLE, 0) DESC, threshold LIMIT 1)"""


_ALL_SCALED = f"""{PARTED}, {scaled_sql(ENHANCED, "parted", "TRUE")}, tagged AS MATERIALIZED (SELECT *, {_TAG} FROM matrix)"""
TUNED_ROWS = f"""{PARTED}, {scaled_sql(ENHANCED, "parted", "split = 'train'")}, tagged AS MATERIALIZED (SELECT *, {_TAG} FROM matrix),
{forest_sql("tuned_forest", "tagged", STAMP, ENHANCED_INPUTS, trees=200, max_features=0.6, fit="split = 'train'")},
{shifted_sql("tuned_forest", 0.03, "tuned_scores")}, {best_cut_sql("tuned_cut", "tuned_scores")},
tuned AS MATERIALIZED (SELECT * EXCLUDE (forest_flag), CASE WHEN score >= threshold THEN 1 ELSE 0 END AS forest_flag FROM tuned_scores, tuned_cut)"""
_TUNED_BOTH = f"""{TUNED_ROWS}, {noise_sql("tagged", '"Timestamp"', ENHANCED_INPUTS, 10.0, 10, "manhattan")},
span AS (SELECT min(score) AS lo, max(score) AS hi FROM tuned),
flagged AS MATERIALIZED (SELECT tuned.*, density_flag, CASE WHEN hi = lo THEN 0 ELSE (score - lo) / (hi - lo) END AS score_norm
  FROM tuned JOIN noise USING ("Timestamp"), span)"""


@query("a9_routed_ensemble", f"""WITH {_ALL_SCALED}, {forest_sql("grown", "tagged", STAMP, ENHANCED_INPUTS)}, {shifted_sql("grown", 0.05, "flagged")},
{noise_sql("tagged", '"Timestamp"', ENHANCED_INPUTS, 3.0, 5, "euclidean")}, span AS (SELECT min(score) AS lo, max(score) AS hi FROM flagged)
SELECT "Timestamp", forest_flag, density_flag, CASE WHEN 0.7::DOUBLE * ((score - lo) / (hi - lo)) + (1 - 0.7::DOUBLE) * density_flag >= 0.5 THEN 1 ELSE 0 END AS is_anomaly
FROM flagged JOIN noise USING ("Timestamp"), span""")
def a9_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dt.detect(readings(spark, sf_dir), ONE, "ensemble", lambda df: materialize(enhanced_features(df, ONE)),
                      ensemble=dt.EnsembleConfig("weighted"), density=dt.DensityConfig(eps=3.0, scale=True))
    return found.select(TIMESTAMP, "forest_flag", "density_flag", "is_anomaly")


# --- Studies ----------------------------------------------------------------------------------

def _forest_grid_sql() -> str:
    """Validation scores of every forest setting, with the threshold and the contamination cut-off of each."""
    shares, counts = studies.MAX_FEATURES_GRID, studies.TREES_GRID
    grown = ", ".join(forest_sql(f"g{i}", "tagged", STAMP, ENHANCED_INPUTS, trees=max(counts), max_features=share, fit="split = 'train'", prefixes=counts)
                      for i, share in enumerate(shares))
    long = " UNION ALL ".join(f'SELECT "Timestamp", split, label, count, {share!r}::DOUBLE AS share, round(raw, 12) AS score FROM g{i}' for i, share in enumerate(shares))
    settings = ", ".join(f"({k * len(counts) * len(shares) + i * len(shares) + j}, {c!r}::DOUBLE, {t}, {m!r}::DOUBLE)"
                         for k, c in enumerate(studies.CONTAMINATION_GRID) for i, t in enumerate(counts) for j, m in enumerate(shares))
    return f"""{PARTED}, {scaled_sql(ENHANCED, "parted", "split = 'train'")}, tagged AS MATERIALIZED (SELECT *, {_TAG} FROM matrix), {grown},
long AS MATERIALIZED ({long}), val AS (SELECT * FROM long WHERE split = 'val'),
spread AS (SELECT count, share, count(DISTINCT score) AS n, quantile_cont(score, [{_QUANTILES}]) AS q FROM val GROUP BY count, share),
candidates AS (SELECT DISTINCT count, share, threshold FROM (
  SELECT count, share, unnest(q) AS threshold FROM spread WHERE n > 100
  UNION ALL SELECT val.count, val.share, score FROM val JOIN spread USING (count, share) WHERE n <= 100)),
curve AS (SELECT count, share, threshold, count(*) FILTER (WHERE label = 1 AND score >= threshold) AS tp,
  count(*) FILTER (WHERE (label = 1) <> (score >= threshold)) AS e FROM val JOIN candidates USING (count, share) GROUP BY ALL),
searched AS (SELECT count, share, threshold, coalesce(2 * tp / nullif(2 * tp + e, 0)::DOUBLE, 0) AS f1 FROM curve
  QUALIFY row_number() OVER (PARTITION BY count, share ORDER BY f1 DESC, threshold) = 1),
settings AS (SELECT * FROM (VALUES {settings}) AS t(grid_order, contamination, trees, max_features)),
offsets AS MATERIALIZED (SELECT grid_order, any_value(contamination) AS contamination, any_value(count) AS count, any_value(share) AS share,
    quantile_cont(score, [{", ".join(f"{1.0 - c!r}::DOUBLE" for c in studies.CONTAMINATION_GRID)}])[grid_order // {len(shares) * len(counts)} + 1] AS cut
  FROM settings JOIN long ON count = trees AND share = max_features WHERE split = 'train' GROUP BY grid_order),
by_cut AS (SELECT grid_order, count(*) FILTER (WHERE label = 1 AND score - cut > 0) AS tp, count(*) FILTER (WHERE (label = 1) <> (score - cut > 0)) AS e
  FROM offsets JOIN val USING (count, share) GROUP BY grid_order),
board AS MATERIALIZED (SELECT grid_order, o.contamination, o.count AS trees, o.share AS max_features, s.threshold AS best, s.f1 AS f1_threshold,
    CASE WHEN tp > 0 THEN 2 * tp / (2 * tp + e)::DOUBLE ELSE 0 END AS f1_contamination, cut
  FROM offsets o JOIN by_cut USING (grid_order) JOIN searched s ON s.count = o.count AND s.share = o.share)"""


@query("a10_forest_grid", f"""WITH {_forest_grid_sql()}
SELECT grid_order, contamination, trees, max_features, CASE WHEN f1_threshold >= f1_contamination THEN round(best, 6) END AS threshold,
  CASE WHEN f1_threshold >= f1_contamination THEN 'threshold' ELSE 'contamination' END AS mode, round(f1_threshold, 6) AS f1_threshold,
  round(f1_contamination, 6) AS f1_contamination, round(greatest(f1_threshold, f1_contamination), 6) AS val_f1 FROM board""")
def a10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return studies.forest_grid(enhanced(spark, sf_dir), ONE).withColumns(
        {c: six(c) for c in ("threshold", "f1_threshold", "f1_contamination", "val_f1")})


def grid_sql(inputs: tuple[str, ...], configs: list[tuple[float, int]], metrics: tuple[str, ...]) -> str:
    """Scores of every density setting by brute force over one table of pair distances."""
    euclid = "sqrt(" + " + ".join(f'pow(a."{c}" - b."{c}", 2)' for c in inputs) + ")"
    city = " + ".join(f'abs(a."{c}" - b."{c}")' for c in inputs)
    gap = {"euclidean": euclid, "manhattan": city}
    radii = sorted({e for e, _ in configs})
    pairs = " UNION ALL ".join(
        f"""SELECT '{m}' AS metric, a.row_idx AS i, b.row_idx AS j, {gap[m]} AS d FROM tagged a JOIN tagged b ON TRUE
        WHERE {gap[m]} <= {radii[-1]}""" for m in metrics)
    names = ", ".join(f"({e}::DOUBLE, {m})" for e, m in configs)
    return f"""pairs AS MATERIALIZED ({pairs}),
settings AS (SELECT * FROM (VALUES {names}) AS t(eps, min_samples)),
radii AS (SELECT DISTINCT eps FROM settings),
counts AS MATERIALIZED (SELECT metric, eps, i, count(*) AS c FROM pairs JOIN radii ON d <= eps GROUP BY 1, 2, 3),
core AS MATERIALIZED (SELECT metric, s.eps, min_samples, i FROM counts c JOIN settings s ON c.eps = s.eps AND c >= min_samples),
reached AS MATERIALIZED (SELECT DISTINCT p.metric, eps, min_samples, p.i FROM pairs p JOIN core k
            ON k.metric = p.metric AND k.i = p.j AND p.d <= k.eps),
flags AS (SELECT m.metric, s.eps, s.min_samples, t.split, t.label, CASE WHEN r.i IS NULL THEN 1 ELSE 0 END AS is_anomaly
  FROM tagged t CROSS JOIN settings s CROSS JOIN (SELECT unnest([{", ".join(repr(m) for m in metrics)}]) AS metric) m
  LEFT JOIN reached r ON r.metric = m.metric AND r.eps = s.eps AND r.min_samples = s.min_samples AND r.i = t.row_idx),
c AS (SELECT metric, eps, min_samples, split, {COUNTS} FROM flags GROUP BY 1, 2, 3, 4)
SELECT metric, eps, min_samples, split, tn, fp, fn, tp, tp + fp AS flagged, {RATES} FROM c"""


@query("a11_density_grid_unscaled", f"""WITH {EVALUABLE},
tagged AS (SELECT *, 'all' AS split, {_TAG} FROM evaluable),
{grid_sql(MATRIX, [(e, m) for e in studies.LEGACY_EPS_GRID for m in studies.LEGACY_MIN_SAMPLES_GRID], ("euclidean",))}""")
def a11_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_rounded_rates(studies.density_grid(
        base(spark, sf_dir), ONE, eps=studies.LEGACY_EPS_GRID, min_samples=studies.LEGACY_MIN_SAMPLES_GRID,
        metrics=("euclidean",), scale=False))


_SCALED_GRID = f"""WITH {PARTED}, {scaled_sql(ENHANCED, "parted", "split = 'train'")},
tagged AS (SELECT *, {_TAG} FROM matrix),
{grid_sql((*(f"{c}_scaled" for c in ENHANCED), "hour_zscore"),
          [(e, m) for e in studies.EPS_GRID for m in studies.MIN_SAMPLES_GRID], studies.METRIC_GRID)}"""


@query("a11_density_winner", f"""WITH g AS ({_SCALED_GRID}),
best AS (SELECT metric, eps, min_samples FROM g WHERE split = 'val' ORDER BY f1 DESC, metric, eps, min_samples LIMIT 1)
SELECT g.* FROM g JOIN best USING (metric, eps, min_samples)""")
def a11_winner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_rounded_rates(studies.density_winner(enhanced(spark, sf_dir), ONE))


@query("a11_density_grid_scaled", _SCALED_GRID)
def a11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_rounded_rates(studies.density_grid(enhanced(spark, sf_dir), ONE))


_TUNED_SWEEP = f"""WITH {_TUNED_BOTH},
options AS (
  SELECT split, label, 'intersection' AS strategy, 0.7::DOUBLE AS alpha, least(forest_flag, density_flag) AS is_anomaly FROM flagged
  UNION ALL SELECT split, label, 'union', 0.7::DOUBLE, greatest(forest_flag, density_flag) FROM flagged
  UNION ALL SELECT split, label, 'weighted', alpha, CASE WHEN alpha * score_norm + (1 - alpha) * density_flag >= 0.5 THEN 1 ELSE 0 END
  FROM flagged, (SELECT unnest([0.5, 0.6, 0.7, 0.8, 0.9]::DOUBLE[]) AS alpha)),
c AS (SELECT strategy, alpha, split, {COUNTS} FROM options GROUP BY 1, 2, 3)
SELECT strategy, alpha, split, tn, fp, fn, tp, {RATES} FROM c"""


@query("a12_ensemble_sweep", _TUNED_SWEEP)
def a12(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = studies.tuned_ensemble_rows(enhanced(spark, sf_dir), ONE)
    return with_rounded_rates(studies.ensemble_sweep(rows, "forest_flag", "density_flag", "score_norm"))


_RULE_SWEEP = f"""WITH {RULED}, b AS (SELECT min(score) AS lo, max(score) AS hi FROM ruled),
options AS (
  SELECT split, label, 'intersection' AS strategy, 0.7::DOUBLE AS alpha, least(is_anomaly, flag_b) AS is_anomaly FROM ruled
  UNION ALL SELECT split, label, 'union', 0.7::DOUBLE, greatest(is_anomaly, flag_b) FROM ruled
  UNION ALL SELECT split, label, 'weighted', alpha,
    CASE WHEN alpha * ((score - lo) / (hi - lo)) + (1 - alpha) * flag_b >= 0.5 THEN 1 ELSE 0 END
  FROM ruled, b, (SELECT unnest([0.5, 0.6, 0.7, 0.8, 0.9]::DOUBLE[]) AS alpha)),
c AS (SELECT strategy, alpha, split, {COUNTS} FROM options GROUP BY 1, 2, 3)
SELECT strategy, alpha, split, tn, fp, fn, tp, {RATES} FROM c"""


@query("a12_rule_winner", f"""WITH g AS ({_RULE_SWEEP}),
best AS (SELECT strategy, alpha FROM g WHERE split = 'val' ORDER BY f1 DESC, strategy, alpha LIMIT 1)
SELECT g.* FROM g JOIN best USING (strategy, alpha)""")
def a12_rule_winner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_rounded_rates(studies.ensemble_winner(a12_rule(spark, sf_dir)))


@query("a12_rule_sweep", _RULE_SWEEP)
def a12_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = th.min_max(materialize(ruled(spark, sf_dir)), "score")
    return with_rounded_rates(studies.ensemble_sweep(rows, "is_anomaly", "flag_b", "score_norm"))


@query("a12_ensemble_winner", f"""WITH g AS ({_TUNED_SWEEP}),
best AS (SELECT strategy, alpha FROM g WHERE split = 'val' ORDER BY f1 DESC, strategy, alpha LIMIT 1)
SELECT g.* FROM g JOIN best USING (strategy, alpha)""")
def a12_winner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_rounded_rates(studies.ensemble_winner(a12(spark, sf_dir)))


@query("a10_forest_winner", f"""WITH {_forest_grid_sql()},
best_row AS (SELECT *, CASE WHEN f1_threshold >= f1_contamination THEN 'threshold' ELSE 'contamination' END AS mode FROM board
  ORDER BY greatest(f1_threshold, f1_contamination) DESC, grid_order LIMIT 1),
flags AS (SELECT contamination, trees, max_features, mode, split, label,
    CASE WHEN mode = 'threshold' THEN (score >= best)::INT ELSE (score - cut > 0)::INT END AS is_anomaly
  FROM long JOIN best_row ON count = trees AND share = max_features),
c AS (SELECT contamination, trees, max_features, mode, split, {COUNTS} FROM flags GROUP BY 1, 2, 3, 4, 5)
SELECT contamination, trees, max_features, mode, split, tn, fp, fn, tp, {RATES} FROM c""")
def a10_winner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_rounded_rates(studies.forest_winner(enhanced(spark, sf_dir), ONE))


@query("e12_enhanced_splits", f"""WITH {TUNED_ROWS},
c AS (SELECT split, {COUNTS} FROM (SELECT split, label, forest_flag AS is_anomaly FROM tuned) GROUP BY split)
SELECT split, tn, fp, fn, tp, {RATES} FROM c""")
def e12_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_rounded_rates(studies.enhanced_forest_splits(materialize(readings(spark, sf_dir)), ONE))


def profiles_sql() -> str:
    """``profiles``: flags of the three detection profiles on the evaluable rows."""
    return f"""{_ALL_SCALED},
{forest_sql("plain", "tagged", STAMP, MATRIX)}, {shifted_sql("plain", 0.05, "legacy_rows")},
{forest_sql("early", "tagged", STAMP, MATRIX, fit="split = 'train'")}, {shifted_sql("early", 0.05, "early_scored")}, {best_cut_sql("early_cut", "early_scored")},
{forest_sql("rich", "tagged", STAMP, ENHANCED_INPUTS, trees=200, max_features=0.6)}, {shifted_sql("rich", 0.03, "rich_scored")}, {best_cut_sql("rich_cut", "rich_scored")},
profiles AS MATERIALIZED (SELECT "Timestamp", a.forest_flag AS legacy, (b.score >= x.threshold)::INT AS legacy_threshold, (c.score >= y.threshold)::INT AS enhanced
  FROM legacy_rows a JOIN early_scored b USING ("Timestamp") JOIN rich_scored c USING ("Timestamp"), early_cut x, rich_cut y)"""


@query("a13_profile_flags", f"""WITH {profiles_sql()} SELECT "Timestamp", legacy, legacy_threshold, enhanced FROM profiles""")
def a13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flags of all three detection profiles side by side."""
    source = materialize(readings(spark, sf_dir))
    result = None
    for profile in dt.PROFILES:
        _, flags = dt.profile_flags(source, ONE, profile)
        named = flags.withColumnRenamed("is_anomaly", profile)
        result = named if result is None else result.join(named, TIMESTAMP)
    return result


_BASE_FORESTS = f"""{forest_sql("full_forest", "tagged", STAMP, MATRIX)}, {shifted_sql("full_forest", 0.05, "full_rows")},
{forest_sql("early", "tagged", STAMP, MATRIX, fit="split = 'train'")}, {shifted_sql("early", 0.05, "early_scored")}, {best_cut_sql("early_cut", "early_scored")},
base_board AS (
  SELECT 'base forest, all rows' AS detector, label, forest_flag AS is_anomaly FROM full_rows
  UNION ALL SELECT 'base forest, test', label, forest_flag FROM early_scored WHERE split = 'test'
  UNION ALL SELECT 'base forest, test, validation threshold', label, (score >= threshold)::INT FROM early_scored, early_cut WHERE split = 'test')"""


@query("e12_measured_board", f"""WITH {_TUNED_BOTH}, {_BASE_FORESTS}, {noise_sql("tagged", '"Timestamp"', MATRIX, 0.5, 5, "euclidean", "plain_noise")},
board AS (SELECT * FROM base_board
  UNION ALL SELECT 'enhanced forest, test', label, forest_flag FROM flagged WHERE split = 'test'
  UNION ALL SELECT 'enhanced density, test', label, density_flag FROM flagged WHERE split = 'test'
  UNION ALL SELECT 'enhanced union, test', label, greatest(forest_flag, density_flag) FROM flagged WHERE split = 'test'
  UNION ALL SELECT 'enhanced intersection, test', label, least(forest_flag, density_flag) FROM flagged WHERE split = 'test'
  UNION ALL SELECT 'base density, all rows', label, density_flag FROM plain_noise JOIN tagged USING ("Timestamp")),
c AS (SELECT detector, {COUNTS} FROM board GROUP BY 1)
SELECT detector, tn, fp, fn, tp, {RATES} FROM c""")
def e12_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_rounded_rates(studies.comparison_board(materialize(readings(spark, sf_dir)), ONE))


@query("e13_fair_comparison", f"""WITH {TUNED_ROWS}, {_BASE_FORESTS},
board AS (SELECT * FROM base_board UNION ALL SELECT 'enhanced forest, test', label, forest_flag FROM tuned WHERE split = 'test'),
c AS (SELECT detector, {COUNTS} FROM board GROUP BY 1)
SELECT detector AS model, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0), 6) AS test_f1 FROM c""")
def e13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return studies.fair_comparison(materialize(readings(spark, sf_dir)), ONE).withColumn("test_f1", six("test_f1"))


@query("x4_segmented_forest", f"""WITH {TUNED_ROWS},
test AS (SELECT *, forest_flag AS is_anomaly FROM tuned WHERE split = 'test'), overall AS (SELECT {COUNTS} FROM test),
seg AS (
  SELECT 'hour' AS segmentation, CAST(hour AS VARCHAR) AS segment, {COUNTS}, count(*) AS n FROM test GROUP BY 2
  UNION ALL SELECT 'day_kind', CASE WHEN is_weekend = 0 THEN 'weekday' ELSE 'weekend' END, {COUNTS}, count(*) FROM test GROUP BY 2)
SELECT segmentation, segment, n, {RATES}, fp, fn,
  coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0) < (SELECT coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0) FROM overall) AS flag_low_recall
FROM seg WHERE n >= 10""")
def x4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test scores by hour and day kind of a tuned forest fitted on the train rows."""
    bundle = tuning_bundle(enhanced(spark, sf_dir), ONE)
    config = dt.ForestConfig(contamination=0.03, trees=200, max_features=0.6, scale=True, fit_on="train")
    scored = dt.forest_scores(bundle, ONE, config)
    cut = th.best_threshold(scored.where(F.col("split") == "val"), "score").first()["threshold"]
    flagged = materialize(scored.withColumn("is_anomaly", th.flag_at("score", cut)))
    return with_rounded_rates(segment_table(flagged, min_rows=10))
