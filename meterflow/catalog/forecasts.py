"""Queries over forecasters."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterflow.catalog.basics import lags_sql
from meterflow.catalog.registry import query
from meterflow.catalog.tables import ONE, TYPED, features_sql, grid, readings_sql, six, split_sql
from meterflow.operators import forecast as fc
from meterflow.operators.boosting import TARGET_BITS, BoostConfig, BoostedTrees, fit_boosted, importance
from meterflow.operators.eda import last_rows
from meterflow.operators.features import add_calendar
from meterflow.operators.metrics import forecast_scorecard
from meterflow.operators.ordering import with_row_index
from meterflow.operators.splits import forecast_split
from meterflow.plans import forecasting as plan
from meterflow.session import materialize, scratch_path
from meterflow.sources.readings import read_readings
from meterflow.sources.sinks import write_predictions
from meterflow.spec import FORECAST_SPLIT, TIMESTAMP, SeriesSpec


def naive_sql(keys: str = "") -> str:
    part = f"PARTITION BY {keys} " if keys else ""
    k = f"{keys}, " if keys else ""
    y = '"Electricity_Consumed"'
    return f"""{readings_sql(keys)}, {split_sql("readings", *FORECAST_SPLIT, keys=keys)},
near AS (SELECT {k}"Timestamp", split, {y} AS y_true, lag({y}, 48) OVER ({part}ORDER BY "Timestamp") AS y_pred
         FROM parted WHERE split <> 'val'),
far AS (SELECT {k}"Timestamp", split, {y} AS y_true, lag({y}, 48) OVER ({part}ORDER BY "Timestamp") AS y_pred
        FROM parted),
predictions AS (
  SELECT 'naive' AS model, {k}"Timestamp", y_true, y_pred FROM near WHERE split = 'test'
  UNION ALL SELECT 'naive_all' AS model, {k}"Timestamp", y_true, y_pred FROM far WHERE split = 'test')"""


NAIVE = naive_sql()


def naive_predictions(spark: SparkSession, sf_dir: str, spec: SeriesSpec = ONE) -> DataFrame:
    """Both look-back variants of the seasonal naive forecaster in one table."""
    slots = grid(spark, sf_dir, spec).select(*spec.series, spec.ts, spec.target)
    split = materialize(forecast_split(slots, spec))
    parts = [fc.seasonal_naive(split, spec, history=h).withColumn("model", F.lit(m))
             for m, h in (("naive", "train_test"), ("naive_all", "all"))]
    return parts[0].unionByName(parts[1])


@query("t1_seasonal_naive", f"""WITH {NAIVE} SELECT "Timestamp", y_true, y_pred FROM predictions WHERE model = 'naive'""")
def t1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fc.seasonal_naive(forecast_split(grid(spark, sf_dir), ONE), ONE)


@query("t1_seasonal_naive_by_type", f"""WITH {naive_sql('event_type')}
SELECT event_type, model, "Timestamp", y_true, y_pred FROM predictions""")
def t1_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return naive_predictions(spark, sf_dir, TYPED)


@query("t1_seasonal_naive_scores", f"""WITH {NAIVE}
SELECT 'naive' AS model, count(*) AS rows, round(avg(abs(y_true - y_pred)), 6) AS mae,
  round(sqrt(avg((y_true - y_pred) ** 2)), 6) AS rmse,
  round(avg(abs(y_true - y_pred) / greatest(abs(y_true), 1e-8)) * 100, 6) AS mape
FROM predictions WHERE model = 'naive'""")
def t1_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = forecast_split(add_calendar(grid(spark, sf_dir)), ONE)
    card = forecast_scorecard(fc.seasonal_naive(split, ONE).withColumn("model", F.lit("naive")))
    return card.withColumns({c: six(c) for c in ("mae", "rmse", "mape")})


@query("t2_training_frames", f"""WITH {readings_sql()}, {split_sql("readings", *FORECAST_SPLIT)}
SELECT 'train' AS part, "Timestamp" AS ds, "Electricity_Consumed" AS y FROM parted WHERE split = 'train'
UNION ALL SELECT 'future', "Timestamp", NULL FROM parted WHERE split = 'test'""")
def t2(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = forecast_split(grid(spark, sf_dir), ONE)
    train = fc.training_frame(split.where(F.col("split") == "train"), ONE).withColumn("part", F.lit("train"))
    future = fc.future_frame(split.where(F.col("split") == "test"), ONE).withColumn("part", F.lit("future"))
    return train.unionByName(future, allowMissingColumns=True)


def rounded_predictions(df: DataFrame) -> DataFrame:
    return df.withColumn("y_pred", six("y_pred"))


def descent_sql(name: str, problems: str, terms: int, sweeps: int, keys: str = "") -> str:
    """``{name}``: weights after so many sweeps of coordinate descent over ``problems`` (keys, gram, cross, l1, l2), a term a step."""
    k, on = (f"{keys}, ", f"USING ({keys})") if keys else ("", "ON TRUE")
    return f"""{name}_steps AS (
  SELECT {k}0 AS step, list_transform(range({terms}), lambda i: 0.0::DOUBLE) AS w FROM {problems}
  UNION ALL
  SELECT {k}step + 1, list_transform(w, lambda v, i: CASE WHEN i = step % {terms} + 1
    THEN sign(pull) * greatest(abs(pull) - l1[i], 0.0::DOUBLE) / (gram[i][i] + l2[i]) ELSE v END)
  FROM (SELECT *, cross_[step % {terms} + 1] - list_dot_product(gram[step % {terms} + 1], w) + gram[step % {terms} + 1][step % {terms} + 1] * w[step % {terms} + 1] AS pull
        FROM {name}_steps JOIN {problems} {on}) WHERE step < {terms * sweeps}),
{name} AS (SELECT * FROM {name}_steps WHERE step = {terms * sweeps})"""


def products_sql(name: str, source: str, terms: int, keys: str = "") -> str:
    """``{name}``: sums of products of the lists ``x`` of ``source``, as a list of lists."""
    k = f"{keys}, " if keys else ""
    by = f"GROUP BY {keys}" if keys else ""
    return f"""{name}_cells AS (SELECT {k}i, j, sum(x[i] * x[j]) AS g FROM {source}, (SELECT unnest(range(1, {terms + 1})) AS i), (SELECT unnest(range(1, {terms + 1})) AS j)
  GROUP BY ALL),
{name} AS MATERIALIZED (SELECT {k}list(r ORDER BY i) AS m FROM (SELECT {k}i, list(g ORDER BY j) AS r FROM {name}_cells GROUP BY {k}i) {by})"""


def additive_sql(keys: str = "", sweeps: int = 150) -> str:
    """The default additive model by coordinate descent on its moments."""
    model = fc.AdditiveModel()
    lasso, ridge = model.shrinkage
    n = len(lasso)
    k, on = (f"{keys}, ", f"USING ({keys})") if keys else ("", "ON TRUE")
    by = f"GROUP BY {keys}" if keys else ""
    knots = [f"greatest(u - {model.change_range * j / model.changepoints!r}::DOUBLE, 0.0::DOUBLE)" for j in range(1, model.changepoints + 1)]
    waves = [f"{fn}(t % {period!r}::DOUBLE * {2 * math.pi * c / period!r}::DOUBLE)" for period, order in ((86400.0, model.daily_order), (7 * 86400.0, model.weekly_order))
             for c in range(1, order + 1) for fn in ("sin", "cos")]
    y = '"Electricity_Consumed"'
    numbers = lambda values: "[" + ", ".join(f"{v!r}::DOUBLE" for v in values) + "]"
    return f"""WITH RECURSIVE {readings_sql(keys)}, {split_sql("readings", *FORECAST_SPLIT, keys=keys)},
timed AS (SELECT *, epoch("Timestamp") AS t FROM parted),
ranges AS (SELECT {k}min(t) AS t0, greatest(max(t) - min(t), 1.0) AS span FROM timed WHERE split = 'train' {by}),
design AS MATERIALIZED (SELECT {k}"Timestamp", split, {y} AS y, [1.0::DOUBLE, u, {", ".join(knots + waves)}] AS x
  FROM (SELECT timed.*, (t - t0) / span AS u FROM timed JOIN ranges {on})),
moved AS (SELECT {k}list_append(x, y::DOUBLE) AS x FROM design WHERE split = 'train' AND y IS NOT NULL),
neighbours AS (SELECT {k}avg(d * d) / 2 AS steps FROM (
  SELECT {k}max({y}) - min({y}) AS d FROM parted WHERE split = 'train' AND {y} IS NOT NULL GROUP BY {k}row_idx // 2 HAVING count(*) = 2) {by}),
{products_sql("products", "moved", n + 1, keys)},
sized AS (SELECT {k}m, sqrt(m[{n + 1}][{n + 1}] / m[1][1]) AS size FROM products),
problems AS MATERIALIZED (SELECT {k}size, list_transform(m[1:{n}], lambda r: r[1:{n}]) AS gram, list_transform(m[1:{n}], lambda r: r[{n + 1}] / size) AS cross_,
    list_transform({numbers(lasso)}, lambda p: p * noise) AS l1, list_transform({numbers(ridge)}, lambda p: p * noise) AS l2
  FROM (SELECT sized.*, steps / size ** 2 AS noise FROM sized JOIN neighbours {on})),
{descent_sql("fitted", "problems", n, sweeps, keys)}
SELECT {k}"Timestamp", y AS y_true, round(list_dot_product(x, w) * size, 6) AS y_pred
FROM design JOIN problems {on} JOIN fitted {on} WHERE split = 'test'"""


@query("t3_additive_forecast", additive_sql())
def t3(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = materialize(forecast_split(grid(spark, sf_dir), ONE))
    return rounded_predictions(fc.additive_forecast(split, ONE))


@query("t3_additive_forecast_by_type", additive_sql("event_type"))
def t3_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = materialize(forecast_split(grid(spark, sf_dir, TYPED), TYPED))
    return rounded_predictions(fc.additive_forecast(split, TYPED))


def _plain_fit_sql() -> str:
    """Train-only straight line over time: the additive design without changes and seasons."""
    return f"""WITH {readings_sql('event_type')}, {split_sql("readings", *FORECAST_SPLIT, keys="event_type")},
fit AS (SELECT event_type, regr_slope("Electricity_Consumed", epoch("Timestamp") / 86400.0 - 19723) AS b,
          regr_intercept("Electricity_Consumed", epoch("Timestamp") / 86400.0 - 19723) AS a
        FROM parted WHERE split = 'train' GROUP BY 1)
SELECT event_type, "Timestamp", "Electricity_Consumed" AS y_true,
  round(a + b * (epoch("Timestamp") / 86400.0 - 19723), 4) AS y_pred
FROM parted JOIN fit USING (event_type) WHERE split = 'test'"""


@query("t3_linear_trend_by_type", _plain_fit_sql())
def t3_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = materialize(forecast_split(grid(spark, sf_dir, TYPED), TYPED))
    line = fc.AdditiveModel(changepoints=0, daily_order=0, weekly_order=0)
    return fc.additive_forecast(split, TYPED, line).withColumn("y_pred", F.round("y_pred", 4))


def calendar_grid(spark: SparkSession, sf_dir: str, spec: SeriesSpec = ONE) -> DataFrame:
    return materialize(with_row_index(add_calendar(grid(spark, sf_dir, spec)), spec))


@query("t4_boosted_lags")
def t4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded_predictions(fc.boosted_forecast(calendar_grid(spark, sf_dir), ONE))


@query("t4_lag_frame", f"""WITH {lags_sql()}, {split_sql("lags", *FORECAST_SPLIT)}
SELECT "Timestamp", "Electricity_Consumed", "Electricity_Consumed_lag_1", "Electricity_Consumed_lag_2",
  "Electricity_Consumed_lag_48", "Temperature", "Humidity", hour, day_of_week, month, is_weekend, split FROM parted""")
def t4_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = fc.boosted_frame(calendar_grid(spark, sf_dir), ONE)
    return frame.select(TIMESTAMP, ONE.target, *fc.boosted_features(ONE.target), "split")


SMALL = BoostConfig(trees=3, depth=3, bins=16)
STUMPS = BoostConfig(trees=8, depth=1, bins=32)


def boosted_sql(config: BoostConfig) -> str:
    """The boosted trees of a small configuration, level by level: ``p<trees>`` has the predictions, ``split_<tree>_<level>`` the splits."""
    names = fc.boosted_features(ONE.target)
    y = f'"{ONE.target}"'
    probs = ", ".join(f"{k / config.bins!r}::DOUBLE" for k in range(1, config.bins))
    long = " UNION ALL ".join(f'SELECT id, split, {i} AS f, CAST("{c}" AS DOUBLE) AS x FROM numbered' for i, c in enumerate(names))
    parts = [f"""{lags_sql()}, {split_sql("lags", *FORECAST_SPLIT)},
numbered AS MATERIALIZED (SELECT row_number() OVER (ORDER BY "Timestamp") AS id, * FROM parted),
unpivoted AS ({long}),
cuts AS (SELECT f, unnest(list_distinct(quantile_cont(x, [{probs}]))) AS c FROM unpivoted WHERE split = 'train' GROUP BY f),
binned AS MATERIALIZED (SELECT id, f, CASE WHEN any_value(x) IS NULL THEN 0 ELSE 1 + count(c) FILTER (c < x) END AS b
                        FROM unpivoted LEFT JOIN cuts USING (f) GROUP BY id, f),
consts AS (SELECT pow(2, {TARGET_BITS} - ceil(log2(max(abs({y})) + 1))) AS unit FROM numbered WHERE split = 'train'),
p0 AS MATERIALIZED (SELECT id, split, t, (sum(t) FILTER (split = 'train') OVER () // count(*) FILTER (split = 'train') OVER ())::BIGINT AS p
  FROM (SELECT id, split, floor({y} * unit + 0.5)::BIGINT AS t FROM numbered, consts))"""]
    for tree in range(config.trees):
        parts.append(f"node_{tree}_0 AS (SELECT id, split, t, p, 1 AS node FROM p{tree})")
        for level in range(config.depth):
            at = f"{tree}_{level}"
            parts.append(f"""cells_{at} AS (SELECT node, f, b, count(*) AS n, sum(t - p) AS s FROM node_{at} JOIN binned USING (id)
  WHERE split = 'train' AND node >= {1 << level} GROUP BY ALL),
sides_{at} AS (SELECT node, f, b, sum(n) OVER w AS ln, sum(s) OVER w AS ls, sum(n) OVER (PARTITION BY node, f) AS n, sum(s) OVER (PARTITION BY node, f) AS s
  FROM cells_{at} WINDOW w AS (PARTITION BY node, f ORDER BY b)),
gains_{at} AS (SELECT node, f, b, n, ((ls::DOUBLE * ls::DOUBLE / (ln::DOUBLE + {config.penalty!r}::DOUBLE)
  + (s - ls)::DOUBLE * (s - ls)::DOUBLE / ((n - ln)::DOUBLE + {config.penalty!r}::DOUBLE))
  - s::DOUBLE * s::DOUBLE / (n::DOUBLE + {config.penalty!r}::DOUBLE)) / (unit * unit) AS gain FROM sides_{at}, consts WHERE ln < n),
split_{at} AS MATERIALIZED (SELECT * FROM gains_{at} WHERE gain > {config.min_gain!r}
  QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, b) = 1),
node_{tree}_{level + 1} AS MATERIALIZED (SELECT a.id, split, t, p, CASE WHEN c.node IS NULL THEN a.node ELSE 2 * a.node + (d.b > c.b)::INT END AS node
  FROM node_{at} a LEFT JOIN split_{at} c ON a.node = c.node LEFT JOIN binned d ON d.id = a.id AND d.f = c.f)""")
        parts.append(f"""leaf_{tree} AS (SELECT node, floor({config.step!r}::DOUBLE * sum(t - p)::DOUBLE / (count(*)::DOUBLE + {config.penalty!r}::DOUBLE) + 0.5)::BIGINT AS v
  FROM node_{tree}_{config.depth} WHERE split = 'train' GROUP BY node),
p{tree + 1} AS MATERIALIZED (SELECT id, split, t, p + v AS p FROM node_{tree}_{config.depth} JOIN leaf_{tree} USING (node))""")
    return ", ".join(parts)


def predictions_sql(config: BoostConfig) -> str:
    return f"""WITH {boosted_sql(config)}
SELECT "Timestamp", "{ONE.target}" AS y_true, round(p / unit, 6) AS y_pred
FROM numbered JOIN p{config.trees} USING (id), consts WHERE numbered.split = 'test'"""


def splits_sql(config: BoostConfig) -> str:
    """tree, node, feature, rows and gain of every split."""
    names = ", ".join(f"'{c}'" for c in fc.boosted_features(ONE.target))
    found = " UNION ALL ".join(f"SELECT {t} AS tree, node::INT AS node, [{names}][f + 1] AS feature, n::BIGINT AS rows, gain FROM split_{t}_{level}"
                               for t in range(config.trees) for level in range(config.depth))
    return f"WITH {boosted_sql(config)}, splits AS ({found})"


def boosted_on_grid(spark: SparkSession, sf_dir: str, config: BoostConfig) -> BoostedTrees:
    return fc.boosted_fit(fc.boosted_frame(calendar_grid(spark, sf_dir), ONE), ONE, config)


@query("t4_boosted_stumps", predictions_sql(STUMPS))
def t4_stumps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded_predictions(fc.boosted_forecast(calendar_grid(spark, sf_dir), ONE, STUMPS))


@query("t4_boosted_small_trees", predictions_sql(SMALL))
def t4_small(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded_predictions(fc.boosted_forecast(calendar_grid(spark, sf_dir), ONE, SMALL))


@query("t4_boosted_by_level_jobs", predictions_sql(SMALL))
def t4_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same model with one aggregation over all tasks a level, as tables of many blocks are grown."""
    lags = fc.boosted_frame(calendar_grid(spark, sf_dir), ONE)
    model = fit_boosted(lags.where(F.col("split") == "train"), fc.boosted_features(ONE.target), ONE.target, SMALL, block_rows=0)
    return rounded_predictions(fc.prediction_frame(model.predict(lags.where(F.col("split") == "test")), ONE, "prediction"))


@query("t5_split_ledger", f"""{splits_sql(SMALL)} SELECT tree, node, feature, rows, round(gain, 6) AS gain FROM splits""")
def t5_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = boosted_on_grid(spark, sf_dir, SMALL).ledger(spark).where("feature is not null")
    return ledger.select("tree", "node", "feature", "rows", six("gain").alias("gain"))


@query("t5_importance_of_stumps", f"""{splits_sql(STUMPS)}
SELECT feature, round(coalesce(avg(gain), 0), 6) AS importance, count(gain) AS splits
FROM (SELECT unnest([{", ".join(f"'{c}'" for c in fc.boosted_features(ONE.target))}]) AS feature) LEFT JOIN splits USING (feature) GROUP BY feature""")
def t5_stumps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance(boosted_on_grid(spark, sf_dir, STUMPS).ledger(spark), fc.boosted_features(ONE.target)).withColumn("importance", six("importance"))


@query("t5_feature_importance")
def t5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance(boosted_on_grid(spark, sf_dir, BoostConfig()).ledger(spark), fc.boosted_features(ONE.target))


WINDOW, WINDOW_FEATURES = 3, (ONE.target, "Temperature", "hour")


def window_sql(features: tuple[str, ...], length: int, penalty: float = 0.01, mix: float = 0.5, sweeps: int = 400) -> str:
    """Window regression with every window written out, by coordinate descent on standardised moments."""
    n = len(features) * length
    lags = ", ".join(f'lag("{f}", {length - a}) OVER o::DOUBLE' for a in range(length) for f in features)
    return f"""WITH RECURSIVE {features_sql()},
laid AS (SELECT "Timestamp", row_idx, series_rows, "{features[0]}"::DOUBLE AS y, [{lags}] AS past FROM features WINDOW o AS (ORDER BY "Timestamp")),
samples AS (SELECT * FROM laid WHERE row_idx >= {length}), {split_sql("samples", *FORECAST_SPLIT)},
moved AS (SELECT list_concat(past, [y, 1.0::DOUBLE]) AS x FROM parted WHERE split = 'train'),
{products_sql("products", "moved", n + 2)},
centred AS (SELECT m, n, list_transform(m[1:{n + 1}], lambda r: r[{n + 2}] / n) AS mean FROM (SELECT *, m[{n + 2}][{n + 2}] AS n FROM products)),
spreads AS (SELECT *, list_transform(range(1, {n + 2}), lambda i: sqrt((m[i][i] - n * mean[i] * mean[i]) / (n - 1))) AS s FROM centred),
problems AS MATERIALIZED (SELECT mean, s,
    list_transform(range(1, {n + 1}), lambda i: list_transform(range(1, {n + 1}), lambda j: (m[i][j] - n * mean[i] * mean[j]) / (s[i] * s[j]) / n)) AS gram,
    list_transform(range(1, {n + 1}), lambda i: (m[i][{n + 1}] - n * mean[i] * mean[{n + 1}]) / (s[i] * s[{n + 1}]) / n) AS cross_,
    list_transform(range({n}), lambda i: {penalty * mix!r}::DOUBLE / s[{n + 1}]) AS l1, list_transform(range({n}), lambda i: {penalty * (1 - mix)!r}::DOUBLE / s[{n + 1}]) AS l2
  FROM spreads),
{descent_sql("fitted", "problems", n, sweeps)},
model AS (SELECT weights, mean[{n + 1}] - list_dot_product(weights, mean[1:{n}]) AS intercept
  FROM (SELECT mean, list_transform(w, lambda v, i: v * s[{n + 1}] / s[i]) AS weights FROM fitted, problems))
SELECT "Timestamp", y AS y_true, round(list_dot_product(past, weights) + intercept, 6) AS y_pred FROM parted, model WHERE split = 'test'"""


@query("t6_window_regression_short", window_sql(WINDOW_FEATURES, WINDOW))
def t6_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded_predictions(fc.window_regression_forecast(calendar_grid(spark, sf_dir), ONE, WINDOW_FEATURES, WINDOW))


@query("t6_window_regression")
def t6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded_predictions(fc.window_regression_forecast(calendar_grid(spark, sf_dir), ONE))


@query("t7_routed_forecast", f"""WITH {naive_sql('event_type')}
SELECT event_type, "Timestamp", y_true, y_pred FROM predictions WHERE model = 'naive'""")
def t7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.run_forecast(grid(spark, sf_dir, TYPED), TYPED, "naive")


@query("t8_prediction_ranges", f"""WITH {readings_sql()},
lagged AS (SELECT * FROM readings WHERE row_idx >= 48), samples AS (SELECT * FROM readings WHERE row_idx >= 24),
{split_sql("readings", *FORECAST_SPLIT, name="plain")}, {split_sql("lagged", *FORECAST_SPLIT, name="lag_rows")},
{split_sql("samples", *FORECAST_SPLIT, name="windows")},
tests AS (
  SELECT 'naive' AS model, "Timestamp" FROM plain WHERE split = 'test'
  UNION ALL SELECT 'prophet', "Timestamp" FROM plain WHERE split = 'test'
  UNION ALL SELECT 'xgboost', "Timestamp" FROM lag_rows WHERE split = 'test'
  UNION ALL SELECT 'lstm', "Timestamp" FROM windows WHERE split = 'test')
SELECT model, count(*) AS rows, min("Timestamp") AS start_ts, max("Timestamp") AS end_ts FROM tests GROUP BY 1""")
def t8(spark: SparkSession, sf_dir: str) -> DataFrame:
    predictions = plan.collect_predictions(calendar_grid(spark, sf_dir), ONE)
    return plan.prediction_ranges(predictions, ONE)


@query("x3_forecast_ladder")
def x3(spark: SparkSession, sf_dir: str) -> DataFrame:
    cards = plan.ladder(calendar_grid(spark, sf_dir), ONE)
    return cards.withColumns({c: six(c) for c in ("mae", "rmse", "mape")})


@query("s4_predictions_file", f"""WITH {NAIVE} SELECT "Timestamp", y_true, y_pred FROM predictions WHERE model = 'naive'""")
def s4(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_predictions(t1(spark, sf_dir), scratch_path(spark, "predictions"))
    columns = T.StructType([T.StructField("y_true", T.DoubleType()), T.StructField("y_pred", T.DoubleType())])
    return read_readings(spark, path, schema=columns)


@query("d10_last_predictions", f"""WITH {naive_sql('event_type')},
ranked AS (SELECT *, row_number() OVER (PARTITION BY event_type, model ORDER BY "Timestamp" DESC) AS r FROM predictions)
SELECT event_type, model, "Timestamp", y_true, y_pred FROM ranked WHERE r <= 144""")
def d10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return last_rows(naive_predictions(spark, sf_dir, TYPED), ["event_type", "model"], TIMESTAMP)


@query("d10_first_predictions", f"""WITH {NAIVE},
ranked AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY "Timestamp") AS r FROM predictions)
SELECT model, "Timestamp", y_true, y_pred FROM ranked WHERE r <= 144""")
def d10_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return last_rows(naive_predictions(spark, sf_dir), ["model"], TIMESTAMP, first=True)

