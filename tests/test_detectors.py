import numpy as np
import pandas as pd
import pytest
from helpers import ONE, series, to_spark
from pyspark.sql import functions as F

from meterflow.operators.density import _Grid, density_noise, density_noise_grid
from meterflow.operators.features import base_features
from meterflow.operators.forest import SAMPLE, _tree_samples, contamination_offset, fit_forest, mean_path
from meterflow.operators.matrix import MatrixScaler, evaluable_rows, model_matrix
from meterflow.plans import detection as dt
from meterflow.spec import Layout


def brute_noise(x, eps, least, metric="euclidean"):
    gap = x[:, None, :] - x[None, :, :]
    d = np.sqrt((gap ** 2).sum(-1)) if metric == "euclidean" else np.abs(gap).sum(-1)
    near = d <= eps
    core = near.sum(1) >= least
    return (~(near & core[None, :]).any(1)).astype(int)


def cloud(n, dims, seed):
    rng = np.random.default_rng(seed)
    tight = rng.normal(0, 0.3, (n // 2, dims))
    wide = rng.normal(0, 3, (n - n // 2, dims))
    return np.vstack([tight, wide])


@pytest.mark.parametrize(("dims", "metric", "eps"), [(1, "euclidean", 0.2), (2, "manhattan", 0.8), (5, "euclidean", 2.0)])
def test_noise_equals_brute_force(spark, dims, metric, eps):
    x = cloud(260, dims, dims)
    names = [f"f{i}" for i in range(dims)]
    df = spark.createDataFrame(pd.DataFrame(x, columns=names).assign(id=range(len(x))))
    got = density_noise(df, names, eps, 6, metric, layout=Layout(block_rows=16)).orderBy("id").toPandas()
    want = brute_noise(x, eps, 6, metric)
    assert 0 < want.sum() < len(want)
    assert got["is_anomaly"].tolist() == want.tolist()


def test_noise_grid_equals_single_runs(spark):
    x = cloud(150, 3, 9)
    configs = [(0.5, 3), (1.0, 5), (2.0, 10)]
    df = spark.createDataFrame(pd.DataFrame(x, columns=list("abc")).assign(id=range(len(x))))
    got = density_noise_grid(df, list("abc"), configs, layout=Layout(block_rows=20)).orderBy("id").toPandas()
    for i, (eps, least) in enumerate(configs):
        assert [n[i] for n in got["noise"]] == brute_noise(x, eps, least).tolist()


def test_copies_count_with_their_weight_and_border_points_are_kept(spark):
    rows = [(0.0, 0.0)] * 400 + [(0.9, 0.0), (1.7, 0.0), (50.0, 0.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    got = density_noise(df, ["a", "b"], 1.0, 5, layout=Layout(block_rows=4)).groupBy("a").agg(
        F.max("is_anomaly").alias("n"), F.count("*").alias("c")).collect()
    found = {r.a: (r.n, r.c) for r in got}
    # 0.9 has 402 neighbours and is core, 1.7 only two: a border point of 0.9.
    assert found == {0.0: (0, 400), 0.9: (0, 1), 1.7: (0, 1), 50.0: (1, 1)}


def test_forest_is_deterministic_and_finds_the_outlier(spark):
    rng = np.random.default_rng(11)
    frame = pd.DataFrame(rng.normal(size=(2000, 4)), columns=list("abcd")).assign(id=range(2000))
    frame.loc[77, list("abcd")] = 12.0
    df = spark.createDataFrame(frame)
    scores = []
    for n in (1, 7):
        part = df.repartition(n)
        forest = fit_forest(part, list("abcd"), ["id"], trees=40)
        scores.append(forest.score(part).orderBy("id").toPandas()["score"])
    pd.testing.assert_series_equal(scores[0], scores[1])
    assert scores[0].idxmax() == 77 and scores[0].between(0, 1).all()


def test_forest_prefixes_and_missing_features(spark):
    frame = pd.DataFrame({"a": [1.0, 2, 3, None], "b": [1.0, 5, 2, 2], "id": range(4)})
    df = spark.createDataFrame(frame).withColumn("a", F.nanvl("a", F.lit(None).cast("double")))
    forest = fit_forest(df, ["a", "b"], ["id"], trees=10)
    got = forest.score(df, prefixes=[5, 10]).orderBy("id").toPandas()["score"]
    assert got[3] is None and len(got[0]) == 2
    whole = forest.score(df).orderBy("id").toPandas()["score"]
    assert got[0][1] == whole[0]


def test_a_smaller_forest_is_the_start_of_a_larger_one(spark):
    for rows in (100, 5000):
        frame = pd.DataFrame(np.random.default_rng(3).random((rows, 2)), columns=["a", "b"]).assign(id=range(rows))
        df = spark.createDataFrame(frame)
        few, many = fit_forest(df, ["a", "b"], ["id"], trees=4), fit_forest(df.repartition(5), ["a", "b"], ["id"], trees=20)
        width = few.feature.shape[1]
        assert (few.feature == many.feature[:4, :width]).all() and (few.cut == many.cut[:4, :width]).all()


def test_tree_samples_are_bounded_without_repeats(spark):
    for rows, trees in ((5000, 8), (700, 10), (40, 3)):
        df = spark.range(rows).select(F.md5(F.col("id").cast("string").cast("binary")).alias("_key"), F.array(F.col("id").cast("double")).alias("_x"))
        psi = min(SAMPLE, rows)
        per_tree = _tree_samples(df, rows, psi, trees).groupBy("_tree").agg(
            F.count("*").alias("n"), F.countDistinct("_x").alias("d")).collect()
        assert sorted(r["_tree"] for r in per_tree) == list(range(trees))
        assert {(r.n, r.d) for r in per_tree} == {(psi, psi)}


def test_mean_path():
    assert mean_path(np.array([0, 1, 2])).tolist() == [0.0, 0.0, 1.0]
    assert mean_path(np.array([256]))[0] == pytest.approx(10.24, abs=0.01)


def test_contamination_share(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)], "score double")
    assert contamination_offset(df, "score", 0.05) == 95.0
    with pytest.raises(ValueError):
        contamination_offset(df, "score", 0.9)


def test_scaler_uses_population_deviation_and_unseen_hours(spark):
    df = spark.createDataFrame([(0, 1.0, 4.0), (0, 3.0, 4.0), (1, 7.0, 4.0)], "hour int, y double, k double")
    scaler = MatrixScaler.fit(df.where("hour = 0"), ["y", "k"], "y")
    got = scaler.transform(df).toPandas()
    assert got["y_scaled"].tolist() == [-1.0, 1.0, 5.0] and got["k_scaled"].tolist() == [0.0] * 3
    assert got["hour_zscore"].tolist() == [-1.0, 1.0, 0.0]
    lone = MatrixScaler.fit(df.where("hour = 1"), ["y"], "y").transform(df).toPandas()
    assert lone["hour_zscore"].tolist() == [0.0, 0.0, 0.0]


def labelled(spark, n=260):
    frame = series(n, 21)
    rng = np.random.default_rng(22)
    for c in ("Temperature", "Humidity", "Wind_Speed", "Avg_Past_Consumption"):
        frame[c] = rng.normal(size=n)
    odd = rng.random(n) < 0.06
    frame.loc[odd, "Electricity_Consumed"] += 15
    frame["Anomaly_Label"] = np.where(odd, "Abnormal", "Normal")
    return to_spark(spark, frame)


def test_matrix_has_thirteen_columns_and_drops_warm_up(spark):
    matrix = model_matrix(base_features(labelled(spark), ONE), ONE, scale=False)
    assert len(matrix.inputs) == 13 and matrix.rows.count() == 260 - 47
    assert matrix.rows.agg(F.max("row_idx")).first()[0] == 260 - 48
    dry = model_matrix(base_features(labelled(spark), ONE), ONE, scale=True, drop_weather=True)
    assert len(dry.inputs) == 11 and not any("Temperature" in c for c in dry.inputs)
    assert evaluable_rows(base_features(labelled(spark), ONE), ONE).count() == 213


def test_router(spark):
    df = labelled(spark)
    found = dt.detect(df, ONE, "Isolation_Forest ", config=dt.ForestConfig(trees=20))
    assert found.agg(F.sum("is_anomaly")).first()[0] == 11  # strictly above the 95th percentile of 213 rows
    with pytest.raises(ValueError, match="Unsupported model"):
        dt.detect(df, ONE, "svm")
    with pytest.raises(ValueError, match="Unsupported profile"):
        dt.profile_flags(df, ONE, "other")


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
def test_landmarks_prune_blocks_where_eps_spans_every_value(spark, metric):
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 1.5, (12, 14))
    x = np.vstack([c + rng.normal(0, 0.08, (60, 14)) for c in centres] + [rng.normal(0, 1.5, (30, 14))])
    eps = 1.2 if metric == "euclidean" else 4.0
    names = [f"f{i}" for i in range(14)]
    df = spark.createDataFrame(pd.DataFrame(x, columns=names).assign(id=range(len(x))))
    layout = Layout(block_rows=16)
    got = density_noise(df, names, eps, 6, metric, layout=layout).orderBy("id").toPandas()
    assert got["is_anomaly"].tolist() == brute_noise(x, eps, 6, metric).tolist() and 0 < got["is_anomaly"].sum() < len(x)
    grid = _Grid(names, [(eps, 6)], metric, layout)
    points = grid._located(df.select(F.array(*names).alias("_x"), F.lit(1).cast("long").alias("_w"), F.col("id").alias("_id")))
    left, right = grid._blocks(points.select("_id", "_x", "_y"), points.select("_id", "_x", "_y", "_w"), *grid._axes(points))
    pairs = left.cogroup(right).applyInPandas(lambda q, c: pd.DataFrame({"n": [len(q) * len(c)]}), "n long").agg(F.sum("n")).first()[0]
    assert len(x) <= pairs < 0.45 * len(x) ** 2
