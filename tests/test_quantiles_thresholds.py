import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from meterflow.operators import thresholds as th
from meterflow.operators.quantiles import bracketed_quantiles, exact_quantiles
from meterflow.spec import Layout

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.95, 0.99, 1.0]


@pytest.mark.parametrize("kind", ["normal", "copies", "few"])
def test_bracketed_quantiles_are_exact(spark, kind):
    rng = np.random.default_rng(3)
    values = {"normal": rng.normal(size=20_000), "few": np.array([3.0, 1.0, 2.0]),
              "copies": np.where(rng.random(20_000) < 0.4, 1.5, rng.normal(size=20_000))}[kind]
    df = spark.createDataFrame(pd.DataFrame({"v": values})).repartition(7)
    got = bracketed_quantiles(df, "v", PROBS, accuracy=200).first()["quantiles"]
    np.testing.assert_allclose(got, np.quantile(values, PROBS), atol=1e-12)


def test_grouped_quantiles_both_ways(spark):
    rng = np.random.default_rng(4)
    frame = pd.DataFrame({"g": rng.integers(0, 3, 9_000), "v": rng.exponential(size=9_000).round(2)})
    df = spark.createDataFrame(frame)
    for layout in (Layout(), Layout(exact_limit=10)):
        got = {r["g"]: r["quantiles"] for r in exact_quantiles(df, "v", PROBS, ["g"], layout).collect()}
        for g, part in frame.groupby("g"):
            np.testing.assert_allclose(got[g], np.quantile(part["v"], PROBS), atol=1e-12)


def scores(spark, values, labels):
    return spark.createDataFrame(list(zip(values, labels)), "score double, label int")


def test_best_threshold(spark):
    got = th.best_threshold(scores(spark, [0.1, 0.2, 0.3, 0.4], [0, 0, 1, 1]), "score").first()
    assert (got.threshold, got.f1, got.tp, got.fp) == (0.3, 1.0, 2, 0)


def test_lowest_threshold_wins_a_tie(spark):
    got = th.best_threshold(scores(spark, [0.1, 0.2, 0.3], [1, 1, 0]), "score").first()
    best = max(2 * 2 / (2 * 2 + 1), 0)
    assert (got.threshold, got.f1) == (0.1, pytest.approx(best))
    none = th.best_threshold(scores(spark, [0.1, 0.2], [0, 0]), "score").first()
    assert (none.threshold, none.f1) == (0.1, 0.0)


def test_threshold_search_matches_brute_force(spark):
    rng = np.random.default_rng(5)
    values = rng.normal(size=500).round(6)
    labels = (values + rng.normal(size=500) > 1.2).astype(int)
    candidates = np.unique(np.quantile(values, np.linspace(0.01, 0.99, 100)))

    def f1(t):
        p = values >= t
        tp = (p & (labels == 1)).sum()
        return 2 * tp / (p.sum() + labels.sum())
    best = max(candidates, key=lambda t: (f1(t), -t))
    got = th.best_threshold(scores(spark, values.tolist(), labels.tolist()).repartition(6), "score").first()
    assert got.threshold == pytest.approx(best, abs=1e-12) and got.f1 == pytest.approx(f1(best))


def test_empty_scores(spark):
    with pytest.raises(ValueError):
        th.best_threshold(scores(spark, [], []), "score")


def test_min_max(spark):
    constant = th.min_max(scores(spark, [2.0, 2.0], [0, 1]), "score")
    assert [r.score_norm for r in constant.collect()] == [0.0, 0.0]
    spread = th.min_max(scores(spark, [1.0, 3.0, 2.0], [0, 1, 1]), "score")
    assert [r.score_norm for r in spread.collect()] == [0.0, 1.0, 0.5]


def test_ensembles(spark):
    df = spark.createDataFrame([(1, 0, 0.8), (1, 1, 0.5), (0, 1, 0.2)], "f int, d int, n double")
    flags = df.select(*[th.ensemble_flag(s, "f", "d", "n").alias(s) for s in th.STRATEGIES]).toPandas()
    assert flags["union"].tolist() == [1, 1, 1] and flags["intersection"].tolist() == [0, 1, 0]
    assert flags["weighted"].tolist() == [1, 1, 0]
    with pytest.raises(ValueError):
        th.ensemble_flag("vote", "f", "d", "n")
    assert df.select(F.sum(th.flag_at("n", 0.5))).first()[0] == 2
