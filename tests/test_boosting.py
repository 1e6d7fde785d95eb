"""Boosted trees against a plain construction, and the same model however the rows are dealt."""

import numpy as np
import pandas as pd
import pytest

from meterflow.operators.boosting import BoostConfig, bin_of, fit_boosted, predictor_cuts

NAMES = ["a", "b", "c"]
SMALL = BoostConfig(trees=4, depth=3, bins=8)


def frame(n=400, seed=3):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(0, 9, n).astype(float), rng.normal(0, 1, n).round(3)
    c = np.where(rng.random(n) < 0.2, np.nan, rng.normal(0, 2, n).round(2))
    y = np.where(a > 4, 3.0, -1.0) + 2 * (b > 0.3) + np.nan_to_num(c, nan=4.0) / 4 + rng.normal(0, 0.1, n).round(3)
    return pd.DataFrame({"a": a, "b": b, "c": c, "y": y.round(4), "prediction_old": 1})


def plain(frame, model, config):
    """Rows, sums and splits of every node by direct search over rows."""
    cuts = model.cuts
    bins = np.array([[0 if np.isnan(x) else 1 + sum(c < x for c in cuts[i]) for i, x in enumerate(r)] for r in frame[NAMES].to_numpy()])
    unit = model.shape.unit
    target = np.floor(frame["y"].to_numpy() * unit + 0.5)
    base = int(target.sum()) // len(target)
    predicted = np.full(len(target), float(base))
    ledger = {}
    for t in range(config.trees):
        nodes = {1: np.arange(len(target))}
        residual = target - predicted
        while nodes:
            node, rows = nodes.popitem()
            s, n = residual[rows].sum(), len(rows)
            best = None
            if node < 1 << config.depth:
                for f in range(3):
                    for b in sorted(set(bins[rows, f]))[:-1]:
                        left = rows[bins[rows, f] <= b]
                        ls, ln = residual[left].sum(), len(left)
                        gain = (ls * ls / (ln + 1.0) + (s - ls) * (s - ls) / (n - ln + 1.0) - s * s / (n + 1.0)) / (unit * unit)
                        if gain > config.min_gain and (best is None or gain > best[0]):
                            best = (gain, f, b)
            if best:
                ledger[t, node] = (best[1], best[2], n)
                inside = bins[rows, best[1]] <= best[2]
                nodes[2 * node], nodes[2 * node + 1] = rows[inside], rows[~inside]
            else:
                ledger[t, node] = (-1, 0, n)
                predicted[rows] += np.floor(config.step * s / (n + 1.0) + 0.5)
    return ledger, predicted / unit


def splits(model):
    return {(t, int(k)): (int(tree.feature[k]), int(tree.bin[k]), int(tree.rows[k])) for t, tree in enumerate(model.trees) for k in np.flatnonzero(tree.rows)}


def test_equals_a_plain_construction_for_any_layout(spark):
    data = frame()
    df = spark.createDataFrame(data)
    model = fit_boosted(df, NAMES, "y", SMALL)
    ledger, predicted = plain(data, model, SMALL)
    assert splits(model) == ledger
    got = model.predict(df.withColumn("prediction", df["y"] * 0).drop("prediction")).toPandas()
    assert np.allclose(got["prediction"], predicted, atol=1e-12)
    dealt = fit_boosted(df.repartition(7, "b"), NAMES, "y", SMALL, block_rows=0)
    assert splits(dealt) == ledger and all((a.value == b.value).all() for a, b in zip(dealt.trees, model.trees))


def test_predictions_are_stored_between_trees(spark):
    df = spark.createDataFrame(frame(150)).repartition(3)
    config = BoostConfig(trees=12, depth=1, bins=4)
    here, over = (fit_boosted(df, NAMES, "y", config, block_rows=k) for k in (1000, 0))
    assert splits(here) == splits(over) and all((a.value == b.value).all() for a, b in zip(here.trees, over.trees))


def test_ledger_learning_and_edge_cases(spark):
    data = frame()
    df = spark.createDataFrame(data)
    model = fit_boosted(df, NAMES, "y")
    errors = model.predict(df).toPandas().eval("(y - prediction) ** 2").mean()
    assert errors < 0.02 * data["y"].var()
    ledger = model.ledger(spark).toPandas()
    assert set(ledger["tree"]) == set(range(100)) and (ledger.loc[ledger["feature"].notna(), "gain"] > 0).all()
    children = ledger[ledger["node"] > 1].groupby(["tree", ledger["node"] // 2])["rows"].sum()
    inner = ledger[ledger["feature"].notna()].set_index(["tree", "node"])["rows"]
    assert (children.rename_axis(["tree", "node"]).sort_index() == inner.sort_index()).all()
    constant = fit_boosted(spark.createDataFrame([(1.0, 5.0)] * 9, "a double, y double"), ["a"], "y", BoostConfig(trees=2))
    assert constant.predict(spark.createDataFrame([(None, 0.0)], "a double, y double")).first()["prediction"] == 5.0
    with pytest.raises(ValueError, match="no training rows"):
        fit_boosted(df.where("false"), NAMES, "y")


def test_bins(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (1.0,), (2.0,), (2.5,), (9.0,)], "x double")
    assert [r[0] for r in df.select(bin_of("x", [1.0, 2.0])).collect()] == [0, 0, 1, 2, 3, 3]
    assert predictor_cuts(df, ["x"], 2) == [[2.25]]
