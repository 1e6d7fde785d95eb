import numpy as np
import pandas as pd
import pytest
from helpers import KEYED, ONE, series, shuffled, to_spark
from pyspark.sql import functions as F

from meterflow.operators import forecast as fc
from meterflow.operators.splits import forecast_split
from meterflow.plans import forecasting as plan
from meterflow.session import scratch_path
from meterflow.sources.grid import to_interval_grid
from meterflow.sources.readings import read_clean, read_readings
from meterflow.sources.sinks import write_clean, write_predictions
from meterflow.spec import Layout

TINY = Layout(bucket_slots=64, chunk_rows=60)
Y = "Electricity_Consumed"


def split_rows(spark, frame, spec=ONE):
    return forecast_split(shuffled(to_spark(spark, frame)), spec, layout=TINY)


def test_naive_closes_the_validation_gap(spark):
    frame = series(400, 1)
    got = fc.seasonal_naive(split_rows(spark, frame), ONE, layout=TINY).orderBy("Timestamp").toPandas()
    y = frame[Y].to_numpy()
    train, test = y[:280], y[340:]
    want = np.concatenate([train, test])[280 - 48:280 - 48 + 60]
    np.testing.assert_array_equal(got["y_pred"], want)
    np.testing.assert_array_equal(got["y_true"], test)
    whole = fc.seasonal_naive(split_rows(spark, frame), ONE, history="all", layout=TINY).orderBy("Timestamp").toPandas()
    np.testing.assert_array_equal(whole["y_pred"], y[340 - 48:400 - 48])


def test_naive_rejects_bad_input(spark):
    rows = split_rows(spark, series(60))
    with pytest.raises(ValueError):
        fc.seasonal_naive(rows, ONE, season=0)
    with pytest.raises(ValueError):
        fc.seasonal_naive(rows, ONE, history="none")
    with pytest.raises(Exception, match="shorter than the season"):
        fc.seasonal_naive(rows, ONE).collect()


def test_additive_fit_equals_least_squares_per_series(spark):
    frame = pd.concat([series(500, 2, "a"), series(300, 3, "b", 0.1)])
    model = fc.AdditiveModel(changepoints=3, weekly_order=1, daily_order=2)
    got = fc.additive_forecast(split_rows(spark, frame, KEYED), KEYED, model, TINY).toPandas()
    for meter, part in frame.groupby("meter"):
        n = len(part)
        a, b = int(n * 0.7), int(n * (0.7 + 0.15))
        s = (part["Timestamp"] - pd.Timestamp("1970-01-01")).dt.total_seconds().to_numpy()
        t = (s - s[0]) / (s[a - 1] - s[0])
        knots = [0.8 * j / 3 for j in (1, 2, 3)]
        cols = [np.ones(n), t, *[np.maximum(t - k, 0) for k in knots]]
        for period, order in ((86400, 2), (7 * 86400, 1)):
            for k in range(1, order + 1):
                cols += [np.sin(2 * np.pi * k * s / period), np.cos(2 * np.pi * k * s / period)]
        x = np.column_stack(cols)
        y = part[Y].to_numpy()
        size = np.sqrt((y[:a] ** 2).mean())
        steps = np.diff(y[:a] / size)[::2]
        noise = (steps ** 2).mean() / 2
        lasso, ridge = (noise * np.array(p) for p in model.shrinkage)
        w = np.zeros(x.shape[1])
        for _ in range(20_000):  # plain proximal steps
            step = 1 / (np.linalg.eigvalsh(x[:a].T @ x[:a]).max() + ridge.max())
            v = w - step * (x[:a].T @ (x[:a] @ w - y[:a] / size) + ridge * w)
            w = np.sign(v) * np.maximum(np.abs(v) - step * lasso, 0)
        w *= size
        mine = got[got["meter"] == meter].sort_values("Timestamp")["y_pred"]
        np.testing.assert_allclose(mine, (x @ w)[b:], atol=1e-4)


def test_shrunk_weights_are_optimal_and_sparse():
    from meterflow.operators.shrinkage import optimality, shrunk_weights

    rng = np.random.default_rng(8)
    for trial in range(30):
        x = rng.normal(size=(60, 12))
        x[:, 5] = x[:, 4] + 1e-3 * rng.normal(size=60)
        x[:, 7] = 0
        y = 3 * x[:, 0] - 2 * x[:, 4] + rng.normal(size=60)
        l1, l2 = np.full(12, 8.0 * (trial % 3)), np.full(12, 0.5 * (trial % 2))
        l1[0] = 0
        w = shrunk_weights(x.T @ x, x.T @ y, l1, l2)
        assert optimality(x.T @ x, x.T @ y, l1, l2, w).max() < 1e-9 and w[7] == 0
        if trial % 3 == 2:
            assert (w == 0).sum() >= 3


def test_additive_trend_change_is_found(spark):
    frame = series(1500, 4, "a")
    t = np.arange(1500)
    frame[Y] = 20 + np.maximum(t - 500, 0) * 0.05 + np.random.default_rng(2).normal(0, 0.2, 1500)
    split = split_rows(spark, frame, KEYED)
    train = split.where("split = 'train'")
    got = fc.additive_forecast(split, KEYED, layout=TINY).toPandas()
    assert (got["y_pred"] - got["y_true"]).abs().mean() < 2 and train.count() == 1050


def test_window_moments_equal_the_laid_out_windows(spark):
    rng = np.random.default_rng(7)
    for n, f, length, first, last in ((40, 3, 5, 5, 40), (30, 2, 1, 4, 20), (25, 1, 6, 6, 7)):
        x = rng.normal(size=(n, f))
        laid = np.array([[*x[j - length:j].ravel(), x[j, 0], 1.0] for j in range(first, last)])
        np.testing.assert_allclose(fc._lagged_moments(x, first, last, length), laid.T @ laid, atol=1e-9)
    frame = pd.concat([daily_wave(300).assign(meter="a"), daily_wave(220).assign(meter="b")])
    df = to_spark(spark, frame)
    samples = fc.window_samples(df, KEYED, [Y, "Temperature"], 4, TINY)
    model = fc.window_regression_fit(samples, [Y, "Temperature"], 4, penalty=0.0)
    rows, wanted = [], []
    for _, part in frame.groupby("meter"):
        x = part[[Y, "Temperature"]].to_numpy()
        for i in range(int((len(x) - 4) * 0.7)):
            rows.append([*x[i:i + 4].ravel(), 1.0])
            wanted.append(x[i + 4, 0])
    w = np.linalg.lstsq(np.array(rows), np.array(wanted), rcond=None)[0]
    np.testing.assert_allclose([*model.weights.ravel(), model.intercept], w, atol=1e-8)
    got = fc.window_regression_predict(samples, KEYED, model).toPandas()
    assert len(got) == (296 - int(296 * 0.85)) + (216 - int(216 * 0.85))
    part = frame[frame["meter"] == "b"].reset_index(drop=True)
    row = got[got["meter"] == "b"].sort_values("Timestamp").iloc[-1]
    at = part.index[part["Timestamp"] == row["Timestamp"]][0]
    assert row["y_pred"] == pytest.approx(np.dot([*part[[Y, "Temperature"]].to_numpy()[at - 4:at].ravel(), 1.0], w))


def daily_wave(n=480):
    frame = series(n, 5)
    t = np.arange(n)
    frame[Y] = 10 + 3 * np.sin(2 * np.pi * t / 48) + np.random.default_rng(1).normal(0, 0.5, n)
    return frame.assign(Temperature=1.0 * (t % 7), Humidity=1.0 * (t % 5))


def test_learned_models_beat_the_floor_on_a_daily_wave(spark):
    from meterflow.operators.features import add_calendar

    rows = add_calendar(to_spark(spark, daily_wave()), ONE)
    cards = {r.model: r for r in plan.ladder(rows, ONE, ("naive", "prophet", "lstm"), trees=3).collect()}
    assert cards["prophet"].beats_floor and cards["lstm"].beats_floor and cards["naive"].beats_floor is None
    assert cards["naive"].rows == 72 and cards["lstm"].rows == 69
    with pytest.raises(ValueError, match="Unsupported model"):
        plan.run_forecast(rows, ONE, "arima")


def test_boosted_forecast_and_importance(spark):
    from meterflow.operators.boosting import importance
    from meterflow.operators.features import add_calendar

    rows = add_calendar(to_spark(spark, daily_wave()), ONE)
    lags = fc.boosted_frame(rows, ONE)
    names = fc.boosted_features(Y)
    ledger = fc.boosted_fit(lags, ONE, 5).ledger(spark)
    table = importance(ledger, names).collect()
    assert len(table) == 9 and [r.importance for r in table] == sorted(r.importance for r in table)
    assert {r.feature for r in table if r.importance == 0} >= {"month"}
    assert sum(r.splits for r in table) == ledger.where("feature is not null").count()
    assert fc.boosted_forecast(rows, ONE, trees=2).count() == 65


def raw_frame(n=4):
    frame = series(n)
    for c in ("Temperature", "Humidity", "Wind_Speed", "Avg_Past_Consumption"):
        frame[c] = 0.5
    return frame.assign(Anomaly_Label="Normal")


def test_csv_round_trip_and_order_of_columns(spark, tmp_path):
    frame = raw_frame().assign(Timestamp=lambda d: d["Timestamp"].dt.strftime("%Y-%m-%d %H:%M:%S"))
    frame = frame[[*frame.columns[::-1]]]
    frame.loc[1, Y] = None
    frame.to_csv(tmp_path / "a.csv", index=False)
    got = read_readings(spark, str(tmp_path))
    assert dict(got.dtypes)["Timestamp"] == "timestamp_ntz" and dict(got.dtypes)[Y] == "double"
    assert got.count() == 4 and got.where(F.col(Y).isNull()).count() == 1


def test_csv_faults(spark, tmp_path):
    raw_frame().assign(Timestamp="2024/01/01 00:00").to_csv(tmp_path / "bad.csv", index=False)
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP|cannot be parsed|could not be parsed"):
        read_readings(spark, str(tmp_path / "bad.csv")).collect()
    raw_frame().drop(columns="Timestamp").to_csv(tmp_path / "none.csv", index=False)
    with pytest.raises(ValueError, match="Timestamp"):
        read_readings(spark, str(tmp_path / "none.csv"))
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        read_readings(spark, str(tmp_path / "missing.csv"))


def test_clean_artefact_is_pruned_by_date(spark):
    df = to_spark(spark, raw_frame(200))
    path = write_clean(df, scratch_path(spark, "t"))
    day = read_clean(spark, path).where("date = DATE'2024-01-02'")
    assert day.count() == 48
    assert "PartitionFilters: [isnotnull(date" in day._jdf.queryExecution().executedPlan().toString()
    csv = read_clean(spark, write_clean(df, scratch_path(spark, "t"), file_format="csv"), file_format="csv")
    assert csv.count() == 200 and dict(csv.dtypes)[Y] == "double"
    with pytest.raises(KeyError):
        write_predictions(df, scratch_path(spark, "t"))


def test_interval_grid(spark):
    rows = [("2024-01-01 00:00:01", 1.0), ("2024-01-01 00:29:59", 3.0), ("2024-01-01 00:30:00", 5.0)]
    df = spark.createDataFrame(rows, "t string, v double").select(F.to_timestamp_ntz("t").alias("t"), "v")
    got = to_interval_grid(df, "t", {"m": F.avg("v")}).orderBy("Timestamp").collect()
    assert [(r.Timestamp.minute, r.m) for r in got] == [(0, 2.0), (30, 5.0)]
