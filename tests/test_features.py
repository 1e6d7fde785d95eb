import numpy as np
import pandas as pd
import pytest
from helpers import KEYED, ONE, series, shuffled, to_spark
from pyspark.sql import functions as F

from meterflow.operators import features as ft
from meterflow.spec import Layout

TINY = Layout(bucket_slots=16, chunk_rows=50)


def test_rolling_guard(spark):
    frame = series(6).assign(Electricity_Consumed=[1.0, 2, 3, 4, 5, 6])
    got = ft.add_rolling(to_spark(spark, frame), ONE).orderBy("Timestamp").toPandas()
    assert got["rolling_mean_3h"].isna().tolist() == [True] * 5 + [False]
    assert got["rolling_mean_3h"].iloc[5] == 3.5
    assert got["rolling_std_3h"].iloc[5] == pytest.approx(1.870829, abs=1e-6)


def test_enhanced_features_match_pandas_for_any_partitioning(spark):
    frame = series(300, 7, drop=0.1)
    y = frame["Electricity_Consumed"]
    results = []
    for n in (1, 9):
        got = ft.enhanced_features(shuffled(to_spark(spark, frame), n), ONE, TINY).orderBy("Timestamp").toPandas()
        results.append(got)
        for name, rows in (("3h", 6), ("24h", 48)):
            np.testing.assert_allclose(got[f"rolling_mean_{name}"], y.rolling(rows).mean(), atol=1e-9)
            np.testing.assert_allclose(got[f"rolling_std_{name}"], y.rolling(rows).std(), atol=1e-9)
        np.testing.assert_allclose(got["consumption_diff"], y.diff(), atol=1e-12)
        np.testing.assert_allclose(got["consumption_residual_24h"], y - y.rolling(48).mean(), atol=1e-9)
        hour = frame["Timestamp"].dt.hour
        assert (got["hour"] == hour).all() and (got["day_of_week"] == frame["Timestamp"].dt.dayofweek).all()
        np.testing.assert_allclose(got["hour_sin"], np.sin(2 * np.pi * hour / 24), atol=1e-12)
    pd.testing.assert_frame_equal(results[0], results[1])


def test_lags_drop_warm_up_and_renumber(spark):
    got = ft.supervised_lags(to_spark(spark, series(50)), ONE, layout=TINY).orderBy("row_idx").toPandas()
    assert len(got) == 2 and got["row_idx"].tolist() == [0, 1]
    assert got["Electricity_Consumed_lag_48"].iloc[0] == series(50)["Electricity_Consumed"].iloc[0]


def test_null_target_drops_its_dependants(spark):
    frame = series(60)
    frame.loc[3, "Electricity_Consumed"] = None
    df = to_spark(spark, frame).withColumn("Electricity_Consumed", F.nanvl("Electricity_Consumed", F.lit(None)))
    got = ft.supervised_lags(df, ONE, layout=TINY)
    assert got.count() == 11 and got.agg(F.max("row_idx")).first()[0] == 10


def test_sequences(spark):
    rows = ft.add_calendar(to_spark(spark, series(30).assign(Temperature=1.0, Humidity=2.0)), ONE)
    got = ft.sequences(rows, ONE).orderBy("row_idx").toPandas()
    assert len(got) == 6 and {len(s) for s in got["sequence"]} == {24}
    y = series(30)["Electricity_Consumed"]
    assert got["next_step"].iloc[0][0] == y.iloc[24]
    assert [v[0] for v in got["sequence"].iloc[5]] == y.iloc[5:29].tolist()
    with pytest.raises(ValueError):
        ft.sequences(rows, ONE, length=0)
    with pytest.raises(KeyError):
        ft.sequences(to_spark(spark, series(5)), ONE)


def test_label_codes(spark):
    df = spark.createDataFrame([("Normal",), ("Abnormal",), ("Normal",)], "Anomaly_Label string")
    assert [r.label for r in ft.encode_labels(df).collect()] == [0, 1, 0]
    with pytest.raises(KeyError, match="Anomaly_Label"):
        ft.encode_labels(spark.createDataFrame([(1,)], "other int"))
    bad = spark.createDataFrame([("Normal",), ("Unknown",)], "Anomaly_Label string")
    with pytest.raises(Exception, match="Unmapped label values: Unknown"):
        ft.encode_labels(bad).collect()


def test_missing_columns_fail_without_a_job(spark):
    df = spark.createDataFrame([(1,)], "x int")
    for run in (lambda: ft.add_calendar(df), lambda: ft.add_rolling(df), lambda: ft.add_cyclical(df),
                lambda: ft.add_derivatives(df), lambda: ft.supervised_lags(df)):
        with pytest.raises(KeyError):
            run()


def test_series_do_not_leak_into_each_other(spark):
    frame = pd.concat([series(60, 1, "a"), series(60, 2, "b")])
    got = ft.add_rolling(to_spark(spark, frame), KEYED, TINY)
    assert got.where(F.col("rolling_mean_24h").isNull()).count() == 2 * 47


def test_features_of_a_range_open_only_its_days_and_a_halo(spark, tmp_path):
    import datetime as dt

    from meterflow.operators.ranges import features_between, rows_between, write_ranged

    frame = pd.concat([series(48 * 40, 1, "a"), series(48 * 40, 2, "b", drop=0.4), series(48 * 3, 3, "gone"), series(48 * 40, 4, "thin", drop=0.97)])
    whole = ft.base_features(to_spark(spark, frame), KEYED)
    path = write_ranged(to_spark(spark, frame), str(tmp_path / "t"), KEYED)
    start, end = dt.datetime(2024, 1, 30, 6, 30), dt.datetime(2024, 2, 1, 3, 0)
    got = features_between(spark, path, KEYED, start, end, lambda df: ft.base_features(df, KEYED)).toPandas()
    want = whole.where((F.col("Timestamp") >= str(start)) & (F.col("Timestamp") < str(end))).toPandas()
    order = ["meter", "Timestamp"]
    pd.testing.assert_frame_equal(got.sort_values(order).reset_index(drop=True)[want.columns], want.sort_values(order).reset_index(drop=True), atol=1e-9)
    dense = write_ranged(to_spark(spark, frame[frame["meter"] == "a"]), str(tmp_path / "d"), KEYED)
    rows = rows_between(spark, dense, KEYED, start, end)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    days = {str(r[0]) for r in rows.select(F.to_date("Timestamp")).distinct().collect()}
    assert "PartitionFilters: [isnotnull(date" in plan and days == {"2024-01-29", "2024-01-30", "2024-01-31", "2024-02-01"}
    nothing = features_between(spark, path, KEYED, dt.datetime(2030, 1, 1), dt.datetime(2030, 1, 2), lambda df: ft.base_features(df, KEYED))
    assert nothing.count() == 0
