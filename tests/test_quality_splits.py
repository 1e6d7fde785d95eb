import pandas as pd
import pytest
from helpers import ONE, series, to_spark
from pyspark.sql import functions as F

from meterflow.operators import quality as ql
from meterflow.operators.splits import cut_points, forecast_split, tuning_split
from meterflow.spec import SeriesSpec

ANY = SeriesSpec()


def test_clean_grid_passes(spark):
    got = ql.time_continuity(to_spark(spark, series(100)), ANY).first()
    assert (got.verdict, got.missing, got.duplicates, got.irregular, got.expected) == ("PASS", 0, 0, 0, 100)


def test_dropped_and_duplicated_slot(spark):
    frame = series(20)
    frame = pd.concat([frame.drop(index=7), frame.iloc[[12]]])
    got = ql.time_continuity(to_spark(spark, frame), ANY).first()
    assert (got.missing, got.duplicates, got.verdict) == (1, 1, "REVIEW")
    assert got.irregular == 2  # one double step and one zero step
    missing = ql.missing_slots(to_spark(spark, frame), ANY).collect()
    assert [r.missing_ts for r in missing] == [series(20)["Timestamp"].iloc[7].to_pydatetime()]


def test_off_grid_time_is_not_counted_as_present(spark):
    frame = series(6)
    frame.loc[3, "Timestamp"] += pd.Timedelta("7min")
    got = ql.time_continuity(to_spark(spark, frame), ANY).first()
    assert (got.missing, got.duplicates, got.irregular) == (1, 0, 2)
    assert ql.missing_slots(to_spark(spark, frame), ANY).first()[0] == series(6)["Timestamp"].iloc[3].to_pydatetime()


def test_first_ten_missing(spark):
    frame = series(100).drop(index=[*range(5, 11), *range(50, 70)])
    got = [r[0] for r in ql.missing_slots(to_spark(spark, frame), ANY).collect()]
    full = series(100)["Timestamp"]
    assert got == [full.iloc[i].to_pydatetime() for i in [*range(5, 11), *range(50, 54)]]


def test_readiness(spark):
    df = to_spark(spark, series(30))
    assert ql.readiness(df, ANY, expected_rows=30).first().ready
    assert ql.assert_ready(df, ANY, 30) is df
    with pytest.raises(ValueError, match="not forecast-ready"):
        ql.assert_ready(df, ANY, 31)


@pytest.mark.parametrize(("n", "sizes"), [(4953, (2971, 991, 991))])
def test_tuning_cut_points(spark, n, sizes):
    a, b = cut_points(n, 0.6, 0.2)
    assert (a, b - a, n - b) == sizes
    got = tuning_split(to_spark(spark, series(n)), ONE).groupBy("split").agg(
        F.count("*").alias("n"), F.min("row_idx").alias("a"), F.max("row_idx").alias("b")).collect()
    found = {r.split: (r.n, r.a, r.b) for r in got}
    assert found == {"train": (2971, 0, 2970), "val": (991, 2971, 3961), "test": (991, 3962, 4952)}


def test_forecast_cut_points_truncate_doubles(spark):
    assert cut_points(1440, 0.7, 0.15) == (1007, 1224)
    got = forecast_split(to_spark(spark, series(1440)), ONE).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in got} == {"train": 1007, "val": 217, "test": 216}


def test_bad_ratios_and_short_series(spark):
    df = to_spark(spark, series(3))
    for train, val in ((0, 0.1), (0.9, 0.1), (1.2, 0.1)):
        with pytest.raises(ValueError):
            forecast_split(df, ONE, train, val)
    with pytest.raises(ValueError):
        tuning_split(df, ONE, 0.8, 0.2)
    with pytest.raises(Exception, match="empty split part"):
        forecast_split(df, ONE).collect()


def test_schema_summary(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (3, None)], "a int, b string")
    got = {r["column"]: (r["dtype"], r["nulls"], r["rows"]) for r in ql.schema_summary(df).collect()}
    assert got == {"a": ("int", 0, 3), "b": ("string", 2, 3)}


def test_split_adjacency_sees_a_gap(spark):
    frame = series(100).drop(index=70)
    got = ql.split_adjacency(forecast_split(to_spark(spark, frame), ONE), ONE).first()
    assert (got.train_rows, got.val_rows, got.test_rows) == (69, 15, 15)
    assert got.val_test_adjacent and got.train_val_adjacent
    frame = series(100).drop(index=69)
    got = ql.split_adjacency(forecast_split(to_spark(spark, frame), ONE), ONE).first()
    assert not got.train_val_adjacent
