import pandas as pd
import pytest
from helpers import KEYED, ONE, series, shuffled, to_spark
from pyspark.sql import Window
from pyspark.sql import functions as F

from meterflow.operators.ordering import windowed, with_row_index
from meterflow.spec import Layout, SeriesSpec

TINY = Layout(bucket_slots=7, chunk_rows=5)


def test_numbers_match_sorted_position_in_every_series(spark):
    frame = pd.concat([series(200, 1, "a", 0.2), series(90, 2, "b", 0.1), series(1, 3, "c")])
    got = with_row_index(shuffled(to_spark(spark, frame)), KEYED, TINY).toPandas()
    got = got.sort_values(["meter", "Timestamp"])
    assert (got["row_idx"] == got.groupby("meter").cumcount()).all()
    assert (got["series_rows"] == got.groupby("meter")["row_idx"].transform("size")).all()


def test_null_series_key_keeps_its_rows(spark):
    frame = pd.concat([series(30, 1, "a"), series(20, 2, None).assign(meter=None)])
    got = with_row_index(to_spark(spark, frame), KEYED, TINY)
    assert got.count() == 50
    assert got.where(F.col("meter").isNull()).agg(F.max("row_idx"), F.max("series_rows")).first()[:] == (19, 20)


def test_overfull_bucket_is_numbered_by_range(spark):
    # Two thirds of all rows share one timestamp, and many of those are complete copies.
    frame = series(150, 4)
    hot = frame.iloc[[70]].loc[lambda d: d.index.repeat(300)].assign(id=lambda d: range(0, 300))
    frame = pd.concat([frame.assign(id=-1), hot, hot.iloc[:40]]).reset_index(drop=True)
    spec = SeriesSpec(tiebreak=("id",))
    got = with_row_index(to_spark(spark, frame).repartition(6), spec, Layout(bucket_slots=7, bucket_limit=100)).toPandas()
    assert sorted(got["row_idx"]) == list(range(len(frame)))
    ordered = got.sort_values("row_idx")
    keys = list(zip(ordered["Timestamp"], ordered["id"]))
    assert keys == sorted(keys)


def test_range_and_bucket_numbering_agree_per_series(spark):
    frame = pd.concat([series(120, 1, "a"), series(80, 2, "b")])
    loose = SeriesSpec(series=("meter",))
    by_bucket = with_row_index(to_spark(spark, frame), KEYED, TINY).select("meter", "Timestamp", "row_idx", "series_rows")
    by_range = with_row_index(to_spark(spark, frame), loose, Layout(bucket_slots=64, bucket_limit=10)).select(by_bucket.columns)
    assert by_bucket.exceptAll(by_range).isEmpty() and by_range.exceptAll(by_bucket).isEmpty()


@pytest.mark.parametrize("back", [1, 3, 11])
def test_chunked_window_equals_plain_window(spark, back):
    frame = pd.concat([series(211, 5, "a", 0.3), series(64, 6, "b")])
    numbered = with_row_index(shuffled(to_spark(spark, frame)), KEYED, TINY)
    make = {"s": lambda w: F.sum("Electricity_Consumed").over(w.rowsBetween(-back, 0)),
            "l": lambda w: F.lag("Electricity_Consumed", back).over(w)}
    got = windowed(numbered, KEYED, make, back, TINY)
    plain = Window.partitionBy("meter").orderBy("Timestamp")
    want = numbered.withColumns({k: f(plain) for k, f in make.items()})
    assert got.columns == want.columns
    cols = ["meter", "Timestamp", F.round("s", 9), "l"]
    assert got.count() == want.count()
    assert got.select(cols).exceptAll(want.select(cols)).isEmpty()


def test_no_window_runs_over_a_whole_series(spark):
    numbered = with_row_index(to_spark(spark, series(50)), ONE, TINY)
    plan = windowed(numbered, ONE, {"l": lambda w: F.lag("Electricity_Consumed", 1).over(w)}, 1, TINY)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    # The only window without a partition key is the prefix sum over bucket counts.
    assert text.count("Window [lag(") == 1 and "[_chunk" in text
