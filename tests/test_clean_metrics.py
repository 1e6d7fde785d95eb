import numpy as np
import pandas as pd
import pytest
from helpers import KEYED, ONE, series, shuffled, to_spark
from pyspark.sql import functions as F

from meterflow.operators import metrics as mt
from meterflow.operators.clean import compare_artefacts, interpolate_flagged
from meterflow.spec import Layout

TINY = Layout(bucket_slots=8, chunk_rows=4)
Y = "Electricity_Consumed"


def frame_of(minutes, values, flags):
    start = pd.Timestamp("2024-01-01")
    return pd.DataFrame({"Timestamp": [start + pd.Timedelta(minutes=m) for m in minutes], Y: values,
                         "is_anomaly": pd.array(flags, dtype="Int64")})


def filled(spark, frame, spec=ONE, layout=TINY):
    flag = F.nanvl(F.col("is_anomaly").cast("double"), F.lit(None).cast("double")).cast("int")
    df = to_spark(spark, frame).withColumn("is_anomaly", flag)
    df = df.withColumn(Y, F.nanvl(Y, F.lit(None).cast("double")))
    return interpolate_flagged(df, spec, layout=layout).orderBy("Timestamp").toPandas()


def test_elapsed_time_not_position(spark):
    assert filled(spark, frame_of([0, 30, 90], [0.0, 5.0, 9.0], [0, 1, 0]))[Y].tolist() == [0.0, 3.0, 9.0]


def test_edges(spark):
    got = filled(spark, frame_of([0, 30, 60, 90], [9.0, 1.0, 2.0, 9.0], [1, 0, 0, 1]))[Y]
    assert np.isnan(got[0]) and got.tolist()[1:] == [1.0, 2.0, 2.0]


def test_without_flags_old_blanks_stay_and_with_one_they_fill(spark):
    blank = frame_of([0, 30, 60, 90], [1.0, np.nan, 3.0, 4.0], [0, 0, 0, 0])
    assert np.isnan(filled(spark, blank)[Y][1])
    blank["is_anomaly"] = pd.array([0, 0, 0, 1], dtype="Int64")
    assert filled(spark, blank)[Y].tolist() == [1.0, 2.0, 3.0, 3.0]


def test_unscored_rows_are_kept_and_bad_flags_fail(spark):
    got = filled(spark, frame_of([0, 30, 60], [1.0, 2.0, 4.0], [None, 1, 0]))
    assert got[Y].tolist() == [1.0, 2.5, 4.0]
    with pytest.raises(Exception, match="flags must be 0 or 1"):
        filled(spark, frame_of([0, 30], [1.0, 2.0], [0, 2]))


def test_gaps_over_many_chunks_match_pandas(spark):
    rng = np.random.default_rng(8)
    parts = []
    for meter, n in (("a", 150), ("b", 60), ("c", 20)):
        frame = series(n, n, meter, 0.15)
        flags = (rng.random(len(frame)) < 0.3).astype(int)
        flags[20:47] = 1  # spans several chunks
        if meter == "c":
            flags[:] = 0
        parts.append(frame.assign(is_anomaly=flags))
    frame = pd.concat(parts).reset_index(drop=True)
    got = interpolate_flagged(shuffled(to_spark(spark, frame)), KEYED, layout=TINY).toPandas()
    assert len(got) == len(frame)
    for meter, part in frame.groupby("meter"):
        y = part.set_index("Timestamp")[Y].mask(part.set_index("Timestamp")["is_anomaly"] == 1)
        want = y.interpolate(method="time") if part["is_anomaly"].any() else part.set_index("Timestamp")[Y]
        mine = got[got["meter"] == meter].set_index("Timestamp")[Y].sort_index()
        np.testing.assert_allclose(mine, want, atol=1e-9)


def test_compare_artefacts(spark):
    base = to_spark(spark, series(6).assign(**{Y: [1.0, 2, 3, 4, 5, 6]}))
    a = to_spark(spark, series(6).assign(**{Y: [1.0, 9, 9, 4, 5, 6]}))
    b = to_spark(spark, series(6).assign(**{Y: [1.0, 2, 8, 7, 5, 6]}))
    got = compare_artefacts(base, a, b, ONE).first()
    assert (got.imputed_rows_a, got.imputed_rows_b, got.disagree_rows) == (2, 2, 2)
    assert (got.jaccard_imputed, got.max_abs_diff_imputed) == (pytest.approx(1 / 3), 1.0)
    assert (got.top_disagree_hour, got.top_disagree_hour_count) == (0, 1)
    same = compare_artefacts(base, base, base, ONE).first()
    assert (same.jaccard_imputed, same.top_disagree_hour, same.top_disagree_hour_count) == (0.0, -1, 0)
    assert (got.unmatched_rows, same.unmatched_rows) == (0, 0)
    short = compare_artefacts(base, a, b.where(F.col(Y) != 8), ONE).first()  # the third row is missing
    assert (short.unmatched_rows, short.imputed_rows_a, short.imputed_rows_b) == (1, 1, 1)


def detections(spark, rows):
    return spark.createDataFrame(rows, "hour int, label int, is_anomaly int").withColumn("split", F.lit("test")) \
        .withColumn("is_weekend", F.lit(0))


def test_detection_scorecard(spark):
    df = detections(spark, [(0, 0, 0), (0, 0, 1), (0, 1, 1), (0, 1, 0)])
    got = mt.detection_scorecard(df).first()
    assert (got.tn, got.fp, got.fn, got.tp, got.precision, got.recall, got.f1) == (1, 1, 1, 1, 0.5, 0.5, 0.5)
    none = mt.detection_scorecard(detections(spark, [(0, 1, 0), (0, 0, 0)])).first()
    assert (none.precision, none.recall, none.f1) == (0.0, 0.0, 0.0)
    with pytest.raises(Exception, match="labels and flags must be 0 or 1"):
        mt.detection_scorecard(detections(spark, [(0, 2, 0), (0, 0, 0)])).collect()
    with pytest.raises(ValueError):
        mt.assert_detectable(df.limit(0))


def test_confusion_by_hour_and_false_positive_rate(spark):
    rows = [(0, 0, 1), (0, 1, 1), (1, 0, 1), (1, 0, 0), (1, 1, 0)]
    got = {r.hour: r for r in mt.confusion_by_hour(detections(spark, rows)).collect()}
    assert (got[0].fp, got[0].tp, got[0].fn) == (1, 1, 0) and (got[1].fp, got[1].fn, got[1].tp) == (1, 1, 0)
    rate = mt.false_positives_by_hour(detections(spark, [(2, 0, 1), (2, 0, 1), (2, 0, 0), (2, 1, 0)])).first()
    assert (rate.fp, rate.normal_rows, rate.fp_rate) == (2, 3, pytest.approx(2 / 3))
    only = mt.false_positives_by_hour(detections(spark, [(3, 1, 1)])).first()
    assert only.fp_rate is None


def test_segments_need_enough_rows(spark):
    rows = [(0, 1, 1)] * 30 + [(1, 1, 0)] * 29
    got = mt.segment_table(detections(spark, rows)).collect()
    assert {(r.segmentation, r.segment): r.n for r in got} == {("hour", "0"): 30, ("day_kind", "weekday"): 59}


def test_forecast_scores(spark):
    df = spark.createDataFrame([("m", 0.0, 1.0), ("m", 2.0, 1.0)], "model string, y_true double, y_pred double")
    got = mt.forecast_scorecard(df).first()
    assert (got.mae, got.rmse) == (1.0, 1.0) and got.mape == pytest.approx((1e8 + 0.5) / 2 * 100)
    with pytest.raises(ValueError):
        mt.mape(floor=0)
    with pytest.raises(ValueError):
        mt.assert_scorable(df.limit(0))
    floor = spark.createDataFrame([("naive", 1.0, 2.0), ("x", 0.5, 2.0), ("y", 0.5, 1.0)], "model string, mae double, rmse double")
    words = {r.model: (r.mae_vs_floor, r.rmse_vs_floor, r.beats_floor) for r in mt.compare_to_floor(floor).collect()}
    assert words == {"x": ("beats", "matches", False), "y": ("beats", "beats", True)}
