"""Small series for tests."""

from __future__ import annotations

import numpy as np
import pandas as pd

from meterflow.spec import SeriesSpec

ONE = SeriesSpec(one_per_slot=True)
KEYED = SeriesSpec(series=("meter",), one_per_slot=True)


def series(n: int, seed: int = 0, meter: str | None = None, drop: float = 0.0) -> pd.DataFrame:
    """Half-hour readings; ``drop`` removes a share of the rows to leave gaps."""
    rng = np.random.default_rng(seed)
    frame = pd.DataFrame({
        "Timestamp": pd.date_range("2024-01-01", periods=n, freq="30min"),
        "Electricity_Consumed": rng.normal(10, 2, n).round(3),
    })
    if meter is not None:
        frame.insert(0, "meter", meter)
    if drop:
        frame = frame[rng.random(n) >= drop].reset_index(drop=True)
    return frame


def to_spark(spark, frame: pd.DataFrame):
    df = spark.createDataFrame(frame)
    return df.withColumn("Timestamp", df["Timestamp"].cast("timestamp_ntz")) if "Timestamp" in frame else df


def shuffled(df, n: int = 5):
    from pyspark.sql import functions as F

    return df.repartition(n, F.xxhash64("Timestamp", F.lit(n)))
