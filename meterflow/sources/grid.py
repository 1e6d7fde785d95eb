"""Bucketing of raw events into the fixed interval grid that the operators expect."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_interval_grid(
    df: DataFrame,
    ts: str,
    aggregates: Mapping[str, Column],
    *,
    step: str = "30 minutes",
    series: Sequence[str] = (),
    out_ts: str = "Timestamp",
) -> DataFrame:
    """One row per series and occupied slot; partial aggregation runs before the shuffle."""
    slot = F.window(F.col(ts), step)["start"].alias(out_ts)
    return df.groupBy(*series, slot).agg(*[c.alias(name) for name, c in aggregates.items()])
