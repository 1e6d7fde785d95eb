"""Clean artefacts: detect, mask, interpolate, write, and compare profiles."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, SparkSession

from meterflow.operators.clean import compare_artefacts, interpolate_flagged
from meterflow.plans.detection import PROFILES, attach_flags, profile_flags
from meterflow.session import materialize
from meterflow.sources.readings import read_readings
from meterflow.sources.sinks import write_clean
from meterflow.spec import DEFAULT_LAYOUT, ROW, ROWS, Layout, SeriesSpec


def clean_readings(df: DataFrame, spec: SeriesSpec, profile: str = "legacy",
                   layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """Feature table with flagged targets interpolated; as many rows as ``df``."""
    features, flags = profile_flags(df, spec, profile, layout)
    flagged = attach_flags(features, flags, spec)
    return interpolate_flagged(flagged, spec, layout=layout).drop("is_anomaly")


def build_clean_artefact(spark: SparkSession, source: str, target: str, spec: SeriesSpec = SeriesSpec(),
                         profile: str = "legacy", file_format: str = "parquet",
                         layout: Layout = DEFAULT_LAYOUT) -> str:
    """Read readings, clean them and write the artefact; returns where it lies."""
    clean = clean_readings(read_readings(spark, source), spec, profile, layout)
    return write_clean(clean.drop(ROW, ROWS), target, ts=spec.ts, file_format=file_format)


def compare_profiles(df: DataFrame, spec: SeriesSpec, profiles: tuple[str, ...] = PROFILES,
                     layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """One row per pair of profiles on how their artefacts differ."""
    cleaned = {p: materialize(clean_readings(df, spec, p, layout)) for p in profiles}
    rows = [compare_artefacts(df, cleaned[a], cleaned[b], spec, a, b) for a, b in combinations(profiles, 2)]
    result = rows[0]
    for row in rows[1:]:
        result = result.unionByName(row)
    return result
