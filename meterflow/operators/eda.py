"""Aggregates behind exploratory charts: profiles, correlations, histograms, densities, boxes."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterflow.functions.checks import require_columns
from meterflow.operators.quantiles import exact_quantiles
from meterflow.operators.joins import lookup
from meterflow.spec import DEFAULT_LAYOUT, LABEL, NUMERIC_COLUMNS, Layout, SeriesSpec

HISTOGRAM_FEATURES = NUMERIC_COLUMNS[:4]


def hourly_means(df: DataFrame, spec: SeriesSpec, top: int | None = None) -> DataFrame:
    """Mean target per hour; with ``top``, only the highest hours."""
    means = df.groupBy(F.hour(spec.ts).alias("hour")).agg(F.avg(spec.target).alias("mean"))
    return means if top is None else means.orderBy(F.desc("mean"), "hour").limit(top)


def peak_hour(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """The hour with the highest mean, the lowest hour on ties."""
    best = F.max_by(F.struct("hour", "mean"), F.struct("mean", -F.col("hour")))
    return hourly_means(df, spec).agg(best.alias("b")).select("b.hour", "b.mean")


def weekend_means(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    weekend = F.weekday(spec.ts) >= 5
    return df.agg(F.avg(F.when(~weekend, F.col(spec.target))).alias("weekday_mean"),
                  F.avg(F.when(weekend, F.col(spec.target))).alias("weekend_mean"))


def day_of_week_means(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    return df.groupBy(F.weekday(spec.ts).alias("day_of_week"), F.date_format(spec.ts, "EEEE").alias("day_name")) \
        .agg(F.avg(spec.target).alias("mean"))


def correlations(df: DataFrame, features: Sequence[str] = NUMERIC_COLUMNS) -> DataFrame:
    """Pearson correlation of every pair of features, from one aggregation over the table."""
    require_columns(df, features, ValueError)
    pairs = [(i, j) for i in range(len(features)) for j in range(i + 1, len(features))]
    # Rows lacking either value are left out pair by pair.
    one = df.agg(*[F.corr(features[i], features[j]).alias(f"r{i}_{j}") for i, j in pairs],
                 *[F.stddev_pop(f).alias(f"s{i}") for i, f in enumerate(features)])

    def entry(i: int, j: int) -> Column:
        own = F.when(F.col(f"s{i}") > 0, F.lit(1.0))
        value = own if i == j else F.col(f"r{min(i, j)}_{max(i, j)}")
        return F.struct(F.lit(features[i]).alias("feature_a"), F.lit(features[j]).alias("feature_b"),
                        value.alias("corr"))

    cells = [entry(i, j) for i in range(len(features)) for j in range(len(features))]
    return one.select(F.inline(F.array(*cells)))


def correlation_with(df: DataFrame, target: str, features: Sequence[str] = NUMERIC_COLUMNS) -> DataFrame:
    """Correlation of every feature with the target, strongest first."""
    return (correlations(df, features).where(F.col("feature_a") == target)
            .select(F.col("feature_b").alias("feature"), "corr").orderBy(F.desc("corr"), "feature"))


def label_distribution(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Count and percent of each label and how many times it exceeds the rarest one."""
    require_columns(df, [label])
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("rows"))
    return counts.select("label", "rows",
                         (F.col("rows") * 100.0 / counts.agg(F.sum("rows")).scalar()).alias("percent"),
                         (F.col("rows") / counts.agg(F.min("rows")).scalar()).alias("ratio_to_rarest"))


def _bounds(df: DataFrame, features: Sequence[str]) -> dict[str, tuple[float, float, float, int]]:
    """Minimum, maximum, deviation and count of every feature (one row)."""
    row = df.agg(*[f(c).alias(f"{n}{i}") for i, c in enumerate(features)
                   for n, f in (("lo", F.min), ("hi", F.max), ("sd", F.stddev_samp), ("n", F.count))]).first()
    return {c: (row[f"lo{i}"], row[f"hi{i}"], row[f"sd{i}"], row[f"n{i}"]) for i, c in enumerate(features)}


def _long(df: DataFrame, features: Sequence[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in features])
    return df.select(F.inline(pairs)).where(F.col("value").isNotNull())


def histograms(df: DataFrame, features: Sequence[str] = HISTOGRAM_FEATURES, bins: int = 30) -> DataFrame:
    """Equal-width bins over each feature's range; empty bins are listed with 0 rows."""
    require_columns(df, features, ValueError)
    bounds = _bounds(df, features)
    lo, width = _per_feature({c: b[0] for c, b in bounds.items()}), _per_feature(
        {c: (b[1] - b[0]) / bins for c, b in bounds.items() if b[0] is not None})
    place = F.least(F.floor((F.col("value") - lo) / width), F.lit(bins - 1)).cast("int")
    counted = (_long(df, features)
               .groupBy("feature", F.when(width > 0, place).otherwise(0).alias("bin"))
               .agg(F.count(F.lit(1)).alias("rows")))
    spark = df.sparkSession
    frame = [(c, i, b[0] + i * (b[1] - b[0]) / bins, b[0] + (i + 1) * (b[1] - b[0]) / bins)
             for c, b in bounds.items() if b[0] is not None for i in range(bins)]
    every = spark.createDataFrame(frame, "feature string, bin int, left_edge double, right_edge double")
    return (every.join(counted, ["feature", "bin"], "left")
            .select("feature", "bin", "left_edge", "right_edge", F.coalesce("rows", F.lit(0)).alias("rows")))


def _per_feature(values: dict[str, float]) -> Column:
    c = F.lit(None).cast("double")
    for name, value in values.items():
        c = F.when(F.col("feature") == name, F.lit(float(value))).otherwise(c)
    return c


def densities(df: DataFrame, features: Sequence[str] = HISTOGRAM_FEATURES, points: int = 200) -> DataFrame:
    """Gaussian kernel density of every feature at evenly spaced points over its range.

    Bandwidth by Scott's rule, ``deviation * n ** (-1/5)``. Equal values are counted first. Each task then
    sums the weighted kernels of its own values, and the shuffle carries one number per feature and point.
    """
    require_columns(df, features, ValueError)
    bounds = {c: b for c, b in _bounds(df, features).items() if b[3] > 1 and b[2] > 0}
    lo = _per_feature({c: b[0] for c, b in bounds.items()})
    step = _per_feature({c: (b[1] - b[0]) / (points - 1) for c, b in bounds.items()})
    width = _per_feature({c: b[2] * b[3] ** -0.2 for c, b in bounds.items()})
    rows = _per_feature({c: b[3] for c, b in bounds.items()})
    grids = {c: (b[0] + np.arange(points) * ((b[1] - b[0]) / (points - 1)), b[2] * b[3] ** -0.2) for c, b in bounds.items()}

    def kernels(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals = {c: np.zeros(points) for c in grids}
        for batch in batches:
            for c, part in batch.groupby("feature"):
                for start in range(0, len(part), 1024):
                    values, weights = (part[k].to_numpy()[start:start + 1024] for k in ("value", "weight"))
                    z = (values[:, None] - grids[c][0]) / grids[c][1]
                    totals[c] += weights @ np.exp(-0.5 * z * z)
        for c, total in totals.items():
            yield pd.DataFrame({"feature": c, "point": np.arange(points), "part": total})

    tallies = _long(df, list(bounds)).groupBy("feature", "value").agg(F.count(F.lit(1)).cast("double").alias("weight"))
    sums = (tallies.mapInPandas(kernels, "feature string, point int, part double")
            .groupBy("feature", "point").agg(F.sum("part").alias("_k")))
    norm = rows * width * F.sqrt(F.lit(2.0) * F.pi())
    return sums.select("feature", "point", (lo + F.col("point") * step).alias("x"),
                       (F.col("_k") / norm).alias("density"))


def box_statistics(df: DataFrame, group: str, target: str, layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """Quartiles, whiskers (last values within 1.5 IQR of the box) and outlier counts per group."""
    require_columns(df, [group, target])
    boxes = exact_quantiles(df, target, [0.25, 0.5, 0.75], [group], layout).select(
        group, F.col("rows").alias("_rows"),
        *[F.col("quantiles")[i].alias(q) for i, q in enumerate(("q1", "median", "q3"))])
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col(target).between(F.col("q1") - reach, F.col("q3") + reach)
    kept = F.when(inside, F.col(target))
    tallies = df.where(F.col(target).isNotNull()).groupBy(group, target).agg(F.count(F.lit(1)).alias("_c"))
    return (lookup(tallies, boxes, group, "_rows")
            .groupBy(group, "q1", "median", "q3")
            .agg(F.min(kept).alias("whisker_low"), F.max(kept).alias("whisker_high"),
                 F.sum(F.when(inside, 0).otherwise(F.col("_c"))).alias("outliers"), F.sum("_c").alias("rows")))


def last_rows(df: DataFrame, by: Sequence[str], order: str, k: int = 144, first: bool = False) -> DataFrame:
    """The last (or first) ``k`` rows of every group by time.

    The rank bound becomes a group limit that runs before the shuffle, so at most ``k`` rows per
    group and input task move.
    """
    w = Window.partitionBy(*by).orderBy(F.col(order).asc() if first else F.col(order).desc())
    return df.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k).drop("_r")


def date_range(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """First and last time, rows, and missing values over all columns."""
    blanks = F.lit(0)
    for c in df.columns:
        blanks = blanks + F.col(c).isNull().cast("int")
    return df.agg(F.min(spec.ts).alias("start_ts"), F.max(spec.ts).alias("end_ts"),
                  F.count(F.lit(1)).alias("rows"), F.sum(blanks.cast("long")).alias("total_nulls"))
