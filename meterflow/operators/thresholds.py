"""Anomaly score post-processing: cut-offs, normalisation, best-F1 search and ensembles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.functions.checks import require_columns
from meterflow.functions.literals import double_rows
from meterflow.operators.metrics import with_rates
from meterflow.operators.quantiles import exact_quantile_values
from meterflow.spec import DEFAULT_LAYOUT, Layout

STRATEGIES = ("intersection", "union", "weighted")


def flag_at(score: str | Column, threshold: float) -> Column:
    """1 where the score reaches the threshold."""
    c = F.col(score) if isinstance(score, str) else score
    return (c >= F.lit(float(threshold))).cast("int")


def min_max(df: DataFrame, score: str, out: str = "score_norm") -> DataFrame:
    """Scale a score to 0..1 over the table; all zeros when it is constant."""
    span = df.agg(F.struct(F.min(score).alias("lo"), F.max(score).alias("hi")).alias("s")).scalar()
    lo, hi = span.getField("lo"), span.getField("hi")
    return df.withColumn(out, F.when(hi == lo, F.lit(0.0)).otherwise(
        F.try_divide(F.col(score) - lo, hi - lo)))


def threshold_candidates(df: DataFrame, score: str, count: int = 100,
                         layout: Layout = DEFAULT_LAYOUT) -> list[float]:
    """Distinct scores if there are at most ``count``, else ``count`` linear quantiles, ascending."""
    few = [r[0] for r in df.where(F.col(score).isNotNull()).select(score).distinct().limit(count + 1).collect()]
    if not few:
        raise ValueError("no scores to choose a threshold from")
    if len(few) > count:
        step = 0.98 / (count - 1) if count > 1 else 0.0
        few = exact_quantile_values(df, score, [0.01 + i * step for i in range(count)], layout)
    return sorted(set(few))


def threshold_curve(df: DataFrame, score: str, candidates: Sequence[float], label: str = "label") -> DataFrame:
    """Confusion counts and rates at every candidate."""
    steps = sorted(candidates)
    curve = threshold_curves(df.withColumn("_ladder", F.lit(0)), score, [steps], "_ladder", label)
    return curve.drop("_ladder")


def threshold_curves(df: DataFrame, score: str, ladders: Sequence[Sequence[float]], ladder: str,
                     label: str = "label") -> DataFrame:
    """Threshold curves of several scores at once; column ``ladder`` picks each row's candidates.

    Each row is counted once, in the gap between two neighbouring candidates; the counts at a
    candidate are sums over the few gaps above and below it. Rows are never multiplied by candidates.
    """
    require_columns(df, [ladder, score, label])
    steps = double_rows([sorted(c) for c in ladders])[F.col(ladder)]
    gap = F.size(F.filter(steps, lambda c: c <= F.col(score)))
    tallies = df.groupBy(ladder, gap.alias("_gap")).agg(
        F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) == 0).alias("_neg"))
    spread = tallies.select(ladder, "_gap", "_pos", "_neg", F.posexplode(steps).alias("_below", "threshold"))
    above = F.col("_gap") > F.col("_below")
    counts = spread.groupBy(ladder, "threshold").agg(
        *[F.sum(F.when(side, F.col(n)).otherwise(0)).alias(name) for name, side, n in (
            ("tn", ~above, "_neg"), ("fp", above, "_neg"), ("fn", ~above, "_pos"), ("tp", above, "_pos"))])
    return with_rates(counts)


def best_threshold(df: DataFrame, score: str, label: str = "label", count: int = 100,
                   layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """One row: the lowest candidate with the highest F1, and its counts and rates."""
    candidates = threshold_candidates(df, score, count, layout)
    curve = threshold_curve(df, score, candidates, label)
    return curve.orderBy(F.desc("f1"), "threshold").limit(1)


def ensemble_flag(strategy: str, forest_flag: str, density_flag: str, forest_norm: str | None = None,
                  alpha: float = 0.7) -> Column:
    """Combine two 0/1 flags; ``weighted`` mixes the normalised forest score with the density flag."""
    key = strategy.strip().lower()
    if key == "union":
        return F.greatest(forest_flag, density_flag)
    if key == "intersection":
        return F.least(forest_flag, density_flag)
    if key == "weighted":
        if forest_norm is None:
            raise ValueError("weighted needs the normalised forest score")
        mixed = alpha * F.col(forest_norm) + (1.0 - alpha) * F.col(density_flag).cast("double")
        return (mixed >= 0.5).cast("int")
    raise ValueError(f"Unsupported ensemble strategy {strategy!r}; use one of {STRATEGIES}")

