"""Exact quantiles of groups that may be too large for one aggregation buffer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterflow.functions.literals import doubles
from meterflow.operators.joins import lookup
from meterflow.spec import DEFAULT_LAYOUT, Layout

APPROXIMATION = 10_000


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], groups: Sequence[str] = (),
                    layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """One row per group: ``quantiles``, linearly interpolated, in the order of ``probs``, and ``rows``.

    The built-in exact percentile keeps all distinct values of a group in one buffer, so it is
    used only after a count shows every group to be small. Larger groups are bracketed.
    """
    data = df.where(F.col(value).isNotNull()).select(*groups, F.col(value).cast("double").alias("_v"))
    peak = data.groupBy(*groups).count().agg(F.max("count")).first()[0] or 0
    if peak <= layout.exact_limit:
        wanted = F.percentile("_v", doubles(probs))
        return data.groupBy(*groups).agg(wanted.alias("quantiles"), F.count(F.lit(1)).alias("rows"))
    return bracketed_quantiles(data, "_v", probs, groups)


def exact_quantile_values(df: DataFrame, value: str, probs: Sequence[float],
                          layout: Layout = DEFAULT_LAYOUT) -> list[float]:
    """Quantiles of a whole column as Python numbers (one short row reaches the driver)."""
    row = exact_quantiles(df, value, probs, layout=layout).first()
    if row is None or row[0] is None:
        raise ValueError(f"no values in {value}")
    return list(row[0])


def bracketed_quantiles(df: DataFrame, value: str, probs: Sequence[float], groups: Sequence[str] = (),
                        accuracy: int = APPROXIMATION) -> DataFrame:
    """Exact quantiles from approximate brackets.

    Approximate percentiles just below and above each wanted position cut the values of a group
    into cells. Cell counts tell which cells hold the wanted order statistics; only the rows of
    those cells, a share of about 6/accuracy per quantile, are sorted, with equal values counted
    together first.
    """
    group = F.struct(*groups, F.lit(0).alias("_all"))
    data = df.where(F.col(value).isNotNull()).select(group.alias("_g"), F.col(value).alias("_v"))
    margin = 2.0 / accuracy
    marks = sorted({min(1.0, max(0.0, p + d)) for p in probs for d in (-margin, margin)})
    edges = data.groupBy("_g").agg(F.array_sort(F.array_distinct(F.percentile_approx(
        "_v", [float(m) for m in marks], accuracy))).alias("_edges"), F.count(F.lit(1)).alias("_rows"))
    # Equal values are counted before anything is joined; a value held by many rows is one row then.
    tallies = data.groupBy("_g", "_v").agg(F.count(F.lit(1)).alias("_c"))
    celled = (lookup(tallies, edges, "_g", "_rows")
              .withColumn("_cell", F.size(F.filter("_edges", lambda e: e <= F.col("_v"))))
              .drop("_edges"))

    counts = celled.groupBy("_g", "_cell").agg(F.sum("_c").alias("_n"))
    in_order = Window.partitionBy("_g").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = counts.select(
        "_g", "_cell", "_n",
        F.coalesce(F.sum("_n").over(in_order), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy("_g")).alias("_total"))
    positions = F.transform(doubles(probs), lambda p, i: F.struct(i.alias("i"), p.alias("p")))
    place = F.col("_q.p") * (F.col("_total") - 1)
    wanted = (cells.withColumn("_q", F.explode(positions))
              .withColumn("_rank", F.explode(F.array_distinct(F.array(F.floor(place), F.ceil(place)))))
              .where((F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_before") + F.col("_n")))
              .select("_g", "_cell", "_before", F.col("_q.i").alias("_i"), "_rank", place.alias("_place"),
                      "_total"))

    chosen = wanted.select("_g", "_cell", "_before").distinct()
    near = celled.join(chosen, ["_g", "_cell"])
    by_value = Window.partitionBy("_g", "_cell").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranges = (near.withColumn("_end", F.col("_before") + F.sum("_c").over(by_value))
              .withColumn("_start", F.col("_end") - F.col("_c")).drop("_before"))
    hits = (ranges.join(wanted, ["_g", "_cell"])
            .where((F.col("_rank") >= F.col("_start")) & (F.col("_rank") < F.col("_end"))))
    per_prob = hits.groupBy("_g", "_i").agg(
        F.min_by("_v", "_rank").alias("_lo"), F.max_by("_v", "_rank").alias("_hi"),
        F.first("_place").alias("_place"), F.first("_total").alias("_total"))
    share: Column = F.col("_place") - F.floor("_place")
    mixed = F.struct("_i", ((1 - share) * F.col("_lo") + share * F.col("_hi")).alias("_x"))
    collected = per_prob.groupBy("_g").agg(F.array_sort(F.collect_list(mixed)).alias("_all_q"),
                                            F.first("_total").alias("rows"))
    return collected.select(*[F.col("_g")[c].alias(c) for c in groups],
                            F.transform("_all_q", lambda s: s["_x"]).alias("quantiles"), "rows")
