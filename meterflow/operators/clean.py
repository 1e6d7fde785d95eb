"""Masking of flagged readings, interpolation in time, and comparison of cleaned artefacts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterflow.functions.calendar import epoch_exact
from meterflow.functions.checks import require_columns
from meterflow.operators.ordering import CHUNK, chunk_key, chunk_number, chunk_window, ensure_row_index
from meterflow.spec import DEFAULT_LAYOUT, Layout, SeriesSpec


def interpolate_flagged(df: DataFrame, spec: SeriesSpec, flag: str = "is_anomaly", out: str | None = None,
                        layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """Blank the target where ``flag`` is 1 and fill every blank linearly in elapsed time.

    A blank after the last value repeats it, a blank before the first stays NULL, an unscored row
    (NULL flag) is kept, and a series without any flag comes back as it was. The nearest known
    values are found inside chunks; each chunk's first and last known value are carried over the
    short list of chunks of its series, so a gap may span any number of chunks.
    """
    require_columns(df, [spec.ts, spec.target, flag])
    target = F.col(spec.target)
    f = F.col(flag)
    bad = F.raise_error(F.lit("flags must be 0 or 1")).cast("int")
    checked = F.when(f.isNull() | f.isin(0, 1), f).otherwise(bad)
    indexed = (ensure_row_index(df, spec, layout)
               .withColumn("_flag", checked)
               .withColumn("_y", F.when(F.coalesce(F.col("_flag") == 1, F.lit(False)), None).otherwise(target))
               .withColumn("_t", epoch_exact(spec.ts))
               .withColumn(CHUNK, chunk_key(spec, chunk_number(layout))))
    point = F.when(F.col("_y").isNotNull(), F.struct(F.col("_t").alias("t"), F.col("_y").alias("y")))
    known = F.when(F.col("_y").isNotNull(), F.col("_t"))
    summary = indexed.groupBy(CHUNK).agg(
        F.min_by(point, known).alias("_first"), F.max_by(point, known).alias("_last"),
        F.coalesce(F.sum(F.col("_flag").cast("long")), F.lit(0)).alias("_flags"))
    series = Window.partitionBy(*[F.col(CHUNK)[c] for c in spec.series])
    forward = series.orderBy(F.col(CHUNK)["_no"].asc()).rowsBetween(Window.unboundedPreceding, -1)
    backward = series.orderBy(F.col(CHUNK)["_no"].desc()).rowsBetween(Window.unboundedPreceding, -1)
    carried = summary.select(
        CHUNK,
        F.last("_last", ignorenulls=True).over(forward).alias("_carry_prev"),
        F.last("_first", ignorenulls=True).over(backward).alias("_carry_next"),
        (F.sum("_flags").over(series) > 0).alias("_any"))

    # Both directions run over a growing frame, which Spark evaluates in one pass.
    up = chunk_window().rowsBetween(Window.unboundedPreceding, 0)
    down = chunk_window(descending=True).rowsBetween(Window.unboundedPreceding, 0)
    near = (indexed.withColumn("_point", point)
            .withColumn("_prev", F.last("_point", ignorenulls=True).over(up))
            .withColumn("_next", F.last("_point", ignorenulls=True).over(down)))
    joined = near.join(carried, CHUNK)
    prev: Column = F.coalesce("_prev", "_carry_prev")
    nxt: Column = F.coalesce("_next", "_carry_next")
    share = F.try_divide(F.col("_t") - prev["t"], nxt["t"] - prev["t"])
    line = prev["y"] + (nxt["y"] - prev["y"]) * share
    filled = F.coalesce(F.col("_y"), line, prev["y"])
    return (joined.withColumn("_filled", F.when(F.col("_any"), filled).otherwise(target))
            .select(*[c for c in indexed.columns if not c.startswith("_") and c != (out or spec.target)],
                    F.col("_filled").alias(out or spec.target)))


def compare_artefacts(baseline: DataFrame, a: DataFrame, b: DataFrame, spec: SeriesSpec,
                      name_a: str = "a", name_b: str = "b") -> DataFrame:
    """One row on how two cleaned artefacts differ from the baseline and from each other.

    A row counts as imputed when its value differs from the baseline; two missing values count as
    different, too. The hour with most disagreements is -1 with count 0 when there are none. Rows that
    one of the three tables lacks are counted as unmatched and nowhere else.
    """
    require_columns(baseline, [spec.ts, spec.target])
    key = F.struct(*spec.series, F.col(spec.ts)).alias("_key")

    def slim(df: DataFrame, value: str, *more: Column) -> DataFrame:
        return df.select(key, F.col(spec.target).alias(value), *more)

    joined = (slim(baseline, "_base", F.hour(spec.ts).alias("_hour"))
              .withColumn("_in", F.lit(1))
              .join(slim(a, "_a", F.lit(1).alias("_in_a")), "_key", "full").join(slim(b, "_b", F.lit(1).alias("_in_b")), "_key", "full"))
    everywhere = F.col("_in").isNotNull() & F.col("_in_a").isNotNull() & F.col("_in_b").isNotNull()

    def imputed(value: str) -> Column:
        base, other = F.col("_base"), F.col(value)
        return ~base.eqNullSafe(other) | (base.isNull() & other.isNull())

    marked = joined.withColumns({"_ia": everywhere & imputed("_a"), "_ib": everywhere & imputed("_b"),
                                 "_hour": F.when(everywhere, F.col("_hour"))})
    both, either = F.col("_ia") & F.col("_ib"), F.col("_ia") | F.col("_ib")
    gap = F.when(both, F.abs(F.col("_a") - F.col("_b")))
    # Hours are at most 24, so the totals come from a second, tiny aggregation.
    hourly = marked.groupBy("_hour").agg(
        F.count_if("_ia").alias("_na"), F.count_if("_ib").alias("_nb"),
        F.count_if(F.col("_ia") != F.col("_ib")).alias("_d"),
        F.count_if(both).alias("_both"), F.count_if(either).alias("_either"),
        F.count_if(~everywhere).alias("_apart"), F.max(gap).alias("_max"), F.sum(gap).alias("_sum"), F.count(gap).alias("_gaps"))
    worst = F.max_by(F.struct(F.col("_hour").alias("h"), F.col("_d").alias("d")),
                     F.struct(F.col("_d"), -F.col("_hour")))
    total = hourly.agg(
        F.sum("_na").alias("imputed_rows_a"), F.sum("_nb").alias("imputed_rows_b"),
        F.sum("_d").alias("disagree_rows"),
        (F.sum("_both") / F.greatest(F.sum("_either"), F.lit(1))).alias("jaccard_imputed"),
        F.coalesce(F.max("_max"), F.lit(0.0)).alias("max_abs_diff_imputed"),
        F.coalesce(F.try_divide(F.sum("_sum"), F.sum("_gaps")), F.lit(0.0)).alias("mean_abs_diff_imputed"),
        F.sum("_apart").alias("unmatched_rows"), worst.alias("_worst"))
    some = F.col("disagree_rows") > 0
    return total.select(
        F.lit(f"{name_a} vs {name_b}").alias("pair"), *total.columns[:-1],
        F.when(some, F.col("_worst.h")).otherwise(-1).alias("top_disagree_hour"),
        F.when(some, F.col("_worst.d")).otherwise(0).alias("top_disagree_hour_count"))
