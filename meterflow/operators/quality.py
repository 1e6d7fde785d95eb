"""Data quality reports over readings: schema, time grid, readiness and feature ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterflow.functions.calendar import epoch_exact, epoch_micros
from meterflow.functions.checks import require_columns
from meterflow.operators.features import sequences, supervised_lags
from meterflow.operators.joins import series_lookup
from meterflow.operators.ordering import ensure_row_index, windowed
from meterflow.spec import (CALENDAR_COLUMNS, CYCLICAL_COLUMNS, DEFAULT_LAYOUT, LAGS, ROLLING_WINDOWS, ROW, ROWS,
                            SEQUENCE_LENGTH, Layout, SeriesSpec)


def schema_summary(df: DataFrame) -> DataFrame:
    """column, dtype, nulls and rows, from one aggregation over the table."""
    counts = df.agg(F.count(F.lit(1)).alias("_rows"),
                    *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_n{i}") for i, c in enumerate(df.columns)])
    lines = F.array(*[
        F.struct(F.lit(name).alias("column"), F.lit(kind).alias("dtype"), F.col(f"_n{i}").alias("nulls"))
        for i, (name, kind) in enumerate(df.dtypes)])
    return counts.select(F.explode(lines).alias("_line"), F.col("_rows").alias("rows")).select("_line.*", "rows")


def _distinct_times(df: DataFrame, spec: SeriesSpec, layout: Layout) -> tuple[DataFrame, SeriesSpec]:
    """Copies of a timestamp collapse to one counted row before anything is ordered."""
    times = df.groupBy(*spec.series, spec.ts).agg(F.count(F.lit(1)).alias("_copies"))
    plain = SeriesSpec(ts=spec.ts, target=spec.target, series=spec.series, step=spec.step,
                       one_per_slot=spec.one_per_slot)
    return ensure_row_index(times, plain, layout), plain


def time_continuity(df: DataFrame, spec: SeriesSpec, layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """Per series: range, observed, expected, missing, duplicate and irregular counts, verdict.

    Missing grid points are the expected ones minus the distinct observed times that lie on the
    grid, so no calendar of expected points is generated.
    """
    require_columns(df, [spec.ts])
    times, plain = _distinct_times(df, spec, layout)
    micros = epoch_micros(spec.ts)
    steps = windowed(times, plain, {"_delta": lambda w: micros - F.lag(micros, 1).over(w)}, 1, layout)
    step = F.lit(spec.seconds * 1_000_000)
    # Each further copy of a timestamp is one zero-length interval.
    off_step = F.when(F.col("_delta") != step, 1).otherwise(0) + F.col("_copies") - 1
    by_phase = (steps.groupBy(*spec.series, F.pmod(micros, step).alias("_phase"))
                .agg(F.min(spec.ts).alias("_start"), F.max(spec.ts).alias("_end"),
                     F.sum("_copies").alias("_rows"), F.count(F.lit(1)).alias("_times"),
                     F.sum(off_step).alias("_off")))
    facts = by_phase.groupBy(*spec.series).agg(
        F.min("_start").alias("start_ts"), F.max("_end").alias("end_ts"),
        F.sum("_rows").alias("observed"),
        # The grid starts at the first time, so its phase is the phase of the grid.
        F.min_by("_times", "_start").alias("_on_grid"),
        (F.sum("_rows") - F.sum("_times")).alias("duplicates"),
        F.sum("_off").alias("irregular"))
    expected = F.floor((epoch_micros("end_ts") - epoch_micros("start_ts")) / step) + 1
    clean = (F.col("missing") == 0) & (F.col("duplicates") == 0) & (F.col("irregular") == 0)
    return (facts.withColumn("expected", expected)
            .withColumn("missing", F.col("expected") - F.col("_on_grid"))
            .withColumn("verdict", F.when(clean, "PASS").otherwise("REVIEW"))
            .select(*spec.series, "start_ts", "end_ts", "observed", "expected", "missing",
                    "duplicates", "irregular", "verdict"))


def missing_slots(df: DataFrame, spec: SeriesSpec, limit: int = 10, layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """The first absent grid points of each series, in time order.

    Every gap yields at most ``limit`` of its points, which is all the report can use.
    """
    require_columns(df, [spec.ts])
    times, plain = _distinct_times(df, spec, layout)
    now = epoch_micros(spec.ts)
    previous = windowed(times, plain, {"_prev": lambda w: F.lag(spec.ts, 1).over(w)}, 1, layout)
    firsts = times.where(F.col(ROW) == 0).select(*spec.series, F.col(spec.ts).alias("_first"), ROWS)
    step = spec.seconds * 1_000_000
    anchored = series_lookup(previous.where(F.col("_prev").isNotNull()), firsts, spec.series)
    origin = epoch_micros("_first")
    # Grid numbers strictly between the previous and the current time.
    low = F.floor((epoch_micros("_prev") - origin) / step) + 1
    high = F.ceil((now - origin) / step) - 1
    gaps = anchored.withColumn("_low", low).withColumn("_high", F.least(high, low + (limit - 1)))
    points = (gaps.where(F.col("_low") <= F.col("_high"))
              .withColumn("_k", F.explode(F.sequence("_low", "_high")))
              .select(*spec.series, "_first", "_k"))
    spelled = points.select(
        *spec.series,
        (F.col("_first") + F.make_dt_interval(secs=(F.col("_k") * spec.seconds).cast("decimal(18,6)")))
        .alias("missing_ts"))
    if not spec.series:
        return spelled.orderBy("missing_ts").limit(limit)
    order = Window.partitionBy(*spec.series).orderBy("missing_ts")
    # row_number with a literal bound becomes a group limit that runs before the shuffle.
    return spelled.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= limit).drop("_r")


def readiness(df: DataFrame, spec: SeriesSpec, expected_rows: int | None = None,
              layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """Per series: row count, missing targets and grid defects, and whether all are in order.

    Here ``missing`` is expected points minus distinct times, a count difference.
    """
    require_columns(df, [spec.ts, spec.target])
    grid = time_continuity(df, spec, layout).withColumn(
        "missing", F.col("expected") - (F.col("observed") - F.col("duplicates")))
    nulls = df.groupBy(*spec.series).agg(F.count_if(F.col(spec.target).isNull()).alias("target_nulls"))
    key = F.struct(*spec.series, F.lit(0))
    joined = (grid.withColumn("_series", key)
              .join(nulls.withColumn("_series", key).select("_series", "target_nulls"), "_series")
              .drop("_series"))
    defects = [F.col(c) == 0 for c in ("target_nulls", "duplicates", "irregular", "missing")]
    ready = defects[0] & defects[1] & defects[2] & defects[3]
    if expected_rows is not None:
        ready = ready & (F.col("observed") == expected_rows)
    return joined.select(*spec.series, F.col("observed").alias("rows"), "target_nulls", "duplicates",
                         "irregular", "missing", ready.alias("ready"))


def assert_ready(df: DataFrame, spec: SeriesSpec, expected_rows: int | None = None) -> DataFrame:
    """``df`` unchanged, or ValueError naming the first series that is not forecast-ready."""
    bad = readiness(df, spec, expected_rows).where(~F.col("ready")).first()
    if bad is not None:
        raise ValueError(f"not forecast-ready: {bad.asDict()}")
    return df


def _share_true(condition: Column) -> Column:
    """True when no row breaks the condition; NULL rows are the caller's concern."""
    return F.coalesce(F.bool_and(condition), F.lit(True))


def feature_checks(df: DataFrame, spec: SeriesSpec = SeriesSpec(), tail: int = 5) -> DataFrame:
    """One row of booleans over a feature table: value ranges and warm-up NULLs."""
    wanted = [*CALENDAR_COLUMNS, *(f"rolling_mean_{n}" for n in ROLLING_WINDOWS)]
    require_columns(df, [*wanted, ROW, ROWS])
    at_tail = F.col(ROW) >= F.col(ROWS) - tail
    checks = {
        "hour_ok": F.col("hour").between(0, 23),
        "day_of_week_ok": F.col("day_of_week").between(0, 6),
        "month_ok": F.col("month").between(1, 12),
        "is_weekend_ok": F.col("is_weekend").isin(0, 1),
    }
    for name, rows in ROLLING_WINDOWS.items():
        mean, std = F.col(f"rolling_mean_{name}"), F.col(f"rolling_std_{name}")
        checks[f"warmup_{name}_ok"] = (F.col(ROW) >= rows - 1) | mean.isNull()
        checks[f"tail_{name}_ok"] = ~at_tail | (mean.isNotNull() & std.isNotNull())
    if set(CYCLICAL_COLUMNS) <= set(df.columns):
        for c in CYCLICAL_COLUMNS:
            checks[f"{c}_ok"] = F.col(c).between(-1.0, 1.0)
    if "consumption_diff" in df.columns:
        checks["first_diff_ok"] = (F.col(ROW) > 0) | F.col("consumption_diff").isNull()
        checks["tail_residual_ok"] = ~at_tail | F.col("consumption_residual_24h").isNotNull()
    return df.agg(*[_share_true(c).alias(name) for name, c in checks.items()])


def split_adjacency(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Per series: sizes and ranges of the splits and whether they touch without gap or overlap."""
    require_columns(df, [spec.ts, "split"])
    parts = ("train", "val", "test")
    aggregates = []
    for p in parts:
        here = F.when(F.col("split") == p, F.col(spec.ts))
        aggregates += [F.count(here).alias(f"{p}_rows"), F.min(here).alias(f"{p}_start"),
                       F.max(here).alias(f"{p}_end")]
    out = df.groupBy(*spec.series).agg(*aggregates)
    for left, right in (("train", "val"), ("val", "test")):
        gap = epoch_exact(f"{right}_start") - epoch_exact(f"{left}_end")
        out = out.withColumn(f"{left}_{right}_adjacent", gap == float(spec.seconds))
    return out


def lag_frame_check(df: DataFrame, spec: SeriesSpec, lags: Sequence[int] = LAGS,
                    layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """Per series: rows before and after lag construction and rows dropped."""
    key = F.struct(*spec.series, F.lit(0)).alias("_series")
    before = df.groupBy(*spec.series).agg(F.count(F.lit(1)).alias("rows_before"))
    after = (supervised_lags(df, spec, lags, layout).groupBy(*spec.series)
             .agg(F.count(F.lit(1)).alias("rows_after")).select(key, "rows_after"))
    kept = F.coalesce(F.col("rows_after"), F.lit(0))
    return (before.withColumn("_series", F.struct(*spec.series, F.lit(0)))
            .join(after, "_series", "left")
            .select(*spec.series, "rows_before", kept.alias("rows_after"),
                    (F.col("rows_before") - kept).alias("rows_dropped"),
                    (F.col("rows_before") - kept == max(lags)).alias("drop_ok")))


def sequence_shape_check(df: DataFrame, spec: SeriesSpec, first_rows: int = 200, length: int = SEQUENCE_LENGTH,
                         features: Sequence[str] | None = None, layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """Sample count and array shape of the sequences cut from the first rows of each series."""
    head = ensure_row_index(df, spec, layout).where(F.col(ROW) < first_rows)
    head = head.withColumn(ROWS, F.least(F.col(ROWS), F.lit(first_rows).cast("long")))
    samples = (sequences(head, spec, features, length, layout) if features
               else sequences(head, spec, length=length, layout=layout))
    return samples.groupBy(*spec.series).agg(
        F.count(F.lit(1)).alias("samples"), F.min(F.size("sequence")).alias("steps"),
        F.min(F.size("next_step")).alias("features"))
