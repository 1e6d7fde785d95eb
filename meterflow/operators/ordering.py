"""Row numbers and bounded look-back windows over series of any length.

A window ordered by time and partitioned only by the series key puts a whole series into
one task. Both steps here keep every group small instead:

* ``with_row_index`` numbers the rows of each series by adding a prefix sum of time bucket
  counts to the position inside the bucket. Only bucket counts are ever windowed per series.
* ``windowed`` cuts the numbered series into chunks, copies the last few rows of a chunk into
  the next one, evaluates window expressions inside chunks and drops the copies.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from meterflow.functions.calendar import epoch_seconds
from meterflow.session import materialize
from meterflow.spec import DEFAULT_LAYOUT, ROW, ROWS, Layout, SeriesSpec

CHUNK = "_chunk"


def with_row_index(df: DataFrame, spec: SeriesSpec, layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """Add ``row_idx`` (0-based, per series, in time order) and ``series_rows``.

    With ``spec.one_per_slot`` the plan is lazy. Otherwise one aggregate over the key columns
    finds the fullest time bucket; tables with an overfull bucket are numbered from a
    checkpointed range partitioned sort, which splits any hot timestamp.
    """
    base = df.drop(ROW, ROWS)
    if not spec.one_per_slot and _fullest_bucket(base, spec, layout) > layout.bucket_limit:
        return _number_by_range(base, spec)
    return _number_by_bucket(base, spec, layout)


def ensure_row_index(df: DataFrame, spec: SeriesSpec, layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """``with_row_index`` unless the rows already carry their numbers."""
    return df if ROW in df.columns and ROWS in df.columns else with_row_index(df, spec, layout)


def _bucket_key(spec: SeriesSpec, layout: Layout) -> Column:
    # A struct compares NULL keys as equal, so rows of a NULL series survive the join.
    width = spec.seconds * layout.bucket_slots
    bucket = F.floor(epoch_seconds(spec.ts) / F.lit(width)).cast("long")
    return F.struct(*[F.col(c) for c in spec.series], bucket.alias("_bucket"))


def _fullest_bucket(df: DataFrame, spec: SeriesSpec, layout: Layout) -> int:
    counts = df.groupBy(_bucket_key(spec, layout).alias("_key")).count()
    return counts.agg(F.max("count")).first()[0] or 0


def _offsets(counts: DataFrame, series: list[Column], order: Column, keep: list[Column]) -> DataFrame:
    """Rows before each part of a series and rows of the whole series."""
    whole = Window.partitionBy(*series)
    before = whole.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(
        *keep,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(whole).alias(ROWS),
    )


def _number_by_bucket(df: DataFrame, spec: SeriesSpec, layout: Layout) -> DataFrame:
    keyed = df.withColumn("_key", _bucket_key(spec, layout))
    counts = keyed.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"))
    offsets = _offsets(counts, [F.col("_key")[c] for c in spec.series],
                       F.col("_key._bucket"), [F.col("_key")])
    inside = Window.partitionBy("_key").orderBy(spec.ts, *spec.tiebreak, *_last_resort(df, spec))
    return (keyed.join(offsets, "_key")
            .withColumn(ROW, F.row_number().over(inside) - 1 + F.col("_before"))
            .select(*df.columns, ROW, ROWS))


def _row_hash(df: DataFrame) -> Column:
    """The same for a row whatever the partitions and the order of the columns."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in sorted(df.columns)])


def _last_resort(df: DataFrame, spec: SeriesSpec) -> list[Column]:
    """Rows of one time are ordered by their hash, as in the range sort, so that both ways give the same numbers."""
    return [] if spec.one_per_slot else [_row_hash(df)]


def _number_by_range(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    # Equal keys cannot be split by range; the arrival number tells complete copies apart, whose order is all one.
    keys = [*spec.series, spec.ts, *spec.tiebreak, "_hash", "_arrival"]
    ordered = (df.withColumn("_hash", _row_hash(df))
               .withColumn("_arrival", F.monotonically_increasing_id())
               .repartitionByRange(*keys)
               .sortWithinPartitions(*keys)
               .drop("_hash", "_arrival")
               .withColumn("_pos", F.monotonically_increasing_id())
               .withColumn("_key", F.struct(*spec.series, F.spark_partition_id().alias("_part"))))
    ordered = materialize(ordered)
    counts = ordered.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first"))
    offsets = _offsets(counts, [F.col("_key")[c] for c in spec.series], F.col("_key._part"),
                       [F.col("_key"), F.col("_first")])
    return (ordered.join(offsets, "_key")
            .withColumn(ROW, F.col("_pos") - F.col("_first") + F.col("_before"))
            .select(*df.columns, ROW, ROWS))


def chunk_size(layout: Layout = DEFAULT_LAYOUT, least: int = 1) -> Column:
    """Rows per chunk: at least ``chunk_rows`` and ``least``, else the root of the series length."""
    return F.greatest(F.lit(max(layout.chunk_rows, least)),
                      F.ceil(F.sqrt(F.col(ROWS)))).cast("long")


def chunk_number(layout: Layout = DEFAULT_LAYOUT, least: int = 1) -> Column:
    return F.floor(F.col(ROW) / chunk_size(layout, least)).cast("long")


def chunk_key(spec: SeriesSpec, number: Column) -> Column:
    """Series and chunk number as one struct.

    With separate columns Spark would accept an input already partitioned by series as well
    distributed for (series, chunk) and leave a hot series in one task.
    """
    return F.struct(*[F.col(c) for c in spec.series], number.alias("_no"))


def chunk_window(descending: bool = False) -> WindowSpec:
    order = F.col(ROW).desc() if descending else F.col(ROW).asc()
    return Window.partitionBy(CHUNK).orderBy(order)


def with_halo(df: DataFrame, spec: SeriesSpec, back: int, layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """Numbered rows by chunk; the last ``back`` rows of a chunk are in the next one, too.

    A row is at home in the chunk whose ``_no`` is ``chunk_number(layout, back)``.
    """
    size = chunk_size(layout, back)
    home = chunk_number(layout, back)
    handed_on = (F.col(ROW) % size >= size - back) & ((home + 1) * size < F.col(ROWS))
    parts = F.when(handed_on, F.array(home, home + 1)).otherwise(F.array(home))
    return df.select("*", F.explode(parts).alias("_n")).withColumn(CHUNK, chunk_key(spec, F.col("_n"))).drop("_n")


def windowed(
    df: DataFrame,
    spec: SeriesSpec,
    columns: Mapping[str, Callable[[WindowSpec], Column]],
    back: int,
    layout: Layout = DEFAULT_LAYOUT,
) -> DataFrame:
    """Add window columns that look back at most ``back`` rows within a series.

    ``columns`` maps a name to a function from the ordered window to a column. Rows must carry
    gap-free numbers from ``with_row_index``. All columns share one exchange and one sort.
    """
    home = chunk_number(layout, back)
    spread = with_halo(df, spec, back, layout)
    w = chunk_window()
    return (spread.withColumns({name: make(w) for name, make in columns.items()})
            .where(F.col(CHUNK)["_no"] == home)
            .drop(CHUNK))
