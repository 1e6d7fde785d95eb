"""Lookup joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.spec import ROWS

HOT_ROWS = 10_000_000
SALTS = 1024


def lookup(big: DataFrame, small: DataFrame, key: str, weight: str, *, how: str = "inner",
           big_weight: Column | None = None, hot_rows: int = HOT_ROWS, salts: int = SALTS) -> DataFrame:
    """Join ``small`` (one row per ``key``) to ``big``, spreading hot keys over ``salts`` partitions.

    ``weight`` names a column of ``small`` with the rows ``big`` holds for the key. Only keys above
    ``hot_rows``, of which there are few by definition, are repeated once per salt. If the rows of
    ``big`` know their own weight, ``big_weight`` saves marking them by a first join with the hot keys.
    The join key is one struct, so that a later grouping by the key and something else is shuffled
    anew instead of inheriting a layout in which the key sits in one task.
    """
    others = [F.col(f"`{c}`") for c in big.columns]
    numbers = F.sequence(F.lit(0), F.lit(salts - 1))
    # The input partition tells complete copies of a row apart and, unlike a row position, is the same
    # when a lost task runs again.
    own_salt = F.pmod(F.xxhash64(*others, F.spark_partition_id()), F.lit(salts)).cast("int")
    if big_weight is None:
        hot = (small.where(F.col(weight) > hot_rows)
               .withColumn("_copy", F.explode(numbers))
               .select(F.struct(F.col(key), F.col("_copy")).alias("_spread"), F.lit(True).alias("_hot")))
        marked = (big.withColumn("_salt", own_salt)
                  .withColumn("_spread", F.struct(F.col(key), F.col("_salt")))
                  .join(hot, "_spread", "left"))
        is_hot = F.coalesce(F.col("_hot"), F.lit(False))
    else:
        marked = big.withColumn("_salt", own_salt).withColumn("_hot", F.lit(None))
        is_hot = big_weight > hot_rows
    salted = (marked.withColumn("_spread", F.struct(F.col(key), F.when(is_hot, F.col("_salt")).otherwise(0)))
              .drop("_salt", "_hot"))
    copies = F.when(F.col(weight) > hot_rows, numbers).otherwise(F.array(F.lit(0)))
    values = [c for c in small.columns if c not in (key, weight)]
    repeated = (small.withColumn("_copy", F.explode(copies))
                .select(F.struct(F.col(key), F.col("_copy")).alias("_spread"), *values))
    return salted.join(repeated, "_spread", how).drop("_spread")


def series_lookup(rows: DataFrame, per_series: DataFrame, series: tuple[str, ...], how: str = "inner") -> DataFrame:
    """``lookup`` by series for numbered rows; ``per_series`` carries ``series_rows``, too.

    NULL series keys meet each other, as the key is a struct.
    """
    key = F.struct(*series, F.lit(0))
    small = per_series.withColumn("_series", key).withColumnRenamed(ROWS, "_weight").drop(*series)
    joined = lookup(rows.withColumn("_series", key), small, "_series", "_weight", how=how, big_weight=F.col(ROWS))
    return joined.drop("_series")
