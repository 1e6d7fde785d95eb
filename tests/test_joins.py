import pandas as pd
from pyspark.sql import functions as F

from meterflow.operators.joins import lookup, series_lookup


def tables(spark):
    big = spark.createDataFrame(pd.DataFrame({"k": [1] * 500 + [2] * 30 + [3] * 5, "v": range(535)}))
    small = spark.createDataFrame([(1, 500, "a"), (2, 30, "b")], "k long, n long, name string")
    return big, small


def test_hot_keys_give_the_plain_join(spark):
    big, small = tables(spark)
    for how in ("inner", "left"):
        want = big.join(small.drop("n"), "k", how).select("k", "v", "name")
        got = lookup(big, small, "k", "n", how=how, hot_rows=100, salts=7).select("k", "v", "name")
        assert got.count() == want.count() and got.exceptAll(want).isEmpty()


def test_hot_key_is_spread_over_partitions(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        big, small = tables(spark)
        got = lookup(big, small, "k", "n", hot_rows=100, salts=64)
        parts = got.where("k = 1").groupBy(F.spark_partition_id()).count().collect()
        assert len(parts) > 1 and max(r["count"] for r in parts) < 250
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_rows_that_know_their_series_size(spark):
    big, small = tables(spark)
    numbered = big.withColumn("series_rows", F.when(F.col("k") == 1, 500).when(F.col("k") == 2, 30).otherwise(5))
    per_series = small.withColumnRenamed("n", "series_rows")
    got = series_lookup(numbered, per_series, ("k",), how="left")
    assert got.count() == 535 and set(got.columns) == {"k", "v", "series_rows", "name"}
