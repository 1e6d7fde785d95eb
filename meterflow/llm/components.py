"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.common import stored


def components(edges: DataFrame, name: str = "stars") -> DataFrame:
    """(node, root) of every node with an edge; root is the smallest node of its component.

    ``edges``: a, b. Each round hangs larger neighbours under the smallest one and smaller ones beside it;
    rounds are logarithmic in the number of nodes. Aggregates combine before they are shuffled and joins leave
    hot nodes to be split; edges are stored after every round.
    """
    pairs = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name)
    last = None
    while True:
        both = pairs.select("u", "v").union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = stored(large, name)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        pairs = stored(small.where("u <> v").distinct(), name)
        state = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == last:
            break
        last = state
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).union(pairs.select("v", "v").distinct())
