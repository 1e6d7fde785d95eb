"""Reliable intermediate results: tables and scratch folders on shared storage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Checkpoint folder named by the session; a temporary one only in local mode."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="meterflow-")
        context.setCheckpointDir(folder)
        current = context.getCheckpointDir()
    return current


def materialize(df: DataFrame) -> DataFrame:
    """Store ``df`` as Parquet in the shared folder, so later passes neither recompute it nor read columns they do not need."""
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name in the shared folder; what is written there goes when the session's JVM ends."""
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path
