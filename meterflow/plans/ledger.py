"""Stored stages of a job that a later run takes up again.

A stage is known by a fingerprint of its name, its parameters and what it reads: for files their paths, sizes and times
of change, for the stages before it their own fingerprints. A finished stage is read back; one that was cut off has no
mark of success and is written anew. So a job that was killed goes on behind its last finished stage, and a
job over changed files or with other parameters starts from there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def fingerprint(*parts: object) -> str:
    return hashlib.sha256("\x1f".join(map(repr, parts)).encode()).hexdigest()


def files_fingerprint(spark: SparkSession, path: str) -> str:
    """Of the files below ``path`` as they are listed; no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    row = files.agg(F.count("*"), F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)"))).first()
    return fingerprint("files", *map(str, row))


@dataclass(frozen=True)
class Stage:
    """A stored table and the fingerprint it is known by."""

    table: DataFrame
    mark: str


@dataclass
class StageLedger:
    """Stages below one folder of the shared store. ``written`` lists those that this run had to make."""

    spark: SparkSession
    folder: str

    def __post_init__(self) -> None:
        self.written: list[str] = []

    def _finished(self, path: str) -> bool:
        mark = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        return mark.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)

    def stage(self, name: str, reads: list[str], settings: object, make: Callable[[], DataFrame]) -> Stage:
        """The stored result of ``make``, which is called only if no run has finished this stage before."""
        mark = fingerprint(name, reads, settings)
        path = f"{self.folder.rstrip('/')}/{name}-{mark[:24]}"
        if not self._finished(path):
            make().write.mode("overwrite").parquet(path)
            self.written.append(name)
        return Stage(self.spark.read.parquet(path), mark)
