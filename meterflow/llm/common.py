"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
import sys
import types
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.session import scratch_path

#: ASCII white space; a word of the shared contracts is a maximal run of anything else.
SPACES = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and whole text under fixed names; a null text is empty. Other columns cannot clash."""
    return docs.select(F.col(f"`{key}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, keeps column pruning, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back.stored_at = path
    return back


def forget(*tables: DataFrame) -> None:
    """Deletes stored tables that nothing will read again."""
    for df in tables:
        path = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def plain_names(docs: DataFrame) -> DataFrame:
    """The table with columns c0, c1 and so on, which no working column clashes with; ``toDF(*docs.columns)`` gives the names back."""
    return docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])


def map_batches(docs: DataFrame, run: Callable) -> DataFrame:
    """``run`` over Arrow batches of all columns; it keeps their number and types. Columns may have any name."""
    plain = plain_names(docs)
    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)


#: Longest piece of text that a worker's cache keeps: with a bound on its entries, that bounds its bytes.
CACHED = 64


def ascii_lower(c: Column) -> Column:
    """A-Z only; other letters stay as they are."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def per_process(key: str, make: Callable[[], object]) -> object:
    """One object for each Python worker process, kept from task to task."""
    store = sys.modules.setdefault("_meterflow_process", types.ModuleType("_meterflow_process")).__dict__
    if key not in store:
        store[key] = make()
    return store[key]


def release() -> None:
    """Drops what this worker process keeps for other work, which makes it again; whatever needs the memory itself calls this first."""
    sys.modules.pop("_meterflow_process", None)


def load_tokenizer(path: str) -> object:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = per_process(f"tokenizer {path}", lambda: Tokenizer.from_file(path))
    return tokenizer

