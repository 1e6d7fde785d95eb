"""Training-data pipeline: documents to token sequences, in five stored stages.

Every stage works on all that the one before it kept. The first four return the columns of documents:
texts that the quality rules reject go, one document of each group of near duplicates stays (five words,
similarity 0.8), documents that hold a benchmark item go, secrets are masked in place. The last one returns the
pieces of packed sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from meterflow.llm import decontamination, jaccard_join, packing, quality_rules, secrets
from meterflow.llm.common import stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Tokenizers and language models are no SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(_documents(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_of_each(_documents(docs))


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.without_items(_documents(docs), table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.mask_secrets(_documents(docs), length="n_chars")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(docs), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


STAGES = [
    ("quality rules", keep_quality),
    ("n-gram jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark),
    ("secret scans", mask_secrets),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
