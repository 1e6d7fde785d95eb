"""Exact deduplication of arriving files by a stateful stream whose state never expires.

Two chained streams run to the end of what has arrived, each from its own checkpoint:

* ``fingerprints`` reads the files once and appends one small row a document: digest of the normalised text, length,
  identifier and content locator (file and row in it);
* ``state`` folds those rows into RocksDB state keyed by digest: how many rows there were, and length, identifier and locator
  of the row that stays. There is no watermark, so a copy is found however late it comes. Rows combine before
  the shuffle, so a digest with a third of all rows is one message a task.

Both go on from their checkpoints when new files arrive: old texts are not read again to fold new ones in.

A digest hit is then checked on the full bytes. The rows of digests that were hit are marked in a bitmap of
``MARKS`` bits over hashed locators, which is sent to all tasks: its size is fixed. Only marked rows take their texts to the
check, where the least and greatest text of each digest are found, combined before the shuffle; they are equal
only if all texts of the digest are. Digests with different texts are grouped again by the texts themselves.

Everything is DataFrame and SQL functions: no Python runs on the data.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterflow.llm.common import stored

#: Bits of the bitmap of marked rows: 8 MB. With more marked rows than bits more texts than needed are checked, never fewer.
MARKS = 1 << 26
#: A digest with more than this share of all rows is hot; there are at most as many hot digests as its inverse.
HOT_SHARE = 1 / 1000
_BLOCK = 1 << 15  # bits of one bitmap of bitmap_construct_agg

#: State on disk, written as changes, with small buffers and nothing preallocated: hundreds of partitions may share an executor.
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "4",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def normalised(text: Column) -> Column:
    """The text without ASCII white space; texts are equal when these are."""
    for space in " \n\t\r\v\f":
        text = F.replace(text, F.lit(space), F.lit(""))
    return text


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@dataclass(frozen=True)
class Deduplicator:
    """Streams over the Parquet files that arrive at ``path``; ``folder`` keeps what they know between runs.

    ``path`` is a file, a folder or a pattern. ``digest`` maps a normalised text to a binary value; whatever it is, the result
    is exact, as hits are checked on the texts. ``files`` bounds the files of one micro-batch.
    """

    spark: SparkSession
    path: str
    folder: str
    key: str = "doc_id"
    text: str = "text"
    digest: Callable[[Column], Column] = sha256
    files: int = 10_000

    def _texts(self, files: DataFrame) -> DataFrame:
        whole = F.coalesce(F.col(f"`{self.text}`").cast("string"), F.lit(""))
        return files.select(F.col(f"`{self.key}`").alias("doc_id"), whole.alias("text"), F.col("_metadata.file_path").alias("file"),
                            F.col("_metadata.row_index").alias("row"))

    def _schema(self) -> T.StructType:
        return self.spark.read.parquet(self.path).select(f"`{self.key}`", f"`{self.text}`").schema

    def absorb(self) -> None:
        """Take in every file that is not known yet."""
        with _settings(self.spark, SETTINGS):
            arrived = self._texts(self.spark.readStream.schema(self._schema()).option("maxFilesPerTrigger", self.files).parquet(_pattern(self.path)))
            rows = arrived.select("doc_id", "file", "row", F.char_length("text").alias("points"), self.digest(normalised(F.col("text"))).alias("digest"))
            (rows.writeStream.format("parquet").option("path", f"{self.folder}/fingerprints").option("checkpointLocation", f"{self.folder}/reading")
             .trigger(availableNow=True).start().awaitTermination())
            known = self.spark.readStream.schema(self._fingerprint_schema()).option("maxFilesPerTrigger", self.files).parquet(f"{self.folder}/fingerprints")
            (known.groupBy("digest").agg(F.count("*").alias("n"), F.min(_rank()).alias("best")).writeStream.format("noop").outputMode("update")
             .option("checkpointLocation", f"{self.folder}/state").trigger(availableNow=True).start().awaitTermination())

    def fingerprints(self) -> DataFrame:
        """doc_id, file, row, points, digest of every row taken in."""
        return self.spark.read.schema(self._fingerprint_schema()).parquet(f"{self.folder}/fingerprints")

    def _fingerprint_schema(self) -> T.StructType:
        kind = self._schema()[self.key].dataType
        return (T.StructType().add("doc_id", kind).add("file", T.StringType()).add("row", T.LongType()).add("points", T.IntegerType())
                .add("digest", T.BinaryType()))

    def state(self) -> DataFrame:
        """The state as a table: digest, n, and best (doc_id, file and row of the row that stays)."""
        with _settings(self.spark, SETTINGS):
            rows = self.spark.read.format("statestore").load(f"{self.folder}/state")
        count, best = (F.col("value")[name] for name in rows.schema["value"].dataType.names)
        return rows.select("key.digest", count.alias("n"), F.struct(*(best[name].alias(name) for name in ("doc_id", "file", "row"))).alias("best"))

    def groups(self) -> DataFrame:
        """One row per row taken in: doc_id, keep_id, group_size, kept, digest.

        Of equal texts the one with the most code points before normalisation stays, then the one with the smallest id (null
        last), then the first in file and row order, so repeated rows keep exactly one. Null texts count as empty; empty
        texts and texts of white space alone are one group. Whole texts are compared, however long. Columns other than key
        and text are not read, so none can clash. An empty table gives no row.
        """
        rows = self.fingerprints()
        total = rows.count()
        if not total:
            best = F.lit(None).cast(T.StructType([rows.schema[c] for c in ("doc_id", "file", "row")]))
            return _answer(rows.withColumns({"n": F.lit(0).cast("long"), "best": best}))
        assigned = stored(_lookup(rows, stored(self.state(), "state"), total), "assigned")
        differ = stored(self._unequal(assigned.where("n > 1")), "unequal")
        if differ.isEmpty():
            return _answer(assigned)
        return _answer(assigned.join(differ, "digest", "left_anti").unionByName(self._regrouped(assigned.join(differ, "digest", "left_semi"))))

    def _marked(self, members: DataFrame) -> DataFrame:
        """digest, normalised text, doc_id, file, row and length of (at least) the rows of ``members``."""
        mark = F.pmod(F.xxhash64("file", "row"), F.lit(MARKS))
        part = F.floor(F.col("mark") / _BLOCK)
        bits = (members.select(mark.alias("mark")).groupBy(part.alias("part"))
                .agg(F.bitmap_construct_agg((F.col("mark") % _BLOCK).cast("int")).alias("bits")))
        files = self._texts(self.spark.read.schema(self._schema()).parquet(self.path)).withColumn("mark", mark).withColumn("part", part)
        byte = F.conv(F.hex(F.substring("bits", (F.col("mark") % _BLOCK / 8).cast("int") + 1, 1)), 16, 10).cast("int")
        is_set = F.call_function("shiftright", byte, (F.col("mark") % 8).cast("int")).bitwiseAND(1) == 1
        marked = files.join(F.broadcast(bits), "part").where(is_set)  # MARKS bits in all
        return (marked.select("doc_id", "file", "row", F.char_length("text").alias("points"), normalised(F.col("text")).alias("normal"))
                .withColumn("digest", self.digest(F.col("normal"))))

    def _unequal(self, members: DataFrame) -> DataFrame:
        """Digests whose texts are not all equal byte by byte."""
        return (self._marked(members).groupBy("digest").agg(F.min("normal").alias("a"), F.max("normal").alias("b"))
                .where("a <> b").select("digest"))

    def _regrouped(self, members: DataFrame) -> DataFrame:
        """Rows of digests with different texts, in groups of equal texts."""
        texts = self._marked(members).join(members.select("file", "row"), ["file", "row"], "left_semi")
        texts = stored(texts.withColumn("normal", F.col("normal").cast("binary")), "regrouped")
        best = texts.groupBy("digest", "normal").agg(F.count("*").alias("n"), F.min(_rank()).alias("best"))
        return texts.join(best, ["digest", "normal"]).select(*members.columns[:-1], F.struct("best.doc_id", "best.file", "best.row").alias("best"))


def _rank() -> Column:
    """The longest text is least, then the smallest identifier (null last), then the first place."""
    return F.struct((-F.col("points")).alias("points"), F.col("doc_id").isNull().alias("unnamed"), "doc_id", "file", "row")


def _answer(assigned: DataFrame) -> DataFrame:
    stays = (F.col("best.file") == F.col("file")) & (F.col("best.row") == F.col("row"))
    return assigned.select("doc_id", F.col("best.doc_id").alias("keep_id"), F.col("n").alias("group_size"), stays.alias("kept"), "digest")


def _pattern(path: str) -> str:
    """The path as a pattern: a stream takes a single file only so."""
    return path if any(c in path for c in "*?[{") else f"{path[:-1]}[{path[-1]}]"


def _lookup(rows: DataFrame, groups: DataFrame, total: int) -> DataFrame:
    """``rows`` with n and best (last) of their digest. Hot digests, at most 1 / HOT_SHARE of them, are sent to every task."""
    hot = groups.where(F.col("n") > total * HOT_SHARE)
    found = rows.join(F.broadcast(hot.select(F.col("digest").alias("d"), "n", "best")), F.col("digest") == F.col("d"), "left")
    cold = found.where("d is null").drop("d", "n", "best").join(groups.where(F.col("n") <= total * HOT_SHARE), "digest")
    return found.where("d is not null").drop("d").unionByName(cold)


def exact_copies(spark: SparkSession, path: str, folder: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Takes in what has arrived at ``path`` since the last call with ``folder``; groups of all rows so far."""
    deduplicator = Deduplicator(spark, path, folder, key, text)
    deduplicator.absorb()
    return deduplicator.groups()
