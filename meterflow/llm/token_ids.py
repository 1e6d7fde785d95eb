"""Token-id files: Elias-Fano coded document ends over one concatenated id array.

A file set is a Parquet folder whose rows are blocks. A block holds the ids of consecutive documents as
one array (two bytes an id where the vocabulary has at most 65,536 strings, else four) and the ends of
its documents as an Elias-Fano sequence, about ``2 + log2(ids per document)`` bits a document instead of
a 64-bit offset; offsets are read by ``select``. Whole-number keys ascend and are coded in the same way, other keys
are kept as they are. Blocks carry their start within their shard; a shard is what one write task produced.
Parquet is the container because Spark's writers reach every store and commit a task once.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterflow.llm.common import texts
from meterflow.llm.wordpieces import WordEncoder
from meterflow.session import scratch_path

#: Ids after which a block is closed; a longer document is one block of its own.
BLOCK_IDS = 1 << 20

#: A block row, for Spark and for Arrow.
BLOCK = ("shard int, block int, local_start long, n_docs int, n_ids long, width int, low_bits int, lows binary, highs binary, samples binary, "
         "null_keys int, first_key long, key_low_bits int, key_lows binary, key_highs binary, key_samples binary, other_keys array<{key}>, ids binary")
_KINDS = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}


def _arrow_schema(key: pa.DataType) -> pa.Schema:
    return pa.schema([(name, _KINDS.get(kind, pa.list_(key))) for name, kind in (c.split() for c in BLOCK.split(", "))])


class EliasFano:
    """A non-decreasing sequence of whole numbers: low bits packed, high parts in unary.

    ``select(i)`` finds the i-th one of the unary part: a sample for every 64th one, then a scan
    from there; ``all()`` decodes the sequence at once.
    """

    STEP = 64

    def __init__(self, low_bits: int, lows: bytes, highs: bytes, samples: bytes, n: int):
        self.low_bits, self.lows, self.highs, self.n = low_bits, lows, np.frombuffer(highs, np.uint8), n
        self.samples = np.frombuffer(samples, "<u4")

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.int64)
        n, top = len(values), int(values[-1]) + 1 if len(values) else 1
        low_bits = max(0, (top // max(n, 1)).bit_length() - 1)
        ones = (values >> low_bits) + np.arange(n)
        bits = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        bits[ones] = 1
        low = ((values[:, None] >> np.arange(low_bits)) & 1).astype(np.uint8).ravel()
        return cls(low_bits, np.packbits(low, bitorder="little").tobytes(), np.packbits(bits, bitorder="little").tobytes(),
                   ones[::cls.STEP].astype("<u4").tobytes(), n)

    def _low(self, first: int, count: int) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(count, np.int64)
        at = first * self.low_bits
        stop = at + count * self.low_bits
        bits = np.unpackbits(np.frombuffer(self.lows, np.uint8)[at // 8:(stop + 7) // 8], bitorder="little")
        bits = bits[at % 8:at % 8 + count * self.low_bits].reshape(count, self.low_bits)
        return bits.astype(np.int64) @ (1 << np.arange(self.low_bits, dtype=np.int64))

    def all(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.highs, bitorder="little"))[:self.n]
        return ((ones - np.arange(self.n)) << self.low_bits) | self._low(0, self.n)

    def select(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        at, left = int(self.samples[i // self.STEP]), i % self.STEP
        byte = at // 8
        while True:
            bits = np.flatnonzero(np.unpackbits(self.highs[byte:byte + 64], bitorder="little"))
            bits = bits[bits + byte * 8 >= at]
            if left < len(bits):
                return ((int(bits[left]) + byte * 8 - i) << self.low_bits) | int(self._low(i, 1)[0])
            left, byte = left - len(bits), byte + 64
            at = byte * 8

    def size(self) -> int:
        return len(self.lows) + len(self.highs) + 4 * len(self.samples)


def _coded_keys(keys: list, whole: bool) -> dict:
    """Ascending keys, nulls first: whole numbers as distances from the first one."""
    known = [k for k in keys if k is not None]
    coded = whole and (not known or known[-1] - known[0] < 1 << 62)
    code = EliasFano.of(np.array([k - known[0] for k in known], np.int64) if coded else np.empty(0, np.int64))
    return {"null_keys": len(keys) - len(known), "first_key": known[0] if coded and known else None, "key_low_bits": code.low_bits, "key_lows": code.lows,
            "key_highs": code.highs.tobytes(), "key_samples": code.samples.tobytes(), "other_keys": None if coded else known}


def _decoded_keys(b: dict) -> list:
    if b["other_keys"] is not None:
        return [None] * b["null_keys"] + b["other_keys"]
    code = EliasFano(b["key_low_bits"], b["key_lows"], b["key_highs"], b["key_samples"], b["n_docs"] - b["null_keys"])
    return [None] * b["null_keys"] + [b["first_key"] + code.select(i) for i in range(code.n)]


def _block(shard: int, number: int, start: int, keys: list, parts: list[bytes], width: int, whole: bool) -> dict:
    lengths = np.array([len(p) // 4 for p in parts], np.int64)
    code = EliasFano.of(np.cumsum(lengths))
    ids = np.frombuffer(b"".join(parts), "<u4")
    return {"shard": shard, "block": number, "local_start": start, "n_docs": len(parts), "n_ids": int(lengths.sum()), "width": width,
            **_coded_keys(keys, whole), "low_bits": code.low_bits, "lows": code.lows, "highs": code.highs.tobytes(),
            "samples": code.samples.tobytes(), "ids": (ids.astype("<u2") if width == 2 else ids).tobytes()}


def _encode(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(path)
        width = 2 if encoder.pieces.words.tokenizer.get_vocab_size() <= 1 << 16 and end_id < 1 << 16 else 4
        end = np.array([end_id], "<u4").tobytes()
        shard, number, start, keys, parts, size = TaskContext.get().partitionId(), 0, 0, [], [], 0
        schema, whole = None, False
        for batch in batches:
            schema, whole = _arrow_schema(batch.column(0).type), pa.types.is_integer(batch.column(0).type)
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                part = encoder.encode(text.as_py()) + end
                keys.append(key)
                parts.append(part)
                size += len(part) // 4
                if size >= BLOCK_IDS:
                    yield pa.RecordBatch.from_pylist([_block(shard, number, start, keys, parts, width, whole)], schema)
                    number, start, keys, parts, size = number + 1, start + size, [], [], 0
        if parts:
            yield pa.RecordBatch.from_pylist([_block(shard, number, start, keys, parts, width, whole)], schema)

    return run


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int, path: str, key: str = "doc_id", text: str = "text") -> str:
    """Encode whole texts, append ``end_id`` to each document, and write blocks in ascending key order.

    Null texts are empty documents (the end id alone). Rows with the same key follow one another, ordered
    by their text; a null key comes first. An empty table writes no block.
    """
    ordered = texts(docs, key, text).repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text")
    kind = ordered.schema["doc_id"].dataType.simpleString()
    ordered.mapInArrow(_encode(tokenizer, end_id), BLOCK.format(key=kind)).write.option("compression", "uncompressed").parquet(path)
    return path


def shard_starts(totals: DataFrame) -> DataFrame:
    """Exclusive running totals over shards. There is one row for each write task, so one window is bounded."""
    return totals.select("shard", (F.sum("total").over(Window.orderBy("shard")) - F.col("total")).alias("shard_start"))


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            b = {name: batch.column(i)[row].as_py() for i, name in enumerate(batch.schema.names)}
            code = EliasFano(b["low_bits"], b["lows"], b["highs"], b["samples"], b["n_docs"])
            ends = np.array([code.select(i) for i in range(code.n)], np.int64)
            starts = np.concatenate([[0], ends[:-1]])
            ids = np.frombuffer(b["ids"], f"<u{b['width']}").astype("<u4").tobytes()
            sums = [zlib.crc32(ids[4 * a:4 * z]) for a, z in zip(starts.tolist(), ends.tolist())]
            yield pa.RecordBatch.from_arrays([
                pa.array(_decoded_keys(b), batch.schema.field("other_keys").type.value_type), pa.array(starts + b["local_start"] + b["shard_start"], pa.int64()),
                pa.array(ends - starts, pa.int64()), pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])


def read_token_files(spark: SparkSession, path: str, key: str | None = None) -> DataFrame:
    """Document ranges and checksums of their ids, from the files alone. ``key`` is the type of the keys, if known."""
    blocks = spark.read.parquet(path) if key is None else spark.read.schema(BLOCK.format(key=key)).parquet(path)
    kind = blocks.schema["other_keys"].dataType.elementType.simpleString()
    starts = shard_starts(blocks.groupBy("shard").agg(F.sum("n_ids").alias("total")))
    return (blocks.join(F.broadcast(starts), "shard")  # a row per write task
            .mapInArrow(_decode, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long"))


def token_files(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Write to a fresh shared folder and read back."""
    spark = docs.sparkSession
    return read_token_files(spark, write_token_files(docs, tokenizer, end_id, scratch_path(spark, "token-ids")), docs.schema["doc_id"].dataType.simpleString())
