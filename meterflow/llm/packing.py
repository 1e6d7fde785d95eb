"""Order-preserving packing of documents into token sequences by dynamic programming.

Documents follow one another in key order. Windows may be cut at the end of a document, at the end of a
sentence, or anywhere at a price. For boundaries ``b`` the cheapest packing that ends at ``b[j]`` is

    cost[j] = min over i with b[j] - b[i] <= width of cost[i] + (width - (b[j] - b[i])) + penalty[j]

that is, padding plus truncation penalty. ``cost[i] + b[i]`` does not depend on j, so a monotone queue
gives every minimum in constant time. Each task packs a range of keys and carries the open window from
one stretch to the next; what is left at its end is cut at powers of two, which need no padding.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.common import stored, texts
from meterflow.llm.token_ids import shard_starts
from meterflow.llm.wordpieces import WordEncoder

WIDTH = 4096
#: Price, in tokens of padding, of a cut at a sentence end and of a cut elsewhere.
SENTENCE, ANYWHERE = 8, 256
#: Tokens after which a stretch is planned.
STRETCH = 1 << 18
PIECE = "shard int, local_sequence long, offset long, doc_id {key}, start long, length long, ids_crc32 long, doc_tokens long"


def cheapest_cuts(bounds: list[int], prices: list[int], width: int = WIDTH) -> tuple[list[float], list[int]]:
    """Cost of the cheapest packing that ends at each boundary, and the boundary before it.

    ``bounds`` starts with 0 and rises by 1 to ``width`` from one to the next.
    """
    costs, back = [0.0], [-1]
    queue = deque([(0.0, 0)])  # of (cost + position, boundary), rising in both
    for j in range(1, len(bounds)):
        at = bounds[j]
        while bounds[queue[0][1]] < at - width:
            queue.popleft()
        key, i = queue[0]
        cost = key + width - at + prices[j]
        costs.append(cost)
        back.append(i)
        key = cost + at
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, j))
    return costs, back


def _filled(bounds: list[int], prices: list[int], width: int) -> tuple[list[int], list[int]]:
    """Adds boundaries at ANYWHERE's price: a window's width after each other, where none is nearer."""
    full, cost = [bounds[0]], [prices[0]]
    for at, price in zip(bounds[1:], prices[1:]):
        while at - full[-1] > width:
            full.append(full[-1] + width)
            cost.append(ANYWHERE)
        if at > full[-1]:
            full.append(at)
            cost.append(price)
        else:
            cost[-1] = min(cost[-1], price)
    return full, cost


def windows(bounds: list[int], prices: list[int], last: bool, width: int = WIDTH) -> list[int]:
    """Window ends over positions from 0; the rest after the last one stays open unless ``last``.

    An open stretch is committed up to the cheapest boundary of its last window; the final rest is cut
    into powers of two.
    """
    bounds, prices = _filled([0, *bounds], [0, *prices], width)
    costs, back = cheapest_cuts(bounds, prices, width)
    first = bisect_left(bounds, bounds[-1] - width + 1)
    # cost per position: the open rest counts as filled later
    j = min(range(first, len(bounds)), key=lambda k: (costs[k], -k)) if bounds[-1] >= width else 0
    ends = []
    at = j
    while at > 0:
        ends.append(bounds[at])
        at = back[at]
    ends.reverse()
    if last:
        done = ends[-1] if ends else 0
        rest = bounds[-1] - done
        for power in reversed(range(rest.bit_length())):
            if rest >> power & 1:
                done += 1 << power
                ends.append(done)
    return ends


def sentence_tokens(tokenizer) -> np.ndarray:
    """For each id whether it ends a sentence: the end of a word that ends in a full stop, exclamation or question mark."""
    vocabulary = tokenizer.get_vocab()
    ends = np.zeros(max(vocabulary.values()) + 1, bool)
    ends[[i for token, i in vocabulary.items() if token.removesuffix("</w>")[-1:] in (".", "!", "?") and token.endswith("</w>")]] = True
    return ends


def sentence_ends(ids: bytes, ends: np.ndarray) -> list[int]:
    """Positions behind sentences of a document with its end id; the last is the document's end."""
    codes = np.frombuffer(ids, "<u4")
    found = (np.flatnonzero(ends[codes[:-1]]) + 1).tolist()
    if found and found[-1] == len(codes) - 1:
        found.pop()  # the end id belongs to the last sentence
    return [*found, len(codes)]


class _Packer:
    def __init__(self, shard: int, width: int):
        self.shard, self.width, self.sequence = shard, width, 0
        self.docs: list[list] = []  # key, ids, position of its first token in the stretch
        self.bounds: list[int] = []
        self.prices: list[int] = []
        self.size = 0

    def add(self, key: int | None, ids: bytes, ends: list[int]) -> None:
        self.docs.append([key, ids, self.size])
        self.bounds += [self.size + e for e in ends]
        self.prices += [SENTENCE] * (len(ends) - 1) + [0]
        self.size += ends[-1]

    def flush(self, last: bool) -> list[tuple]:
        ends = windows(self.bounds, self.prices, last, self.width)
        pieces, d = [], 0
        begin = 0
        for end in ends:
            while d < len(self.docs):
                key, ids, first = self.docs[d]
                n = len(ids) // 4
                a, z = max(begin, first), min(end, first + n)
                if a >= end:
                    break
                pieces.append((self.shard, self.sequence, a - begin, key, a - first, z - a, zlib.crc32(ids[4 * (a - first):4 * (z - first)]), n))
                if first + n > end:
                    break
                d += 1
            self.sequence += 1
            begin = end
        self.docs = [[key, ids, first - begin] for key, ids, first in self.docs[d:]]
        k = next((i for i, b in enumerate(self.bounds) if b > begin), len(self.bounds))
        self.bounds, self.prices, self.size = [b - begin for b in self.bounds[k:]], self.prices[k:], self.size - begin
        return pieces


def _pack(path: str, end_id: int, width: int):
    names = [c.split()[0] for c in PIECE.split(", ")]

    def batch(pieces: list[tuple], key: pa.DataType) -> pa.RecordBatch:
        kinds = [pa.int32(), pa.int64(), pa.int64(), key, *[pa.int64()] * 4]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*pieces), kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = WordEncoder(path), np.array([end_id], "<u4").tobytes()
        stops = sentence_tokens(encoder.pieces.words.tokenizer)
        packer, kind = _Packer(TaskContext.get().partitionId(), width), pa.null()
        for rows in batches:
            kind = rows.column(0).type
            for key, text in zip(rows.column(0).to_pylist(), rows.column(1)):
                ids = encoder.encode(text.as_py()) + end
                packer.add(key, ids, sentence_ends(ids, stops))
                if packer.size >= STRETCH and (pieces := packer.flush(False)):
                    yield batch(pieces, kind)
        if pieces := packer.flush(True):
            yield batch(pieces, kind)

    return run


def pack(docs: DataFrame, tokenizer: str, end_id: int, width: int = WIDTH, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: which tokens of which document stand where in which sequence.

    Null and empty texts are documents of the end id alone. Rows with one key are documents of their own,
    in order of their text; a null key comes first. An empty table gives no piece. Sequences are numbered
    without gaps in key order; every token lies in exactly one piece. Keys may be of any type that has an order.
    """
    ordered = texts(docs, key, text).repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text")
    kind = ordered.schema["doc_id"].dataType.simpleString()
    pieces = stored(ordered.mapInArrow(_pack(tokenizer, end_id, width), PIECE.format(key=kind)), "pieces")
    totals = pieces.groupBy("shard").agg((F.max("local_sequence") + 1).alias("total"))
    placed = pieces.join(F.broadcast(shard_starts(totals)), "shard")  # a row per write task
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                         (F.col("shard_start") + F.col("local_sequence")).alias("sequence_id"), "offset")
