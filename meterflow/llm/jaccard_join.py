"""Exact similarity join of shingle sets by a prefix index with set-relation skipping.

Equal sets are one class from the start. Every class puts the rarest ``n - ceil(t n) + 1`` of its shingles
into an index, in one order for all sets; two sets with similarity ``t`` or more share one of them. Sets meet at the
*first* shingle they share in that order, so all shingles before it are missing in the other set. What a set may
still miss behind it is its *margin*, ``n (1 - t) / (1 + t)`` less the place of the shingle. Two relations let parts of
the index be skipped:

* by position: a list is cut into blocks by size and margin. Blocks whose margins add up to less than nothing never
  meet. Two sets of a block differ in no more than twice its best margin behind the shingle; dealt by hash
  into one part more than that, one part at least of the rests of two linked sets is the same. So large blocks meet where the
  digest of a part agrees, small ones set by set. Sets that share one of their earliest long lists have met there and do not
  meet again;
* by answers: every set is first compared with the smallest set of each of its lists, the *pivot*. Jaccard
  distance is a metric, so what is known of the pivot answers for its followers: two sets linked with
  the same pivot are in one group already, and a set farther from the pivot than a follower's distance
  plus ``1 - t`` cannot link with that follower. Only what is left open is compared.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterflow.llm.common import CACHED, SPACES, forget, plain_names, release, stored, texts
from meterflow.llm.components import components

WIDTH = 5
NUMERATOR, DENOMINATOR = 80, 100
#: Shingles that the ordering table holds at most (the most frequent ones; the order affects speed only).
ORDERED = 1 << 16
#: Cells of an outline: the upper nine bits of a code.
CELLS = 512
_TABLE = bytes((b + 32 if 65 <= b <= 90 else b) for b in range(256))
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= 1_000_000:
            self.clear()
        code = xxhash.xxh3_64_digest(word)
        if len(word) <= CACHED:
            self[word] = code
        return code


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def shingle_set(text: str, hashes: dict, width: int = WIDTH) -> np.ndarray:
    """Sorted 64-bit codes of the distinct shingles; a shorter text is one shingle of all its words."""
    words = text.encode("utf-8", "surrogatepass").translate(_TABLE).split()
    if not words:
        return np.empty(0, np.uint64)
    codes = np.frombuffer(b"".join(map(hashes.__getitem__, words)), np.uint64)
    n = max(1, len(codes) - width + 1)
    total = codes[:n] + np.uint64(min(width, len(words)))
    for k in range(1, min(width, len(words))):
        total ^= total >> np.uint64(32)
        total *= _FACTORS[k % 5]
        total += codes[k:k + n]
    total = np.sort(_mixed(total))
    return total[np.concatenate([[True], total[1:] != total[:-1]])]


def prefix_length(n: int) -> int:
    return n - -(-NUMERATOR * n // DENOMINATOR) + 1


def outline(codes: np.ndarray) -> bytes:
    """How many codes fall into each of ``CELLS`` equal parts of their range, 255 meaning that many or more."""
    return np.minimum(np.bincount((codes >> np.uint64(55)).astype(np.int64), minlength=CELLS), 255).astype(np.uint8).tobytes()


def may_link(a: bytes, b: bytes, size_a: int, size_b: int) -> bool:
    """Two sets have at most the smaller count of each cell in common; a full cell tells nothing."""
    x, y = np.frombuffer(a, np.uint8).astype(np.int64), np.frombuffer(b, np.uint8).astype(np.int64)
    if x.max() == 255 or y.max() == 255:
        return True
    return DENOMINATOR * (common := int(np.minimum(x, y).sum())) >= NUMERATOR * (size_a + size_b - common)


def _likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(batch.column(2), batch.column(3), batch.column(4).to_pylist(), batch.column(5).to_pylist())
        kept = batch.filter(pa.array([may_link(a.as_py(), b.as_py(), m, n) for a, b, m, n in rows], pa.bool_()))
        yield kept.select(["a", "b"])


def _sets(seed: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        hashes = _Hashes()
        for batch in batches:
            sets = [shingle_set(t.as_py(), hashes, width) for t in batch.column(1)]
            raw = [s.tobytes() for s in sets]
            distinct = list({r: s for r, s in zip(raw, sets)}.values())
            often, n = np.unique(np.concatenate(distinct), return_counts=True) if distinct else (np.empty(0, np.uint64), np.empty(0, int))
            often, n = often[n > 2].view(np.int64), n[n > 2]
            counts = [[{"token": t, "n": c} for t, c in zip(often.tolist(), n.tolist())], *([None] * (len(sets) - 1))][:len(sets)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(2), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([np.uint64(xxhash.xxh3_64_intdigest(r, seed)).view(np.int64) if r else None for r in raw], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(r, seed) if r else None for r in raw], pa.binary()), pa.array([outline(s) for s in sets], pa.binary()),
                pa.array(counts, pa.list_(pa.struct([("token", pa.int64()), ("n", pa.int64())])))],
                ["doc_id", "row", "n_shingles", "key", "digest", "outline", "often"])

    return run


def shingle_sets(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH) -> tuple[DataFrame, int]:
    """Stored: doc_id, a hash of the text, n_shingles, key of the set (null if empty), frequent codes of a batch; and the seed.

    Keys of 64 bits are checked against digests of 128 bits; if two different sets share a key, all keys are made
    anew from another seed.
    """
    rows = texts(docs, key, text).withColumn("row", F.xxhash64("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    for seed in range(5):
        sets = stored(rows.mapInArrow(_sets(seed, width), f"doc_id {kind}, row long, n_shingles long, key long, digest binary, outline binary, "
                                                         "often array<struct<token:long,n:long>>"), "sets")
        shared = sets.where("key is not null").groupBy("key").agg(F.min("digest").alias("a"), F.max("digest").alias("b")).where("a <> b")
        if shared.isEmpty():
            return sets, seed
    raise RuntimeError("keys of different sets coincide under every seed")


def frequent(sets: DataFrame, most: int = ORDERED) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent codes (sorted) and how often they were counted: at most ``most`` rows reach the driver."""
    rows = (sets.select(F.explode("often").alias("o")).groupBy("o.token").agg(F.sum("o.n").alias("n"))
            .orderBy(F.desc("n"), "token").limit(most).collect())
    tokens = np.array([r["token"] for r in rows], np.int64).view(np.uint64)
    n = np.array([r["n"] for r in rows], np.int64)
    order = np.argsort(tokens)
    return tokens[order], n[order]


def _distinct_sets(batches: Iterator[pa.RecordBatch], seed: int, width: int) -> Iterator[list[tuple[int, np.ndarray]]]:
    """Keys and codes of the sets of each batch that hold something, equal ones of a batch once."""
    release()
    hashes = _Hashes()
    for batch in batches:
        found = {}
        for value in batch.column(0):
            codes = shingle_set(value.as_py(), hashes, width)
            if len(codes):
                found.setdefault(np.uint64(xxhash.xxh3_64_intdigest(codes.tobytes(), seed)).view(np.int64).item(), codes)
        yield list(found.items())


def _prefixes(tokens: np.ndarray, counts: np.ndarray, seed: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for sets in _distinct_sets(batches, seed, width):
            parts, keys, sizes, positions = [], [], [], []
            for key, codes in sets:
                p = prefix_length(len(codes))
                codes = _in_order(codes, tokens, counts)
                parts.append(codes[:p])
                keys.append(np.full(p, key, np.int64))
                sizes.append(np.full(p, len(codes), np.int32))
                positions.append(np.arange(p, dtype=np.int32))
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(parts).view(np.int64)), pa.array(np.concatenate(keys)),
                                                  pa.array(np.concatenate(sizes)), pa.array(np.concatenate(positions))],
                                                 ["token", "key", "size", "pos"])

    return run


def _in_order(codes: np.ndarray, tokens: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Codes by how often they were counted, then by value: the order of all sets."""
    if len(tokens):
        at = np.minimum(np.searchsorted(tokens, codes), len(tokens) - 1)
        rank = np.where(tokens[at] == codes, counts[at], 0)
        codes = codes[np.argsort(rank, kind="stable")] if rank.any() else codes
    return codes


def _part_digests(tokens: np.ndarray, counts: np.ndarray):
    """For each wanted place of a set, the digests of the parts of the codes behind it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for grams, wants in zip(batch.column(1), batch.column(2).to_pylist()):
                codes = _in_order(np.frombuffer(grams.as_buffer(), np.uint64), tokens, counts)
                mixed = _mixed(codes + np.uint64(1))
                lists = []
                for want in wants:
                    behind, parts = slice(want["pos"] + 1, None), np.uint64(want["parts"])
                    sums = np.zeros(want["parts"], np.uint64)
                    np.add.at(sums, codes[behind] % parts, mixed[behind])
                    lists.append(_mixed(sums + np.arange(want["parts"], dtype=np.uint64) * _FACTORS[0] + _FACTORS[1]).view(np.int64).tolist())
                found.append(lists)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found, pa.list_(pa.list_(pa.int64())))], ["key", "wants", "digests"])

    return run


def _codes(seed: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for sets in _distinct_sets(batches, seed, width):
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in sets], pa.int64()), pa.array([c.tobytes() for _, c in sets], pa.binary())],
                                             ["key", "grams"])

    return run


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for x, y in zip(batch.column(2), batch.column(3)):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            found.append(len(np.intersect1d(x, y, assume_unique=True)))
        sizes = [[len(v.as_buffer()) // 8 for v in batch.column(c)] for c in (2, 3)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.int64()),
                                          *(pa.array(s, pa.int64()) for s in sizes)], ["a", "b", "common", "size_a", "size_b"])


#: Rows of two or three numbers that are sent to every task at most; more are joined by a shuffle.
SENT_KEYS = 1_000_000


def _sent(rows: DataFrame) -> DataFrame:
    """A stored table, marked to be sent to every task if it is small enough to be; else joins shuffle."""
    return F.broadcast(rows) if rows.count() <= SENT_KEYS else rows


@dataclass
class Shingled:
    """A table, its stored sets, and how they were made."""

    texts: DataFrame  # id (of doc_id and row), text
    sets: DataFrame
    seed: int
    width: int

    def codes(self, keys: DataFrame) -> DataFrame:
        """Stored key and codes (grams) of the sets of distinct ``keys``, made again from one text of each."""
        first = F.min(F.struct("doc_id", "row")).alias("id")
        rows = stored(self.sets.join(keys, "key").groupBy("key").agg(first).select("id"), "needed")
        codes = stored(self.texts.join(_sent(rows), "id", "left_semi").select("text").mapInArrow(_codes(self.seed, self.width), "key long, grams binary"), "codes")
        if codes.count() > codes.select("key").distinct().count():  # rows that repeat both id and text
            codes = codes.dropDuplicates(["key"])
        return codes

    def compared(self, pairs: DataFrame) -> DataFrame:
        """Exact overlaps of those pairs (a, b) of keys that may link: common, size_a, size_b.

        Pairs whose outlines rule a link out are left out. Sets are made again from one text of each key that remains.
        """
        keys = pairs.select(F.col("a").alias("key")).distinct().union(pairs.select(F.col("b").alias("key")).distinct()).distinct()
        outlines = stored(self.sets.join(_sent(stored(keys, "keys")), "key").groupBy("key").agg(
            F.first("outline").alias("o"), F.first("n_shingles").alias("n")), "outlines")
        first, second = (outlines.select(F.col("key").alias(c), F.col("o").alias(f"o{c}"), F.col("n").alias(f"n{c}")) for c in "ab")
        likely = pairs.select("a", "b").join(first, "a").join(second, "b").select("a", "b", "oa", "ob", "na", "nb")
        pairs = stored(likely.mapInArrow(_likely, "a long, b long"), "likely")
        codes = self.codes(pairs.select(F.col("a").alias("key")).distinct().union(pairs.select(F.col("b").alias("key")).distinct()).distinct())
        left, right = (codes.select(F.col("key").alias(c), F.col("grams").alias(f"g{c}")) for c in "ab")
        return pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "ga", "gb").mapInArrow(
            _overlaps, "a long, b long, common long, size_a long, size_b long")


def _union() -> Column:
    return F.col("size_a") + F.col("size_b") - F.col("common")


def _linked() -> Column:
    return DENOMINATOR * F.col("common") >= NUMERATOR * _union()


def _room(size_a: str, pos_a: str, size_b: str, pos_b: str) -> Column:
    """Most that two sets can have in common if they share the shingle at these places."""
    return F.least(F.col(size_a) - F.col(pos_a), F.col(size_b) - F.col(pos_b)) + F.least(pos_a, pos_b)


def _needed(a: str, b: str) -> Column:
    return F.ceil(NUMERATOR * (F.col(a) + F.col(b)) / (NUMERATOR + DENOMINATOR) - 1e-9)


def _candidates(shared: DataFrame) -> DataFrame:
    """Pairs whose common prefix shingles leave room for enough overlap.

    ``shared``: a, b, size_a, size_b, pos_a, pos_b, one row for each common prefix shingle. Behind the last one,
    at most the shorter rest can be common.
    """
    best = shared.groupBy("a", "b", "size_a", "size_b").agg(F.count("*").alias("c"), F.max("pos_a").alias("pa"), F.max("pos_b").alias("pb"))
    room = F.col("c") + F.least(F.col("size_a") - F.col("pa"), F.col("size_b") - F.col("pb")) - 1
    return best.where(room >= _needed("size_a", "size_b")).select("a", "b")


def shingled(docs: DataFrame, key: str, text: str, width: int) -> Shingled:
    sets, seed = shingle_sets(docs, key, text, width)
    return Shingled(texts(docs, key, text).select(F.struct("doc_id", F.xxhash64("text").alias("row")).alias("id"), "text"), sets, seed, width)


#: Entries of a list from which on it gets more pivots, and the share of their pairs that must link for yet another one.
LONG, MANY_LINKS = 32, 0.4
#: Share of a set's size that it and an equally large one may miss of each other.
MISSES = (DENOMINATOR - NUMERATOR) / (DENOMINATOR + NUMERATOR)
#: Pairs that cost as much as one digest.
DIGEST = 4
#: Earliest long lists of a set that tell where it has met others, and kinds of these in a block up to which they are counted.
HEADS, KINDS = 4, 256


def _placed(members: DataFrame) -> DataFrame:
    """List entries under the sizes they may meet: their own bucket, and as smaller sets the next one; with margin and its level."""
    margin = F.col("size") * F.lit(MISSES) - F.col("pos")
    level = F.when(F.col("margin") < 0, 0).otherwise(F.floor(F.log2(F.greatest(F.col("margin"), F.lit(1.0))) / 2) + 1).cast("int")
    places = F.array(F.struct(F.col("bucket").alias("place"), F.lit(1).alias("own")), F.struct((F.col("bucket") + 1).alias("place"), F.lit(0).alias("own")))
    return members.withColumn("margin", margin + 1e-9).withColumn("level", level).select("*", F.inline(places)).drop("bucket")


def _blocks(entries: DataFrame) -> DataFrame:
    """Blocks of a list that hold different groups: block, token, place, top, most, parts, whether small.

    A block is one level of a list, its *top*, with all entries of that level and below that have room with the top's best margin (``most``).
    Its pairs have an entry of the top and one of their own bucket on either side.
    """
    counts = entries.groupBy("token", "place", "level").agg(F.count("*").alias("n"), F.sum("own").alias("o"), F.max("margin").alias("most"),
                                                            F.min("root").alias("lo"), F.max("root").alias("hi"))
    x, y = counts.where("level > 0").alias("x"), counts.alias("y")
    whole = x.join(y, ["token", "place"]).where("y.level <= x.level and y.most + x.most >= 0").groupBy("token", "place", F.col("x.level").alias("top")).agg(
        F.first("x.most").alias("most"), F.first("x.n").alias("n"), F.first("x.o").alias("o"), F.sum("y.n").alias("all_n"), F.sum("y.o").alias("all_o"),
        F.min("y.lo").alias("lo"), F.max("y.hi").alias("hi")).where("lo <> hi and all_o > 0")
    n, o, all_n, all_o = (F.col(c).cast("double") for c in ("n", "o", "all_n", "all_o"))
    pairs = (n * (n - 1) - (n - o) * (n - o - 1)) / 2 + n * (all_n - n) - (n - o) * (all_n - all_o - (n - o))
    parts = F.floor(2 * F.col("most")).cast("int") + 1
    return whole.where(pairs > 0).select(F.xxhash64("token", "place", "top").alias("block"), "token", "place", "top", "most", parts.alias("parts"),
                                         (pairs <= DIGEST * all_n * parts).alias("small"))


def _held(entries: DataFrame, blocks: DataFrame) -> DataFrame:
    """Entries of each block, without those that have no room even with the best of its top."""
    return (entries.join(blocks, ["token", "place"]).where("level <= top and margin + most >= 0")
            .select("block", "key", "size", "pos", "root", "pivot", "far", "own", (F.col("level") == F.col("top")).alias("top"), "parts"))


def _meet(held: DataFrame, on: list[str], *more: Column) -> DataFrame:
    """Pairs (a < b) of entries of different groups with room behind the shared shingle that no pivot answers for."""
    x, y = held.where("top").alias("x"), held.alias("y")
    room = (F.least(F.col("x.size") - F.col("x.pos"), F.col("y.size") - F.col("y.pos")) >= _needed("x.size", "y.size"))
    answered = F.coalesce((F.col("x.pivot") == F.col("y.pivot")) & (F.abs(F.col("x.far") - F.col("y.far")) > 1 - NUMERATOR / DENOMINATOR + 1e-9), F.lit(False))
    once = (~F.col("y.top") | (F.col("x.key") < F.col("y.key"))) & (F.col("x.own") + F.col("y.own") > 0)
    same = [F.col(f"x.{c}") == F.col(f"y.{c}") for c in on]
    joined = x.join(y, reduce(Column.__and__, [*same, F.col("x.root") != F.col("y.root"), once, room, ~answered, *more]))
    return joined.select(F.least("x.key", "y.key").alias("a"), F.greatest("x.key", "y.key").alias("b"))


def _small_blocks(entries: DataFrame, blocks: DataFrame) -> DataFrame:
    return _meet(_held(entries, blocks.where("small")), ["block"])


def _large_blocks(made: Shingled, entries: DataFrame, blocks: DataFrame, long: DataFrame, tokens: np.ndarray, counts: np.ndarray) -> DataFrame:
    """Entries of large blocks meet where a part of what is behind the shared shingle has the same digest.

    Two sets meet at the first shingle they share, so sets whose earliest long lists (``before``) have one in common have met already.
    Entries that have met all others of their block are left out, and blocks with few pairs left meet set by set.
    """
    heads = long.groupBy("key").agg(F.slice(F.array_sort(F.collect_list(F.struct("pos", "token"))), 1, HEADS).alias("heads"))
    before = F.transform(F.filter("heads", lambda h: h.pos < F.col("pos")), lambda h: h.token)
    held = _held(entries, blocks.where("not small")).join(heads, "key", "left")
    held = stored(held.withColumn("before", F.coalesce(before, F.array().cast("array<long>"))).drop("heads"), "held")
    kinds = stored(held.groupBy("block", "before").agg(F.count("*").alias("n"), F.count_if("top").alias("t")), "kinds")
    several = kinds.groupBy("block").agg(F.count("*").alias("kinds")).where(F.col("kinds") <= KINDS).select("block")
    x, y = kinds.join(several, "block").alias("x"), kinds.alias("y")
    apart = x.join(y, (F.col("x.block") == F.col("y.block")) & ~F.arrays_overlap("x.before", "y.before") & (F.col("x.t") + F.col("y.t") > 0))
    apart = apart.groupBy("x.block", "x.before").agg(F.first("x.n").alias("n"), F.sum(F.col("x.t") * F.col("y.n")).alias("pairs"))
    rest = kinds.join(several, "block", "left_anti").select("block", "before", "n", F.lit(None).cast("long").alias("pairs"))
    left = stored(apart.select("block", "before", "n", "pairs").unionByName(rest), "apart")
    total = left.groupBy("block").agg(F.sum("n").alias("rows"), F.sum("pairs").alias("pairs"))
    held = held.join(_sent(left.select("block", "before")), ["block", "before"], "left_semi").join(_sent(stored(total, "totals")), "block")
    few = F.coalesce(F.col("pairs") <= DIGEST * F.col("rows") * F.col("parts"), F.lit(False))
    wants = held.where(~few).groupBy("key").agg(F.collect_list(F.struct("block", "pos", "parts", "size", "root", "pivot", "far", "own", "top", "before")).alias("wants"))
    wants = stored(wants, "wants")
    kind = wants.schema["wants"].dataType.elementType.simpleString()
    digests = made.codes(wants.select("key")).join(wants, "key").mapInArrow(
        _part_digests(tokens, counts), f"key long, wants array<{kind}>, digests array<array<long>>")
    zipped = digests.select("key", F.inline(F.arrays_zip("wants", "digests"))).select("key", "wants.*", F.explode("digests").alias("digest"))
    apart = ~F.arrays_overlap("x.before", "y.before")
    return _meet(stored(held.where(few), "few"), ["block"], apart).unionByName(_meet(stored(zipped, "parts"), ["block", "digest"], apart))


def _bucket(shift: float = 0.0) -> Column:
    """Sizes that cannot link with the smallest one of their bucket lie in other buckets."""
    return F.floor(F.log(F.col("size").cast("double")) / math.log(1.0001 * DENOMINATOR / NUMERATOR) + shift).cast("int")


def _long_lists(lists: DataFrame) -> DataFrame:
    many = lists.groupBy("token").agg(F.count("*").alias("n")).where(F.col("n") >= LONG)
    return stored(lists.select("token", "key", "size", "pos").join(_sent(stored(many, "long-tokens")), "token"), "long")


def _turn(long: DataFrame, groups: DataFrame | None, turn: int) -> DataFrame:
    """Stored pairs a, b of another pivot and of those sets of its lists that are of another group and may link with it.

    The pivot comes from the largest group and is the same one for all lists that it is in, so there are few pairs; sizes are cut at other
    places in every other turn. The first turn takes the set whose long lists have most entries: it lies in the middle of a family of near
    copies, so even those of them link with it that hardly link with one another. Later turns draw.
    """
    rows = long.withColumn("root", F.col("key")).withColumn("many", F.lit(0))
    if groups is not None:
        many = groups.groupBy("root").agg((-F.count("*")).alias("many"))
        group = _sent(stored(groups.select(F.col("node").alias("key"), "root").join(many, "root"), "grouped"))
        rows = long.join(group, "key", "left").withColumn("root", F.coalesce("root", "key")).withColumn("many", F.coalesce("many", F.lit(0)))
    order = F.xxhash64(F.lit(turn), "key") if turn else -F.sum("n").over(Window.partitionBy("key"))
    rows = stored(rows.withColumn("bucket", _bucket(turn % 2 / 2)).withColumn("order", order).drop("n"), "turn")
    pivots = rows.groupBy("token", "bucket").agg(F.min(F.struct("many", "order", "pos", "key", "size", "root")).alias("p"))
    star = rows.join(pivots, ["token", "bucket"]).where((F.col("root") != F.col("p.root")) & (_room("p.size", "p.pos", "size", "pos") >= _needed("p.size", "size")))
    return stored(star.select(F.col("p.key").alias("a"), F.col("key").alias("b")).distinct(), "turn-pairs")


def set_roots(made: Shingled) -> DataFrame:
    """Stored rows key, root: one for each distinct set; sets of one connected component share a root."""
    sets = made.sets
    tokens, counts = frequent(sets)
    index = made.texts.select("text").mapInArrow(_prefixes(tokens, counts, made.seed, made.width), "token long, key long, size int, pos int")
    # both sides of the join need whole entries, so the index is made and dealt by token once; the rest stays in its partition
    index = index.select("token", F.struct("key", "size", "pos").alias("entry")).repartition("token").distinct()
    often = index.groupBy("token").agg(F.count("*").alias("n")).where("n > 1").select("token")
    plain = stored(index.join(often.hint("merge"), "token").select("token", "entry.*").withColumn("bucket", _bucket()), "lists")
    first = plain.groupBy("token", "bucket").agg(F.min(F.struct("size", "key", "pos")).alias("p"))
    lists = stored(plain.join(first, ["token", "bucket"]), "pivoted")

    # first round: every set against those pivots of its lists that may link with it, judged by the lists they lead;
    # pairs that this passes over are left open, so nothing is lost
    star = lists.where((F.col("key") != F.col("p.key")) & (_room("p.size", "p.pos", "size", "pos") >= _needed("p.size", "size")))
    star = star.select(F.col("p.key").alias("a"), F.col("key").alias("b"), F.col("p.size").alias("size_a"), F.col("size").alias("size_b"),
                       F.col("p.pos").alias("pos_a"), F.col("pos").alias("pos_b"))
    # the smallest set of a long list may be a cut-off copy that few others link with, so these get another pivot, and more while those link with many
    long = _long_lists(plain)
    pairs = _turn(long, None, 0)
    known = stored(made.compared(stored(_candidates(star).union(pairs).distinct(), "star-pairs")), "star-overlaps")
    links = known.where(_linked()).select("a", "b")
    groups = stored(components(links), "groups")
    forget(plain)
    turn, found = 0, links.join(pairs, ["a", "b"], "left_semi").count()
    while found and found >= MANY_LINKS * pairs.count():
        turn += 1
        pairs = _turn(long, groups, turn)
        links = stored(made.compared(pairs).where(_linked()).select("a", "b"), "turn-links")
        groups = stored(components(groups.select(F.col("node").alias("a"), F.col("root").alias("b")).union(links)), "groups")
        found = links.count()

    # second round: what the pivots do not answer, between sets of different groups that share a list
    group = _sent(groups.select(F.col("node").alias("key"), F.col("root")))
    followed = _sent(known.select(F.col("a").alias("pivot"), F.col("b").alias("key"), (1 - F.col("common") / _union()).alias("far")))
    members = (lists.select("token", "bucket", "key", "size", "pos", F.col("p.key").alias("pivot"))
               .join(group, "key", "left").withColumn("root", F.coalesce("root", "key"))
               .join(followed, ["pivot", "key"], "left")
               .withColumn("far", F.when(F.col("key") == F.col("pivot"), 0.0).otherwise(F.col("far"))))
    members = stored(members, "members")
    forget(lists)
    several = members.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("token")
    entries = stored(_placed(members.join(several, "token")), "entries")
    blocks = stored(_blocks(entries), "blocks")
    open_pairs = _small_blocks(entries, blocks).unionByName(_large_blocks(made, entries, blocks, long, tokens, counts)).distinct()
    open_pairs = stored(open_pairs, "open-pairs")
    forget(members, entries, blocks)
    more = made.compared(open_pairs).where(_linked()).select("a", "b")
    groups = components(stored(groups.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more), "links"))

    classes = sets.select("key").where("key is not null").distinct()
    return stored(classes.join(groups.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key")), "classes")


def similar_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id.

    Null and empty texts and texts without words have no shingles and are groups of their own. Equal sets link.
    A null doc_id takes part in links but names no group unless all its ids are null. Repeated rows are of
    one group. An empty table gives an empty result.
    """
    made = shingled(docs, key, text, width)
    sets, roots = made.sets, set_roots(made)
    least = sets.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("least"))
    named = least.join(roots, "key")
    names = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_key = stored(named.join(names, "root").select("key", "component_id"), "names")
    return (sets.select("doc_id", "n_shingles", "key").join(by_key, "key", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """The row with the smallest id of each group (its copies with one id and text count once), columns unchanged.

    Rows without words (null, empty, white space) are groups of their own and all stay. A null id stays only where all ids of
    a group are null. An empty table stays empty; texts are compared whole; columns may have any name.
    """
    made = shingled(docs, key, text, width)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")).alias("first")
    keepers = made.sets.select("doc_id", "row", "key").where("key is not null").join(set_roots(made), "key").groupBy("root").agg(first)
    keepers = stored(keepers.select(F.struct(F.col("first.doc_id").alias("i"), F.col("first.row").alias("r")).alias("kept")), "keepers")
    plain, names = plain_names(docs), [f"c{docs.columns.index(c)}" for c in (key, text)]
    whole = F.coalesce(F.col(names[1]).cast("string"), F.lit(""))
    worded = whole.rlike(f"[^{SPACES}]")
    own = plain.where(worded).withColumn("kept", F.struct(F.col(names[0]).alias("i"), F.xxhash64(whole).alias("r")))
    kept = own.join(keepers, "kept", "left_semi").dropDuplicates(["kept"]).drop("kept")
    return kept.unionByName(plain.where(~worded)).toDF(*docs.columns)
