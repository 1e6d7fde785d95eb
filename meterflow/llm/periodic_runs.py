"""Maximal runs of periodically repeated words by maximal pairs of a text's LCP-interval tree.

A run is a stretch of words with smallest period ``q`` and a length of ``EXPONENT * q`` or more that no
neighbouring word extends. Its words without the last ``q`` ones stand again ``q`` words on, so (start,
start + q) is a *maximal pair*: two places with equal words for a length ``l``, other words before them and
other words behind. The other way round, a maximal pair at a distance ``d <= l / (EXPONENT - 1)`` spans a
stretch of period ``d`` that cannot be extended, because its ends were compared when the pair was found; of
pairs over one stretch, the nearest has the smallest period. So runs are read off pairs, with no extension.

Pairs come from the tree bottom up. A node (LCP interval) has the length ``l`` that its places share, the
places in text order, and the *block starts* of its lists of places by word to the left: the places whose
predecessor in the node has another word before it. When a child joins a node, each place of the smaller
side looks for places of the other within ``l / (EXPONENT - 1)`` words and skips, from block start to block start,
those with its own left word. Every place moves a logarithmic number of times, and the pairs met are
those reported: their number is bounded by the sum of the runs' exponents.

Texts are independent, so this is one pass of Arrow batches without a shuffle.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.llm.common import SPACES, texts

#: A run is at least so many words long, and at least so many periods.
LENGTH, EXPONENT = 6, 4
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)


def _dense(values: np.ndarray) -> np.ndarray:
    """Ranks from 1 of whole numbers, equal ones alike, in their order."""
    return np.unique(values, return_inverse=True)[1] + 1


def _shifted(values: np.ndarray, by: int) -> np.ndarray:
    """The value ``by`` places on, 0 behind the end."""
    out = np.zeros_like(values)
    if by < len(values):
        out[:len(values) - by] = values[by:]
    return out


def shortest_pair(length: int, exponent: int) -> int:
    """Words that the two places of any qualifying pair share at least: a run's length without its period."""
    period = 1
    least = max(length, exponent) - 1
    while period * exponent < length:
        period += 1
        least = min(least, max(length, exponent * period) - period)
    return least


def _may_repeat(codes: np.ndarray, width: int) -> bool:
    """Whether some ``width`` words stand twice; hashes may only err towards yes."""
    n = len(codes) - width + 1
    if n < 2:
        return False
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total += codes[k:k + n].astype(np.uint64) * _FACTORS[k % 5] * np.uint64(2 * (k // 5) + 1)
    total.sort()
    return bool((total[1:] == total[:-1]).any())


def _start_ranks(codes: np.ndarray, width: int) -> np.ndarray:
    """Ranks of all places by their first ``width`` words, in the order of the words."""
    first = ranks = _dense(codes)
    have, top = 1, len(codes) + 1
    while have < width:
        step = have if 2 * have <= width else 1
        ranks = _dense(ranks * top + _shifted(ranks if step == have else first, have))
        have += step
    return ranks


def suffix_order(codes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Places whose first ``width`` words stand twice or more, in suffix order, and for each the length it shares
    with the one before it (0 where the first ``width`` words differ)."""
    n = len(codes)
    starts = _start_ranks(codes, width)
    order = np.argsort(starts, kind="stable")
    sorted_ranks = starts[order]
    head = np.flatnonzero(np.concatenate([[True], sorted_ranks[1:] != sorted_ranks[:-1]]))
    rank = np.empty(n, np.int64)
    sizes = np.diff(np.append(head, n))
    rank[order] = np.repeat(head, sizes)
    slots = np.flatnonzero(np.repeat(sizes > 1, sizes))
    active, opened = slots, width
    while len(active):
        places = order[active]
        behind = places + opened
        second = np.where(behind < n, rank[np.minimum(behind, n - 1)] + 1, 0)
        key = rank[places] * (n + 1) + second
        turn = np.argsort(key, kind="stable")
        places, key = places[turn], key[turn]
        order[active] = places
        fresh = np.concatenate([[True], key[1:] != key[:-1]])
        head = np.flatnonzero(fresh)
        sizes = np.diff(np.append(head, len(key)))
        rank[places] = np.repeat(active[head], sizes)
        active = active[np.repeat(sizes > 1, sizes)]
        opened *= 2
    return order[slots], _shared_lengths(codes, starts, order[slots], width)


def _shared_lengths(codes: np.ndarray, starts: np.ndarray, places: np.ndarray, width: int) -> np.ndarray:
    """Kasai's pass in text order over those places; a place behind its predecessor keeps all but one word."""
    before = np.full(len(codes), -1, np.int64)
    same = starts[places[1:]] == starts[places[:-1]]
    before[places[1:][same]] = places[:-1][same]
    words, n, shared, result = codes.tolist(), len(codes), 0, {}
    for at, other in zip(sorted(places.tolist()), before[np.sort(places)].tolist()):
        if other < 0:
            result[at], shared, last = 0, 0, at
            continue
        shared = max(shared - (at - last), width) if shared else width
        while at + shared < n and other + shared < n and words[at + shared] == words[other + shared]:
            shared += 1
        result[at], last = shared, at
    return np.array([result[p] for p in places.tolist()], np.int64)


class _Node:
    """Places of an LCP interval in text order, and the starts of their blocks of one left word."""

    __slots__ = ("places", "starts")

    def __init__(self, place: int):
        self.places, self.starts = [place], [place]

    def add(self, place: int, left: list[int]) -> None:
        at = bisect_left(self.places, place)
        word = left[place]
        if at < len(self.places):
            behind = self.places[at]
            was = at == 0 or left[self.places[at - 1]] != left[behind]
            if was and left[behind] == word:
                del self.starts[bisect_left(self.starts, behind)]
            elif not was and left[behind] != word:
                insort(self.starts, behind)
        if at == 0 or left[self.places[at - 1]] != word:
            insort(self.starts, place)
        self.places.insert(at, place)

    def near(self, place: int, reach: int, left: list[int]) -> Iterator[int]:
        """Places within ``reach`` words of one that is not in the node, whose left words differ from its own."""
        places, word = self.places, left[place]
        at = bisect_left(places, place)
        k = at
        while k < len(places) and places[k] <= place + reach:
            if left[places[k]] != word:
                yield places[k]
                k += 1
            else:  # on to the next block
                s = bisect_left(self.starts, places[k] + 1)
                k = bisect_left(places, self.starts[s]) if s < len(self.starts) else len(places)
        k = at - 1
        while k >= 0 and places[k] >= place - reach:
            if left[places[k]] != word:
                yield places[k]
                k -= 1
            else:  # back to the place before this block
                k = bisect_left(places, self.starts[bisect_left(self.starts, places[k] + 1) - 1]) - 1


def _joined(big: _Node, small: _Node, shared: int, left: list[int], length: int, exponent: int, found: dict) -> _Node:
    """One node of both sides' places; their maximal pairs go to ``found``: (start, length) with smallest distance."""
    if len(small.places) > len(big.places):
        big, small = small, big
    reach = shared // (exponent - 1)
    for place in small.places:
        for other in big.near(place, reach, left):
            start, distance = min(place, other), abs(place - other)
            if shared + distance >= length:
                key = (start, shared + distance)
                found[key] = min(distance, found.get(key, distance))
    for place in small.places:
        big.add(place, left)
    return big


def find_runs(codes: np.ndarray, length: int = LENGTH, exponent: int = EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a sequence of whole numbers, by start, then period."""
    width = shortest_pair(length, exponent)
    codes = np.asarray(codes, np.int64)
    if not _may_repeat(codes, width):
        return []
    places, shared = suffix_order(codes, width)
    if not len(places):
        return []
    # a place whose nearest place with the same first words is too far for the most it shares with any is in no pair
    group = np.cumsum(shared == 0)
    by_place = np.lexsort((places, group))
    gap = np.diff(places[by_place]).astype(np.float64)
    gap[np.diff(group[by_place]) != 0] = np.inf
    nearest = np.empty(len(places))
    nearest[by_place] = np.minimum(np.append(gap, np.inf), np.insert(gap, 0, np.inf))
    most = np.maximum(shared, np.append(shared[1:], 0))
    useful = np.flatnonzero(nearest <= most // (exponent - 1))
    if not len(useful):
        return []
    lengths = np.minimum.reduceat(shared[:useful[-1] + 1], np.insert(useful[:-1] + 1, 0, 0)).tolist()
    left = np.insert(codes[:-1], 0, -1).tolist()
    found: dict[tuple[int, int], int] = {}
    stack: list[tuple[int, _Node]] = []  # open nodes from the root down: length shared with the one before, node

    def close(down_to: int) -> None:
        while len(stack) > 1 and stack[-1][0] > down_to:
            shared_, node = stack.pop()
            above, other = stack.pop()
            stack.append((above, _joined(other, node, shared_, left, length, exponent, found)))

    for place, common in zip(places[useful].tolist(), [0, *lengths[1:]]):
        close(common)
        if not common:
            stack.clear()
        stack.append((common, _Node(place)))
    close(0)
    return sorted(((s, n, d) for (s, n), d in found.items()), key=lambda r: (r[0], r[2]))


def _codes(words: list[bytes]) -> np.ndarray:
    numbers: dict[bytes, int] = {}
    return np.array([numbers.setdefault(w, len(numbers) + 1) for w in words], np.int64)


def kept_words(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words that no run contains after its first period."""
    if not runs:
        return words
    drop = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    return [w for w, covered in zip(words, np.cumsum(drop).tolist()) if not covered]


def _scan(length: int, exponent: int):
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, runs, collapsed = [], [], []
            for value in batch.column(1):
                words = value.as_py().encode("utf-8", "surrogatepass").split()
                found = find_runs(_codes(words), length, exponent) if len(words) >= length else []
                counts.append(len(words))
                runs.append([{"start": s, "length": n, "period": p} for s, n, p in found])
                collapsed.append(b" ".join(kept_words(words, found)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(runs, run_type),
                                              pa.array(collapsed, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

    return run


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, exponent: int = EXPONENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, runs (array of start, length, period) and the collapsed text.

    Words are maximal runs of anything but ASCII white space, numbered from 0. The collapsed text has the words that
    no run contains after its first period, joined by one blank. Null and empty texts and texts of white space alone have
    no words, no runs and an empty collapsed text; whole texts are read, however long. Repeated rows and rows with one
    or a null id each give a row; ids keep their type. An empty table gives an empty result. Other columns are not read.
    """
    rows = texts(docs, key, text)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_scan(length, exponent), f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def word_array(text: Column) -> Column:
    return F.filter(F.split(text, f"[{SPACES}]+"), lambda w: w != "")


def planted(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and text; the words of every tenth document (by checksum of its id) turn periodic from some place on.

    With ``h`` the checksum, ``g = h div 10`` and ``n`` words: word i from ``a = g mod n`` on becomes word
    ``a + (i - a) mod p``, ``p = 1 + (n - a) div (3 + g mod 8)``. A null id plants nothing.
    """
    rows = texts(docs, key, text)
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")

    def periodic(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8)).cast("long")
        tail = F.transform(F.sequence(a, n - 1), lambda i: F.element_at(words, (a + (i - a) % p + 1).cast("int")))
        return F.when(F.size(words) > 0, F.array_join(F.concat(F.slice(words, F.lit(1), a.cast("int")), tail), " ")).otherwise("")

    once = F.transform(F.array(word_array(F.col("text"))), periodic)  # the words are taken once
    return rows.select("doc_id", F.when(h % 10 == 0, F.element_at(once, 1)).otherwise(F.col("text")).alias("text"))


def run_report(found: DataFrame) -> DataFrame:
    """Digest columns of ``periodic_runs``: the run with the most repetitions, and checksums of all runs and of the text."""
    longer = lambda a, b: a["length"] * b["period"] - b["length"] * a["period"]
    by_exponent = F.array_sort("runs", lambda a, b: F.when(longer(a, b) > 0, -1).when(longer(a, b) < 0, 1)
                               .when(a["start"] != b["start"], F.signum(a["start"] - b["start"]).cast("int"))
                               .otherwise(F.signum(a["period"] - b["period"]).cast("int")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    top = F.col("top")
    return (found.withColumn("top", F.when(F.size("runs") > 0, F.element_at(by_exponent, 1)))
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), top["start"].alias("start"), top["length"].alias("length"),
                    top["period"].alias("period"), F.expr("1000 * top.length div top.period").alias("exponent_milli"),
                    F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")))
