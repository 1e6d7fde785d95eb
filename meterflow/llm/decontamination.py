"""Benchmark decontamination by latent semantic retrieval.

Texts are coded over the benchmark's own vocabulary (other words have no part in any item). A randomised
SVD of the TF-IDF matrix of all passages of the corpus and of the benchmark spans a latent space: with a
random matrix O, every task adds its part of ``A'(A O)``, and the sum is made orthonormal. All directions
are kept, so no further rotation is needed; it would not change a cosine. Each text is searched at every
eighth word in windows that just hold an item, and pairs of window and item with a high cosine, or with enough
of the item's rarer word pairs whatever the cosine, are checked by words in common and by their longest common
subsequence. So a copy is checked however many items there are. Between sure and doubtful shares the item's
answer (its last sentence) must be there, too.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from meterflow.llm.common import map_batches, stored, texts
from meterflow.llm.licences import words

STEP = 8  # words of a block
PASSAGE = 4  # blocks of a passage of the matrix
#: Directions up to so many items; beyond, they grow with the square root of the items.
DIRECTIONS, ITEMS = 48, 200
#: Part of an item's word pairs, rarest first, that are looked up, and share of them that a window needs.
RARER, PAIRS = 0.5, 0.2
#: Cosine of candidates; shares of an item's words: sure, enough with the answer, and of the answer itself.
COSINE, SURE, ENOUGH, ANSWER = 0.5, 0.8, 0.6, 0.8
#: Items with fewer words say too little for a latent space: they are found word by word, exactly.
LEAST_WORDS = 8
#: Words of a benchmark at most: items and vocabulary are sent to every task.
MOST_WORDS = 5_000_000
#: Words that are worked on at once.
CHUNK = 1 << 15


@dataclass
class Benchmark:
    items: list[int]
    codes: list[np.ndarray]
    answers: list[np.ndarray]
    vocabulary: dict[bytes, int] = field(default_factory=dict)
    short: dict[int, dict[bytes, list[int]]] = field(default_factory=dict)  # words, codes, places of the items

    @property
    def size(self) -> int:
        return len(self.vocabulary) + 1

    @property
    def kind(self) -> type:
        return np.uint16 if self.size <= 1 << 16 else np.uint32


def read_benchmark(benchmark: DataFrame, item: str = "item_id", text: str = "text", least_words: int = LEAST_WORDS) -> Benchmark:
    """Distinct items, the short ones last. Null texts and texts without words are no items. A benchmark of too many words is an error."""
    rows = benchmark.select(F.col(f"`{item}`").alias("i"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))
    size = rows.agg(F.sum(F.length("t"))).first()[0] or 0
    if size > MOST_WORDS * 8:
        raise ValueError(f"the benchmark has {size} characters; it is sent to every task and may have {MOST_WORDS * 8}")
    found = Benchmark([], [], [])
    code = found.vocabulary
    kept = [(row, words(row["t"])) for row in sorted(rows.distinct().collect(), key=lambda r: (r["i"] is None, r["i"] or 0, r["t"]))]
    for row, tokens in kept:
        if len(tokens) < least_words:
            continue
        sentences = [s for s in re.split(r"(?<=[.!?])\s+", row["t"]) if words(s)]
        found.items.append(row["i"])
        found.codes.append(np.array([code.setdefault(w, len(code) + 1) for w in tokens]))
        found.answers.append(np.array([code[w] for w in words(sentences[-1])]))
    for row, tokens in kept:
        if 0 < len(tokens) < least_words:
            codes = np.array([code.setdefault(w, len(code) + 1) for w in tokens], np.int64).tobytes()
            found.short.setdefault(len(tokens), {}).setdefault(codes, []).append(len(found.items))
            found.items.append(row["i"])
    return found


def short_items(benchmark: Benchmark, codes: np.ndarray) -> dict[int, float]:
    """The short items whose words stand one after another in a coded text."""
    found = {}
    codes = codes.astype(np.int64)
    for n, items in benchmark.short.items():
        if len(codes) < n:
            continue
        starts = np.flatnonzero(np.isin(codes[:len(codes) - n + 1], [np.frombuffer(c, np.int64)[0] for c in items]))
        for at in starts.tolist():
            for k in items.get(codes[at:at + n].tobytes(), ()):
                found[k] = 1.0
    return found


def _code(vocabulary: dict[bytes, int], kind: type):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coded = []
            for value in batch.column(1):
                tokens = words(value.as_py())
                coded.append(np.fromiter(map(vocabulary.get, tokens, repeat(0)), kind, len(tokens)).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(coded, pa.binary())], ["doc_id", "codes"])

    return run


def blocks(coded: list[np.ndarray], per: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Codes padded by zeros to whole groups of ``per`` blocks a text, as rows of one block; first block of each text and the end."""
    counts = np.array([-(-len(c) // (STEP * per)) * per for c in coded], np.int64)
    first = np.concatenate([[0], np.cumsum(counts)])
    out = np.zeros(first[-1] * STEP, np.int64)
    for at, c in zip((first * STEP).tolist(), coded):
        out[at:at + len(c)] = c
    return out.reshape(-1, STEP), first


def _chunks(values: Iterator[np.ndarray]) -> Iterator[list[np.ndarray]]:
    chunk, size = [], 0
    for value in values:
        chunk.append(value)
        size += len(value)
        if size >= CHUNK:
            yield chunk
            chunk, size = [], 0
    if chunk:
        yield chunk


def _frequencies(size: int, kind: type):
    """In how many blocks each word occurs; row 0 has the number of blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for chunk in _chunks(np.frombuffer(v.as_buffer(), kind) for v in batch.column(0)):
                rows = np.sort(blocks(chunk)[0], axis=1)
                new = np.ones(rows.shape, bool)
                new[:, 1:] = rows[:, 1:] != rows[:, :-1]
                total += np.bincount(rows[new], minlength=size)
                total[0] += len(rows) - np.count_nonzero(rows[:, 0] == 0)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["word", "n"])

    return run


def products(rows: np.ndarray, weighted: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """A'(A O) of passages given as rows of codes; ``weighted`` is O with rows times idf (row 0 is zero)."""
    y = weighted[rows].sum(axis=1)
    flat = rows.ravel()
    order = np.argsort(flat, kind="stable")
    order = order[np.searchsorted(flat[order], 1):]
    out = np.zeros_like(weighted)
    if len(order):
        terms = flat[order]
        starts = np.flatnonzero(np.concatenate([[True], terms[1:] != terms[:-1]]))
        out[terms[starts]] = np.add.reduceat(y[order // rows.shape[1]], starts, axis=0)
    return out * idf[:, None]


def _sketch(weighted: np.ndarray, idf: np.ndarray, kind: type):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(weighted.shape)
        for batch in batches:
            for chunk in _chunks(np.frombuffer(v.as_buffer(), kind) for v in batch.column(0)):
                rows = blocks(chunk, PASSAGE)[0].reshape(-1, STEP * PASSAGE)
                total += products(rows, weighted, idf)
        at = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), *(pa.array(c) for c in total[at].T)],
                                         ["word", *(f"c{i}" for i in range(total.shape[1]))])

    return run


@dataclass
class Space:
    benchmark: Benchmark
    basis: np.ndarray  # word -> latent direction times idf
    idf: np.ndarray


def coded_texts(rows: DataFrame, benchmark: Benchmark) -> DataFrame:
    """Stored doc_id and codes of whole texts over the benchmark's vocabulary."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    return stored(rows.mapInArrow(_code(benchmark.vocabulary, benchmark.kind), f"doc_id {kind}, codes binary"), "codes")


def fit_space(coded: DataFrame, benchmark: Benchmark, directions: int | None = None, seed: int = 7) -> Space:
    """Latent space of all passages. One row for each benchmark word reaches the driver, from the whole corpus.

    The benchmark's own passages enter with the weight of the whole corpus, so that its rare words keep directions.
    """
    size, kind = benchmark.size, benchmark.kind
    directions = directions or int(DIRECTIONS * max(1.0, len(benchmark.items) / ITEMS) ** 0.5)
    directions, coded = min(directions, size), coded.select("codes")
    counts = np.zeros(size)
    for row in coded.mapInArrow(_frequencies(size, kind), "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect():
        counts[row["word"]] = row["n"]
    idf = np.log((counts[0] + 2) / (counts + 1)).astype(np.float32)
    idf[0] = 0
    weighted = np.random.default_rng(seed).standard_normal((size, directions)).astype(np.float32) * idf[:, None]
    names = [f"c{i}" for i in range(directions)]
    total = np.zeros((size, directions))
    parts = coded.mapInArrow(_sketch(weighted, idf, kind), "word long, " + ", ".join(f"{n} double" for n in names))
    for row in parts.groupBy("word").agg(*[F.sum(n).alias(n) for n in names]).collect():
        total[row["word"]] = row[1:]
    own = np.zeros_like(total)
    for codes in benchmark.codes:
        own += products(codes[None, :], weighted, idf)
    total += own * (np.linalg.norm(total) / max(np.linalg.norm(own), 1e-12) if total.any() else 1.0)
    basis = np.linalg.qr(total)[0].astype(np.float32)
    return Space(benchmark, basis * idf[:, None], idf)


def common_subsequence(x: np.ndarray, y: np.ndarray) -> int:
    """Length of the longest common subsequence, a machine word at a time."""
    at: dict[int, int] = {}
    for i, code in enumerate(x.tolist()):
        at[code] = at.get(code, 0) | 1 << i
    full = (1 << len(x)) - 1
    v = full
    for code in y.tolist():
        u = v & at.get(code, 0)
        v = ((v + u) | (v - u)) & full
    return len(x) - v.bit_count()


class Searcher:
    def __init__(self, space: Space, cosine: float, sure: float, enough: float, answer: float):
        self.space, self.cosine, self.sure, self.enough, self.answer = space, cosine, sure, enough, answer
        b = space.benchmark
        latent = np.stack([space.basis[c].sum(axis=0) for c in b.codes])
        self.latent = latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)
        self.scales: dict[int, list[int]] = {}
        for k, codes in enumerate(b.codes):
            self.scales.setdefault(-(-len(codes) // STEP) + 1, []).append(k)
        self.known = np.zeros((len(b.codes), b.size), bool)
        for k, codes in enumerate(b.codes):
            self.known[k, codes] = True
        self.need = np.array([self.enough * len(codes) for codes in b.codes])
        self._post_pairs()

    def _post_pairs(self) -> None:
        """For each item its rarer word pairs, as a sorted index from pair to items with a bit table in front."""
        b, idf = self.space.benchmark, self.space.idf
        pairs = [np.unique(c[:-1] * b.size + c[1:]) for c in b.codes]
        keys, at, n = np.unique(np.concatenate(pairs), return_inverse=True, return_counts=True)
        rare = idf[keys // b.size] + idf[keys % b.size] - np.log(n)
        posted, start = [], 0
        for k, own in enumerate(pairs):
            own = at[start:start + len(own)]
            start += len(own)
            posted.append(own[np.argsort(-rare[own], kind="stable")][:-int(-len(own) * RARER // 1)])
        item = np.repeat(np.arange(len(posted)), [len(p) for p in posted])
        flat = np.concatenate(posted)
        order = np.argsort(flat, kind="stable")
        used, self.pair_first = np.unique(flat[order], return_index=True)
        self.pair_keys, self.pair_items = keys[used], item[order]
        self.pair_first = np.append(self.pair_first, len(flat))
        self.pair_need = np.array([max(1, int(np.ceil(PAIRS * len(p)))) for p in posted])
        self.scale = np.array([-(-len(c) // STEP) + 1 for c in b.codes])
        self.shift = np.uint64(64 - max(16, min(26, 5 + len(used).bit_length())))
        self.pair_bits = np.zeros(1 << (64 - int(self.shift)), bool)
        self.pair_bits[self._slots(self.pair_keys)] = True

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift

    def _paired(self, rows: np.ndarray, first: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First block and item of all windows that hold enough of an item's posted pairs."""
        flat = rows.ravel()
        at = np.flatnonzero((flat[:-1] > 0) & (flat[1:] > 0))
        keys = flat[at] * self.space.benchmark.size + flat[at + 1]
        hit = self.pair_bits[self._slots(keys)]
        at, keys = at[hit], keys[hit]
        place = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        hit = self.pair_keys[place] == keys
        at, place = at[hit], place[hit]
        n = self.pair_first[place + 1] - self.pair_first[place]
        item = self.pair_items[np.repeat(self.pair_first[place] - np.cumsum(n) + n, n) + np.arange(n.sum())]
        width = len(rows) + int(self.scale.max()) + 1
        placed = np.sort(item * width + np.repeat(at // STEP, n))
        item = placed // width
        enough = np.searchsorted(placed, placed + self.scale[item]) - np.arange(len(placed)) >= self.pair_need[item]
        placed = np.unique(placed[enough])
        item, block = np.divmod(placed, width)
        # the copy may start before its first posted pair
        back = self.scale[item]
        item, last = np.repeat(item, back), np.repeat(block, back)
        block = last - (np.arange(back.sum()) - np.repeat(np.cumsum(back) - back, back))
        good = block >= first[owner[last]]
        placed = np.unique(item[good] * width + block[good])
        return placed % width, placed // width

    def search(self, coded: list[np.ndarray]) -> list[dict[int, float]]:
        """For each text the items that it holds, and the share of their words."""
        rows, first = blocks(coded)
        found: list[dict[int, float]] = [{} for _ in coded]
        if not len(rows):
            return found
        owner = np.repeat(np.arange(len(coded)), np.diff(first))
        sums = np.zeros((len(rows) + 1, self.latent.shape[1]), np.float32)  # of one chunk, so single precision will do
        np.cumsum(np.einsum("ijk->ik", np.take(self.space.basis, rows, axis=0)), axis=0, out=sums[1:])
        held = np.concatenate([[0], np.cumsum(np.count_nonzero(rows, axis=1))])
        paired, pair_item = self._paired(rows, first, owner)
        for scale, items in self.scales.items():
            own = self.scale[pair_item] == scale
            start, item = paired[own], pair_item[own]
            end = np.minimum(start + scale, first[owner[start] + 1])
            for w, k in zip(*self._worded(rows, held, start, end, np.arange(len(start)), item, scale)):
                self._check(coded, first, int(owner[start[w]]), int(start[w]), int(end[w]), int(k), found)
            start = np.arange(len(rows))
            end = np.minimum(start + scale, first[owner + 1])
            # fewer benchmark words than the shortest item needs cannot hold one
            start = start[held[end] - held[start] >= self.enough * min(len(self.space.benchmark.codes[k]) for k in items)]
            end = np.minimum(start + scale, first[owner[start] + 1])
            z = np.take(sums, end, axis=0) - np.take(sums, start, axis=0)
            near = z @ self.latent[items].T >= self.cosine * np.sqrt(np.einsum("ij,ij->i", z, z))[:, None]
            window, column = np.divmod(np.flatnonzero(near), len(items))
            for w, k in zip(*self._worded(rows, held, start, end, window, np.array(items)[column], scale)):
                self._check(coded, first, int(owner[start[w]]), int(start[w]), int(end[w]), int(k), found)
        return found

    def _worded(self, rows, held, start, end, window, item, scale) -> tuple[list[int], list[int]]:
        """Candidates whose window has enough words of the item, and so of the benchmark at least."""
        kept = ([], [])
        some = (held[end] - held[start])[window] >= self.need[item]
        window, item = window[some], item[some]
        if not len(window):
            return kept
        padded = np.concatenate([rows, np.zeros((1, STEP), rows.dtype)])
        known, size = self.known.ravel(), self.known.shape[1]
        for a in range(0, len(window), 4096):
            w, k = window[a:a + 4096], item[a:a + 4096]
            at = start[w][:, None] + np.arange(scale)
            codes = np.take(padded, np.where(at < end[w][:, None], at, len(rows)), axis=0).reshape(len(w), -1)
            good = np.count_nonzero(np.take(known, codes + (k * size)[:, None]), axis=1) >= self.need[k]
            kept[0].extend(w[good].tolist())
            kept[1].extend(k[good].tolist())
        return kept

    def _check(self, coded, first, text: int, start: int, end: int, k: int, found: list[dict[int, float]]) -> None:
        item, answer = self.space.benchmark.codes[k], self.space.benchmark.answers[k]
        at = (start - int(first[text])) * STEP
        region = coded[text][max(0, at - STEP):at + (end - start + 1) * STEP]
        share = common_subsequence(item, region) / len(item)
        if share < self.enough or share < self.sure and common_subsequence(answer, region) < self.answer * len(answer):
            return
        found[text][k] = max(share, found[text].get(k, 0.0))


def _searched(space: Space, bounds: tuple[float, ...], column: int):
    """(batch, items of each row) for batches whose text, or its codes, stand in ``column``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[dict[int, float]]]]:
        known = space.benchmark
        searcher, get, kind = Searcher(space, *bounds) if known.codes else None, known.vocabulary.get, known.kind

        def search(chunk: list[np.ndarray]) -> list[dict[int, float]]:
            found = searcher.search(chunk) if searcher else [{} for _ in chunk]
            if known.short:
                for own, codes in zip(found, chunk):
                    own.update(short_items(known, codes))
            return found

        for batch in batches:
            values = batch.column(column)
            if pa.types.is_binary(values.type):
                coded = (np.frombuffer(v.as_buffer(), kind) for v in values)
            else:
                coded = ((lambda t: np.fromiter(map(get, t, repeat(0)), kind, len(t)))(words(v.as_py() or "")) for v in values)
            yield batch, [f for chunk in _chunks(coded) for f in search(chunk)]

    return run


def find_items(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", cosine: float = COSINE, sure: float = SURE,
               enough: float = ENOUGH, answer: float = ANSWER) -> DataFrame:
    """Per row: doc_id and the items it holds with the share of their words, by item.

    Null and empty texts hold none. Whole texts are searched, however long, repeated rows each. An empty benchmark is found
    nowhere; equal items are all reported. An empty table gives an empty result.
    """
    rows = texts(docs, key, text)
    items = f"array<struct<item_id:{benchmark.schema['item_id'].dataType.simpleString()},share:double>>"
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, items {items}"
    known = read_benchmark(benchmark)
    if not known.items:
        return rows.select("doc_id", F.array().cast(items).alias("items"))
    coded = coded_texts(rows, known)
    search = _searched(fit_space(coded, known), (cosine, sure, enough, answer), 1)
    kinds = pa.list_(pa.struct([("item_id", to_arrow_type(benchmark.schema["item_id"].dataType)), ("share", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in search(batches):
            held = [[{"item_id": known.items[k], "share": s} for k, s in sorted(f.items())] for f in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(held, kinds)], ["doc_id", "items"])

    return coded.mapInArrow(run, schema)


def without_items(docs: DataFrame, benchmark: DataFrame, text: str = "text", cosine: float = COSINE, sure: float = SURE,
                  enough: float = ENOUGH, answer: float = ANSWER) -> DataFrame:
    """The rows that hold no item, with their columns unchanged.

    Null and empty texts hold none and stay. Whole texts are searched, repeated rows each; an empty table stays empty, and an
    empty benchmark leaves all rows.
    """
    known = read_benchmark(benchmark)
    if not known.items:
        return docs
    coded = coded_texts(docs.select(F.lit(0).alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text")), known)
    search = _searched(fit_space(coded, known), (cosine, sure, enough, answer), docs.columns.index(text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in search(batches):
            yield batch.filter(pa.array([not f for f in found], pa.bool_()))

    return map_batches(docs, run)


def contamination_report(found: DataFrame) -> DataFrame:
    return found.select("doc_id", (F.size("items") > 0).alias("contaminated"), F.size("items").cast("long").alias("n_items"),
                        F.array_join(F.array_sort(F.col("items.item_id")), ",").alias("item_ids"),
                        F.coalesce(F.array_max("items.share"), F.lit(0.0)).alias("best_share"))
