"""Gradient boosted regression trees over binned predictors, grown level by level from histograms.

Predictors are cut once at exact quantiles of the training rows. A level of a tree needs, for each of its nodes, predictor
and bin, the number of rows and the sum of their residuals: every task sums its rows, one aggregation adds
the tasks up, and at most ``2^depth * predictors * (bins + 1)`` cells reach the driver. Targets, predictions
and leaf values are whole numbers (24 bits of the largest target), so sums are exact: the model is the same for any
partitioning, and can be computed again in SQL. The splits are a table, the *ledger*.

A training table of up to ``BLOCK_ROWS`` rows is a single block, and there is nothing to add up between tasks;
the same functions then grow all trees in the task that holds it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.functions.checks import require_columns
from meterflow.functions.literals import doubles
from meterflow.operators.quantiles import exact_quantiles
from meterflow.session import materialize
from meterflow.spec import DEFAULT_LAYOUT, Layout

BLOCK_ROWS = 1 << 17
#: Bits of the largest absolute target: sums of 2^38 rows fit 64 bits.
TARGET_BITS = 24
#: Trees after which predictions are stored with the rows instead of computed anew at every level.
STORED_EVERY = 10
LEDGER = "tree int, node int, feature int, bin int, rows long, gain double, value long"


@dataclass(frozen=True)
class BoostConfig:
    """``penalty`` is added to a leaf's row count; a split must gain more than ``min_gain`` (in squared target units)."""

    trees: int = 100
    step: float = 0.1
    depth: int = 6
    bins: int = 64
    penalty: float = 1.0
    min_gain: float = 1e-6


@dataclass(frozen=True)
class _Shape:
    """What tasks need to know of a model in the making."""

    config: BoostConfig
    features: int
    base: int
    unit: float  # one target unit in whole numbers

    @property
    def width(self) -> int:
        return self.config.bins + 1


@dataclass
class _Tree:
    """Arrays over heap-numbered nodes (root 1): split predictor (-1 at a leaf), last bin of its left side, leaf value."""

    feature: np.ndarray
    bin: np.ndarray
    value: np.ndarray
    rows: np.ndarray
    gain: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> _Tree:
        size = 1 << (depth + 1)
        return cls(np.full(size, -1, np.int64), np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size))

    def descend(self, bins: np.ndarray, node: np.ndarray) -> np.ndarray:
        feature = self.feature[node]
        moved = 2 * node + (bins[np.arange(len(bins)), np.maximum(feature, 0)] > self.bin[node])
        return np.where(feature >= 0, moved, node)

    def leaves(self, bins: np.ndarray, depth: int) -> np.ndarray:
        node = np.ones(len(bins), np.int64)
        for _ in range(depth):
            node = self.descend(bins, node)
        return node


def _histogram(bins: np.ndarray, residual: np.ndarray, node: np.ndarray, first: int, shape: _Shape) -> tuple[np.ndarray, np.ndarray]:
    """Rows and residual sums by (node of the level that starts at ``first``, predictor, bin). Sums of a block are exact in doubles."""
    here = node >= first
    local, bins, weights = node[here] - first, bins[here], residual[here].astype(np.float64)
    rows = np.zeros((first, shape.features, shape.width), np.int64)
    sums = np.zeros_like(rows)
    for f in range(shape.features):
        cell = local * shape.width + bins[:, f]
        rows[:, f] = np.bincount(cell, minlength=first * shape.width).reshape(first, -1)
        sums[:, f] = np.bincount(cell, weights, minlength=first * shape.width).reshape(first, -1).astype(np.int64)
    return rows, sums


def _leaf_value(total: np.ndarray, rows: np.ndarray, config: BoostConfig) -> np.ndarray:
    return np.floor(config.step * total.astype(np.float64) / (rows.astype(np.float64) + config.penalty) + 0.5).astype(np.int64)


def _grow(tree: _Tree, rows: np.ndarray, sums: np.ndarray, first: int, shape: _Shape) -> bool:
    """Splits the level's nodes where that gains; ties go to the first predictor, then the lowest bin. False if none split."""
    config = shape.config
    n, s = rows[:, 0].sum(axis=1), sums[:, 0].sum(axis=1)
    left_n, left_s = rows.cumsum(axis=2), sums.cumsum(axis=2)
    right_n, right_s = n[:, None, None] - left_n, s[:, None, None] - left_s

    def score(total: np.ndarray, count: np.ndarray) -> np.ndarray:
        return total.astype(np.float64) * total.astype(np.float64) / (count.astype(np.float64) + config.penalty)

    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (score(left_s, left_n) + score(right_s, right_n) - score(s, n)[:, None, None]) / (shape.unit * shape.unit)
    gain[(left_n == 0) | (right_n == 0)] = -np.inf
    flat = gain.reshape(len(n), -1)
    best = flat.argmax(axis=1)
    split = (flat[np.arange(len(n)), best] > config.min_gain) & (n > 0)
    nodes = first + np.arange(len(n))
    f, b = best // shape.width, best % shape.width
    tree.rows[nodes] = n
    tree.value[nodes] = _leaf_value(s, n, config)
    tree.feature[nodes[split]], tree.bin[nodes[split]] = f[split], b[split]
    tree.gain[nodes[split]] = flat[np.arange(len(n)), best][split]
    at = np.arange(len(n))
    for child, count, total in ((2 * nodes, left_n, left_s), (2 * nodes + 1, right_n, right_s)):
        tree.rows[child[split]] = count[at, f, b][split]
        tree.value[child[split]] = _leaf_value(total[at, f, b][split], count[at, f, b][split], config)
    return bool(split.any())


def _grow_here(bins: np.ndarray, target: np.ndarray, shape: _Shape) -> list[_Tree]:
    predicted = np.full(len(target), shape.base, np.int64)
    trees = []
    for _ in range(shape.config.trees):
        tree = _Tree.empty(shape.config.depth)
        node = np.ones(len(target), np.int64)
        for level in range(shape.config.depth):
            if not _grow(tree, *_histogram(bins, target - predicted, node, 1 << level, shape), 1 << level, shape):
                break
            node = tree.descend(bins, node)
        predicted += tree.value[node]
        trees.append(tree)
    return trees


def _ledger_rows(trees: Sequence[_Tree], first: int = 0) -> list[tuple]:
    return [(first + t, int(k), int(tree.feature[k]), int(tree.bin[k]), int(tree.rows[k]), float(tree.gain[k]), int(tree.value[k]))
            for t, tree in enumerate(trees) for k in np.flatnonzero(tree.rows)]


def _trees_from(rows: Sequence[tuple], config: BoostConfig) -> list[_Tree]:
    trees = [_Tree.empty(config.depth) for _ in range(config.trees)]
    for t, k, feature, cut, n, gain, value in rows:
        tree = trees[t]
        tree.feature[k], tree.bin[k], tree.rows[k], tree.gain[k], tree.value[k] = feature, cut, n, gain, value
    return trees


def _matrix(batch: pa.RecordBatch, features: int) -> np.ndarray:
    return np.column_stack([batch.column(f).to_numpy() for f in range(features)]).astype(np.int64)


def bin_of(value: str | Column, cuts: Sequence[float]) -> Column:
    """0 for a missing value, else one more than the number of cuts below it."""
    value = F.col(value) if isinstance(value, str) else value
    value = F.nanvl(value.cast("double"), F.lit(None).cast("double"))
    below = F.size(F.filter(doubles(cuts), lambda c: c < value)) if len(cuts) else F.lit(0)
    return F.when(value.isNull(), 0).otherwise(1 + below).cast("int")


@dataclass
class BoostedTrees:
    """A fitted model: cuts of each predictor, trees, and whole numbers of one target unit."""

    features: list[str]
    cuts: list[list[float]]
    trees: list[_Tree]
    shape: _Shape

    def _bins(self) -> list[Column]:
        return [bin_of(f, c).alias(f"_b{i}") for i, (f, c) in enumerate(zip(self.features, self.cuts))]

    def predict(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        """``df`` with the model's prediction; rows pass through Arrow batches against the model's few arrays."""
        n, shape, trees = len(self.features), self.shape, self.trees
        columns = df.columns

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                bins = _matrix(batch, n)
                total = np.full(len(bins), shape.base, np.int64)
                for tree in trees:
                    total += tree.value[tree.leaves(bins, shape.config.depth)]
                yield pa.RecordBatch.from_arrays([*batch.columns[n:], pa.array(total / shape.unit)], [*columns, name])

        rows = df.select(*self._bins(), *(F.col(f"`{c}`") for c in columns))
        schema = df.schema.add(name, "double")
        return rows.mapInArrow(run, schema)

    def ledger(self, spark: SparkSession) -> DataFrame:
        """One row per node: tree, node (root 1, children 2n and 2n + 1), predictor and cut of its split (null at a
        leaf; rows up to the cut and missing values go left, a null cut sends missing values alone), rows, gain in squared target units, leaf value."""
        plain = spark.createDataFrame(_ledger_rows(self.trees), LEDGER)
        names = F.array(*map(F.lit, self.features))
        cuts = F.array(*(doubles([None, *c]) for c in self.cuts))  # bin 0 holds missing values only
        split = F.col("feature") >= 0
        inner = F.coalesce(split, F.lit(False))
        return plain.select(
            "tree", "node", F.when(inner, F.get(names, F.greatest("feature", F.lit(0)))).alias("feature"),
            F.when(inner, F.get(F.get(cuts, F.greatest("feature", F.lit(0))), F.col("bin"))).alias("cut"), "rows",
            F.when(inner, F.col("gain")).alias("gain"), F.when(~inner, F.col("value") / self.shape.unit).alias("value"))


def predictor_cuts(train: DataFrame, features: Sequence[str], bins: int, layout: Layout = DEFAULT_LAYOUT) -> list[list[float]]:
    """Distinct exact quantiles of each predictor that divide its training values into ``bins`` parts."""
    long = train.select(*(F.col(f"`{f}`").cast("double").alias(str(i)) for i, f in enumerate(features))).unpivot(
        [], [str(i) for i in range(len(features))], "_f", "_x").where(~F.isnan("_x"))
    found = {r["_f"]: r["quantiles"] for r in exact_quantiles(long, "_x", [k / bins for k in range(1, bins)], ["_f"], layout).collect()}
    return [sorted(set(found.get(str(i), []))) for i in range(len(features))]


def fit_boosted(train: DataFrame, features: Sequence[str], target: str, config: BoostConfig = BoostConfig(),
                layout: Layout = DEFAULT_LAYOUT, block_rows: int = BLOCK_ROWS) -> BoostedTrees:
    """Squared-loss boosting; every tree is grown to its full depth and none is left out. Rows without a target do not count."""
    require_columns(train, [*features, target])
    y = F.col(f"`{target}`").cast("double")
    rows = train.where(y.isNotNull() & ~F.isnan(y))
    cuts = predictor_cuts(rows, features, config.bins, layout)
    largest = rows.agg(F.max(F.abs(y))).first()[0]
    if largest is None:
        raise ValueError("no training rows")
    unit = 2.0 ** (TARGET_BITS - math.ceil(math.log2(largest + 1)))
    table = materialize(rows.select(*(bin_of(F.col(f"`{f}`"), c).cast("short").alias(f"_b{i}") for i, (f, c) in enumerate(zip(features, cuts))),
                                    F.floor(y * unit + 0.5).cast("long").alias("_y")))
    count, total = table.agg(F.count("*"), F.sum(F.col("_y").cast("decimal(38,0)"))).first()
    shape = _Shape(config, len(features), int(total) // count, unit)
    if count <= block_rows:
        grown = _trees_from([tuple(r) for r in table.coalesce(1).mapInArrow(_grown(shape), LEDGER).collect()], config)
    else:
        grown = _grow_over(table, shape)
    return BoostedTrees(list(features), cuts, grown, shape)


def _grown(shape: _Shape):
    names = [c.split()[0] for c in LEDGER.split(", ")]
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.float64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            bins = np.concatenate([_matrix(b, shape.features) for b in held])
            target = np.concatenate([b.column(shape.features).to_numpy() for b in held])
            rows = _ledger_rows(_grow_here(bins, target, shape))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return run


def _grow_over(table: DataFrame, shape: _Shape) -> list[_Tree]:
    """One aggregation over all tasks for each level of each tree."""
    depth, trees = shape.config.depth, []
    table, stored_trees = table.withColumn("_p", F.lit(shape.base).cast("long")), 0
    for _ in range(shape.config.trees):
        if len(trees) - stored_trees == STORED_EVERY:
            table, stored_trees = materialize(table.mapInArrow(_advance(trees[stored_trees:], shape), table.schema)), len(trees)
        tree = _Tree.empty(depth)
        for level in range(depth):
            cells = (table.mapInArrow(_cells(trees[stored_trees:], tree, level, shape), "cell long, n long, s long")
                     .groupBy("cell").agg(F.sum("n"), F.sum("s")).collect())
            rows = np.zeros((1 << level) * shape.features * shape.width, np.int64)
            sums = np.zeros_like(rows)
            for cell, n, s in cells:
                rows[cell], sums[cell] = n, s
            grid = (1 << level, shape.features, shape.width)
            if not _grow(tree, rows.reshape(grid), sums.reshape(grid), 1 << level, shape):
                break
        trees.append(tree)
    return trees


def _advance(trees: list[_Tree], shape: _Shape):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = _matrix(batch, shape.features)
            predicted = batch.column(shape.features + 1).to_numpy() + sum(t.value[t.leaves(bins, shape.config.depth)] for t in trees)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(predicted)], batch.schema.names)

    return run


def _cells(trees: list[_Tree], tree: _Tree, level: int, shape: _Shape):
    """A task's rows and residual sums by cell of the level's histogram."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = np.zeros(((1 << level), shape.features, shape.width), np.int64)
        sums = np.zeros_like(rows)
        for batch in batches:
            bins = _matrix(batch, shape.features)
            residual = batch.column(shape.features).to_numpy() - batch.column(shape.features + 1).to_numpy()
            for t in trees:
                residual = residual - t.value[t.leaves(bins, shape.config.depth)]
            n, s = _histogram(bins, residual, tree.leaves(bins, level), 1 << level, shape)
            rows += n
            sums += s
        used = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(rows.ravel()[used]), pa.array(sums.ravel()[used])], ["cell", "n", "s"])

    return run


def importance(ledger: DataFrame, features: Sequence[str]) -> DataFrame:
    """Average gain per split of each predictor, 0 if unused, and its number of splits; ascending by importance."""
    names = ledger.sparkSession.createDataFrame([(f,) for f in features], "feature string")
    gains = ledger.where("feature is not null").groupBy("feature").agg(F.avg("gain").alias("importance"), F.count("*").alias("splits"))
    return (names.join(gains, "feature", "left").select("feature", F.coalesce("importance", F.lit(0.0)).alias("importance"),
                                                         F.coalesce("splits", F.lit(0)).alias("splits")).orderBy("importance", "feature"))
