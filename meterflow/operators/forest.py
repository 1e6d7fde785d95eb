"""Isolation forest as a Spark job: bounded samples, trees built per group, vectorised scoring.

Method: Liu, Ting and Zhou, "Isolation Forest" (2008). Every tree sees ``min(256, n)`` rows, and every draw is
a digest: of a row's key for the sample, of (seed, tree, node) for a cut. So neither partitioning nor retries
nor the order of rows change the forest, and SQL can grow the same one. Values are read at nine decimals, so the last bits of
windowed sums decide no cut. The fitted forest has at most ``trees * 511`` nodes; like any fitted model it travels
to the scoring tasks whole.
"""

from __future__ import annotations

import hashlib
import math
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterflow.functions.checks import require_columns
from meterflow.operators.quantiles import exact_quantile_values
from meterflow.session import materialize
from meterflow.spec import DEFAULT_LAYOUT, Layout

# Task functions travel by value, so executors do not need this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SAMPLE = 256
#: Row draws are whole numbers below this prime, so that a tree number times a draw fits 64 bits.
PRIME = (1 << 53) - 111
DECIMALS = 9
_EULER = 0.5772156649015329


def mean_path(n: np.ndarray) -> np.ndarray:
    """Average path length of an unsuccessful search among ``n`` points."""
    n = np.asarray(n, dtype=float)
    harmonic = np.log(np.maximum(n - 1, 1)) + _EULER
    long = 2 * harmonic - 2 * (n - 1) / np.maximum(n, 1)
    return np.where(n > 2, long, np.where(n == 2, 1.0, 0.0))


def digest_share(*parts: object) -> float:
    """A number from 0 up to 1, the same for the same parts in any engine."""
    return int(hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()[:13], 16) / (1 << 52)


def _values(features: Sequence[str]) -> Column:
    return F.array(*[F.round(F.col(c).cast("double"), DECIMALS) for c in features])


@dataclass(frozen=True)
class IsolationForest:
    """Fitted trees as arrays of shape (trees, nodes): root 1, children 2n and 2n + 1; ``feature`` is -1 at a leaf."""

    features: tuple[str, ...]
    sample_size: int
    depth_limit: int
    feature: np.ndarray
    cut: np.ndarray
    path: np.ndarray

    @property
    def trees(self) -> int:
        return self.feature.shape[0]

    def score(self, df: DataFrame, out: str = "score", prefixes: Sequence[int] = ()) -> DataFrame:
        """Add scores in 0..1, higher for rows that isolate sooner; NULL if a feature is missing.

        ``prefixes`` asks for an array of scores of the first k trees for every k, which lets a
        grid over the number of trees share one pass.
        """
        require_columns(df, list(self.features))
        counts = tuple(prefixes) or (self.trees,)
        vector = _values(self.features)
        scale = float(mean_path(np.array([self.sample_size]))[0]) or 1.0
        # Plain arrays: executors need not have this package to read them.
        shared = df.sparkSession.sparkContext.broadcast(
            (self.feature, self.cut, self.path, self.depth_limit, scale))

        @F.pandas_udf("array<double>")
        def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                yield pd.Series(_score_batch(batch, shared.value, counts))

        complete = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v))
        values = scores(F.when(complete, vector))
        return df.withColumn(out, values if prefixes else values[0])


def _score_batch(batch: pd.Series, forest: tuple, counts: tuple[int, ...]) -> list:
    """Scores of the first k trees for every k in ``counts``; the trees advance level by level together."""
    feature, cut, path, depth_limit, scale = forest
    known = batch.notna().to_numpy()
    result: list = [None] * len(batch)
    if not known.any():
        return result
    x = np.stack(batch[known].to_numpy())
    trees = np.arange(feature.shape[0])[None, :]
    rows = np.arange(len(x))[:, None]
    node = np.ones((len(x), feature.shape[0]), dtype=np.int64)
    for _ in range(depth_limit):
        f = feature[trees, node]
        above = x[rows, np.maximum(f, 0)] > cut[trees, node]
        node = np.where(f >= 0, 2 * node + above, node)
    total = np.cumsum(path[trees, node], axis=1)
    scored = np.stack([2.0 ** (-total[:, k - 1] / k / scale) for k in counts], axis=1)
    for place, values in zip(np.flatnonzero(known), scored, strict=True):
        result[place] = values
    return result


def fit_forest(
    df: DataFrame,
    features: Sequence[str],
    row_key: Sequence[str],
    *,
    trees: int = 100,
    max_features: float | int = 1.0,
    seed: int = 42,
    sample_size: int = SAMPLE,
) -> IsolationForest:
    """Fit on the complete rows of ``df``; ``row_key`` must identify a row.

    Every tree sees ``sample_size`` rows (all, if there are fewer). A tree depends on the rows, the seed and
    its own number only: a smaller forest is the start of a larger one.
    """
    require_columns(df, [*features, *row_key])
    complete = df.dropna(subset=list(features)).select(
        F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in row_key]).cast("binary")).alias("_key"),
        _values(features).alias("_x"))
    rows = complete.count()
    if rows == 0:
        raise ValueError("no complete rows to fit the forest on")
    psi = min(sample_size, rows)
    per_tree = (max(1, min(len(features), max_features)) if isinstance(max_features, int)
                else max(1, int(max_features * len(features))))
    limit = max(1, math.ceil(math.log2(psi))) if psi > 1 else 1
    sample = _tree_samples(complete, rows, psi, trees)
    dims, base_seed = len(features), seed

    def grow(key: tuple, rows_of_tree: pd.DataFrame) -> pd.DataFrame:
        tree = int(key[0])
        order = sorted(range(dims), key=lambda f: (digest_share(base_seed, tree, f, "subset"), f))
        nodes = _grow_tree(np.stack(rows_of_tree["_x"].to_numpy()), np.sort(order[:per_tree]), limit, base_seed, tree)
        return nodes.assign(tree=tree)

    # Bounded by trees * (2 * psi - 1) nodes.
    nodes = sample.groupBy("_tree").applyInPandas(grow, "tree int, node int, feature int, cut double, path double").toPandas()
    return _assemble(nodes, tuple(features), psi, limit, trees)


def _tree_samples(complete: DataFrame, rows: int, psi: int, trees: int) -> DataFrame:
    """For every tree the ``psi`` rows with the lowest hash of row key and tree number.

    A bound on the hash leaves about twice as many candidates a tree before they are ranked. It only saves
    work: should a tree have fewer than it needs, the bound is raised and the ranking done again.
    """
    share = min(1.0, (2 * psi + 64) / rows)
    number = lambda first: F.conv(F.substring("_key", first, 13), 16, 10).cast("long")
    start, step = number(1), number(14)
    while True:
        bound = PRIME if share >= 1 else int(share * PRIME)
        trees_near = F.element_at(F.transform(F.array(F.struct(start.alias("a"), step.alias("b"))), lambda d: F.filter(
            F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: (d["a"] + t * d["b"]) % PRIME < bound)), 1)
        dealt = complete.withColumn("_tree", F.explode(trees_near)).withColumn("_draw", (start + F.col("_tree") * step) % PRIME)
        order = Window.partitionBy("_tree").orderBy("_draw", "_key", "_x")
        picked = materialize(dealt.withColumn("_rank", F.row_number().over(order) - 1).where(F.col("_rank") < psi)
                             .select("_tree", "_x"))
        if share >= 1 or picked.count() == trees * psi:
            return picked
        share = min(1.0, 4 * share)


def _grow_tree(x: np.ndarray, allowed: np.ndarray, limit: int, seed: int, tree: int) -> pd.DataFrame:
    """Axis-parallel cuts at drawn places until points are alone, equal, or ``limit`` levels deep."""
    extra = mean_path(np.arange(len(x) + 1))
    nodes: list[tuple] = []
    waiting = [(1, np.ascontiguousarray(x[:, allowed]), 0)]
    while waiting:
        node, block, depth = waiting.pop()
        varied = ()
        if depth < limit and len(block) > 1:
            low, high = block.min(axis=0), block.max(axis=0)
            varied = np.flatnonzero(high > low)
        if not len(varied):
            nodes.append((node, -1, 0.0, depth + extra[len(block)]))
            continue
        pick = varied[int(digest_share(seed, tree, node, "feature") * len(varied))]
        cut = low[pick] + digest_share(seed, tree, node, "cut") * (high[pick] - low[pick])
        if cut >= high[pick]:  # rounding may lift a draw to the upper end, which would leave one side empty
            cut = low[pick]
        below = block[:, pick] <= cut
        nodes.append((node, allowed[pick], cut, 0.0))
        waiting += [(2 * node, block[below], depth + 1), (2 * node + 1, block[~below], depth + 1)]
    return pd.DataFrame(nodes, columns=["node", "feature", "cut", "path"])


def _assemble(nodes: pd.DataFrame, features: tuple[str, ...], psi: int, limit: int, trees: int) -> IsolationForest:
    where = (nodes["tree"].to_numpy(), nodes["node"].to_numpy())

    def table(column: str, fill: float, kind: type) -> np.ndarray:
        grid = np.full((trees, 1 << (limit + 1)), fill, dtype=kind)
        grid[where] = nodes[column].to_numpy()
        return grid

    return IsolationForest(features, psi, limit, table("feature", -1, np.int64), table("cut", 0.0, float), table("path", 0.0, float))


def contamination_offset(df: DataFrame, score: str, contamination: float,
                         layout: Layout = DEFAULT_LAYOUT) -> float:
    """Score above which the given share of the fit rows lies."""
    if not 0 < contamination <= 0.5:
        raise ValueError("contamination must be in (0, 0.5]")
    return exact_quantile_values(df, score, [1.0 - contamination], layout)[0]


def contamination_flag(score: str | Column, offset: float) -> Column:
    """1 strictly above the offset, where the shifted score is positive."""
    c = F.col(score) if isinstance(score, str) else score
    return (c - F.lit(offset) > 0).cast("int")
