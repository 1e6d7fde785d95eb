"""Exact density noise (points DBSCAN leaves unclustered) without pairs or large groups.

Only the noise flag is needed, so clusters are never formed:

1. Equal vectors become one weighted point, which settles groups of copies.
2. A cell so small that any two of its points are neighbours certifies all its points as core
   when it holds enough weight. Crowded regions are settled here, in linear work.
3. Every other point counts its neighbours block against block: a task sees one pair of blocks of bounded size and
   returns one count per point. No pair of points is ever emitted, and a hot cell spreads over many blocks.
   A point's *coordinates* are its values and its distances to a few landmarks; by the triangle inequality none of
   them differs by more than the distance of two points. The two widest coordinates make coarse cells; the nearest
   landmark and the next coordinates cut these into rings, and two rings meet only if the ranges of all their
   coordinates come within ``eps``. Landmarks prune where ``eps`` spans every single value, as it does for
   many scaled features.
4. Points that are not core look for a core neighbour in the same way; without one they are noise.

Step 3 is quadratic in the points that share a neighbourhood of radius ``eps`` and were not
certified, which no exact method avoids when ``eps`` spans the data.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.functions.checks import require_columns
from meterflow.operators.joins import lookup
from meterflow.session import materialize
from meterflow.spec import DEFAULT_LAYOUT, Layout

# Task functions travel by value, so executors do not need this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

METRICS = ("euclidean", "manhattan")
#: Landmarks, the points they are chosen from at most, and coordinates that cut cells into rings.
LANDMARKS, CHOICE, RINGS = 16, 2048, 3


def density_noise(df: DataFrame, features: Sequence[str], eps: float = 0.5, min_samples: int = 5,
                  metric: str = "euclidean", out: str = "is_anomaly", layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """Add a flag that is 1 for points with no core point within ``eps`` (themselves included)."""
    flags = density_noise_grid(df, features, [(eps, min_samples)], metric, "_noise", layout)
    return flags.withColumn(out, F.col("_noise")[0]).drop("_noise")


def density_noise_grid(df: DataFrame, features: Sequence[str], configs: Sequence[tuple[float, int]],
                       metric: str = "euclidean", out: str = "noise", layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """Noise flags for many (eps, min_samples) settings at once, as an array in their order.

    Distances are computed twice in all (neighbour counts, then core search), whatever the number
    of settings.
    """
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")
    require_columns(df, list(features))
    grid = _Grid(list(features), list(configs), metric, layout)
    vector = F.array(*[F.col(c).cast("double") + 0.0 for c in features])
    tagged = df.withColumn("_x", vector)
    points = materialize(
        tagged.groupBy("_x").agg(F.count(F.lit(1)).alias("_w"))
        .withColumn("_id", F.monotonically_increasing_id()))
    noise = grid.noise(points)
    return lookup(tagged, noise, "_x", "_w").drop("_x").withColumnRenamed("_flags", out)


class _Grid:
    def __init__(self, features: list[str], configs: list[tuple[float, int]], metric: str, layout: Layout):
        self.dims = len(features)
        self.configs = [(float(e), int(m)) for e, m in configs]
        self.radii = sorted({e for e, _ in self.configs})
        self.metric = metric
        self.layout = layout
        self.by_landmark = False  # whether cells hold so much that they are cut by nearest landmark

    def noise(self, points: DataFrame) -> DataFrame:
        points = self._located(points)
        axes, rings = self._axes(points)
        certain = self._certified(points)
        open_points = certain.where(~F.col("_sure"))
        counts = self._neighbour_counts(open_points, points, axes, rings)
        cores = [F.col("_sure") | (F.coalesce(F.col("_near")[self.radii.index(e)], F.lit(0)) >= m)
                 for e, m in self.configs]
        marked = materialize(certain.join(counts, "_id", "left")
                             .withColumn("_core", F.array(*cores)).drop("_near", "_sure"))
        every = F.forall("_core", lambda c: c)
        some = F.exists("_core", lambda c: c)
        reached = self._core_in_reach(marked.where(~every), marked.where(some), axes, rings)
        flags = F.transform(F.sequence(F.lit(0), F.lit(len(self.configs) - 1)), lambda i: F.when(
            F.col("_core")[i] | F.coalesce(F.col("_reach")[i], F.lit(False)), 0).otherwise(1))
        return marked.join(reached, "_id", "left").select("_x", "_w", flags.alias("_flags"))

    def _located(self, points: DataFrame) -> DataFrame:
        """Stored points with ``_y``: their values, then their distances to the landmarks."""
        some = [r["_x"] for r in points.orderBy(F.xxhash64("_x"), "_x").limit(CHOICE).select("_x").collect()]
        marks, metric = _far_apart(np.array(some).reshape(len(some), self.dims), metric=self.metric), self.metric

        @F.pandas_udf("array<double>")
        def placed(batch: pd.Series) -> pd.Series:
            return pd.Series(list(_distances(batch, pd.Series(list(marks)), metric)) if len(batch) else [])

        return materialize(points.withColumn("_y", F.concat("_x", placed("_x")) if len(marks) else F.col("_x")))

    def _axes(self, points: DataFrame) -> tuple[list[tuple[int, float]], list[tuple[int, float]]]:
        """The two widest coordinates with the side of a coarse cell along each, and the next ones with the width of a ring.

        Cells are no narrower than the largest radius and else sized to hold about one block of points, so a
        sparse table does not fall apart into tiny groups. Rings cut what a cell holds beyond a block.
        """
        width = self.dims + LANDMARKS
        row = points.agg(F.count(F.lit(1)).alias("n"),
                         *[(F.max(F.get("_y", F.lit(i))) - F.min(F.get("_y", F.lit(i)))).alias(f"d{i}") for i in range(width)]).first()
        spans = sorted(((row[f"d{i}"] or 0.0, -i) for i in range(width)), reverse=True)[:2 + RINGS]
        blocks = max(1.0, row["n"] / self.layout.block_rows)
        reach = self.radii[-1] * (1 + 1e-9)
        axes = [(-i, max(reach, span / blocks ** (1 / 2))) for span, i in spans[:2]]
        cells = math.prod(max(1.0, span / side) for (span, _), (_, side) in zip(spans, axes))
        left = [(span, -i) for span, i in spans[2:] if span > 0]
        # the widest coordinates, too, may be cut more finely than cells are
        left += [(side, i) for i, side in axes if side > 0]
        per_ring = max(1.0, blocks / cells) ** (1 / max(1, len(left)))
        self.by_landmark = blocks >= 4
        return axes, [(i, span / per_ring) for span, i in left] if per_ring > 1 else []

    def _certified(self, points: DataFrame) -> DataFrame:
        """Mark points of cells whose diameter is below the smallest radius and whose weight suffices."""
        parts = math.sqrt(self.dims) if self.metric == "euclidean" else self.dims
        side = self.radii[0] / parts * (1 - 1e-9)
        need = max(m for _, m in self.configs)
        cell = F.transform("_x", lambda v: F.floor(v / F.lit(side)))
        celled = points.withColumn("_cell", cell)
        heavy = (celled.groupBy("_cell").agg(F.sum("_w").alias("_cw"), F.count(F.lit(1)).alias("_points"))
                 .where(F.col("_cw") >= need).select("_cell", "_points", F.lit(True).alias("_heavy")))
        return (lookup(celled, heavy, "_cell", "_points", how="left")
                .withColumn("_sure", F.coalesce("_heavy", F.lit(False))).drop("_cell", "_heavy"))

    def _ring_pairs(self, near: DataFrame, far: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Per cell and ring of either side: its rows, its blocks, and the rings of the other side within reach with their blocks."""
        per_block = self.layout.block_rows
        width = self.dims + LANDMARKS

        def rings(df: DataFrame, side: str) -> DataFrame:
            bounds = [f(F.get("_y", F.lit(i))) for i in range(width) for f in (F.min, F.max)]
            found = df.groupBy("_cell").agg(F.count(F.lit(1)).alias(f"_r{side}"), F.array(*bounds[::2]).alias(f"_lo{side}"), F.array(*bounds[1::2]).alias(f"_hi{side}"))
            return found.withColumn(f"_n{side}", F.ceil(F.col(f"_r{side}") / per_block)).withColumn("_place", F.col("_cell._place")).withColumnRenamed("_cell", f"_cell{side}")

        slack = self.radii[-1] * (1 + 1e-9)
        both = materialize(rings(near, "q").join(rings(far, "c"), "_place"))
        apart = lambda lo, hi: F.exists(F.zip_with(lo, hi, lambda x, y: F.coalesce(x - y > slack + 1e-9 * (F.abs(x) + F.abs(y)), F.lit(False))), lambda p: p)
        met = materialize(both.where(~apart(F.col("_loq"), F.col("_hic")) & ~apart(F.col("_loc"), F.col("_hiq"))).select(
            "_cellq", "_rq", "_nq", "_cellc", "_rc", "_nc"))
        left = met.groupBy(F.col("_cellq").alias("_cell")).agg(F.first("_rq").alias("_rows"), F.first("_nq").alias("_own"),
                                                               F.collect_list(F.struct(F.col("_cellc").alias("cell"), F.col("_nc").alias("n"))).alias("_others"))
        right = met.groupBy(F.col("_cellc").alias("_cell")).agg(F.first("_rc").alias("_rows"), F.first("_nc").alias("_own"),
                                                                F.collect_list(F.struct(F.col("_cellq").alias("cell"), F.col("_nq").alias("n"))).alias("_others"))
        return left, right

    def _blocks(self, queries: DataFrame, candidates: DataFrame, axes: list[tuple[int, float]], rings: list[tuple[int, float]]):
        """Pair blocks of points: queries go to every coarse cell their largest radius touches, and there to the rings within reach."""
        reach = F.lit(self.radii[-1] * (1 + 1e-9))

        def number(value: Column, side: float) -> Column:
            return F.floor(value / F.lit(side)) if side > 0 else F.lit(0).cast("long")

        def celled(df: DataFrame, names: list[str]) -> DataFrame:
            to_marks = F.slice("_y", self.dims + 1, LANDMARKS)
            nearest = F.array_position(to_marks, F.array_min(to_marks)) if self.by_landmark else F.lit(0).cast("long")
            ring = F.struct(nearest.alias("_0"), *[number(F.col("_y")[axis], side).alias(f"_{k}") for k, (axis, side) in enumerate(rings, 1)])
            return df.withColumn("_cell", F.struct(F.struct(*names).alias("_place"), ring.alias("_ring"))).drop(*names)

        near, far = queries, candidates
        for i, (axis, side) in enumerate(axes):
            y = F.col("_y")[axis]
            near = near.withColumn(f"_c{i}", F.explode(F.sequence(number(y - reach, side), number(y + reach, side))))
            far = far.withColumn(f"_c{i}", number(y, side))
        names = [f"_c{i}" for i in range(len(axes))]
        near, far = celled(near, names), celled(far, names)
        of_near, of_far = self._ring_pairs(near, far)
        spread = F.xxhash64("_id")

        def dealt(df: DataFrame, partners: DataFrame, own: str, other: str) -> DataFrame:
            """Rows with the block of each side for every block they meet."""
            rows = lookup(df, partners, "_cell", "_rows").withColumn(f"_{own}", F.struct(F.col("_cell").alias("cell"), F.pmod(spread, F.col("_own")).alias("no")))
            rows = rows.withColumn("_other", F.explode("_others")).withColumn("_no", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_other.n") - 1)))
            rows = rows.withColumn(f"_{other}", F.struct(F.col("_other.cell").alias("cell"), F.col("_no").alias("no")))
            # Both sides stem from the same points; new column identities keep the cogroup unambiguous.
            kept = [c for c in df.columns if c not in ("_cell", "_y")] + ["_q", "_c"]
            return rows.select(*[F.col(c).alias(c) for c in kept])

        return dealt(near, of_near, "q", "c").groupBy("_q", "_c"), dealt(far, of_far, "c", "q").groupBy("_q", "_c")

    def _neighbour_counts(self, queries: DataFrame, candidates: DataFrame, axes: list[tuple[int, float]], rings: list[tuple[int, float]]) -> DataFrame:
        radii, metric = self.radii, self.metric

        def count(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
            if q.empty or c.empty:
                return pd.DataFrame({"_id": [], "_near": []})
            distance = _distances(q["_x"], c["_x"], metric)
            weight = c["_w"].to_numpy(dtype=np.int64)
            near = np.stack([(distance <= r) @ weight for r in radii], axis=1)
            return pd.DataFrame({"_id": q["_id"].to_numpy(), "_near": list(near)})

        left, right = self._blocks(queries.select("_id", "_x", "_y"), candidates.select("_id", "_x", "_y", "_w"), axes, rings)
        partial = left.cogroup(right).applyInPandas(count, "_id long, _near array<long>")
        return _combine(partial, "_near", len(radii), F.sum)

    def _core_in_reach(self, queries: DataFrame, candidates: DataFrame, axes: list[tuple[int, float]], rings: list[tuple[int, float]]) -> DataFrame:
        configs, metric = self.configs, self.metric

        def search(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
            if q.empty or c.empty:
                return pd.DataFrame({"_id": [], "_reach": []})
            distance = _distances(q["_x"], c["_x"], metric)
            core = np.stack(c["_core"].to_numpy()).astype(bool)
            hit = np.stack([((distance <= e) & core[:, i]).any(axis=1) for i, (e, _) in enumerate(configs)], axis=1)
            return pd.DataFrame({"_id": q["_id"].to_numpy(), "_reach": list(hit)})

        left, right = self._blocks(queries.select("_id", "_x", "_y"), candidates.select("_id", "_x", "_y", "_core"), axes, rings)
        partial = left.cogroup(right).applyInPandas(search, "_id long, _reach array<boolean>")
        return _combine(partial, "_reach", len(configs), F.bool_or)


def _combine(partial: DataFrame, column: str, size: int, how) -> DataFrame:
    parts = partial.groupBy("_id").agg(*[how(F.col(column)[i]).alias(f"_{i}") for i in range(size)])
    return parts.select("_id", F.array(*[F.col(f"_{i}") for i in range(size)]).alias(column))


def _far_apart(points: np.ndarray, metric: str, count: int = LANDMARKS) -> np.ndarray:
    """Up to ``count`` of the points: half of them the first ones, which lie where points are many, then each as far as possible from those before."""
    if not len(points):
        return points
    rows = pd.Series(list(points))
    chosen = list(range(min(count // 2, len(points))))
    near = _distances(rows, rows.iloc[chosen], metric).min(axis=1)
    while len(chosen) < min(count, len(points)):
        chosen.append(int(np.argmax(near)))
        near = np.minimum(near, _distances(rows, rows.iloc[[chosen[-1]]], metric)[:, 0])
    return points[chosen]


def _distances(q: pd.Series, c: pd.Series, metric: str) -> np.ndarray:
    """Distances between two blocks, one dimension at a time to stay within a block-sized matrix."""
    left, right = np.stack(q.to_numpy()), np.stack(c.to_numpy())
    total = np.zeros((len(left), len(right)))
    for d in range(left.shape[1]):
        gap = left[:, d][:, None] - right[:, d][None, :]
        total += gap * gap if metric == "euclidean" else np.abs(gap)
    return np.sqrt(total) if metric == "euclidean" else total


