"""Penalised least squares from moment matrices: ``(1/2) w'Gw - c'w + sum l1 |w| + (1/2) sum l2 w^2``.

Feature-sign search: terms become active one at a time, where the optimality condition is violated most; for given signs the
active weights solve one linear system, and a weight that would cross zero on the way there is dropped at the best of
these crossings. The answer is exact, and the optimality condition of every term shows it.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

# Task functions travel by value, so executors do not need this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Linear systems solved at most for each term.
SOLVES = 50


def optimality(gram: np.ndarray, cross: np.ndarray, l1: np.ndarray, l2: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """How far each term is from its optimality condition, on the scale of its own gradient."""
    slope = gram @ weights - cross + l2 * weights
    gap = np.where(weights != 0, np.abs(slope + l1 * np.sign(weights)), np.maximum(np.abs(slope) - l1, 0.0))
    return gap / (np.abs(gram) @ np.abs(weights) + np.abs(cross) + l1 + 1e-300)


def shrunk_weights(gram: np.ndarray, cross: np.ndarray, l1: np.ndarray, l2: np.ndarray, tolerance: float = 1e-11) -> np.ndarray:
    """The minimiser; terms without any variation get the weight 0."""
    system = gram + np.diag(l2)
    live = np.diag(gram) > 0
    free = live & (l1 == 0)
    weights, signs, active = np.zeros(len(cross)), np.zeros(len(cross)), free.copy()

    def cost(w: np.ndarray) -> float:
        return float(w @ system @ w / 2 - cross @ w + l1 @ np.abs(w))

    for _ in range(SOLVES * len(cross)):
        used = np.flatnonzero(active)
        goal = np.zeros(len(cross))
        goal[used] = np.linalg.lstsq(system[np.ix_(used, used)], cross[used] - l1[used] * signs[used], rcond=None)[0]
        crossing = np.flatnonzero((weights * goal < 0) & (l1 > 0))
        places = [1.0, *(weights[crossing] / (weights[crossing] - goal[crossing])).tolist()]
        costs = [cost(weights + p * (goal - weights)) for p in places]
        best = int(np.argmin(costs))
        weights = weights + places[best] * (goal - weights)
        if best:
            weights[crossing[best - 1]] = 0.0
        settled = best == 0 and (np.sign(weights) == signs)[active & ~free].all()
        active = free | (weights != 0)
        signs = np.where(free, 0.0, np.sign(weights))
        if not settled:
            continue
        slope = system @ weights - cross
        excess = np.where(live & ~active, np.abs(slope) - l1, -np.inf)
        worst = int(np.argmax(excess))
        if excess[worst] <= tolerance * (np.abs(gram[worst]) @ np.abs(weights) + abs(cross[worst]) + l1[worst]):
            break
        active[worst], signs[worst] = True, -np.sign(slope[worst])
    return weights
