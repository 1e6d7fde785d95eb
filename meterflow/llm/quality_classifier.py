"""Quality classifier by positive-unlabelled learning.

Trusted positives are labelled good; everything without a label is unlabelled. With logistic loss the
unbiased risk of a linear score g is  -prior * mean_P[g] + mean_U[log(1 + exp(g))], which is convex. Its
part for negatives, mean_U[log(1 + exp(g))] - prior * mean_P[log(1 + exp(g))], stands for a mean loss and is clipped
at zero: steps that only push it further below do not count, and fitting stops there. Every Newton step sums
gradient and curvature over all rows.

The class prior is estimated from scores alone: under a first model, the share of unlabelled rows above a
score is at least the prior times the share of positives above it, so the least ratio of the two, taken where
both shares are known well enough, bounds the prior from above and meets it where hardly a bad text scores so high.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.llm.common import SPACES, stored, texts

#: Text measures, and the values at which each is bent (hinges).
HINGES = {
    "symbols": (0.0, 0.05, 0.15, 0.4), "capitals": (0.0, 0.06, 0.15, 0.4), "marks": (0.0, 0.05, 0.3), "pipes": (0.0, 0.05, 0.3),
    "new_words": (0.0, 0.2, 0.4, 0.6, 0.8), "word_length": (0.0, 3.0, 5.0, 7.0, 9.0, 12.0), "short_words": (0.0, 0.1, 0.2, 0.4),
    "stutter": (0.0, 0.02, 0.1, 0.4), "log_words": (0.0, 2.0, 3.5, 5.0, 7.0), "digits": (0.0, 0.05, 0.2), "stops": (0.0, 0.02, 0.06, 0.15),
    "copied_lines": (0.0, 0.1, 0.4),
}
#: From strong to weak.
RIDGES = (0.1, 0.01, 1e-3)
THRESHOLD = 0.3
#: Prior of the first model, and bins of its scores.
FIRST_PRIOR, BINS = 0.5, 512


def _features(docs: DataFrame) -> DataFrame:
    """doc_id and one vector of hinged measures; built-in functions only."""
    words = F.regexp_extract_all(F.col("text"), F.lit(f"([^{SPACES}]+)"), F.lit(1))
    step = docs.select("doc_id", "text", words.alias("_w"), F.filter(F.split("text", "\n"), lambda x: F.length(x) > 0).alias("_l"))
    w, t = F.col("_w"), F.col("text")
    n = F.greatest(F.size(w), F.lit(1)).cast("double")
    chars = F.length(F.array_join(w, ""))
    size = F.greatest(chars, F.lit(1)).cast("double")
    lost = lambda c: F.length(t) - F.length(c)
    values: dict[str, Column] = {
        "symbols": lost(F.translate(t, "#*$%&<>", "")) / n, "capitals": lost(F.regexp_replace(t, r"\p{Lu}+", "")) / size,
        "marks": lost(F.replace(t, F.lit("!"), F.lit(""))) / n, "pipes": lost(F.replace(t, F.lit("|"), F.lit(""))) / n,
        "new_words": F.size(F.array_distinct(w)) / n, "word_length": chars / n,
        "short_words": F.size(F.filter(w, lambda x: F.length(x) <= 3)) / n,
        "stutter": F.size(F.filter(F.transform(w, lambda x, i: x == F.get(w, i + 1)), lambda x: F.coalesce(x, F.lit(False)))) / n,
        "log_words": F.log1p(F.size(w).cast("double")), "digits": lost(F.translate(t, "0123456789", "")) / size,
        "stops": lost(F.translate(t, ".?", "")) / n,
        "copied_lines": (F.size("_l") - F.size(F.array_distinct("_l"))) / F.greatest(F.size("_l"), F.lit(1)).cast("double"),
    }
    step = step.select("doc_id", *[v.cast("double").alias(f"_{k}") for k, v in values.items()])
    bends = [F.lit(1.0)]
    for name, at in HINGES.items():
        for low, high in zip(at, [*at[1:], at[-1] * 4 + 1]):
            bends.append(F.least(F.greatest((F.col(f"_{name}") - low) / (high - low), F.lit(0.0)), F.lit(1.0)))
    return step.select("doc_id", F.array(*bends).alias("x"))


def _sums(weights: np.ndarray):
    """Sums over a partition: unlabelled rows' loss, gradient and curvature; positives' count, sum of x and loss."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = len(weights)
        total = np.zeros(4 + 2 * d + d * d)
        for batch in batches:
            if not batch.num_rows:
                continue
            positive = np.asarray(batch.column(0).to_pylist(), bool)
            x = np.asarray(batch.column(1).flatten()).reshape(-1, d)
            g = x @ weights
            loss = np.logaddexp(0, g)
            p, u = x[positive], x[~positive]
            s = 1 / (1 + np.exp(-g[~positive]))
            total[:4] += [len(u), loss[~positive].sum(), len(p), loss[positive].sum()]
            total[4:4 + d] += u.T @ s
            total[4 + d:4 + 2 * d] += p.sum(axis=0)
            total[4 + 2 * d:] += ((u * (s * (1 - s))[:, None]).T @ u).ravel()
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["sums"])

    return run


def _total(rows: DataFrame, weights: np.ndarray) -> np.ndarray:
    """Sums of partial sums, added up position by position on the executors; one short row arrives."""
    parts = rows.select("positive", "x").mapInArrow(_sums(weights), "sums array<double>")
    added = parts.select(F.posexplode("sums").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v")).collect()
    total = np.zeros(4 + 2 * len(weights) + len(weights) ** 2)
    for row in added:
        total[row["i"]] = row["v"]
    return total


def _risk(total: np.ndarray, weights: np.ndarray, prior: float, penalty: np.ndarray) -> float:
    """Risk with the negatives' part clipped at zero: log(1 + exp(-g)) is log(1 + exp(g)) - g."""
    d = len(weights)
    positives = prior * (total[3] - total[4 + d:4 + 2 * d] @ weights) / total[2]
    return positives + max(0.0, _negatives(total, prior)) + 0.5 * penalty @ weights ** 2


def _negatives(total: np.ndarray, prior: float) -> float:
    return total[1] / total[0] - prior * total[3] / total[2]


def _descend(rows: DataFrame, weights: np.ndarray, total: np.ndarray, prior: float, ridge: float, rounds: int = 6) -> tuple[np.ndarray, np.ndarray]:
    """Newton steps on the unbiased risk, each halved while it leads uphill."""
    d = len(weights)
    penalty = np.full(d, ridge)
    penalty[0] = 0
    for _ in range(rounds):
        gradient = total[4:4 + d] / total[0] - prior * total[4 + d:4 + 2 * d] / total[2] + penalty * weights
        curve = total[4 + 2 * d:].reshape(d, d) / total[0] + np.diag(penalty + 1e-9)
        step, before = -np.linalg.solve(curve, gradient), _risk(total, weights, prior, penalty)
        for _ in range(4):
            trial = weights + step
            new = _total(rows, trial)
            if _risk(new, trial, prior, penalty) <= before:
                break
            step = step / 4
        else:
            break
        weights, total = trial, new
        if before - _risk(total, weights, prior, penalty) < 1e-4:
            break
    return weights, total


def fit(rows: DataFrame, prior: float, ridges: tuple[float, ...] = RIDGES) -> np.ndarray:
    """Weights of the least non-negative risk. ``rows``: positive, x.

    The ridge is weakened step by step, each from the weights before. Where the negatives' part of the risk would fall below
    zero, the model fits its positives too closely for this prior: the weights before are kept.
    """
    d = 1 + sum(map(len, HINGES.values()))
    kept = np.zeros(d)
    total = _total(rows, kept)
    if not total[0] or not total[2]:
        return kept
    kept[0] = np.log(prior / (1 - prior))
    total = _total(rows, kept)
    for ridge in ridges:
        weights, sums = _descend(rows, kept, total, prior, ridge)
        if _negatives(sums, prior) < 0:
            break
        kept, total = weights, sums
    return kept


def _score(weights: np.ndarray) -> Column:
    g = F.lit(float(weights[0]))
    for i, value in enumerate(weights[1:], 1):
        g = g + F.col("x")[i] * float(value)
    return 1 / (1 + F.exp(-g))


def estimated_prior(rows: DataFrame, weights: np.ndarray) -> float:
    """Share of good rows among the unlabelled ones: the least ratio of tail shares, each of which counts for its sampling error.

    Scores are counted in ``BINS`` bins, so at most twice as many rows reach the driver.
    """
    counts = np.zeros((2, BINS))
    for r in rows.groupBy("positive", F.least(F.floor(_score(weights) * BINS), F.lit(BINS - 1)).alias("bin")).count().collect():
        counts[int(r["positive"]), int(r["bin"])] = r["count"]
    n = counts.sum(axis=1)
    if not n.all():
        return FIRST_PRIOR
    tails = counts[:, ::-1].cumsum(axis=1) / n[:, None]
    error = np.sqrt(np.log(40) / 2 / n).sum()  # of both tails, one in ten
    seen = tails[1] > 0
    bound = (tails[0][seen] + error) / tails[1][seen]
    best = int(np.argmin(bound))
    return float(np.clip(tails[0][seen][best] / tails[1][seen][best], 0.01, 0.99))


def held_out(key: Column) -> Column:
    """Rows that training never sees a label of: checksum of the key's digits divisible by five."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def score_quality(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Per row: held_out, score, predicted.

    Labels of held-out keys are dropped before anything is learnt; of the others only the good ones are used, the rest
    counts as unlabelled. The class prior is estimated from the scores of a first model. Null and empty texts get the score
    of a text without words. A key labelled both ways counts as not trusted; repeated rows are scored each. Without any
    trusted row or any unlabelled one every score is one half.
    """
    rows = stored(_features(texts(docs, key, text)), "features")
    known = labels.select(F.col("doc_id"), F.col("quality").cast("int").alias("quality")).where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    known = known.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    marked = rows.join(known, "doc_id", "left")
    training = stored(marked.select((F.col("quality") == 1).eqNullSafe(True).alias("positive"), "x"), "training")
    weights = fit(training, estimated_prior(training, fit(training, FIRST_PRIOR)))
    score = _score(weights)
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"), (score >= threshold).cast("int").alias("predicted"))
