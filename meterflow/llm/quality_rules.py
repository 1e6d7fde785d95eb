"""Quality rules by weak supervision: rules vote or abstain, expectation-maximisation weighs them.

Every rule measures a text and votes good, bad, or not at all. The model has a share of good texts and,
for each rule, the probabilities of its votes on good and on bad texts; both are estimated from how often
each combination of votes occurs in the whole table (at most three to the power of the number of rules).
A text is kept if its posterior probability of being good is high enough. Only built-in functions run on
the rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.llm.common import SPACES, plain_names, stored, texts

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_marks", "n_lines", "n_short")


@dataclass(frozen=True)
class Rule:
    """Bad from ``bad`` on, good up to ``good``, silent between; ``floor`` turns it round for small values."""

    name: str
    value: str
    good: float
    bad: float
    low: bool = False


#: Shares of words or characters; texts without words get no vote.
RULES = (
    Rule("symbols", "n_symbols / n_words", 0.1, 0.25),
    Rule("repeats", "n_repeat_words / n_words", 0.25, 0.5),
    Rule("copied_lines", "n_dup_lines / n_lines", 0.15, 0.4),
    Rule("capitals", "n_upper / word_chars", 0.15, 0.4),
    Rule("exclamations", "n_marks / n_words", 0.1, 0.3),
    Rule("long_words", "word_chars / n_words", 9.0, 13.0),
    Rule("short_words", "n_short / n_words", 0.2, 0.06, low=True),
)
#: Posterior probability of being good from which a text is kept.
KEEP = 0.5
#: Least odds with which a bad vote speaks against a text.
TELLING = 200.0


def _neighbours_equal(s: Column, i: Column) -> Column:
    """Whether the i-th of the sorted windows has an equal one beside it."""
    own = s[i]["g"]
    return F.coalesce(own == F.get(s, i - 1)["g"], F.lit(False)) | F.coalesce(own == F.get(s, i + 1)["g"], F.lit(False))


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with a struct ``_m`` of measures; each is a sequence of projections, so nothing is computed twice."""
    t = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    names = docs.columns
    words = F.regexp_extract_all(F.col("_t"), F.lit(f"([^{SPACES}]+)"), F.lit(1))
    step = docs.select(*[F.col(f"`{c}`") for c in names], t.alias("_t"))
    step = step.select(*names, "_t", words.alias("_w"), F.filter(F.split("_t", "\n"), lambda x: x.rlike(f"[^{SPACES}]")).alias("_l"))
    w = F.col("_w")
    # words hold no blank, so joined by blanks they tell three-word windows apart
    windows = F.when(F.size(w) < 3, F.array().cast("array<string>")).otherwise(
        F.slice(F.transform(w, lambda x, i: F.concat_ws(" ", x, F.get(w, i + 1), F.get(w, i + 2))), 1, F.size(w) - 2))
    marks = F.length("_t") - F.length(F.replace(F.col("_t"), F.lit("!"), F.lit("")))
    upper = F.length("_t") - F.length(F.regexp_replace("_t", r"\p{Lu}+", ""))
    lines = F.col("_l")
    simple = F.struct(
        F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        (F.length("_t") - F.length(F.translate("_t", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        upper.cast("long").alias("n_upper"), marks.cast("long").alias("n_marks"), F.size(lines).cast("long").alias("n_lines"),
        F.size(F.filter(w, lambda x: F.length(x) <= 3)).cast("long").alias("n_short"))
    step = step.select(*names, simple.alias("_s"), windows.alias("_g"))
    g = F.col("_g")
    ordered = F.when(F.size(F.array_distinct(g)) < F.size(g), F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("g"), i.alias("i")))))
    step = step.select(*names, "_s", ordered.alias("_o"))
    o = F.col("_o")
    repeated = F.filter(F.transform(o, lambda x, i: F.when(_neighbours_equal(o, i), x["i"])), lambda p: p.isNotNull())
    covered = F.array_distinct(F.flatten(F.transform(repeated, lambda p: F.array(p, p + 1, p + 2))))
    n_repeat = F.when(o.isNull(), F.lit(0)).otherwise(F.size(covered)).cast("long")
    return step.select(*names, F.struct(*[n_repeat.alias(m) if m == "n_repeat_words" else F.col(f"_s.{m}").alias(m) for m in MEASURES]).alias("_m"))


def base_failed() -> Column:
    n, repeated = F.col("_m.n_words"), F.col("_m.n_repeat_words")
    return (n < 50) | (100 * repeated > 50 * n)


def votes(rules: Sequence[Rule] = RULES) -> Column:
    """One digit a rule: 1 good, 0 bad, 2 silent."""
    parts = []
    for rule in rules:
        above, below = (x.strip() for x in rule.value.split("/"))
        share = F.col(f"_m.{above}") / F.when(F.col(f"_m.{below}") > 0, F.col(f"_m.{below}"))
        bad, good = (share <= rule.bad, share >= rule.good) if rule.low else (share >= rule.bad, share <= rule.good)
        parts.append(F.when(bad, "0").when(good, "1").otherwise("2"))
    return F.concat(*parts)


@dataclass(frozen=True)
class Model:
    prior: float  # share of good texts
    chances: tuple  # for each rule: of votes 0, 1, 2 on bad texts, and on good ones

    def evidence(self, pattern: str) -> float:
        """Log odds of good."""
        return math.log(self.prior / (1 - self.prior)) + sum(
            math.log(good[int(v)] / bad[int(v)]) for v, (bad, good) in zip(pattern, self.chances))

    def posterior(self, pattern: str) -> float:
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, self.evidence(pattern)))))


def estimate(patterns: dict[str, int], rules: int, rounds: int = 100) -> Model:
    """Expectation-maximisation over counted vote patterns.

    It starts from rules that are mostly right and few bad texts. Each probability gets a small
    pseudo-count, and a bad vote stays ``TELLING`` times as likely on bad texts as on good ones at
    least: rules are trusted to be precise, not to be complete, and the classes cannot change places.
    """
    start = ((0.4, 0.5, 0.1), (0.02, 0.88, 0.1))
    model = Model(0.8, tuple(start for _ in range(rules)))
    for _ in range(rounds):
        mass, seen = [1.0, 4.0], [[[0.5] * 3, [0.1, 2.0, 0.5]] for _ in range(rules)]
        for pattern in sorted(patterns):
            n, p = patterns[pattern], model.posterior(pattern)
            for good, share in ((0, n * (1 - p)), (1, n * p)):
                mass[good] += share
                for r, v in enumerate(pattern):
                    seen[r][good][int(v)] += share
        chances = []
        for bad, good in seen:
            bad, good = ([x / sum(c) for x in c] for c in (bad, good))
            if good[0] > bad[0] / TELLING:
                rest = good[1] + good[2]
                good = [bad[0] / TELLING, *((1 - bad[0] / TELLING) * x / rest for x in good[1:])]
            chances.append((tuple(bad), tuple(good)))
        new = Model(mass[1] / sum(mass), tuple(chances))
        if abs(new.prior - model.prior) < 1e-9:
            return new
        model = new
    return model


def counted(rows: DataFrame, rules: Sequence[Rule] = RULES) -> dict[str, int]:
    """How often each combination of votes occurs: at most 3 ** len(rules) rows."""
    return {r["pattern"]: r["n"] for r in rows.groupBy(votes(rules).alias("pattern")).agg(F.count("*").alias("n")).collect()}


def posterior(model: Model, rules: Sequence[Rule] = RULES) -> Column:
    pattern = votes(rules)
    odds = F.lit(math.log(model.prior / (1 - model.prior)))
    for r, (bad, good) in enumerate(model.chances):
        vote = F.substring(pattern, r + 1, 1)
        a, b, c = (math.log(good[v] / bad[v]) for v in range(3))
        odds = odds + F.when(vote == "0", a).when(vote == "1", b).otherwise(c)
    return 1 / (1 + F.exp(-odds))


def quality_report(docs: DataFrame, rules: Sequence[Rule] = RULES, keep: float = KEEP, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row the base measures, base_failed, the posterior and whether the text is kept.

    A null text has no words; texts of fewer than 50 words fail. Repeated rows are measured each. Measures are
    stored once (a few numbers a row), so texts are read once; an empty table gives an empty result.
    """
    rows = stored(measured(texts(docs, key, text)).select("doc_id", "_m"), "measures")
    model = estimate(counted(rows, rules), len(rules))
    good = posterior(model, rules)
    return rows.select("doc_id", *[F.col(f"_m.{m}").alias(m) for m in MEASURES[:5]], base_failed().alias("base_failed"),
                       (~base_failed() & (good >= keep)).alias("kept"), good.alias("posterior"))


def keep_good(docs: DataFrame, rules: Sequence[Rule] = RULES, keep: float = KEEP, text: str = "text") -> DataFrame:
    """The rows that pass the base rules and whose posterior is high enough, with their columns unchanged.

    Null, empty and very short texts fail the base rules; whole texts are measured, however long. Repeated rows are judged
    each and share one verdict; an empty table stays empty; columns may have any name. Rows are stored with their
    measures: a filter pushed below the measuring would repeat it for every use.
    """
    rows = stored(measured(plain_names(docs), f"c{docs.columns.index(text)}"), "measured")
    model = estimate(counted(rows, rules), len(rules))
    return rows.where(~base_failed() & (posterior(model, rules) >= keep)).drop("_m").toDF(*docs.columns)
