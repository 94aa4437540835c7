"""Quality classifier: a sparse ensemble of rules.

Small decision trees are grown on statistics of a bounded sample of labelled texts. Every path from a root to a node is a
rule, a conjunction of comparisons. A logistic regression with an L1 penalty (lasso) weighs the rules and drops most
of them. What is left is compiled into one Spark column expression over the statistics, which are built-in functions of
the text: scoring runs no Python and moves no text.

Bounds: ``sample_rows`` labelled rows are fitted on the driver, as eleven numbers each. Every text is scored whole.

Cases: a null text counts as empty, and an empty text has all statistics 0 and is scored like any other; null labels and
labels other than 0 and 1 teach nothing; of several labels of one document each one counts; without labels of both
kinds the score is the share of label 1 (0.5 without any label); repeated rows are scored one by one.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cotrend.llm.common import SPACE, texts

TREES = 24
DEPTH = 3
LEAST_ROWS = 8
PENALTIES = (0.03, 0.01, 0.003, 0.001)


def statistics(text: Column) -> dict[str, Column]:
    """Numbers about a text, each 0 for an empty one."""
    chars = F.length(text).cast("double")
    words = F.regexp_count(text, F.lit(rf"[^{SPACE}]+")).cast("double")
    lines = F.split(text, "\n", -1)
    part = lambda n, whole: F.when(whole > 0, n / whole).otherwise(F.lit(0.0))
    share = lambda cls: part(F.regexp_count(text, F.lit(cls)).cast("double"), chars)
    return {
        "chars": chars,
        "chars_per_word": part(chars, words),
        "words_per_line": part(words, F.size(lines).cast("double")),
        "upper_share": share(r"[A-Z]"),
        "symbol_share": share(r"[#$%&*+/<=>@\\^_`{|}~]"),
        "mark_share": share(r"[!?]"),
        "stop_share": share(r"[.,;:]"),
        "digit_share": share(r"[0-9]"),
        "long_words": part(F.regexp_count(text, F.lit(rf"[^{SPACE}]{{13,}}")).cast("double"), words),
        # a word and the same word again; matching never backtracks, so long texts cost no more a character
        "echoes": part(
            F.regexp_count(text, F.lit(rf"(?<![^{SPACE}])([^{SPACE}]++)[{SPACE}]\1(?![^{SPACE}])")).cast("double"), words
        ),
        "repeated_lines": F.when(
            chars > 0, 1.0 - F.size(F.array_distinct(lines)) / F.size(lines).cast("double")
        ).otherwise(F.lit(0.0)),
    }


@dataclass(frozen=True)
class Rule:
    """All of ``(statistic, above?, threshold)`` hold."""

    parts: frozenset[tuple[str, bool, float]]

    def column(self, prefix: str) -> Column:
        value = {n: F.col(prefix + n) for n, _, _ in self.parts}
        tests = [value[n] > t if above else value[n] <= t for n, above, t in sorted(self.parts)]
        return reduce(lambda a, b: a & b, tests)

    def of(self, x: np.ndarray, names: list[str]) -> np.ndarray:
        out = np.ones(len(x), bool)
        for name, above, threshold in self.parts:
            value = x[:, names.index(name)]
            out &= value > threshold if above else value <= threshold
        return out


@dataclass
class Model:
    rules: list[tuple[Rule, float]]
    bias: float

    def column(self, prefix: str = "_stat_") -> Column:
        """Score between 0 and 1, from the columns of the statistics."""
        logit = F.lit(self.bias)
        for rule, weight in self.rules:
            logit = logit + F.when(rule.column(prefix), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))


def best_split(x: np.ndarray, y: np.ndarray, features: np.ndarray) -> tuple[int, float] | None:
    """The feature and threshold that lower the Gini impurity most."""
    best, found = 1e-9, None
    n, ones = len(y), y.sum()
    base = ones * (n - ones) / n
    for f in features:
        order = np.argsort(x[:, f], kind="stable")
        value, left = x[order, f], np.cumsum(y[order])[:-1]
        sizes = np.arange(1, n)
        can = (value[1:] > value[:-1]) & (sizes >= LEAST_ROWS) & (n - sizes >= LEAST_ROWS)
        if not can.any():
            continue
        gain = base - left * (sizes - left) / sizes - (ones - left) * (n - sizes - ones + left) / (n - sizes)
        k = int(np.argmax(np.where(can, gain, -1)))
        if gain[k] > best:
            best, found = gain[k], (int(f), float((value[k] + value[k + 1]) / 2))
    return found


def grow(x, y, names: list[str], random, depth: int, path: frozenset, rules: dict[Rule, None]) -> None:
    if depth == 0 or len(y) < 2 * LEAST_ROWS or y.min() == y.max():
        return
    some = random.permutation(x.shape[1])[: max(2, x.shape[1] // 2)]
    split = best_split(x, y, np.sort(some))
    if split is None:
        return
    feature, threshold = split
    for above in (False, True):
        side = (x[:, feature] > threshold) == above
        longer = path | {(names[feature], above, threshold)}
        rules[Rule(longer)] = None
        grow(x[side], y[side], names, random, depth - 1, longer, rules)


def lasso(z: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400) -> tuple[np.ndarray, float]:
    """Logistic loss plus ``penalty`` times the sum of weights' sizes, by accelerated proximal gradient."""
    n, k = z.shape
    w, bias = np.zeros(k), np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6))
    v, c, t = w.copy(), bias, 1.0
    step = 4.0 / (np.linalg.norm(np.column_stack([z, np.ones(n)]), 2) ** 2 / n + 1e-12)
    for _ in range(steps):
        error = 1 / (1 + np.exp(-np.clip(z @ v + c, -40, 40))) - y
        moved = v - step * (z.T @ error) / n
        w_next = np.sign(moved) * np.maximum(np.abs(moved) - step * penalty, 0)
        b_next = c - step * error.mean()
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, c = w_next + (t - 1) / t_next * (w_next - w), b_next + (t - 1) / t_next * (b_next - bias)
        w, bias, t = w_next, b_next, t_next
    return w, float(bias)


def fit_rules(x: np.ndarray, y: np.ndarray, names: list[str], seed: int = 5) -> Model:
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.5
        return Model([], float(np.log((share + 1e-3) / (1 - share + 1e-3))))
    random = np.random.default_rng(seed)
    rules: dict[Rule, None] = {}
    for _ in range(TREES):
        rows = random.choice(len(y), max(1, int(0.7 * len(y))), replace=False)
        grow(x[rows], y[rows], names, random, DEPTH, frozenset(), rules)
    found = list(rules)
    z = np.column_stack([r.of(x, names) for r in found]).astype(float) if found else np.zeros((len(y), 0))
    kept_back = random.permutation(len(y)) % 4 == 0
    score = {}
    for penalty in PENALTIES:
        w, bias = lasso(z[~kept_back], y[~kept_back], penalty)
        p = np.clip(1 / (1 + np.exp(-np.clip(z[kept_back] @ w + bias, -40, 40))), 1e-6, 1 - 1e-6)
        score[penalty] = -(y[kept_back] * np.log(p) + (1 - y[kept_back]) * np.log(1 - p)).mean()
    weights, bias = lasso(z, y, min(score, key=score.get))
    return Model([(r, float(w)) for r, w in zip(found, weights) if abs(w) > 1e-6], bias)


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = 6000, seed: int = 5) -> Model:
    """Learn from ``doc_id``, ``text`` and ``doc_id``, ``quality``; the caller leaves out what may not be learned from."""
    usable = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", "quality")
    place = F.xxhash64("doc_id", F.lit(seed))
    chosen = usable.distinct().orderBy(place, "doc_id", "quality").limit(sample_rows)
    met = texts(docs).join(F.broadcast(chosen), "doc_id")  # at most sample_rows pairs of numbers
    # a doc_id may have any number of rows; one text for each pair keeps what reaches the driver bounded
    rows = met.groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    stats = statistics(F.col("text"))
    table = rows.select("doc_id", "quality", *[c.alias(n) for n, c in stats.items()]).toPandas()
    table = table.sort_values(list(table.columns), kind="stable")
    names = list(stats)
    return fit_rules(table[names].to_numpy(float), table["quality"].to_numpy(float), names, seed)


def with_statistics(docs: DataFrame) -> DataFrame:
    """``docs`` with a column per statistic and ``_row``.

    A filter that also reads ``_row`` stays above this projection: pushed below it, every rule would count its texts anew.
    """
    stats = statistics(F.coalesce(F.col("text"), F.lit("")))
    named = [c.alias(f"_stat_{n}") for n, c in stats.items()]
    return docs.select("*", *named, F.monotonically_increasing_id().alias("_row"))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``score`` for every row."""
    return with_statistics(docs.select("doc_id", "text")).select("doc_id", model.column().alias("score"))


def keep(docs: DataFrame, model: Model, least: float) -> DataFrame:
    """The rows of ``docs``, unchanged, whose score is ``least`` or more; columns may have any names."""
    # columns that are named like the statistics step aside meanwhile
    clashing = [name for name in docs.columns if name.lower() == "_row" or name.lower().startswith("_stat_")]
    aside = {name: f"_aside_{uuid.uuid4().hex}" for name in clashing}
    passed = with_statistics(docs.withColumnsRenamed(aside)).where((model.column() >= least) & (F.col("_row") >= 0))
    return passed.select([F.col(f"`{aside.get(name, name)}`").alias(name) for name in docs.columns])
