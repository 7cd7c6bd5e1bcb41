"""Quality by a sparse rule ensemble, compiled into Spark column expressions.

Text statistics are column expressions over the whole text. On a bounded labelled
sample, shallow trees are grown over them (numpy, each on its own bootstrap
rows); every path from a root to a node is a rule, a conjunction of limits. A
logistic model with an L1 penalty keeps few rules, and they become one column
expression again: prediction runs in the JVM alone.

Defined results: a null text has the statistics of the empty text; equal texts
score alike; a training sample without both classes is an error; an empty table
gives an empty result. Input columns named like an output column are replaced by it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from settlekit.llm import blocks as B

TREES, DEPTH, LEAF = 40, 3, 10
PENALTY, STEPS = 0.002, 400
SAMPLE = 6000
LIMIT = 0.3                     # predicted 1 from this score on
OUTPUTS = ("score", "predicted")
#: Characters counted as symbols (a fixed value).
SYMBOLS = "!|%$&*#~^@<>{}[]=+_/\\"


def _share(text: Column, characters: str, n: Column) -> Column:
    return (n - F.length(F.translate(text, characters, ""))) / n


def statistics(text: Column) -> dict[str, Column]:
    """The statistics by name; all are doubles and never null."""
    t = F.coalesce(text.cast("string"), F.lit(""))
    n = F.greatest(F.length(t), F.lit(1)).cast("double")
    words, lines = F.split(t, " "), F.split(t, "\n")
    n_words = F.size(words).cast("double")
    return {
        "log_length": F.log1p(F.length(t).cast("double")),
        "upper": _share(t, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", n),
        "digits": _share(t, "0123456789", n),
        "symbols": _share(t, SYMBOLS, n),
        "word_length": n / n_words,
        "distinct_words": F.size(F.array_distinct(words)) / n_words,
        "distinct_lines": F.size(F.array_distinct(lines)) / F.size(lines).cast("double"),
        "line_length": n / F.size(lines).cast("double"),
    }


@dataclass(frozen=True)
class Rule:
    """All of ``(statistic, limit, above)``: statistic > limit, or <= limit."""
    parts: tuple[tuple[str, float, bool], ...]
    weight: float

    def column(self) -> Column:
        out = F.lit(True)
        for name, limit, above in self.parts:
            out = out & ((F.col(name) > limit) if above else (F.col(name) <= limit))
        return F.when(out, F.lit(self.weight)).otherwise(F.lit(0.0))


@dataclass(frozen=True)
class RuleModel:
    rules: tuple[Rule, ...]
    bias: float

    def column(self) -> Column:
        z = F.lit(self.bias)
        for rule in self.rules:
            z = z + rule.column()
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def _split(x: np.ndarray, y: np.ndarray, features: np.ndarray) -> tuple[int, float] | None:
    """(feature, limit) of the split with the least squared error."""
    best, n = None, len(y)
    for f in features.tolist():
        order = np.argsort(x[:, f], kind="stable")
        v, s = x[order, f], np.cumsum(y[order])
        left = np.arange(1, n)
        ok = (v[1:] > v[:-1]) & (left >= LEAF) & (n - left >= LEAF)
        if ok.any():
            gain = np.where(ok, s[:-1] ** 2 / left + (s[-1] - s[:-1]) ** 2 / (n - left), -np.inf)
            i = int(gain.argmax())
            if best is None or gain[i] > best[0]:
                best = (gain[i], f, float((v[i] + v[i + 1]) / 2))
    return None if best is None or best[0] <= y.sum() ** 2 / n + 1e-9 else best[1:]


def tree_rules(x: np.ndarray, y: np.ndarray, names: list[str], seed: int = 3) -> list[tuple]:
    """The distinct paths of ``TREES`` trees."""
    rng = np.random.default_rng(seed)
    found: dict[tuple, None] = {}

    def grow(rows, path, depth):
        if depth == DEPTH or len(rows) < 2 * LEAF:
            return
        cut = _split(x[rows], y[rows], rng.permutation(x.shape[1])[:max(2, x.shape[1] // 2)])
        if cut is None:
            return
        f, limit = cut
        for above in (False, True):
            part = rows[(x[rows, f] > limit) == above]
            longer = tuple(sorted({*path, (names[f], limit, above)}))
            found.setdefault(longer)
            grow(part, longer, depth + 1)

    for _ in range(TREES):
        grow(rng.integers(0, len(y), len(y)), (), 0)
    return list(found)


def lasso(a: np.ndarray, y: np.ndarray, penalty: float = PENALTY, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Logistic weights with an L1 penalty, by accelerated proximal gradient steps."""
    n = len(y)
    rate = 4.0 / max(1e-9, np.linalg.norm(np.hstack([a, np.ones((n, 1))]), 2) ** 2 / n)
    w = v = np.zeros(a.shape[1] + 1)
    t = 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ v[:-1] + v[-1], -30, 30)))
        g = np.append(a.T @ (p - y), (p - y).sum()) / n
        new = v - rate * g
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - rate * penalty, 0)
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v = new + (t - 1) / t_next * (new - w)
        w, t = new, t_next
    return w[:-1], float(w[-1])


def train(x: np.ndarray, y: np.ndarray, names: list[str]) -> RuleModel:
    if len(set(y.tolist())) < 2:
        raise ValueError("both classes are needed to learn from")
    paths = tree_rules(x, y.astype(np.float64), names)
    at = {n: i for i, n in enumerate(names)}
    a = np.ones((len(y), len(paths)))
    for j, path in enumerate(paths):
        for name, limit, above in path:
            a[:, j] *= (x[:, at[name]] > limit) == above
    weights, bias = lasso(a, y.astype(np.float64))
    return RuleModel(tuple(Rule(p, float(w)) for p, w in zip(paths, weights, strict=True) if abs(w) > 1e-3), bias)


def fit_quality_model(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      label_col: str = "quality", sample: int = SAMPLE) -> RuleModel:
    """Trains on the documents of at most ``sample`` labels per class (only their statistics leave Spark)."""
    made = statistics(F.col("text"))
    rows = B.labelled_sample(docs, labels, label_col, {0: sample, 1: sample}, id_col, text_col).select(
        "label", *[c.alias(n) for n, c in made.items()]).collect()
    data = np.array(sorted(tuple(r) for r in rows), dtype=np.float64).reshape(-1, 1 + len(made))
    return train(data[:, 1:], data[:, 0].astype(np.int64), list(made))


def score_quality(docs: DataFrame, model: RuleModel, text_col: str = "text", limit: float = LIMIT) -> DataFrame:
    """``docs`` without its text, with ``score`` and ``predicted`` (score >= ``limit``)."""
    rest = [c for c in docs.columns if c != text_col and c not in OUTPUTS]
    made = statistics(F.col(text_col))
    stats = docs.select(*[F.col(c).alias(f"__in_{c}") for c in rest], *[c.alias(n) for n, c in made.items()])
    scored = stats.withColumn("__score", model.column())
    return scored.select(*[F.col(f"__in_{c}").alias(c) for c in rest], F.col("__score").alias("score"),
                         (F.col("__score") >= limit).cast("int").alias("predicted"))
