"""Quality classifier: a sparse ensemble of rules over text statistics.

Boosted trees on a bounded sample of labelled documents propose rules (the paths to their nodes),
a lasso logistic regression keeps few of them, and these become one Spark column expression.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import SPACE, checked_broadcast, held_out, let
from orderloom.llm.mixing import n_words

# At most so many labelled documents train the model: those with the smallest seeded hash of the id.
SAMPLE = 20_000
TREES, DEPTH, BINS, RATE = 24, 3, 64, 0.3
# Weight of the lasso's penalty and its steps.
PENALTY, STEPS = 2e-3, 400


# The statistics, in the order of the struct.
STATISTICS = [
    "words", "mean_word", "upper", "digits", "symbols", "sentence_marks", "distinct_words",
    "distinct_lines",
]


def statistics(text: Column) -> Column:
    """Statistics of a whole text as a struct of doubles; a null text counts as empty.

    Built-in functions only. Everything that reads the text is bound once, so that the struct costs
    the same wherever the optimiser moves it.
    """

    def share(count: Column, of: Column) -> Column:
        return F.when(of > 0, count.cast("double") / of).otherwise(F.lit(0.0))

    def distinct(parts: Column) -> Column:
        return let(
            parts, lambda p: share(F.size(F.array_distinct(p)), F.size(p))
        )

    def ratios(c: Column) -> Column:
        out = [
            c["words"].cast("double"), share(c["n"] - c["words"] + 1, c["words"]),
            share(c["upper"], c["n"]), share(c["digits"], c["n"]),
            share(c["marks"] - c["plain"], c["n"]), share(c["plain"], c["n"]),
            c["distinct_words"], c["distinct_lines"],
        ]
        return F.struct(*[o.alias(k) for k, o in zip(STATISTICS, out, strict=True)])

    def counts(t: Column) -> Column:
        def kept(pattern: str) -> Column:
            return F.length(F.regexp_replace(t, pattern, ""))

        return F.struct(
            F.length(t).alias("n"),
            n_words(t).alias("words"),
            kept(r"\P{Lu}+").alias("upper"),
            kept(r"\P{N}+").alias("digits"),
            kept(r"[\p{L}\p{N}\s]+").alias("marks"),
            kept(r"[^.,;:'\"()-]+").alias("plain"),
            distinct(F.split(F.lower(t), SPACE)).alias("distinct_words"),
            distinct(F.split(t, "\n")).alias("distinct_lines"),
        )

    return let(counts(F.coalesce(text, F.lit(""))), ratios)


@dataclass(frozen=True)
class Condition:
    """``feature <= at`` or, with ``above``, ``feature > at``."""

    feature: str
    at: float
    above: bool

    def column(self, stats: Column) -> Column:
        value = stats[self.feature]
        return value > F.lit(self.at) if self.above else value <= F.lit(self.at)

    def mask(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] > self.at if self.above else x[self.feature] <= self.at


Rule = tuple[Condition, ...]


@dataclass(frozen=True)
class Model:
    bias: float
    rules: tuple[tuple[Rule, float], ...]

    def score(self, stats: Column) -> Column:
        """Probability of label 1, as one expression over the struct of statistics."""
        total = F.lit(self.bias)
        for rule, weight in self.rules:
            hit = rule[0].column(stats)
            for condition in rule[1:]:
                hit = hit & condition.column(stats)
            total = total + F.when(hit, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def _tree(codes: np.ndarray, cuts: list, names: list, g: np.ndarray, h: np.ndarray, out: np.ndarray):
    """Grow one tree on gradients and return the rules of its nodes; adds its values to ``out``."""
    rules, nodes = [], [((), np.arange(len(g)), 0)]
    while nodes:
        rule, rows, depth = nodes.pop(0)
        if rule:
            rules.append(rule)
        best = (1e-9, None, None)
        base = g[rows].sum() ** 2 / (h[rows].sum() + 1.0)
        if depth < DEPTH and len(rows) >= 20:
            for f in range(codes.shape[1]):
                size = len(cuts[f]) + 1
                gs = np.bincount(codes[rows, f], g[rows], size).cumsum()[:-1]
                hs = np.bincount(codes[rows, f], h[rows], size).cumsum()[:-1]
                if not len(gs):
                    continue
                gain = gs**2 / (hs + 1) + (g[rows].sum() - gs) ** 2 / (h[rows].sum() - hs + 1)
                k = int(np.argmax(gain))
                if gain[k] - base > best[0]:
                    best = (gain[k] - base, f, k)
        if best[1] is None:
            out[rows] += RATE * g[rows].sum() / (h[rows].sum() + 1.0)
            continue
        _, f, k = best
        low = codes[rows, f] <= k
        for above, part in ((False, rows[low]), (True, rows[~low])):
            nodes.append(((*rule, Condition(names[f], float(cuts[f][k]), above)), part, depth + 1))
    return rules


def _tidy(rule: Rule) -> Rule:
    """Keep the tightest condition per feature and side."""
    best: dict[tuple[str, bool], Condition] = {}
    for c in rule:
        old = best.get((c.feature, c.above))
        if old is None or (c.at > old.at if c.above else c.at < old.at):
            best[(c.feature, c.above)] = c
    return tuple(sorted(best.values(), key=lambda c: (c.feature, c.above)))


def train(x: dict[str, np.ndarray], y: np.ndarray) -> Model:
    """Rules from boosted trees, weights from a lasso logistic regression by proximal gradient.

    Without rows the score is 0.5; with one label only it is the smoothed share of label 1.
    """
    n = len(y)
    prior = (y.sum() + 1.0) / (n + 2.0)
    bias = float(np.log(prior / (1 - prior)))
    if n == 0 or y.min() == y.max():
        return Model(bias, ())
    names = sorted(x)
    cuts, codes = [], np.zeros((n, len(names)), dtype=np.int64)
    for f, name in enumerate(names):
        values = np.unique(np.quantile(x[name], np.linspace(0, 1, BINS + 1)[1:-1]))
        values = values[values < x[name].max()]
        cuts.append(values)
        codes[:, f] = np.searchsorted(values, x[name], side="left")
    out, found = np.full(n, bias), []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-out))
        found += _tree(codes, cuts, names, y - p, p * (1 - p), out)
    rules = list(dict.fromkeys(_tidy(r) for r in found))
    matrix = np.ones((n, len(rules)))
    for k, rule in enumerate(rules):
        for condition in rule:
            matrix[:, k] *= condition.mask(x)
    _, first = np.unique(matrix, axis=1, return_index=True)
    first = np.sort(first)
    rules, matrix = [rules[k] for k in first], matrix[:, first]
    # Proximal gradient with momentum; the bias is not penalised.
    step = 4.0 * n / (np.linalg.norm(np.c_[matrix, np.ones(n)], 2) ** 2)
    w, b = np.zeros(len(rules)), bias
    vw, vb, t = w, b, 1.0
    for _ in range(STEPS):
        e = (1 / (1 + np.exp(-(matrix @ vw + vb))) - y) / n
        nw = vw - step * (matrix.T @ e)
        nw = np.sign(nw) * np.maximum(np.abs(nw) - step * PENALTY, 0)
        nb = vb - step * e.sum()
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        vw, vb = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = nw, nb, nt
    kept = tuple((r, float(v)) for r, v in zip(rules, w, strict=True) if abs(v) > 1e-6)
    return Model(float(b), kept)


def fit(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", sample: int = SAMPLE, seed: int = 11,
) -> Model:
    """Fit on at most ``sample`` labelled documents outside the held-out third.

    A document with several labels counts as 1 if at least half of them are; null ids, null labels
    and labels without a document are left out. Equal ids in ``docs`` count as rows of their own.
    """
    ids = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
        .where(~held_out(id_col, 3, 1))
        .groupBy(F.col(id_col).alias("_id"))
        .agg((F.avg(F.col(label_col).cast("double")) >= 0.5).cast("int").alias("_label"))
        .orderBy(F.xxhash64("_id", F.lit(seed)), "_id")
        .limit(sample)
    )
    rows = (
        docs.select(F.col(id_col).alias("_id"), F.col(text_col))
        .join(checked_broadcast(ids, sample, SAMPLE), "_id")
        .select("_id", "_label", statistics(F.col(text_col)).alias("_statistics"))
        .orderBy(F.xxhash64("_id", F.lit(seed)), "_id", "_statistics")
        .limit(sample)
        .select("_label", "_statistics.*")
        .collect()
    )
    data = np.array([tuple(r) for r in rows], dtype=float).reshape(-1, len(STATISTICS) + 1)
    return train({k: data[:, i + 1] for i, k in enumerate(STATISTICS)}, data[:, 0])


def score(docs: DataFrame, model: Model, *, text_col: str = "text", out: str = "score") -> DataFrame:
    """All columns of ``docs`` with ``out`` (a column of that name is replaced), from 0 to 1.

    Null and empty texts are scored by the statistics of an empty text.
    """
    return docs.withColumn(out, let(statistics(F.col(text_col)), model.score))


def classify(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document, by a model fitted on ``labels``."""
    model = fit(docs, labels, id_col=id_col)
    return score(docs.select(id_col, "text"), model).select(
        id_col, held_out(id_col, 3, 1).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
