"""Quality classifier: a sparse rule ensemble that runs as Spark column expressions.

Boosted trees over text statistics give conjunctive rules, one per tree path; a lasso logistic fit
keeps few of them; those become CASE expressions over the statistics, so scoring stays in the JVM.
Training sees a bounded sample of labelled rows and nothing but the statistics.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows that training reads at most, chosen by a hash of the id.
TRAIN_ROWS = 20_000


def statistics(text: Column) -> dict[str, Column]:
    """Named statistics of a text, each a double; null is the empty text, where all are 0."""
    t = F.coalesce(text.cast("string"), F.lit(""))
    n = F.length(t)
    per_char = lambda x: F.coalesce(x / F.nullif(n, F.lit(0)), F.lit(0.0))
    count = lambda c: n - F.length(F.replace(t, F.lit(c), F.lit("")))
    letters = F.length(F.regexp_replace(t, r"[^\p{L}]+", ""))
    capitals = F.length(F.regexp_replace(t, r"[^\p{Lu}]+", ""))
    digits = n - F.length(F.translate(t, "0123456789", ""))
    tokens = F.filter(F.split(t, r"\s+"), lambda w: w != "")
    words, different = F.size(tokens), F.size(F.array_distinct(tokens))
    per_word = lambda x: F.coalesce(x / F.nullif(words, F.lit(0)), F.lit(0.0))
    return {
        "bangs": per_char(count("!")),
        "pipes": per_char(count("|")),
        "signs": per_char(count("#") + count("$") + count("%") + count("&") + count("*")),
        "capitals": F.coalesce(capitals / F.nullif(letters, F.lit(0)), F.lit(0.0)),
        "letters": per_char(letters),
        "digits": per_char(digits),
        "words": words.cast("double"),
        "distinct": per_word(different),
        "word_length": per_word(letters),
        "lines": per_word(count("\n")),
        "stops": per_word(count(".") + count(",")),
    }


@dataclass(frozen=True)
class Rule:
    """All of (statistic, low, high): low < value <= high; and the rule's weight."""

    terms: tuple[tuple[str, float, float], ...]
    weight: float

    def holds(self) -> Column:
        out = F.lit(True)
        for name, low, high in self.terms:
            if np.isfinite(low):
                out = out & (F.col(name) > F.lit(low))
            if np.isfinite(high):
                out = out & (F.col(name) <= F.lit(high))
        return out


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    rules: tuple[Rule, ...]

    def logit(self) -> Column:
        out = F.lit(self.intercept)
        for rule in self.rules:
            out = out + F.when(rule.holds(), F.lit(rule.weight)).otherwise(F.lit(0.0))
        return out

    def score(self) -> Column:
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-self.logit()))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _grow(bins: np.ndarray, grad: np.ndarray, hess: np.ndarray, rows: np.ndarray, depth: int, least: int, path: tuple, out: list) -> None:
    """One tree by the usual second-order gain; collects (path, rows, value) of every node."""
    total_g, total_h = grad[rows].sum(), hess[rows].sum()
    if path:
        out.append((path, rows, -total_g / (total_h + 1.0)))
    if depth == 0 or len(rows) < 2 * least:
        return
    best, base = (1e-6, -1, -1), total_g**2 / (total_h + 1.0)
    for f in range(bins.shape[1]):
        own = bins[rows, f]
        size = int(own.max()) + 1
        g = np.cumsum(np.bincount(own, grad[rows], size))[:-1]
        h = np.cumsum(np.bincount(own, hess[rows], size))[:-1]
        n = np.cumsum(np.bincount(own, minlength=size))[:-1]
        gain = g**2 / (h + 1) + (total_g - g) ** 2 / (total_h - h + 1) - base
        gain[(n < least) | (n > len(rows) - least)] = 0
        if gain.size and gain.max() > best[0]:
            best = (gain.max(), f, int(gain.argmax()))
    _, f, cut = best
    if f < 0:
        return
    low = bins[rows, f] <= cut
    _grow(bins, grad, hess, rows[low], depth - 1, least, (*path, (f, cut, True)), out)
    _grow(bins, grad, hess, rows[~low], depth - 1, least, (*path, (f, cut, False)), out)


def _leaf_values(paths: list, n: int) -> np.ndarray:
    out = np.zeros(n)
    for _, rows, value in paths:  # a child comes after its parent and overwrites it
        out[rows] = value
    return out


def fit_rules(x: np.ndarray, y: np.ndarray, names: list[str], trees: int = 40, depth: int = 3, cuts: int = 48, penalty: float = 2e-3, steps: int = 400) -> RuleModel:
    """Boost trees on (x, y), take their paths as rules and fit lasso logistic weights.

    Without rows of both labels the model is the constant (n1 + 1) / (n + 2).
    """
    n, prior = len(y), (y.sum() + 1) / (len(y) + 2)
    constant = RuleModel(float(np.log(prior / (1 - prior))), ())
    if n < 10 or y.min() == y.max():
        return constant
    edges = []
    for column in x.T:
        values = np.unique(column)
        middle = (values[1:] + values[:-1]) / 2
        edges.append(middle if len(middle) <= cuts else np.unique(np.quantile(middle, np.linspace(0, 1, cuts))))
    bins = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)], 1)
    least, margin, found = max(3, n // 1000), np.full(n, np.log(prior / (1 - prior))), {}
    for _ in range(trees):
        p = _sigmoid(margin)
        paths: list = []
        _grow(bins, p - y, p * (1 - p), np.arange(n), depth, least, (), paths)
        if not paths:
            break
        margin += 0.3 * _leaf_values(paths, n)
        for path, rows, _ in paths:
            box: dict[int, list[float]] = {}
            for f, cut, low in path:
                own = box.setdefault(f, [-np.inf, np.inf])
                own[low] = min(own[1], edges[f][cut]) if low else max(own[0], edges[f][cut])
            found.setdefault(tuple((f, *box[f]) for f in sorted(box)), rows)
    rules = list(found)
    if not rules:
        return constant
    matrix = np.zeros((n, len(rules)), np.float32)
    for k, rule in enumerate(rules):
        matrix[found[rule], k] = 1
    weights, intercept = _lasso(matrix, y, penalty, steps)
    kept = [k for k in range(len(rules)) if abs(weights[k]) > 1e-3]
    return RuleModel(float(intercept), tuple(Rule(tuple((names[f], float(a), float(b)) for f, a, b in rules[k]), float(weights[k])) for k in kept))


def _lasso(x: np.ndarray, y: np.ndarray, penalty: float, steps: int) -> tuple[np.ndarray, float]:
    """L1 logistic regression by accelerated proximal gradient; the intercept is free."""
    n, m = x.shape
    full = np.hstack([x, np.ones((n, 1), np.float32)])
    probe = np.ones(m + 1)
    for _ in range(20):
        probe = full.T @ (full @ probe)
        probe /= np.linalg.norm(probe)
    rate = 4 * n / float(np.linalg.norm(full @ probe) ** 2 * 1.02 + 1e-9)
    w = v = np.zeros(m + 1)
    t = 1.0
    for _ in range(steps):
        step = v - rate * (full.T @ (_sigmoid(full @ v) - y)) / n
        new = np.sign(step) * np.maximum(np.abs(step) - rate * penalty, 0)
        new[-1] = step[-1]
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v = new + (t - 1) / t_new * (new - w)
        w, t = new, t_new
    return w[:-1], w[-1]


def train_quality(docs: DataFrame, labels: DataFrame, label_col: str = "quality", rows: int = TRAIN_ROWS, keep: Column | None = None, id_col: str = "doc_id", text_col: str = "text") -> RuleModel:
    """Fit on at most ``rows`` labelled rows, chosen by a hash of the id, for which ``keep`` holds."""
    picked = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    picked = picked.where(keep) if keep is not None else picked
    picked = picked.select(F.col(id_col).alias("__id"), F.col(label_col).cast("double").alias("__y")).orderBy(F.md5(F.col("__id").cast("string")), "__id", "__y").limit(rows)
    sample = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).join(F.broadcast(picked), "__id")  # at most ``rows`` rows
    stats = statistics(F.col("__text"))
    found = sample.select("__id", "__y", *[c.alias(k) for k, c in stats.items()]).toPandas().sort_values(["__id", "__y", *stats], kind="stable")
    return fit_rules(found[list(stats)].to_numpy(float).reshape(-1, len(stats)), found["__y"].to_numpy(float), list(stats))


def score_quality(docs: DataFrame, model: RuleModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, statistics...) of every row; score is in (0, 1), higher: label 1 likelier.

    Null and empty texts have all statistics 0 and get what the rules give for that.  Repeated rows
    get equal scores; other columns are ignored; an empty table gives an empty result.
    """
    stats = statistics(F.col(text_col))
    rows = docs.select(F.col(id_col), *[c.alias(k) for k, c in stats.items()])
    return rows.select(id_col, model.score().alias("score"), *stats)
