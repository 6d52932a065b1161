"""Quality classifier: a sparse ensemble of rules over statistics of a text.

Trees are boosted on statistics of labelled texts; every path from a root to a node is a conjunction of thresholds, a
rule. A logistic regression with an L1 penalty weighs the rules, most of them with zero, and what is left is compiled
into one Spark column expression over the statistics.

The classifier is fitted on at most ``FIT_ROWS`` labelled rows in the order of a hash of doc_id, whole texts; every
text is scored whole. Classes weigh alike in the fit, so that a score of 0.5 means no evidence either way.

Defined results: a null text counts as empty, and an empty text has all statistics zero and a score like any other;
labels that are null teach nothing, the lowest counts where a doc_id has several; without labels of both classes the
score is 0.5; repeated rows score alike; an empty table gives an empty result; extra columns, whatever their names, are
kept by ``score_quality`` unless named ``score`` in any case.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import apart, chosen

FIT_ROWS = 20_000
TREES = 40
DEPTH = 3
BINS = 48
PENALTY = 0.002
SEED = 11

SYMBOLS = b"#*$%&|<>"
STATS = (
    "log_words", "word_length", "symbols", "bare_symbol_words", "symbol_ended_words", "upper", "bangs", "distinct_words",
    "repeated_next", "repeated_pairs", "longest_run", "repeated_lines", "digits", "marks", "line_words", "ended_lines",
    "long_words", "sentence_words",
)
_MARKS = bytes(range(33, 48)) + bytes(range(58, 65)) + bytes(range(91, 97)) + bytes(range(123, 127))


def text_statistics(text: str | None) -> tuple[float, ...]:
    """The statistics in the order of ``STATS``; shares of words, characters or lines, all 0 for a text without words."""
    raw = (text or "").encode()
    words = raw.split()
    n = len(words)
    if not n:
        return (0.0,) * len(STATS)
    size = len(raw)
    letters = sum(map(len, words))
    share = lambda drop: (size - len(raw.translate(None, drop))) / size
    lines = [x for x in raw.split(b"\n") if x.strip()]
    same = list(map(eq, words, words[1:]))
    run = best = 1
    if any(same):
        for s in same:
            run = run + 1 if s else 1
            best = run if run > best else best
    pairs = len(set(zip(words, words[1:])))
    bare = sum(1 for w in words if len(w) < 3 and not w.translate(None, SYMBOLS))
    ended = sum(1 for w in words if w[-1] in SYMBOLS)
    upper = raw.translate(None, bytes(set(range(256)) - set(range(65, 91))))
    lower = raw.translate(None, bytes(set(range(256)) - set(range(97, 123))))
    return (
        float(np.log1p(n)),
        letters / n,
        share(SYMBOLS),
        bare / n,
        ended / n,
        len(upper) / max(1, len(upper) + len(lower)),
        raw.count(b"!!") / n,
        len(set(words)) / n,
        sum(same) / n,
        1.0 - pairs / max(1, n - 1) if n > 1 else 0.0,
        best / n if best > 2 else 0.0,
        1.0 - len(set(lines)) / len(lines),
        share(b"0123456789"),
        share(_MARKS),
        n / len(lines),
        sum(1 for x in lines if x.rstrip()[-1:] in b".!?") / len(lines),
        sum(1 for w in words if len(w) > 20) / n,
        n / (1 + raw.count(b".") + raw.count(b"!") + raw.count(b"?")),
    )


def statistics_column(text: Column) -> Column:
    """A struct of the statistics; only the text goes to Python."""

    @F.pandas_udf(", ".join(f"{s} double" for s in STATS))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([text_statistics(t) for t in texts], columns=list(STATS), dtype=float)

    return run(text)


@dataclass(frozen=True)
class Rule:
    """A conjunction of (statistic, is_above, threshold): value > threshold if is_above, else value <= threshold."""

    terms: tuple[tuple[int, bool, float], ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), dtype=bool)
        for k, above, t in self.terms:
            out &= (x[:, k] > t) == above
        return out

    def column(self, stats: Column) -> Column:
        out = F.lit(True)
        for k, above, t in self.terms:
            value = stats[STATS[k]]
            out = out & (value > t if above else value <= t)
        return out


@dataclass(frozen=True)
class RuleEnsemble:
    rules: tuple[tuple[Rule, float], ...]
    intercept: float

    def column(self, stats: Column) -> Column:
        """The score as one expression over the struct of statistics."""
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(rule.column(stats), weight).otherwise(0.0)
        return 1.0 / (1.0 + F.exp(-total))


def _grow(x: np.ndarray, binned: np.ndarray, cuts: list[np.ndarray], g: np.ndarray, h: np.ndarray, rows: np.ndarray, depth: int, path: tuple, found: list[tuple]) -> list[tuple[tuple, np.ndarray, float]]:
    """Leaves of one tree as (path, rows, value); every inner and leaf path goes to ``found``."""
    value = -g[rows].sum() / (h[rows].sum() + 1.0)
    best = (1e-3, -1, -1)
    if depth and len(rows) >= 20:
        base = g[rows].sum() ** 2 / (h[rows].sum() + 1.0)
        for k in range(x.shape[1]):
            if not len(cuts[k]):
                continue
            gs = np.cumsum(np.bincount(binned[rows, k], g[rows], len(cuts[k]) + 1))[:-1]
            hs = np.cumsum(np.bincount(binned[rows, k], h[rows], len(cuts[k]) + 1))[:-1]
            ns = np.cumsum(np.bincount(binned[rows, k], minlength=len(cuts[k]) + 1))[:-1]
            gain = gs**2 / (hs + 1.0) + (g[rows].sum() - gs) ** 2 / (h[rows].sum() - hs + 1.0) - base
            gain[(ns < 5) | (ns > len(rows) - 5)] = 0
            at = int(np.argmax(gain))
            if gain[at] > best[0]:
                best = (gain[at], k, at)
    if best[1] < 0:
        return [(path, rows, value)]
    _, k, at = best
    low = binned[rows, k] <= at
    leaves = []
    for side, above in ((rows[low], False), (rows[~low], True)):
        step = (*path, (k, above, float(cuts[k][at])))
        found.append(step)
        leaves += _grow(x, binned, cuts, g, h, side, depth - 1, step, found)
    return leaves


def _rules(x: np.ndarray, y: np.ndarray, w: np.ndarray, trees: int, depth: int, seed: int) -> list[Rule]:
    """Distinct rules on the paths of boosted trees, each grown on a random half of the rows."""
    rng = np.random.default_rng(seed)
    cuts = []
    for k in range(x.shape[1]):
        v = np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1]))
        v = np.unique(np.concatenate([v, np.quantile(x[y == 0, k], np.linspace(0, 1, 9)[1:-1])]))
        cuts.append(v[v < x[:, k].max()])
    binned = np.stack([np.searchsorted(c, x[:, k], side="left") for k, c in enumerate(cuts)], axis=1)
    f = np.zeros(len(y))
    found: list[tuple] = []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-f))
        rows = np.sort(rng.choice(len(y), max(1, len(y) // 2), replace=False))
        for path, _, value in _grow(x, binned, cuts, w * (p - y), w * p * (1 - p), rows, depth, (), found):
            f += 0.3 * value * (Rule(path).holds(x) if path else 1.0)
    return [Rule(t) for t in dict.fromkeys(tuple(sorted(set(p))) for p in found)]


def _lasso(z: np.ndarray, y: np.ndarray, w: np.ndarray, penalty: float, steps: int = 400) -> tuple[np.ndarray, float]:
    """Weights and intercept of an L1-penalised logistic regression, by accelerated proximal gradient steps."""
    a = np.column_stack([z, np.ones(len(z))])
    w = w / w.sum()
    v = np.ones(a.shape[1])
    for _ in range(30):
        v = a.T @ (w * (a @ v))
        v /= np.linalg.norm(v) or 1.0
    step = 4.0 / (v @ (a.T @ (w * (a @ v))) + 1e-9)
    b = prev = np.zeros(a.shape[1])
    t = 1.0
    for _ in range(steps):
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        at = b + (t - 1) / t2 * (b - prev)
        new = at - step * (a.T @ (w * (1 / (1 + np.exp(-(a @ at))) - y)))
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - step * penalty, 0)
        prev, b, t = b, new, t2
    return b[:-1], float(b[-1])


def fit_ensemble(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, penalty: float = PENALTY, seed: int = SEED) -> RuleEnsemble:
    """A rule ensemble from statistics (rows of ``STATS``) and labels 0 or 1."""
    y = y.astype(float)
    if not len(y) or y.min() == y.max():
        return RuleEnsemble((), 0.0)
    w = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum()) * len(y)
    rules = _rules(x, y, w, trees, depth, seed)
    if not rules:
        return RuleEnsemble((), 0.0)
    z = np.stack([r.holds(x) for r in rules], axis=1).astype(float)
    weights, intercept = _lasso(z, y, w, penalty)
    return RuleEnsemble(tuple((r, float(b)) for r, b in zip(rules, weights) if abs(b) > 1e-6), intercept)


def fit_quality(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> RuleEnsemble:
    """Fit on documents (doc_id, text) that have a label (doc_id, quality)."""
    known = chosen(labels, "doc_id", "quality").filter("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("__label"))
    taken = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    # rows that repeat id and text teach once, so a hot id cannot fill the driver
    rows = chosen(docs, "doc_id", "text").join(F.broadcast(taken), "doc_id").distinct()
    held = rows.select(F.col("__label"), statistics_column(F.col("text")).alias("s")).select("__label", "s.*").toPandas()
    held = held.sort_values(list(held.columns), kind="stable")  # the fit must not hang on the order of partitions
    return fit_ensemble(held[list(STATS)].to_numpy(float), held["__label"].to_numpy())


def score_quality(docs: DataFrame, ensemble: RuleEnsemble) -> DataFrame:
    """``docs`` with ``score``."""
    rows, places, names, at = apart(docs, ("text",), ("score",))
    stats = rows.select(*places, statistics_column(F.col(at["text"])).alias("stats"))
    return stats.select(*places, ensemble.column(F.col("stats")).alias("made")).toDF(*names, "score")
