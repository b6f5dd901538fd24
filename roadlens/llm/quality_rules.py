"""Operator 7, quality rules: gradient-boosted trees over document statistics.

The trees are grown on a bounded labelled sample (its statistics, not its texts, come to the driver), are
flattened into numpy node arrays, and score every text inside its Arrow batch.  Chosen statistics are
constrained: more symbols, repeated words or capitals can never raise a document's score.

Defined results: a null or empty text has no words, so it fails the base rules; null ids are scored like
others; a column that is called like a result column is replaced; without labels of both classes the base
rules alone decide.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from roadlens.llm.common import SAMPLE_ROWS, append_columns, labelled_sample
from roadlens.llm.textstats import COUNTS, FEATURES, column_stats

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: A document stays if its probability of good quality is at least this.
KEEP_FROM = 0.5
#: -1: the score must not rise with the statistic.
MONOTONE = {"symbols_per_word": -1, "dup_line_share": -1, "repeat_word_share": -1, "same_as_previous": -1,
            "upper_share": -1, "marks_per_word": -1, "pipes_per_word": -1}

SCHEMA = T.StructType(
    [T.StructField(c, T.LongType()) for c in COUNTS]
    + [T.StructField("base_failed", T.BooleanType()), T.StructField("score", T.DoubleType()),
       T.StructField("kept", T.BooleanType())]
)


@dataclass
class Trees:
    """Boosted trees as flat arrays; a leaf points to itself, so every row takes ``depth`` steps."""

    bias: float
    depth: int
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        rows = np.arange(len(x))
        total = np.full(len(x), self.bias)
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                goes_left = x[rows, self.feature[node]] <= self.threshold[node]
                node = np.where(goes_left, self.left[node], self.right[node])
            total += self.value[node]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


@dataclass
class _Node:
    rows: np.ndarray
    low: float
    high: float
    depth: int


def fit_trees(x: np.ndarray, y: np.ndarray, signs: np.ndarray, n_trees: int = 40, depth: int = 3,
              rate: float = 0.2, bins: int = 32, ridge: float = 1.0, least: float = 5.0) -> Trees:
    """Newton boosting of log loss on binned features.

    ``signs[f]`` is -1, 0 or 1.  A split on a constrained feature is taken only if the two leaf values are
    in order, and the halves are then bounded by their mean, so the order holds for whole subtrees.
    """
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    margin = np.full(len(y), np.log(mean / (1 - mean)))
    feature, threshold, left, right, value, roots = [], [], [], [], [], []
    for _ in range(n_trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = y - p, np.maximum(p * (1 - p), 1e-6)

        def leaf(g: float, h: float, node: _Node) -> float:
            return float(np.clip(g / (h + ridge), node.low, node.high))

        def best_split(node: _Node):
            g, h = grad[node.rows], hess[node.rows]
            total_g, total_h = g.sum(), h.sum()
            whole = leaf(total_g, total_h, node)
            gain_of = lambda v, a, b: v * a - 0.5 * v * v * (b + ridge)
            best = (1e-6, None, None, 0.0, 0.0)
            for f, c in enumerate(cuts):
                if not len(c):
                    continue
                b = binned[node.rows, f]
                lg = np.cumsum(np.bincount(b, g, len(c) + 1))[:-1]
                lh = np.cumsum(np.bincount(b, h, len(c) + 1))[:-1]
                ln = np.cumsum(np.bincount(b, minlength=len(c) + 1))[:-1]
                rg, rh = total_g - lg, total_h - lh
                lv = np.clip(lg / (lh + ridge), node.low, node.high)
                rv = np.clip(rg / (rh + ridge), node.low, node.high)
                gain = gain_of(lv, lg, lh) + gain_of(rv, rg, rh) - gain_of(whole, total_g, total_h)
                legal = (ln >= least) & (len(b) - ln >= least)
                if signs[f]:
                    legal &= (rv - lv) * signs[f] >= 0
                gain = np.where(legal, gain, -np.inf)
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (float(gain[k]), f, k, float(lv[k]), float(rv[k]))
            return best

        def grow(node: _Node) -> int:
            at = len(value)
            feature.append(0), threshold.append(0.0), left.append(at), right.append(at)
            value.append(rate * leaf(grad[node.rows].sum(), hess[node.rows].sum(), node))
            _, f, k, lv, rv = best_split(node) if node.depth < depth else (0, None, None, 0, 0)
            if f is None:
                margin[node.rows] += value[at]
                return at
            goes_left = binned[node.rows, f] <= k
            middle = (lv + rv) / 2
            low = [node.low, node.low]
            high = [node.high, node.high]
            if signs[f] > 0:
                high[0], low[1] = middle, middle
            elif signs[f] < 0:
                low[0], high[1] = middle, middle
            feature[at], threshold[at] = f, float(cuts[f][k])
            left[at] = grow(_Node(node.rows[goes_left], low[0], high[0], node.depth + 1))
            right[at] = grow(_Node(node.rows[~goes_left], low[1], high[1], node.depth + 1))
            return at

        roots.append(grow(_Node(np.arange(len(y)), -4.0, 4.0, 0)))
    return Trees(float(np.log(mean / (1 - mean))), depth, np.array(roots, dtype=np.int64),
                 np.array(feature, dtype=np.int64), np.array(threshold), np.array(left), np.array(right),
                 np.array(value))


def fit_rules(docs: DataFrame, labels: DataFrame, label: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Trees | None:
    """Trees fitted on at most ``sample_rows`` labelled documents; None if they do not show both classes."""
    schema = T.StructType([T.StructField("features", T.ArrayType(T.DoubleType()))])

    def compute(text: pa.Array) -> list[pa.Array]:
        return [pa.array(list(column_stats(text)[1]), type=pa.list_(pa.float64()))]

    # At most sample_rows short rows of numbers; sorted, so the fit does not depend on arrival order.
    rows = append_columns(labelled_sample(docs, labels, label, sample_rows), "text", schema, compute,
                          ["doc_id", "label"]).orderBy("doc_id", "label").collect()
    y = np.array([r["label"] for r in rows], dtype=float)
    if len(np.unique(y)) < 2:
        return None
    signs = np.array([MONOTONE.get(f, 0) for f in FEATURES])
    return fit_trees(np.array([r["features"] for r in rows]), y, signs)


def apply_rules(docs: DataFrame, trees: Trees | None, text_col: str = "text", carry: list[str] | None = None,
                keep_from: float = KEEP_FROM) -> DataFrame:
    """``docs`` with the five counts, ``base_failed``, ``score`` (probability of good quality) and ``kept``."""

    def compute(text: pa.Array) -> list[pa.Array]:
        counts, features = column_stats(text)
        n_words, repeated = counts[:, 0], counts[:, 4]
        failed = (n_words < MIN_WORDS) | (100 * repeated > MAX_REPEAT_PERCENT * n_words)
        score = trees.probability(features) if trees is not None else np.ones(len(counts))
        return [pa.array(counts[:, i]) for i in range(len(COUNTS))] + [
            pa.array(failed), pa.array(score), pa.array(~failed & (score >= keep_from))]

    return append_columns(docs, text_col, SCHEMA, compute, carry)


def quality_rules(docs: DataFrame, labels: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Fit on the labels that are not held out, then judge every document."""
    return apply_rules(docs, fit_rules(docs, labels), carry=carry)
