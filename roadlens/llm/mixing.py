"""Operator 9, mixing sources to target weights: iterative proportional fitting, then calibrated sampling.

1. Each document has a source, a language, a topic and a number of tokens.  Values without a target of their
   own fall under ``other``, so there are at most (targets + 1) cells along each margin.
2. Tokens are added up by cell, in Spark.  The cells, whose number the targets bound, are raked on the driver:
   source, language and topic weights are scaled in turn until all margins match.
3. A cell's documents are kept with the probability of its weight against its tokens, times one factor for
   all, at most 1.  The factor is the largest that misses no more than SHORTFALL of the weight in cells that
   hold too few tokens, so the sample is as large as its targets allow.
4. A document is kept if a hash of its id (and text) lies below its cell's probability: the same in every run,
   and decided row by row without a shuffle.

Topics are learnt from the texts (:mod:`roadlens.llm.topics`) or told by a rule.  Targets are an argument; by default they
are the shares of the table itself with their differences damped (:func:`balanced`).

Margins whose targets no present value has are left as they are; targets of absent values are shared among
the present ones in proportion.  Margins that raking cannot meet together give a :class:`MarginsMissed` warning.

Defined results: a null source or language is ``other``; null and empty texts have no tokens and the topic
``prose`` (``none`` among learnt ones), and are decided by their cell (kept in one without tokens); a column that is called like a result column is replaced; a table
without tokens keeps all its rows with weight 1.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlens.llm.common import append_columns, stage
from roadlens.llm.topics import Topics

OTHER = "other"
#: Share of the target weight that may be missed where a cell holds too few tokens.
SHORTFALL = 0.02


@dataclass
class Targets:
    """Wanted shares of the tokens by value, for each margin."""

    source: dict[str, float] = field(default_factory=dict)
    lang: dict[str, float] = field(default_factory=dict)
    topic: dict[str, float] = field(default_factory=dict)


class MarginsMissed(UserWarning):
    """The raked weights do not meet all margins."""


#: Values of a margin that get a target of their own by default, and how far shares are evened out (1: not at all).
MOST_VALUES, DAMPING = 200, 0.8
#: Distance from a margin's target that is not worth a warning.
CLOSE = 0.005


def topic_of(text: Column) -> Column:
    """``notice``: licence and copyright lines; ``contact``: addresses and credentials; else ``prose``."""
    low = F.lower(F.coalesce(text, F.lit("")))
    notice = low.contains("licensed under") | low.contains("copyright") | low.contains("all rights reserved")
    contact = low.contains("@") | low.contains("password") | low.contains("http")
    return F.when(notice, "notice").when(contact, "contact").otherwise("prose")


def rake(tokens: np.ndarray, margins: list[np.ndarray], targets: list[np.ndarray], steps: int = 200,
         close: float = 1e-9) -> np.ndarray:
    """Weights w (summing to one) near ``tokens``: for each margin m and value v, w summed where m is v meets its target.

    ``margins[m]`` numbers the value of each cell, ``targets[m]`` holds the share of each value.
    """
    w = tokens / max(tokens.sum(), 1e-300)
    for _ in range(steps):
        worst = 0.0
        for values, wanted in zip(margins, targets, strict=True):
            has = np.bincount(values, w, len(wanted))
            present = has > 0
            goal = np.where(present, wanted, 0)
            if goal.sum() <= 0:
                continue
            goal = goal / goal.sum()
            factor = np.where(present, goal / np.where(present, has, 1), 0)
            worst = max(worst, float(np.abs(has - goal).max()))
            w = w * factor[values]
        if worst < close:
            break
    missed = margin_gap(w, margins, targets)
    if missed > CLOSE:
        warnings.warn(f"a margin is missed by {missed:.4f} of the weight", MarginsMissed, stacklevel=2)
    return w


def margin_gap(w: np.ndarray, margins: list[np.ndarray], targets: list[np.ndarray]) -> float:
    """The largest distance of a margin's value from its target (those of absent values shared among the present ones)."""
    worst = 0.0
    for values, wanted in zip(margins, targets, strict=True):
        present = np.bincount(values, w > 0, len(wanted)) > 0
        goal = np.where(present, wanted, 0)
        if goal.sum() > 0 and w.sum() > 0:
            worst = max(worst, float(np.abs(np.bincount(values, w, len(wanted)) / w.sum() - goal / goal.sum()).max()))
    return worst


def calibrate(tokens: np.ndarray, w: np.ndarray, shortfall: float) -> np.ndarray:
    """Probabilities min(1, f * w / tokens) with the largest f that misses at most ``shortfall`` of the weight.

    Where f asks for more tokens than a cell has, all are kept and the rest is missed.  With ``shortfall`` 0 the
    expected shares are the raked ones exactly, and the scarcest cell sets the size of the sample.
    """
    ratio = np.divide(w, tokens, out=np.zeros_like(w), where=tokens > 0)
    if not (ratio > 0).any():
        return np.ones_like(w)
    missed = lambda f: (np.maximum(f * w - tokens, 0).sum() / (f * w.sum()))
    low, high = 1 / ratio.max(), 1 / ratio[ratio > 0].min()
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if missed(middle) <= shortfall else (low, middle)
    return np.minimum(1, low * ratio)


def _with_topic(docs: DataFrame, topics: Topics | None) -> DataFrame:
    """``docs`` with ``topic`` and ``n_tokens``, by learnt topics or else by :func:`topic_of`."""
    if topics is None:
        text = F.col("text").cast("string")
        return docs.withColumns({
            "topic": topic_of(text),
            "n_tokens": F.coalesce(F.regexp_count(text, F.lit(r"[^ \t-\r]+")), F.lit(0)).cast("long")})

    def compute(text: pa.Array) -> list[pa.Array]:
        words, topic = topics.of(text)
        return [pa.array(topic, pa.string()), pa.array(words)]

    schema = T.StructType([T.StructField("topic", T.StringType()), T.StructField("n_tokens", T.LongType())])
    return append_columns(docs, "text", schema, compute)


def balanced(totals: DataFrame, damping: float = DAMPING, most: int = MOST_VALUES) -> Targets:
    """Targets from a table of ``source``, ``lang``, ``topic`` and ``n_tokens``: each value's share of the tokens to the power ``damping``.

    Only the ``most`` largest values of a margin get a target.
    """
    out = Targets()
    for margin in ("source", "lang", "topic"):
        rows = (totals.where(F.col(margin).isNotNull() & (F.col("n_tokens") > 0)).groupBy(margin)
                .agg(F.sum("n_tokens").alias("n")).orderBy(F.desc("n"), margin).limit(most).collect())
        getattr(out, margin).update({r[margin]: float(r["n"]) ** damping for r in rows})
    return out


def mix_documents(docs: DataFrame, targets: Targets | None = None, shortfall: float = SHORTFALL,
                  carry: list[str] | None = None, topics: Topics | None = None) -> DataFrame:
    """``docs`` with ``topic``, ``n_tokens``, ``weight`` (wanted tokens against those there), ``probability``, ``kept``."""
    new = ["topic", "n_tokens", "weight", "probability", "kept"]
    own = [c for c in (docs.columns if carry is None else carry) if c not in new]
    values = [F.col(m).cast("string").alias(m) for m in ("source", "lang", "topic")]
    totals = stage(_with_topic(docs.select("text", "source", "lang"), topics).groupBy(*values)
                   .agg(F.sum("n_tokens").alias("n_tokens")), "op9-totals")
    if targets is None:
        targets = balanced(totals)
    named = {"source": targets.source, "lang": targets.lang, "topic": targets.topic}
    keys = [f"__{m}" for m in named]

    def with_cells(df: DataFrame) -> DataFrame:
        return df.withColumns({
            f"__{m}": F.when(F.col(m).isin(*wanted), F.col(m).cast("string")).otherwise(F.lit(OTHER))
            if wanted else F.lit(OTHER) for m, wanted in named.items()})

    marked = with_cells(_with_topic(docs, topics))
    # At most (targets + 1) values along each margin, so a bounded number of cells.
    cells = with_cells(totals).groupBy(*keys).agg(F.sum("n_tokens").alias("tokens")).orderBy(*keys).collect()
    tokens = np.array([r["tokens"] for r in cells], dtype=float)
    margins, wanted = [], []
    for m, shares in named.items():
        names = sorted(shares) + [OTHER] * (OTHER not in shares)
        margins.append(np.array([names.index(r[f"__{m}"]) for r in cells], dtype=np.int64))
        rest = sum(t for t, r in zip(tokens, cells, strict=True) if r[f"__{m}"] == OTHER and OTHER not in shares)
        scale = max(sum(shares.values()), 1e-300)
        other = rest / max(tokens.sum(), 1.0)  # what has no target keeps its share
        wanted.append(np.array([shares[v] / scale * (1 - other) if v in shares else other for v in names]))
    if tokens.sum() > 0:
        w = rake(tokens, margins, wanted)
        p = calibrate(tokens, w, shortfall)
        weight = np.divide(w * tokens.sum(), tokens, out=np.ones_like(w), where=tokens > 0)
        p = np.where(tokens > 0, p, 1.0)
    else:
        weight = p = np.ones(len(cells))
    table = docs.sparkSession.createDataFrame(
        [(*[r[k] for k in keys], float(x), float(y)) for r, x, y in zip(cells, weight, p, strict=True)],
        ", ".join(f"{k} string" for k in keys) + ", weight double, probability double")
    # 52 bits of a hash as a number from 0 to 1
    draw = F.pmod(F.xxhash64(F.lit("mixing"), "doc_id", "text"), F.lit(1 << 52)) / float(1 << 52)
    return (
        marked.drop("weight", "probability", "kept").join(F.broadcast(table), keys)
        .withColumn("kept", draw < F.col("probability")).select(*own, *new))
