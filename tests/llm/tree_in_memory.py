"""The suffix tree of operator 5 in memory, for small corpora: the tests hold the operator's tables against it."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.llm.suffix_tree import DISCOUNT, DIVERGENCE, END, LEAST
from roadlens.llm.words import Block, blocks, distinct

#: Words have numbers below 2**21, so a context's number and a follower fit in 63 bits.
_WIDTH = 1 << 21
DEPTH = 2


def count_tokens(training: DataFrame) -> DataFrame:
    """(token, c): a token's hash and how often it occurs; the end of a text is one."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = list(blocks(batch.column(0), lower=True))
            values, first, inverse = distinct(np.concatenate([b.hash for b in parts]) if parts else np.zeros(0, np.uint64))
            tokens = np.append(values.view(np.int64), END)
            counts = np.append(np.bincount(inverse, minlength=len(values)), batch.num_rows)
            yield pa.RecordBatch.from_arrays([pa.array(tokens), pa.array(counts.astype(np.int64))], names=["token", "c"])

    found = training.select("text").mapInArrow(partial, "token long, c long")
    return found.groupBy("token").agg(F.sum("c").alias("c"))


@dataclass
class Level:
    """Contexts of one length: numbers (sorted), retained or not, log10 of their back-off, and their followers."""

    contexts: np.ndarray
    back_off: np.ndarray
    #: context index * _WIDTH + follower, sorted, and log10 of the follower's probability there
    entries: np.ndarray
    log_p: np.ndarray


@dataclass
class Tree:
    """Frequent words by hash with their root log10 probability, and a level for each context length."""

    hashes: np.ndarray
    root: np.ndarray
    end: int
    levels: list[Level]


def _find(values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Index of each wanted number in the sorted values, -1 where it is not there."""
    if not len(values):
        return np.full(len(wanted), -1, dtype=np.int64)
    at = np.minimum(np.searchsorted(values, wanted), len(values) - 1)
    return np.where(values[at] == wanted, at, -1)


def walk(b: Block, tree: Tree) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token number or -1, text, hash) of all tokens of a block, the end after each text's words."""
    values, _, inverse = distinct(b.hash)
    number = _find(tree.hashes, values)[inverse] if len(values) else np.zeros(0, dtype=np.int64)
    ends = np.searchsorted(b.doc, np.arange(b.n_docs), side="right")
    return np.insert(number, ends, tree.end), np.insert(b.doc, ends, np.arange(b.n_docs)), np.insert(b.hash, ends, 0)


def _states(number: np.ndarray, doc: np.ndarray, tree: Tree) -> list[np.ndarray]:
    """For each length the index of the context before each token in its level; -1: not among its contexts.

    The beginning of a text is written as the number of the end, which can stand in no other place.
    """
    n = len(number)
    before = np.full(n, -1, dtype=np.int64)
    before[1:] = number[:-1]
    first = np.ones(n, dtype=bool)
    first[1:] = doc[1:] != doc[:-1]
    before[first] = tree.end
    out: list[np.ndarray] = []
    longer = before
    for depth, level in enumerate(tree.levels):
        if depth == 0:
            state = np.where(before >= 0, _find(level.contexts, before), -1)
        else:
            # a context of this length: one shorter that ended a token ago, then the token before
            shorter = np.full(n, -1, dtype=np.int64)
            shorter[1:] = longer[:-1]
            shorter[first] = -1
            state = np.full(n, -1, dtype=np.int64)
            some = np.flatnonzero((shorter >= 0) & (before >= 0))
            state[some] = _find(level.contexts, shorter[some] * _WIDTH + before[some])
        out.append(state)
        longer = state
    return out


def _count_followers(training: DataFrame, tree: Tree, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(key, n): how often a token follows each context of the deepest level, key = context index * _WIDTH + token."""
    keys = [np.zeros(0, dtype=np.int64)]
    for b in blocks(pa.array([r["text"] for r in training.select("text").collect()], pa.string()), lower=True):
        number, doc, _ = walk(b, tree)
        state = _states(number, doc, tree)[-1]
        some = (state >= 0) & (number >= 0)
        keys.append(state[some] * _WIDTH + number[some])
    values, n = np.unique(np.concatenate(keys), return_counts=True)
    return values[n >= least], n[n >= least].astype(np.int64)


def _parent_log_p(tree: Tree, depth: int, suffix: np.ndarray, token: np.ndarray) -> np.ndarray:
    """log10 probability of tokens after a context of the given length, by its index (-1: the root only)."""
    if depth < 0:
        return tree.root[token]
    level = tree.levels[depth]
    at = np.where(suffix >= 0, _find(level.entries, suffix * _WIDTH + token), -1)
    # the suffix of a context of length one is the root
    shorter = _suffix(tree, depth, suffix)
    lower = _parent_log_p(tree, depth - 1, shorter, token)
    out = np.where(suffix >= 0, level.back_off[suffix], 0.0) + lower
    return np.where(at >= 0, level.log_p[at], out) if len(level.log_p) else out


def _suffix(tree: Tree, depth: int, context: np.ndarray) -> np.ndarray:
    """Index, one level up, of each context without its first token."""
    if depth == 0:
        return np.full(len(context), -1, dtype=np.int64)
    contexts = tree.levels[depth].contexts
    last = contexts[context] % _WIDTH
    if depth == 1:
        return np.where(context >= 0, _find(tree.levels[0].contexts, last), -1)
    first = _suffix(tree, depth - 1, contexts[context] // _WIDTH)
    return np.where((context >= 0) & (first >= 0), _find(tree.levels[depth - 1].contexts, first * _WIDTH + last), -1)


def _fill(tree: Tree, keys: np.ndarray, counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Give the deepest level its followers and back-off; returns the divergence of each context from its suffix.

    ``totals`` are the occurrences of the contexts.
    """
    level = tree.levels[-1]
    depth = len(tree.levels) - 1
    order = np.argsort(keys)
    level.entries, counts = keys[order], counts[order].astype(float)
    context, token = level.entries // _WIDTH, level.entries % _WIDTH
    p = (counts - DISCOUNT) / totals[context]
    suffix = _suffix(tree, depth, context)
    parent = 10 ** _parent_log_p(tree, depth - 1, suffix, token)
    n = len(level.contexts)
    left = 1 - np.bincount(context, p, n)
    parent_left = np.maximum(1 - np.bincount(context, parent, n), 1e-9)
    left = np.maximum(left, 1e-9)
    level.log_p = np.log10(p)
    level.back_off = np.log10(left / parent_left)
    diverging = np.bincount(context, p * np.log(p / parent), n) + left * np.log(left / parent_left)
    return diverging


def _keep(level: Level, keep: np.ndarray) -> Level:
    """The level without followers and back-off at contexts that are not retained: those act as their suffix."""
    kept = keep[level.entries // _WIDTH]
    return Level(level.contexts, np.where(keep, level.back_off, 0.0), level.entries[kept], level.log_p[kept])


def fit_tree(training: DataFrame, counts: DataFrame, total: int, vocabulary: int, depth: int = DEPTH) -> Tree:
    """The tree of the training texts in memory, for small corpora."""
    words = counts.where((F.col("c") >= LEAST) & (F.col("token") != F.lit(int(END)))).toArrow()
    hashes = words.column("token").to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    hashes, c = hashes[order], words.column("c").to_numpy()[order]
    n_end = counts.where(F.col("token") == F.lit(int(END))).agg(F.sum("c")).first()[0] or 0
    every = np.append(c, n_end).astype(float)
    root = np.log10((every + 0.5) / (total + 0.5 * (vocabulary + 1)))
    tree = Tree(hashes, root, len(hashes), [])
    contexts, totals = np.flatnonzero(every >= LEAST), every[every >= LEAST]
    keep: list[np.ndarray] = []
    for _ in range(depth):
        if not len(contexts):
            break
        none = np.zeros(0)
        tree.levels.append(Level(contexts, np.zeros(len(contexts)), np.zeros(0, dtype=np.int64), none))
        keys, n = _count_followers(training, tree, LEAST)
        keep.append(_fill(tree, keys, n, totals) >= DIVERGENCE)
        entries = tree.levels[-1].entries
        order = np.argsort(keys)
        n = n[order]
        longer = (n >= LEAST) & (entries % _WIDTH != tree.end)  # a context's number: its shorter one, then its last token
        contexts, totals = entries[longer], n[longer].astype(float)
    # a retained context keeps its suffixes
    for level in range(len(tree.levels) - 1, 0, -1):
        suffix = _suffix(tree, level, np.flatnonzero(keep[level]))
        keep[level - 1][suffix[suffix >= 0]] = True
    tree.levels = [_keep(level, k) for level, k in zip(tree.levels, keep, strict=True)]
    return tree


def log_probability(number: np.ndarray, doc: np.ndarray, tree: Tree) -> tuple[np.ndarray, np.ndarray]:
    """(log10 probability by the tree, by the root) of each token; rare tokens get the part that is not the root's."""
    root = np.where(number >= 0, tree.root[number], 0.0)
    score = root.copy()
    for level, state in zip(tree.levels, _states(number, doc, tree), strict=True):
        at = np.full(len(number), -1, dtype=np.int64)
        some = np.flatnonzero((state >= 0) & (number >= 0))
        at[some] = _find(level.entries, state[some] * _WIDTH + number[some])
        score = np.where(state >= 0, score + level.back_off[state] if len(level.back_off) else score, score)
        if len(level.log_p):
            score = np.where(at >= 0, level.log_p[at], score)
    return score, root
