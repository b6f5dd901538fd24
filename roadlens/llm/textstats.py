"""Statistics of whole texts, shared by the quality rules (op 7) and the quality classifier (op 10)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from roadlens.llm.words import Block, blocks, keyed, segment_hash

# The symbol characters [#*$%&|<>].
SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[list(b"#*$%&|<>")] = True

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = [
    "log_words", "mean_word_chars", "symbols_per_word", "dup_line_share", "repeat_word_share", "same_as_previous",
    "upper_share", "pipes_per_word", "marks_per_word", "distinct_word_share", "digit_share", "stops_per_word",
    "non_ascii_share", "log_lines",
]


def _lines(b: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lines with a word: per text the number of them, and of those equal to an earlier one; per text all lines."""
    breaks = np.flatnonzero(b.data == 10)
    edges = np.sort(np.concatenate((breaks, b.offsets[1:])), kind="stable")
    owner = np.concatenate((b.docs_at(breaks), np.arange(b.n_docs)))
    owner.sort(kind="stable")
    begin = np.empty(len(edges), dtype=np.int64)
    begin[:1] = 0
    begin[1:] = edges[:-1]
    new_text = np.concatenate(([True], owner[1:] != owner[:-1]))
    begin[~new_text] += 1  # after the line break
    begin[new_text] = b.offsets[owner[new_text]]
    words_before = np.searchsorted(b.start, np.stack((begin, edges)))
    keep = words_before[1] > words_before[0]
    hashes = keyed(segment_hash(b.data, begin[keep], (edges - begin)[keep]), owner[keep])
    _, first = np.unique(hashes, return_index=True)
    n = b.per_doc(owner[keep])
    return n, n - b.per_doc(owner[keep][first]), b.per_doc(owner)


def _repeated(b: Block) -> np.ndarray:
    """Words in 3-word windows that the text has twice or more."""
    first, hashes = b.ngrams(3)
    if not len(first):
        return np.zeros(b.n_docs)
    _, inverse, counts = np.unique(keyed(hashes, b.doc[first]), return_inverse=True, return_counts=True)
    twice = first[counts[inverse.reshape(-1)] > 1]
    covered = np.zeros(len(b.doc), dtype=bool)
    for j in range(3):
        covered[twice + j] = True
    return b.per_doc(b.doc[covered])


def text_counts(b: Block) -> tuple[np.ndarray, np.ndarray]:
    """(the five contract counts as int64, the model's features as float64), a row for each text of the block."""
    n_words = b.per_doc(b.doc)
    continuation = (b.data & 0xC0) == 0x80
    seen = np.concatenate(([0], np.cumsum(continuation, dtype=np.int64)))
    chars = (b.end - b.start) - (seen[b.end] - seen[b.start])
    word_chars = b.per_doc(b.doc, chars)
    n_symbols = b.per_doc(b.docs_at(np.flatnonzero(SYMBOLS[b.data])))
    n_lines, dup_lines, all_lines = _lines(b)
    repeated = _repeated(b)
    counts = np.stack((n_words, word_chars, n_symbols, dup_lines, repeated), axis=1)

    words = np.maximum(n_words, 1)
    size = np.maximum(np.diff(b.offsets), 1)
    same = np.zeros(len(b.doc), dtype=bool)
    same[1:] = (b.hash[1:] == b.hash[:-1]) & (b.doc[1:] == b.doc[:-1])
    _, first = np.unique(keyed(b.hash, b.doc), return_index=True)
    last = b.data[b.end - 1]
    at = lambda mask: b.per_doc(b.docs_at(np.flatnonzero(mask)))
    features = np.stack((
        np.log1p(n_words),
        word_chars / words,
        n_symbols / words,
        dup_lines / np.maximum(n_lines, 1),
        repeated / words,
        b.per_doc(b.doc[same]) / words,
        b.count_bytes((b.data >= 65) & (b.data <= 90)) / size,
        at(b.data == 124) / words,
        at(b.data == 33) / words,
        b.per_doc(b.doc[first]) / words,
        at((b.data >= 48) & (b.data <= 57)) / size,
        b.per_doc(b.doc[(last == 46) | (last == 44)]) / words,
        b.count_bytes(b.data >= 128) / size,
        np.log1p(all_lines),
    ), axis=1)
    return np.rint(counts).astype(np.int64), features


def column_stats(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """:func:`text_counts` of a whole Arrow column; null texts count as empty."""
    parts = [text_counts(b) for b in blocks(text)]
    if not parts:
        return np.zeros((0, len(COUNTS)), dtype=np.int64), np.zeros((0, len(FEATURES)))
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
