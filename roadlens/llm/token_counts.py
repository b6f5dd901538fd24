"""Operator 3, token counts: a Viterbi pass that counts pieces and builds none.

The vocabulary is a unigram model: pieces with scores, taken from a public SentencePiece file.  A text is cut
at each space, which belongs to the word after it; so is the text's beginning.  An Aho-Corasick automaton
of all pieces lists every piece that ends at each character of a word, and a dynamic program carries the
best score and the number of pieces on that path.  Ties go as in the public tokenizer: of equal paths to a
place, that whose last piece began first.  A character that is no piece costs the lowest score less ten;
neighbouring ones are one unknown, which counts as its UTF-8 bytes (or as one piece if the vocabulary lacks
them).  Words repeat, so each distinct word is counted once by a task and remembered.

No shuffle; each text costs its length.

Defined results: null and empty texts have no tokens; null ids are counted like others; a column that is
called like a result column is replaced.
"""

from __future__ import annotations

from functools import cache

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from sentencepiece import SentencePieceProcessor

from roadlens.llm.common import append_columns
from roadlens.llm.words import LOOK_UP_BYTES, Memory, distinct, segment_hash
from roadlens.llm.words import blocks as text_blocks

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
#: Written for a space in the vocabulary.
SPACE = "▁"
UNKNOWN_PENALTY = 10.0


def read_vocabulary(path: str) -> list[tuple[str, float]]:
    """(piece, score) of a SentencePiece file in the order of the ids."""
    model = SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class PieceCounter:
    """Counts the pieces of one word at a time."""

    def __init__(self, vocabulary: list[tuple[str, float]]) -> None:
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        pieces = {p for p, _ in vocabulary}
        self.by_bytes = all(f"<0x{i:02X}>" in pieces for i in range(256))
        self.unknown = min((s for _, s in vocabulary), default=0.0) - UNKNOWN_PENALTY
        self.memory = Memory(1)

    def count(self, word: str) -> int:
        """Pieces of the best path through a word (the space before it written as SPACE).

        The automaton lists matches by their end and, for one end, longest first: the earliest beginning first.
        """
        n = len(word)
        best, pieces = [0.0] * (n + 1), [0] * (n + 1)
        run = [0] * (n + 1)  # characters of the unknown that ends here
        unknown, by_bytes = self.unknown, self.by_bytes

        def without_piece(end: int) -> None:
            best[end] = best[end - 1] + unknown
            if by_bytes:
                pieces[end] = pieces[end - 1] + len(word[end - 1].encode("utf-8", "surrogatepass"))
            else:
                pieces[end] = pieces[end - 1] + (run[end - 1] == 0)
                run[end] = run[end - 1] + 1

        at, single = 0, True
        for end, (size, score) in self.automaton.iter(word):
            end += 1
            if end != at:
                if not single and best[at - 1] + unknown > best[at]:
                    without_piece(at)
                while at < end - 1:
                    at += 1
                    without_piece(at)
                at, top, single = end, None, False
            candidate = best[end - size] + score
            if top is None or candidate > top:
                top = best[end] = candidate
                pieces[end] = pieces[end - size] + 1
            if size == 1:
                single = True
        if not single and best[at - 1] + unknown > best[at]:
            without_piece(at)
        while at < n:
            at += 1
            without_piece(at)
        return pieces[n]

    def count_texts(self, text: pa.Array) -> np.ndarray:
        out = []
        for b in text_blocks(text, size=LOOK_UP_BYTES):
            # A word begins at each space and at the text's beginning (unless a space stands there).
            spaces = np.flatnonzero(b.data == 0x20)
            full = np.flatnonzero(np.diff(b.offsets))
            heads = b.offsets[full]
            heads = heads[b.data[heads] != 0x20]
            start = np.sort(np.concatenate((spaces, heads)))
            end = np.append(start[1:], len(b.data))
            # keyed by the bytes after the space: " word" and "word" at a beginning are the same word
            begin = start + (b.data[start] == 0x20)
            values, first, inverse = distinct(segment_hash(b.data, begin, end - begin))
            raw = b.data.tobytes()
            counted = self.memory.look_up(values, lambda i: (
                self.count(SPACE + raw[begin[first[i]]:end[first[i]]].decode("utf-8", "replace")),))
            out.append(b.per_doc(b.docs_at(start), counted[inverse, 0]).astype(np.int64))
        return np.concatenate(out) if out else np.zeros(0, dtype=np.int64)


@cache
def counter(path: str) -> PieceCounter:
    """One counter for each Python worker, which Spark uses for several tasks."""
    return PieceCounter(read_vocabulary(path))


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY, text_col: str = "text",
                 carry: list[str] | None = None) -> DataFrame:
    """``docs`` with ``n_tokens``."""
    schema = T.StructType([T.StructField("n_tokens", T.LongType())])
    return append_columns(docs, text_col, schema, lambda text: [pa.array(counter(vocabulary).count_texts(text))], carry)
