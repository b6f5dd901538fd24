"""Operator 8, cost-balanced packing of token sequences.

Each text becomes token ids: the ids of a public tokenizer, then one end id.  Long documents are cut into
full sequences; what remains is packed so that the estimated cost of the sequences (linear in the tokens
plus quadratic attention within each piece) is even: pieces in descending length go to the open sequence of
the lowest cost that has room.  Pieces that fit nowhere whole are cut to fill the holes.  The tokens that
fill no sequence wait for the next window of documents; the last of a partition are laid out in sequences
whose lengths are powers of two, which need no padding.

Packing works within a partition, window by window, in bounded memory: no shuffle, and a lost executor
costs its partitions only.  Sequence ids hold the partition, so they never clash.  A partition must keep
its rows when a task is repeated, so read ``docs`` from files or a checkpoint.

The tokenizer lowers case and cuts at white space, so the ids of a text are those of its words between ASCII
white space, one after another, and capital letters need not be told apart (but for its two special strings,
which hold no white space).  Distinct words are encoded once by a task and remembered.

Defined results: null and empty texts are the end id alone; rows that share an id are packed each for
itself; extra columns are left out.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache
from itertools import chain
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from roadlens.llm.words import LOOK_UP_BYTES, Block, blocks, distinct

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
END_ID = 1
CAPACITY = 2048
#: Tokens that are packed together.
WINDOW_TOKENS = 1_500_000
#: Cost of a piece of n tokens: LINEAR * n + QUADRATIC * n * n.
LINEAR, QUADRATIC = 1.0, 1 / 1024
#: Distinct words that a task remembers.
REMEMBER = 1_000_000

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "ids binary")


def _byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: printable ones as they are, the rest from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(i) if i in printable else chr(next(others)) for i in range(256)]


_LETTERS = _byte_letters()


class WordIds:
    """Token ids of words by hash, in growing flat arrays; forgets everything when it holds ``remember`` words."""

    def __init__(self, path: str, remember: int = REMEMBER) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.stops = {c: self.tokenizer.encode(c, add_special_tokens=False).ids for c in ".,"}
        self.remember = remember
        self._forget()

    def _forget(self) -> None:
        self.hashes = np.zeros(0, dtype=np.uint64)
        self.begin = np.zeros(0, dtype=np.int32)
        self.length = np.zeros(0, dtype=np.int32)
        self.ids = np.zeros(0, dtype=np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32)

    def encode(self, word: str) -> list[int]:
        """Ids of a word.  Plain lower-case letters are one piece of the tokenizer's pattern, a stop after them another."""
        core, stop = (word[:-1], self.stops[word[-1]]) if word[-1] in ".," else (word, [])
        if core.isascii() and core.isalpha() and core.islower():
            return [t.id for t in self.model.tokenize(core)] + stop
        if core.isalpha() and core.islower() and core.lower() == core and is_normalized("NFC", core):
            return [t.id for t in self.model.tokenize("".join([_LETTERS[x] for x in core.encode()]))] + stop
        return self.tokenizer.encode(word, add_special_tokens=False).ids

    def look_up(self, b: Block) -> tuple[np.ndarray, np.ndarray]:
        """(begin, length) in ``ids`` of each word of the block."""
        hashes, first, inverse = distinct(b.hash)
        if len(self.hashes) + len(hashes) > self.remember:
            self._forget()
        at = np.searchsorted(self.hashes, hashes)
        known = np.zeros(len(hashes), dtype=bool)
        inside = at < len(self.hashes)
        known[inside] = self.hashes[at[inside]] == hashes[inside]
        new = np.flatnonzero(~known)
        if len(new):
            new = new[np.argsort(hashes[new])]
            found = [self.encode(b.word(i).decode("utf-8", "replace")) for i in first[new].tolist()]
            length = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
            begin = len(self.ids) + np.cumsum(length) - length
            self.ids = np.concatenate((self.ids, np.fromiter(chain.from_iterable(found), self.ids.dtype, int(length.sum()))))
            at = np.searchsorted(self.hashes, hashes[new])
            self.hashes = np.insert(self.hashes, at, hashes[new])
            self.begin = np.insert(self.begin, at, begin)
            self.length = np.insert(self.length, at, length)
        at = np.searchsorted(self.hashes, hashes)
        return self.begin[at][inverse], self.length[at][inverse]


@cache
def word_ids(path: str) -> WordIds:
    """One memory for each Python worker, which Spark uses for several tasks."""
    return WordIds(path)


def token_ids(b: Block, memory: WordIds) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts of the block one after another, each with its end id; bounds of the texts in them)."""
    begin, length = memory.look_up(b)
    # The end id is one more item after the words of each text.
    ends = np.searchsorted(b.doc, np.arange(b.n_docs), side="right")
    lengths = np.insert(length, ends, 1)
    begins = np.insert(begin, ends, len(memory.ids))
    pool = np.append(memory.ids, memory.ids.dtype.type(END_ID))
    total = np.cumsum(lengths)
    ids = pool[np.arange(total[-1]) + np.repeat(begins - (total - lengths), lengths)]
    last = ends + np.arange(b.n_docs)
    return ids, np.concatenate(([0], total[last]))


def texts_of(text: pa.Array) -> Iterator[Block]:
    """Blocks of lower-cased texts; as they are where one may hold a special string, whose case counts."""
    special = pc.any(pc.match_substring(text.cast(pa.large_string()), "<|")).as_py()
    return blocks(text, lower=not special, size=LOOK_UP_BYTES)


def plan(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[list[list[tuple[int, int, int]]], list[tuple[int, int, int]]]:
    """Full sequences, as lists of pieces (item, start, length), and the pieces that fill none.

    ``lengths`` are of the waiting items.  The pieces left over have less than ``capacity`` tokens in all.
    """
    sequences: list[list[tuple[int, int, int]]] = []
    rest: list[tuple[int, int, int]] = []
    for item, n in enumerate(lengths.tolist()):
        whole = n // capacity
        sequences += [[(item, k * capacity, capacity)] for k in range(whole)]
        if n % capacity:
            rest.append((item, whole * capacity, n % capacity))
    rest.sort(key=lambda p: -p[2])
    n_open = sum(p[2] for p in rest) // capacity
    opened: list[list[tuple[int, int, int]]] = [[] for _ in range(n_open)]
    room, cost = np.full(n_open, capacity), np.zeros(n_open)
    homeless = []
    for piece in rest:
        n = piece[2]
        at = int(np.argmin(np.where(room >= n, cost, np.inf))) if n_open else 0
        if n_open and room[at] >= n:
            opened[at].append(piece)
            room[at] -= n
            cost[at] += LINEAR * n + QUADRATIC * n * n
        else:
            homeless.append(piece)
    for at in np.flatnonzero(room).tolist():
        hole = int(room[at])
        while hole:
            item, start, n = homeless.pop()
            used = min(n, hole)
            opened[at].append((item, start, used))
            hole -= used
            if n > used:
                homeless.append((item, start + used, n - used))
    return sequences + opened, homeless


def powers_of_two(pieces: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """The pieces laid out in sequences whose lengths are powers of two, largest first."""
    out, waiting = [], sorted(pieces, key=lambda p: p[2])
    left = sum(p[2] for p in pieces)
    while left:
        hole = 1 << (left.bit_length() - 1)
        left -= hole
        out.append([])
        while hole:
            item, start, n = waiting.pop()
            used = min(n, hole)
            out[-1].append((item, start, used))
            hole -= used
            if n > used:
                waiting.append((item, start + used, n - used))
    return out


class _Packer:
    """Documents of one partition that wait, and the sequences made so far."""

    def __init__(self, partition: int, capacity: int) -> None:
        self.capacity = capacity
        self.next_sequence = partition << 40
        self.doc: list[int | None] = []
        self.ids: list[np.ndarray] = []
        self.start: list[int] = []
        self.total: list[int] = []
        self.waiting = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc.append(doc_id), self.ids.append(ids), self.start.append(0), self.total.append(len(ids))
        self.waiting += len(ids)

    def flush(self, last: bool) -> pa.RecordBatch:
        sequences, rest = plan(np.array([len(x) for x in self.ids], dtype=np.int64), self.capacity)
        if last:
            sequences, rest = sequences + powers_of_two(rest), []
        columns: list[list] = [[] for _ in range(8)]
        for number, pieces in enumerate(sequences):
            offset = 0
            for item, start, n in pieces:
                raw = self.ids[item][start:start + n].astype("<u4").tobytes()
                row = (self.doc[item], self.start[item] + start, n, zlib.crc32(raw), self.total[item],
                       self.next_sequence + number, offset, raw)
                for column, value in zip(columns, row, strict=True):
                    column.append(value)
                offset += n
        self.next_sequence += len(sequences)
        kept = [(self.doc[i], self.ids[i][s:s + n], self.start[i] + s, self.total[i]) for i, s, n in rest]
        self.doc, self.ids, self.start, self.total = ([k[j] for k in kept] for j in range(4))
        self.waiting = sum(map(len, self.ids))
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
        kinds = [pa.int64()] * 7 + [pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def pack_documents(docs: DataFrame, vocabulary: str = VOCABULARY, capacity: int = CAPACITY,
                   window_tokens: int = WINDOW_TOKENS) -> DataFrame:
    """A row for each piece of ``docs`` (doc_id, text); ``ids`` are little-endian unsigned 32-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = word_ids(vocabulary)
        packer = _Packer(TaskContext.get().partitionId(), capacity)
        for batch in batches:
            names = batch.column(0).to_pylist()
            for b in texts_of(batch.column(1)):
                ids, bounds = token_ids(b, memory)
                for i in range(b.n_docs):
                    packer.add(names[b.lo + i], ids[bounds[i]:bounds[i + 1]])
                if packer.waiting >= window_tokens:
                    yield packer.flush(last=False)
        yield packer.flush(last=True)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, PIECES)
