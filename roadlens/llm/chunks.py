"""Token ids of whole texts by public subword tokenizers, for the functions that run inside Arrow batches.

A text is cut into chunks that the tokenizer encodes independently of each other, so each distinct chunk is
encoded once by a worker and remembered.  Where it is uncertain whether a cut is allowed, none is made and
the chunk is longer.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from roadlens.llm.words import LOOK_UP_BYTES, distinct, segment_hash

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core

#: Distinct chunks, and their ids, that a worker remembers.
REMEMBER, REMEMBER_IDS = 1_000_000, 16_000_000

WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: ASCII letters, digits and signs other than the apostrophe.
_KIND = np.array([1 if chr(i).isalpha() else 2 if chr(i).isdigit() else 3 if 32 < i < 127 and i != 39 else 0
                  for i in range(128)] + [0] * 128, dtype=np.uint8)


def text_blocks(text: pa.Array, size: int = LOOK_UP_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bytes, bounds of the texts in them) of the column in blocks of whole texts; null texts are empty."""
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
    text = text.cast(pa.large_string()).fill_null("")
    n = len(text)
    if n == 0:
        return
    _, offset_buffer, data_buffer = text.buffers()
    offsets = np.frombuffer(offset_buffer, dtype=np.int64)[text.offset:text.offset + n + 1]
    every = np.frombuffer(data_buffer, dtype=np.uint8) if data_buffer is not None else np.zeros(0, dtype=np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, side="right")) - 1)
        yield every[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


def _cuts(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """Where a run of marked bytes begins, and where a text does."""
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = offsets[:-1][np.diff(offsets) > 0]
    first[heads] = True
    return first


def byte_level_chunks(data: np.ndarray, offsets: np.ndarray, whole: tuple[bytes, ...] = ()) -> np.ndarray:
    """Starts of the chunks of a byte-level vocabulary: at white space, and where ASCII letters, digits and signs meet.

    The vocabulary's pattern never joins those, nor goes from other characters into white space, and looks ahead only to
    the character after white space.  Apostrophes, bytes beyond ASCII and control characters have no class,
    and after what may be white space beyond ASCII there is no cut.  Strings in ``whole`` are not cut.
    """
    first = _cuts(data, offsets, WHITE[data])
    start = np.flatnonzero(first)
    heads = np.zeros(len(data) + 1, dtype=bool)
    heads[offsets] = True
    asked = start[~heads[start]]
    before = data[asked - 1]
    doubtful = asked[(before >= 0x80) | ((before >= 0x1C) & (before <= 0x1F))]
    if len(doubtful):
        one, two, three = data[doubtful - 1], data[np.maximum(doubtful - 2, 0)], data[np.maximum(doubtful - 3, 0)]
        wide = ((three == 0xE1) & (two == 0x9A)) | ((three == 0xE2) & ((two == 0x80) | (two == 0x81))) | ((three == 0xE3) & (two == 0x80))
        first[doubtful[(one < 0x20) | ((two == 0xC2) & ((one == 0x85) | (one == 0xA0))) | wide]] = False
    kind = _KIND[data]
    first[1:] |= (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0)
    if any(whole):
        raw = data.tobytes()
        for s in whole:
            at = raw.find(s)
            while at >= 0:
                first[at + 1:at + len(s)] &= heads[at + 1:at + len(s)]
                at = raw.find(s, at + 1)
    return np.flatnonzero(first)


def space_chunks(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of the chunks of a vocabulary whose pieces hold spaces only at their beginning."""
    return np.flatnonzero(_cuts(data, offsets, data == 0x20))


class ChunkIds:
    """Ids of chunks by hash, in growing flat arrays; forgets everything when it holds too many."""

    def __init__(self, encode: Callable[[list[bytes]], list[list[int]]], whole: tuple[bytes, ...] = (), remember: int = REMEMBER) -> None:
        #: strings that no chunk may cut
        self.whole = whole
        self.encode, self.remember = encode, remember
        self._forget()

    def _forget(self) -> None:
        self.hashes = np.zeros(0, dtype=np.uint64)
        self.begin = np.zeros(0, dtype=np.int64)
        self.length = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.uint32)

    def ids_of(self, data: np.ndarray, offsets: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, bounds of the texts in them); chunks begin at ``start``."""
        end = np.append(start[1:], len(data))
        hashes, first, inverse = distinct(segment_hash(data, start, end - start))
        if len(self.hashes) + len(hashes) > self.remember or len(self.ids) > REMEMBER_IDS:
            self._forget()
        at = np.searchsorted(self.hashes, hashes)
        known = np.zeros(len(hashes), dtype=bool)
        inside = at < len(self.hashes)
        known[inside] = self.hashes[at[inside]] == hashes[inside]
        new = np.flatnonzero(~known)
        if len(new):
            new = new[np.argsort(hashes[new])]
            raw, lo, hi = data.tobytes(), start[first[new]].tolist(), end[first[new]].tolist()
            found = self.encode([raw[i:j] for i, j in zip(lo, hi, strict=True)])
            length = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
            begin = len(self.ids) + np.cumsum(length) - length
            self.ids = np.concatenate((self.ids, np.fromiter(chain.from_iterable(found), np.uint32, int(length.sum()))))
            at = np.searchsorted(self.hashes, hashes[new])
            self.hashes = np.insert(self.hashes, at, hashes[new])
            self.begin = np.insert(self.begin, at, begin)
            self.length = np.insert(self.length, at, length)
            at = np.searchsorted(self.hashes, hashes)
        begin, length = self.begin[at][inverse], self.length[at][inverse]
        total = np.concatenate(([0], np.cumsum(length)))
        ids = self.ids[np.arange(total[-1]) + np.repeat(begin - total[:-1], length)]
        return ids, total[np.searchsorted(start, offsets)]


@cache
def byte_level(path: str, plain: bool) -> ChunkIds:
    """One memory for each Python worker.  ``plain``: the strings of special tokens are ordinary text."""
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = plain

    def encode(chunks: list[bytes]) -> list[list[int]]:
        texts = [c.decode("utf-8", "replace") for c in chunks]
        return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    special = () if plain else tuple(t.content.encode() for t in tokenizer.get_added_tokens_decoder().values())
    return ChunkIds(encode, special)


@cache
def piecewise(path: str) -> ChunkIds:
    """As :func:`byte_level`; chunks begin with the space that the library adds itself.

    Raises ValueError for a vocabulary whose pieces hold a space after another character.
    """
    model = SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    if any("▁" in p.lstrip("▁") for p in pieces):
        raise ValueError("a piece of this vocabulary goes beyond a space")
    space = [model.piece_to_id("▁")]  # the library adds none to an empty text

    def encode(chunks: list[bytes]) -> list[list[int]]:
        found = model.encode([c[1:].decode("utf-8", "replace") for c in chunks], num_threads=1)
        return [space if c == b" " else ids for c, ids in zip(chunks, found, strict=True)]

    return ChunkIds(encode)


def _byte_letters() -> dict[str, int]:
    """The byte behind each letter of a byte-level vocabulary: printable ones as they are, the rest from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = (i for i in range(256) if i not in printable)
    return {chr(i): i for i in printable} | {chr(256 + n): i for n, i in enumerate(others)}


class ByteTable:
    """Byte strings by number, gathered for whole arrays of numbers at once."""

    def __init__(self, entries: list[bytes]) -> None:
        self.length = np.fromiter(map(len, entries), dtype=np.int64, count=len(entries))
        self.begin = np.cumsum(self.length) - self.length
        self.data = np.frombuffer(b"".join(entries), dtype=np.uint8)

    def joined(self, numbers: np.ndarray) -> np.ndarray:
        """The strings of the numbers one after another."""
        length = self.length[numbers]
        total = np.cumsum(length)
        return self.data[np.arange(total[-1] if len(total) else 0) + np.repeat(self.begin[numbers] - (total - length), length)]


@cache
def byte_level_bytes(path: str) -> ByteTable:
    tokenizer, letters = Tokenizer.from_file(path), _byte_letters()
    pieces = [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size())]
    return ByteTable([bytes(letters[c] for c in p) if all(c in letters for c in p) else p.encode() for p in pieces])


@cache
def piece_bytes(path: str) -> ByteTable:
    model = SentencePieceProcessor(model_file=path)
    return ByteTable([
        bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode()
        for i, p in enumerate(model.id_to_piece(i) for i in range(model.get_piece_size()))])
