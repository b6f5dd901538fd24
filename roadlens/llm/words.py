"""Words of whole texts as numpy arrays, for the functions that run inside Arrow batches.

A word is ``[^\\x20\\x09-\\x0D]+``.  Those separators are ASCII, so words can be cut on the UTF-8 bytes of
an Arrow string column without decoding it.  A column is taken in blocks of a few megabytes; a text is
never cut, so one very long text makes one larger block.

Words, lines and shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa

#: Bytes of text that are worked on at once; the arrays made of them take some forty times as much.
BLOCK_BYTES = 1 << 20
#: For work that looks words up in a memory, which larger blocks do less often.
LOOK_UP_BYTES = 2 << 20
#: Longer segments are hashed one by one.
LONG = 4096

_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit mixer (xor-shift and multiply), elementwise."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def weights(n: int, salt: int = 0) -> np.ndarray:
    """``n`` fixed pseudo-random odd 64-bit numbers."""
    with np.errstate(over="ignore"):
        seeds = (np.arange(n, dtype=np.uint64) + np.uint64(1 + salt)) * np.uint64(0x9E3779B97F4A7C15)
    return mix64(seeds) | np.uint64(1)


def segment_hash(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Hash of each segment ``data[starts[i]:starts[i] + lengths[i]]``, eight bytes at a time.

    Different segments of the same length up to eight bytes never share a hash.
    """
    out = mix64(lengths.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019))
    padded = np.concatenate((data, np.zeros(8, dtype=np.uint8)))
    eights = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    long = lengths > LONG
    rows = np.flatnonzero((lengths > 0) & ~long)
    done = 0
    while len(rows):
        left = lengths[rows] - done
        loaded = eights[starts[rows] + done]
        short = left < 8
        loaded[short] &= (np.uint64(1) << (left[short] * 8).astype(np.uint64)) - np.uint64(1)
        out[rows] = mix64(out[rows] ^ loaded)
        rows, done = rows[left > 8], done + 8
    for i in np.flatnonzero(long):
        raw = data[starts[i]:starts[i] + lengths[i]].tobytes()
        out[i] = np.uint64(int.from_bytes(blake2b(raw, digest_size=8).digest(), "little"))
    return out


def keyed(hashes: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Hashes made different for each document of a block, so one sort serves all of them."""
    return hashes ^ mix64(docs.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019))


@dataclass
class Block:
    """Some whole texts: rows ``lo`` to ``hi`` of the column.

    ``data`` holds their bytes one after another, text i at ``offsets[i]:offsets[i + 1]``.  Words are given
    by ``start``, ``end`` (positions in ``data``), ``doc`` (text within the block) and ``hash``.
    """

    lo: int
    hi: int
    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    hash: np.ndarray

    @property
    def n_docs(self) -> int:
        return self.hi - self.lo

    def word(self, i: int) -> bytes:
        return self.data[self.start[i]:self.end[i]].tobytes()

    def per_doc(self, docs: np.ndarray, amounts: np.ndarray | None = None) -> np.ndarray:
        return np.bincount(docs, weights=amounts, minlength=self.n_docs)

    def docs_at(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets[1:], positions, side="right")

    def count_bytes(self, mask: np.ndarray) -> np.ndarray:
        """How many bytes of each text are marked."""
        total = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def ngrams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of each window of n words within one text."""
        if len(self.doc) < n:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
        last = len(self.doc) - n + 1
        first = np.flatnonzero(self.doc[:last] == self.doc[n - 1:])
        factors = weights(n, 1 << 40)
        total = np.zeros(len(first), dtype=np.uint64)
        for j in range(n):
            total += self.hash[first + j] * factors[j]
        return first, mix64(total)


def _cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    inside = ~_SEPARATOR[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty(len(data), dtype=bool)
    before[:1] = False
    before[1:] = inside[:-1]
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(len(data), dtype=bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return start, end, np.searchsorted(offsets[1:], start, side="right")


def blocks(text: pa.Array, lower: bool = False, size: int = BLOCK_BYTES) -> Iterator[Block]:
    """The texts of an Arrow string column in blocks of whole texts; null texts are empty."""
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
        data = every[offsets[lo]:offsets[hi]]
        if lower:
            data = _LOWER[data]
        own = offsets[lo:hi + 1] - offsets[lo]
        start, end, doc = _cut(data, own)
        yield Block(lo, hi, data, own, start, end, doc, segment_hash(data, start, end - start))
        lo = hi


def distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct hashes in order of appearance, the first position of each, index of each input in them)."""
    codes, values = pd.factorize(hashes)
    first = np.empty(len(values), dtype=np.int64)
    first[codes[::-1]] = np.arange(len(hashes) - 1, -1, -1)
    return values, first, codes


class Memory:
    """Numbers about words, worked out once for each distinct word and remembered by its hash.

    Holds at most ``most`` words; when a block would exceed that, it starts anew.
    """

    def __init__(self, width: int, most: int = 1_000_000) -> None:
        self.width, self.most = width, most
        self.clear()

    def clear(self) -> None:
        self.hashes = np.zeros(0, dtype=np.uint64)
        self.values = np.zeros((0, self.width), dtype=np.int32)

    def look_up(self, hashes: np.ndarray, compute: Callable[[int], tuple[int, ...]]) -> np.ndarray:
        """A row for each of the distinct ``hashes``; ``compute(i)`` gives that of the i-th if it is new."""
        if len(self.hashes) + len(hashes) > self.most:
            self.clear()
        at = np.searchsorted(self.hashes, hashes)
        known = np.zeros(len(hashes), dtype=bool)
        inside = at < len(self.hashes)
        known[inside] = self.hashes[at[inside]] == hashes[inside]
        new = np.flatnonzero(~known)
        if len(new):
            new = new[np.argsort(hashes[new])]
            found = np.array([compute(i) for i in new.tolist()], dtype=np.int32).reshape(len(new), self.width)
            place = np.searchsorted(self.hashes, hashes[new])
            self.hashes = np.insert(self.hashes, place, hashes[new])
            self.values = np.insert(self.values, place, found, axis=0)
            at = np.searchsorted(self.hashes, hashes)
        return self.values[at]
