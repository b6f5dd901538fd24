"""Operator 12, periodic runs of words: Baier's grouping, Lyndon arrays under both orders, extension to runs.

A run is a stretch of consecutive words of smallest period q, of ``times`` * q words or more (and of
``least``), that no neighbouring word extends.

1. In such a run of four periods every window of WINDOW words occurs three times or more.  Stretches of windows
   that occur so often in their text are kept, the rest of the text holds no part of a run.
2. The grouping of Baier's suffix sorter (its first phase) gives the longest Lyndon word that starts at each
   word, once with the words in one order and once in the reverse: groups of equal Lyndon words are taken from
   the highest to the lowest, and each word group is appended to what stands before its members
   (:func:`lyndon_groups`).  This takes linear time.
3. Every run has a Lyndon root of the length of its period under one of both orders, at each place where that
   root stands whole.  Roots that follow each other are extended to both sides by the longest common extensions
   of the word there and the word a period on.

All work is within a text; nothing is shuffled.  Words are compared by 64-bit hashes.  Texts are worked on in
blocks; a very long text makes one larger block in its task.

Defined results: null, empty and blank texts have no runs and an empty collapsed text; rows that share an id
are texts of their own; further columns are kept, one that is called like a result column is replaced.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlens.llm.chunks import WHITE
from roadlens.llm.common import append_columns
from roadlens.llm.words import Block, blocks, distinct, keyed

#: Least length of a run, in periods and in words.
TIMES, LEAST = 4, 6
#: A window is short enough for each of those of a run to occur OFTEN times in it; both follow from TIMES and LEAST.
WINDOW, OFTEN = 3, 3

_RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
RESULT = T.StructType([
    T.StructField("n_runs", T.LongType()), T.StructField("runs", T.ArrayType(_RUN)), T.StructField("collapsed", T.StringType())])


def lyndon_groups(rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(length, group) of the longest Lyndon word that starts at each place; equal words have equal groups.

    Negative ranks separate texts; those places have length 0 and no group (-1).

    ``left`` and ``right`` link the places whose group is still to be taken; the text from a place up to its right
    neighbour is what its group has in common.  Taking a group appends its members to the places before them:
    of a group whose members are followed by different numbers of them, those with more go higher.
    """
    n = len(rank)
    found, kind = [0] * n, [-1] * n
    left, right = [*range(-1, n - 1), 0], [*range(1, n + 1), 0]
    for i in np.flatnonzero(rank < 0).tolist():
        if i + 1 < n:
            left[i + 1] = -1
    order = np.argsort(rank, kind="stable")
    order = order[np.searchsorted(rank[order], 0):]
    if not len(order):
        return np.zeros(n, dtype=np.int64), np.full(n, -1)
    cuts = np.flatnonzero(np.diff(rank[order])) + 1
    members = [x.tolist() for x in np.split(order, cuts)]
    size = [len(m) for m in members]
    group = [0] * (n + 1)
    for g, own in enumerate(members):
        for i in own:
            group[i] = g
    top = len(members) - 1
    lower, higher = list(range(-1, top)), [*range(1, top + 1), -1]
    while top >= 0:
        own = members[top] if len(members[top]) == size[top] else [i for i in members[top] if group[i] == top]
        if own:
            length = right[own[0]] - own[0]
            last, count, followed = -1, 0, []
            for i in own:  # in the order of the text, so what stands on the left is of a lower group
                found[i], kind[i] = length, top
                before, after = left[i], right[i]
                right[before], left[after] = after, before
                if before == last:
                    count += 1
                else:
                    if last >= 0:
                        followed.append((count, group[last], last))
                    last, count = before, 1
            if last >= 0:
                followed.append((count, group[last], last))
            if len(followed) == 1:
                if size[followed[0][1]] == 1:
                    followed = []
            else:
                followed.sort(key=lambda x: (-x[0], x[1], x[2]))
            at = 0
            while at < len(followed):
                count, g, _ = followed[at]
                moved = []
                while at < len(followed) and followed[at][0] == count and followed[at][1] == g:
                    moved.append(followed[at][2])
                    at += 1
                if len(moved) == size[g]:
                    continue
                size[g] -= len(moved)
                new = len(members)
                for i in moved:
                    group[i] = new
                members.append(moved)
                size.append(len(moved))
                above = higher[g]
                lower.append(g)
                higher.append(above)
                higher[g] = new
                if above >= 0:
                    lower[above] = new
        members[top] = ()
        top = lower[top]
    return np.array(found, dtype=np.int64), np.array(kind, dtype=np.int64)


def _extension(word: np.ndarray, period: int, at: int, step: int) -> int:
    """How many words from ``at`` on, to the right (step 1) or left (-1), equal those a period to their right."""
    done, size, limit = 0, 16, len(word) - period - at if step > 0 else at + 1
    while done < limit:
        size = min(size, limit - done)
        lo = at + done if step > 0 else at - done - size + 1
        differ = np.flatnonzero(word[lo:lo + size] != word[lo + period:lo + period + size])
        if len(differ):
            return done + int(differ[0] if step > 0 else size - 1 - differ[-1])
        done, size = done + size, size * 4
    return done


def find_runs(word: np.ndarray, rank: np.ndarray, times: int = TIMES, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs; ``rank`` numbers the words, negative: a separator of its own word."""
    found = set()
    top = rank.max(initial=-1)
    for own in (rank, np.where(rank < 0, rank, top - rank)):
        lengths, group = lyndon_groups(own)
        group = np.append(group, -1)
        at = np.flatnonzero(lengths > 0)
        # of a run of `times` periods, times - 1 roots stand whole one after another
        for k in range(1, times - 1):
            at = at[group[np.minimum(at + k * lengths[at], len(own))] == group[at]]
        for i in at[group[np.maximum(at - lengths[at], -1)] != group[at]].tolist():  # the first of them
            period = int(lengths[i])
            back = _extension(word, period, i - 1, -1)
            length = period + back + _extension(word, period, i, 1)
            if length >= max(least, times * period):
                found.add((i - back, length, period))
    return sorted(found, key=lambda r: (r[0], r[2]))


def _stretches(b: Block) -> Iterator[tuple[int, int]]:
    """(first word, words) of the stretches that can hold runs."""
    first, hashes = b.ngrams(WINDOW)
    values, _, inverse = distinct(keyed(hashes, b.doc[first]))
    often = np.bincount(inverse, minlength=len(values))[inverse] >= OFTEN
    edge = np.flatnonzero(np.diff(np.concatenate(([False], often, [False])).astype(np.int8)))
    for lo, hi in edge.reshape(-1, 2).tolist():
        # windows of neighbouring texts do not follow each other
        parts = np.flatnonzero(np.diff(first[lo:hi]) != 1) + lo + 1
        for a, z in zip([lo, *parts.tolist()], [*parts.tolist(), hi], strict=True):
            if z - a + WINDOW - 1 >= LEAST:
                yield int(first[a]), z - a + WINDOW - 1


def runs_of_block(b: Block, times: int = TIMES, least: int = LEAST) -> dict[int, list[tuple[int, int, int]]]:
    """Runs by text, starts counted from the text's first word."""
    stretches = list(_stretches(b))
    if not stretches:
        return {}
    # all stretches one after another, each behind a separator
    place = np.concatenate([np.arange(a - 1, a + n) for a, n in stretches])
    heads = np.cumsum([0] + [n + 1 for _, n in stretches[:-1]])
    separator = np.zeros(len(place), dtype=bool)
    separator[heads] = True
    _, rank = np.unique(b.hash[np.maximum(place, 0)], return_inverse=True)
    rank = rank.reshape(-1).astype(np.int64)
    rank[separator] = -1
    word = rank.copy()
    word[separator] = -1 - np.arange(len(heads))
    begins = np.searchsorted(b.doc, np.arange(b.n_docs))
    out = defaultdict(list)
    for start, length, period in find_runs(word, rank, times, least):
        doc = int(b.doc[place[start]])
        out[doc].append((int(place[start] - begins[doc]), length, period))
    return {doc: sorted(found, key=lambda r: (r[0], r[2])) for doc, found in out.items()}


def spaced(b: Block) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, bounds of the texts in them) of the words of each text joined by one space."""
    data = b.data.copy()
    inner = np.flatnonzero(b.doc[1:] == b.doc[:-1]) if len(b.doc) else np.zeros(0, dtype=np.int64)
    kept = ~WHITE[data]
    kept[b.end[inner]] = True
    data[b.end[inner]] = 0x20
    return data[kept], np.concatenate(([0], np.cumsum(kept, dtype=np.int64)))[b.offsets]


def _column(text: pa.Array, times: int, least: int) -> list[pa.Array]:
    n_runs, runs, collapsed = [], [], []
    for b in blocks(text):
        found = runs_of_block(b, times, least)
        data, bounds = spaced(b)
        raw, bounds = data.tobytes(), bounds.tolist()
        begins = np.searchsorted(b.doc, np.arange(b.n_docs + 1))
        for d in range(b.n_docs):
            own = found.get(d, [])
            n_runs.append(len(own))
            runs.append([{"start": s, "length": n, "period": q} for s, n, q in own])
            if own:
                keep = np.ones(begins[d + 1] - begins[d], dtype=bool)
                for s, n, q in own:
                    keep[s + q:s + n] = False
                collapsed.append(b" ".join([b.word(i) for i in (begins[d] + np.flatnonzero(keep)).tolist()]))
            else:
                collapsed.append(raw[bounds[d]:bounds[d + 1]])
    return [pa.array(n_runs, pa.int64()), pa.array(runs, pa.list_(pa.struct([(f, pa.int64()) for f in _RUN.names]))),
            pa.array(collapsed, pa.binary()).cast(pa.string())]


def periodic_runs(docs: DataFrame, text_col: str = "text", carry: list[str] | None = None, times: int = TIMES,
                  least: int = LEAST) -> DataFrame:
    """``docs`` with n_runs, runs (by start, then period) and the collapsed text: each run cut to its first period.

    ``times`` is 4 or more and ``least`` 6 or more.
    """
    if times < TIMES or least < LEAST:
        raise ValueError("windows find runs of four periods and six words or more")
    return append_columns(docs, text_col, RESULT, lambda text: _column(text, times, least), carry)


def longest():
    """The run of the greatest length (of equal ones the first), null if there is none."""
    runs = F.array_sort(F.col("runs"), lambda a, b: (
        F.when(a["length"] > b["length"], -1).when(a["length"] < b["length"], 1)
        .when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1).otherwise(a["period"] - b["period"]).cast("int")))
    return F.get(runs, 0)


def _repeated(text: pa.Array, marks: pa.Array) -> pa.Array:
    """Texts whose mark h (a crc32) ends in 0 with their last part made periodic; the others as they are."""
    mark = marks.fill_null(1).to_numpy()
    out = text.to_pylist()
    chosen = np.flatnonzero((mark % 10 == 0) & text.is_valid().to_numpy(zero_copy_only=False))
    for b in blocks(text.take(pa.array(chosen))):
        begins = np.searchsorted(b.doc, np.arange(b.n_docs + 1)).tolist()
        for d in range(b.n_docs):
            begin, n = begins[d], begins[d + 1] - begins[d]
            if n:
                i = int(chosen[b.lo + d])
                g = int(mark[i]) // 10
                a = g % n
                period = 1 + (n - a) // (3 + g % 8)
                head = [b.word(begin + j).decode() for j in range(min(n, a + period))]
                out[i] = " ".join([*head[:a], *[head[a + j % period] for j in range(n - a)]])
    return pa.array(out, pa.string())


def with_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, text) of all documents, every tenth (by the crc32 of its id) with a periodic end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), _repeated(batch.column(2), batch.column(1))], names=["doc_id", "text"])

    source = docs.select("doc_id", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("mark"),
                         F.col("text").cast("string").alias("text"))
    return source.mapInArrow(run, T.StructType([docs.schema["doc_id"], T.StructField("text", T.StringType())]))
