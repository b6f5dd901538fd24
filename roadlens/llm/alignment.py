"""Operator 13, alignment of two tokenizers over the same texts, counted by inverted pair bitmaps.

Both tokenizers cut the bytes of a space and the text.  Tokens whose byte ranges overlap are linked; places where
tokens of both end cut the tokens into groups.

1. Texts are encoded where they are read.  A container holds up to 2**16 neighbouring documents.  Of each id pair that is
   linked in it there is a posting: bitmaps of the container's documents, one for each bit of how often the pair is linked
   in a document (multiplicity planes).  A bitmap is a list of 16-bit numbers or, where that is shorter, a bit set.
   Blocks of a few texts are encoded at a time; their postings are merged into the container's.
2. Popcounts: a pair's planes ORed together give its documents, 2**k for each bit of plane k its links.  Containers are
   disjoint, so their numbers add up, pre-aggregated before the shuffle.
3. Of each id of the second tokenizer the highest count is found; pairs get their count and whether it is that.
4. These scores meet the postings of each container again, whose bitmaps say which documents they go to.

Work is spread by containers, which are of bounded size; pairs are joined by a shuffle.

Defined results: null and empty texts, and texts whose tokens do not give back their bytes, have no tokens, zeros
everywhere and empty groups; null ids and rows that share an id are documents of their own; extra columns are left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.llm.chunks import (
    ByteTable,
    byte_level,
    byte_level_bytes,
    byte_level_chunks,
    piece_bytes,
    piecewise,
    space_chunks,
    text_blocks,
)
from roadlens.llm.common import pieces, stage

FIRST = public_tokenizers.path("byte_bpe_50k.json")
SECOND = public_tokenizers.path("piece_bpe_32k.model")
#: Bytes of text of a container, and of what is encoded at once.
CONTAINER_BYTES, BLOCK_BYTES = 8 << 20, 1 << 20
#: Documents of a container: places take 16 bits.
CONTAINER_DOCS = 1 << 16


@dataclass
class Aligned:
    """A block of documents: numbers of each, their links one after another, and their groups as bytes."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    doc: np.ndarray
    a: np.ndarray
    b: np.ndarray
    groups: np.ndarray
    groups_at: np.ndarray


@cache
def _decimals(largest: int) -> ByteTable:
    """Number 4 * id + s: the id in decimals with nothing, a comma, a bar or a semicolon behind it."""
    return ByteTable([str(i).encode() + s for i in range(largest + 1) for s in (b"", b",", b"|", b";")])


def _faithful(ids: np.ndarray, bounds: np.ndarray, table: ByteTable, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which texts' tokens, joined, are the bytes of the text."""
    n_tokens, n_bytes = np.diff(bounds), np.diff(offsets)
    joined = np.concatenate(([0], np.cumsum(table.length[ids])))
    good = np.diff(joined[bounds]) == n_bytes
    differ = table.joined(ids[np.repeat(good, n_tokens)]) != data[np.repeat(good, n_bytes)]
    of = np.flatnonzero(good)
    good[of[np.searchsorted(np.cumsum(n_bytes[of]), np.flatnonzero(differ), side="right")]] = False
    return good


def align(data: np.ndarray, offsets: np.ndarray, first: str = FIRST, second: str = SECOND) -> Aligned:
    """Texts (each a space and the text; only the space: without tokens) aligned."""
    sides = []
    usable = np.diff(offsets) > 1
    for memory, cut, table in (
            (byte_level(first, plain=True), byte_level_chunks, byte_level_bytes(first)),
            (piecewise(second), space_chunks, piece_bytes(second))):
        ids, bounds = memory.ids_of(data, offsets, cut(data, offsets))
        usable &= _faithful(ids, bounds, table, data, offsets)
        sides.append((ids, np.diff(bounds), table))
    sides = [(ids[np.repeat(usable, n)].astype(np.int64), np.where(usable, n, 0), table) for ids, n, table in sides]
    (a, n_a, table_a), (b, n_b, table_b) = sides
    text_end = np.cumsum(np.where(usable, np.diff(offsets), 0))
    ends = np.zeros(int(text_end[-1]) + 1, dtype=np.uint8)
    for ids, mark, table in ((a, 1, table_a), (b, 2, table_b)):
        ends[np.cumsum(table.length[ids])] |= mark
    links = np.flatnonzero(ends)  # between two of them lies what one token of each side shares
    in_a, in_b, cut = ends[links] & 1 > 0, ends[links] & 2 > 0, ends[links] == 3
    before = lambda marked: np.cumsum(marked) - marked
    upto = np.searchsorted(links, text_end, side="right")
    n_links = np.diff(upto, prepend=0)
    n_groups = np.diff(np.concatenate(([0], np.cumsum(cut)))[upto], prepend=0)
    # groups: the tokens of the first side, then those of the second
    group = 2 * before(cut)
    group = np.concatenate((group[in_a], group[in_b] + 1))
    order = np.argsort(group, kind="stable")
    group, ids = group[order], np.concatenate((a, b))[order]
    stop = np.zeros(len(ids), dtype=np.int64)
    stop[:-1] = np.where(group[1:] == group[:-1], 1, np.where(group[:-1] % 2 == 0, 2, 3))
    n_tokens = n_a + n_b
    last = np.cumsum(n_tokens)[n_tokens > 0] - 1
    stop[last] = 0
    decimals = _decimals(max(len(table_a.length), len(table_b.length)))
    numbers = 4 * ids + stop
    length = np.concatenate(([0], np.cumsum(decimals.length[numbers])))
    return Aligned(n_a, n_b, n_groups, n_links, np.repeat(np.arange(len(usable)), n_links), a[before(in_a)], b[before(in_b)],
                   decimals.joined(numbers), length[np.concatenate(([0], np.cumsum(n_tokens)))])


# postings


def postings(pair: np.ndarray, doc: np.ndarray, links: np.ndarray, n_docs: int) -> tuple[np.ndarray, pa.Array]:
    """(distinct pairs, their planes as lists of bitmaps) of entries sorted by pair and document.

    A bitmap is 0 and the documents as 16-bit numbers, or 1 and a bit for each document of the container.
    """
    heads = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1]))) if len(pair) else np.zeros(0, dtype=np.int64)
    number = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(pair))))
    n_planes = np.zeros(len(heads), dtype=np.int64)
    if len(heads):
        n_planes = np.ceil(np.log2(np.maximum.reduceat(links, heads) + 1)).astype(np.int64)
    set_bytes = -(-n_docs // 8)
    first = np.concatenate(([0], np.cumsum(n_planes)))  # a pair's planes among all
    size = np.zeros(first[-1], dtype=np.int64)
    planes = []
    for k in range(int(n_planes.max(initial=0))):
        at = np.flatnonzero(links >> k & 1)
        many = np.bincount(number[at], minlength=len(heads))
        has = n_planes > k
        size[first[:-1][has] + k] = 1 + np.minimum(2 * many[has], set_bytes)
        planes.append((at, many))
    offsets = np.concatenate(([0], np.cumsum(size)))
    out = np.zeros(offsets[-1], dtype=np.uint8)
    for k, (at, many) in enumerate(planes):
        start = offsets[first[number[at]] + k]
        as_set = 2 * many[number[at]] > set_bytes
        listed = at[~as_set]
        rank = np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)
        place = start[~as_set] + 1 + 2 * rank[~as_set]
        out[place], out[place + 1] = doc[listed] & 255, doc[listed] >> 8
        out[start[as_set]] = 1
        dense = doc[at[as_set]]
        np.bitwise_or.at(out, start[as_set] + 1 + (dense >> 3), (1 << (dense & 7)).astype(np.uint8))
    values = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(out)])
    return pair[heads], pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), values)


def expanded(planes: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, document, 2**plane) of every bit of a column of :func:`postings`."""
    lists = planes.offsets.to_numpy()
    values = planes.values
    bounds = np.frombuffer(values.buffers()[1], np.int32, len(values) + 1, 4 * values.offset)
    data = np.frombuffer(values.buffers()[2] or b"", np.uint8)
    which = np.arange(lists[0], lists[-1])
    row = np.repeat(np.arange(len(planes)), np.diff(lists))
    plane = which - lists[row]
    begin, size = bounds[which].astype(np.int64), np.diff(bounds)[which]
    as_set = data[begin] == 1
    many = np.where(as_set, 0, (size - 1) // 2)
    of = np.repeat(np.arange(len(which)), many)
    at = begin[of] + 1 + 2 * (np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many))
    found = [(of, data[at].astype(np.int64) | data[at + 1].astype(np.int64) << 8)]
    for n in np.unique(size[as_set]).tolist():
        own = np.flatnonzero(as_set & (size == n))
        bits = np.unpackbits(data[begin[own][:, None] + np.arange(1, n)], axis=1, bitorder="little")
        of, doc = np.nonzero(bits)
        found.append((own[of], doc))
    of, doc = (np.concatenate(x) for x in zip(*found, strict=True))
    return row[of], doc, np.int64(1) << plane[of]


def _flat(column: pa.ChunkedArray | pa.Array) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


# tables

_INDEX = ("container long, place int, {id}, n_a long, n_b long, n_groups long, n_links long, groups string, "
          "a int, b int, planes array<binary>")


def _rows(container: int, docs: list[tuple], a: np.ndarray, b: np.ndarray, planes: pa.Array, names: list[str]) -> pa.RecordBatch:
    """A container's documents, then its postings, in one batch."""
    n, m = sum(len(d[0]) for d in docs), len(a)
    joined = [pa.concat_arrays([d[i] for d in docs]) for i in range(len(docs[0]))]
    columns = [pa.array(np.full(n + m, container)), pa.concat_arrays([pa.array(np.arange(n, dtype=np.int32)), pa.nulls(m, pa.int32())])]
    columns += [pa.concat_arrays([x, pa.nulls(m, x.type)]) for x in joined]
    columns += [pa.concat_arrays([pa.nulls(n, x.type), x]) for x in (pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)), planes)]
    return pa.RecordBatch.from_arrays(columns, names=names)


def alignment_index(docs: DataFrame, first: str = FIRST, second: str = SECOND) -> DataFrame:
    """A row for each document (place in its container, its numbers, its groups) and one for each posting (a, b, planes)."""
    spark_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["container", "place", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "a", "b", "planes"]
        for whole in batches:
            for batch in pieces(whole, CONTAINER_BYTES):
                for part in (batch.slice(i, CONTAINER_DOCS) for i in range(0, batch.num_rows, CONTAINER_DOCS)):
                    rows, keys, links, at = [], [], [], 0
                    text = pc.binary_join_element_wise(
                        pa.scalar(" ", pa.large_string()), part.column(2).cast(pa.large_string()).fill_null(""), pa.scalar("", pa.large_string()))
                    for data, offsets in text_blocks(text, BLOCK_BYTES):
                        found = align(data, offsets, first, second)
                        n = len(found.n_a)
                        key, often = np.unique((found.a << 16 | found.b) << 16 | (found.doc + at), return_counts=True)
                        keys.append(key), links.append(often)
                        groups = pa.Array.from_buffers(pa.large_string(), n, [
                            None, pa.py_buffer(found.groups_at.astype(np.int64)), pa.py_buffer(found.groups)]).cast(pa.string())
                        rows.append((part.column(1).slice(at, n), *[pa.array(x.astype(np.int64)) for x in (
                            found.n_a, found.n_b, found.n_groups, found.n_links)], groups))
                        at += n
                    key, often = np.concatenate(keys), np.concatenate(links)
                    order = np.argsort(key)  # blocks hold different documents: their union
                    key, often = key[order], often[order]
                    pair, planes = postings(key >> 16, key & 0xFFFF, often, at)
                    yield _rows(part.column(0)[0].as_py(), rows, pair >> 16, pair & 0xFFFF, planes, names)

    source = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.col("text").cast("string").alias("text"))
    return source.mapInArrow(run, _INDEX.format(id=f"doc_id {spark_type}"))


def pair_counts(index: DataFrame) -> DataFrame:
    """(a, b, n_docs, n_links) over the whole corpus, by popcounts of the postings of an :func:`alignment_index`."""

    def popcounts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, doc, weight = expanded(batch.column(2))
            links = np.bincount(row, weight, batch.num_rows).astype(np.int64)
            either = np.unique(row << 16 | doc) >> 16  # the planes ORed
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.bincount(either, minlength=batch.num_rows).astype(np.int64)), pa.array(links)],
                names=["a", "b", "n_docs", "n_links"])

    counted = index.where(F.col("place").isNull()).select("a", "b", "planes").mapInArrow(popcounts, "a int, b int, n_docs long, n_links long")
    return counted.groupBy("a", "b").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_links").alias("n_links"))


def score_documents(index: DataFrame, counts: DataFrame) -> DataFrame:
    """The documents of the index with n_best and count_sum; ``counts`` are its :func:`pair_counts`, written."""
    best = counts.groupBy("b").agg(F.max("n_links").alias("top"))
    scores = counts.join(best, "b").select(
        F.col("a").alias("id_a"), F.col("b").alias("id_b"), F.col("n_links").alias("links"), (F.col("n_links") == F.col("top")).alias("best"))
    wanted = index.where(F.col("place").isNull()).select(
        F.col("container").alias("of"), F.col("a").alias("id_a"), F.col("b").alias("id_b")).join(scores, ["id_a", "id_b"])
    kept = [c for c in index.columns if c not in ("container", "place", "a", "b", "planes", "n_links")]

    def summed(left: pa.Table, right: pa.Table) -> pa.Table:
        docs = left.filter(pc.is_valid(left.column("place"))).sort_by("place")
        found = left.filter(pc.is_null(left.column("place")))
        pair = lambda t, a, b: t.column(a).to_numpy().astype(np.int64) << 32 | t.column(b).to_numpy()
        scored = pair(right, "id_a", "id_b")
        order = np.argsort(scored)
        at = order[np.searchsorted(scored[order], pair(found, "a", "b"))]
        row, doc, weight = expanded(_flat(found.column("planes")))
        count, is_best = right.column("links").to_numpy()[at], right.column("best").to_numpy(zero_copy_only=False)[at].astype(np.int64)
        n_best, total = np.zeros(docs.num_rows, dtype=np.int64), np.zeros(docs.num_rows, dtype=np.int64)
        np.add.at(n_best, doc, weight * is_best[row])
        np.add.at(total, doc, weight * count[row])
        out = docs.select([*kept, "n_links"])
        return out.append_column("n_best", pa.array(n_best)).append_column("count_sum", pa.array(total))

    fields = [index.schema[c] for c in (*kept, "n_links")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", n_best long, count_sum long"
    return index.groupBy("container").cogroup(wanted.groupBy("of")).applyInArrow(summed, schema)


def align_documents(docs: DataFrame, first: str = FIRST, second: str = SECOND,
                    keep_groups: Callable[[Column], Column] = lambda groups: groups) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of each document.

    ``keep_groups`` says what of the groups is written and returned: they are longer than the texts.
    """
    index = stage(alignment_index(docs, first, second).withColumn("groups", keep_groups(F.col("groups"))), "op13-index")
    return score_documents(index, stage(pair_counts(index), "op13-pairs"))
