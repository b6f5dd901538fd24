"""Chunks, packed ids and alignment against the public tokenizers themselves."""

from __future__ import annotations

import glob
import hashlib
import mmap
import random
import tempfile
import zlib
from collections import Counter
from functools import cache

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import AWKWARD, awkward, documents, nothing
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from roadlens.llm import alignment as al
from roadlens.llm import bit_packing as bp
from roadlens.llm.chunks import byte_level, byte_level_chunks, piecewise, space_chunks, text_blocks
from roadlens.llm.queries import QUERIES
from roadlens.llm.token_counts import VOCABULARY as PIECES

PARTS = ["a", "B", " ", "  ", "\n", "\t", "\xa0", "　", "—", "'s", "'", "é", "日本", "1", "12", "<|endoftext|>", ".", "(", "\x1c",
         "\x85", " ", "</s>", "<s>", "☃", "can't", "\r\n", "x" * 40]
MIXED = st.lists(st.sampled_from(PARTS), max_size=30).map("".join)


@cache
def tokenizer(plain=False):
    own = Tokenizer.from_file(bp.VOCABULARY)
    own.encode_special_tokens = plain
    return own


@cache
def pieces():
    return SentencePieceProcessor(model_file=PIECES)


def mapped(path):
    with open(path, "rb") as f:
        return bp.PackedFile(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))


def chunked(texts, memory, cut):
    out = []
    for data, offsets in text_blocks(pa.array(texts, pa.string()), size=200):
        ids, bounds = memory.ids_of(data, offsets, cut(data, offsets))
        out += [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), MIXED), max_size=6))
def test_byte_level_chunks_are_independent(texts):
    for plain in (False, True):
        own = tokenizer(plain)
        memory = byte_level(bp.VOCABULARY, plain)
        want = [e.ids for e in own.encode_batch([t or "" for t in texts], add_special_tokens=False)]
        assert chunked(texts, memory, lambda d, o: byte_level_chunks(d, o, memory.whole)) == want  # noqa: B023


@settings(max_examples=300, deadline=None)
@given(st.lists(MIXED.filter(bool), max_size=6))
def test_piece_chunks_are_independent(texts):
    model = pieces()
    assert chunked([" " + t for t in texts], piecewise(PIECES), space_chunks) == [model.encode(t) for t in texts]


def test_chunks_after_forgetting():
    texts = ["one two three", "two four", "five one"] * 5
    memory = byte_level.__wrapped__(bp.VOCABULARY, False)
    memory.remember = 4
    own = tokenizer()
    assert chunked(texts, memory, byte_level_chunks) == [own.encode(t).ids for t in texts]


# op 11


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 32), st.integers(0, 300), st.integers(0, 2**32))
def test_bits_round_trip(width, n, seed):
    ids = np.random.default_rng(seed).integers(0, 1 << width, n, dtype=np.uint64)
    words = bp.pack(ids, width)
    assert len(words) == -(-n // 64) * width
    assert bp.unpack(words, width)[:n].tolist() == ids.tolist()


def test_width_is_the_least():
    assert [bp.bits_for(x) for x in (0, 1, 2, 255, 256, 50_256, 65_536)] == [1, 1, 2, 8, 9, 16, 17]


def _want(rows, own):
    """(doc_id, start, n_tokens, crc) of all rows by brute force; the order of equal ids is given."""
    out, at = [], 0
    for i, text in rows:
        ids = own.encode(text or "", add_special_tokens=False).ids + [bp.END_ID]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_packed_ids_of_a_corpus(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").repartition(5)
    got = sorted(tuple(r) for r in bp.packed_ids(docs).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    assert got == _want(rows, tokenizer())


def test_packed_ids_of_awkward_documents(spark):
    got = sorted((tuple(r) for r in bp.packed_ids(awkward(spark)).select("start", "doc_id", "n_tokens", "ids_crc32").collect()))
    own = tokenizer()
    every = {(i, n, crc) for i, _, n, crc in _want(AWKWARD, own)}
    assert [g[1] for g in got] == sorted((i for i, _ in AWKWARD), key=lambda i: -1 if i is None else i)
    assert {(i, n, crc) for _, i, n, crc in got} == every
    at = 0
    for start, _, n, _ in got:
        assert start == at
        at += n
    assert bp.packed_ids(nothing(spark)).collect() == []


@pytest.mark.parametrize(("vocabulary_bits", "file_bytes"), [(16, 6000), (17, 1 << 30), (5, 300)])
def test_files_hold_everything(spark, vocabulary_bits, file_bytes):
    """Random access through the block offsets, on a memory map; small blocks and many files."""

    def written_numbers(text):  # texts that are ids already
        found = [[int(x) for x in t.split()] for t in text.to_pylist()]
        return np.array([len(f) for f in found]), np.array([x for f in found for x in f], np.uint32)

    rng = random.Random(vocabulary_bits)
    rows = [(rng.randrange(50), np.array([rng.randrange(1 << vocabulary_bits) for _ in range(rng.choice([1, 3, 700]))], "<u4"))
            for _ in range(120)]
    table = spark.createDataFrame([(i, " ".join(map(str, x))) for i, x in rows], "doc_id long, text string")
    path = tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/ids"
    bp.write_ids(table, path, written_numbers, vocabulary_bits, file_bytes, block_ids=128)
    files = [mapped(f) for f in sorted(glob.glob(path + "/part-*"))]
    assert len(files) > 1 or file_bytes > 6000
    ids = [(int(f.doc_id[i]), f.document(i).astype("<u4").tobytes()) for f in files for i in range(len(f.doc_id))]
    assert [i for i, _ in ids] == sorted(i for i, _ in rows)
    assert sorted(ids) == sorted((i, x.tobytes()) for i, x in rows)
    for f in files:
        every = f.ids(0, f.n_ids)
        for _ in range(20):
            lo = rng.randrange(f.n_ids)
            hi = rng.randrange(lo, f.n_ids + 1)
            assert f.ids(lo, hi).tolist() == every[lo:hi].tolist()
        with pytest.raises(IndexError):
            f.ids(0, f.n_ids + 1)


def test_an_id_of_many_rows_fills_many_files(spark):
    rows = documents(spark, [f"text {i}" for i in range(400)]).selectExpr("case when doc_id < 300 then 7 else doc_id end doc_id", "text")
    path = tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/ids"
    bp.write_ids(rows, path, bp.byte_level_encoder(bp.VOCABULARY, 2), 16, 400)
    files = [mapped(f) for f in sorted(glob.glob(path + "/part-*"))]
    assert sum(7 in f.doc_id for f in files) > 2 and max(len(f.doc_id) for f in files) < 200
    assert sum(len(f.doc_id) for f in files) == 400


# op 13


def by_ends(ids, size):
    out, at = [], 0
    for i in ids:
        out.append((at, at + size(i), i))
        at += size(i)
    return out


@cache
def letters():
    """The byte of each letter of the byte-level vocabulary, from the library's own alphabet order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [i for i in range(256) if i not in plain]
    return {**{chr(i): i for i in plain}, **{chr(256 + n): i for n, i in enumerate(rest)}}


def bytes_a(i):
    return bytes(letters()[c] for c in tokenizer(True).id_to_token(i))


def bytes_b(i):
    p = pieces().id_to_piece(i)
    return bytes([int(p[3:5], 16)]) if pieces().is_byte(i) else p.replace("\u2581", " ").encode()


def brute_alignment(rows):
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) by comparing all ranges of a text."""
    out, every, docs_of = [], Counter(), Counter()
    for i, text in rows:
        a, b = [], []
        if text:
            a, b = tokenizer(True).encode(" " + text, add_special_tokens=False).ids, pieces().encode(text)
            if any(b"".join(map(f, x)) != b" " + text.encode() for f, x in ((bytes_a, a), (bytes_b, b))):
                a, b = [], []
        ra, rb = by_ends(a, lambda x: len(bytes_a(x))), by_ends(b, lambda x: len(bytes_b(x)))
        links = [(x, y) for lo, hi, x in ra for l2, h2, y in rb if max(lo, l2) < min(hi, h2)]
        every.update(links)
        docs_of.update(set(links))
        cuts = sorted({r[1] for r in ra} & {r[1] for r in rb})
        groups, at = [], 0
        for cut in cuts:
            side = lambda r: ",".join(str(x) for lo, hi, x in r if at <= lo and hi <= cut)  # noqa: B023, E731
            groups.append(side(ra) + "|" + side(rb))
            at = cut
        out.append((i, len(a), len(b), len(cuts), links, ";".join(groups)))
    top = Counter()
    for (_, y), n in every.items():
        top[y] = max(top[y], n)
    got = [(i, a, b, g, len(links), sum(every[p] == top[p[1]] for p in links), sum(every[p] for p in links), groups)
           for i, a, b, g, links, groups in out]
    return got, {p: (docs_of[p], n) for p, n in every.items()}


ALIGNED = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[-1]))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 300), st.integers(1, 9)), max_size=120), st.sampled_from([301, 4000]))
def test_postings_round_trip(found, n_docs):
    often = {(p, d): n for p, d, n in found}
    key = np.array(sorted(p << 16 | d for p, d in often), np.int64)
    links = np.array([often[k >> 16, k & 0xFFFF] for k in key.tolist()], np.int64)
    pair, planes = al.postings(key >> 16, key & 0xFFFF, links, n_docs)
    assert pair.tolist() == sorted({p for p, _ in often})
    got = Counter()
    for row, doc, weight in zip(*al.expanded(planes), strict=True):
        got[int(pair[row]), int(doc)] += int(weight)
    assert got == often
    assert all(len(x) <= 1 + -(-n_docs // 8) for x in planes.values.to_pylist())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(MIXED, st.just("\u2581 x")), min_size=1, max_size=5))
def test_alignment_of_any_texts(texts):
    found = [al.align(d, o) for d, o in text_blocks(pa.array([" " + t for t in texts], pa.string()))]
    (got,) = found
    want, _ = brute_alignment(list(enumerate(texts)))
    raw = got.groups.tobytes()
    at = got.groups_at.tolist()
    assert [(i, *[int(x[i]) for x in (got.n_a, got.n_b, got.n_groups, got.n_links)], raw[at[i]:at[i + 1]].decode())
            for i in range(len(texts))] == [(*r[:5], r[-1]) for r in want]


def test_alignment_of_a_corpus(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("length(text) < 4000").limit(150).cache()
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    rows += [(5, "same id"), (5, "same id"), (None, "the the the the the the"), (900_001, ""), (900_002, None), (900_003, "\u2581"),
             (900_004, "<|endoftext|> </s>"), (900_005, "the " * 300)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want, counts = brute_alignment(rows)
    assert in_order(tuple(r) for r in al.align_documents(table).select(*ALIGNED).collect()) == in_order(want)
    index = al.alignment_index(table)
    assert {(r["a"], r["b"]): (r["n_docs"], r["n_links"]) for r in al.pair_counts(index).collect()} == counts
    assert {r[0]: r[-1] for r in want}[900_003] == "" and max(n for _, n in counts.values()) > 255  # many planes


def test_alignment_query(spark):
    rows = [(i, t) for i, t in AWKWARD if len(t or "") < 10_000]
    want, _ = brute_alignment(rows)
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    awkward(spark).where("length(text) < 10000 or text is null").write.parquet(f"{folder}/documents.parquet")
    got = QUERIES["op13_alignment"](spark, folder).select(*ALIGNED[:-1], "groups_sha256").collect()
    assert in_order(tuple(r) for r in got) == in_order(
        (*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest() if r[-1] else "") for r in want)
    long = {r["doc_id"]: r["n_links"] for r in al.align_documents(awkward(spark)).collect()}
    assert long[6] == long[7] > 20_000
    assert al.align_documents(nothing(spark)).collect() == []
