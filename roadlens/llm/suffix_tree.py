"""Operator 5, language-model scoring by a probabilistic suffix tree over words.

A token's state is the longest retained suffix of the two tokens before it (the text's beginning included).  A follower that
occurs LEAST times or more in a context is listed there and has its discounted relative frequency; the mass that is
left is spread over the others in proportion to the parent's distribution, so each state's probabilities sum to
one (an unseen token counts as one more word).  The root is the contract's base.  A context is retained if its followers'
distribution diverges from that of its suffix by DIVERGENCE nats an occurrence or more, or if it is the suffix of one
that is.  LEAST and DIVERGENCE do not depend on the size of the corpus.

Everything that decides about contexts that end in one token is known where all of that token's occurrences
meet, so the token stream is shuffled once, by the token before:

1. Texts are taken in pieces.  A piece asks the tokens' buckets for the counts of its distinct tokens, and for numbers for
   those that occur LEAST times or more (small ones for frequent tokens).  Other tokens are all alike as followers, and no
   contexts.
2. Each piece turns its tokens into records (token before, token, the one before both, document), sorted and packed by
   bucket of the token before.
3. A bucket counts its records, finds what its contexts retain, and returns for each document what its tokens score above
   the root.
4. A hot token before, of very many occurrences, is dealt to buckets by the token before both.  What of it
   is not known in one bucket goes through Spark's grouping: counts of its followers, and whether it is a retained one's suffix.

Arrays travel packed in the bytes that their largest number needs, by byte planes, compressed.  Nothing the tree learns
comes to the driver or is broadcast.  Pieces and buckets are of bounded size.  Both passes over the texts must find the same
pieces, so read ``docs`` from files or a checkpoint; a piece without its answers raises an error.

Defined results: null and empty texts are the end alone; null ids are scored, are not trained on and have
``held_out`` null; extra columns are left out; with no training text every token has probability 1.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.llm.common import fold, pieces, stage
from roadlens.llm.words import blocks, mix64

#: Occurrences of a context and of its follower.
LEAST = 2
DIVERGENCE = 0.02
DISCOUNT = 0.75
HELD_OUT = 1

#: The end of a text as a token, and its beginning as a context; words hash to any other number.
END = np.int64(-1)
#: Bytes of text, and documents, of a piece.
PIECE_BYTES, PIECE_DOCS = 6 << 20, 1 << 15
#: Bytes of text whose records share a bucket, about.
BUCKET_BYTES = 6 << 20
#: A token's followers are dealt to many buckets if it has more occurrences than HOT, which bounds a bucket, or more than one
#: in HOT_SHARE (but HOT_LEAST), so that the same words are dealt at every size up to there.
HOT, HOT_SHARE, HOT_LEAST = 1_000_000, 200, 10_000

#: Smallest part of a context's mass that is left to unlisted followers.
_FLOOR = 1e-9


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.col("text").cast("string").alias("text"), (fold() == HELD_OUT).alias("held_out"))


# arrays of numbers as bytes


def squeeze(x: np.ndarray) -> bytes:
    """Numbers from 0 on, packed: their count, width, and byte planes compressed."""
    x = np.ascontiguousarray(x, dtype="<u8")
    width = max(1, (int(x.max(initial=0)).bit_length() + 7) // 8)
    planes = x.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()
    return len(x).to_bytes(5, "little") + bytes([width]) + pa.compress(planes, codec="zstd", asbytes=True)


def unsqueeze(raw: bytes) -> np.ndarray:
    n, width = int.from_bytes(raw[:5], "little"), raw[5]
    out = np.zeros((n, 8), dtype=np.uint8)
    if n:
        planes = pa.decompress(raw[6:], decompressed_size=n * width, codec="zstd", asbytes=True)
        out[:, :width] = np.frombuffer(planes, np.uint8).reshape(width, n).T
    return out.reshape(-1).view("<i8")


# 1. tokens


def _tokens(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of all tokens of a piece, the end after each text's words."""
    hashes, docs, lo = [np.zeros(0, dtype=np.uint64)], [np.zeros(0, dtype=np.int64)], 0
    for b in blocks(text, lower=True):
        ends = np.searchsorted(b.doc, np.arange(b.n_docs), side="right")
        hashes.append(np.insert(b.hash, ends, END.view(np.uint64)))
        docs.append(lo + np.insert(b.doc, ends, np.arange(b.n_docs)))
        lo += b.n_docs
    return np.concatenate(hashes), np.concatenate(docs)


def _distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct hashes, index of each in them)."""
    codes, values = pd.factorize(hashes)
    order = np.argsort(values)
    place = np.empty(len(values), dtype=np.int64)
    place[order] = np.arange(len(values))
    return values[order], place[codes]


def _bucket_bounds(keys: np.ndarray, n_buckets: int) -> np.ndarray:
    """Where each bucket begins among sorted hashes; buckets are ranges of them."""
    return np.searchsorted(keys, (np.arange(n_buckets, dtype=object) * (1 << 64) // n_buckets).astype(np.uint64))


def _in_pieces(texts: DataFrame) -> DataFrame:
    return texts.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out",
                        F.coalesce(~F.col("held_out"), F.lit(False)).alias("learnt"), "text")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in pieces(whole, PIECE_BYTES):
            for lo in range(0, batch.num_rows, PIECE_DOCS):
                yield batch.slice(lo, PIECE_DOCS)


def ask_tokens(texts: DataFrame, n_buckets: int) -> DataFrame:
    """(bucket, piece, keys, n): distinct tokens of each piece, and how often they occur in its training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _cut(batches):
            hashes, doc = _tokens(batch.column(4))
            keys, of = _distinct(hashes)
            n = np.bincount(of, batch.column(3).to_numpy(zero_copy_only=False)[doc], len(keys)).astype(np.int64)
            bounds = [*_bucket_bounds(keys, n_buckets).tolist(), len(keys)]
            cells = [(i, bounds[i], bounds[i + 1]) for i in range(n_buckets) if bounds[i] < bounds[i + 1]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([c[0] for c in cells], pa.int32()), pa.repeat(batch.column(0)[0], len(cells)),
                 pa.array([squeeze(np.diff(keys[a:b], prepend=np.uint64(0))) for _, a, b in cells], pa.binary()),
                 pa.array([squeeze(n[a:b]) for _, a, b in cells], pa.binary())], names=["bucket", "piece", "keys", "n"])

    return _in_pieces(texts).mapInArrow(run, "bucket int, piece long, keys binary, n binary")


def answer_tokens(asked: DataFrame, n_buckets: int) -> DataFrame:
    """(piece, bucket, number, c, total, vocabulary): counts of the tokens asked for, and numbers of those of LEAST or more.

    ``total`` and ``vocabulary`` are those of the bucket, in one row of it (else 0).
    """

    def merged(key: tuple, rows: pa.Table) -> pa.Table:
        bucket = key[0].as_py()
        keys = [np.cumsum(unsqueeze(x.as_py()).view(np.uint64), dtype=np.uint64) for x in rows.column("keys")]
        values, of = _distinct(np.concatenate(keys))
        c = np.bincount(of, np.concatenate([unsqueeze(x.as_py()) for x in rows.column("n")]), len(values)).astype(np.int64)
        order = np.argsort(-c, kind="stable")
        number = np.empty(len(values), dtype=np.int64)
        number[order] = np.arange(len(values)) * n_buckets + bucket + 1
        number[c < LEAST] = 0
        at = np.cumsum([0] + [len(k) for k in keys])
        cells = [of[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
        first = np.arange(len(cells)) == 0
        return pa.table([rows.column("piece"), rows.column("bucket"), pa.array([squeeze(number[x]) for x in cells], pa.binary()),
                         pa.array([squeeze(c[x]) for x in cells], pa.binary()), pa.array(np.where(first, int(c.sum()), 0)),
                         pa.array(np.where(first, int((c > 0).sum()), 0))], names=["piece", "bucket", "number", "c", "total", "vocabulary"])

    return asked.groupBy("bucket").applyInArrow(merged, "piece long, bucket int, number binary, c binary, total long, vocabulary long")


# 2. records

#: Cells: arrays of one piece for one bucket.  "hot" ones hold hot tokens before.
_CELL = ["before", "n_before", "pairs", "token", "n_token", "records", "second", "doc"]
_PARTS = ("kind string, bucket int, piece long, " + ", ".join(f"{c} binary" for c in _CELL)
          + ", doc_id array<{id}>, held_out array<boolean>, n_tokens binary, n_known binary, base binary, sums binary, "
            "c1 long, c1_n long, t long, t_n long, n long")


def _part(kind: str, size: int, schema: pa.Schema, /, **columns: pa.Array) -> pa.Table:
    """Rows of the table of parts; columns that are not given are null."""
    columns["kind"] = pa.array([kind] * size, pa.string())
    return pa.table([columns[f.name] if f.name in columns else pa.nulls(size, f.type) for f in schema], schema=schema)


def _heads(*sorted_columns: np.ndarray) -> np.ndarray:
    """Where a group of equal rows begins."""
    change = np.ones(len(sorted_columns[0]), dtype=bool)
    change[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in sorted_columns])
    return np.flatnonzero(change)


def _cells(bucket: np.ndarray, before: np.ndarray, n_before: np.ndarray, token: np.ndarray, n_token: np.ndarray, second: np.ndarray,
           doc: np.ndarray) -> tuple[list[int], dict[str, list[bytes]]]:
    """(buckets, packed arrays) of records; each bucket's are sorted by token before and token."""
    order = np.lexsort((token, before, bucket))
    bucket, before, n_before, token, n_token, second, doc = (x[order] for x in (bucket, before, n_before, token, n_token, second, doc))
    cuts = np.append(_heads(bucket), len(bucket)) if len(bucket) else np.zeros(1, dtype=np.int64)
    out: dict[str, list[bytes]] = {c: [] for c in _CELL}
    for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        pair = _heads(before[a:z], token[a:z])
        one = _heads(before[a:z][pair])
        for name, x in (("before", before[a:z][pair][one]), ("n_before", n_before[a:z][pair][one]), ("pairs", np.diff(np.append(one, len(pair)))),
                        ("token", token[a:z][pair]), ("n_token", n_token[a:z][pair]), ("records", np.diff(np.append(pair, z - a))),
                        ("second", second[a:z]), ("doc", doc[a:z])):
            out[name].append(squeeze(x))
    return bucket[cuts[:-1]].tolist(), out


def _recorded(n_buckets: int, total: int, vocabulary: int, hot: int, schema: pa.Schema):
    """Turn a piece's texts and answers into its documents' row and its cells."""

    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        if not texts.num_rows or not answers.num_rows:
            raise RuntimeError("a piece of the texts has changed between two passes: read them from files or a checkpoint")
        raw = pa.decompress(texts.column("blob")[0].as_py(), decompressed_size=int(texts.column("size")[0].as_py()), codec="zstd")
        offsets = np.concatenate(([0], np.cumsum(unsqueeze(texts.column("lengths")[0].as_py()))))
        n_docs = len(offsets) - 1
        text = pa.Array.from_buffers(pa.large_string(), n_docs, [None, pa.py_buffer(offsets.astype(np.int64)), raw])
        learnt = np.array(texts.column("learnt")[0].as_py(), dtype=np.int64)
        hashes, doc = _tokens(text)
        keys, of = _distinct(hashes)
        answers = answers.sort_by("bucket")
        number, c = (np.concatenate([unsqueeze(x.as_py()) for x in answers.column(name)]) for name in ("number", "c"))
        if len(number) != len(keys):
            raise RuntimeError("a piece of the texts has changed between two passes: read them from files or a checkpoint")
        root = np.log10((c + 0.5) / (total + 0.5 * (vocabulary + 1)))
        piece = texts.column("piece")[0].as_py()
        rows = [_part("documents", 1, schema, piece=pa.array([piece], pa.int64()), bucket=pa.array([piece % n_buckets], pa.int32()),
                      doc_id=texts.column("doc_id").combine_chunks(), held_out=texts.column("held_out").combine_chunks(),
                      n_tokens=pa.array([squeeze(np.bincount(doc, minlength=n_docs))], pa.binary()),
                      n_known=pa.array([squeeze(np.bincount(doc, (c > 0)[of], n_docs))], pa.binary()),
                      base=pa.array([np.bincount(doc, root[of], n_docs).tobytes()], pa.binary()))]
        end = int(np.searchsorted(keys, END.view(np.uint64)))
        before, second = np.full(len(of), end), np.full(len(of), end)
        before[1:] = np.where(doc[1:] == doc[:-1], of[:-1], end)
        second[1:] = np.where(doc[1:] == doc[:-1], before[:-1], end)
        some = np.flatnonzero(number[before] > 0)
        before, second, of, mark = before[some], second[some], of[some], 2 * doc[some] + learnt[doc[some]]
        is_hot = c[before] > hot
        spread = np.where(is_hot, mix64((number[before].view(np.uint64) << np.uint64(1)) ^ mix64(number[second].view(np.uint64))),
                          mix64(number[before].view(np.uint64)))
        bucket = (spread % np.uint64(n_buckets)).astype(np.int64)
        token = np.where(number[of] > 0, number[of], 0)
        n_token = np.where(token > 0, c[of], 0)
        for kind, mine in (("plain", ~is_hot), ("hot", is_hot)):
            if mine.any():
                at, packed = _cells(bucket[mine], number[before[mine]], c[before[mine]], token[mine], n_token[mine], number[second[mine]], mark[mine])
                rows.append(_part(kind, len(at), schema, bucket=pa.array(at, pa.int32()), piece=pa.array([piece] * len(at), pa.int64()),
                                  **{name: pa.array(x, pa.binary()) for name, x in packed.items()}))
        return pa.concat_tables(rows)

    return run


def _texts_by_piece(texts: DataFrame) -> DataFrame:
    """(piece, doc_id, held_out, learnt, lengths, size, blob): a row for each piece, its texts compressed."""
    id_type = texts.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _cut(batches):
            text = batch.column(4).cast(pa.large_string()).fill_null("")
            offsets = np.frombuffer(text.buffers()[1], np.int64, len(text) + 1, 8 * text.offset)
            raw = (text.buffers()[2] or pa.py_buffer(b""))[int(offsets[0]):int(offsets[-1])]
            one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
            yield pa.RecordBatch.from_arrays(
                [pa.array([batch.column(0)[0].as_py()], pa.int64()), one(batch.column(1)), one(batch.column(2)), one(batch.column(3)),
                 pa.array([squeeze(np.diff(offsets))], pa.binary()), pa.array([len(raw)], pa.int64()),
                 pa.array([pa.compress(raw, codec="zstd", asbytes=True)], pa.binary())],
                names=["piece", "doc_id", "held_out", "learnt", "lengths", "size", "blob"])

    return _in_pieces(texts).mapInArrow(run, f"piece long, doc_id array<{id_type}>, held_out array<boolean>, learnt array<boolean>, "
                                             "lengths binary, size long, blob binary")


# 3. buckets


class Records:
    """The records of the cells of a bucket, one after another.

    ``one``, ``pair``, ``two``, ``three`` number each record's token before, (token before, token), (second, token
    before) and all three; a second that has no number is 0, and so is a token.
    """

    def __init__(self, cells: pa.Table) -> None:
        columns = {name: [unsqueeze(x.as_py()) for x in cells.column(name)] for name in _CELL}
        self.piece = np.repeat(np.arange(cells.num_rows, dtype=np.int32), [len(x) for x in columns["doc"]])
        flat = {name: np.concatenate(columns.pop(name)) for name in _CELL}
        of_pair = np.repeat(np.arange(len(flat["records"])), flat["records"])
        of_one = np.repeat(np.arange(len(flat["pairs"])), flat["pairs"])
        doc = flat.pop("doc")
        self.doc, self.learnt = (doc >> 1).astype(np.int32), (doc & 1).astype(np.int8)
        one, self.before = pd.factorize(flat["before"])
        self.n_before = np.zeros(len(self.before), dtype=np.int64)
        self.n_before[one] = flat["n_before"]
        token, self.token = pd.factorize(flat["token"])
        pair, keys = pd.factorize(one[of_one] << 32 | token)
        self.pair = pair[of_pair]
        self.one_of_pair, self.token_of_pair = keys >> 32, self.token[keys & 0xFFFFFFFF]
        self.n_token = np.zeros(len(keys), dtype=np.int64)
        self.n_token[pair] = flat["n_token"]
        self.n_pair = np.bincount(self.pair, self.learnt, len(keys)).astype(np.int64)
        self.one = self.one_of_pair[self.pair]
        second, seconds = pd.factorize(flat.pop("second"))
        self.two, keys = pd.factorize(second << 32 | self.one)
        self.one_of_two, self.known_two = keys & 0xFFFFFFFF, seconds[keys >> 32] > 0
        self.n_two = np.bincount(self.two, self.learnt, len(keys)).astype(np.int64)
        self.three, keys = pd.factorize(self.two << 32 | self.pair)
        self.two_of_three, self.pair_of_three = keys >> 32, keys & 0xFFFFFFFF
        self.n_three = np.bincount(self.three, self.learnt, len(keys)).astype(np.int64)


def _contexts(context: np.ndarray, n: np.ndarray, log_p: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log10 of the back-off, divergence) of each context from its listed followers: counts and the parent's log10 probability."""
    mass = n - DISCOUNT
    add = lambda x: np.bincount(context, x, len(total))
    return finish_contexts(add(mass), add(10 ** log_p), add(mass * (np.log(mass) - log_p * np.log(10))), total)


def finish_contexts(mass: np.ndarray, parent: np.ndarray, gain: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    total = np.maximum(total, 1)
    left = np.maximum(1 - mass / total, _FLOOR)
    share = left / np.maximum(1 - parent, _FLOOR)
    return np.log10(share), np.where(mass > 0, (gain - mass * np.log(total)) / total + left * np.log(share), 0.0)


def score_records(r: Records, root_total: float, n_pair: np.ndarray | None = None, back_off: np.ndarray | None = None,
                  diverging: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(score above the root of each record, whether that is certain, tokens before that are suffixes of retained contexts).

    Counts of pairs and the contexts of one token are given for hot tokens, else found in the records.  For hot ones it
    may be uncertain whether they are retained.
    """
    given = n_pair is not None
    n_pair = n_pair if given else r.n_pair
    listed = (n_pair >= LEAST) & (r.token_of_pair > 0)
    with np.errstate(divide="ignore"):
        root = np.log10((r.n_token + 0.5) / root_total)
        own = np.where(listed, np.log10(np.maximum(n_pair - DISCOUNT, _FLOOR) / np.maximum(r.n_before[r.one_of_pair], 1)), 0.0)
    if not given:
        back_off, diverging = _contexts(r.one_of_pair[listed], n_pair[listed].astype(float), root[listed], r.n_before)
    above = np.where(listed, own - root, back_off[r.one_of_pair])  # above the root by the token before alone
    listed_three = (r.n_three >= LEAST) & listed[r.pair_of_three] & r.known_two[r.two_of_three]
    two, pair = r.two_of_three[listed_three], r.pair_of_three[listed_three]
    off_two, diverging_two = _contexts(two, r.n_three[listed_three].astype(float), own[pair], r.n_two)
    keep_two = diverging_two >= DIVERGENCE
    suffix = np.zeros(len(r.before), dtype=bool)
    suffix[r.one_of_two[keep_two]] = True
    keep_one = (diverging >= DIVERGENCE) | suffix
    by_two = off_two[r.two_of_three] + above[r.pair_of_three]
    by_two[listed_three] = np.log10((r.n_three[listed_three] - DISCOUNT) / r.n_two[two]) - root[pair]
    kept = keep_two[r.two]
    score = np.where(kept, by_two[r.three], above[r.pair])
    certain = kept | keep_one[r.one]
    return (score, certain, suffix) if given else (np.where(certain, score, 0.0), np.ones(len(score), dtype=bool), suffix)


def _sums(r: Records, score: np.ndarray, cells: pa.Table, kind: str, schema: pa.Schema) -> pa.Table:
    """What the records add to each document of their pieces."""
    of, out = [], []
    for i, piece in enumerate(cells.column("piece").to_pylist()):
        mine = r.piece == i
        added = np.bincount(r.doc[mine], score[mine])
        at = np.flatnonzero(added)
        if len(at):
            packed = squeeze(at)
            of.append(piece), out.append(len(packed).to_bytes(8, "little") + packed + added[at].tobytes())
    return _part(kind, len(of), schema, piece=pa.array(of, pa.int64()), sums=pa.array(out, pa.binary()))


def added_sums(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(documents, what to add to each) of a row of :func:`_sums`."""
    n = int.from_bytes(raw[:8], "little")
    return unsqueeze(raw[8:8 + n]), np.frombuffer(raw[8 + n:], np.float64)


def _scored(root_total: float, schema: pa.Schema):
    """Score a bucket's plain cells; count the pairs of its hot ones; pass on the rest."""

    def run(rows: pa.Table) -> pa.Table:
        kinds = np.array(rows.column("kind").to_pylist())
        out = [rows.filter(pa.array((kinds == "documents") | (kinds == "hot")))]
        plain, hot = rows.filter(pa.array(kinds == "plain")), rows.filter(pa.array(kinds == "hot"))
        if plain.num_rows:
            r = Records(plain)
            out.append(_sums(r, score_records(r, root_total)[0], plain, "sums", schema))
        if hot.num_rows:
            r = Records(hot)
            one, n = r.one_of_pair, len(r.one_of_pair)
            out.append(_part(
                "pair", n, schema, bucket=pa.repeat(rows.column("bucket")[0], n), c1=pa.array(r.before[one]),
                c1_n=pa.array(r.n_before[one]), t=pa.array(r.token_of_pair), t_n=pa.array(r.n_token), n=pa.array(r.n_pair)))
        return pa.concat_tables([t.cast(schema) for t in out])

    return run


# 4. hot tokens


def _hot_contexts(pairs: DataFrame, root_total: float) -> DataFrame:
    """(bucket, c1, t, n, back_off, diverging) for each hot pair of each bucket, by counts over all buckets."""
    counted = stage(pairs.groupBy("c1", "t").agg(F.sum("n").alias("n"), F.max("t_n").alias("t_n"), F.max("c1_n").alias("c1_n")), "op5-hot-pairs")
    listed = (F.col("n") >= LEAST) & (F.col("t") > 0)
    mass = F.when(listed, F.col("n") - DISCOUNT).otherwise(0.0)
    p = (F.col("t_n") + 0.5) / root_total
    sums = counted.groupBy("c1").agg(
        F.max("c1_n").alias("c1_n"), F.sum(mass).alias("mass"), F.sum(F.when(listed, p).otherwise(0.0)).alias("parent"),
        F.sum(F.when(listed, mass * (F.log(mass) - F.log(p))).otherwise(0.0)).alias("gain"))
    total = F.greatest("c1_n", F.lit(1))
    left = F.greatest(1 - F.col("mass") / total, F.lit(_FLOOR))
    share = left / F.greatest(1 - F.col("parent"), F.lit(_FLOOR))
    gain = (F.col("gain") - F.col("mass") * F.log(total)) / total + left * F.log(share)
    diverging = F.when(F.col("mass") > 0, gain).otherwise(0.0)
    contexts = stage(sums.select("c1", F.log10(share).alias("back_off"), diverging.alias("diverging")), "op5-hot")
    return pairs.select("bucket", "c1", "t").join(counted.select("c1", "t", "n"), ["c1", "t"]).join(contexts, "c1")


def _scored_hot(root_total: float, schema: pa.Schema):
    """Score a bucket's hot cells: sums, sums that count only if their token before is retained, and suffixes of retained contexts."""

    def run(cells: pa.Table, known: pa.Table) -> pa.Table:
        r = Records(cells)
        place = {b: i for i, b in enumerate(r.before.tolist())}
        one = np.array([place[b] for b in known.column("c1").to_pylist()])
        keys = pd.Series(np.arange(known.num_rows), index=pd.MultiIndex.from_arrays([one, known.column("t").to_numpy()]))
        at = keys.loc[list(zip(r.one_of_pair.tolist(), r.token_of_pair.tolist(), strict=True))].to_numpy()
        back_off, diverging = np.zeros(len(r.before)), np.zeros(len(r.before))
        back_off[one], diverging[one] = known.column("back_off").to_numpy(), known.column("diverging").to_numpy()
        score, certain, suffix = score_records(r, root_total, known.column("n").to_numpy()[at], back_off, diverging)
        found = np.flatnonzero(suffix)
        out = [_sums(r, np.where(certain, score, 0.0), cells, "sums", schema), _part("suffix", len(found), schema, c1=pa.array(r.before[found]))]
        for i in np.unique(r.one[~certain]).tolist():
            part = _sums(r, np.where(certain | (r.one != i), 0.0, score), cells, "if", schema)
            out.append(part.set_column(part.schema.get_field_index("c1"), "c1", pa.array(np.full(part.num_rows, r.before[i]))))
        return pa.concat_tables([t.cast(schema) for t in out])

    return run


def _total(total: int):
    """Put a piece's parts together: a row for each of its documents."""

    def run(rows: pa.Table) -> pa.Table:
        kinds = np.array(rows.column("kind").to_pylist())
        own = rows.filter(pa.array(kinds == "documents"))
        base = np.frombuffer(own.column("base")[0].as_py(), np.float64)
        score = base.copy()
        for raw in rows.filter(pa.array(kinds == "sums")).column("sums"):
            at, added = added_sums(raw.as_py())
            score[at] += added
        n_tokens, n_known = (unsqueeze(own.column(c)[0].as_py()) for c in ("n_tokens", "n_known"))
        ids, held = (own.column(c).combine_chunks().flatten() for c in ("doc_id", "held_out"))
        return pa.table([ids, held, pa.array(n_tokens), pa.array(n_known), pa.array(np.full(len(base), total)), pa.array(base), pa.array(score)],
                        names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return run


def suffix_tree_scores(docs: DataFrame, hot: int | None = None) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score): learn from the texts that are not held out, score all."""
    texts = _texts(docs)
    id_type = texts.schema["doc_id"].dataType.simpleString()
    n_bytes = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_buckets = 1 + n_bytes // BUCKET_BYTES
    answers = stage(answer_tokens(ask_tokens(texts, n_buckets), n_buckets), "op5-answers")
    found = answers.agg(F.sum("total").alias("n"), F.sum("vocabulary").alias("v")).first()
    total, vocabulary = int(found["n"] or 0), int(found["v"] or 0)
    root_total = total + 0.5 * (vocabulary + 1)
    if hot is None:
        hot = min(HOT, max(HOT_LEAST, total // HOT_SHARE))
    spark_schema = _PARTS.format(id=id_type)
    schema = _arrow_schema(docs, spark_schema)
    recorded = _texts_by_piece(texts).groupBy("piece").cogroup(answers.select("piece", F.col("bucket"), "number", "c").groupBy("piece")).applyInArrow(
        _recorded(n_buckets, total, vocabulary, hot, schema), spark_schema)
    parts = stage(recorded.groupBy("bucket").applyInArrow(_scored(root_total, schema), spark_schema), "op5-parts")
    done = parts.where("kind in ('documents', 'sums')")
    pairs = parts.where("kind = 'pair'")
    if pairs.limit(1).count():
        known = _hot_contexts(pairs, root_total).select(F.col("bucket").alias("of"), "c1", "t", "n", "back_off", "diverging")
        cells = parts.where("kind = 'hot'").select("bucket", "piece", *_CELL)
        scored = cells.groupBy("bucket").cogroup(known.groupBy("of")).applyInArrow(_scored_hot(root_total, schema), spark_schema)
        more = stage(scored, "op5-hot-parts")
        suffixes = more.where("kind = 'suffix'").select("c1").distinct()
        certain = more.where("kind = 'if'").join(suffixes, "c1", "left_semi").withColumn("kind", F.lit("sums"))
        done = done.unionByName(more.where("kind = 'sums'")).unionByName(certain.select(*done.columns))
    slim = done.select("kind", "piece", "doc_id", "held_out", "n_tokens", "n_known", "base", "sums")
    return slim.groupBy("piece").applyInArrow(
        _total(total), f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def _arrow_schema(docs: DataFrame, spark_schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(spark_schema))
