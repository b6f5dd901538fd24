"""Operator 11, token ids in files of fixed-width packed bits.

Each id takes the least number of bits that holds every id of the vocabulary.  A file is

* blocks of equally many ids (the last has fewer), each padded to whole 64-bit words;
* a footer: for each document its id, whether it has one, and its first place among the file's ids; then the
  offset of each block;
* a trailer of fixed size: magic, width, ids of a block and the sizes above.

Numbers are little-endian.  Spark's text writer puts a newline behind each row it writes, so one ends each
block and the file; the format counts them as padding.  Its commit protocol makes retried and lost tasks harmless, and the
files can lie wherever Spark writes.  Ids at any place are found by the block offsets and unpacked in numpy,
64 ids to ``width`` words at a time (:class:`PackedFile`).

1. Texts are sorted by document id into ranges, one file each (those of a repeated id are dealt by their hash and
   their row, so one id may fill many files), and encoded there.
2. The files are read back; a file's first place among all ids is the sum of the files before it.

Defined results: null and empty texts are the end id alone; null document ids come first; rows that share an id
are documents of their own, in the order of their texts' hash; extra columns are left out; no documents give no rows.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from roadlens.llm.chunks import byte_level, byte_level_chunks, text_blocks
from roadlens.llm.common import pieces, stage
from roadlens.session import scratch_path

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 2
#: A multiple of 64.
BLOCK_IDS = 1 << 16
#: Bytes of text whose ids go to one file, about; a document is never cut, so a file may have more.
TEXT_BYTES = 64 << 20

MAGIC = b"PACKIDS1"
_TRAILER = struct.Struct("<8sIIQQQ")
#: Files whose sums are taken together.
_FILES = 1000


def bits_for(largest: int) -> int:
    """Least bits that hold every id up to ``largest``."""
    return max(1, int(largest).bit_length())


def pack(ids: np.ndarray, width: int) -> np.ndarray:
    """Ids as 64-bit words, ``width`` bits each; the last 64 are filled up with zeros."""
    rows = np.zeros(-(-len(ids) // 64) * 64, dtype=np.uint64)
    rows[:len(ids)] = ids
    rows = rows.reshape(-1, 64)
    out = np.zeros((len(rows), width), dtype=np.uint64)
    for i in range(64):
        word, shift = divmod(i * width, 64)
        out[:, word] |= rows[:, i] << np.uint64(shift)
        if shift + width > 64:
            out[:, word + 1] |= rows[:, i] >> np.uint64(64 - shift)
    return out.reshape(-1)


def unpack(words: np.ndarray, width: int) -> np.ndarray:
    """The ids of :func:`pack`, with the zeros at the end."""
    rows = words.reshape(-1, width)
    out = np.empty((len(rows), 64), dtype=np.uint32)
    mask = np.uint64((1 << width) - 1)
    for i in range(64):
        word, shift = divmod(i * width, 64)
        value = rows[:, word] >> np.uint64(shift)
        if shift + width > 64:
            value |= rows[:, word + 1] << np.uint64(64 - shift)
        out[:, i] = value & mask
    return out.reshape(-1)


class PackedFile:
    """One file, given as bytes or a memory map; nothing is unpacked before it is asked for."""

    def __init__(self, content) -> None:
        self.content = memoryview(content)
        end = len(self.content) - 1  # a newline
        magic, self.width, self.block_ids, n_docs, self.n_ids, n_blocks = _TRAILER.unpack_from(self.content, end - _TRAILER.size)
        if magic != MAGIC:
            raise ValueError("not a file of packed ids")
        at = end - _TRAILER.size - 8 * n_blocks - 8 * (n_docs + 1) - n_docs - 8 * n_docs
        self.doc_id = np.frombuffer(self.content, "<i8", n_docs, at)
        self.has_id = np.frombuffer(self.content, bool, n_docs, at + 8 * n_docs)
        self.start = np.frombuffer(self.content, "<i8", n_docs + 1, at + 9 * n_docs)
        self.block = np.frombuffer(self.content, "<i8", n_blocks, at + 9 * n_docs + 8 * (n_docs + 1))

    def ids(self, lo: int, hi: int) -> np.ndarray:
        """Ids at the places lo to hi of the file."""
        if not 0 <= lo <= hi <= self.n_ids:
            raise IndexError((lo, hi, self.n_ids))
        found = [np.zeros(0, dtype=np.uint32)]
        while lo < hi:
            block, inside = divmod(lo, self.block_ids)
            upto = min(hi - block * self.block_ids, self.block_ids)
            first, last = inside // 64, -(-upto // 64)
            words = np.frombuffer(self.content, "<u8", (last - first) * self.width, int(self.block[block]) + first * self.width * 8)
            found.append(unpack(words, self.width)[inside - first * 64:upto - first * 64])
            lo = block * self.block_ids + upto
        return np.concatenate(found)

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.start[i]), int(self.start[i + 1]))


class _Writer:
    """Turns documents into the rows of one file."""

    def __init__(self, width: int, block_ids: int) -> None:
        self.width, self.block_ids = width, block_ids
        self.waiting: list[np.ndarray] = []
        self.n_waiting = self.n_ids = self.n_bytes = 0
        self.block: list[int] = []
        self.docs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def _row(self, raw: bytes) -> bytes:
        self.n_bytes += len(raw) + 1
        return raw

    def add(self, doc_id: np.ndarray, has_id: np.ndarray, length: np.ndarray, ids: np.ndarray) -> Iterator[bytes]:
        self.docs.append((doc_id, has_id, length))
        self.waiting.append(ids)
        self.n_ids, self.n_waiting = self.n_ids + len(ids), self.n_waiting + len(ids)
        if self.n_waiting >= self.block_ids:
            every = np.concatenate(self.waiting)
            full = len(every) // self.block_ids * self.block_ids
            for lo in range(0, full, self.block_ids):
                yield self._block(every[lo:lo + self.block_ids])
            self.waiting, self.n_waiting = [every[full:]], len(every) - full

    def _block(self, ids: np.ndarray) -> bytes:
        self.block.append(self.n_bytes)
        return self._row(pack(ids, self.width).astype("<u8").tobytes())

    def finish(self) -> Iterator[bytes]:
        if not self.docs:
            return
        if self.n_waiting:
            yield self._block(np.concatenate(self.waiting))
        doc_id, has_id, length = (np.concatenate(x) for x in zip(*self.docs, strict=True))
        start = np.concatenate(([0], np.cumsum(length)))
        yield self._row(b"".join([
            doc_id.astype("<i8").tobytes(), has_id.astype(bool).tobytes(), start.astype("<i8").tobytes(),
            np.array(self.block, "<i8").tobytes(),
            _TRAILER.pack(MAGIC, self.width, self.block_ids, len(doc_id), self.n_ids, len(self.block))]))


def byte_level_encoder(vocabulary: str, end_id: int) -> Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]:
    """(ids of each text, all of them one after another) of an array of texts, the end id behind each."""

    def encode(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        memory = byte_level(vocabulary, plain=False)
        lengths, parts = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.uint32)]
        for data, offsets in text_blocks(text):
            ids, bounds = memory.ids_of(data, offsets, byte_level_chunks(data, offsets, memory.whole))
            parts.append(np.insert(ids, bounds[1:], np.uint32(end_id)))
            lengths.append(np.diff(bounds) + 1)
        return np.concatenate(lengths), np.concatenate(parts)

    return encode


def write_ids(docs: DataFrame, path: str, encode: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]], width: int,
              text_bytes: int = TEXT_BYTES, block_ids: int = BLOCK_IDS) -> None:
    """The ids of ``docs`` (doc_id, text) as files in ascending order of doc_id, under ``path``.

    ``block_ids`` is a multiple of 64.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_files = max(1, -(-total // text_bytes), min(total >> 20, int(spark.conf.get("spark.sql.shuffle.partitions"))))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Writer(width, block_ids)
        for whole in batches:
            for batch in pieces(whole):
                doc_id = batch.column(0)
                for raw in out.add(doc_id.fill_null(0).to_numpy(), doc_id.is_valid().to_numpy(zero_copy_only=False), *encode(batch.column(1))):
                    yield pa.RecordBatch.from_arrays([pa.array([raw], pa.binary())], names=["row"])
        for raw in out.finish():
            yield pa.RecordBatch.from_arrays([pa.array([raw], pa.binary())], names=["row"])

    ranged = (texts.select("doc_id", "text", F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("row"))
              .repartitionByRange(n_files, "doc_id", "tie", "row").sortWithinPartitions("doc_id", "tie").select("doc_id", "text"))
    # The cast keeps the bytes as they are, and so does the writer.
    ranged.mapInArrow(blocks, "row binary").select(F.col("row").cast("string").alias("value")).write.text(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) of each document in the files; start counts the ids before it in all."""

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                packed = PackedFile(content.as_buffer())
                n = len(packed.doc_id)
                lo = 0
                while lo < n:  # about a block of ids at a time
                    hi = max(lo + 1, int(np.searchsorted(packed.start, packed.start[lo] + packed.block_ids, side="right")) - 1)
                    hi = min(hi, n)
                    start = packed.start[lo:hi + 1]
                    raw = packed.ids(int(start[0]), int(start[-1])).astype("<u4").tobytes()
                    own = (start - start[0]) * 4
                    ids = [raw[a:b] for a, b in zip(own[:-1].tolist(), own[1:].tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.repeat(pa.scalar(number, pa.int64()), hi - lo), pa.array(packed.doc_id[lo:hi], mask=~packed.has_id[lo:hi]),
                         pa.array(start[:-1]), pa.array(np.diff(start)),
                         pa.array([zlib.crc32(x) for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                        names=["file", "doc_id", "start", "n_tokens", "ids_crc32", "ids"])
                    lo = hi

    number = F.regexp_extract("path", r"part-(\d+)-[^/]*$", 1).cast("long").alias("file")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).where("length > 0")
    return files.select(number, "content").mapInArrow(
        documents, "file long, doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")


def place(found: DataFrame) -> DataFrame:
    """``found`` (file, start, n_tokens, ...) with start counted over all files; it is read twice."""
    totals = found.groupBy("file").agg(F.sum("n_tokens").alias("n")).withColumn("part", F.floor(F.col("file") / _FILES))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("part").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = totals.groupBy("part").agg(F.sum("n").alias("n"))
    earlier = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = (totals.withColumn("before", before).join(parts.select("part", earlier.alias("earlier")), "part")
             .select("file", (F.col("before") + F.col("earlier")).alias("base")))
    return found.join(bases, "file").withColumn("start", F.col("start") + F.col("base")).drop("file", "base")


def packed_ids(docs: DataFrame, vocabulary: str = VOCABULARY, end_id: int = END_ID, path: str | None = None) -> DataFrame:
    """Write the ids of every document under ``path`` (default: the shared folder) and tell of each what the files hold.

    (doc_id, start, n_tokens, ids_crc32); :func:`read_ids` gives the ids themselves.
    """
    spark = docs.sparkSession
    largest = max(Tokenizer.from_file(vocabulary).get_vocab_size() - 1, end_id)
    path = path or scratch_path(spark, "op11-files")
    write_ids(docs, path, byte_level_encoder(vocabulary, end_id), bits_for(largest))
    return place(stage(read_ids(spark, path).drop("ids"), "op11-read"))
