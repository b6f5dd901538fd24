"""Topics learnt from the texts: centroids of hashed terms.

A text is a vector of BUCKETS: how often words of each hash bucket occur (their root), weighted by how few texts
have the bucket, of length one.  Spherical k-means over all texts gives the centroids; every text has the topic
of the centroid that points most nearly its way.  Topics are called ``t0``, ``t1``, ... from the largest down.

The texts are counted once and their counts staged; each draw of a first centre and each step of the k-means is one
pass over them.  Tasks add up whole numbers, Spark adds up the tasks', and the driver gets (TOPICS, BUCKETS) sums: the
same however the table is partitioned.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlens.llm.common import append_columns, stage
from roadlens.llm.words import blocks
from roadlens.session import Scratch

TOPICS, BUCKETS, STEPS = 8, 256, 25
#: Topic of a text without words.
NONE = "none"
#: Components are added up as whole numbers of 1 / SCALE.
SCALE = 1 << 26
#: Vectors worked on at once, and the distance from a centre below which a text is that centre.
ROWS, SAME = 1024, 1e-9


def term_counts(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(words, BUCKETS root counts) of each text."""
    words, rows = [np.zeros(0, dtype=np.int64)], [np.zeros((0, BUCKETS))]
    for b in blocks(text, lower=True):
        bucket = (b.hash >> np.uint64(40)).astype(np.int64) % BUCKETS
        rows.append(np.sqrt(np.bincount(b.doc * BUCKETS + bucket, minlength=b.n_docs * BUCKETS)).reshape(b.n_docs, BUCKETS))
        words.append(b.per_doc(b.doc).astype(np.int64))
    return np.concatenate(words), np.concatenate(rows)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-12)


@dataclass
class Topics:
    rarity: np.ndarray
    centroids: np.ndarray

    def of(self, text: pa.Array) -> tuple[np.ndarray, list[str]]:
        """(words, topic) of each text."""
        words, counts = term_counts(text)
        if not len(self.centroids):
            return words, ["t0" if n else NONE for n in words]
        best = (_unit(counts * self.rarity) @ self.centroids.T).argmax(axis=1)
        return words, [f"t{t}" if n else NONE for t, n in zip(best.tolist(), words.tolist(), strict=True)]


def _counted(docs: DataFrame, sample: int | None) -> DataFrame:
    """(draw, counts) of the texts with words: a hash of id and text, and the root counts as 32-bit floats."""
    draw = F.pmod(F.xxhash64(F.lit("topics"), "doc_id", "text"), F.lit(1 << 52))
    some = docs.select(F.col("text").cast("string").alias("text"), draw.alias("draw"))
    if sample is not None:
        total = some.where(F.length(F.trim("text")) > 0).count()
        some = some.where(F.col("draw") < int((1 << 52) * min(1.0, sample / max(total, 1))))

    def compute(text: pa.Array) -> list[pa.Array]:
        words, counts = term_counts(text)
        return [pa.array([row.tobytes() if n else None for n, row in zip(words.tolist(), counts.astype("<f4"), strict=True)], pa.binary())]

    schema = T.StructType([T.StructField("counts", T.BinaryType())])
    return append_columns(some, "text", schema, compute, ["draw"]).where("counts IS NOT NULL")


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """The batches in parts of ROWS, with their counts."""
    for batch in batches:
        for lo in range(0, batch.num_rows, ROWS):
            part = batch.slice(lo, ROWS)
            yield part, np.frombuffer(b"".join(part.column("counts").to_pylist()), "<f4").reshape(-1, BUCKETS).astype(float)


def _total(counted: DataFrame, shape: tuple[int, int], sums: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The whole numbers ``sums(counts)`` of all texts, added up."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(shape, dtype=np.int64)
        for _, counts in _parts(batches):
            out += sums(counts)
        at = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(out.ravel()[at])], names=["at", "n"])

    out = np.zeros(shape, dtype=np.int64)
    for at, n in counted.select("counts").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n")).collect():
        out.ravel()[at] = n
    return out


def _rarity(counted: DataFrame) -> np.ndarray:
    """Weight of each bucket by the number of texts that have it, of all."""
    found = _total(counted, (1, BUCKETS + 1), lambda counts: np.append((counts > 0).sum(axis=0), len(counts))[None])[0]
    return np.log((found[BUCKETS] + 1) / (found[:BUCKETS] + 1)) + 0.1


def _another(counted: DataFrame, rarity: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """A text (one row, or none) drawn with the odds of its distance from the nearest of ``centres``.

    That is the first in a race of times -log(u) / distance, where u is a hash of the text and the number of centres.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, counts in _parts(batches):
            x = _unit(counts * rarity)
            apart = 1 - (x @ centres.T).max(axis=1) if len(centres) else np.ones(len(x))
            time = np.where(apart > SAME, -np.log(part.column("u").to_numpy()) / np.maximum(apart, SAME), np.inf)
            best = int(time.argmin())
            if time[best] < np.inf:
                yield pa.RecordBatch.from_arrays([pa.array(time[best:best + 1]), part.column("counts").slice(best, 1)], names=["time", "counts"])

    u = (F.pmod(F.xxhash64("draw", F.lit(len(centres))), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    first = counted.select("counts", u.alias("u")).mapInArrow(run, "time double, counts binary").orderBy("time", "counts").limit(1).collect()
    return _unit(np.array([np.frombuffer(r["counts"], "<f4") for r in first], dtype=float).reshape(-1, BUCKETS) * rarity)


def _centroids(counted: DataFrame, rarity: np.ndarray, topics: int) -> np.ndarray:
    """Spherical k-means: first centres far apart, then averages; the largest first."""
    centres = np.zeros((0, BUCKETS))
    while len(centres) < topics:
        another = _another(counted, rarity, centres)
        if not len(another):
            break
        centres = np.concatenate((centres, another))
    if not len(centres):
        return centres

    def sums(counts: np.ndarray) -> np.ndarray:
        x = _unit(counts * rarity)
        own = (x @ centres.T).argmax(axis=1) == np.arange(len(centres))[:, None]
        # whole numbers below 2 ** 53, so their sums are exact
        return np.column_stack((own.astype(float) @ np.rint(x * SCALE), own.sum(axis=1))).astype(np.int64)

    total = np.zeros((len(centres), BUCKETS + 1), dtype=np.int64)
    for _ in range(STEPS):
        total, before = _total(counted, total.shape, sums), total
        if (total == before).all():
            break
        centres = np.where(total[:, BUCKETS:] > 0, _unit(total[:, :BUCKETS].astype(float)), centres)
    return centres[np.argsort(-total[:, BUCKETS], kind="stable")]


def fit_topics(docs: DataFrame, topics: int = TOPICS, sample: int | None = None) -> Topics:
    """Topics of ``docs`` (doc_id, text), from all texts with words; with ``sample``, from about so many by a hash of id and text."""
    with Scratch(docs.sparkSession):
        counted = stage(_counted(docs, sample), "topic-counts")
        rarity = _rarity(counted)
        return Topics(rarity, _centroids(counted, rarity, topics))
