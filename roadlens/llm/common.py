"""What the operators of this subpackage share: appended columns, labelled samples, staged tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlens.session import scratch_path

#: Most labelled rows that a model is fitted on.
SAMPLE_ROWS = 20_000
PIECE_BYTES = 4 << 20


def pieces(batch: pa.RecordBatch, size: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``size`` bytes of its last column, a text; no row is cut.

    Small pieces keep the memory of a task even: what is sent back is as large as what is worked on.
    """
    bounds = np.concatenate(([0], np.cumsum(pc.fill_null(pc.binary_length(batch.column(batch.num_columns - 1)), 0))))
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + size, side="right")) - 1)
        yield batch.slice(lo, hi - lo)
        lo = hi


def append_columns(
    df: DataFrame,
    text_col: str,
    new: T.StructType,
    compute: Callable[[pa.Array], list[pa.Array]],
    carry: list[str] | None = None,
) -> DataFrame:
    """``df`` with columns computed from one text column, an Arrow batch at a time, without a shuffle.

    ``carry`` names the columns to keep (default: all).  A kept column that is called like a new one is
    replaced by it.
    """
    kept = [c for c in (df.columns if carry is None else carry) if c not in new.names]
    source = df.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text_col}`").cast("string").alias("__text"))
    schema = T.StructType([df.schema[c] for c in kept] + list(new.fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                n = part.num_columns - 1
                arrays = [part.column(i) for i in range(n)] + compute(part.column(n))
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return source.mapInArrow(run, schema)


def fold(doc_id: str = "doc_id"):
    """crc32 of the id as text, modulo 5; null ids give null."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, label, text) of at most ``rows`` labelled documents that are not held out; each text once.

    Labels are taken in the order of a hash of their id, so the sample is fixed, however the tables are partitioned.
    Null labels and ids take no part; of several labels for an id the smallest counts, of several texts of an
    id the one of the smallest hash, of several labels for a text the largest.  The chosen ids, at most ``rows``,
    are broadcast to the documents, which are not shuffled.
    """
    chosen = (
        labels.select(F.col("doc_id"), F.col(label).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & (fold() != 0))
        .groupBy("doc_id").agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    )
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    found = docs.select("doc_id", text.alias("text")).join(F.broadcast(chosen), "doc_id")
    one = found.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("mark"), "text", "label")).alias("one"))
    return one.groupBy("one.text").agg(F.max("one.label").alias("label"), F.min("doc_id").alias("doc_id")).select("doc_id", "label", "text")


def stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: its plan ends there, and lost executors cost a re-read."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
