"""Operator 2, sharding: vector bin packing of groups of equal texts by bytes, tokens and rows.

1. One pass gives each row its size, tokens and a hash of its text; a slim table of these is written.
2. Rows are added up by text.  A group that is large against a shard (in bytes, tokens or rows) is an item of
   its own, in several pieces of half a fair load if it exceeds a whole one; small groups are added up into a fixed number of
   buckets by a hash, a geometric series of large to tiny ones.  So there are a bounded number of items, and
   the rows of a text stay together unless the text alone is too large.
3. The items, largest first, go to the shard where the dot product of the item with the shard's residual
   capacity is highest among the shards with room; the last fifth, the smallest, evens out the bytes.
4. Each shard's rows are numbered without a gap: counted by (shard, block), numbered within a block, and
   moved up by the counts of the blocks before.  No task gets a whole shard.

Law: ``bytes``, the sizes of the shards are near equal.

Defined results: a null text has size 1 and the checksum of no bytes, 0, and is of the same group as other
nulls; null ids and rows that share an id are rows like others; extra columns are left out.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadlens.llm.common import stage

SHARDS = 16
#: Buckets of small groups: half as many hold half of the hash range, a quarter a quarter of what is left, and so on.
BUCKETS = 4096
LEVELS = 6
#: A group with more than 1 / HEAVY of a shard's fair share is an item of its own.
HEAVY = 64
#: Share of the bytes that goes to the smallest shards.
TAIL = 0.2
#: Rows that are numbered together.
BLOCK_ROWS = 50_000
DIMENSIONS = ("size", "tokens", "rows")


def place(amounts: np.ndarray, n_shards: int) -> np.ndarray:
    """Shard of each item (rows of ``amounts``: bytes, tokens, rows), by the dot product with the residual capacity.

    Everything is measured in shares of a shard's fair load.  Items are taken in descending order of their
    largest share.  A shard has room if the item's bytes fit; if none has, or when only the share TAIL of
    the bytes is left, the shard with the fewest bytes takes it, which evens out the sizes.
    """
    share = amounts / np.maximum(amounts.sum(axis=0), 1) * n_shards
    residual = np.ones((n_shards, amounts.shape[1]))
    out = np.zeros(len(amounts), dtype=np.int64)
    left = share[:, 0].sum()
    for i in np.argsort(-share.max(axis=1), kind="stable").tolist():
        fits = (residual[:, 0] >= share[i, 0]) & (left > TAIL * n_shards)
        left -= share[i, 0]
        score = np.where(fits, residual @ share[i], -np.inf)
        at = int(np.argmax(score)) if fits.any() else int(np.argmax(residual[:, 0]))
        out[i] = at
        residual[at] -= share[i]
    return out


def _bucket(h) -> F.Column:
    """Bucket of a hash: LEVELS ranges, each half as wide as the one before, cut into equally many buckets."""
    per_level = BUCKETS // LEVELS
    u = F.pmod(h, F.lit(1 << 30)) / float(1 << 30)
    level = F.least(F.floor(-F.log2(1 - u)), F.lit(LEVELS - 1)).cast("int")
    return (level * per_level + F.pmod(F.xxhash64(h), F.lit(per_level))).cast("long")


def shard_documents(docs: DataFrame, n_shards: int = SHARDS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row of ``docs`` (doc_id, text)."""
    text = F.col("text").cast("string")
    data = F.coalesce(text, F.lit("")).cast("binary")
    rows = stage(docs.select(
        "doc_id",
        (F.octet_length(data) + 1).cast("long").alias("size"),
        F.coalesce(F.regexp_count(text, F.lit(r"[^ \t-\r]+")), F.lit(0)).cast("long").alias("tokens"),
        F.crc32(data).alias("text_crc32"),
        F.xxhash64(text).alias("text_hash"),
        F.monotonically_increasing_id().alias("row"),
    ), "op2-rows")
    groups = stage(rows.groupBy("text_hash").agg(
        F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")), "op2-groups")
    total = groups.agg(*[F.coalesce(F.sum(d), F.lit(0)).alias(d) for d in DIMENSIONS]).first()
    fair = {d: max(total[d] / n_shards, 1) for d in DIMENSIONS}
    weight = F.greatest(*[F.col(d) / fair[d] for d in DIMENSIONS])
    # At most 3 * n_shards * HEAVY heavy groups and BUCKETS buckets.
    heavy = groups.where(weight * HEAVY >= 1).select("text_hash", *DIMENSIONS).orderBy("text_hash").collect()
    light = (groups.where(weight * HEAVY < 1).groupBy(_bucket(F.col("text_hash")).alias("bucket"))
             .agg(*[F.sum(d).alias(d) for d in DIMENSIONS]).orderBy("bucket").collect())
    spark = docs.sparkSession
    halves = {r["text_hash"]: int(np.ceil(max(r[d] / fair[d] for d in DIMENSIONS) * 2)) for r in heavy}
    pieces = spark.createDataFrame([(h, n) for h, n in halves.items() if n > 2], "text_hash long, pieces long")
    marked = rows.join(F.broadcast(pieces), "text_hash", "left").withColumn(
        "piece", F.pmod(F.xxhash64("row"), F.coalesce("pieces", F.lit(1))))
    cut = (marked.where("pieces IS NOT NULL").groupBy("text_hash", "piece").agg(
        F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")).collect())
    items, names = [], []
    for r in [x for x in heavy if halves[x["text_hash"]] <= 2] + sorted(cut, key=lambda x: (x["text_hash"], x["piece"])):
        items.append([r[d] for d in DIMENSIONS])
        names.append((None, r["text_hash"], r["piece"] if "piece" in r else 0))
    for r in light:
        items.append([r[d] for d in DIMENSIONS])
        names.append((r["bucket"], None, 0))
    shard = place(np.array(items, dtype=float).reshape(-1, len(DIMENSIONS)), n_shards)
    large = spark.createDataFrame([(h, p, int(s)) for (b, h, p), s in zip(names, shard, strict=True) if b is None],
                                  "text_hash long, piece long, own_shard int")
    small = spark.createDataFrame([(b, int(s)) for (b, _, _), s in zip(names, shard, strict=True) if b is not None],
                                  "bucket long, bucket_shard int")
    dealt = (
        marked.join(F.broadcast(large), ["text_hash", "piece"], "left")
        .withColumn("bucket", _bucket(F.col("text_hash")))
        .join(F.broadcast(small), "bucket", "left")
        .withColumn("shard", F.coalesce("own_shard", "bucket_shard"))
        .withColumn("block", F.pmod(F.xxhash64("row"), F.lit(max(1, -(-total["rows"] // (n_shards * block_rows)))))))
    dealt = stage(dealt.select("doc_id", "size", "text_crc32", "shard", "block", "row"), "op2-dealt")
    counts = dealt.groupBy("shard", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = F.row_number().over(Window.partitionBy("shard", "block").orderBy("row"))
    return (
        dealt.withColumn("place", within).join(starts, ["shard", "block"])
        .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                (F.col("first") + F.col("place") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard")))
