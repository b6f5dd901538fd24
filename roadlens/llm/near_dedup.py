"""Operator 6, near duplicates: b-bit MinHash, band candidates, exact confirmation.

1. Every whole text becomes its set of 5-word shingles, 96 minima, 24 band keys of four minima each, and a
   packed signature of the four low bits of each (mixed) minimum.  Equal sets collapse to one, so copies
   are never paired.
2. Sets that share a band key are candidates.  Each is compared with the smallest of its bucket by the bit
   counts of the packed signatures, corrected for chance collisions.  An estimate of TIGHT or more takes the set out of the
   bucket, because whatever links with it must then lie within LOOSE of the bucket's smallest (Jaccard distance
   obeys the triangle inequality).  The sets that remain in a bucket are compared with each other in blocks of
   bounded size.
3. Each bucket's smallest and the sets within LOOSE of it are its star.  Members are confirmed against the smallest on full
   sets.  A linked pair that is not both confirmed lies in the star, or in the bucket's remainder, and is
   estimated near the threshold; of a block of either the sets that such estimates join form a group.
4. The full sets of a group are shipped once, in blocks of bounded size, and all pairs inside are confirmed exactly:
   100 * |intersection| >= percent * |union|.  Groups reach no further than a block, so chains of sets that are
   somewhat alike are not followed.
5. The confirmed links form the components.

LOOSE follows from the threshold (:func:`loose`).  Nothing is capped: larger buckets and clusters make more
blocks.  A pair at similarity 0.85 shares no band with probability (1 - 0.85^4)^24, about 2e-8; at 0.80 about
3e-6.  Shingles are compared by 64-bit hashes.

Defined results: null, empty and blank texts have an empty set and link with nothing; rows that share an
id are one document of several texts, a link of any of them counts and all have its component; a null id takes no part in links, its
component is null and it is kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlens.llm.common import append_columns, stage
from roadlens.llm.components import components
from roadlens.llm.words import Block, blocks, keyed, mix64, weights

SHINGLE = 5
PERCENT = 85
BANDS, ROWS, BITS = 24, 4, 4
MINIMA = BANDS * ROWS
LANES = MINIMA * BITS // 64
TIGHT = 0.8
#: What LOOSE leaves for the error of an estimate, about four standard deviations.
SLACK = 0.15
BLOCK_SETS = 512
BLOCK_SHINGLES = 1_000_000
#: Up to so many ids (8 MB) are broadcast to the documents; more are joined by a shuffle.
BROADCAST_IDS = 500_000

_FACTORS = (weights(MINIMA, 1 << 41) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_SHIFTS = (weights(MINIMA, 1 << 42) >> np.uint64(32)).astype(np.uint32)
_BAND_WEIGHTS = weights(ROWS, 1 << 43)


def shingles(b: Block) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the distinct shingles of each text of a block, in the order of the texts."""
    first, hashes = b.ngrams(SHINGLE)
    docs = b.doc[first]
    n_words = b.per_doc(b.doc).astype(np.int64)
    begins = np.concatenate(([0], np.cumsum(n_words)[:-1]))
    for n in range(1, SHINGLE):  # the whole sequence of a shorter text
        short = np.flatnonzero(n_words == n)
        if len(short):
            total = np.full(len(short), np.uint64(n))
            for j, w in enumerate(weights(n, 1 << 44)):
                total += b.hash[begins[short] + j] * w
            docs, hashes = np.concatenate((docs, short)), np.concatenate((hashes, mix64(total)))
    _, at = np.unique(keyed(hashes, docs), return_index=True)
    at = at[np.argsort(docs[at], kind="stable")]
    return docs[at], hashes[at]


def _signatures(text: pa.Array) -> list[pa.Array]:
    counts, set_a, set_b, bands, lanes = [], [], [], [], []
    for b in blocks(text, lower=True):
        docs, hashes = shingles(b)
        n = b.per_doc(docs).astype(np.int64)
        full = np.flatnonzero(n)
        begins = np.searchsorted(docs, full)
        one_a, one_b = np.zeros(b.n_docs, dtype=np.uint64), np.zeros(b.n_docs, dtype=np.uint64)
        minima = np.zeros((b.n_docs, MINIMA), dtype=np.uint32)
        if len(full):
            one_a[full] = np.add.reduceat(mix64(hashes + np.uint64(1)), begins)
            one_b[full] = np.add.reduceat(mix64(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5)), begins)
            narrow = (hashes >> np.uint64(32)).astype(np.uint32)
            for k in range(MINIMA):
                minima[full, k] = np.minimum.reduceat(narrow * _FACTORS[k] + _SHIFTS[k], begins)
        rows = minima.reshape(b.n_docs, BANDS, ROWS).astype(np.uint64)
        bands.append(mix64((rows * _BAND_WEIGHTS).sum(axis=2, dtype=np.uint64)
                           + np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
        low = ((minima * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)).astype(np.uint64)
        low = low.reshape(b.n_docs, LANES, 64 // BITS) << (np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS))
        lanes.append(np.bitwise_or.reduce(low, axis=2))
        counts.append(n), set_a.append(one_a), set_b.append(one_b)
    if not counts:
        return [pa.array([], t) for t in (pa.int64(), pa.int64(), pa.int64(), *[pa.int64()] * LANES, pa.list_(pa.int64()))]
    number = lambda parts: pa.array(np.concatenate(parts).view(np.int64))
    lane = np.concatenate(lanes).view(np.int64)
    keys = np.concatenate(bands).view(np.int64)
    listed = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, BANDS), pa.int32()), pa.array(keys.reshape(-1)))
    return [number(counts), number(set_a), number(set_b), *[pa.array(lane[:, i]) for i in range(LANES)], listed]


_LANE = [f"lane{i}" for i in range(LANES)]
_SIGNATURE = T.StructType(
    [T.StructField(c, T.LongType()) for c in ("n_shingles", "set_a", "set_b", *_LANE)]
    + [T.StructField("bands", T.ArrayType(T.LongType()))])


def loose(percent: int) -> float:
    """Least estimate of a candidate edge.

    Estimated distances obey the triangle inequality too: what links with a set that lies within 1 - TIGHT
    of a bucket's smallest is estimated within (1 - TIGHT) + (1 - percent / 100) of it, but for SLACK.
    """
    return TIGHT - (1 - percent / 100) - SLACK


def estimate(left: list, right: list):
    """Similarity from two packed signatures (lists of long columns): bit counts, corrected for chance."""
    differ = F.lit(0)
    ones = F.lit(0x1111111111111111)
    for a, b in zip(left, right, strict=True):
        x = a.bitwiseXOR(b)
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        differ = differ + F.bit_count(x.bitwiseAND(ones))
    chance = 1 / (1 << BITS)
    return ((1 - differ / F.lit(MINIMA)) - chance) / (1 - chance)


def _estimates(lanes: np.ndarray) -> np.ndarray:
    """:func:`estimate` of all pairs of the rows (n, LANES)."""
    differ = np.zeros((len(lanes), len(lanes)), dtype=np.uint16)
    for i in range(LANES):
        x = lanes[:, None, i] ^ lanes[None, :, i]
        x |= x >> np.uint64(1)
        x |= x >> np.uint64(2)
        differ += np.bitwise_count(x & np.uint64(0x1111111111111111))
    chance = 1 / (1 << BITS)
    return ((1 - differ / MINIMA) - chance) / (1 - chance)


def _forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of a symmetric boolean matrix: as few edges as keep its components."""
    waiting = np.ones(len(linked), dtype=bool)
    edges = []
    for root in range(len(linked)):
        if not waiting[root]:
            continue
        waiting[root] = False
        queue = [root]
        while queue:
            at = queue.pop()
            found = np.flatnonzero(linked[at] & waiting)
            waiting[found] = False
            edges += [(at, int(x)) for x in found]
            queue += found.tolist()
    return edges


def _by_group(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[pa.Table]:
    """Cut a stream that is sorted by its first columns into a table for each key."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(n_keys)], axis=1)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        bounds = [0, *cuts.tolist(), batch.num_rows]
        for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
            part = batch.slice(lo, hi - lo)
            if held and any(held[0].column(i)[0] != part.column(i)[0] for i in range(n_keys)):
                yield pa.Table.from_batches(held)
                held = []
            held.append(part)
    if held:
        yield pa.Table.from_batches(held)


def _in_blocks(df: DataFrame, group: str, member: str, n_blocks) -> DataFrame:
    """Each row once for each block (two chunks i <= j of its group) it belongs to.

    Groups of one chunk have one block.  Any two members of a group meet in at least one block.
    """
    dealt = df.withColumn("__n", n_blocks.cast("int")).withColumn("__c", F.pmod(F.xxhash64(member), F.col("__n")).cast("int"))
    other = F.explode(F.when(F.col("__n") <= 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("__n") - 1)))
    return dealt.withColumn("__o", other).withColumn("bi", F.least("__c", "__o")).withColumn("bj", F.greatest("__c", "__o")).drop("__n", "__c", "__o")


def _near_groups(batches: Iterator[pa.RecordBatch], near: float) -> Iterator[pa.RecordBatch]:
    """(grp, set_id): in each block the sets that estimates of ``near`` or more join.

    Pairs that are both confirmed already are passed over.  A group is called by its members, so blocks that find the
    same one agree.
    """
    for t in _by_group(batches, 3):
        ids = t.column("set_id").to_numpy()
        lanes = np.stack([t.column(c).to_numpy() for c in _LANE], axis=1).view(np.uint64)
        linked = _estimates(lanes) >= near
        confirmed = t.column("confirmed").to_numpy(zero_copy_only=False).astype(bool)
        linked[np.ix_(confirmed, confirmed)] = False
        of = np.arange(len(ids))
        for a, b in _forest(linked):  # a root comes before its tree
            of[b] = of[a]
        order = np.argsort(of, kind="stable")
        heads = np.flatnonzero(np.concatenate(([True], np.diff(of[order]) != 0)))
        size = np.diff(np.append(heads, len(ids)))
        name = np.add.reduceat(mix64(ids[order].view(np.uint64) + np.uint64(0x632BE59BD9B4E019)), heads)
        several = np.repeat(size > 1, size)
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(mix64(name), size)[several].view(np.int64)), pa.array(ids[order][several])],
                                         names=["grp", "set_id"])


def _star_links(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """(rep, set_id, linked): the members of each block of a star against its smallest set."""
    for t in _by_group(batches, 2):
        ids, is_rep = t.column("set_id").to_numpy(), t.column("is_rep").to_numpy(zero_copy_only=False).astype(bool)
        sets = [np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in t.column("hashes")]
        own = np.sort(sets[int(np.flatnonzero(is_rep)[0])])
        members = np.flatnonzero(~is_rep)
        linked = []
        for i in members.tolist():
            at = np.minimum(np.searchsorted(own, sets[i]), len(own) - 1)
            both = int((own[at] == sets[i]).sum())
            linked.append(100 * both >= percent * (len(own) + len(sets[i]) - both))
        yield pa.RecordBatch.from_arrays([pa.repeat(t.column(0)[0], len(members)), pa.array(ids[members]), pa.array(linked, pa.bool_())],
                                         names=["rep", "set_id", "linked"])


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections of sorted arrays of distinct hashes."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    column = column.reshape(-1)
    shared = often[column] > 1  # only a hash of two sets or more adds to an intersection
    renumber = np.cumsum(often > 1) - 1
    owner, column = owner[shared], renumber[column[shared]]
    out = np.zeros((len(sets), len(sets)), dtype=np.float32)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        i, j = np.searchsorted(column, (lo, lo + 4096))
        incidence = np.zeros((len(sets), 4096), dtype=np.float32)
        incidence[owner[i:j], column[i:j] - lo] = 1
        out += incidence @ incidence.T
    return out.astype(np.int64)


def _exact_links(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Links confirmed on full sets in each block of a cluster, thinned to a spanning forest."""
    for t in _by_group(batches, 3):
        ids = t.column("set_id").to_numpy()
        sets = [np.frombuffer(x.as_py(), dtype=np.uint64) for x in t.column("hashes")]
        size = np.array([len(s) for s in sets])
        both = overlaps(sets)
        linked = 100 * both >= percent * (size[:, None] + size[None, :] - both)
        edges = np.array(_forest(linked), dtype=np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(ids[edges[:, 0]]), pa.array(ids[edges[:, 1]])], names=["a", "b"])


def _sets_of(text: pa.Array) -> list[pa.Array]:
    out = []
    for b in blocks(text, lower=True):
        docs, hashes = shingles(b)
        cuts = np.searchsorted(docs, np.arange(b.n_docs + 1))
        out += [hashes[lo:hi].tobytes() for lo, hi in zip(cuts[:-1], cuts[1:], strict=True)]
    return [pa.array(out, pa.binary())]


def _stars(sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stars (rep, set_id, alike, lanes) and remainders (key, n, set_id, lanes) of the buckets of several sets."""
    rows = sets.select("set_id", F.explode("bands").alias("key"))
    buckets = stage(rows.groupBy("key").agg(F.min("set_id").alias("rep"), F.count("*").alias("n")).where("n > 1"),
                    "op6-buckets")
    members = stage(rows.join(buckets, "key").where("set_id != rep").select("key", "rep", "set_id"), "op6-members")
    lanes = sets.select("set_id", *_LANE)
    rep_lanes = sets.select(F.col("set_id").alias("rep"), *[F.col(c).alias(f"rep_{c}") for c in _LANE])
    star = stage(
        members.select("rep", "set_id").distinct().join(lanes, "set_id").join(rep_lanes, "rep")
        .select("rep", "set_id",
                estimate([F.col(c) for c in _LANE], [F.col(f"rep_{c}") for c in _LANE]).alias("alike"), *_LANE),
        "op6-star")
    rest = stage(members.join(star, ["rep", "set_id"]).where(F.col("alike") < TIGHT).select("key", "set_id", *_LANE),
                 "op6-rest")
    # A written table, so that the join reads both shuffles directly and can split a hot bucket.
    often = stage(rest.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "op6-often")
    return star, rest.join(often, "key")


def _in_groups(df: DataFrame, key: str, near: float) -> DataFrame:
    """:func:`_near_groups` of ``df`` (key, n, set_id, lanes, confirmed) by key, in blocks."""
    dealt = _in_blocks(df, key, "set_id", F.ceil(F.col("n") / BLOCK_SETS)).select(key, "bi", "bj", "set_id", "confirmed", *_LANE)
    return (dealt.repartition(key, "bi", "bj").sortWithinPartitions(key, "bi", "bj")
            .mapInArrow(lambda batches: _near_groups(batches, near), "grp long, set_id long"))


def _full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(set_id, hashes) of the wanted sets."""
    wanted = stage(wanted.distinct(), "op6-wanted")
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    texts = docs.select(F.col("doc_id").alias("set_id"), F.col("text").cast("string").alias("text")).join(wanted, "set_id")
    schema = T.StructType([T.StructField("hashes", T.BinaryType())])
    return stage(append_columns(texts, "text", schema, _sets_of, ["set_id"]), "op6-full")


def _confirmed(docs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Exact links (a, b), enough to connect all that ``percent`` links."""
    near, least = percent / 100 - SLACK, loose(percent)
    star, rest = _stars(sets)
    star = star.where(F.col("alike") >= least)
    apart = stage(_in_groups(rest.withColumn("confirmed", F.lit(False)), "key", near).distinct(), "op6-apart")
    full = _full_sets(docs, star.select("set_id").unionByName(star.select(F.col("rep").alias("set_id"))).unionByName(apart.select("set_id")))

    # members against the smallest of their star, which every block of a star gets
    checked = star.where(F.col("alike") >= near).select("rep", "set_id").join(sets.select("set_id", "n_shingles"), "set_id")
    sizes = stage(checked.groupBy("rep").agg(F.ceil(F.greatest(F.count("*") / BLOCK_SETS, F.sum("n_shingles") / BLOCK_SHINGLES))
                                             .cast("int").alias("parts")), "op6-sizes")
    members = (star.where(F.col("alike") >= near).select("rep", "set_id").join(sizes, "rep")
               .withColumn("part", F.pmod(F.xxhash64("set_id"), F.col("parts")).cast("int")).join(full, "set_id")
               .select("rep", "part", F.lit(False).alias("is_rep"), "set_id", "hashes"))
    reps = (sizes.select(F.col("rep").alias("set_id"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")).join(full, "set_id")
            .select(F.col("set_id").alias("rep"), "part", F.lit(True).alias("is_rep"), "set_id", "hashes"))
    links = stage(members.unionByName(reps).repartition("rep", "part").sortWithinPartitions("rep", "part")
                  .mapInArrow(lambda batches: _star_links(batches, percent), "rep long, set_id long, linked boolean"), "op6-starred")

    # stars that are not confirmed whole: what else is near the threshold there
    marked = stage(star.join(links.where("linked"), ["rep", "set_id"], "left")
                   .withColumn("confirmed", F.coalesce("linked", F.lit(False))).drop("linked", "alike"), "op6-marked")
    open_stars = stage(marked.groupBy("rep").agg(F.count("*").alias("n"), F.count_if(~F.col("confirmed")).alias("u"))
                       .where("u > 0 AND n > 1").select("rep", "n"), "op6-open")
    within = _in_groups(marked.join(open_stars, "rep"), "rep", near)
    groups = stage(apart.unionByName(within).distinct(), "op6-groups")
    totals = stage(groups.join(sets.select("set_id", "n_shingles"), "set_id").groupBy("grp")
                   .agg(F.ceil(F.greatest(F.count("*") / BLOCK_SETS, F.sum("n_shingles") / BLOCK_SHINGLES)).alias("parts")), "op6-totals")
    dealt = _in_blocks(groups.join(totals, "grp").join(full, "set_id"), "grp", "set_id", F.col("parts"))
    exact = (dealt.select("grp", "bi", "bj", "set_id", "hashes").repartition("grp", "bi", "bj").sortWithinPartitions("grp", "bi", "bj")
             .mapInArrow(lambda batches: _exact_links(batches, percent), "a long, b long"))
    return links.where("linked").select(F.col("rep").alias("a"), F.col("set_id").alias("b")).unionByName(exact)


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs`` (doc_id, text); links from ``percent`` on.

    Rows of one id are one document: they have one component, whatever their texts.
    """
    repeated = docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1")
    if not repeated.limit(1).count():
        return _of_unique_ids(docs, percent)
    # Rows get numbers, and are compared under those; the rows of one id are linked as well.
    rows = stage(docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row")), "op6-rows")
    known = rows.where("doc_id IS NOT NULL")
    alike = _of_unique_ids(known.select(F.col("row").alias("doc_id"), "text"), percent)
    found = stage(alike.select(F.col("doc_id").alias("row"), "n_shingles", F.col("component_id").alias("linked"))
                  .join(known.select("row", "doc_id"), "row"), "op6-found")
    first = stage(found.groupBy("doc_id").agg(F.min("row").alias("first"), F.count("*").alias("n")).where("n > 1"), "op6-first")
    edges = found.select(F.col("row").alias("a"), F.col("linked").alias("b")).unionByName(
        found.join(first, "doc_id").select(F.col("row").alias("a"), F.col("first").alias("b")))
    group = components(edges)
    named = stage(found.join(group, found["row"] == group["node"], "left")
                  .select("doc_id", "n_shingles", F.coalesce("component", "row").alias("grp")), "op6-named")
    least = stage(named.groupBy("grp").agg(F.min("doc_id").alias("component_id")), "op6-least")
    out = named.join(least, "grp").select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))
    return out.unionByName(_of_unique_ids(rows.where("doc_id IS NULL").select("doc_id", "text"), percent))


def _of_unique_ids(docs: DataFrame, percent: int) -> DataFrame:
    """:func:`near_duplicates` of rows of which no two share an id."""
    signed = stage(append_columns(docs.select("doc_id", "text"), "text", _SIGNATURE, _signatures, ["doc_id"]), "op6-signed")
    some = signed.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    # Equal sets have equal signatures and bands, so any of them will do.
    key = ["set_a", "set_b", "n_shingles"]
    sets = stage(
        some.groupBy(*key).agg(
            F.min("doc_id").alias("set_id"), *[F.min(c).alias(c) for c in _LANE], F.first("bands").alias("bands")),
        "op6-sets")
    found = components(_confirmed(docs, sets, percent))
    named = stage(
        sets.join(found, sets["set_id"] == found["node"], "left")
        .select(*key, F.coalesce("component", "set_id").alias("component_id")), "op6-named")
    out = signed.select("doc_id", *key).join(named, key, "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None).cast("long")).otherwise(F.coalesce("component_id", "doc_id"))
    return (out.withColumn("component_id", component)
            .select("doc_id", "n_shingles", "component_id",
                    F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")))
