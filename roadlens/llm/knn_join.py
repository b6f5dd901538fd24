"""Operator 1, exact top-k search: a Voronoi kNN join for the largest inner product.

Vectors become whole numbers, floor(256 * x).

1. Pivots are candidates in the order of a hash of their id, about the root of their number (and one of each other vector
   length).  Every vector goes to the cell of its nearest pivot.
2. Each cell is summarised by its candidates' distances from the pivot: how many there are, the smallest few, and
   quantiles.
3. For a query q and a candidate x at distance d from its pivot p, q.x lies within |q| d of q.p.  So the smallest
   distances of all cells give a score that k candidates reach, and each cell a distance below which no
   candidate can reach it; a group of queries needs of a cell the candidates from the smallest such distance on.
4. Cells of queries that lie near each other form a group if sending their candidates together costs less than
   apart: shipping a candidate to a group weighs as much as PAIRS of its products with queries.
5. A group's candidates are dealt to parts of bounded size; each part meets the group's queries in one task
   and returns k of each; the best k of these remain.

Only the summaries come to the driver: a few numbers for each of at most PIVOTS cells, and one for each pair of them.
Scores are exact integers; bounds allow for rounding.

Defined results: vectors that are null or hold null or non-finite components, or components that are no long when
scaled, take no part, nor do null ids.  Vectors are compared with those of their own length (an empty one scores 0).
A score beyond a long is the largest or smallest long.  Rows with the query's id are the query's own.  Equal query
rows are one query; equal candidate rows are each a candidate.  With no candidates there are no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadlens.llm.common import stage

#: At most so many cells (plus one of each further vector length).
PIVOTS = 256
GROUP_QUERIES = 4096
PART_ROWS = 16384
#: Candidates nearest to the pivot that a cell's summary holds beyond k; rows of the query's own id may be among them.
OWN = 8
QUANTILES = 32
#: Products that cost as much as sending a candidate.
PAIRS = 32
#: Relative allowance for rounding in distances.
SLACK = 1e-9


def scaled(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = 256) -> DataFrame:
    """(vec_id, v): whole-number vectors of the rows that take part."""
    column = F.col(embedding)
    fine = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * scale) < float(1 << 63)))
    return (vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("__e"))
            .withColumnRenamed("__e", embedding)
            .where(F.col("vec_id").isNotNull() & column.isNotNull() & F.coalesce(fine, F.lit(False)))
            .select("vec_id", F.transform(column, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v")))


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), len(flat) // max(len(column), 1)).astype(np.int64, copy=False)


def _by_length(batch: pa.RecordBatch, at: int) -> Iterator[pa.RecordBatch]:
    lengths = np.diff(batch.column(at).offsets.to_numpy())
    for n in np.unique(lengths):
        yield batch.filter(pa.array(lengths == n))


def products(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Inner products of all rows, exact: in floating point, longs or Python integers, by what their size needs."""
    largest = int(np.abs(queries).max(initial=0)) * int(np.abs(candidates).max(initial=0)) * queries.shape[1]
    if largest < 1 << 53:
        return (queries.astype(np.float64) @ candidates.astype(np.float64).T).astype(np.int64)
    if largest < 1 << 63:
        return queries @ candidates.T
    exact = queries.astype(object) @ candidates.T.astype(object)
    return np.clip(exact, -(1 << 63), (1 << 63) - 1).astype(np.int64)


class Cells:
    """Pivots of each vector length."""

    def __init__(self, pivots: list[list[int]]) -> None:
        self.of: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for number, v in enumerate(pivots):
            numbers, rows = self.of.setdefault(len(v), ([], []))
            numbers.append(number), rows.append(v)
        self.of = {n: (np.array(numbers), np.array(rows, dtype=float).reshape(len(rows), n)) for n, (numbers, rows) in self.of.items()}

    def nearest(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cell, distance) of each row; cell -1 where no pivot has this length."""
        if v.shape[1] not in self.of:
            return np.full(len(v), -1), np.zeros(len(v))
        numbers, pivots = self.of[v.shape[1]]
        x = v.astype(float)
        at = ((pivots * pivots).sum(axis=1)[None, :] - 2 * x @ pivots.T).argmin(axis=1)
        return numbers[at], np.sqrt(((x - pivots[at]) ** 2).sum(axis=1))


def _assign(rows: DataFrame, cells: Cells) -> DataFrame:
    """``rows`` (vec_id, v, ...) with ``cell`` and ``distance``."""
    more = [f for f in rows.schema if f.name not in ("vec_id", "v")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for same in _by_length(batch, 1):
                cell, distance = cells.nearest(_matrix(same.column(1)))
                yield pa.RecordBatch.from_arrays([*same.columns, pa.array(cell, pa.int32()), pa.array(distance)],
                                                 names=[*same.schema.names, "cell", "distance"])

    kept = "".join(f", {f.name} {f.dataType.simpleString()}" for f in more)
    return rows.mapInArrow(run, f"vec_id long, v array<bigint>{kept}, cell int, distance double").where("cell >= 0")


def _needs(asked: DataFrame, cells: Cells, nearest: dict[int, list[float]], k: int) -> DataFrame:
    """(query_cell, cell, need, n): from which distance on a cell's candidates matter to the queries of a cell, and how many those are.

    ``own`` are the rows of a query's own id, which the summaries may count.
    """
    known = {length: (numbers, pivots, np.array([(nearest.get(int(c), []) + [np.inf] * (k + OWN))[:k + OWN] for c in numbers]))
             for length, (numbers, pivots) in cells.of.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for same in _by_length(batch, 1):
                q = _matrix(same.column(1)).astype(float)
                numbers, pivots, near = known[q.shape[1]]
                own, at = same.column(2).to_numpy(), same.column(3).to_numpy()
                for lo in range(0, len(q), 256):
                    x, m = q[lo:lo + 256], own[lo:lo + 256]
                    norm, dots = np.sqrt((x * x).sum(axis=1)), x @ pivots.T
                    with np.errstate(invalid="ignore"):
                        reached = dots[:, :, None] - norm[:, None, None] * near[None]
                    reached = np.sort(np.where(np.isfinite(near)[None], reached, -np.inf).reshape(len(x), -1), axis=1)[:, ::-1]
                    kth = np.where(m <= OWN, reached[np.arange(len(x)), np.minimum(k + m, reached.shape[1]) - 1], -np.inf)
                    kth[reached.shape[1] < k + m] = -np.inf
                    room = SLACK * (1 + np.abs(dots) + np.abs(np.where(np.isfinite(kth), kth, 0))[:, None])
                    with np.errstate(divide="ignore", invalid="ignore"):
                        need = (kth[:, None] - dots - room) / norm[:, None]
                    need = np.where((norm > 0)[:, None] & np.isfinite(need), need * (1 - np.sign(need) * SLACK), -np.inf)
                    for cell in np.unique(at[lo:lo + 256]):
                        mine = at[lo:lo + 256] == cell
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(numbers), cell), pa.int32()), pa.array(numbers, pa.int32()), pa.array(need[mine].min(axis=0)),
                             pa.array(np.full(len(numbers), mine.sum()), pa.int64())], names=["query_cell", "cell", "need", "n"])

    found = asked.select("vec_id", "v", "own", "cell").mapInArrow(run, "query_cell int, cell int, need double, n long")
    return found.groupBy("query_cell", "cell").agg(F.min("need").alias("need"), F.sum("n").alias("n"))


class _Group:
    """Query cells whose candidates are sent together; ``need`` by candidate cell."""

    def __init__(self, cells: list[int], queries: int, need: np.ndarray, sent) -> None:
        self.cells, self.queries, self.need = cells, queries, need
        self.sent = sent(need)
        self.cost = self.sent * (PAIRS + queries)

    def with_(self, other: _Group, sent) -> _Group:
        return _Group(self.cells + other.cells, self.queries + other.queries, np.minimum(self.need, other.need), sent)


def _grouped(pivots: np.ndarray, need: dict[int, np.ndarray], queries: dict[int, int], sent, most: int) -> list[_Group]:
    """Groups of query cells (by their place among ``pivots``): neighbours on a chain of near pivots are joined while that saves."""
    waiting, chain = set(need), []
    while waiting:
        at = min(waiting) if not chain else min(waiting, key=lambda i: (((pivots[i] - pivots[chain[-1]]) ** 2).sum(), i))
        waiting.remove(at)
        chain.append(at)
    groups = [_Group([i], queries[i], need[i], sent) for i in chain]
    while True:
        joined, at = [], 0
        while at < len(groups):
            if at + 1 < len(groups) and groups[at].queries + groups[at + 1].queries <= most:
                both = groups[at].with_(groups[at + 1], sent)
                if both.cost <= groups[at].cost + groups[at + 1].cost:
                    joined.append(both)
                    at += 2
                    continue
            joined.append(groups[at])
            at += 1
        if len(joined) == len(groups):
            return groups
        groups = joined


def _local(k: int):
    """Best k candidates of each query of a group within one part."""

    def run(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        names = ["query_key", "query_id", "vec_id", "score"]
        if not queries.num_rows or not candidates.num_rows:
            return pa.table({n: pa.array([], pa.int64()) for n in names})
        ids = candidates.column("vec_id").to_numpy()
        order = np.argsort(ids, kind="stable")  # so equal scores keep the smaller id first
        ids, theirs = ids[order], _matrix(candidates.column("v").combine_chunks())[order]
        keys, own = queries.column("query_key").to_numpy(), queries.column("query_id").to_numpy()
        mine = _matrix(queries.column("v").combine_chunks())
        out = []
        for lo in range(0, len(mine), 256):
            score = products(mine[lo:lo + 256], theirs)
            for i, row in enumerate(score):
                # all at least as good as the best few (a query's own rows included), then in order
                skip = np.searchsorted(ids, (own[lo + i], own[lo + i] + 1))
                few = min(len(row), k + int(skip[1] - skip[0]))
                least = np.partition(row, len(row) - few)[len(row) - few]
                good = np.flatnonzero(row >= least)
                good = good[ids[good] != own[lo + i]]
                good = good[np.argsort(-row[good], kind="stable")][:k]
                out.append((np.full(len(good), keys[lo + i]), np.full(len(good), own[lo + i]), ids[good], row[good]))
        return pa.table({n: pa.array(np.concatenate([o[j] for o in out]), pa.int64()) for j, n in enumerate(names)})

    return run


def exchanged(vectors: DataFrame, queries: DataFrame, k: int, n_pivots: int | None = None, group_queries: int = GROUP_QUERIES,
              part_rows: int = PART_ROWS) -> tuple[DataFrame, DataFrame] | None:
    """What meets: queries (grp, part, query_id, query_key, v) and candidates (grp, part, vec_id, v); None without candidates or queries."""
    candidates = stage(vectors, "op1-vectors")
    total = candidates.count()
    n_pivots = n_pivots or min(PIVOTS, math.isqrt(total) + 1)
    chosen = candidates.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(n_pivots).select("v").collect()
    lengths = {len(r["v"]) for r in chosen}
    chosen += [r for r in candidates.groupBy(F.size("v").alias("n")).agg(F.min("v").alias("v"))
               .where(~F.col("n").isin(*lengths) if lengths else F.lit(True)).collect()]
    cells = Cells(list({tuple(r["v"]): list(r["v"]) for r in chosen}.values()))
    data = stage(_assign(candidates, cells), "op1-cells")
    repeated = candidates.groupBy("vec_id").agg(F.count("*").alias("own")).where("own > 1")
    asked = queries.distinct().join(repeated, "vec_id", "left").select("vec_id", "v", F.coalesce("own", F.lit(1)).alias("own"))
    asked = stage(_assign(asked, cells), "op1-asked")

    # Summaries: a row for each cell, at most k + OWN distances, and a row for each pair of cells.
    rank = F.row_number().over(Window.partitionBy("cell").orderBy("distance"))
    nearest: dict[int, list[float]] = {}
    for r in data.select("cell", "distance").withColumn("i", rank).where(F.col("i") <= k + OWN).orderBy("cell", "i").collect():
        nearest.setdefault(r["cell"], []).append(r["distance"])
    steps = F.percentile_approx("distance", [i / QUANTILES for i in range(QUANTILES + 1)], 1000).alias("steps")
    about = {r["cell"]: (r["n"], np.array(r["steps"])) for r in data.groupBy("cell").agg(F.count("*").alias("n"), steps).collect()}
    pairs = _needs(asked, cells, nearest, k).collect()
    needs, goes, groups = [], [], 0
    for numbers, pivots in cells.of.values():
        place = {int(c): i for i, c in enumerate(numbers)}
        need: dict[int, np.ndarray] = {}
        n_queries: dict[int, int] = {}
        for r in pairs:
            if r["query_cell"] in place:
                need.setdefault(place[r["query_cell"]], np.full(len(numbers), np.inf))[place[r["cell"]]] = r["need"]
                n_queries[place[r["query_cell"]]] = r["n"]
        sizes = np.array([about[int(c)][0] if int(c) in about else 0 for c in numbers])
        by_step = np.array([about[int(c)][1] if int(c) in about else np.zeros(QUANTILES + 1) for c in numbers])

        def sent(need: np.ndarray, sizes=sizes, by_step=by_step) -> float:
            """About how many candidates are needed: those of the quantiles above."""
            return float((sizes * (by_step >= need[:, None]).mean(axis=1)).sum())

        for group in _grouped(pivots, need, n_queries, sent, group_queries):
            parts, splits = max(1, math.ceil(group.sent / part_rows)), max(1, -(-group.queries // group_queries))
            needs += [(int(numbers[i]), groups, float(group.need[i]), parts, splits) for i in range(len(numbers)) if sizes[i]]
            goes += [(int(numbers[i]), groups, parts, splits) for i in group.cells]
            groups += splits
    if not needs:
        return None
    spark = vectors.sparkSession
    needs = spark.createDataFrame(needs, "cell int, base int, need double, parts int, splits int")
    goes = spark.createDataFrame(goes, "cell int, base int, parts int, splits int")
    left = (
        asked.select("vec_id", "v", "cell").join(F.broadcast(goes), "cell")
        .select((F.col("base") + F.pmod(F.xxhash64("vec_id", "v"), F.col("splits"))).cast("int").alias("grp"),
                F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("vec_id").alias("query_id"),
                F.xxhash64("vec_id", "v").alias("query_key"), "v"))
    right = (
        data.withColumn("row", F.monotonically_increasing_id()).join(F.broadcast(needs), "cell").where(F.col("distance") >= F.col("need"))
        .select(F.explode(F.sequence(F.col("base"), F.col("base") + F.col("splits") - 1)).alias("grp"),
                F.pmod(F.xxhash64("vec_id", "row"), F.col("parts")).cast("int").alias("part"), "vec_id", "v"))
    return left, right


def knn_join(vectors: DataFrame, queries: DataFrame, k: int = 5, n_pivots: int | None = None,
             group_queries: int = GROUP_QUERIES, part_rows: int = PART_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): of each row of ``queries`` the k rows of ``vectors`` with the largest
    inner product, ties to the smaller id.  Both hold (vec_id, v), as :func:`scaled` gives them."""
    meeting = exchanged(vectors, queries, k, n_pivots, group_queries, part_rows)
    if meeting is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    left, right = meeting
    found = left.groupBy("grp", "part").cogroup(right.groupBy("grp", "part")).applyInArrow(
        _local(k), "query_key long, query_id long, vec_id long, score long")
    best = F.row_number().over(Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", best).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")
