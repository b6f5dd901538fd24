"""Operator 1: pruning, large values, empty vectors and repeated rows, all against all pairs."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadlens.llm.knn_join import exchanged, knn_join, products, scaled


def table(spark, rows, parts=3):
    return spark.createDataFrame([(int(i), [int(x) for x in v]) for i, v in rows], "vec_id long, v array<bigint>").repartition(parts)


def by_query(df):
    got = defaultdict(list)
    for r in df.orderBy("query_id", "rank", "vec_id").collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    return got


def all_pairs(rows, queries, k=5):
    want = {}
    for q, x in queries:
        scored = sorted((-sum(int(a) * int(b) for a, b in zip(x, y, strict=True)), i) for i, y in rows if i != q and len(x) == len(y))
        if scored:
            want[q] = [(n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return want


def clustered(n=20_000, clusters=50, dim=16):
    rng = np.random.default_rng(11)
    centre = rng.normal(size=(clusters, dim)) * 4000
    return (centre[rng.integers(0, clusters, n)] + rng.normal(size=(n, dim)) * 60).astype(np.int64)


def test_candidates_of_far_clusters_are_not_sent(spark):
    v = clustered()
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, v array<bigint>").repartition(4)
    asked = df.where("vec_id % 50 = 0")
    _, right = exchanged(df, asked, 5)
    groups = right.groupBy("grp").agg(F.count("*").alias("n")).collect()
    assert len(groups) > 1 and sum(r["n"] for r in groups) < 0.3 * len(v) * len(groups)
    got = by_query(knn_join(df, asked, 5))
    score = v[::50] @ v.T
    for row, q in enumerate(range(0, len(v), 50)):
        order = [int(i) for i in np.lexsort((np.arange(len(v)), -score[row])) if i != q][:5]
        assert got[q] == [(n + 1, i, int(score[row, i])) for n, i in enumerate(order)]


def test_a_group_of_everything_when_nothing_can_be_left_out(spark):
    v = np.random.default_rng(5).integers(-300, 300, (3000, 40))
    df = table(spark, enumerate(v))
    left, right = exchanged(df, df.where("vec_id % 50 = 0"), 5)
    assert left.select("grp").distinct().count() <= 2 and right.count() <= 2 * 3000


@pytest.mark.parametrize("largest", [1 << 20, 1 << 27, 1 << 33])
def test_products_of_any_size_are_exact(largest):
    rng = np.random.default_rng(2)
    q, c = rng.integers(-largest, largest, (3, 7)), rng.integers(-largest, largest, (4, 7))
    limit = (1 << 63) - 1
    want = [[min(max(sum(int(a) * int(b) for a, b in zip(x, y, strict=True)), -limit - 1), limit) for y in c] for x in q]
    assert products(q, c).tolist() == want


def test_large_values_take_part(spark):
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.integers(-2**20, 2**20, 4)]) for i in range(120)]
    rows += [(200, [1e30, 1.0, 0.0, 0.0]), (250, [3e6, 0.0, 0.0, -1.0])]  # no long; beyond the former limit
    df = scaled(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    whole = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows if i != 200]
    assert by_query(knn_join(df, df.where("vec_id % 50 = 0"))) == all_pairs(whole, [r for r in whole if r[0] % 50 == 0])


def test_empty_vectors_score_nothing_with_each_other(spark):
    rows = [(0, []), (1, []), (2, [5, 5]), (3, []), (50, [1, 1])]
    df = spark.createDataFrame(rows, "vec_id long, v array<bigint>")
    assert by_query(knn_join(df, df.where("vec_id % 50 = 0"))) == {0: [(1, 1, 0), (2, 3, 0)], 50: [(1, 2, 10)]}


def test_repeated_rows(spark):
    """Many rows of a query's own id, and one vector thousands of times: dealt to many parts, none lost, none the query's own."""
    rng = np.random.default_rng(4)
    v = rng.integers(-9, 9, (400, 3))
    rows = list(enumerate(v)) + [(50, v[50])] * 30 + [(77, [9, 9, 9])] * 3000
    df = table(spark, rows)
    asked = df.where("vec_id in (0, 50, 100)")
    _, right = exchanged(df, asked, 5, part_rows=200)
    dealt = right.where("vec_id = 77").groupBy("grp", "part").agg(F.count("*").alias("n")).collect()
    assert len(dealt) > 5 and max(r["n"] for r in dealt) < 1000
    got = by_query(knn_join(df, asked, part_rows=200))
    assert got == all_pairs(rows, [(q, v[q]) for q in (0, 50, 100)])


def test_zero_queries_and_zero_candidates(spark):
    rows = [(0, [0, 0]), (50, [1, -1]), (3, [0, 0]), (4, [-2, 5]), (5, [7, 7]), (6, [0, 0]), (7, [1, 1]), (8, [2, 2])]
    df = table(spark, rows)
    assert by_query(knn_join(df, df.where("vec_id % 50 = 0"))) == all_pairs(rows, rows[:2])
