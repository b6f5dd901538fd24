"""Connected components of an edge list, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.llm.common import stage


#: A node with more than this share of the edges is a hub.
HUBS = 1000


def _progress(edges: DataFrame) -> tuple[int, int]:
    """(number of edges, nodes that keep them from being stars: with two parents, or with a parent and a child)."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    found = nodes.agg(F.sum("up").alias("edges"), F.count_if((F.col("up") > 1) | ((F.col("up") == 1) & (F.col("down") == 1)))
                      .alias("odd")).first()
    return found["edges"] or 0, found["odd"]


def _hang(larger: DataFrame, low: DataFrame, n_edges: int) -> DataFrame:
    """(b, m) for each edge (a, b): hung onto the smallest neighbour m of a.

    Nodes with more than 1 / HUBS of all edges, at most HUBS of them, are joined by a broadcast, so that no
    task gets all the edges of one.
    """
    hub = F.col("n") * HUBS > n_edges
    pairs = [F.col("b").alias("a"), F.col("m").alias("b")]
    hubs = F.broadcast(low.where(hub).select("a", "m"))
    rest = larger.join(hubs, "a", "left_anti").join(low.where(~hub).select("a", "m"), "a")
    return larger.join(hubs, "a").select(*pairs).unionByName(rest.select(*pairs))


def components(edges: DataFrame) -> DataFrame:
    """(node, component): each node of ``edges`` (a, b; long) with the smallest node it can reach.

    Each round hangs every node's larger neighbours, then its smaller ones, onto its smallest neighbour.
    It ends when only stars are left, after a logarithmic number of rounds.  Only minima and
    the edges themselves are shuffled; each round is written to the shared folder, so plans stay short.
    Nulls and loops are dropped; no edges give no rows.
    """
    current = stage(
        edges.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    n_edges, odd = _progress(current)
    while odd:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = stage(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count("*").alias("n")), "edges-low")
        # b > a >= m, so each edge points from the larger to the smaller node again
        large = _hang(both.where("b > a"), low, 2 * n_edges).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(
            F.explode(F.when(F.col("b") == F.col("m"), F.array(F.struct("a", F.col("m").alias("b"))))
                      .otherwise(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b"))))).alias("e"))
        current = stage(small.select("e.a", "e.b").distinct(), "edges")
        n_edges, odd = _progress(current)
    root = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(root)
