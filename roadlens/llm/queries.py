"""The registered query of each operator, as its contract words it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.llm.alignment import align_documents
from roadlens.llm.bit_packing import packed_ids
from roadlens.llm.common import table
from roadlens.llm.knn_join import knn_join, scaled
from roadlens.llm.mixing import mix_documents
from roadlens.llm.near_dedup import near_duplicates
from roadlens.llm.packing import pack_documents
from roadlens.llm.periodic_runs import longest, periodic_runs, with_repeats
from roadlens.llm.quality_classifier import quality_classifier
from roadlens.llm.quality_rules import quality_rules
from roadlens.llm.sharding import shard_documents
from roadlens.llm.suffix_tree import suffix_tree_scores
from roadlens.llm.token_counts import token_counts
from roadlens.llm.topics import fit_topics
from roadlens.llm.toxicity import toxicity


def op1_knn_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = scaled(table(spark, sf_dir, "embeddings"))
    return knn_join(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5)


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), carry=["doc_id"])


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), carry=["doc_id"])
    return scored.select("doc_id", "held_out", "score", "predicted")


def op5_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree_scores(table(spark, sf_dir, "documents"))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), carry=["doc_id"])


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents")).drop("ids")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mix_documents(docs, carry=["doc_id", "source", "lang"], topics=fit_topics(docs))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality_classifier(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), carry=["doc_id"])
    return scored.select("doc_id", "held_out", "score", "predicted")


def op11_bit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_ids(table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_repeats(table(spark, sf_dir, "documents")), carry=["doc_id"]).withColumn("r", longest())
    line = lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"])
    digest = lambda text: F.sha2(text.cast("binary"), 256)
    return found.select(
        "doc_id", "n_runs", "r.start", "r.length", "r.period",
        F.floor(1000 * F.col("r.length") / F.col("r.period")).alias("exponent_milli"),
        digest(F.concat_ws("", F.transform("runs", line))).alias("runs_sha256"), digest(F.col("collapsed")).alias("collapsed_sha256"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = lambda groups: F.when(groups == "", "").otherwise(F.sha2(groups.cast("binary"), 256))
    found = align_documents(table(spark, sf_dir, "documents"), keep_groups=digest)
    return found.withColumnRenamed("groups", "groups_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_knn_join": op1_knn_join,
    "op2_sharding": op2_sharding,
    "op3_token_counts": op3_token_counts,
    "op4_toxicity": op4_toxicity,
    "op5_suffix_tree": op5_suffix_tree,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_quality_rules": op7_quality_rules,
    "op8_packing": op8_packing,
    "op9_mixing": op9_mixing,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_bit_packing": op11_bit_packing,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_alignment": op13_alignment,
}

OP1_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id
  WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""

OP6_SQL = """
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[ \\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), s AS MATERIALIZED (
  SELECT r, doc_id, CASE WHEN len(w) >= 5
    THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s
  FROM w
), u AS (SELECT r, doc_id, len(s) AS n, unnest(s) AS g FROM s WHERE doc_id IS NOT NULL),
p AS (
  SELECT any_value(a.doc_id) AS a, any_value(b.doc_id) AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS shared
  FROM u a JOIN u b ON a.g = b.g AND a.r < b.r GROUP BY a.r, b.r
), e AS (SELECT DISTINCT a, b FROM p WHERE 100 * shared >= 85 * (na + nb - shared) AND a <> b),
l AS (SELECT a AS x, b AS y FROM e UNION SELECT b, a FROM e),
reach AS (SELECT doc_id AS x, doc_id AS y FROM s UNION SELECT r.x, l.y FROM reach r JOIN l ON r.y = l.x),
c AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT s.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, coalesce(s.doc_id = component_id, true) AS kept
FROM s LEFT JOIN c ON c.x = s.doc_id
"""

ORACLES: dict[str, str] = {"op1_knn_join": OP1_SQL, "op6_near_duplicates": OP6_SQL}
