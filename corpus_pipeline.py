"""The corpus pipeline: quality rules, quality classifier, near-dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept, and returns a DataFrame that is
written as Parquet and read back as the next one's ``docs``.  All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.llm.common import stage, table
from roadlens.llm.mixing import mix_documents
from roadlens.llm.near_dedup import BROADCAST_IDS, near_duplicates
from roadlens.llm.packing import pack_documents
from roadlens.llm.quality_classifier import apply_classifier, fit_classifier
from roadlens.llm.quality_rules import quality_rules
from roadlens.llm.topics import fit_topics
from roadlens.session import Scratch

#: Documents that share so many percent of their five-word shingles are near copies.
NEAR_PERCENT = 80
#: The number of a row, which the documents' own columns are not called.
ROW = "__pipeline_row"


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    judged = quality_rules(docs, table(spark, sf_dir, "labels"), carry=docs.columns)
    return judged.where("kept").select(*docs.columns)


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts to be good."""
    # Fitted on all labelled documents: the rules have left hardly any bad ones among ``docs``.
    model = fit_classifier(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return apply_classifier(docs, model).where("predicted = 1").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: that of the smallest id, of several such the first.

    Rows are compared, not ids: of two rows that share an id and are no near copies both stay, of a row that is repeated as
    a whole one.  Null, empty and blank texts and rows without an id stay.
    """
    rows = stage(docs.withColumn(ROW, F.monotonically_increasing_id()), "rows")  # numbered once and for all
    known = rows.where("doc_id IS NOT NULL")
    linked = near_duplicates(known.select(F.col(ROW).alias("doc_id"), "text"), NEAR_PERCENT)
    groups = linked.where("n_shingles > 0").select(F.col("doc_id").alias(ROW), F.col("component_id").alias("grp"))
    grouped = stage(groups.join(known.select(ROW, "doc_id"), ROW), "groups")
    first = stage(grouped.groupBy("grp").agg(F.min(F.struct("doc_id", ROW)).alias("first"), F.count("*").alias("n")).where("n > 1"), "first")
    gone = stage(grouped.join(first, "grp").where(F.col(ROW) != F.col(f"first.{ROW}")).select(ROW), "gone")
    if gone.count() <= BROADCAST_IDS:  # else the texts are shuffled
        gone = F.broadcast(gone)
    return rows.join(gone, ROW, "left_anti").select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents kept to meet the target weights of sources, languages and topics.

    Topics, tokens a cell and probabilities come from all of ``docs``; only the result is a part of them, as the weights ask.
    """
    return mix_documents(docs, topics=fit_topics(docs)).where("kept").select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, with their ids."""
    return pack_documents(docs)


STAGES = [("quality rules", rules), ("quality classifier", classifier), ("near-dedup", near_dedup),
          ("mixing", mixing), ("packing", packing)]

#: Models and iterations are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another; what a stage wrote besides its result goes when that is written, its result after the next."""
    docs = table(spark, sf_dir, "documents")
    with Scratch(spark) as results:
        for name, function in STAGES:
            with Scratch(spark) as own:
                docs = own.hand_over(function(spark, docs, sf_dir), name.replace(" ", "-"))
            results.close(but=1)
        results.release()
    return docs
