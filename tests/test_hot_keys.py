"""Joins that split off hot keys: the same rows as the plain join, whatever is hot."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import rows
from roadlens.operators import hot_marks, salted_semi_join, split_join
from roadlens.operators.hot_keys import hot_pieces


def left(spark):
    """Key 7 holds a third of the rows, NULL another ninth; rows repeat."""
    k = "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 9 = 1 THEN NULL ELSE id % 500 END"
    return spark.range(0, 9000, 1, 8).selectExpr(f"{k} AS k", "id % 10 AS v")


def test_hot_keys_are_found(spark):
    df = left(spark)
    found = spark.range(1).select(hot_marks(df, ["k"], 100).alias("m")).first()["m"]
    assert found == [spark.range(1).select(F.xxhash64(F.lit(7).cast("bigint")).alias("m")).first()["m"]]
    assert spark.range(1).select(hot_marks(df.where("false"), ["k"]).alias("m")).first()["m"] == []


@pytest.mark.parametrize("parts", [2, 100, 1000])
@pytest.mark.parametrize("how", ["inner", "left_semi"])
def test_same_rows_as_the_plain_join(spark, how, parts):
    df = left(spark)
    dim = spark.range(0, 400).selectExpr("CASE WHEN id = 399 THEN NULL ELSE id END AS k", "concat('b', id % 5) AS b")
    if how == "left_semi":
        dim = dim.unionAll(dim)
    assert rows(split_join(df, dim, ["k"], how, parts)) == rows(df.join(dim, ["k"], how))
    without = dim.where("k <> 7")
    assert rows(split_join(df, without, ["k"], how, parts)) == rows(df.join(without, ["k"], how))


def test_keys_of_two_columns_and_empty_sides(spark):
    df = left(spark).withColumn("w", (F.col("v") % 2).cast("string"))
    other = spark.createDataFrame([(7, "1"), (7, "1"), (8, "0"), (None, "0")], "k long, w string")
    assert rows(split_join(df, other, ["k", "w"], "left_semi")) == rows(df.join(other, ["k", "w"], "left_semi"))
    assert split_join(df, other.where("false"), ["k", "w"], "left_semi").count() == 0
    assert split_join(df.where("false"), other, ["k", "w"], "left_semi").count() == 0


def test_refused_joins(spark):
    df = left(spark)
    with pytest.raises(ValueError, match="split"):
        split_join(df, df, ["k"], "left_anti")
    with pytest.raises(TypeError, match="cast"):
        split_join(df, df.select(F.col("k").cast("int")), ["k"], "left_semi")


@pytest.mark.parametrize("parts", [2, 1000])
def test_salted_semi_join(spark, parts):
    df = left(spark).withColumn("v", F.monotonically_increasing_id()).distinct()
    other = spark.createDataFrame([(7,), (7,), (8,), (None,), (9,)], "k long")
    want = rows(df.join(other, ["k"], "left_semi"))
    assert rows(salted_semi_join(df, other, ["k"], df, parts, salts=5)) == want
    assert rows(salted_semi_join(df, other, ["k"], df.where("false"), parts)) == want
    assert rows(salted_semi_join(df, other.where("k <> 7"), ["k"], df, parts)) == rows(df.join(other.where("k <> 7"), ["k"], "left_semi"))
    assert salted_semi_join(df, other.where("false"), ["k"], df, parts).count() == 0


def test_pieces_follow_the_share_of_a_key(spark):
    """Of 40 keys above the limit, 39 barely: each is dealt in the pieces it fills, not all in the most there are."""
    df = spark.range(0, 4000, 1, 8).selectExpr("CASE WHEN id < 2050 THEN 0 ELSE id % 39 + 1 END AS k")
    found = spark.range(1).select(hot_pieces(df, ["k"], 100, 256).alias("m")).first()["m"]
    mark = spark.range(1).select(F.xxhash64(F.lit(0).cast("bigint")).alias("m")).first()["m"]
    assert len(found) == 40 and found.pop(mark) == 52 and set(found.values()) == {2}
    assert spark.range(1).select(hot_pieces(df, ["k"], 100, 7).alias("m")).first()["m"][mark] == 7
    assert spark.range(1).select(hot_pieces(df.where("false"), ["k"]).alias("m")).first()["m"] == {}
