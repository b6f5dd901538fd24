"""Joins that survive a hot key without AQE's skew split.

A key that holds much of the rows of a table puts them into one task when the table is shuffled by that key.
Here such keys are found first, by Spark's frequent-items sketch: one pass over the key columns that shuffles
only sketches.  Keys above a share of 1 / PARTS of the rows are hot, so there are fewer than PARTS of them.

* :func:`split_join`: rows of hot keys are joined where they are, against the other side's rows of those keys,
  which are broadcast: at most one for each hot key, as the other side holds each key once.  All others are
  joined by a shuffle.  The table is read for each of both, but its hot rows are never shuffled.
* :func:`salted_semi_join`, for a table of distinct rows that is costly to make: it is made once, and the rows of a hot key are
  dealt in pieces of about 1 / PARTS of all rows, at most SALTS, each of which gets the key of the other side.  So the other side
  grows by fewer than two rows for each of PARTS, however many keys are hot.

Which keys are hot decides the plan alone; whatever the sketch says, the result is the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is hot above this share of the rows, 1 / PARTS.
PARTS = 1000
#: Keys that the sketch follows; its error is about 3.5 / TRACKED of the rows, far below 1 / PARTS.
TRACKED = 16_384
#: Most pieces that the rows of a hot key are dealt in.
SALTS = 256


def _mark(keys: list[str]) -> Column:
    return F.xxhash64(*keys)


def _hottest(df: DataFrame, keys: list[str], parts: int) -> DataFrame:
    """One row: ``hot``, an array of fewer than ``parts`` (item, count) of the hot keys' hashes, and ``n``, the rows; NULL keys are never hot."""
    known = df.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys)).select(_mark(keys).alias("mark"))
    found = known.agg(F.expr(f"approx_top_k(mark, {parts}, {TRACKED})").alias("top"), F.count("*").alias("n"))
    return found.select(F.filter("top", lambda t: t["count"] * parts > F.col("n")).alias("hot"), "n")


def hot_marks(df: DataFrame, keys: list[str], parts: int = PARTS) -> Column:
    """Scalar subquery: the hashes of the hot keys of ``df``, an array of fewer than ``parts``; NULL keys are never hot."""
    return _hottest(df, keys, parts).select(F.transform("hot", lambda t: t["item"])).scalar()


def hot_pieces(df: DataFrame, keys: list[str], parts: int = PARTS, most: int = SALTS) -> Column:
    """Scalar subquery: hashes of the hot keys of ``df`` -> pieces of 1 / ``parts`` of the rows that each fills, at most ``most``; a map."""
    pieces = lambda t: F.least(F.ceil(t["count"] * parts / F.col("n")), F.lit(most)).cast("long")
    return _hottest(df, keys, parts).select(F.map_from_entries(F.transform("hot", lambda t: F.struct(t["item"], pieces(t))))).scalar()


def _same_types(df: DataFrame, other: DataFrame, keys: list[str]) -> None:
    for k in keys:
        if df.schema[k].dataType != other.schema[k].dataType:
            raise TypeError(f"{k} has two types, and so two hashes: cast it first")


def _is_hot(marks: Column, keys: list[str]) -> Column:
    return F.coalesce(F.array_contains(marks, _mark(keys)), F.lit(False))


def split_join(df: DataFrame, other: DataFrame, keys: list[str], how: str = "inner", parts: int = PARTS) -> DataFrame:
    """``df`` joined (``inner`` or ``left_semi``) to ``other`` on ``keys``, whose columns have the same names in both.

    For ``inner``, ``other`` holds each key once (a dimension's primary key); for ``left_semi`` it may hold it
    often.  NULL keys match nothing.
    """
    if how not in ("inner", "left_semi"):
        raise ValueError(f"no split for {how!r}")
    _same_types(df, other, keys)
    if how == "left_semi":
        other = other.select(*keys).distinct()
    hot = _is_hot(hot_marks(df, keys, parts), keys)
    near = df.where(hot).join(F.broadcast(other.where(hot)), keys, how)
    return near.unionByName(df.where(~hot).join(other.where(~hot), keys, how))


def salted_semi_join(df: DataFrame, other: DataFrame, keys: list[str], source: DataFrame, parts: int = PARTS, salts: int = SALTS) -> DataFrame:
    """Rows of ``df``, which are distinct, whose ``keys`` occur in ``other``; NULL keys match nothing.

    Hot keys are those of ``source``, the rows that ``df`` was made from: a key of more than 1 / ``parts`` of them, dealt in as many
    pieces as it fills, at most ``salts``.
    """
    _same_types(df, other, keys)
    pieces = F.coalesce(F.try_element_at(hot_pieces(source, keys, parts, salts), _mark(keys)), F.lit(1).cast("long"))
    salt = F.pmod(F.xxhash64(*df.columns), pieces).alias("__salt")
    dealt = F.sequence(F.lit(0).cast("long"), pieces - 1)
    wanted = other.select(*keys).distinct().select(*keys, F.explode(dealt).alias("__salt"))
    return df.select("*", salt).join(wanted, [*keys, "__salt"], "left_semi").select(*df.columns)
