"""Set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SIDE = "__roadlens_side"


def except_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """SQL ``EXCEPT DISTINCT``: distinct rows of ``a`` not in ``b`` (by position, NULL equals NULL).

    One grouping over both sides: a hot value of either is a few rows after
    the map-side partial aggregate, and there is one shuffle.
    """
    sides = a.withColumn(_SIDE, F.lit(0)).unionByName(b.toDF(*a.columns).withColumn(_SIDE, F.lit(1)))
    grouped = sides.groupBy(*[F.col(f"`{c}`") for c in a.columns]).agg(F.max(_SIDE).alias(_SIDE))
    return grouped.filter(F.col(_SIDE) == 0).drop(_SIDE)
