"""Top-1 per group and first row per key.

Both are ``row_number() = 1`` over a partitioned window.  Catalyst inserts a
``WindowGroupLimit`` before the shuffle for this shape, so each map task
forwards at most one row per key: a hot key costs one row per task, not a
third of the table in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "__roadlens_rn"


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per ``keys``: the first under ``order`` (give a total order for a stable pick)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def top_1_per_group(df: DataFrame, group: str, item: str, measure: str) -> DataFrame:
    """Per ``group`` the ``item`` with the largest ``measure``; ties by ``item`` ascending, NULL last."""
    order = [F.col(measure).desc_nulls_last(), F.col(item).asc_nulls_last()]
    return first_per_key(df, [group], order)
