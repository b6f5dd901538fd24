"""Grouping operators: having-count, entity counts, top-k, rank bands.

Every grouping here is a hash aggregate that Spark runs partial (map side)
then final, so a hot key or a large group of copies is collapsed before the
shuffle.  Top-k keeps ``orderBy`` and ``limit`` adjacent so the plan is a
``TakeOrderedAndProject`` (k rows per task), never a full sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.functions import measure_then_key


def count_rows(df: DataFrame, out: str) -> DataFrame:
    """Global ``count(*)``: always exactly one row, 0 on empty input."""
    return df.agg(F.count("*").alias(out))


def count_entities(df: DataFrame, keys: list[str], out: str) -> DataFrame:
    """Number of distinct ``keys`` tuples (NULL is a value); one row."""
    return count_rows(df.select(*keys).distinct(), out)


def count_by(df: DataFrame, key: str | list[str], out: str, counted: str | None = None) -> DataFrame:
    """Rows per group; with ``counted``, ``count(counted)`` (NULLs not counted)."""
    keys = [key] if isinstance(key, str) else list(key)
    measure = F.count(counted) if counted else F.count("*")
    return df.groupBy(*keys).agg(measure.alias(out))


def having_count(
    df: DataFrame, keys: list[str], threshold: int, out: str, inclusive: bool = False
) -> DataFrame:
    """Groups with more than ``threshold`` rows (``>=`` when ``inclusive``)."""
    counted = count_by(df, keys, out)
    cond = F.col(out) >= threshold if inclusive else F.col(out) > threshold
    return counted.filter(cond)


def sum_having(
    df: DataFrame,
    entity_cols: list[str],
    key: str,
    measure: Column,
    threshold: int,
    out: str,
) -> DataFrame:
    """Sum ``measure`` over distinct ``entity_cols`` rows per ``key``; keep sums > threshold.

    ``measure`` is evaluated on the distinct rows; a NULL measure is skipped
    by the sum and a NULL sum never passes the threshold.
    """
    distinct_rows = df.select(*entity_cols).distinct()
    summed = distinct_rows.groupBy(key).agg(F.sum(measure).cast("bigint").alias(out))
    return summed.filter(F.col(out) > threshold)


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def top_k_by_measure(df: DataFrame, measure: str, key: str, k: int, ascending: bool = False) -> DataFrame:
    """k rows by ``measure`` (desc unless ``ascending``), ties by ``key`` ascending, NULL key last."""
    return top_k(df, measure_then_key(measure, key, ascending), k)


def top_k_by_count(
    df: DataFrame,
    entity_keys: list[str],
    attr: str,
    k: int,
    out: str = "cnt",
    ascending: bool = False,
    count_nulls: bool = True,
) -> DataFrame:
    """The k values of ``attr`` found with the most distinct entities.

    Entities are distinct ``entity_keys + [attr]`` rows.  ``count_nulls=False``
    counts with ``count(attr)``, so a NULL ``attr`` group scores 0.
    """
    entities = df.select(*entity_keys, attr).distinct()
    counted = count_by(entities, attr, out, counted=None if count_nulls else attr)
    return top_k_by_measure(counted, out, attr, k, ascending)


def limit_offset(df: DataFrame, order: list[Column], limit: int, offset: int) -> DataFrame:
    """SQL ``ORDER BY .. LIMIT limit OFFSET offset``: rows offset+1 .. offset+limit."""
    return df.orderBy(*order).offset(offset).limit(limit)


def rank_band(df: DataFrame, order: list[Column], lo: int, hi: int) -> DataFrame:
    """Rows ranked ``lo`` .. ``hi`` (1-based, inclusive) under a total ``order``.

    One ordered pass with offset/limit; a global ``row_number`` window would
    pull every row into one partition instead.
    """
    if lo < 1 or hi < lo:
        raise ValueError(f"bad rank band {lo}..{hi}")
    return limit_offset(df, order, hi - lo + 1, lo - 1)
