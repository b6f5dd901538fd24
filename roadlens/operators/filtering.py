"""Semi / anti filtering, null-aware NOT IN, and top-N dimension filters.

``keep_matching`` / ``drop_matching`` are ``left_semi`` / ``left_anti`` joins
against the deduplicated key list of the other table, so a hot key on that
side is one row before it is shuffled (AQE can split only the left side of a
semi or anti join).  When the other table's keys are unique already
(``dedupe=False``) the join reads both shuffles directly, which is what AQE's
skew split needs to cut a hot key on the left side.

``distinct_matching`` / ``distinct_not_matching`` deduplicate first and
filter after.  Catalyst moves a semi / anti join below that ``distinct``
only when the key list can be broadcast (the join then runs map side, before
any shuffle); with a large key list the join stays above, so copies collapse
in the map-side partial aggregate and a hot crash reaches the join as a
handful of rows.  ``tests/skew_probe.py`` measures this with one crash
holding a third of all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.operators.aggregate import count_by, top_k_by_count, top_k_by_measure


def key_list(other: DataFrame, keys: list[str], other_keys: list[str] | None = None, dedupe: bool = True) -> DataFrame:
    """Key tuples of ``other`` renamed to ``keys``; distinct unless ``dedupe=False``."""
    src = other_keys or keys
    out = other.select(*[F.col(s).alias(k) for s, k in zip(src, keys)])
    return out.distinct() if dedupe else out


def keep_matching(df: DataFrame, other: DataFrame, keys: list[str], dedupe: bool = True) -> DataFrame:
    """Rows of ``df`` whose ``keys`` occur in ``other`` (NULL keys never match).

    ``dedupe=False`` when ``other``'s keys are unique already (a dimension's
    primary key): the join then reads its shuffle directly, which AQE's skew
    split needs to cut a hot key on the ``df`` side into several tasks.  With
    the dedupe an aggregate sits between them and only ``df`` deduplicated
    beforehand (``distinct_matching``) is safe from a hot key.
    """
    return df.join(key_list(other, keys, dedupe=dedupe), on=keys, how="left_semi")


def drop_matching(df: DataFrame, other: DataFrame, keys: list[str], dedupe: bool = True) -> DataFrame:
    """Rows of ``df`` whose ``keys`` do not occur in ``other``; NULL-key rows stay (see ``keep_matching``)."""
    return df.join(key_list(other, keys, dedupe=dedupe), on=keys, how="left_anti")


def distinct_matching(df: DataFrame, cols: list[str], other: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct ``cols`` rows of ``df`` whose ``keys`` (a subset of cols) occur in ``other``."""
    return keep_matching(df.select(*cols).distinct(), other, keys)


def distinct_not_matching(df: DataFrame, cols: list[str], other: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct ``cols`` rows of ``df`` whose ``keys`` do not occur in ``other``; NULL keys stay."""
    return drop_matching(df.select(*cols).distinct(), other, keys)


def drop_not_in(df: DataFrame, key: str, other: DataFrame, other_key: str | None = None) -> DataFrame:
    """SQL ``key NOT IN (SELECT other_key FROM other)``, NULL-aware.

    * ``other`` empty: every row stays, also a NULL ``key``.
    * ``other`` holds a NULL: no row stays.
    * otherwise: rows whose ``key`` is not NULL and not in ``other``.

    Spark plans a NOT IN subquery as a null-aware anti join that needs the
    whole list broadcast (or a nested loop).  Here it is an anti equi-join on
    the non-NULL keys plus one scalar subquery over ``other`` (a global
    aggregate) carrying the NULL rules, so it scales with both sides.
    """
    values = other.select(F.col(other_key or key).alias(key))
    mode = values.agg(
        F.when(F.count("*") == 0, F.lit(0))
        .when(F.count_if(F.col(key).isNull()) > 0, F.lit(2))
        .otherwise(F.lit(1))
    ).scalar()
    kept = drop_matching(df, values.filter(F.col(key).isNotNull()), [key])
    # keep-row rule per mode, indexed by the one scalar value (one subquery in the plan)
    rule = F.array(F.lit(True), F.col(key).isNotNull(), F.lit(False))
    return kept.filter(F.element_at(rule, mode + 1))


def top_values(df: DataFrame, attr: str, n: int, entity_keys: list[str] | None = None) -> DataFrame:
    """The ``n`` values of ``attr`` with the most rows, or with the most distinct
    ``entity_keys`` when given; ties by value ascending, NULL last."""
    if entity_keys is None:
        counted = count_by(df, attr, "__roadlens_n")
        return top_k_by_measure(counted, "__roadlens_n", attr, n).select(attr)
    return top_k_by_count(df, entity_keys, attr, n).select(attr)


def top_n_filter(
    df: DataFrame,
    attr: str,
    source: DataFrame,
    n: int,
    entity_keys: list[str] | None = None,
    on: str | None = None,
) -> DataFrame:
    """Rows of ``df`` whose ``on`` (default ``attr``) is one of the top-``n`` values of ``source``.

    The value list is built here with ``limit(n)``, so its size is bounded
    by ``n`` rows whatever the data size: broadcasting it is safe, and the
    filter then runs map side without shuffling ``df``.
    """
    top = top_values(source, attr, n, entity_keys)
    target = on or attr
    if target != attr:
        top = top.withColumnRenamed(attr, target)
    return df.join(F.broadcast(top), on=target, how="left_semi")
