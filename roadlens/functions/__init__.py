"""Column-level helpers: predicates, casts and orderings.

All return built-in Spark expressions, so they stay inside whole-stage codegen
and are pushed to the scan where the source allows it.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def any_like(columns: list[str], pattern: str) -> Column:
    """True when any of the columns matches ``pattern`` (SQL LIKE, case-sensitive).

    NULL columns do not match; NULL OR TRUE is TRUE, so one match is enough.
    """
    return reduce(or_, [col(c).like(pattern) for c in columns])


def in_values(c: str | Column, values: list[str]) -> Column:
    return col(c).isin(*values)


def not_in_values(c: str | Column, values: list[str]) -> Column:
    """``c NOT IN (values)``: a NULL ``c`` gives NULL and is dropped by a filter."""
    return ~col(c).isin(*values)


def to_number(c: str | Column) -> Column:
    """String count to a decimal ('6', '6.0' and '1e2' are numbers); what is not a number becomes NULL.

    Wide enough to add counts beyond the int range without overflow.
    """
    return col(c).try_cast("decimal(20,4)")


def measure_then_key(measure: str, key: str, ascending: bool = False) -> list[Column]:
    """Total order used by every top-k: measure (NULLs last), then key ascending, NULL key last."""
    m = F.col(measure).asc_nulls_last() if ascending else F.col(measure).desc_nulls_last()
    return [m, F.col(key).asc_nulls_last()]


__all__ = ["any_like", "col", "in_values", "measure_then_key", "not_in_values", "to_number"]
