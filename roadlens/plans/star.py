"""The generic operators on the raw star tables (s_*).

Shows each operator is not tied to crash columns, and exercises it on the
largest table (``lineitem``) where shuffles and skew matter most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.functions import measure_then_key
from roadlens.operators import (
    count_by,
    count_entities,
    drop_matching,
    except_rows,
    first_per_key,
    having_count,
    keep_matching,
    rank_band,
    split_join,
    top_1_per_group,
    top_k_by_count,
    top_n_filter,
)

Tables = Callable[[str], DataFrame]

# Fixed values of the star-table demonstrations.
RETURNED = "R"
PROMO_TYPE = "PROMO"
FINISHED = "F"


def s_having(tbl: Tables) -> DataFrame:
    """Orders with more than two returned lines."""
    li = tbl("lineitem").filter(F.col("l_returnflag") == RETURNED)
    return having_count(li, ["l_orderkey"], 2, "line_count")


def s_entities(tbl: Tables) -> DataFrame:
    """Distinct (order, line) of PROMO parts; the lines of a hot part are filtered where they are."""
    promo = tbl("part").filter(F.col("p_type") == PROMO_TYPE).select(F.col("p_partkey").alias("l_partkey"))
    lines = split_join(tbl("lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), promo, ["l_partkey"], "left_semi")
    return count_entities(lines, ["l_orderkey", "l_linenumber"], "entity_count")


def s_topk(tbl: Tables) -> DataFrame:
    """Five brands found in the most distinct orders; the lines of a hot part get its brand where they are."""
    li = tbl("lineitem").select("l_orderkey", F.col("l_partkey").alias("p_partkey"))
    brands = split_join(li, tbl("part").select("p_partkey", "p_brand"), ["p_partkey"])
    return top_k_by_count(brands, ["l_orderkey"], "p_brand", 5, out="cnt")


def _finished_orders(tbl: Tables) -> DataFrame:
    o = tbl("orders").filter(F.col("o_orderstatus") == FINISHED)
    return o.select(F.col("o_custkey").alias("c_custkey"))


def s_semi(tbl: Tables) -> DataFrame:
    return keep_matching(tbl("customer").select("c_custkey"), _finished_orders(tbl), ["c_custkey"])


def s_anti(tbl: Tables) -> DataFrame:
    return drop_matching(tbl("customer").select("c_custkey"), _finished_orders(tbl), ["c_custkey"])


def s_band(tbl: Tables) -> DataFrame:
    """Nations ranked 3rd to 5th by customers.

    Customers are counted per nation key before the join, so the join sees
    one row per nation key instead of every customer.
    """
    per_key = count_by(tbl("customer"), "c_nationkey", "n")
    nations = tbl("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    per_name = per_key.join(nations, "c_nationkey").groupBy("n_name").agg(
        F.sum("n").cast("bigint").alias("cust_count"))
    return rank_band(per_name, measure_then_key("cust_count", "n_name"), 3, 5)


def s_top1(tbl: Tables) -> DataFrame:
    """Commonest order priority per order status."""
    counted = count_by(tbl("orders"), ["o_orderstatus", "o_orderpriority"], "cnt")
    top = top_1_per_group(counted, "o_orderstatus", "o_orderpriority", "cnt")
    return top.select("o_orderstatus", "o_orderpriority")


def s_first(tbl: Tables) -> DataFrame:
    """First event per (user, event type) by time, then event id."""
    e = tbl("events").select("user_id", "event_type", "event_id", "ts")
    order = [F.col("ts").asc_nulls_last(), F.col("event_id").asc_nulls_last()]
    return first_per_key(e, ["user_id", "event_type"], order).select("user_id", "event_type", "event_id")


def s_topn(tbl: Tables) -> DataFrame:
    """Lines of the ten busiest suppliers, per return flag."""
    li = tbl("lineitem")
    busiest = top_n_filter(li.select("l_suppkey", "l_returnflag"), "l_suppkey", li.select("l_suppkey"), 10)
    return count_by(busiest, "l_returnflag", "line_count")


def s_except(tbl: Tables) -> DataFrame:
    """Order keys without any line."""
    return except_rows(tbl("orders").select("o_orderkey"),
                       tbl("lineitem").select(F.col("l_orderkey").alias("o_orderkey")))


STAR = {
    "s_having": s_having,
    "s_entities": s_entities,
    "s_topk": s_topk,
    "s_semi": s_semi,
    "s_anti": s_anti,
    "s_band": s_band,
    "s_top1": s_top1,
    "s_first": s_first,
    "s_topn": s_topn,
    "s_except": s_except,
}
