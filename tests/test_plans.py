"""Physical-plan shape: the properties that matter at scale, checked on the plan text."""

from __future__ import annotations

import contextlib
import io
import re

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from roadlens.plans.registry import SQL_TEXTS, VIEWS

QUERIES = entry.queries()


def plan(spark, name: str) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        QUERIES[name](spark, SF_SMALL).explain()
    return buf.getvalue()


def test_top_k_is_take_ordered(spark):
    for name in ("a03", "a05", "a08", "a10", "s_topk"):
        assert "TakeOrderedAndProject" in plan(spark, name), name


def test_rank_band_is_one_take_ordered_with_offset(spark):
    p = plan(spark, "a06")
    assert re.search(r"TakeOrderedAndProject\(limit=5, offset=2", p)
    assert "Window" not in p  # no global row_number pulling all rows into one task


def test_top_1_and_first_per_key_limit_before_the_shuffle(spark):
    for name in ("a07", "s_top1", "s_first", "v_zip_dedup_first"):
        p = plan(spark, name)
        assert "WindowGroupLimit" in p, name
        assert re.search(r"Exchange hashpartitioning[^\n]*\n[\s:]*\+- WindowGroupLimit[^\n]*Partial", p), name


def test_top_n_lists_are_broadcast(spark):
    for name in ("a10", "v_speeding_in", "s_topn"):
        p = plan(spark, name)
        assert re.search(r"BroadcastHashJoin[^\n]*LeftSemi", p), name


def test_no_nested_loop_or_cartesian_joins(spark):
    for name in sorted(QUERIES):
        if name.startswith("o_"):
            continue
        p = plan(spark, name)
        assert "NestedLoopJoin" not in p and "CartesianProduct" not in p, name


def test_scans_read_only_needed_columns(spark):
    p = plan(spark, "a01")
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", p)
    assert schemas and all("l_extendedprice" not in s and "l_shipdate" not in s for s in schemas)


def test_equality_filter_reaches_the_scan(spark):
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in plan(spark, "s_having")


def test_key_join_waits_for_the_dedup_when_the_list_is_large(spark):
    """With a key list too big to broadcast, distinct(crash, unit, make) stays below the crash_id join.

    (With a small list Catalyst moves the semi join below the distinct and runs
    it map side as a broadcast, which is better still.)
    """
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(spark, "a03")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    join_at = p.index("SortMergeJoin")
    dedup = re.search(r"HashAggregate\(keys=\[crash_id#\d+, unit_nbr#\d+, veh_make_id#\d+\]", p)
    assert dedup and dedup.start() > join_at


def test_small_key_list_is_a_map_side_broadcast_filter(spark):
    p = plan(spark, "a03")
    assert re.search(r"BroadcastHashJoin[^\n]*LeftSemi", p)


def _tree(text: str):
    """Parse the indented plan text into (name, children) nodes."""
    lines = [l for l in text.splitlines() if re.search(r"[+:]- |^\S", l) and "== " not in l]
    root = {"name": "ROOT", "children": [], "depth": -1}
    stack = [root]
    for line in lines:
        m = re.search(r"[+]- (\*\(\d+\) )?(\w+)", line)
        if not m:
            continue
        depth = m.start()
        node = {"name": m.group(2), "children": [], "depth": depth, "line": line}
        while stack[-1]["depth"] >= depth:
            stack.pop()
        stack[-1]["children"].append(node)
        stack.append(node)
    return root


PASS_THROUGH = {"Project", "Filter", "BroadcastExchange", "Exchange", "AQEShuffleRead", "ShuffleQueryStage",
                "BroadcastQueryStage", "Sort"}


def _first_real(node):
    while node["name"] in PASS_THROUGH and node["children"]:
        node = node["children"][0]
    return node


def _joins(node):
    if node["name"].endswith("Join"):
        yield node
    for c in node["children"]:
        yield from _joins(c)


def _is_inner_join(node) -> bool:
    return node["name"].endswith("Join") and " Inner," in node["line"]


def _aggregated(node) -> bool:
    """An aggregate, or an inner join of aggregates (one row per key on each side)."""
    node = _first_real(node)
    if node["name"] == "HashAggregate":
        return True
    return _is_inner_join(node) and all(_aggregated(c) for c in node["children"])


@pytest.mark.parametrize("name", ["a04", "a07", "a10", "v_bottom_makes", "v_not_unlicensed"])
def test_fan_out_joins_only_see_aggregates(spark, name):
    """Both inputs of every inner join are aggregates: the many-to-many rows are never built."""
    p = plan(spark, name).split("== Initial Plan ==")[0]
    inner = [j for j in _joins(_tree(p)) if _is_inner_join(j)]
    assert inner, name
    for j in inner:
        assert all(_aggregated(c) for c in j["children"]), (name, j["line"].strip())


def test_every_plan_stays_in_the_jvm_and_prunes_columns(spark):
    """No Python evaluation anywhere; no lineitem scan reads a column no question uses."""
    for name in sorted(QUERIES):
        if name.startswith("o_"):
            continue
        p = plan(spark, name)
        assert "EvalPython" not in p and "FlatMapGroupsInPandas" not in p and "MapInPandas" not in p, name
        for schema in re.findall(r"ReadSchema: struct<([^>]*)>", p):
            assert "l_extendedprice" not in schema and "l_shipdate" not in schema, (name, schema)


def test_sql_not_in_broadcasts_no_list(spark):
    """The ids of NOT IN grow with the table: no plan of theirs may need them whole in every task."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(spark, "o_sql_not_in")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Broadcast" not in p and "SortMergeJoin" in p


@pytest.mark.parametrize("females", [["1", "2", "2"], ["1", None], [None], []])
def test_sql_not_in_by_its_null_rules(spark, females):
    drivers = [("1", "TX"), ("2", None), ("3", "TX"), ("3", "TX"), ("3", None), (None, "TX"), (None, None), ("4", "OK")]
    rows = [(c, s, "CLASS C", "MALE") for c, s in drivers] + [("5", "TX", None, "MALE"), ("6", "TX", "OTHER/OUT OF STATE", "MALE")]
    rows += [(c, "TX", None, "FEMALE") for c in females]
    people = spark.createDataFrame(rows, "crash_id string, drvr_lic_state_id string, drvr_lic_cls_id string, prsn_gndr_id string")
    people.createOrReplaceTempView(f"{VIEWS}primary_person")
    kept = {(c, s) for c, s in drivers if not females or (None not in females and c is not None and c not in females)}
    assert spark.sql(SQL_TEXTS["o_sql_not_in"]).collect() == [(len(kept),)]
