"""Every registered query against its DuckDB oracle SQL (the driver's check, at sf0.001)."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from oracle_compare import compare, duck_connection
from roadlens.plans.registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck():
    con = duck_connection(SF_SMALL)
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    ok, msg = compare(spark, duck, name, QUERIES[name], ORACLES[name], SF_SMALL)
    assert ok, msg


# Answers published with the fixture definition (sf0.001).
EXPECTED = {
    "a02": [(582,)],
    "a03": [("MAKE_4", 176), ("MAKE_1", 173), ("MAKE_2", 173), ("MAKE_10", 160), ("MAKE_8", 160)],
    "a04": [(4876,)],
    "a04_hnr": [(2200,)],
    "a05": [("NA", 117)],
    "a06": [("MAKE_7", 913), ("MAKE_4", 912), ("MAKE_9", 890)],
    "a08": [("75007", 200), ("75016", 172), ("75028", 167), ("75019", 166), ("75010", 161)],
    "a09": [(542,)],
    "a10": [("MAKE_1", 1499), ("MAKE_4", 1490), ("MAKE_9", 1367), ("MAKE_3", 1362), ("MAKE_10", 1326)],
    "v_bottom_makes": [("MAKE_11", 165), (None, 167), ("MAKE_3", 175), ("MAKE_6", 180), ("MAKE_9", 180)],
    "v_non_female_state": [("NA", 99)],
    "v_non_female_pairs": [(922,)],
    "s_band": [("NATION_10", 9), ("NATION_20", 9), ("NATION_17", 8)],
}
COUNTS = {"a01": 84, "v_death_sum": 325, "v_male_deaths_ge2": 332, "s_having": 221, "s_first": 75, "s_except": 27}


@pytest.mark.parametrize("name", sorted(EXPECTED))
def test_published_answers_in_order(spark, name):
    got = [tuple(r) for r in QUERIES[name](spark, SF_SMALL).collect()]
    assert got == EXPECTED[name]


@pytest.mark.parametrize("name", sorted(COUNTS))
def test_published_row_counts(spark, name):
    assert QUERIES[name](spark, SF_SMALL).count() == COUNTS[name]


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["veh_make_id", "cnt"]
    assert len(df.collect()) == 5
