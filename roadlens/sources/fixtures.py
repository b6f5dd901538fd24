"""Crash tables derived from the TPC-H-like test tables.

No crash data ships, so the test inputs are a fixed projection of
``lineitem`` (one units row, one person row per line) and ``orders``.  The same
projection exists as SQL text in :mod:`roadlens.plans.oracles` so DuckDB can
check every answer.  Only whole-number arithmetic, CASE and concatenation are
used, so both engines give identical strings.

The projection is SQL expression text in ``selectExpr`` (cheap to build:
one JVM call per table).  It is narrow (no shuffle) and lazy: a query that needs three
columns of ``units`` makes Catalyst read only the lineitem columns behind them.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession

from roadlens.sources.tables import CrashTables

# Fixed values of the fixture (must equal the oracle SQL prefix).
BODY_STYLES = ["MOTORCYCLE", "POLICE MOTORCYCLE", "NA", "NOT REPORTED",
               "OTHER  (EXPLAIN IN NARRATIVE)", "SEDAN", "PICKUP"]  # index = partkey % 8, 7 -> NULL


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return li.selectExpr(
        "l_orderkey AS o", "l_linenumber AS n", "l_partkey AS p", "l_suppkey AS s",
        "CAST(l_quantity AS INT) AS k",
        "CAST(round(l_discount * 100) AS INT) AS d",
        "CAST(round(l_tax * 100) AS INT) AS x",
        "l_returnflag AS rf", "l_linestatus AS ls",
    )


def _case_index(expr: str, values: list[str]) -> str:
    """CASE expr WHEN 0 THEN values[0] WHEN 1 ... END (no match -> NULL)."""
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {expr} {whens} END"


# Expressions are SQL text handed to selectExpr: one call into the JVM per
# table instead of one per Column operation.
_UNIT_EXPRS = [
    "CASE WHEN p % 31 = 0 THEN NULL ELSE CAST(o AS STRING) END AS crash_id",
    "CAST(n AS STRING) AS unit_nbr",
    "CASE WHEN rf = 'R' THEN 'Y' ELSE 'N' END AS veh_hnr_fl",
    f"{_case_index('p % 8', BODY_STYLES)} AS veh_body_styl_id",
    "CASE WHEN p % 13 = 0 THEN 'NA' WHEN p % 13 = 12 THEN NULL"
    " ELSE concat('MAKE_', CAST(p % 13 AS STRING)) END AS veh_make_id",
    "CASE WHEN (s * 7 + n) % 14 = 0 THEN 'NA' WHEN (s * 7 + n) % 14 = 13 THEN NULL"
    " ELSE concat('COLOR_', CAST((s * 7 + n) % 14 AS STRING)) END AS veh_color_id",
    "CASE WHEN (p + s) % 32 = 0 THEN 'NA' WHEN (p + s) % 32 = 31 THEN NULL"
    " WHEN (p + s) % 32 IN (5, 6) THEN 'Unknown'"
    " ELSE concat('ST_', CAST((p + s) % 32 AS STRING)) END AS veh_lic_state_id",
    "CASE WHEN k % 4 = 3 THEN '3.0' ELSE CAST(k % 4 AS STRING) END AS tot_injry_cnt",
    "CASE WHEN k % 17 = 0 THEN NULL ELSE CAST(n % 2 AS STRING) END AS death_cnt",
    "CASE WHEN s % 9 = 0 THEN 'UNDER INFLUENCE - ALCOHOL' ELSE 'NONE' END AS contrib_factr_1_id",
    "CASE WHEN p % 10 = 0 THEN 'HAD BEEN DRINKING ALCOHOL' WHEN p % 10 = 1 THEN NULL ELSE 'NONE' END"
    " AS contrib_factr_2_id",
    "CASE WHEN k % 25 = 0 THEN 'ALCOHOL' END AS contrib_factr_p1_id",
    "CASE WHEN k % 8 = 7 THEN 'DAMAGED 7 HIGHEST' WHEN k % 8 = 0 THEN NULL"
    " ELSE concat('DAMAGED ', CAST(k % 8 AS STRING)) END AS veh_dmag_scl_1_id",
    "CASE WHEN d % 8 = 7 THEN 'DAMAGED 7 HIGHEST' WHEN d % 8 = 0 THEN NULL"
    " ELSE concat('DAMAGED ', CAST(d % 8 AS STRING)) END AS veh_dmag_scl_2_id",
    "CASE rf WHEN 'A' THEN 'PROOF OF LIABILITY INSURANCE' WHEN 'N' THEN 'SURETY BOND' END AS fin_resp_type_id",
]

_PERSON_EXPRS = [
    "CASE WHEN s % 10 = 9 AND p % 3 = 0 THEN NULL ELSE CAST(o AS STRING) END AS crash_id",
    "CAST(n AS STRING) AS unit_nbr",
    "CAST(s % 9 + 1 AS STRING) AS prsn_nbr",
    "CASE WHEN p % 10 < 7 THEN 'DRIVER' ELSE 'PEDESTRIAN' END AS prsn_type_id",
    "CASE WHEN s % 10 < 6 THEN 'MALE' WHEN s % 10 < 9 THEN 'FEMALE' ELSE 'NA' END AS prsn_gndr_id",
    "CASE WHEN k <= 18 THEN 'KILLED' WHEN k <= 40 THEN 'NOT INJURED' END AS prsn_injry_sev_id",
    "CASE WHEN d % 3 = 0 THEN 'NOT DEPLOYED' ELSE 'DEPLOYED, FRONT' END AS prsn_airbag_id",
    "CASE (p + s + n) % 6 WHEN 0 THEN 'NA' WHEN 1 THEN 'UNKNOWN'"
    " ELSE concat('ETHN_', CAST((p + s + n) % 6 AS STRING)) END AS prsn_ethnicity_id",
    "CASE WHEN x <= 4 THEN 'CLASS C' WHEN x = 5 THEN 'UNLICENSED' WHEN x = 6 THEN 'OTHER/OUT OF STATE'"
    " WHEN x = 7 THEN 'CLASS A AND M' END AS drvr_lic_cls_id",
    "CASE WHEN p % 12 = 0 THEN NULL WHEN p % 12 = 1 THEN 'NA'"
    " ELSE concat('ST_', CAST(p % 12 AS STRING)) END AS drvr_lic_state_id",
    "CASE WHEN p % 11 = 0 THEN NULL ELSE CAST(75000 + (s * 3 + n) % 40 AS STRING) END AS drvr_zip",
]

_CHARGE_EXPRS = [
    "CAST(o AS STRING) AS crash_id",
    "CAST(n AS STRING) AS unit_nbr",
    "CAST(s % 9 + 1 AS STRING) AS prsn_nbr",
    "CASE s % 3 WHEN 0 THEN 'SPEEDING - OVER LIMIT' WHEN 1 THEN 'UNSAFE SPEED' ELSE 'NO INSURANCE' END AS charge",
]


_EXTRA_EXPRS = {
    "endorse": [
        "CAST(o AS STRING) AS crash_id", "CAST(n AS STRING) AS unit_nbr",
        "CASE WHEN x < 3 THEN 'NONE' WHEN x < 6 THEN 'TANK VEHICLE' END AS drvr_lic_endors_id",
    ],
    "restrict": [
        "CAST(o AS STRING) AS crash_id", "CAST(n AS STRING) AS unit_nbr",
        "CASE WHEN d < 5 THEN 'WITH CORRECTIVE LENSES' ELSE 'NONE' END AS drvr_lic_restric_id",
    ],
}


def _damages(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return orders.filter("o_orderstatus = 'P'").selectExpr(
        "CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE CAST(o_orderkey AS STRING) END"
        " AS crash_id", "o_orderpriority AS damaged_property")


def extra_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The endorsement and restriction tables, which no question uses."""
    q = _lines(spark, sf_dir)
    return {name: q.selectExpr(*exprs) for name, exprs in _EXTRA_EXPRS.items()}


def crash_tables(spark: SparkSession, sf_dir: str) -> CrashTables:
    """The four crash tables over ``sf_dir``, as lazy plans in the session ``spark``; a table that is not asked for is not read."""
    lines = cache(lambda: _lines(spark, sf_dir))
    return CrashTables(
        primary_person=lambda: lines().selectExpr(*_PERSON_EXPRS),
        units=lambda: lines().selectExpr(*_UNIT_EXPRS),
        damages=lambda: _damages(spark, sf_dir),
        charges=lambda: lines().filter("ls = 'O' AND rf <> 'R'").selectExpr(*_CHARGE_EXPRS),
    )


def star_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
