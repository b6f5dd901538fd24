"""The ten standing crash questions (a01-a10) and the corrected definitions.

Each is a pure function ``CrashTables -> DataFrame`` that builds a lazy plan;
nothing runs until the caller writes or collects.  The answers are the ones
the original job computes, with two deliberate changes:

* every top-k / top-1 / band has a total order: measure, then key ascending
  with NULL last (the original left ties open);
* string counts are cast with ``try_cast`` to decimals, added as such, and the
  sum is a bigint (the original added two strings, which Spark 4 with ANSI on
  rejects).

Plans are shaped for very large, skewed inputs: aggregate before joining
(a04, a07, a10 never build the many-to-many join rows the original counts,
they multiply per-crash counts instead), deduplicate before the key join
(a02, a03, a05, a08, a09), and broadcast only the top-N lists whose size the
limit bounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.functions import any_like, in_values, measure_then_key, not_in_values, to_number
from roadlens.operators import (
    count_by,
    count_rows,
    distinct_matching,
    distinct_not_matching,
    having_count,
    keep_matching,
    rank_band,
    salted_semi_join,
    top_1_per_group,
    top_k_by_measure,
)
from roadlens.sources.tables import CrashTables

# Codes and patterns the questions compare with, as they appear
# in the crash data.
MALE = "MALE"
FEMALE = "FEMALE"
KILLED = "KILLED"
DRIVER = "DRIVER"
AIRBAG_NOT_DEPLOYED = "NOT DEPLOYED"
TWO_WHEELER_BODIES = ["MOTORCYCLE", "POLICE MOTORCYCLE"]
LICENSED_PATTERN = "%CLASS%"
BODY_STYLES_EXCLUDED = ["NA", "OTHER  (EXPLAIN IN NARRATIVE)", "NOT REPORTED"]
ETHNICITIES_EXCLUDED = ["NA", "UNKNOWN"]
ALCOHOL_PATTERN = "%ALCOHOL%"
ALCOHOL_FACTOR_COLUMNS = ["contrib_factr_1_id", "contrib_factr_2_id", "contrib_factr_p1_id"]
HIGH_DAMAGE_LEVELS = ["DAMAGED 5", "DAMAGED 6", "DAMAGED 7 HIGHEST"]
INSURANCE_PATTERN = "%INSURANCE%"
SPEEDING_PATTERN = "%SPEED%"
NOT_AVAILABLE = "NA"
HIT_AND_RUN_YES = "Y"  # flag value assumed for "hit and run"; the job itself never filters on it
TOP_COLOURS = 10
TOP_STATES = 25

CRASH = "crash_id"
UNIT = "unit_nbr"
MAKE = "veh_make_id"


def _killed_males(t: CrashTables) -> DataFrame:
    p = t.primary_person
    return p.filter((F.col("prsn_gndr_id") == MALE) & (F.col("prsn_injry_sev_id") == KILLED))


def _fatal_drivers_no_airbag(t: CrashTables) -> DataFrame:
    p = t.primary_person
    return p.filter(
        (F.col("prsn_type_id") == DRIVER)
        & (F.col("prsn_injry_sev_id") == KILLED)
        & (F.col("prsn_airbag_id") == AIRBAG_NOT_DEPLOYED)
    )


def _licensed(df: DataFrame) -> DataFrame:
    return df.filter(F.col("drvr_lic_cls_id").like(LICENSED_PATTERN))


def a01_male_deaths(t: CrashTables) -> DataFrame:
    """Crashes with more than two killed males: (crash_id, male_death_count)."""
    return having_count(_killed_males(t), [CRASH], 2, "male_death_count")


def a02_two_wheelers_booked(t: CrashTables) -> DataFrame:
    """Distinct two-wheeler units (police bikes included) that have a charge."""
    bikes = t.units.filter(in_values("veh_body_styl_id", TWO_WHEELER_BODIES))
    booked = distinct_matching(bikes, [CRASH, UNIT], t.charges, [CRASH, UNIT])
    return count_rows(booked, "count_two_wheeler_booked")


def a03_top_makes_fatal_no_airbag(t: CrashTables) -> DataFrame:
    """Top 5 makes among all units of crashes where a driver died with the airbag not deployed."""
    return makes_by_units(t, _fatal_drivers_no_airbag(t))


def makes_by_units(t: CrashTables, crashes: DataFrame) -> DataFrame:
    """Top 5 makes by distinct units of the given crashes.

    Units are counted per (crash, make) before the semi join: a crash with any
    number of different units reaches the join as one row per make.
    """
    cars = count_by(t.units.select(CRASH, UNIT, MAKE).distinct(), [CRASH, MAKE], "n_cars")
    made = keep_matching(cars, crashes, [CRASH]).groupBy(MAKE).agg(F.sum("n_cars").alias("cnt"))
    return top_k_by_measure(made, "cnt", MAKE, 5)


def _driver_unit_flag_pairs(drivers: DataFrame, units: DataFrame, out: str) -> DataFrame:
    """count(*) of drivers JOIN distinct(crash_id, veh_hnr_fl) ON crash_id, without the join rows.

    Per crash: d drivers, f distinct flag values; the join has d*f rows.
    Both sides are one row per crash after a map-side partial aggregate, so a
    crash with millions of rows costs a handful of shuffled rows.
    """
    per_crash_drivers = count_by(drivers, CRASH, "n_drivers")
    per_crash_flags = count_by(units.select(CRASH, "veh_hnr_fl").distinct(), CRASH, "n_flags")
    pairs = per_crash_drivers.join(per_crash_flags, CRASH)
    total = F.sum(F.col("n_drivers") * F.col("n_flags"))
    return pairs.agg(F.coalesce(total, F.lit(0)).cast("bigint").alias(out))


def a04_licensed_hit_and_run(t: CrashTables) -> DataFrame:
    """As the job counts it: licensed DRIVER rows times distinct hit-and-run flag values of their crash."""
    drivers = _licensed(t.primary_person.filter(F.col("prsn_type_id") == DRIVER))
    return _driver_unit_flag_pairs(drivers, t.units, "count_licensed")


def a04_hnr(t: CrashTables) -> DataFrame:
    """a04 restricted to units flagged hit and run, which the question asks for."""
    drivers = _licensed(t.primary_person.filter(F.col("prsn_type_id") == DRIVER))
    units = t.units.filter(F.col("veh_hnr_fl") == HIT_AND_RUN_YES)
    return _driver_unit_flag_pairs(drivers, units, "count_licensed")


def hnr_vehicles(t: CrashTables) -> DataFrame:
    """Distinct hit-and-run units that carry a licensed driver: the number of vehicles asked for."""
    units = t.units.filter(F.col("veh_hnr_fl") == HIT_AND_RUN_YES)
    drivers = _licensed(t.primary_person.filter(F.col("prsn_type_id") == DRIVER))
    vehicles = distinct_matching(units, [CRASH, UNIT], drivers, [CRASH, UNIT])
    return count_rows(vehicles, "vehicle_count")


def a05_state_without_females(t: CrashTables) -> DataFrame:
    """Licence state with most crashes that involve no female person.

    ``count(state)``: the NULL state group scores 0.
    """
    p = t.primary_person
    females = p.filter(F.col("prsn_gndr_id") == FEMALE)
    pairs = distinct_not_matching(p, [CRASH, "drvr_lic_state_id"], females, [CRASH])
    counted = count_by(pairs, "drvr_lic_state_id", "state_count", counted="drvr_lic_state_id")
    return top_k_by_measure(counted, "state_count", "drvr_lic_state_id", 1)


def casualties_per_make(t: CrashTables) -> DataFrame:
    """sum(injuries + deaths) per make over distinct (crash, make, injuries, deaths); make 'NA' and NULL out."""
    cars = t.units.filter(F.col(MAKE) != NOT_AVAILABLE)
    cars = cars.select(CRASH, MAKE, "tot_injry_cnt", "death_cnt").distinct()
    casualties = to_number("tot_injry_cnt") + to_number("death_cnt")
    return cars.groupBy(MAKE).agg(F.sum(casualties).cast("bigint").alias("sum_cas"))


def a06_makes_ranked_3_to_5(t: CrashTables) -> DataFrame:
    """Makes ranked 3rd to 5th by casualties."""
    return rank_band(casualties_per_make(t), measure_then_key("sum_cas", MAKE), 3, 5)


def a07_top_ethnicity_per_body_style(t: CrashTables) -> DataFrame:
    """Per body style, the ethnicity with most persons in units of that style."""
    bodies = t.units.filter(not_in_values("veh_body_styl_id", BODY_STYLES_EXCLUDED))
    bodies = bodies.select(CRASH, UNIT, "veh_body_styl_id").distinct()
    people = t.primary_person.filter(not_in_values("prsn_ethnicity_id", ETHNICITIES_EXCLUDED))
    # Persons per (unit, ethnicity) first: the join then carries counts, not persons,
    # and copies of one unit collapse map side.  Joining raw persons on (crash, unit)
    # saves one shuffle but leaves a hot unit to AQE's skew split, which only acts
    # past its size thresholds (tests/skew_probe.py: 4.3k vs 11.8k rows in the
    # busiest task with a third of all rows in one crash).
    people = count_by(people, [CRASH, UNIT, "prsn_ethnicity_id"], "n_persons")
    pairs = people.join(bodies, [CRASH, UNIT])
    counted = pairs.groupBy("prsn_ethnicity_id", "veh_body_styl_id").agg(
        F.sum("n_persons").alias("cnt"))
    top = top_1_per_group(counted, "veh_body_styl_id", "prsn_ethnicity_id", "cnt")
    return top.select("prsn_ethnicity_id", "veh_body_styl_id")


def alcohol_units(t: CrashTables) -> DataFrame:
    return t.units.filter(any_like(ALCOHOL_FACTOR_COLUMNS, ALCOHOL_PATTERN))


def a08_alcohol_zip_codes(t: CrashTables) -> DataFrame:
    """Top 5 driver zip codes by crashes with alcohol as a contributing factor.

    A crash of very many zip codes keeps them after the distinct, so those of a hot crash are dealt to many tasks.
    """
    with_zip = t.primary_person.filter(F.col("drvr_zip").isNotNull())
    crash_zips = salted_semi_join(with_zip.select(CRASH, "drvr_zip").distinct(), alcohol_units(t), [CRASH], with_zip)
    return top_k_by_measure(count_by(crash_zips, "drvr_zip", "tot_count"), "tot_count", "drvr_zip", 5)


def insured_high_damage_units(t: CrashTables) -> DataFrame:
    u = t.units
    high = in_values("veh_dmag_scl_1_id", HIGH_DAMAGE_LEVELS) | in_values("veh_dmag_scl_2_id", HIGH_DAMAGE_LEVELS)
    return u.filter(high & F.col("fin_resp_type_id").like(INSURANCE_PATTERN))


def a09_insured_no_damage_crashes(t: CrashTables) -> DataFrame:
    """Distinct crashes with an insured unit of damage level 5+ and no row in damages."""
    crashes = distinct_not_matching(insured_high_damage_units(t), [CRASH], t.damages, [CRASH])
    return count_rows(crashes, "count_no_damage")


def _top_values_but(counted: DataFrame, attr: str, excluded: list[str], n: int) -> DataFrame:
    """The top ``n`` values of ``attr`` in (attr, n_found), those excluded and NULL left out.

    They are left out after a first cut that has room for them: a filter before it would be moved into the scan and give
    this list a relation of its own.
    """
    wide = top_k_by_measure(counted, "n_found", attr, n + len(excluded) + 1)
    return top_k_by_measure(wide.filter(not_in_values(attr, excluded)), "n_found", attr, n).select(attr)


def speeding_makes(t: CrashTables, excluded_states: list[str] | None = None) -> DataFrame:
    """Top 5 makes by (licensed person, unit, speeding charge) combinations per crash.

    The units are restricted to the top 10 colours (by distinct units) and
    the top 25 licence states (by distinct crashes).  The original joins
    persons x units x charges on crash_id and counts the rows; that product
    is quadratic in a big crash.  Here each side is reduced to a per-crash
    count first and the product is summed: the same number, exactly.

    Both lists and the units come from one relation of distinct vehicles, so
    that Spark scans and shuffles ``units`` once.  The lists are bounded by
    their limits, so they are broadcast.  Joins of the relation are null-safe
    although no NULL is on their other side: a plain equality would put a NULL
    filter into the scan of one use, and the relation would be no longer the
    same.
    """
    # Counted and asked for one row or more, which all have: a plain distinct would be merged into those below.
    vehicles = having_count(t.units, [CRASH, UNIT, MAKE, "veh_color_id", "veh_lic_state_id"], 1, "n_rows", inclusive=True)
    colours = _top_values_but(count_by(vehicles.select(CRASH, UNIT, "veh_color_id").distinct(), "veh_color_id", "n_found"),
                              "veh_color_id", [NOT_AVAILABLE], TOP_COLOURS)
    states = _top_values_but(count_by(vehicles.select(CRASH, "veh_lic_state_id").distinct(), "veh_lic_state_id", "n_found"),
                             "veh_lic_state_id", excluded_states or [NOT_AVAILABLE], TOP_STATES)
    cars = vehicles
    for top in (colours, states):
        (attr,) = top.columns
        cars = cars.join(F.broadcast(top.select(F.col(attr).alias("one_of_top"))), F.col(attr).eqNullSafe(F.col("one_of_top")), "left_semi")
    cars_per_crash = count_by(cars, [CRASH, MAKE], "n_cars").withColumnRenamed(CRASH, "car_crash")
    licensed_per_crash = count_by(_licensed(t.primary_person), CRASH, "n_licensed")
    speeding_per_crash = count_by(t.charges.filter(F.col("charge").like(SPEEDING_PATTERN)), CRASH, "n_speeding")
    per_crash = licensed_per_crash.join(speeding_per_crash, CRASH).join(cars_per_crash, F.col(CRASH).eqNullSafe(F.col("car_crash")))
    combos = F.col("n_cars") * F.col("n_licensed") * F.col("n_speeding")
    made = per_crash.groupBy(MAKE).agg(F.sum(combos).cast("bigint").alias("make_count"))
    return top_k_by_measure(made, "make_count", MAKE, 5)


def a10_speeding_makes(t: CrashTables) -> DataFrame:
    return speeding_makes(t)


ANALYSES = {
    "a01": a01_male_deaths,
    "a02": a02_two_wheelers_booked,
    "a03": a03_top_makes_fatal_no_airbag,
    "a04": a04_licensed_hit_and_run,
    "a05": a05_state_without_females,
    "a06": a06_makes_ranked_3_to_5,
    "a07": a07_top_ethnicity_per_body_style,
    "a08": a08_alcohol_zip_codes,
    "a09": a09_insured_no_damage_crashes,
    "a10": a10_speeding_makes,
}
