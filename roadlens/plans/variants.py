"""Alternative definitions of the questions (v_*): earlier drafts and SQL forms.

Some give the same rows as the standing answer by another route (IN
subquery, dedup before filter, NOT IN); they are kept as checks.  Others
answer a different question and are kept because they are asked that way.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.functions import in_values, measure_then_key, to_number
from roadlens.operators import (
    count_by,
    count_entities,
    count_rows,
    distinct_matching,
    drop_not_in,
    first_per_key,
    having_count,
    limit_offset,
    salted_semi_join,
    sum_having,
    top_k_by_measure,
)
from roadlens.plans import analyses as A
from roadlens.sources.tables import CrashTables

# Fixed values used only by the variants.
UNLICENSED = "UNLICENSED"
OUT_OF_STATE_LICENCE = "OTHER/OUT OF STATE"
TWO_WHEELER_WORD = "MOTORCYCLE"
STATES_EXCLUDED_SQL_FORM = ["Unknown", "NA"]

CRASH, UNIT, MAKE = A.CRASH, A.UNIT, A.MAKE


def male_deaths_ge2(t: CrashTables) -> DataFrame:
    """Crashes with at least two killed males, largest first: (crash_id, death_count)."""
    counted = having_count(A._killed_males(t), [CRASH], 2, "death_count", inclusive=True)
    return counted.orderBy(F.col("death_count").desc(), F.col(CRASH).asc_nulls_last())


def death_sum(t: CrashTables) -> DataFrame:
    """Deaths from units: sum of death_cnt over distinct (crash, unit, death_cnt), kept when > 2."""
    return sum_having(t.units, [CRASH, UNIT, "death_cnt"], CRASH, to_number("death_cnt"), 2, "tot_death_count")


def male_death_crash_count(t: CrashTables) -> DataFrame:
    """The number a01 is asked for: how many crashes have more than two killed males."""
    return count_rows(A.a01_male_deaths(t), "crash_count")


def booked_crashes(t: CrashTables) -> DataFrame:
    """Distinct crashes with a charged two-wheeler unit (charges joined without dedup)."""
    bikes = t.units.filter(in_values("veh_body_styl_id", A.TWO_WHEELER_BODIES))
    units = distinct_matching(bikes, [CRASH, UNIT], t.charges, [CRASH, UNIT])
    return count_entities(units, [CRASH], "crash_count")


def two_wheelers_all(t: CrashTables) -> DataFrame:
    """Distinct units whose body style contains MOTORCYCLE, charged or not."""
    bikes = t.units.filter(F.col("veh_body_styl_id").contains(TWO_WHEELER_WORD))
    return count_entities(bikes, [CRASH, UNIT], "unit_count")


def charge_rows(t: CrashTables) -> DataFrame:
    return count_rows(t.charges, "charge_rows")


def bottom_makes(t: CrashTables) -> DataFrame:
    """Five rarest makes, each unit counted once per fatal-driver row of its crash.

    The draft joins the fatal persons (not deduplicated) to distinct units and
    counts join rows; here units per (crash, make) times fatal rows per crash.
    """
    fatal_per_crash = count_by(A._fatal_drivers_no_airbag(t), CRASH, "n_fatal")
    cars = count_by(t.units.select(CRASH, UNIT, MAKE).distinct(), [CRASH, MAKE], "n_cars")
    joined = cars.join(fatal_per_crash, CRASH)
    made = joined.groupBy(MAKE).agg(F.sum(F.col("n_cars") * F.col("n_fatal")).cast("bigint").alias("make_count"))
    return top_k_by_measure(made, "make_count", MAKE, 5, ascending=True)


def top_makes_in(t: CrashTables) -> DataFrame:
    """a03 in its IN-subquery form: distinct units WHERE crash_id IN (fatal crashes).

    Spark rewrites ``col.isin(subquery)`` into a semi join, but only after
    pushing the predicate below the ``distinct`` onto raw unit rows, where a
    hot crash meets in one task.  So the semi join is written out, on the
    units counted per (crash, make).
    """
    return A.makes_by_units(t, A._fatal_drivers_no_airbag(t).select(CRASH))


def not_unlicensed(t: CrashTables) -> DataFrame:
    """a04 with licence <> 'UNLICENSED' instead of LIKE '%CLASS%' (NULL licence out)."""
    p = t.primary_person
    drivers = p.filter((F.col("prsn_type_id") == A.DRIVER) & (F.col("drvr_lic_cls_id") != UNLICENSED))
    return A._driver_unit_flag_pairs(drivers, t.units, "row_count")


def _non_female_pairs(t: CrashTables) -> DataFrame:
    """Distinct (crash, state) with crash NOT IN female crashes (NULL-aware) and licence <> out of state."""
    p = t.primary_person
    females = p.filter(F.col("prsn_gndr_id") == A.FEMALE)
    pairs = p.filter(F.col("drvr_lic_cls_id") != OUT_OF_STATE_LICENCE).select(CRASH, "drvr_lic_state_id").distinct()
    return drop_not_in(pairs, CRASH, females)


def non_female_pairs(t: CrashTables) -> DataFrame:
    return count_rows(_non_female_pairs(t), "pair_count")


def non_female_state(t: CrashTables) -> DataFrame:
    """As a05 with the licence filter and ``count(*)``, so the NULL state can win."""
    counted = count_by(_non_female_pairs(t), "drvr_lic_state_id", "state_count")
    return top_k_by_measure(counted, "state_count", "drvr_lic_state_id", 1)


def rank_3_to_7(t: CrashTables) -> DataFrame:
    """``LIMIT 5 OFFSET 2`` over the casualty ranking: ranks 3 to 7, not 3 to 5."""
    return limit_offset(A.casualties_per_make(t), measure_then_key("sum_cas", MAKE), 5, 2)


def zip_dedup_first(t: CrashTables) -> DataFrame:
    """a08 with the dedup first: first person row per (crash, zip) by unit, then the alcohol IN filter."""
    p = t.primary_person.select(CRASH, "drvr_zip", UNIT)
    firsts = first_per_key(p, [CRASH, "drvr_zip"], [F.col(UNIT).asc_nulls_last()])
    # One row per (crash, zip) already; the distinct costs no shuffle (the window
    # output is partitioned by these keys) and keeps Catalyst from moving the
    # crash filter below the window onto raw person rows when the list is large.
    pairs = firsts.select(CRASH, "drvr_zip").distinct().filter(F.col("drvr_zip").isNotNull())
    kept = salted_semi_join(pairs, A.alcohol_units(t), [CRASH], p)
    return top_k_by_measure(count_by(kept, "drvr_zip", "tot_count"), "tot_count", "drvr_zip", 5)


def no_damage_not_in(t: CrashTables) -> DataFrame:
    """a09 with NOT IN (damages): equal to a09 unless damages holds a NULL crash_id."""
    crashes = A.insured_high_damage_units(t).select(CRASH).distinct()
    return count_rows(drop_not_in(crashes, CRASH, t.damages), "crash_count")


def no_damage_not_in_parts(t: CrashTables) -> DataFrame:
    """v_no_damage_not_in against each part of damages by itself: (damaged_part, crash_count).

    Parts are damages without a crash, damages with one, and none at all: a NULL in the list keeps nothing, an empty list everything.
    """
    crashes = A.insured_high_damage_units(t).select(CRASH).distinct()
    parts = {"unknown": F.col(CRASH).isNull(), "known": F.col(CRASH).isNotNull(), "none": F.col("damaged_property") == ""}
    counts = [count_rows(drop_not_in(crashes, CRASH, t.damages.filter(rows)), "crash_count").select(F.lit(name).alias("damaged_part"), "crash_count")
              for name, rows in parts.items()]
    return reduce(DataFrame.unionByName, counts)


def speeding_in(t: CrashTables) -> DataFrame:
    """a10 with state 'Unknown' also left out of the top 25."""
    return A.speeding_makes(t, excluded_states=STATES_EXCLUDED_SQL_FORM)


VARIANTS = {
    "v_male_deaths_ge2": male_deaths_ge2,
    "v_death_sum": death_sum,
    "v_male_death_crash_count": male_death_crash_count,
    "v_booked_crashes": booked_crashes,
    "v_two_wheelers_all": two_wheelers_all,
    "v_charge_rows": charge_rows,
    "v_bottom_makes": bottom_makes,
    "v_top_makes_in": top_makes_in,
    "v_not_unlicensed": not_unlicensed,
    "v_non_female_pairs": non_female_pairs,
    "v_non_female_state": non_female_state,
    "v_rank_3_to_7": rank_3_to_7,
    "v_zip_dedup_first": zip_dedup_first,
    "v_no_damage_not_in": no_damage_not_in,
    "v_speeding_in": speeding_in,
    "v_hnr_vehicles": A.hnr_vehicles,
    "a04_hnr": A.a04_hnr,
}
