"""Query registry: key -> callable(spark, sf_dir) -> DataFrame, plus the oracle SQL per key."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.operators import count_by
from roadlens.plans.analyses import ANALYSES
from roadlens.plans.job import result_row_counts, run_job
from roadlens.plans.oracles import all_oracles
from roadlens.plans.star import STAR
from roadlens.plans.variants import VARIANTS, no_damage_not_in_parts
from roadlens.session import Scratch, scratch_path
from roadlens.sources.files import read_table, write_result
from roadlens.sources.fixtures import crash_tables, extra_tables, star_table
from roadlens.sources.tables import CrashTables, count_bad_rows, register_views

Query = Callable[[SparkSession, str], DataFrame]


def _on_crash_tables(fn: Callable[[CrashTables], DataFrame], spark: SparkSession, sf_dir: str) -> DataFrame:
    return fn(crash_tables(spark, sf_dir))


def _on_star_tables(fn, spark: SparkSession, sf_dir: str) -> DataFrame:
    return fn(partial(star_table, spark, sf_dir))


def _cleaned(fn: Query) -> Query:
    """A query whose small result is written, and whose scratch folders are then deleted."""
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        with Scratch(spark) as own:
            return own.hand_over(fn(spark, sf_dir), "result")

    return run


def o_csv_roundtrip(spark: SparkSession, sf_dir: str, typed: bool = False) -> DataFrame:
    """Write ``units`` as header CSV to the shared folder and read it back."""
    path = scratch_path(spark, "csv")
    write_result(crash_tables(spark, sf_dir).units, path, fmt="csv")
    return read_table(spark, path, fmt="csv", table="units", typed=typed)


def o_csv_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return o_csv_roundtrip(spark, sf_dir, typed=True)


def o_csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write ``primary_person`` as CSV and read it with inferred types: its numbers come back as such."""
    path = scratch_path(spark, "csv")
    write_result(crash_tables(spark, sf_dir).primary_person, path, fmt="csv")
    people = read_table(spark, path, fmt="csv", infer=True)
    return people.select("crash_id", "unit_nbr", "prsn_nbr", "drvr_zip")


def o_csv_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write ``units`` into one folder in files of two column orders (one with capital headers), and read them as one table."""
    path = scratch_path(spark, "csv")
    units = crash_tables(spark, sf_dir).units
    turned = units.select(*[F.col(c).alias(c.upper()) for c in reversed(units.columns)])
    units.filter(F.col("veh_hnr_fl") == "Y").write.option("header", True).csv(path)
    turned.filter(F.col("VEH_HNR_FL") != "Y").write.option("header", True).mode("append").csv(path)
    return read_table(spark, path, fmt="csv", table="units", bad_rows="refuse").select(*units.columns)


@_cleaned
def o_csv_bad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write ``damages`` as CSV lines of which those of two properties have a field too few or too many, and count good and bad rows."""
    path = scratch_path(spark, "csv")
    crash, what = F.coalesce("crash_id", F.lit("0")), F.col("damaged_property")
    line = F.when(what == "1-URGENT", crash).when(what == "2-HIGH", F.concat_ws(",", crash, what, what)).otherwise(F.concat_ws(",", crash, what))
    damages = crash_tables(spark, sf_dir).damages.select(line.alias("crash_id,damaged_property"))
    damages.write.option("header", True).option("quote", "").csv(path)
    return count_bad_rows(spark, {"damages": path})


@_cleaned
def o_single_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count ``damages`` by property, write the counts as one CSV file and read it back: its sum and its files.

    The counts are bounded by the properties, so the one task that writes them does not grow with the table.
    """
    path = scratch_path(spark, "csv")
    counted = crash_tables(spark, sf_dir).damages.groupBy("damaged_property").agg(F.count("*").alias("n"))
    write_result(counted, path, fmt="csv", single_file=True)
    back = spark.read.schema("damaged_property string, n long").option("header", True).csv(path)
    return back.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
                    F.count_distinct("_metadata.file_path").alias("file_count"))


@_cleaned
def o_extra_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the endorsement and restriction tables as CSV, scan them, and count their codes."""
    out = []
    for name, df in extra_tables(spark, sf_dir).items():
        path = scratch_path(spark, name)
        write_result(df, path, fmt="csv")
        back = read_table(spark, path, fmt="csv")
        out.append(back.groupBy(F.col(back.columns[-1]).alias("code")).agg(F.count("*").alias("row_count"))
                   .select(F.lit(name).alias("table_name"), "code", "row_count"))
    return out[0].unionByName(out[1])


#: Views are registered under this prefix, so that views of the caller are left alone.
VIEWS = "roadlens_"


def o_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Register the crash tables as temp views and read ``units`` back by name."""
    register_views(crash_tables(spark, sf_dir), VIEWS)
    return count_by(spark.table(f"{VIEWS}units"), "veh_hnr_fl", "unit_rows")


def _sql_over_views(text: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    register_views(crash_tables(spark, sf_dir), VIEWS)
    return spark.sql(text)


SQL_TEXTS = {
    # HAVING: a01
    "o_sql_views": f"""
        SELECT crash_id, count(*) AS male_death_count FROM {VIEWS}primary_person
        WHERE prsn_gndr_id = 'MALE' AND prsn_injry_sev_id = 'KILLED'
        GROUP BY crash_id HAVING count(*) > 2""",
    # IN subquery: v_top_makes_in
    "o_sql_in": f"""
        SELECT veh_make_id, count(DISTINCT struct(crash_id, unit_nbr)) AS cnt FROM {VIEWS}units
        WHERE crash_id IN (
            SELECT crash_id FROM {VIEWS}primary_person
            WHERE prsn_type_id = 'DRIVER' AND prsn_injry_sev_id = 'KILLED' AND prsn_airbag_id = 'NOT DEPLOYED')
        GROUP BY veh_make_id ORDER BY cnt DESC, veh_make_id NULLS LAST LIMIT 5""",
    # NOT IN, by its NULL rules: v_non_female_pairs.  Spark plans the subquery form with the whole list broadcast, copies
    # and all; so an anti join with the known ids, once each, after the rule for the list as a whole: empty keeps all
    # rows, a NULL in it none, else those with an id.
    "o_sql_not_in": f"""
        WITH females AS (SELECT crash_id FROM {VIEWS}primary_person WHERE prsn_gndr_id = 'FEMALE'),
        pairs AS (
            SELECT DISTINCT crash_id, drvr_lic_state_id FROM {VIEWS}primary_person
            WHERE drvr_lic_cls_id <> 'OTHER/OUT OF STATE')
        SELECT count(*) AS pair_count FROM pairs
        LEFT ANTI JOIN (SELECT DISTINCT crash_id FROM females WHERE crash_id IS NOT NULL) USING (crash_id)
        WHERE CASE (SELECT CASE WHEN count(*) = 0 THEN 'empty' WHEN count(crash_id) = count(*) THEN 'known' END FROM females)
            WHEN 'empty' THEN true WHEN 'known' THEN crash_id IS NOT NULL ELSE false END""",
    # CTEs and a join: v_bottom_makes
    "o_sql_cte": f"""
        WITH fatal AS (
            SELECT crash_id, count(*) AS n FROM {VIEWS}primary_person
            WHERE prsn_type_id = 'DRIVER' AND prsn_injry_sev_id = 'KILLED' AND prsn_airbag_id = 'NOT DEPLOYED'
            GROUP BY crash_id),
        cars AS (
            SELECT crash_id, veh_make_id, count(DISTINCT struct(unit_nbr)) AS n FROM {VIEWS}units
            GROUP BY crash_id, veh_make_id)
        SELECT veh_make_id, sum(cars.n * fatal.n) AS make_count FROM cars JOIN fatal USING (crash_id)
        GROUP BY veh_make_id ORDER BY make_count, veh_make_id NULLS LAST LIMIT 5""",
}


@_cleaned
def o_job_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The configured job from end to end: packed CSV inputs with capital headers, loaded by location and staged,
    ten analyses written; (analysis, row_count) of what was written."""
    root = scratch_path(spark, "job")
    inputs = {}
    for name, df in crash_tables(spark, sf_dir).as_dict().items():
        inputs[name] = f"{root}/input/{name}"
        write_result(df.toDF(*[c.upper() for c in df.columns]), inputs[name], fmt="csv", compression="gzip")
    config = {"input_locations": inputs, "output_locations": {name: f"{root}/{name}" for name in ANALYSES},
              "output_format": "csv", "parallel": 4}
    return result_row_counts(spark, run_job(spark, config))


def build_queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for name, fn in {**ANALYSES, **VARIANTS}.items():
        out[name] = partial(_on_crash_tables, fn)
    for name, fn in STAR.items():
        out[name] = partial(_on_star_tables, fn)
    out.update({
        "o_csv_roundtrip": o_csv_roundtrip,
        "o_csv_typed": o_csv_typed,
        "o_csv_inferred": o_csv_inferred,
        "o_csv_headers": o_csv_headers,
        "o_csv_bad_rows": o_csv_bad_rows,
        "o_single_file": o_single_file,
        "o_extra_tables": o_extra_tables,
        "o_not_in_parts": partial(_on_crash_tables, no_damage_not_in_parts),
        "o_views": o_views,
        **{name: partial(_sql_over_views, text) for name, text in SQL_TEXTS.items()},
        "o_job_all": o_job_all,
    })
    return out


QUERIES = build_queries()
ORACLES = {name: sql for name, sql in all_oracles().items() if name in QUERIES}
