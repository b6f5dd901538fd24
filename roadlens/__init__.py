"""roadlens: road-crash analytics as Spark DataFrame plans.

Four crash tables (persons, units, damages, charges) go in, the ten standing
questions and their variants come out as DataFrames.  Everything is expressed
with the DataFrame API so Catalyst and AQE choose the physical plan; the
generic operators live in :mod:`roadlens.operators`, the questions in
:mod:`roadlens.plans`.

Typical use::

    from roadlens import load_tables, ANALYSES, run_job
    tables = load_tables(spark, {"primary_person": ..., "units": ..., "damages": ..., "charges": ...})
    ANALYSES["a03"](tables).show()
    run_job(spark, {"input_locations": {...}, "output_locations": {...}})
"""

from roadlens.plans.analyses import ANALYSES
from roadlens.plans.job import run_job
from roadlens.plans.variants import VARIANTS
from roadlens.sources.files import read_table, write_result
from roadlens.sources.tables import CrashTables, load_tables, register_views, stage_tables

__all__ = [
    "ANALYSES", "VARIANTS", "CrashTables", "load_tables", "read_table", "register_views", "run_job",
    "stage_tables", "write_result",
]
