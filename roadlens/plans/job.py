"""Config-driven batch job: load the four tables, run the analyses, write one result each.

Config (a mapping, or a YAML/JSON file holding one)::

    input_locations:  {primary_person: ..., units: ..., damages: ..., charges: ...}
    output_locations: {output_1: ..., ..., output_10: ...}   # or a01 .. a10
    input_format: csv          # or parquet
    typed: false               # cast the count columns to int (try_cast) at the source
    infer_schema: false        # let Spark infer CSV column types (one extra pass)
    bad_rows: keep             # CSV rows of too many or too few fields: keep, drop or refuse
    output_format: csv         # or parquet
    stage: true                # stage CSV inputs as Parquet once (default for csv)
    persist: false             # keep the inputs in memory/disk between the analyses instead
    parallel: 1                # analyses submitted at once (Spark runs their jobs side by side)
    stage_location: ...        # default: a fresh folder under spark.checkpoint.dir
    single_file: false         # coalesce each (small) result to one file

Run with ``spark-submit run_job.py --config params.yml`` from the repository root.
"""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.plans.analyses import ANALYSES
from roadlens.session import SCALE_CONF, delete_path, scratch_path
from roadlens.sources.files import read_table, write_result
from roadlens.sources.tables import CrashTables, load_tables, stage_tables, used_columns


def load_config(path: str) -> dict:
    with open(path) as fh:
        text = fh.read()
    if path.endswith((".yml", ".yaml")):
        try:
            import yaml
        except ImportError as exc:  # pragma: no cover - yaml is optional
            raise RuntimeError("YAML config needs PyYAML; use a .json config instead") from exc
        return yaml.safe_load(text)
    return json.loads(text)


def output_location(name: str, locations: dict[str, str]) -> str | None:
    """``a03`` is configured as ``a03`` or as ``output_3``."""
    return locations.get(name) or locations.get(f"output_{int(name[1:])}")


def run_job(
    spark: SparkSession,
    config: dict,
    tables: CrashTables | None = None,
    analyses: dict[str, Callable[[CrashTables], DataFrame]] | None = None,
) -> dict[str, str]:
    """Run every configured analysis; returns {analysis: output path}.

    One failing analysis does not stop the others; the failures are raised
    together at the end.  Inputs that the job staged itself are deleted when it
    ends, well or not.
    """
    fmt_in = config.get("input_format", "csv")
    if tables is None:
        tables = load_tables(spark, config["input_locations"], fmt=fmt_in,
                             typed=config.get("typed", False), infer=config.get("infer_schema", False),
                             bad_rows=config.get("bad_rows", "keep"))
        if config.get("stage", fmt_in == "csv"):
            own_stage = None if config.get("stage_location") else scratch_path(spark, "stage")
            try:
                staged = stage_tables(spark, tables, own_stage or config["stage_location"])
                return run_job(spark, config, tables=staged, analyses=analyses)
            finally:
                if own_stage:  # never a folder the user named
                    delete_path(spark, own_stage)
    if config.get("persist", False):
        # Blocks lost with an executor are recomputed from the (short) lineage.
        tables = tables.map(lambda name, df: used_columns(name, df).persist(StorageLevel.MEMORY_AND_DISK))
    outputs = config.get("output_locations", {})
    todo = {name: (fn, output_location(name, outputs)) for name, fn in (analyses or ANALYSES).items()}
    todo = {name: item for name, item in todo.items() if item[1] is not None}
    written: dict[str, str] = {}
    failed: dict[str, Exception] = {}

    def run_one(name: str) -> None:
        fn, path = todo[name]
        try:
            write_result(fn(tables), path, fmt=config.get("output_format", "csv"),
                         single_file=config.get("single_file", False))
            written[name] = path
        except Exception as exc:  # noqa: BLE001 - reported below
            failed[name] = exc

    try:
        # Each analysis is its own set of Spark jobs; with parallel > 1 they are
        # submitted from several threads and share the executors (the tail of
        # one analysis overlaps the scans of the next).
        with ThreadPoolExecutor(max_workers=max(1, int(config.get("parallel", 1)))) as pool:
            list(pool.map(run_one, todo))
    finally:
        if config.get("persist", False):
            tables.map(lambda name, df: df.unpersist())
    if failed:
        raise RuntimeError(f"analyses failed: {sorted(failed)}") from next(iter(failed.values()))
    return {name: written[name] for name in todo if name in written}


def result_row_counts(spark: SparkSession, written: dict[str, str], fmt: str = "csv") -> DataFrame:
    """(analysis, row_count) of each written result, read back from storage."""
    parts = [
        read_table(spark, path, fmt=fmt).agg(F.count("*").alias("row_count"))
        .select(F.lit(name).alias("analysis"), "row_count")
        for name, path in written.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description="Run the crash analyses")
    parser.add_argument("--config", required=True)
    args = parser.parse_args(argv)
    builder = SparkSession.builder.appName("roadlens-job")
    for key, value in SCALE_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    try:
        for name, path in run_job(spark, load_config(args.config)).items():
            print(f"{name} -> {path}")
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
