"""CSV / Parquet sources and sinks, views, staging, and the config-driven job."""

from __future__ import annotations

import json
import os

from pyspark.sql import functions as F

import pytest

from conftest import SF_SMALL, rows
from roadlens.plans import registry
from roadlens.plans.analyses import ANALYSES
from roadlens.plans.job import load_config, output_location, result_row_counts, run_job
from roadlens.sources import files
from roadlens.sources.files import read_table, write_result
from roadlens.sources.schemas import TABLE_COLUMNS
from roadlens.sources.tables import CrashTables, register_views


def _as_strings(df):
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def test_csv_roundtrip_keeps_rows(spark, tables_small, tmp_out):
    path = f"{tmp_out}/units"
    write_result(tables_small.units, path)
    back = read_table(spark, path, fmt="csv", table="units")
    assert back.columns == tables_small.units.columns
    assert rows(back) == rows(tables_small.units)


def test_overwrite_replaces_old_output(spark, tables_small, tmp_out):
    path = f"{tmp_out}/out"
    write_result(tables_small.charges, path)
    write_result(tables_small.damages.limit(3), path)
    assert read_table(spark, path).count() == 3


def test_single_file_sink(spark, tables_small, tmp_out):
    path = f"{tmp_out}/one"
    write_result(tables_small.damages, path, single_file=True)
    assert len([f for f in os.listdir(path) if f.startswith("part-")]) == 1


def test_upper_case_headers_and_typed_read(spark, tmp_out):
    path = f"{tmp_out}/raw.csv"
    with open(path, "w") as fh:
        fh.write("CRASH_ID,UNIT_NBR,TOT_INJRY_CNT,DEATH_CNT\n1,1,2.0,x\n2,1,,0\n")
    plain = read_table(spark, path, fmt="csv", table="units")
    assert plain.columns == ["crash_id", "unit_nbr", "tot_injry_cnt", "death_cnt"]
    assert dict(plain.dtypes)["tot_injry_cnt"] == "string"
    typed = read_table(spark, path, fmt="csv", table="units", typed=True)
    assert dict(typed.dtypes)["death_cnt"] == "bigint"
    assert rows(typed.select("crash_id", "tot_injry_cnt", "death_cnt")) == [("1", 2, None), ("2", None, 0)]


def test_views_and_table_lookup(spark, tables_small):
    names = register_views(tables_small, "t_")
    assert set(names) == {"t_primary_person", "t_units", "t_damages", "t_charges"}
    assert spark.table("t_charges").count() == tables_small.charges.count()


def test_views_belong_to_the_session_of_the_call(spark):
    """Another session's earlier queries do not matter, and a caller's own view keeps its rows."""
    from conftest import SF_SMALL
    from roadlens.plans.registry import QUERIES

    QUERIES["a01"](spark, SF_SMALL).count()
    other = spark.newSession()
    other.range(3).createOrReplaceTempView("units")
    assert QUERIES["o_views"](other, SF_SMALL).count() == 2
    assert QUERIES["o_sql_views"](other, SF_SMALL).count() == QUERIES["a01"](spark, SF_SMALL).count()
    assert other.table("units").count() == 3


def _staged(spark):
    from roadlens.session import shared_dir

    folder = shared_dir(spark).removeprefix("file:")
    return {f for f in os.listdir(folder) if f.startswith("roadlens-stage-")} if os.path.isdir(folder) else set()


def test_job_deletes_only_what_it_staged(spark, tables_small, tmp_out):
    inputs = {}
    for name, df in tables_small.as_dict().items():
        inputs[name] = f"{tmp_out}/life/{name}"
        write_result(df, inputs[name], fmt="csv")
    before = _staged(spark)
    config = {"input_locations": inputs, "output_locations": {"a01": f"{tmp_out}/life/a01"}}
    run_job(spark, config)
    assert _staged(spark) == before

    def failing(t):
        raise ValueError("no")

    with pytest.raises(RuntimeError):
        run_job(spark, config, analyses={"a01": failing})
    assert _staged(spark) == before
    run_job(spark, {**config, "stage_location": f"{tmp_out}/life/mine"})
    assert os.path.isdir(f"{tmp_out}/life/mine/units")


def test_config_files(tmp_out):
    yml = f"{tmp_out}/p.yml"
    with open(yml, "w") as fh:
        fh.write("input_locations:\n  units: a.csv\noutput_locations:\n  output_3: out3\n")
    cfg = load_config(yml)
    assert cfg["input_locations"]["units"] == "a.csv"
    assert output_location("a03", cfg["output_locations"]) == "out3"
    js = f"{tmp_out}/p.json"
    with open(js, "w") as fh:
        json.dump({"output_locations": {"a10": "x"}}, fh)
    assert output_location("a10", load_config(js)["output_locations"]) == "x"


def test_job_from_csv_files_with_staging(spark, tables_small, tmp_out):
    """CSV in (upper-case headers, as shipped), staged to Parquet, ten CSV results out."""
    inputs = {}
    for name, df in tables_small.as_dict().items():
        inputs[name] = f"{tmp_out}/in/{name}"
        write_result(df.toDF(*[c.upper() for c in df.columns]), inputs[name])
    outputs = {f"output_{i}": f"{tmp_out}/out/analysis_{i}" for i in range(1, 11)}
    config = {"input_locations": inputs, "output_locations": outputs,
              "stage_location": f"{tmp_out}/stage"}
    written = run_job(spark, config)
    assert sorted(written) == sorted(ANALYSES)
    assert os.path.isdir(f"{tmp_out}/stage/units")
    for name, fn in ANALYSES.items():
        back = read_table(spark, written[name])
        assert rows(back) == rows(_as_strings(fn(tables_small))), name
    counts = {r["analysis"]: r["row_count"] for r in result_row_counts(spark, written).collect()}
    assert counts["a03"] == 5 and counts["a02"] == 1


def test_job_parquet_in_and_out(spark, tables_small, tmp_out):
    inputs = {}
    for name, df in tables_small.as_dict().items():
        inputs[name] = f"{tmp_out}/pin/{name}"
        write_result(df, inputs[name], fmt="parquet")
    config = {"input_locations": inputs, "input_format": "parquet", "output_format": "parquet",
              "output_locations": {"a06": f"{tmp_out}/pout/a06"}}
    written = run_job(spark, config)
    assert list(written) == ["a06"]
    assert rows(read_table(spark, written["a06"], fmt="parquet")) == rows(ANALYSES["a06"](tables_small))


def test_job_reports_failures_after_running_the_rest(spark, tables_small, tmp_out):
    def broken(t: CrashTables):
        return t.units.select("no_such_column")

    config = {"output_locations": {"a01": f"{tmp_out}/f/a01", "a02": f"{tmp_out}/f/a02"}}
    try:
        run_job(spark, config, tables=tables_small, analyses={"a01": broken, "a02": ANALYSES["a02"]})
    except RuntimeError as exc:
        assert "a01" in str(exc)
    else:
        raise AssertionError("expected a failure")
    assert read_table(spark, f"{tmp_out}/f/a02").count() == 1


def test_inferred_schema_read(spark, tmp_out):
    path = f"{tmp_out}/raw.csv"
    with open(path, "w") as fh:
        fh.write("Crash_ID,Death_Cnt\n1,2\n2,0\n")
    df = read_table(spark, path, fmt="csv", infer=True)
    assert dict(df.dtypes) == {"crash_id": "int", "death_cnt": "int"}


def test_job_with_inferred_types_gives_the_same_answers(spark, tables_small, tmp_out):
    inputs = {}
    for name, df in tables_small.as_dict().items():
        inputs[name] = f"{tmp_out}/inf/{name}"
        write_result(df, inputs[name])
    config = {"input_locations": inputs, "infer_schema": True, "stage": False,
              "output_locations": {"a06": f"{tmp_out}/inf_out/a06", "a01": f"{tmp_out}/inf_out/a01"}}
    written = run_job(spark, config)
    for name in ("a01", "a06"):
        assert rows(read_table(spark, written[name])) == rows(_as_strings(ANALYSES[name](tables_small))), name


def test_shared_folder_comes_from_the_checkpoint_dir(spark):
    from roadlens.session import scratch_path, shared_dir

    ckpt = spark.sparkContext.getCheckpointDir()
    assert ckpt and shared_dir(spark) == ckpt.rstrip("/")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(shared_dir(spark) + "/")


def test_job_with_persisted_inputs(spark, tables_small, tmp_out):
    config = {"output_locations": {"a03": f"{tmp_out}/p/a03"}, "persist": True}
    written = run_job(spark, config, tables=tables_small)
    assert rows(read_table(spark, written["a03"])) == rows(_as_strings(ANALYSES["a03"](tables_small)))
    assert not tables_small.units.is_cached


def test_job_runs_analyses_in_parallel(spark, tables_small, tmp_out):
    config = {"output_locations": {name: f"{tmp_out}/par/{name}" for name in ANALYSES}, "parallel": 4}
    written = run_job(spark, config, tables=tables_small)
    assert list(written) == list(ANALYSES)
    for name in ("a03", "a10"):
        assert rows(read_table(spark, written[name])) == rows(_as_strings(ANALYSES[name](tables_small))), name


def test_single_file_query_writes_a_bounded_result(spark, monkeypatch, tmp_out):
    """One line for each property, not one for each damage; the counts add up to the table."""
    from conftest import SF_SMALL

    from roadlens.plans import registry
    from roadlens.sources.fixtures import crash_tables

    monkeypatch.setattr(registry, "scratch_path", lambda *_: f"{tmp_out}/single")
    damages = crash_tables(spark, SF_SMALL).damages
    got = registry.o_single_file(spark, SF_SMALL).collect()
    assert [tuple(r) for r in got] == [(damages.count(), 1)]
    written = spark.read.option("header", True).csv(f"{tmp_out}/single").count()
    assert written == damages.select("damaged_property").distinct().count() < damages.count()


def test_packed_csv_is_read_back(spark, tables_small, tmp_out, monkeypatch):
    monkeypatch.setattr(files, "FILE_ROWS", 1000)
    path = f"{tmp_out}/packed"
    units = tables_small.units
    write_result(units.toDF(*[c.upper() for c in units.columns]), path, compression="gzip")
    parts = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(parts) >= units.count() / 1000 and all(f.endswith(".csv.gz") for f in parts)
    assert rows(read_table(spark, path)) == rows(units)


def test_the_whole_job_writes_packed_inputs(spark, monkeypatch):
    """Its CSV inputs are most of what it writes."""
    found = {}

    def write(df, path, **options):
        write_result(df, path, **options)
        found[os.path.basename(path)] = [f for f in os.listdir(path.removeprefix("file:")) if f.startswith("part-")]

    monkeypatch.setattr(registry, "write_result", write)
    assert registry.QUERIES["o_job_all"](spark, SF_SMALL).count() == 10
    assert set(found) == set(TABLE_COLUMNS) and all(f.endswith(".csv.gz") for parts in found.values() for f in parts)
