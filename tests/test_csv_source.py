"""CSV files matched by name, and their bad rows."""

from __future__ import annotations

import gzip
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import types as T

from conftest import SF_SMALL, rows
from roadlens.plans.registry import QUERIES
from roadlens.sources.csv_source import HeaderError, layouts, read_checked, read_csv
from roadlens.sources.files import read_table, write_result
from roadlens.sources.fixtures import crash_tables
from roadlens.sources.tables import count_bad_rows


def put(folder, **files):
    os.makedirs(folder, exist_ok=True)
    for name, text in files.items():
        path = f"{folder}/{name.replace('_gz', '.csv.gz')}" if name.endswith("_gz") else f"{folder}/{name}.csv"
        (gzip.open if name.endswith("_gz") else open)(path, "wt").write(text)
    return folder


def test_files_of_another_column_order(spark, tmp_out):
    folder = put(f"{tmp_out}/a b%20c", one="CRASH_ID,UNIT_NBR\n1,u1\n2,u2\n", two="unit_nbr,crash_id\nu3,3\n", three_gz="Unit_Nbr,Crash_Id\nu4,4\n",
                 four="﻿crash_id,unit_nbr\n5,u5\n")
    df = read_table(spark, folder)
    assert df.columns in (["crash_id", "unit_nbr"], ["unit_nbr", "crash_id"])
    assert rows(df.select("crash_id", "unit_nbr")) == [(str(i), f"u{i}") for i in range(1, 6)]
    assert {len(f) for f in layouts(spark, folder).values()} == {2}
    assert rows(read_table(spark, [f"{folder}/one.csv", f"{folder}/t*.csv"]).select("unit_nbr")) == [("u1",), ("u2",), ("u3",)]


def test_missing_and_further_columns(spark, tmp_out):
    folder = put(f"{tmp_out}/x", one="a,b\n1,2\n", two="b,c\n3,4\n", empty="", header_only="c,a\n")
    df = read_csv(spark, folder)
    assert rows(df.select("a", "b", "c")) == [("1", "2", None), (None, "3", "4")]
    wanted = T.StructType([T.StructField("c", T.LongType()), T.StructField("d", T.StringType()), T.StructField("a", T.IntegerType())])
    typed = read_csv(spark, folder, wanted)
    assert typed.schema == wanted and rows(typed) == [(4, None, None), (None, None, 1)]
    nothing = put(f"{tmp_out}/none", empty="")
    assert read_csv(spark, nothing, wanted).count() == 0 and read_csv(spark, nothing, wanted).schema == wanted


def test_inferred_types_over_layouts(spark, tmp_out):
    folder = put(f"{tmp_out}/x", one="a,b,c\n1,2,x\n", two="c,b,a\n7,2.5,8\n")
    df = read_csv(spark, folder, infer=True)
    assert dict(df.dtypes) == {"a": "int", "b": "string", "c": "string"}
    assert rows(df.select("a", "b", "c")) == [(1, "2", "x"), (8, "2.5", "7")]


def test_no_job_reads_headers(spark, tmp_out):
    folder = put(f"{tmp_out}/x", one="a,b\n1,2\n", two="b,a\n3,4\n")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("headers", "headers")
    try:
        read_csv(spark, folder)
        assert not tracker.getJobIdsForGroup("headers")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("header", ["a,a", "a,,b", "a,A"])
def test_bad_headers_are_refused(spark, tmp_out, header):
    with pytest.raises(HeaderError):
        read_csv(spark, put(f"{tmp_out}/{len(header)}", one=f"{header}\n1,2\n"))


SHORT_AND_LONG = dict(one='a,b,c\n1,2,3\n4,5\n6,7,8,9\n"x,y",z,w\n', two="c,a\n3,1\n5\n")


def test_choices_for_bad_rows(spark, tmp_out):
    folder = put(f"{tmp_out}/x", **SHORT_AND_LONG)
    assert read_csv(spark, folder).count() == 6
    kept = rows(read_csv(spark, folder).select("a", "b", "c"))
    assert ("6", "7", "8") in kept and ("4", "5", None) in kept
    good = [("1", "2", "3"), ("1", None, "3"), ("x,y", "z", "w")]
    dropped = read_csv(spark, folder, bad_rows="drop")
    assert rows(dropped.select("a", "b", "c")) == rows(spark.createDataFrame(good, "a string, b string, c string"))
    # the same rows are bad, whatever the query reads
    assert dropped.count() == 3 and rows(dropped.select("c")) == [("3",), ("3",), ("w",)] and dropped.where("a = '1'").count() == 2
    with pytest.raises(Exception, match="MALFORMED"):
        read_csv(spark, folder, bad_rows="refuse").select("a").collect()
    assert read_csv(spark, put(f"{tmp_out}/y", one="a,b\n1,2\n"), bad_rows="refuse").count() == 1
    with pytest.raises(ValueError, match="unknown"):
        read_csv(spark, folder, bad_rows="ignore")


def test_bad_rows_as_a_table(spark, tmp_out):
    folder = put(f"{tmp_out}/x", **SHORT_AND_LONG)
    good, bad = read_checked(spark, folder)
    assert good.count() == 3 and bad.count() == 3
    assert {(r["file"].rsplit("/", 1)[1], r["row"]) for r in bad.collect()} == {("one.csv", "4,5"), ("one.csv", "6,7,8,9"), ("two.csv", "5")}
    wanted = T.StructType([T.StructField("a", T.IntegerType())])
    good, bad = read_checked(spark, folder, wanted)
    assert rows(good) == [(1,), (1,)] and bad.count() == 4  # and 'x,y' is no number
    counts = count_bad_rows(spark, {"t": folder, "u": put(f"{tmp_out}/u", one="a\n1\n")})
    assert rows(counts) == [("t", 3, 3), ("u", 1, 0)]


def test_a_round_trip_in_two_orders(spark, tmp_out):
    units = crash_tables(spark, SF_SMALL).units
    write_result(units, f"{tmp_out}/u/one")
    write_result(units.select(*reversed(units.columns)), f"{tmp_out}/u/two")
    back = read_table(spark, [f"{tmp_out}/u/one", f"{tmp_out}/u/two"], bad_rows="refuse").select(*units.columns)
    assert rows(back) == rows(units.unionAll(units))


def test_a_question_touches_the_tables_it_needs(spark, tmp_out):
    """a01 over a folder that has nothing but the table it reads; the same for configured inputs."""
    from roadlens.plans.analyses import ANALYSES
    from roadlens.sources.tables import load_tables

    os.symlink(f"{SF_SMALL}/lineitem.parquet", f"{tmp_out}/lineitem.parquet")
    assert QUERIES["a01"](spark, tmp_out).count() == QUERIES["a01"](spark, SF_SMALL).count()
    person = f"{tmp_out}/person"
    write_result(crash_tables(spark, SF_SMALL).primary_person, person)
    tables = load_tables(spark, {"primary_person": person, **dict.fromkeys(["units", "damages", "charges"], f"{tmp_out}/nowhere")})
    assert ANALYSES["a01"](tables).count() == QUERIES["a01"](spark, SF_SMALL).count()
    with pytest.raises(PySparkException):
        tables.units  # noqa: B018
