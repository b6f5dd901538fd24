"""CSV with a header in every file, columns matched by name.

Spark takes the header of one file for all of them (or, with a schema, the schema's order), so a file whose
columns stand in another order is read with its values swapped.  Here the driver reads the first line of each
file (no Spark job), files of the same header become one scan with exactly that header as its schema, and the
scans are put together by name.  A column that a file lacks is NULL there.

Rows with more or fewer fields than their file's header are bad.  What happens to them is a choice:

* ``keep``: as Spark reads them (missing fields are NULL, surplus ones are lost);
* ``drop``: they are left out;
* ``refuse``: the read fails;
* :func:`read_checked` gives them as a table of their own, with their file and text, beside the good ones.
"""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEEP, DROP, REFUSE = "keep", "drop", "refuse"
_MODES = {KEEP: "PERMISSIVE", DROP: "DROPMALFORMED", REFUSE: "FAILFAST"}
#: The text of a bad row.
BAD = "_bad_row"
#: First lines that the driver reads at once.
_READERS = 16


class HeaderError(ValueError):
    """A file's header names a column twice, or names none."""


def csv_files(spark: SparkSession, path: str | list[str]) -> list[str]:
    """The files below ``path`` (files, folders, patterns), as Spark lists them."""
    return sorted(unquote(f) for f in spark.read.schema("line string").text(path).inputFiles())


def _first_line(spark: SparkSession, file: str) -> str | None:
    """First line of a file, unpacked by its ending as Spark does; None if the file is empty."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(file)
    stream = path.getFileSystem(conf).open(path)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
        source = stream if codec is None else codec.createInputStream(stream)
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(source, "UTF-8")).readLine()
    finally:
        stream.close()


def header_names(line: str, file: str) -> tuple[str, ...]:
    """Lower-case column names of a header line."""
    names = tuple(c.strip().lower() for c in next(csv.reader([line.removeprefix("﻿")]), []))
    if not names or "" in names or len(set(names)) < len(names):
        raise HeaderError(f"{file}: bad header {line!r}")
    return names


def layouts(spark: SparkSession, path: str | list[str]) -> dict[tuple[str, ...], list[str]]:
    """{header: files that have it}; empty files are left out."""
    files = csv_files(spark, path)
    with ThreadPoolExecutor(_READERS) as pool:
        lines = list(pool.map(lambda f: _first_line(spark, f), files))
    out: dict[tuple[str, ...], list[str]] = {}
    for file, line in zip(files, lines, strict=True):
        if line is not None:
            out.setdefault(header_names(line, file), []).append(file)
    return out


def _reader(spark: SparkSession, mode: str):
    # the names are known, so Spark need not compare them; the header line of each file is skipped
    return spark.read.option("header", True).option("enforceSchema", True).option("mode", mode)


def _inferred(spark: SparkSession, found: dict[tuple[str, ...], list[str]]) -> dict[str, T.DataType]:
    """Types that Spark infers, one pass over each layout; columns whose files disagree are strings."""
    types: dict[str, T.DataType] = {}
    for names, files in found.items():
        schema = _reader(spark, "PERMISSIVE").option("inferSchema", True).csv(files).schema
        for name, field in zip(names, schema, strict=True):
            if types.setdefault(name, field.dataType) != field.dataType:
                types[name] = T.StringType()
    return types


def _scan(spark: SparkSession, names: tuple[str, ...], files: list[str], mode: str, types: dict[str, T.DataType], bad: bool) -> DataFrame:
    schema = T.StructType([T.StructField(n, types.get(n, T.StringType())) for n in names])
    reader = _reader(spark, mode)
    if bad:
        schema.add(BAD, T.StringType())
        # Spark parses only the columns that a query asks for, and then counts no fields
        reader = reader.option("columnNameOfCorruptRecord", BAD).option("columnPruning", False)
    return reader.schema(schema).csv(files)


def _by_name(parts: list[DataFrame], columns: list[str]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).select(*columns)


def _columns(found: dict[tuple[str, ...], list[str]], schema: T.StructType | None) -> tuple[list[str], dict[str, T.DataType]]:
    """Result columns and their types: those of the schema, or all that the files have, as strings."""
    if schema is not None:
        return [f.name for f in schema], {f.name.lower(): f.dataType for f in schema}
    return list(dict.fromkeys(n for names in found for n in names)), {}


def _complete(df: DataFrame, schema: T.StructType | None) -> DataFrame:
    """``df`` with the schema's columns that its files lack, as NULL."""
    if schema is None:
        return df
    return df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema if f.name.lower() not in df.columns])


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    bad_rows: str = KEEP,
    infer: bool = False,
) -> DataFrame:
    """The files below ``path`` as one table, columns matched by name.

    ``schema``: the columns wanted, and their types (default: all columns of all files, as strings).  Names are
    lower-cased.  ``infer``: types as Spark infers them, at the price of a pass over the files.
    """
    if bad_rows not in _MODES:
        raise ValueError(f"unknown treatment of bad rows {bad_rows!r}")
    found = layouts(spark, path)
    columns, types = _columns(found, schema)
    if not found:
        return spark.createDataFrame([], schema or T.StructType([]))
    if infer and schema is None:
        types = _inferred(spark, found)
    bad = bad_rows != KEEP
    parts = [_scan(spark, names, files, _MODES[KEEP if bad_rows == DROP else bad_rows], types, bad) for names, files in found.items()]
    if bad:
        parts = [_good(p, names[0]) for p, names in zip(parts, found, strict=True)]
    return _by_name([_complete(p, schema) for p in parts], columns)


def _any_value(column: str) -> Column:
    """True of every row.  Spark reads no file for the bad-row column alone, so conditions on it name another one as well."""
    return F.length(F.concat_ws("", column)) >= 0


def _good(scan: DataFrame, any_column: str) -> DataFrame:
    return scan.where(F.col(BAD).isNull() & _any_value(any_column)).drop(BAD)


def read_checked(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows): the latter as (file, row), the text of the row as it stands in its file."""
    found = layouts(spark, path)
    columns, types = _columns(found, schema)
    if not found:
        return spark.createDataFrame([], schema or T.StructType([])), spark.createDataFrame([], "file string, row string")
    good, bad = [], []
    for names, files in found.items():
        scan = _scan(spark, names, files, "PERMISSIVE", types, bad=True)
        good.append(_complete(_good(scan, names[0]), schema))
        bad.append(scan.select("*", "_metadata.file_path").where(F.col(BAD).isNotNull() & _any_value(names[0]))
                   .select(F.col("file_path").alias("file"), F.col(BAD).alias("row")))
    return _by_name(good, columns), reduce(DataFrame.unionByName, bad)


def count_rows(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(good_rows, bad_rows) of the files, one row, in one pass."""
    parts = [_scan(spark, names, files, "PERMISSIVE", {}, bad=True).select((F.col(BAD).isNull() & _any_value(names[0])).alias("good"))
             for names, files in layouts(spark, path).items()]
    rows = reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], "good boolean")
    return rows.agg(F.count_if("good").alias("good_rows"), F.count_if(~F.col("good")).alias("bad_rows"))
