"""File sources and sinks (CSV with header, Parquet).

CSV columns are matched by the name in each file's own header and read as
strings, as the crash files are shipped (see :mod:`roadlens.sources.csv_source`);
names are lower-cased at the source so the analyses can use one spelling.
``typed=True`` casts the count columns with ``try_cast`` (a bad number becomes
NULL instead of failing the job).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.functions import to_number
from roadlens.sources.csv_source import KEEP, read_csv
from roadlens.sources.schemas import COUNT_COLUMNS


def lower_case_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def cast_counts(df: DataFrame, table: str) -> DataFrame:
    """Count columns as bigint: '6.0' and '1e2' are numbers, what is not becomes NULL."""
    counts = [c for c in COUNT_COLUMNS.get(table, []) if c in df.columns]
    if not counts:
        return df
    return df.select(*[to_number(c).try_cast("bigint").alias(c) if c in counts else F.col(c) for c in df.columns])


def read_table(
    spark: SparkSession,
    path: str | list[str],
    fmt: str = "csv",
    table: str | None = None,
    typed: bool = False,
    infer: bool = False,
    bad_rows: str = KEEP,
) -> DataFrame:
    """Read one crash table.

    CSV: every column string, found by its name in each file.  ``infer=True``
    lets Spark infer column types instead, at the price of a full extra pass
    over the input; ``typed=True`` is the cheap alternative (casts only the
    count columns).  ``bad_rows`` says what becomes of rows with too many or
    too few fields: ``keep``, ``drop`` or ``refuse``.
    Parquet: the stored schema.
    """
    if fmt == "csv":
        df = read_csv(spark, path, bad_rows=bad_rows, infer=infer)
    elif fmt == "parquet":
        df = lower_case_columns(spark.read.parquet(*([path] if isinstance(path, str) else path)))
    else:
        raise ValueError(f"unsupported input format {fmt!r}")
    if typed and table is not None:
        df = cast_counts(df, table)
    return df


#: Most rows of a compressed CSV file.
FILE_ROWS = 1_000_000


def write_result(df: DataFrame, path: str, fmt: str = "csv", single_file: bool = False, compression: str | None = None) -> None:
    """Write a result directory, replacing what was there.

    ``single_file`` coalesces to one part file; only for small results, as it
    funnels the last stage through one task.  A ``compression`` that Spark knows
    (``gzip``) makes CSV files that one task each reads whole, so they get at most
    ``FILE_ROWS`` rows.
    """
    if single_file:
        df = df.coalesce(1)
    writer = df.write.mode("overwrite")
    if compression is not None:
        writer = writer.option("compression", compression)
        if fmt == "csv" and not single_file:
            writer = writer.option("maxRecordsPerFile", FILE_ROWS)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unsupported output format {fmt!r}")
