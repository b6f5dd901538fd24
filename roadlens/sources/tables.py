"""The four crash tables as one value, and how to load, check, register and stage them."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.sources.csv_source import KEEP, count_rows
from roadlens.sources.files import read_table
from roadlens.sources.schemas import TABLE_COLUMNS

Table = DataFrame | Callable[[], DataFrame]


class CrashTables:
    """The four crash tables.  Each is given as a DataFrame, or as a function that makes it when it is first asked for.

    A question that needs one table then lists the files of that one alone.
    """

    def __init__(self, primary_person: Table, units: Table, damages: Table, charges: Table) -> None:
        self._made = {"primary_person": primary_person, "units": units, "damages": damages, "charges": charges}

    def _get(self, name: str) -> DataFrame:
        table = self._made[name]
        return table if isinstance(table, DataFrame) else table()

    @cached_property
    def primary_person(self) -> DataFrame:
        return self._get("primary_person")

    @cached_property
    def units(self) -> DataFrame:
        return self._get("units")

    @cached_property
    def damages(self) -> DataFrame:
        return self._get("damages")

    @cached_property
    def charges(self) -> DataFrame:
        return self._get("charges")

    def as_dict(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in self._made}

    def map(self, fn: Callable[[str, DataFrame], DataFrame]) -> CrashTables:
        """Each table through ``fn(name, table)``, now."""
        return CrashTables(**{name: fn(name, df) for name, df in self.as_dict().items()})


def load_tables(
    spark: SparkSession,
    input_locations: dict[str, str],
    fmt: str = "csv",
    typed: bool = False,
    infer: bool = False,
    bad_rows: str = KEEP,
) -> CrashTables:
    """The four configured tables, each read when it is first asked for.

    Further entries (e.g. the endorsement and restriction files) are not
    needed by any question; read them with :func:`read_table` when wanted.
    """
    missing = [t for t in TABLE_COLUMNS if t not in input_locations]
    if missing:
        raise KeyError(f"input_locations lacks {missing}")
    return CrashTables(**{
        t: lambda t=t: read_table(spark, input_locations[t], fmt=fmt, table=t, typed=typed, infer=infer, bad_rows=bad_rows)
        for t in TABLE_COLUMNS
    })


def count_bad_rows(spark: SparkSession, input_locations: dict[str, str | list[str]]) -> DataFrame:
    """(table_name, good_rows, bad_rows) of configured CSV inputs, one pass over each."""
    parts = [count_rows(spark, path).select(F.lit(name).alias("table_name"), "*") for name, path in input_locations.items()]
    return reduce(DataFrame.unionByName, parts)


def register_views(tables: dict[str, DataFrame] | CrashTables, prefix: str = "") -> list[str]:
    """Register each table as a temp view ``prefix + name``; returns the view names.

    The views belong to the session the tables were made in.  A view of that
    name there is replaced, so give a prefix where the caller has views of its own.
    """
    items = tables.as_dict() if isinstance(tables, CrashTables) else tables
    for name, df in items.items():
        df.createOrReplaceTempView(prefix + name)
    return [prefix + name for name in items]


def used_columns(name: str, df: DataFrame) -> DataFrame:
    """The columns of a crash table that the questions use."""
    return df.select(*[c for c in TABLE_COLUMNS[name] if c in df.columns])


def stage_tables(spark: SparkSession, tables: CrashTables, path: str) -> CrashTables:
    """Write the used columns of each table once as Parquet and read them back.

    The analyses scan ``units`` and ``primary_person`` about twenty times per
    job.  Staging parses CSV once, gives later scans column pruning and
    row-group skipping, and cuts lineage: a lost executor costs a re-read of
    Parquet in the shared folder, not a re-parse of the CSV input.  The four
    writes run side by side.
    """
    def stage(item: tuple[str, DataFrame]) -> DataFrame:
        name, df = item
        target = f"{path}/{name}"
        df = used_columns(name, df)
        df.write.mode("overwrite").parquet(target)
        return spark.read.schema(df.schema).parquet(target)

    items = tables.as_dict()
    with ThreadPoolExecutor(max_workers=len(items)) as pool:
        return CrashTables(**dict(zip(items, pool.map(stage, items.items()), strict=True)))
