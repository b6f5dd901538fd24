"""Sources and sinks: CSV/Parquet crash tables, temp views, staging, fixtures."""

from roadlens.sources.files import read_table, write_result
from roadlens.sources.tables import CrashTables, load_tables, register_views, stage_tables

__all__ = ["CrashTables", "load_tables", "read_table", "register_views", "stage_tables", "write_result"]
