"""Sources and sinks: CSV and Parquet in, Parquet out, views."""

from facets.sources.csv import BAD_RECORD, FAILED_CASTS, load_checked_csv, load_csv, parse_date, record_faults
from facets.sources.names import normalize_names, rename_prefix
from facets.sources.counted import file_statistics
from facets.sources.parquet import TABLES, land_parquet, materialize, read_table, shared_dir
from facets.sources.views import register_view

__all__ = ["BAD_RECORD", "FAILED_CASTS", "load_checked_csv", "load_csv", "record_faults", "file_statistics", "parse_date", "normalize_names", "rename_prefix", "TABLES", "land_parquet",
           "read_table", "shared_dir", "register_view", "materialize"]
