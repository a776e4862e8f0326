"""Ways into a DataFrame: typed files, tables, a calendar, samples."""

from oreworks.sources.calendar import calendar_days, calendar_span
from oreworks.sources.files import list_data_files, read_typed, source_file_stats
from oreworks.sources.sampling import key_hash_sample, row_sample
from oreworks.sources.tables import read_tables

__all__ = [
    "calendar_days",
    "calendar_span",
    "key_hash_sample",
    "list_data_files",
    "read_tables",
    "read_typed",
    "row_sample",
    "source_file_stats",
]
