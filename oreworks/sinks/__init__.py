"""Writing tables, and what is known about them from their files."""

from oreworks.sinks.metrics import (
    layer_comparison,
    table_columns,
    table_details,
    table_file_metrics,
)
from oreworks.sinks.tables import (
    Layout,
    MissingTable,
    RowCountMismatch,
    append_table,
    merge_rows,
    replace_split,
    replace_table,
    upsert_table,
)

__all__ = [
    "Layout",
    "MissingTable",
    "RowCountMismatch",
    "append_table",
    "layer_comparison",
    "merge_rows",
    "replace_split",
    "replace_table",
    "table_columns",
    "table_details",
    "table_file_metrics",
    "upsert_table",
]
