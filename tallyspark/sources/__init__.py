"""Sources and sinks: CSV/Parquet files and the generated test tables."""

from tallyspark.sources.files import (
    complete_copy,
    is_complete,
    list_names,
    load_tables,
    materialize,
    materialize_parquet,
    normalize_columns,
    normalized_name,
    path_exists,
    read_csv,
    write_copy,
)
from tallyspark.sources.testdata import TABLES, read_table, register_tables, table_path

__all__ = [
    "TABLES",
    "complete_copy",
    "is_complete",
    "list_names",
    "load_tables",
    "materialize",
    "materialize_parquet",
    "normalize_columns",
    "normalized_name",
    "path_exists",
    "read_csv",
    "read_table",
    "register_tables",
    "table_path",
    "write_copy",
]
