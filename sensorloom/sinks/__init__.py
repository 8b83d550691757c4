"""Writers: catalog tables replaced as a whole, and plain Parquet directories."""

from sensorloom.sinks.files import write_parquet
from sensorloom.sinks.tables import (
    ConcurrentReplace,
    ensure_database,
    ensure_table,
    list_tables,
    remove_leftovers,
    replace_table,
    sample_table,
)

__all__ = [
    "ConcurrentReplace",
    "ensure_database",
    "ensure_table",
    "list_tables",
    "remove_leftovers",
    "replace_table",
    "sample_table",
    "write_parquet",
]
