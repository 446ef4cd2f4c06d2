from faremill.sources.catalog import (
    column_names,
    list_tables,
    numeric_columns,
    schema_report,
)
from faremill.sources.readers import list_files, preview, read_trips, read_zones, read_zones_checked, table
from faremill.sources.versions import publish, refresh_partitions, save_bucketed, version_path
from faremill.sources.writers import save_table, save_trips, temp_view

__all__ = [
    "column_names",
    "list_files",
    "list_tables",
    "numeric_columns",
    "preview",
    "read_trips",
    "publish",
    "read_zones",
    "read_zones_checked",
    "refresh_partitions",
    "save_bucketed",
    "save_table",
    "save_trips",
    "schema_report",
    "table",
    "temp_view",
    "version_path",
]
