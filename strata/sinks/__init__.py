from strata.sinks.catalog import (
    compute_statistics,
    ensure_database,
    external_table,
    list_catalog,
    list_statistics,
    list_tables,
    publish,
    publish_version,
    read_back,
    save_table,
    versions,
)
from strata.sinks.files import append_run, rewrite_partitions, save_clustered, save_counted, save_csv, save_parquet

__all__ = [
    "append_run",
    "compute_statistics",
    "ensure_database",
    "external_table",
    "list_catalog",
    "list_statistics",
    "list_tables",
    "publish",
    "publish_version",
    "read_back",
    "rewrite_partitions",
    "save_clustered",
    "save_counted",
    "save_csv",
    "save_parquet",
    "save_table",
    "versions",
]
