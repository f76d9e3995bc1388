from strata.sources.files import (
    delete_folder,
    list_entries,
    load_parquet,
    read_csv_by_name,
    read_csv_strings,
    string_schema,
)

__all__ = ["delete_folder", "list_entries", "load_parquet", "read_csv_by_name", "read_csv_strings", "string_schema"]
