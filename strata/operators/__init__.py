from strata.operators.dedupe import distinct_rows, keep_one
from strata.operators.impute import column_means, fill_constant, fill_mean
from strata.operators.quality import (
    drop_null,
    duplicate_keys,
    filter_null,
    null_profile,
    row_count,
    row_counts,
    schema_report,
    unmatched,
)

__all__ = [
    "column_means",
    "distinct_rows",
    "drop_null",
    "duplicate_keys",
    "fill_constant",
    "fill_mean",
    "filter_null",
    "keep_one",
    "null_profile",
    "row_count",
    "row_counts",
    "schema_report",
    "unmatched",
]
