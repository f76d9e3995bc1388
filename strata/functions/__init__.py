from strata.functions.columns import (
    count_where,
    extract_date_text,
    is_null_flag,
    male_flag,
    parse_date,
    parse_day_month,
    parse_text_date,
    to_bool,
    to_int_lenient,
    total_of,
)

__all__ = [
    "count_where",
    "extract_date_text",
    "is_null_flag",
    "male_flag",
    "parse_date",
    "parse_day_month",
    "parse_text_date",
    "to_bool",
    "to_int_lenient",
    "total_of",
]
