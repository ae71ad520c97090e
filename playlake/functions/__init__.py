"""Column-level functions: parsing, cleaning, checked casts, defaults, paths and dates."""

from playlake.functions.casts import checked_cast, fill_default, fixed_width, not_null
from playlake.functions.parse import (
    clean_age,
    date_range,
    list_field,
    minor_to_major,
    parse_fetched_at,
    parse_release_date,
    partition_path,
    to_date_param,
    truncate_to_second,
    year_month,
)

__all__ = [
    "checked_cast", "fill_default", "fixed_width", "not_null",
    "clean_age", "date_range", "list_field", "minor_to_major", "parse_fetched_at",
    "parse_release_date", "partition_path", "to_date_param", "truncate_to_second", "year_month",
]
