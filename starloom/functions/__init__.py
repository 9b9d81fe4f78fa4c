from starloom.functions.calendar import (
    date_attributes,
    date_spine,
    in_month,
    month_bounds,
    month_label,
    month_start,
    timestamp,
    utc_now,
)
from starloom.functions.keys import scd_id, surrogate_key, surrogate_key_sql
from starloom.functions.rows import known_rows

__all__ = [
    "date_attributes",
    "date_spine",
    "in_month",
    "known_rows",
    "month_bounds",
    "month_label",
    "month_start",
    "scd_id",
    "surrogate_key",
    "surrogate_key_sql",
    "timestamp",
    "utc_now",
]
