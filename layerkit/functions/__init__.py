"""Column functions used by the cleansing jobs."""

from layerkit.functions.cleanse import (
    code_label,
    fold,
    int_to_date,
    key_prefix,
    key_suffix,
    loaded_at,
    or_default,
    prefer,
    report_time,
    to_day,
    trimmed,
)

__all__ = [
    "code_label",
    "fold",
    "int_to_date",
    "key_prefix",
    "key_suffix",
    "loaded_at",
    "or_default",
    "prefer",
    "report_time",
    "to_day",
    "trimmed",
]
