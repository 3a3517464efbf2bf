"""Cleansing expressions. Each takes column names or Columns and returns a Column,
so whole jobs stay one projection inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

NOT_AVAILABLE = "n/a"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trimmed(c: str | Column) -> Column:
    """Strip leading and trailing spaces (tabs stay)."""
    return F.trim(_col(c))


def fold(c: str | Column) -> Column:
    """Trim and upper-case, the form codes are compared in."""
    return F.upper(trimmed(c))


def code_label(c: str | Column, labels: Mapping[str, str], default: str = NOT_AVAILABLE) -> Column:
    """Label for a folded code; unknown and NULL codes get `default`."""
    folded = fold(c)
    label = None
    for code, text in labels.items():
        label = (F if label is None else label).when(folded == code, text)
    return F.lit(default) if label is None else label.otherwise(default)


def key_prefix(c: str | Column, length: int, old: str = "-", new: str = "_") -> Column:
    """First `length` characters with `old` replaced by `new`."""
    return F.replace(F.substring(_col(c), 1, length), F.lit(old), F.lit(new))


def key_suffix(c: str | Column, start: int) -> Column:
    """Everything from the 1-based position `start`."""
    c = _col(c)
    return F.substring(c, F.lit(start), F.length(c))


def or_default(c: str | Column, value) -> Column:
    """`value` where the column is NULL."""
    return F.coalesce(_col(c), F.lit(value))


def prefer(primary: str | Column, fallback: str | Column, missing: str = NOT_AVAILABLE) -> Column:
    """`primary` unless it is NULL or `missing`, then `fallback`, then `missing`."""
    primary = _col(primary)
    return F.when(primary != missing, primary).otherwise(F.coalesce(_col(fallback), F.lit(missing)))


def int_to_date(c: str | Column, on_invalid: str = "fail") -> Column:
    """yyyymmdd integer to date. Zero and values that are not 8 characters long become
    NULL; an 8-character value that is no calendar date raises, or with
    `on_invalid="null"` becomes NULL. Does not depend on the session's ANSI setting."""
    if on_invalid not in ("fail", "null"):
        raise ValueError(f"on_invalid must be 'fail' or 'null', got {on_invalid!r}")
    c = _col(c)
    text = c.cast("string")
    day = F.try_to_date(text, "yyyyMMdd")
    if on_invalid == "fail":
        problem = F.raise_error(F.concat(F.lit("not a yyyymmdd date: "), text)).cast("date")
        day = F.when(c.isNull(), None).otherwise(F.coalesce(day, problem))
    return F.when((c == 0) | (F.length(text) != 8), None).otherwise(day)


def to_day(c: str | Column) -> Column:
    """Calendar date of a timestamp."""
    return _col(c).cast("date")


def loaded_at() -> Column:
    """Audit time of the load, as a timestamp without time zone."""
    return F.current_timestamp().cast("timestamp_ntz")


def report_time(c: str | Column) -> Column:
    """Timestamp in the form used in report headers."""
    return F.date_format(_col(c), "yyyy-MM-dd HH:mm:ss")
