"""Non-strict parsers and small column transforms.

Spark 4 runs with ANSI mode on, so every parse that must yield NULL on bad
input goes through a ``try_*`` function; everything stays a JVM expression
inside whole-stage codegen.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must match the reference's behaviour:
#   release dates parse only as "day abbreviated-month, year", e.g. "5 Nov, 2025";
#   fetch times are ISO local date-times with an optional fraction of up to 9 digits
#   (kept to the microsecond);
#   bronze/silver day folders are "year=YYYY/month=MM/day=DD";
#   the age keeps every digit and drops every other character.
RELEASE_DATE_FORMAT = "d MMM, yyyy"
FETCHED_AT_SHAPE = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,9})?$"
PARTITION_PATH_FORMAT = "'year='yyyy'/month='MM'/day='dd"
NON_DIGITS = r"[^0-9]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_release_date(c: Column | str) -> Column:
    """``d MMM, yyyy`` -> date; any other shape or an impossible day -> NULL."""
    return F.try_to_date(_col(c), RELEASE_DATE_FORMAT)


def parse_fetched_at(c: Column | str) -> Column:
    """ISO text with or without a fraction -> ``timestamp_ntz``; bad text -> NULL.

    No zoned type takes part, so the wall-clock value is the same in every session zone.
    """
    c = _col(c)
    return F.when(c.rlike(FETCHED_AT_SHAPE), c.try_cast("timestamp_ntz"))


def clean_age(c: Column | str) -> Column:
    """Keep the digits only, then a non-strict cast to bigint.

    ``16+`` -> 16, ``"18"`` -> 18, ``18.0`` -> 180, ``-`` -> NULL, 20 digits -> NULL.
    """
    digits = F.regexp_replace(_col(c).cast("string"), NON_DIGITS, "")
    return digits.try_cast("bigint")


def minor_to_major(c: Column | str) -> Column:
    """Minor currency units -> price as a double (never a decimal)."""
    return _col(c) / F.lit(100.0)


def list_field(c: Column | str, field: str = "description") -> Column:
    """map a list of structs to one of its fields (NULL list stays NULL)."""
    return F.transform(_col(c), lambda x: x[field])


def truncate_to_second(c: Column | str) -> Column:
    """Whole seconds of a ``timestamp_ntz``, without the zoned type ``date_trunc`` returns."""
    return F.substring_index(_col(c).cast("string"), ".", 1).cast("timestamp_ntz")


def year_month(c: Column | str) -> Column:
    """``toYYYYMM``-style month key as an int, e.g. 202401."""
    return F.date_format(_col(c), "yyyyMM").cast("int")


def partition_path(c: Column | str) -> Column:
    """The zero-padded day folder of a date, ``year=2024/month=01/day=05``."""
    return F.date_format(_col(c), PARTITION_PATH_FORMAT)


def to_date_param(value: str | _dt.date | None, default: _dt.date | None = None) -> _dt.date:
    """a ``YYYY-MM-DD`` job parameter (or a date) -> date; ``default`` when empty."""
    if value is None or value == "":
        if default is None:
            raise ValueError("a date parameter is required")
        return default
    if isinstance(value, _dt.datetime):
        return value.date()
    if isinstance(value, _dt.date):
        return value
    return _dt.datetime.strptime(value, "%Y-%m-%d").date()


def date_range(start: Column, end: Column) -> Column:
    """F16: inclusive list of days from ``start`` to ``end`` (explode it for rows)."""
    return F.sequence(start, end, F.expr("interval 1 day"))
