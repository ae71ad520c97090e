"""Checked narrowing casts and null defaults."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed ranges of the gold column types (unsigned types are stored in wider Spark types).
UINT8 = (0, 255)
INT16 = (-32768, 32767)
UINT32 = (0, 4294967295)


def checked_cast(c: Column, dtype: str, bounds: tuple[int, int], name: str) -> Column:
    """Cast ``c`` to ``dtype`` and fail the job when a value leaves ``bounds``.

    NULL stays NULL. The check is a JVM ``raise_error`` so it stays in codegen.
    """
    lo, hi = bounds
    bad = (c < F.lit(lo)) | (c > F.lit(hi))
    msg = F.concat(F.lit(f"{name} out of range [{lo}, {hi}]: "), c.cast("string"))
    return F.when(bad, F.raise_error(msg)).otherwise(c).cast(dtype)


def fixed_width(c: Column, width: int, name: str) -> Column:
    """A string that must fit ``width`` characters (``FixedString``); longer values fail."""
    msg = F.concat(F.lit(f"{name} longer than {width}: "), c)
    return F.when(F.length(c) > F.lit(width), F.raise_error(msg)).otherwise(c)


def not_null(c: Column, name: str) -> Column:
    """A non-nullable gold column; a NULL fails the load with a clear message."""
    return F.when(c.isNull(), F.raise_error(F.lit(f"{name} must not be null"))).otherwise(c)


def fill_default(c: Column, default) -> Column:
    """F8: NULL -> a default (literal or column)."""
    return F.coalesce(c, default if isinstance(default, Column) else F.lit(default))
