"""Column expressions that convert text to typed values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def safe(c: Column, dtype: str) -> Column:
    """``c`` as ``dtype``; text that does not convert becomes NULL.

    Text is trimmed first.  Java's own suffixes (``1d``, ``2f``) are refused.
    """
    if dtype in ("double", "float") or dtype.startswith("decimal"):
        text = F.trim(c.cast("string"))
        return F.when(text.rlike(NUMBER), text).try_cast(dtype)
    if dtype in ("string", "date", "timestamp", "timestamp_ntz"):
        return c.try_cast(dtype)
    return c.try_cast(dtype)


def strict(c: Column, dtype: str, name: str) -> Column:
    """``c`` as ``dtype``; a value that does not convert stops the job.

    The error names the column and does not depend on the session's ANSI flag.  What
    :func:`safe` refuses (``12d``, ``NaN``) does not convert here either.
    """
    value = safe(c, dtype)
    message = F.concat(F.lit(f"column {name} is not {dtype}: "), c.cast("string"))
    return F.when(c.isNotNull() & value.isNull(), F.raise_error(message).cast(dtype)).otherwise(
        value
    )


def brl(c: Column, dtype: str = "double") -> Column:
    """Brazilian money or number text to a number; anything invalid is NULL.

    Drops ``R$``, spaces and thousands dots and reads the comma as decimal mark.
    """
    text = F.replace(F.trim(c), F.lit("R$"), F.lit(""))
    return safe(decimal_comma(F.translate(text, " .", "")), dtype)


def decimal_comma(c: Column) -> Column:
    """Decimal comma to decimal point."""
    return F.translate(c, ",", ".")


def bounded_int(c: Column, low: int, high: int) -> Column:
    """The integer in ``c`` when it parses and lies in ``[low, high]``, else NULL."""
    value = c.try_cast("bigint")
    return F.when(value.between(low, high), value)


def first_date(c: Column, formats: Sequence[str]) -> Column:
    """The first of ``formats`` that reads ``c`` as a date, else NULL.

    A value without digits for the day (``yyyy-MM``) is the first of the month.
    """
    return F.coalesce(*[F.try_to_date(c, pattern) for pattern in formats])


def year_start(year: Column) -> Column:
    """January 1 of ``year``."""
    return F.make_date(year.cast("int"), F.lit(1), F.lit(1))


def leading_year(c: Column) -> Column:
    """The first four characters as an integer, NULL when they are not one."""
    return F.left(c, F.lit(4)).try_cast("int")


def null_if_invalid(c: Column, invalid: Sequence[str]) -> Column:
    """NULL for blank text and for the listed markers, case and padding ignored."""
    markers = [marker.strip().upper() for marker in invalid] + [""]
    return F.when(~F.upper(F.trim(c)).isin(markers), c)


def handle_null(c: Column, default) -> Column:
    """``default`` in place of NULL."""
    return F.coalesce(c, F.lit(default))
