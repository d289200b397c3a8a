"""Coordinates held as WKT text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

POINT = r"^\s*POINT\s*\(\s*(\S+)\s+([^\s)]+)\s*\)\s*$"


def point_parts(wkt: Column) -> tuple[Column, Column]:
    """``(latitude, longitude)`` of ``POINT(lon lat)``; NULL when it is not a point."""

    def part(group: int) -> Column:
        text = F.nullif(F.regexp_extract(F.upper(wkt), POINT, group), F.lit(""))
        return text.try_cast("double")

    return part(2), part(1)
