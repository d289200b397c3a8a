"""Inline reference tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def literal_table(
    spark: SparkSession, rows: Iterable[Sequence], schema: StructType | str
) -> DataFrame:
    """A reference table written out in code, with a declared schema.

    The rows are literals of the plan.  A frame made from Python objects has no
    known size and would not be broadcast; this one is as small as it looks.
    """
    fields = (schema if isinstance(schema, StructType) else StructType.fromDDL(schema)).fields
    values = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields, strict=True)])
        for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*values)))
