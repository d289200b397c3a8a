"""Reading and restricting typed tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civicpanel.sizing import small_side

BASE_YEAR = 2022


def read_table(spark: SparkSession, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Scan a catalog table, or a Parquet path, reading only ``columns``."""
    is_path = "/" in name or name.endswith(".parquet")
    df = spark.read.parquet(name) if is_path else spark.table(name)
    return df.select(*columns) if columns else df


def partition_range(df: DataFrame, column: str, low, high) -> DataFrame:
    """Rows with ``low <= column <= high``; prunes partitions and row groups.

    The bounds are literals compared with the bare column, so the filter
    reaches the scan.
    """
    return df.where(F.col(column).between(F.lit(low), F.lit(high)))


def current_term(df: DataFrame, year: str | Column, base_year: int = BASE_YEAR) -> DataFrame:
    """Rows of the years after ``base_year``.

    A date or timestamp column is compared with a date literal instead of
    being wrapped in ``year()``, so the filter still reaches the scan.
    """
    column = F.col(year) if isinstance(year, str) else year
    if isinstance(year, str) and dict(df.dtypes)[year].startswith(("date", "timestamp")):
        return df.where(column >= F.lit(f"{base_year + 1:04d}-01-01").cast(dict(df.dtypes)[year]))
    return df.where(column > F.lit(base_year))


def years_of(df: DataFrame, column: str, years: DataFrame, year: str) -> DataFrame:
    """Rows whose partition is one of the ``years`` of a filtered dimension.

    The dimension has one row for each year, so it is broadcast after a check of its size,
    and Spark prunes the partitions of ``df`` by its values before they are read.
    """
    wanted = years.select(F.col(year).alias("_year")).distinct()
    return df.join(small_side(wanted), F.col(column) == F.col("_year"), "left_semi")
