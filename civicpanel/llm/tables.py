"""The tables of one data folder, by Spark's readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Names for columns of an operator's own that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
