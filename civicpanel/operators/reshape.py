"""Unions, unpivots and ordered reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicpanel.operators.clean import SENSITIVE_TAGS, drop_sensitive


def union_all(frames: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    """All rows of all frames, by column name; equal rows are kept."""
    result = frames[0]
    for df in frames[1:]:
        result = result.unionByName(df, allowMissingColumns=allow_missing)
    return result


def union_with_origin(
    sources: Mapping[str, DataFrame],
    out: str = "origem",
    tags: Mapping[str, Sequence[str]] = SENSITIVE_TAGS,
) -> DataFrame:
    """Stacked sources with a provenance column; protected columns are removed first."""
    return union_all(
        [drop_sensitive(df, tags).withColumn(out, F.lit(name)) for name, df in sources.items()]
    )


def unpivot_periods(
    df: DataFrame, periods: Sequence[tuple[int, str, str]], order: str, period: str, value: str
) -> DataFrame:
    """One row per period from one column per period; empty periods are kept.

    ``periods`` lists ``(order, period, column)``.
    """
    columns = [column for _, _, column in periods]
    rows = F.array(
        *[
            F.struct(
                F.lit(number).alias(order),
                F.lit(name).alias(period),
                F.col(column).alias(value),
            )
            for number, name, column in periods
        ]
    )
    kept = [name for name in df.columns if name not in columns]
    return df.select(*kept, F.inline(rows))


def guard_fixed_metrics(df: DataFrame, order: str, columns: Sequence[str]) -> DataFrame:
    """Metrics that do not vary by period on the first period only, so sums stay right."""
    return df.withColumns({name: F.when(F.col(order) == 1, F.col(name)) for name in columns})


def order_report(df: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Rows in report order."""
    return df.orderBy(*keys)


def sample_rows(df: DataFrame, order: Sequence[str | Column], n: int) -> DataFrame:
    """The first ``n`` rows in a stated order."""
    return df.orderBy(*order).limit(n)


def to_long(
    df: DataFrame, keys: Sequence[str], metrics: Sequence[str], name: str = "metrica", value: str = "valor"
) -> DataFrame:
    """One row per key and metric; the metrics are read as double."""
    typed = df.select(*keys, *[F.col(metric).cast("double").alias(metric) for metric in metrics])
    return typed.unpivot(list(keys), list(metrics), name, value)
