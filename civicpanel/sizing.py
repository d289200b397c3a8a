"""Size checks in front of every explicit broadcast.

A frame is hinted for broadcast only when the optimizer's own size estimate is
within a limit.  Anything larger is left without a hint, so Spark plans a
shuffle join and adaptive execution handles skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """Optimizer size estimate of ``df``; ``None`` where it is not reachable."""
    try:
        stats = df._jdf.queryExecution().optimizedPlan().stats()
        return int(str(stats.sizeInBytes()))
    except AttributeError:  # a remote session exposes no plan statistics
        return None


def is_small(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> bool:
    size = estimated_bytes(df)
    return size is not None and size <= limit


def small_side(
    df: DataFrame,
    bound: DataFrame | None = None,
    limit: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """Hint ``df`` for broadcast if its size bound is at most ``limit`` bytes.

    ``bound`` names a frame that ``df`` cannot outgrow because it is made of it, for
    example by grouping or by :func:`within`: the estimate of an aggregate over a large
    fact says nothing about its result.
    """
    return F.broadcast(df) if is_small(df if bound is None else bound, limit) else df


def within(df: DataFrame, bound: DataFrame, key: str, bound_key: str | None = None) -> DataFrame:
    """The rows of ``df``, grouped by ``key``, whose key ``bound`` has, hinted if ``bound`` is small.

    With one row for each key and only keys of ``bound``, the result cannot have more rows
    than ``bound``, whatever the facts under it hold.
    """
    keys = bound.select(F.col(bound_key or key).alias(key)).distinct()
    return small_side(df.join(small_side(keys, bound), key, "left_semi"), bound)
