"""Joins beyond a plain ``DataFrame.join``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicpanel.sizing import is_small, small_side, within


def full_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    unique_keys: bool = False,
    left_keys: DataFrame | None = None,
    many: bool = False,
) -> DataFrame:
    """Full outer join with merged ``keys``; nothing is lost on either side.

    Spark cannot split a skewed key in a full outer join.  Unless the caller
    knows the keys to be unique on both sides, the result is made of a left join,
    where adaptive execution splits a hot key of ``left``, and of the rows of
    ``right`` without a partner.  ``left`` should be the larger side; ``left_keys`` may
    give its keys from a cheaper source.  ``many`` says that keys have many rows on both
    sides, so that the result outgrows them (see :func:`_left_join_many`).
    """
    keys = list(keys)
    if unique_keys:
        return left.join(right, keys, "full")
    found = _left_join_many(left, right, keys) if many else left.join(right, keys, "left")
    known = (left if left_keys is None else left_keys).select(*keys).distinct()
    only_right = right.join(known, keys, "left_anti")
    return found.unionByName(only_right, allowMissingColumns=True)


def _left_join_many(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join whose time goes into the rows it returns.

    The rows of a small ``right`` are packed into one list for each key, and a row of
    ``left`` is joined to its list and unpacked: no sort, and no search for each pair.  Before
    that ``left`` is dealt out by all its plain columns, since neither the row groups of its files
    nor its keys spread the result evenly.
    """
    packed = [F.col(f"`{name}`") for name in right.columns if name not in keys]
    if not packed or not is_small(right):
        return left.join(right, keys, "left")
    lists = right.groupBy(*keys).agg(F.collect_list(F.struct(*packed)).alias("_rows"))
    plain = [F.col(f"`{name}`") for name, kind in left.dtypes if "<" not in kind and kind != "variant"]
    dealt = left.repartition(*plain) if plain else left
    joined = dealt.join(small_side(lists, right), keys, "left")
    return joined.select("*", F.inline_outer("_rows")).drop("_rows")


def star_join(spine: DataFrame, blocks: Sequence[DataFrame], key: str, bound: DataFrame) -> DataFrame:
    """Left joins of many blocks that hold at most one row per ``key``.

    ``bound`` is the dimension that lists the keys; the blocks are reduced to its keys and
    broadcast if it is small.
    """
    return reduce(lambda df, block: df.join(within(block, bound, key), key, "left"), blocks, spine)


def join_on_cast(
    facts: DataFrame, dimension: DataFrame, fact_key: str, dimension_key: str, how: str = "left"
) -> DataFrame:
    """Equi-join of keys stored in different types.

    The dimension's key is cast to the fact's type, once per dimension row; the
    fact key stays bare.
    """
    dtype = dict(facts.dtypes)[fact_key]
    right = dimension.withColumn(fact_key, F.col(dimension_key).try_cast(dtype))
    if fact_key != dimension_key:
        right = right.drop(dimension_key)
    return facts.join(right, fact_key, how)


def join_distinct(
    facts: DataFrame, dimension: DataFrame, columns: Sequence[str], key: str, how: str = "inner"
) -> DataFrame:
    """Join with the distinct ``columns`` of a finer dimension."""
    return facts.join(small_side(dimension.select(*columns).distinct(), dimension), key, how)


def preaggregated_join(
    parts: Sequence[tuple[DataFrame, Mapping[str, Column]]], keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Several aggregates, each reduced to ``keys`` before they are joined.

    No part can multiply the rows of another one.
    """
    reduced = [
        df.groupBy(*keys).agg(*[value.alias(out) for out, value in measures.items()])
        for df, measures in parts
    ]
    return reduce(lambda a, b: a.join(b, list(keys), how), reduced)
