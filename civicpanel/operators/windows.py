"""First and latest rows, dense ids, totals beside rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicpanel.lineage import Scratch, folder_exists, written


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of every key.

    Spark turns ``row_number() = 1`` into a per-key limit that already runs
    before the shuffle, so a hot key sends one row per input partition only.
    ``order`` should end in a unique column to be repeatable.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def latest_per_key(
    df: DataFrame, keys: Sequence[str], latest: Sequence[str], tiebreak: Sequence[str] = ()
) -> DataFrame:
    """The row of every key with the greatest ``latest`` columns; ties by ``tiebreak``."""
    order = [F.col(name).desc_nulls_last() for name in latest]
    order += [F.col(name).asc_nulls_first() for name in tiebreak]
    return first_per_key(df, keys, order)


def dense_id(
    df: DataFrame, columns: Sequence[str], out: str, write: Callable[[DataFrame], DataFrame] = written
) -> DataFrame:
    """Distinct ``columns`` numbered 1, 2, 3 ... in their sort order.

    The distinct rows are range-sorted over all tasks and numbered inside their
    range.  They are written out first, because the numbering and the count of
    each range must see the same ranges even when a task runs again.  Only the
    row counts, one per range, meet in one place; their running sum reaches the
    rows as an array value.  The result reads the copy that ``write`` makes; pass that of
    a :class:`civicpanel.lineage.Scratch` to have it deleted.
    """
    ordered = write(
        df.select(*columns)
        .distinct()
        .orderBy(*columns)
        .withColumn("_position", F.monotonically_increasing_id())
    )
    # The id packs the partition number above 33 bits of row number.
    number = F.shiftright("_position", 33).cast("int")
    inside = F.col("_position").bitwiseAND(F.lit((1 << 33) - 1))
    counts = ordered.groupBy(number.alias("_range")).agg(F.count(F.lit(1)).alias("_rows"))
    in_order = Window.orderBy("_range")
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    # Empty ranges have no row; the next range also fills their places.
    places = F.col("_range") - F.coalesce(F.lag("_range").over(in_order), F.lit(-1))
    filled = counts.select(
        "_range",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"),
        places.alias("_places"),
    ).select("_range", F.array_repeat("_start", F.col("_places")).alias("_starts"))
    by_range = F.sort_array(F.collect_list(F.struct("_range", "_starts")))
    starts = filled.agg(F.flatten(F.transform(by_range, lambda item: item["_starts"]))).scalar()
    return ordered.select(*columns, (F.get(starts, number) + inside + 1).alias(out))


def extend_ids(
    known: DataFrame | None,
    df: DataFrame,
    columns: Sequence[str],
    out: str,
    write: Callable[[DataFrame], DataFrame] = written,
) -> DataFrame:
    """Numbers for the distinct ``columns`` of ``df`` that ``known`` does not hold yet.

    ``known`` has ``columns`` and ``out``; its numbers stay as they are.  New keys go on
    after its largest number, in their sort order.  Only the new rows are returned, to be
    appended; NULL is a value of a key.
    """
    keys = df.select(*columns).distinct()
    if known is None:
        return dense_id(keys, columns, out, write)
    renamed = known.select(*[F.col(c).alias(f"_known_{c}") for c in columns])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_known_{c}")) for c in columns])
    new = dense_id(keys.join(renamed, same, "left_anti"), columns, out, write)
    last = known.agg(F.coalesce(F.max(out), F.lit(0))).scalar()
    return new.withColumn(out, F.col(out) + last)


def stored_ids(df: DataFrame, path: str, columns: Sequence[str], out: str) -> DataFrame:
    """The key dictionary in folder ``path``, extended by the keys of ``df``.

    Keys keep their numbers from load to load.  The new rows are written before they are
    appended, and the copies that numbering needs are deleted.
    """
    spark = df.sparkSession
    known = spark.read.parquet(path) if folder_exists(spark, path) else None
    with Scratch(spark) as scratch:
        new = scratch.written(extend_ids(known, df, columns, out, scratch.written))
        new.write.mode("append").parquet(path)
    return spark.read.schema(new.schema).parquet(path)


def with_total(df: DataFrame, totals: Mapping[str, Column]) -> DataFrame:
    """Grand totals beside every row, from a one-row aggregate.

    An unpartitioned window would bring all rows into one task; here the totals
    are a scalar subquery, whose one row reaches all tasks as a value.
    """
    one_row = df.agg(F.struct(*[value.alias(out) for out, value in totals.items()]))
    return df.withColumn("_totals", one_row.scalar()).select("*", "_totals.*").drop("_totals")


def share_of_total(df: DataFrame, part: str, whole: str, out: str) -> DataFrame:
    """``sum(part) / sum(whole)`` over all rows, beside every row; NULL if nothing is there."""
    value = F.try_divide(F.sum(part).cast("double"), F.sum(whole).cast("double"))
    return with_total(df, {out: value})
