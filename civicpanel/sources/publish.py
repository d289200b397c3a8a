"""Declared schemas on write, and publication as views or tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from civicpanel.functions.conversion import strict
from civicpanel.lineage import delete_folder, folder_exists, list_folder, rename_folder

RAW_LAYER = "raw"


def enforce_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` with exactly the columns, order and types of ``schema``.

    A value that does not convert, and a NULL in a non-nullable field, stop the
    job; a missing or an extra column stops it before it starts.
    """
    wanted, present = set(schema.fieldNames()), set(df.columns)
    if wanted != present:
        raise ValueError(
            f"columns missing: {sorted(wanted - present)}, unexpected: {sorted(present - wanted)}"
        )
    columns = []
    for field in schema.fields:
        value = strict(F.col(field.name), field.dataType.simpleString(), field.name)
        if not field.nullable:
            message = F.lit(f"NULL in required column {field.name}")
            value = F.coalesce(value, F.raise_error(message).cast(field.dataType))
        columns.append(value.alias(field.name))
    return df.select(*columns)


def replace_folder(df: DataFrame, target: str, partition_by: Sequence[str] = ()) -> None:
    """Replace the Parquet folder ``target``, which ``df`` may read.

    The rows are written beside it first, so a job that fails leaves the old folder as it
    is.  Two renames then switch the folders.
    """
    spark, target = df.sparkSession, target.rstrip("/")
    fresh, old = (f"{target}.{uuid.uuid4().hex}.{kind}" for kind in ("new", "old"))
    try:
        df.write.partitionBy(*partition_by).parquet(fresh)
    except Exception:
        delete_folder(spark, fresh)
        raise
    if folder_exists(spark, target):
        rename_folder(spark, target, old)
    rename_folder(spark, fresh, target)
    spark.catalog.refreshByPath(target)
    delete_folder(spark, old)


def replace_table(df: DataFrame, table: str) -> None:
    """Replace an unpartitioned table, which ``df`` may read, in one step of the catalog.

    Every version has a folder of its own in the warehouse; the catalog's entry is turned to
    the new one when it is complete.  The version before stays for readers that have begun,
    and goes with the next replacement.  A version with other columns needs a new entry, so
    there the table is missing for a moment.
    """
    spark = df.sparkSession
    home = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{table.replace('.', '/')}.versions"
    fresh = f"{home}/{uuid.uuid4().hex}"
    try:
        df.write.parquet(fresh)
    except Exception:
        delete_folder(spark, fresh)
        raise
    before = None
    if spark.catalog.tableExists(table):
        details = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()
        before = details["data_type"] if details else None
        if spark.table(table).dtypes == df.dtypes and before and "/" + home.rsplit("/", 1)[1] + "/" in before:
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{fresh}'")
        else:
            spark.sql(f"DROP TABLE {table}")
            spark.catalog.createTable(table, fresh, "parquet")
    else:
        spark.catalog.createTable(table, fresh, "parquet")
    spark.catalog.refreshTable(table)
    for path in list_folder(spark, home):
        if not any(kept and path.rstrip("/").rsplit("/", 1)[1] == kept.rstrip("/").rsplit("/", 1)[1] for kept in (fresh, before)):
            delete_folder(spark, path)


def replace_partitions(df: DataFrame, target: str, partition_by: Sequence[str]) -> None:
    """Replace only those partitions of the folder ``target`` that ``df`` has rows of.

    ``df`` may read the folder; other partitions are not touched.
    """
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(target)


def publish(df: DataFrame, target: str, mode: str = "overwrite") -> None:
    """Create or replace ``target``, a Parquet folder (with ``/``) or a table.

    Replacing keeps the old rows until the new ones are complete, see
    :func:`replace_folder` and :func:`replace_table`.
    """
    if mode == "overwrite":
        replace_folder(df, target) if "/" in target else replace_table(df, target)
    elif "/" in target:
        df.write.mode(mode).parquet(target)
    else:
        df.write.mode(mode).format("parquet").saveAsTable(target)


def clustered(df: DataFrame, by: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Rows range-partitioned and sorted by ``by``.

    A hash of the whole row ends the range key, so one cluster value that holds
    a large part of the table is spread over several files, still contiguous.
    """
    keys = [F.col(name) for name in by] + [F.xxhash64(*df.columns)]
    ranged = (
        df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    )
    return ranged.sortWithinPartitions(*by)


def publish_clustered(
    df: DataFrame,
    target: str,
    by: Sequence[str],
    partition_by: Sequence[str] = (),
    partitions: int | None = None,
    mode: str = "overwrite",
) -> None:
    """As :func:`publish`, with rows clustered by ``by``.

    ``partition_by`` adds folders per value and suits low-cardinality keys only.
    """
    rows = clustered(df, [*partition_by, *by], partitions)
    if mode == "overwrite" and "/" in target:
        return replace_folder(rows, target, partition_by)
    if mode == "overwrite" and not partition_by:
        return replace_table(rows, target)
    writer = rows.write.mode(mode).partitionBy(*partition_by)
    return writer.parquet(target) if "/" in target else writer.format("parquet").saveAsTable(target)


def materialize(df: DataFrame, layer: str, name: str, root: str | None = None) -> None:
    """A ``raw`` layer becomes a view; every other layer is written.

    With ``root`` the result is a Parquet folder, else a catalog table.
    """
    if layer == RAW_LAYER:
        df.createOrReplaceTempView(f"{layer}_{name}")
    elif root:
        publish(df, f"{root.rstrip('/')}/{layer}/{name}")
    else:
        publish(df, f"{layer}_{name}")
