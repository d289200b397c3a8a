"""Cutting lineage with a table written to the shared checkpoint folder."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
_local_folder: str | None = None


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder the session names for checkpoints.

    Only a local session without one gets a temporary folder, because executors
    on other machines could not see it.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a shared folder")
    global _local_folder
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="civicpanel-checkpoint-")
    return _local_folder


def _found(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of any file system that the session can reach."""
    folder, files = _found(spark, path)
    files.delete(folder, True)


def folder_exists(spark: SparkSession, path: str) -> bool:
    folder, files = _found(spark, path)
    return files.exists(folder)


def rename_folder(spark: SparkSession, path: str, to: str) -> None:
    folder, files = _found(spark, path)
    if not files.rename(folder, spark._jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"cannot rename {path} to {to}")


def list_folder(spark: SparkSession, path: str) -> list[str]:
    folder, files = _found(spark, path)
    return [str(entry.getPath()) for entry in files.listStatus(folder)]


def written(df: DataFrame) -> DataFrame:
    """``df`` computed once, written as Parquet and read back.

    The copy survives lost executors, has no lineage, and its file sizes tell
    the optimizer how large it really is.  It stays; inside an operator use a
    :class:`Scratch` for copies that its result does not read.
    """
    return _copy(df)[0]


def _copy(df: DataFrame) -> tuple[DataFrame, str]:
    path = f"{checkpoint_folder(df.sparkSession)}/civicpanel-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


class Scratch:
    """Written copies that are deleted when the scope ends.

    What an operator returns must not read them any more: it is written with
    :func:`written` inside the scope, or computed from other tables.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._copies: list[tuple[DataFrame, str]] = []

    def written(self, df: DataFrame) -> DataFrame:
        self._copies.append(_copy(df))
        self._release()
        return self._copies[-1][0]

    def drop(self, *tables: DataFrame) -> None:
        """Delete copies that nothing reads any more, before the scope ends."""
        for entry in [e for e in self._copies if any(e[0] is t for t in tables)]:
            self._copies.remove(entry)
            delete_folder(self.spark, entry[1])
        self._release()

    def _release(self) -> None:
        # Spark deletes the files of a shuffle once the driver's JVM has collected what refers to it.
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *failure) -> None:
        for _, path in self._copies:
            delete_folder(self.spark, path)
        self._copies.clear()
        self._release()
