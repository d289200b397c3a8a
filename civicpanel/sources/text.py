"""Text extracts: CSV, delimited TXT and JSON records, all read as strings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt_record"


def text_schema(columns: Sequence[str]) -> StructType:
    """All-string schema; identifiers keep their leading zeros."""
    return StructType([StructField(name, StringType(), True) for name in columns])


def read_text_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """A header CSV (also a spreadsheet export) with every column as text."""
    return (
        spark.read.schema(text_schema(columns))
        .option("header", True)
        .option("enforceSchema", False)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )


def read_delimited_txt(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    sep: str = ";",
    encoding: str = "ISO-8859-1",
    header: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """A delimited extract as text, and the lines that did not fit the schema.

    Returns ``(rows, malformed)``; ``malformed`` holds the raw lines, so that a
    short or long record is visible instead of being filled with NULL.
    """
    schema = text_schema(columns).add(CORRUPT, StringType(), True)
    df = (
        spark.read.schema(schema)
        .option("sep", sep)
        .option("encoding", encoding)
        .option("header", header)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("columnPruning", False)
        .csv(path)
    )
    # Spark judges a line by the columns a query reads; this keeps all of them in use.
    df = df.where(F.length(F.concat_ws("", *columns)) >= 0)
    good = df.where(df[CORRUPT].isNull()).drop(CORRUPT)
    bad = df.where(df[CORRUPT].isNotNull()).select(*columns, CORRUPT)
    return good, bad


def read_json_records(
    spark: SparkSession, path: str, columns: Sequence[str], multi_line: bool = True
) -> DataFrame:
    """JSON records whose numbers and dates are quoted strings, possibly null.

    ``multi_line`` reads whole array files, one task per file; exports with one
    record per line should pass ``False`` so that large files split.
    """
    return spark.read.schema(text_schema(columns)).option("multiLine", multi_line).json(path)


#: Ends a record of an array file, and may also stand inside a text value.
BETWEEN = "},"
# Where a record ends and the next begins without a comma right behind the brace.
TOUCHING = r"(?<=(?<!\\)\"|null)\s*\}\s*,?\s*(?=\{\s*\")"


def _record(piece: Column) -> Column:
    """The text of a record, without the array's brackets, closed by its brace."""
    begun = F.regexp_replace(piece, r"\A[\s,\[]+", "")
    closed = F.regexp_replace(begun, r"\}\s*\]?\s*\z", "")
    return F.concat(closed, F.lit("}"))


def _odd_quotes(piece: Column) -> Column:
    """1 if a text value is open at one end of the piece."""
    bare = F.regexp_replace(piece, r"(?s)\\.", "")
    return (F.length(bare) - F.length(F.replace(bare, F.lit('"'), F.lit("")))) % 2


def read_json_array(
    spark: SparkSession, path: str, columns: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Array files of flat records, read by several tasks, and what is no record.

    As :func:`read_json_records`, but a large file is split at the ends of its records, in
    one line or many.  A text value may hold that separator too: pieces that begin or end
    inside a value, which the number of quotes tells, are put together again; only they are
    ordered by file.  Returns ``(rows, malformed)``; ``malformed`` holds raw text.
    """
    schema = text_schema(columns).add(CORRUPT, StringType(), True)
    pieces = (
        spark.read.option("lineSep", BETWEEN)
        .text(path)
        .select(
            F.col("value").alias("piece"),
            F.col("_metadata.file_path").alias("file"),
            F.struct("_metadata.file_block_start", F.monotonically_increasing_id()).alias("place"),
        )
        .where(~F.col("piece").rlike(r"\A[\s\[\],]*\z"))
    )
    pieces = pieces.withColumn("odd", _odd_quotes(F.col("piece")))
    whole = (F.col("odd") == 0) & F.col("piece").rlike(r'\A[\s,\[]*\{\s*"')

    before = Window.partitionBy("file").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("file").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    broken = pieces.where(~whole)
    broken = broken.withColumn("begins", F.when(F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 0, 1).otherwise(0))
    broken = broken.withColumn("number", F.sum("begins").over(upto)).groupBy("file", "number").agg(
        F.array_sort(F.collect_list(F.struct("place", "piece"))).alias("parts")  # the parts of one value
    )
    joined = broken.select(F.array_join(F.transform("parts", lambda p: p["piece"]), BETWEEN).alias("piece"))

    records = pieces.where(whole).select("piece").union(joined).select(_record(F.col("piece")).alias("piece"))
    parts = F.split("piece", TOUCHING)
    inside = F.exists(parts, lambda part: _odd_quotes(part) == 1)  # the ends are those of a text value
    single = records.select(F.explode(F.when(inside, F.array("piece")).otherwise(parts)).alias("piece"))
    single = single.select(_record(F.col("piece")).alias("piece"))
    parsed = single.select("piece", F.from_json("piece", schema, {"columnNameOfCorruptRecord": CORRUPT}).alias("r"))
    bad = F.col("r").isNull() | F.col(f"r.{CORRUPT}").isNotNull()
    return parsed.where(~bad).select(*[f"r.{c}" for c in columns]), parsed.where(bad).select(F.col("piece").alias(CORRUPT))
