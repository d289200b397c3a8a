"""From raw documents to packed token sequences, in five stages.

Each stage takes all rows its predecessor kept, is written as Parquet and read again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicpanel.lineage import checkpoint_folder
from civicpanel.llm.decontaminate import occurrences
from civicpanel.llm.near_dedup import near_duplicates
from civicpanel.llm.packing import pack
from civicpanel.llm.quality_rules import judged
from civicpanel.llm.substring_dedup import without_repeats
from civicpanel.llm.tables import free_names, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return judged(docs).where("kept").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest id.

    Rows with one id and different texts are judged text by text.  Of rows that repeat with id
    and text the copies go; a row with a null id stays.
    """
    kept = near_duplicates(docs).where("kept").select("doc_id", "text_key").distinct()
    own_id, own_key = free_names(docs, "kept_id", "kept_key")
    kept = kept.select(F.col("doc_id").alias(own_id), F.col("text_key").alias(own_key))
    known = docs.where("doc_id IS NOT NULL").withColumn(text_key := free_names(docs, "text_key")[0], F.xxhash64("text"))
    known = known.join(kept, (F.col("doc_id") == F.col(own_id)) & (F.col(text_key) == F.col(own_key)), "left_semi")
    known = known.dropDuplicates(["doc_id", text_key]).select(*docs.columns)
    return known.union(docs.where("doc_id IS NULL"))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier document has; n_chars is counted anew.

    Rows with one id and different texts are one document of several texts; null texts stay.
    """
    cut = without_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark.

    Rows with one id, or with a null id, are judged text by text; a null text has no passage.
    """
    own_id, own_key = free_names(docs, "hit_id", "hit_key")
    hit = occurrences(docs, table(spark, sf_dir, "benchmark"))
    hit = hit.select(F.col("doc_id").alias(own_id), F.col("text_key").alias(own_key)).distinct()
    return docs.join(hit, F.col("doc_id").eqNullSafe(F.col(own_id)) & (F.xxhash64("text") == F.col(own_key)), "left_anti")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences of 2048 tokens."""
    return pack(docs)


STAGES = [
    ("quality rules", quality),
    ("near-duplicate removal", near_dedup),
    ("substring removal", substring_dedup),
    ("benchmark decontamination", decontamination),
    ("packing", packing),
]

#: The stages are checked against brute force in the tests: SQL cannot express sketches, tokens and packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{checkpoint_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
