"""Shards of near equal size from sampled splitters.

Records are ordered by a key that puts equal texts side by side.  A sample of keys, drawn with
a chance in proportion to the size of the record, gives quantiles that cut the key range into
many small ranges; ranges that turn out overfull are cut again.  Exact totals of the ranges
then place every record at its byte position in the whole order, and the position gives the
shard.  Only the sample (a stated number of keys) and the totals of ranges reach the driver or
one task; the records stay spread by range.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civicpanel.lineage import written

#: Ranges aimed at for each shard, and sampled keys for each range.
RANGES_A_SHARD = 8
KEYS_A_RANGE = 16


def _ranged(batches: Iterator[pa.RecordBatch], cuts: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = np.asarray(batch["order_key"], dtype=np.int64)
        at = np.searchsorted(cuts, keys, side="right")
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at.astype(np.int64))], [*batch.schema.names, "range_id"])


def _sampled_cuts(keyed: DataFrame, total: int, ranges: int) -> np.ndarray:
    """Quantile keys of about ``ranges * KEYS_A_RANGE`` keys drawn in proportion to size."""
    chance = F.col("size") * (ranges * KEYS_A_RANGE / max(total, 1))
    draw = (F.xxhash64("order_key", F.lit("draw")).bitwiseAND(F.lit((1 << 52) - 1)) / F.lit(float(1 << 52)))
    # A record larger than the step of the sample counts once for each whole step.
    times = F.floor(chance + draw).cast("int")
    drawn = keyed.where(times > 0).select("order_key", times.alias("times")).toPandas()
    keys = np.sort(np.repeat(drawn["order_key"].to_numpy(np.int64), drawn["times"]))
    return np.unique(keys[KEYS_A_RANGE::KEYS_A_RANGE]) if len(keys) else np.zeros(0, np.int64)


def shard_by_bytes(docs: DataFrame, shards: int = 40, overhead: int = 16) -> DataFrame:
    """Every record of ``docs`` (doc_id, text) with its shard and its slot there.

    The size of a record is the number of UTF-8 bytes of its text, none for null, plus
    ``overhead``.  Shard sizes differ from the mean by less than the largest record.  Returns
    doc_id, size, text_crc32, law, shard, slot, grown_shard (null: this law moves records when
    a shard is added).  Repeated rows, equal and null ids are records of their own; a null text
    has the checksum of no bytes.  An empty table gives no rows; further columns are ignored.
    """
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select(
        "doc_id",
        (F.octet_length(text) + overhead).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        # The upper half orders by text, the lower half spreads equal texts by id.
        F.shiftleft(F.shiftright(F.xxhash64(text), 24), 24).bitwiseOR(
            F.shiftrightunsigned(F.xxhash64("doc_id", text), 40)
        ).alias("order_key"),
    )
    keyed = written(keyed)
    total, rows = keyed.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    cuts = _sampled_cuts(keyed, total, shards * RANGES_A_SHARD)
    ranged = keyed.mapInArrow(
        partial(_ranged, cuts=cuts), "doc_id bigint, size bigint, text_crc32 bigint, order_key bigint, range_id bigint"
    )
    # An overfull range is cut evenly by a second hash; its records stay in the same part of the order.
    full = max(1, 2 * total // (shards * RANGES_A_SHARD))
    filled = ranged.groupBy("range_id").agg(F.sum("size").alias("filled"))
    filled = filled.select("range_id", F.ceil(F.col("filled") / full).alias("parts"))
    part = F.pmod(F.xxhash64("order_key", "doc_id", F.lit("part")), F.col("parts"))
    ranged = ranged.join(filled, "range_id").select("*", F.when(F.col("parts") > 1, part).otherwise(0).alias("part")).drop("parts")
    ranged = written(ranged)
    inside = Window.partitionBy("range_id", "part").orderBy("order_key", "doc_id", "text_crc32", "size")
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = ranged.groupBy("range_id", "part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    ahead = Window.orderBy("range_id", "part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        "range_id",
        "part",
        F.coalesce(F.sum("bytes").over(ahead), F.lit(0)).alias("bytes_ahead"),
        F.coalesce(F.sum("rows").over(ahead), F.lit(0)).alias("rows_ahead"),
    )
    at = ranged.withColumn("up_to", F.sum("size").over(running)).withColumn("nth", F.row_number().over(inside) - 1)
    at = at.join(totals, ["range_id", "part"])
    middle = F.col("bytes_ahead") + F.col("up_to") - F.col("size") / 2
    shard = F.least(F.lit(shards - 1), F.floor(middle * shards / F.lit(float(max(total, 1)))))
    at = written(
        at.select("doc_id", "size", "text_crc32", shard.cast("int").alias("shard"), (F.col("rows_ahead") + F.col("nth")).alias("rank"))
    )
    begins = at.groupBy("shard").agg(F.min("rank").alias("begin"))
    return at.join(F.broadcast(begins), "shard").select(  # one row for each shard
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("rank") - F.col("begin")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
