"""Connected components of an edge table, as repeated star contractions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicpanel.lineage import Scratch, written


def components(edges: DataFrame, keep: Callable[[DataFrame], DataFrame] = written) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns ``a``, ``b``); the root is the smallest.

    Alternates large-star and small-star steps until the edges stay the same, which takes a
    number of rounds that grows with the logarithm of the longest path.  Minima are combined
    before each shuffle and joins are plain equi-joins, so a node with very many neighbours is
    split by adaptive execution.  Every round is written to the checkpoint folder, and the one
    before is deleted.  Null ends and loops are ignored; no edges give no rows.  ``keep`` writes
    the result, for example to a scratch of the caller's.
    """
    with Scratch(edges.sparkSession) as scratch:
        now = scratch.written(
            edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
            .where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
            .distinct()
        )
        mark = None
        while True:
            seen = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
            if seen == mark or seen[0] == 0:
                break
            mark = seen
            both = now.union(now.select("v", "u"))
            nearest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
            large = both.where("v > u").join(nearest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
            lowest = large.groupBy("u").agg(F.min("v").alias("m"))
            small = large.join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            before, now = now, scratch.written(small.union(lowest).distinct())
            scratch.drop(before)
        pairs = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        return keep(pairs.union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))
