"""Near-duplicate documents by bottom-k sketches from one hash function.

Every text becomes a set of hashed word shingles.  Texts with equal sets form one class.  A
class keeps the ``SKETCH`` smallest hashes of its set, and one bit for the parity of each of
``PARITIES`` parts of the set: the parities in which two sets differ are a lower bound of the
number of elements in which they differ.

Inverted lists of the ``LISTED`` smallest hashes generate overlaps.  Two texts that are to be
linked share at least ``SHARED`` of them, so a class whose hashes are mostly its own leaves the
lists, and of the others only the rarest hashes are listed, as many as two such texts must meet
in.  Members of a list are first compared with one member that stands for it, and in further
rounds with another one, until that finds hardly any new links.  Then members that are still in
different components are compared with each other, once, under the smallest hash they share,
unless sizes or parities rule the link out, which is exact.  A sketch of the union estimates
the similarity of all these pairs; the full sets of those that are left confirm or refuse the
link.  No list is cut and no member is dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civicpanel.lineage import Scratch, written
from civicpanel.llm.graph import components
from civicpanel.llm.words import jaccard, shingle_sets, text_slices

SKETCH = 48
LISTED = 16
PARITIES = 1024
#: Of 16 retained hashes, two sets with a similarity of 0.8 share fewer than 7 in one of 70,000 cases.
SHARED = 7 / 16
#: How far the estimate of 48 hashes may be below the similarity: five standard deviations or more.
MARGIN = 0.30
#: Rounds of comparisons with stand-ins go on while they add this share of links.
WORTH = 0.02


def parities(hashes: np.ndarray) -> np.ndarray:
    """Bits that tell of each part of a set whether its number of elements is odd."""
    counts = np.bincount((hashes & np.uint64(PARITIES - 1)).astype(np.int64), minlength=PARITIES)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def _signatures(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch["text"]
        for a, b in text_slices(texts):
            sets = shingle_sets(texts.slice(a, b - a), width)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"].slice(a, b - a),
                    batch["text_key"].slice(a, b - a),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s, digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                    pa.array([s[:SKETCH].view(np.int64) for s in sets], pa.list_(pa.int64())),
                    pa.array([parities(s) for s in sets], pa.list_(pa.int64())),
                ],
                ["doc_id", "text_key", "n_shingles", "node", "sketch", "bits"],
            )


def _verified(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in text_slices(batch["text_a"], 1 << 20):
            left = shingle_sets(batch["text_a"].slice(a, b - a), width)
            right = shingle_sets(batch["text_b"].slice(a, b - a), width)
            sizes = [jaccard(x, y) for x, y in zip(left, right, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["a"].slice(a, b - a),
                    batch["b"].slice(a, b - a),
                    pa.array([s[0] for s in sizes], pa.int64()),
                    pa.array([s[1] for s in sizes], pa.int64()),
                ],
                ["a", "b", "shared", "together"],
            )


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """A row for each document: its set size, the digest of its set (``node``), sketch and parities."""
    return docs.select("doc_id", "text", "text_key").mapInArrow(
        partial(_signatures, width=width),
        "doc_id bigint, text_key bigint, n_shingles bigint, node binary, sketch array<bigint>, bits array<bigint>",
    )


def _least_shared(n: str) -> str:
    """How many retained hashes a set of ``n`` shares at least with one that it is linked to."""
    return f"greatest(1, CAST(floor({SHARED} * least({LISTED}, {n})) AS int))"


def _listed(classes: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """(value, node) of the lists in which every two texts that are to be linked meet."""
    least = _least_shared(f"ceil({percent / 100} * n_shingles)")
    listed = classes.select("node", "n_shingles", F.explode(F.slice("sketch", 1, LISTED)).alias("value"))
    retained, before = f"least({LISTED}, n_shingles)", []
    for _ in range(2):  # classes that leave make hashes of others their own
        sizes = listed.groupBy("value").agg(F.count("*").alias("members")).where("members > 1")
        shared = listed.join(sizes, "value")
        own = Window.partitionBy("node")
        shared = shared.withColumn("n_shared", F.count("*").over(own)).where(f"n_shared >= {least}")
        # Hashes without a second class are the rarest; the order is the same for all classes.
        place = F.expr(f"{retained} - n_shared") + F.row_number().over(own.orderBy("members", "value"))
        shared = scratch.written(shared.withColumn("place", place).select("value", "node", "n_shingles", "place"))
        scratch.drop(*before)
        before = [shared]
        listed = shared.select("value", "node", "n_shingles")
    return shared.where(f"place <= {retained} - {least} + 1").select("value", "node")


def _possible(percent: int) -> str:
    """Whether sizes and parities of a and b allow the similarity; false is certain."""
    differ = " + ".join(f"bit_count(bits_a[{k}] ^ bits_b[{k}])" for k in range(PARITIES // 64))
    return (
        f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)"
        f" AND {100 + percent} * ({differ}) <= {100 - percent} * (n_a + n_b)"
    )


def _sided(df: DataFrame, side: str, *names: str) -> DataFrame:
    return df.select(*(F.col(c).alias(f"{c}_{side}") for c in names))


def _confirmed(pairs: DataFrame, marked: DataFrame, texts: DataFrame, width: int, percent: int, scratch: Scratch) -> DataFrame:
    """The pairs (a, b) that are links."""
    for s in "ab":
        side = marked.select(F.col("node").alias(s), F.col("sketch").alias(f"s_{s}"), F.col("bits").alias(f"bits_{s}"), F.col("n_shingles").alias(f"n_{s}"))
        pairs = pairs.join(side, s)
    union = F.slice(F.array_sort(F.array_union("s_a", "s_b")), 1, SKETCH)
    both = F.size(F.array_intersect(F.array_intersect("s_a", "s_b"), union))
    pairs = pairs.where(_possible(percent)).where(both >= (percent / 100 - MARGIN) * F.size(union))
    likely = pairs = scratch.written(pairs.select("a", "b"))
    for s in "ab":
        pairs = pairs.join(texts.select(F.col("node").alias(s), F.col("text").alias(f"text_{s}")), s)
    kind = dict(marked.dtypes)["node"]
    checked = pairs.mapInArrow(partial(_verified, width=width), f"a {kind}, b {kind}, shared bigint, together bigint")
    links = scratch.written(checked.where(100 * F.col("shared") >= percent * F.col("together")).select("a", "b"))
    scratch.drop(likely)
    return links


def link_lists(listed: DataFrame, marked: DataFrame, texts: DataFrame, width: int, percent: int, scratch: Scratch) -> DataFrame:
    """(node, root) of the nodes that have links, a table of ``scratch``.

    ``listed`` has the members of each list (value, node), at most a few lists for a node;
    ``marked`` node, n_shingles, sketch and bits; ``texts`` node and text.  All are written.
    """
    links = scratch.written(listed.selectExpr("node AS a", "node AS b").limit(0))
    found, tried, total = links.selectExpr("a AS node", "b AS root"), None, 0
    if listed.isEmpty():
        return found
    for number in range(64):
        placed = listed.join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
        # Of the largest component of a list, another member stands for the list in each round.
        salted = F.struct(F.xxhash64("node", F.lit(number)), F.col("node"))
        groups = placed.groupBy("value", "root").agg(F.count("*").alias("members"), F.min(salted).alias("stands"))
        best = groups.groupBy("value").agg(F.max(F.struct("members", "root", "stands")).alias("top"), F.count("*").alias("roots"))
        best = best.where("roots > 1").select("value", "top.root", F.col("top.stands.node").alias("b"))
        stars = placed.withColumnRenamed("root", "own_root").join(best, "value").where("own_root <> root")
        stars = stars.select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b")).distinct()
        stars = scratch.written(stars if tried is None else stars.join(tried, ["a", "b"], "left_anti"))
        tried = stars if tried is None else tried.union(stars)
        if stars.isEmpty():
            break
        new = _confirmed(stars, marked, texts, width, percent, scratch)
        more = new.count()
        if not more:
            break
        total += more
        links = links.union(new)
        before, found = found, components(links, scratch.written)
        scratch.drop(before)
        if more <= WORTH * total:
            break

    # Members of a list that are left in different components, each pair under its smallest list.
    placed = listed.join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    apart = placed.groupBy("value").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    rest = placed.join(apart.select("value"), "value", "left_semi")
    keys = rest.groupBy("node").agg(F.collect_list("value").alias("keys"))  # a few lists for each node
    rest = rest.join(keys, "node").join(marked.select("node", F.col("n_shingles").alias("n"), "bits"), "node")
    rest = scratch.written(rest)
    names = ("node", "root", "n", "bits", "keys")
    left, right = (_sided(rest, s, "value", *names) for s in "ab")
    pairs = left.join(
        right,
        F.expr(
            f"value_a = value_b AND node_a < node_b AND root_a <> root_b AND {_possible(percent)}"
            " AND value_a = array_min(array_intersect(keys_a, keys_b))"
        ),
    )
    met = scratch.written(pairs.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")))
    scratch.drop(rest)
    pairs = scratch.written(met.join(tried, ["a", "b"], "left_anti"))
    scratch.drop(met)
    if not pairs.isEmpty():
        more = _confirmed(pairs, marked, texts, width, percent, scratch)
        if not more.isEmpty():
            return components(links.union(more), scratch.written)
    return found


def link_classes(classes: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(node, root) of the classes that have links; ``classes`` must be a written table."""
    with Scratch(classes.sparkSession) as scratch:
        chosen = scratch.written(_listed(classes, percent, scratch))
        meeting = chosen.groupBy("value").agg(F.count("*").alias("members")).where("members > 1")
        listed = scratch.written(chosen.join(meeting.select("value"), "value", "left_semi"))
        scratch.drop(chosen)
        marked = classes.join(listed.select("node").distinct(), "node", "left_semi")
        marked = scratch.written(marked.select("node", "doc_id", "text_key", "n_shingles", "sketch", "bits"))
        where = marked.select("node", F.col("doc_id").alias("own_id"), F.col("text_key").alias("own_key"))
        texts = docs.join(where, F.expr("text_key = own_key AND doc_id <=> own_id"))
        texts = scratch.written(texts.select("node", "text").dropDuplicates(["node"]))
        return written(link_lists(listed, marked, texts, width, percent, scratch))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row per document with the smallest document id that its links reach.

    ``docs`` has ``doc_id`` and ``text``; further columns are ignored.  Two texts are linked if
    their sets of ``width``-word shingles share at least ``percent`` per cent of their union; a
    text with fewer words has its whole sequence as the one shingle.  Returns doc_id,
    n_shingles, component_id, kept, and text_key (a hash of the text, which tells rows with
    equal ids apart).

    Texts that are null or have no words link with nothing and are kept.  Repeated rows are
    members of one class and all get its component; rows with equal ids are all kept or all
    dropped if they fall into one component.  A null id never stands for a component unless
    all of its ids are null, and then the component and ``kept`` are null.  An empty table
    gives no rows.
    """
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    with Scratch(docs.sparkSession) as scratch:
        signed = scratch.written(signatures(docs, width))
        row = F.struct("doc_id", "text_key", "n_shingles", "sketch", "bits")
        known = signed.where("node IS NOT NULL").groupBy("node")
        # The smallest id stands for a class; only null ids leave min_by empty.
        classes = known.agg(F.coalesce(F.min_by(row, "doc_id"), F.first(row)).alias("r"))
        classes = scratch.written(classes.select("node", "r.*"))
        rows = scratch.written(signed.select("doc_id", "text_key", "n_shingles", "node"))
        scratch.drop(signed)
        roots = link_classes(classes, docs, width, percent)
        root_of = classes.select("node", "doc_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        least = root_of.groupBy("root").agg(F.min("doc_id").alias("component_id"))
        placed = root_of.join(least, "root").select("node", "component_id")
        result = rows.join(placed, "node", "left")
        component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
        return written(
            result.select(
                "doc_id", "n_shingles", component.alias("component_id"), (F.col("doc_id") == component).alias("kept"), "text_key"
            )
        )
