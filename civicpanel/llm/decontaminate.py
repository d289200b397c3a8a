"""Benchmark decontamination by winnowed fingerprints, in DataFrame functions only.

A fingerprint is the smallest hash of ``GRAM`` consecutive words in each stretch of
``SPAN - GRAM + 1`` such hashes, so any two texts that share ``SPAN`` consecutive words share
a fingerprint.  Documents whose fingerprints meet those of the benchmark are looked at again:
the words around each hit are extended to all windows of ``SPAN`` words that hold it, and those
windows are compared word by word with the windows of the benchmark.

Items shorter than ``SPAN`` words are one window each and shorter than what fingerprints
guarantee; only if there are any, windows of their lengths are compared for all documents.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicpanel.lineage import written

SPAN = 10
GRAM = 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Lower-case words (A-Z only is lowered): runs of digits, letters a-z and anything beyond ASCII."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, BETWEEN), "")


def with_grams(rows: DataFrame) -> DataFrame:
    """Adds ``grams``: the hash of every run of ``GRAM`` words; rows need ``SPAN`` words or more."""
    rows = rows.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    run = ", ".join(f"hashes[i + {k}]" for k in range(GRAM))
    return rows.withColumn("grams", F.expr(f"transform(sequence(0, size(hashes) - {GRAM}), i -> xxhash64({run}))")).drop("hashes")


def fingerprints(rows: DataFrame) -> DataFrame:
    """Replaces ``grams`` by ``print``, one row for each distinct fingerprint."""
    width = SPAN - GRAM + 1
    minima = F.expr(f"array_distinct(transform(sequence(1, size(grams) - {width - 1}), i -> array_min(slice(grams, i, {width}))))")
    return rows.withColumn("print", F.explode(minima)).drop("grams")


def window_text(start: str, length: int | str) -> str:
    return f"array_join(slice(words, {start} + 1, {length}), ' ')"


def occurrences(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, text_key, start, length, item_id) for every window of the benchmark in a document."""
    items = written(
        benchmark.select("item_id", words_of(F.col("text")).alias("words")).where("size(words) > 0")
    )
    long_items = items.where(f"size(words) >= {SPAN}")
    windows = written(
        long_items.select("item_id", "words", F.expr(f"explode(sequence(0, size(words) - {SPAN}))").alias("i"))
        .select("item_id", F.expr(window_text("i", SPAN)).alias("window"))
        .distinct()
    )
    prints = written(fingerprints(with_grams(long_items.select("words"))).select("print").distinct())

    worded = docs.select("doc_id", F.xxhash64("text").alias("text_key"), words_of(F.col("text")).alias("words"))
    enough = worded.where(f"size(words) >= {SPAN}")
    met = fingerprints(with_grams(enough).select("doc_id", "text_key", "grams")).join(prints, "print")
    met = written(met.groupBy("doc_id", "text_key").agg(F.collect_set("print").alias("prints")))

    own = met.select(F.col("doc_id").alias("own_id"), F.col("text_key").alias("own_key"), "prints")
    again = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text").join(
        own, F.expr("text_key = own_key AND doc_id <=> own_id")
    )
    again = with_grams(again.select("doc_id", "text_key", "prints", words_of(F.col("text")).alias("words")))
    before = SPAN - GRAM
    again = again.withColumn(
        "starts",
        F.expr(
            "array_distinct(flatten(transform(filter(sequence(0, size(grams) - 1), p -> array_contains(prints, grams[p])), "
            f"p -> sequence(greatest(0, p - {before}), least(p, size(words) - {SPAN})))))"
        ),
    )
    # The outer form, because the plain one filters by the size of the array below the join, where it is computed anew.
    spans = again.select("doc_id", "text_key", "words", F.explode_outer("starts").alias("start")).where("start IS NOT NULL")
    spans = spans.select("doc_id", "text_key", "start", F.expr(window_text("start", SPAN)).alias("window"))
    found = [spans.join(windows, "window").select("doc_id", "text_key", "start", F.lit(SPAN).alias("length"), "item_id")]

    short_items = items.where(f"size(words) < {SPAN}").select("item_id", "words")
    lengths = sorted(r[0] for r in short_items.select(F.size("words")).distinct().collect())  # below SPAN
    for length in lengths:
        whole = short_items.where(F.size("words") == length).select("item_id", F.array_join("words", " ").alias("window"))
        spans = worded.where(F.size("words") >= length).select(
            "doc_id", "text_key", "words", F.expr(f"explode(sequence(0, size(words) - {length}))").alias("start")
        )
        spans = spans.select("doc_id", "text_key", "start", F.expr(window_text("start", length)).alias("window"))
        found.append(
            spans.join(whole.distinct(), "window").select("doc_id", "text_key", "start", F.lit(length).alias("length"), "item_id")
        )
    return reduce(DataFrame.union, found)


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    ``docs`` has doc_id and text, ``benchmark`` item_id and text; further columns are ignored.
    A word is hit if it is inside any occurrence of a window of an item.  Null and empty texts
    and items have no words and hit nothing.  A null item id counts no item but its windows
    hit; rows with equal item ids are one item.  Repeated documents get equal rows.  The digest
    of no items is that of the empty string.  Empty tables give no rows or no hits.
    """
    docs = docs.select("doc_id", "text")
    found = occurrences(docs, benchmark.select("item_id", "text"))
    by_doc = found.groupBy("doc_id", "text_key").agg(
        F.collect_set(F.struct("start", "length")).alias("spans"),
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"),
    )
    hit = by_doc.select(
        F.col("doc_id").alias("own_id"),
        F.col("text_key").alias("own_key"),
        F.expr("size(array_distinct(flatten(transform(spans, s -> sequence(s.start, s.start + s.length - 1)))))").alias("hit"),
        "items",
    )
    lowered = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    rows = docs.select(
        "doc_id", F.xxhash64("text").alias("text_key"), F.regexp_count(lowered, F.lit(WORD)).cast("bigint").alias("n_words")
    )
    rows = rows.join(hit, F.expr("text_key = own_key AND doc_id <=> own_id"), "left")
    items = F.coalesce("items", F.array().cast("array<string>"))
    return rows.select(
        "doc_id",
        "n_words",
        F.coalesce("hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        F.col("hit").isNotNull().alias("contaminated"),
    )
