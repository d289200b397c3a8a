"""Quality rules with adaptive thresholds from mergeable quantile sketches.

Counts of each text give four measures.  A sketch of a measure is the number of documents in
each bucket of a fixed scale whose width grows with the value (a sixteenth of it at most), so
sketches of any two parts of the corpus merge by adding.  There is one sketch for each
language and source, each language, and the corpus; the finest one with ``ENOUGH`` documents
gives the thresholds of a document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicpanel.lineage import written
from civicpanel.llm.words import SPACE, find_words, mix, run_hashes, span_hashes, text_slices

LEAST_WORDS = 50
REPEATED_PERCENT = 50
ENOUGH = 200
#: Distances of the limits of the word length from the median, in spreads (median less the 10th percentile).
SPREADS = 6
#: Distances of the other limits from the 90th percentile, in spreads of the tail (90th less 75th percentile).
TAIL_SPREADS = 3
#: What every limit allows beyond that: the measure, in ten-thousandths a word or line, and the least distance.
SLACK = {"symbols": 1_000, "duplicate_lines": 2_000, "repeats": 1_000, "word_length": 15_000}

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


def text_counts(texts: pa.Array) -> dict[str, np.ndarray]:
    words = find_words(texts)
    n = len(words.offsets) - 1

    def within(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return np.diff(total[words.offsets])

    def own(hashes: np.ndarray, text: np.ndarray) -> np.ndarray:
        """Hashes that agree only inside one text."""
        return mix(hashes ^ mix(text.astype(np.uint64) + np.uint64(1)))

    breaks = np.flatnonzero(words.data == 10)
    begins = np.sort(np.concatenate([words.offsets[:-1], breaks + 1]))
    ends = np.sort(np.concatenate([breaks, words.offsets[1:]]))
    solid = np.concatenate([[0], np.cumsum(~SPACE[words.data], dtype=np.int64)])
    filled = solid[ends] > solid[begins]
    begins, ends = begins[filled], ends[filled]
    text_of_line = np.searchsorted(words.offsets, begins, side="right") - 1
    _, firsts = np.unique(own(span_hashes(words.data, begins, ends), text_of_line), return_index=True)
    lines = np.bincount(text_of_line, minlength=n)

    runs, at = run_hashes(words.hashes(), words.first, 3)
    text_of = words.text_of
    inside = (words.counts >= 3)[text_of[at]]
    runs, at = runs[inside], at[inside]
    _, index, count = np.unique(own(runs, text_of[at]), return_inverse=True, return_counts=True)
    again = at[count[index] > 1]
    covered = np.zeros(len(text_of), bool)
    for k in range(3):
        covered[again + k] = True
    return {
        "n_words": words.counts,
        "word_chars": within(~SPACE[words.data] & ((words.data & 0xC0) != 0x80)),
        "n_symbols": within(_SYMBOL[words.data]),
        "n_dup_lines": lines - np.bincount(text_of_line[firsts], minlength=n),
        "n_repeat_words": np.bincount(text_of[covered], minlength=n),
        "n_lines": lines,
    }


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in text_slices(batch["text"]):
            part = batch.slice(a, b - a)
            counts = text_counts(part["text"])
            yield pa.RecordBatch.from_arrays(
                [*part.columns, *(pa.array(counts[c].astype(np.int64)) for c in COUNTS)], [*part.schema.names, *COUNTS]
            )


def counted(docs: DataFrame) -> DataFrame:
    """``docs`` with the counts of its whole texts; columns of these names are replaced."""
    docs = docs.drop(*COUNTS)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(_counted, ", ".join([fields, *(f"{c} bigint" for c in COUNTS)]))


def measures() -> dict[str, Column]:
    """Whole numbers, ten thousand for each unit; null where the base is empty."""
    share = lambda part, whole: F.expr(f"CASE WHEN {whole} > 0 THEN 10000 * {part} DIV {whole} END")
    return {
        "symbols": share("n_symbols", "n_words"),
        "duplicate_lines": share("n_dup_lines", "n_lines"),
        "repeats": share("n_repeat_words", "n_words"),
        "word_length": share("word_chars", "n_words"),
    }


def bucket(value: Column) -> Column:
    """The low end of the bucket of a whole number: exact to 32, then 16 buckets for each doubling."""
    step = F.greatest(F.lit(0), F.length(F.bin(value)) - 5)
    return F.call_function("shiftleft", F.call_function("shiftright", value, step), step)


def sketches(counts: DataFrame) -> DataFrame:
    """Merged sketches: level (2: language and source, 1: language, 0: all), lang, source, measure, bucket, docs."""
    rows = F.array(*(F.struct(F.lit(k).alias("measure"), v.alias("value")) for k, v in measures().items()))
    fine = (
        counts.select("lang", "source", F.explode(rows).alias("m"))
        .where("m.value IS NOT NULL")
        .groupBy("lang", "source", F.col("m.measure").alias("measure"), bucket(F.col("m.value")).alias("bucket"))
        .agg(F.count("*").alias("docs"))
    )
    level = lambda n, lang, source: F.struct(F.lit(n).alias("level"), lang.alias("lang"), source.alias("source"))
    none = F.lit(None).cast("string")
    levels = F.array(level(2, F.col("lang"), F.col("source")), level(1, F.col("lang"), none), level(0, none, none))
    return (
        fine.select(F.explode(levels).alias("g"), "measure", "bucket", "docs")
        .groupBy("g.level", "g.lang", "g.source", "measure", "bucket")
        .agg(F.sum("docs").alias("docs"))
    )


def thresholds(merged: DataFrame) -> DataFrame:
    """For each level, language and source: ``low`` and ``high`` of every measure, null where the sketch has too few documents."""
    group = ["level", "lang", "source", "measure"]
    by = Window.partitionBy(*group)
    ranked = merged.withColumn("up_to", F.sum("docs").over(by.orderBy("bucket"))).withColumn("all", F.sum("docs").over(by))
    at = lambda p: F.min(F.when(F.col("up_to") * 100 >= F.col("all") * p, F.col("bucket")))
    quantiles = ranked.groupBy(*group).agg(F.first("all").alias("all"), *(at(p).alias(f"q{p}") for p in (10, 50, 75, 90)))
    slack = F.create_map(*(F.lit(x) for pair in SLACK.items() for x in pair))[F.col("measure")]
    reach = SPREADS * (F.col("q50") - F.col("q10")) + slack
    # Most texts have none of the one-sided measures, so their limits follow the tail; a bucket is a sixteenth wide.
    tail = F.expr(f"q90 + q90 DIV 16 + {TAIL_SPREADS} * (q90 - q75)") + slack
    limits = quantiles.where(F.col("all") >= ENOUGH)
    columns = []
    for name in SLACK:
        here = F.col("measure") == name
        high = F.col("q50") + reach if name == "word_length" else tail
        columns.append(F.max(F.when(here, high)).alias(f"high_{name}"))
        if name == "word_length":
            columns.append(F.max(F.when(here, F.col("q50") - reach)).alias(f"low_{name}"))
    return limits.groupBy("level", "lang", "source").agg(*columns)


def judged(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, lang, source, ...) with counts, base_failed, kept and the reasons.

    The base rule fails texts of fewer than 50 words, also null and empty ones, and texts most
    of whose words stand in repeated three-word windows.  The others are kept unless a measure
    is beyond the limit of their language and source; null is a language or source like any
    other.  Groups with too few documents take the limits of the language, then of the
    corpus; in a corpus with too few documents only the base rule holds.  Repeated rows are
    judged alike, an empty table gives no rows.
    """
    own = [*COUNTS, "base_failed", "kept", "reasons"]
    docs = docs.drop(*own)
    limits = written(thresholds(sketches(counted(docs.select("lang", "source", "text")).drop("text"))))
    rows = counted(docs)
    names = [c for c in limits.columns if c not in ("level", "lang", "source")]
    mark = "_"  # begins no column of the documents
    while any(c.startswith(mark) for c in docs.columns):
        mark += "_"
    for level, keys in ((2, ["lang", "source"]), (1, ["lang"]), (0, [])):
        at = limits.where(F.col("level") == level).select(
            F.lit(True).alias(f"{mark}found"),
            *(F.col(k).alias(mark + k) for k in keys),
            *(F.col(c).alias(f"{mark}{c}_{level}") for c in names),
        )
        same = F.col(f"{mark}found")
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(mark + k))
        if keys:
            rows = rows.join(at, same, "left").drop(f"{mark}found", *(mark + k for k in keys))
        else:  # one row at most: a scalar subquery for each limit
            for c in names:
                rows = rows.withColumn(f"{mark}{c}_0", at.agg(F.max(f"{mark}{c}_0")).scalar())
    values = measures()
    reasons = []
    for c in names:
        side, measure = c.split("_", 1)
        limit = F.coalesce(*(F.col(f"{mark}{c}_{level}") for level in (2, 1, 0)))
        beyond = values[measure] > limit if side == "high" else values[measure] < limit
        reasons.append(F.when(beyond, F.lit(c)))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))
    rows = rows.withColumn("base_failed", failed).withColumn("reasons", F.array_compact(F.array(*reasons)))
    kept = ~F.col("base_failed") & (F.size("reasons") == 0)
    return rows.withColumn("kept", kept).drop(*(f"{mark}{c}_{level}" for c in names for level in (2, 1, 0)))
