"""Importance resampling of documents towards a target corpus, by hashed word n-grams.

Words come from UTF-8 bytes: a table of 256 bytes lowers A-Z and blanks every separator, and
``bytes.split`` gives the words.  The bucket of an n-gram is its CRC-32 modulo the number of
buckets; the checksum of a shorter n-gram is the seed of the next longer one, so no n-gram is
ever put together as bytes.  Counters reduce the words of each batch, then the buckets of each
task, and Spark adds the tasks up.

A document's weight is the floored mean of the log gains of its n-grams, and its score adds
Gumbel noise that depends on its id alone: the highest scores are a draw without replacement
in proportion to the importance weights.  The cut is taken from exact counts of the scores,
which are few (``score_counts``), and the drawn rows are numbered by a range sort.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicpanel.lineage import written

BUCKETS = 10_000
SEED = "2024"
LEAST_WORDS = 20
PERCENT = 10
#: Bytes of a text that are split into words at once.
BLOCK_BYTES = 1 << 20
#: Words of which a task keeps the bucket or gain at hand.
WORDS_AT_HAND = 500_000

#: Lowers A-Z; digits, letters and all bytes above ASCII stay; the rest separates words.
TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def word_blocks(text: str | None) -> Iterator[list[bytes]]:
    """The words of a text in blocks of about ``BLOCK_BYTES``; no word is cut."""
    data, at = (text or "").encode(), 0
    while at < len(data):
        block = data[at : at + BLOCK_BYTES].translate(TABLE)
        if at + BLOCK_BYTES < len(data):
            end = block.rfind(b" ") + 1
            if not end:  # a word that is longer than a block
                rest = data[at + BLOCK_BYTES :].translate(TABLE)
                more = rest.find(b" ")
                block += rest if more < 0 else rest[:more]
                end = len(block)
            block = block[:end]
        at += len(block)
        yield block.split()


class Checksums(dict):
    """word: its CRC-32, kept for a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_AT_HAND:
            self.clear()
        self[word] = found = zlib.crc32(word)
        return found


def gram_buckets(blocks: Iterator[list[bytes]], longest: int, buckets: int, sums: Checksums) -> Iterator[int]:
    """The bucket of every run of 1 to ``longest`` words, joined by one space."""
    open_runs: list[int] = []  # checksums of the runs that end at the word before, longest first
    for words in blocks:
        for word in words:
            spaced = b" " + word
            open_runs = [zlib.crc32(spaced, seed) for seed in open_runs[-(longest - 1) :]] if longest > 1 else []
            open_runs.append(sums[word])
            for value in open_runs:
                yield value % buckets


def _counted(batches: Iterator[pa.RecordBatch], longest: int, buckets: int) -> Iterator[pa.RecordBatch]:
    found: Counter[int] = Counter()
    sums = Checksums()
    for batch in batches:
        words: Counter[bytes] = Counter()
        for text in batch["text"]:
            if longest > 1:
                found.update(gram_buckets(word_blocks(text.as_py()), longest, buckets, sums))
                continue
            for block in word_blocks(text.as_py()):
                words.update(block)
                if len(words) > WORDS_AT_HAND:
                    _reduce(words, found, buckets)
        _reduce(words, found, buckets)
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(found), pa.int32()), pa.array(list(found.values()), pa.int64())], ["bucket", "features"]
    )


def _reduce(words: Counter[bytes], into: Counter[int], buckets: int) -> None:
    for word, count in words.items():
        into[zlib.crc32(word) % buckets] += count
    words.clear()


def bucket_counts(texts: DataFrame, longest: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, features): how many n-grams of ``texts`` (text) fall into each bucket that has any."""
    counted = texts.select("text").mapInArrow(
        partial(_counted, longest=longest, buckets=buckets), "bucket int, features bigint"
    )
    return counted.groupBy("bucket").agg(F.sum("features").alias("features"))


def gains(docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = BUCKETS) -> list[int]:
    """Thousandths of the log ratio of the smoothed shares of each bucket, floored.

    Both count tables have at most one row for each of ``buckets`` buckets, whatever the corpus.
    """
    raw, wanted = (dict(bucket_counts(t, longest, buckets).collect()) for t in (docs, target))
    all_raw, all_wanted = sum(raw.values()), sum(wanted.values())
    return [
        math.floor(1000 * math.log(
            float((wanted.get(b, 0) + 1) * (all_raw + buckets)) / float((raw.get(b, 0) + 1) * (all_wanted + buckets))
        ))
        for b in range(buckets)
    ]


class Gains(dict):
    """word: its gain, kept for a bounded number of words."""

    def __init__(self, gain: list[int]):
        super().__init__()
        self.gain = gain

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_AT_HAND:
            self.clear()
        self[word] = found = self.gain[zlib.crc32(word) % len(self.gain)]
        return found


def _weighed(batches: Iterator[pa.RecordBatch], longest: int, gain: list[int]) -> Iterator[pa.RecordBatch]:
    of_word, sums = Gains(gain), Checksums()
    for batch in batches:
        n_words, n_features, weights = [], [], []
        for text in batch["text"]:
            words = features = total = 0
            for block in word_blocks(text.as_py()):
                words += len(block)
                if longest == 1:
                    total += sum(map(of_word.__getitem__, block))
            features = words
            if longest > 1:
                # A run of k words begins at every word but the last k-1.
                features = sum(max(0, words - k) for k in range(longest))
                total = sum(gain[b] for b in gram_buckets(word_blocks(text.as_py()), longest, len(gain), sums))
            n_words.append(words)
            n_features.append(features)
            weights.append(total // features if features else 0)
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], *(pa.array(v, pa.int64()) for v in (n_words, n_features, weights))],
            ["doc_id", "n_words", "n_features", "weight"],
        )


def noise(doc_id, seed: str = SEED):
    """Thousandths of standard Gumbel noise from the first 32 bits of a hash of the id, floored."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def resample(
    docs: DataFrame,
    target: DataFrame,
    longest: int = 1,
    buckets: int = BUCKETS,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: str = SEED,
) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with its weight, score and rank in the draw.

    ``target`` has ``text``.  Of the rows with at least ``least_words`` words ``percent`` per
    cent, rounded down, are drawn: those with the highest scores, ties to the smaller id.
    Returns doc_id, n_features, weight, score, rank (1, 2, 3 ... for drawn rows, else null).

    Null and empty texts have no features and weight 0.  A null id is scored as an empty one
    and comes after all others in a tie.  Repeated rows are rows of their own; where ids and
    scores are equal, the row with fewer features comes first.  An empty table gives no rows,
    an empty target leaves the gains to the corpus; further columns are ignored.
    """
    docs = docs.select("doc_id", "text")
    gain = gains(docs, target, longest, buckets)
    scored = docs.mapInArrow(
        partial(_weighed, longest=longest, gain=gain), "doc_id bigint, n_words bigint, n_features bigint, weight bigint"
    )
    scored = written(scored.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)))
    may = F.col("n_words") >= least_words
    # Gains and noise are thousandths of logarithms of 64-bit numbers: at most some 200,000 scores.
    score_counts = scored.where(may).groupBy("score").count().orderBy(F.col("score").desc()).collect()
    draw = sum(r["count"] for r in score_counts) * percent // 100
    cut, above = None, 0
    for r in score_counts:
        if above >= draw:
            break
        cut, above = r["score"], above + r["count"]
    if cut is None:
        return scored.select("doc_id", "n_features", "weight", "score", F.lit(None).cast("bigint").alias("rank"))
    chosen = F.coalesce(may & (F.col("score") >= cut), F.lit(False))
    keys = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features")]
    # The position packs the number of the range above 33 bits of row number; it is written
    # because the numbers and the sizes of the ranges must agree even if a task runs again.
    ordered = written(scored.where(chosen).orderBy(*keys).withColumn("position", F.monotonically_increasing_id()))
    part = F.shiftright("position", 33)
    sizes = sorted(ordered.groupBy(part.alias("part")).count().collect())  # one row for each range
    ahead, before = [], 0
    for number, rows in sizes:
        ahead.append((number, before))
        before += rows
    starts = docs.sparkSession.createDataFrame(ahead, "part bigint, ahead bigint")
    rank = F.col("ahead") + F.col("position").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    drawn = ordered.withColumn("part", part).join(F.broadcast(starts), "part").withColumn("place", rank)
    columns = ["doc_id", "n_features", "weight", "score"]
    drawn = drawn.select(*columns, F.when(F.col("place") <= draw, F.col("place")).alias("rank"))
    return drawn.union(scored.where(~chosen).select(*columns, F.lit(None).cast("bigint").alias("rank")))
