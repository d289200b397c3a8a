"""Toxicity by compression distance under two zstandard dictionaries.

Both dictionaries end with the same ordinary text and a mark; the toxic one also holds, in
front of it, the word beginnings that are many times as frequent in toxic text.  Every text is
cut into windows of ``WINDOW_WORDS`` words.  A window that holds toxic words is shorter under
the toxic dictionary, and one without them is as long under either.  The saved bytes of a text
are compared with a calibrated threshold.

The model is fitted on a bounded sample of the labelled rows: at most about ``SAMPLE_TOXIC``
and ``SAMPLE_ORDINARY`` texts of up to ``SAMPLE_BYTES`` bytes, chosen by a hash of the id.
Two thirds train the dictionaries, the others calibrate the threshold.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicpanel.lineage import written

SAMPLE_TOXIC = 3_000
SAMPLE_ORDINARY = 5_000
SAMPLE_BYTES = 32_768
WINDOW_WORDS = 3
LEVEL = 12
#: Bytes of ordinary text at the end of both dictionaries, and of toxic text at most.
ORDINARY_BYTES = 500
TOXIC_BYTES = 8_192
#: A word beginning is toxic if it is so many times as frequent in toxic text,
TIMES = 10
#: stands after at least so many different words there, and after such a part of all of its words.
CONTEXTS, CONTEXT_SHARE = 8, 3e-5
#: Candidates for the bytes that a window must save to count; calibration chooses one.
LEAST_SAVED = (2, 3, 4, 5, 6, 7)
MARK = b"\x00\x01window\x02end\x03\x04\x05"


@dataclass(frozen=True)
class Model:
    toxic: bytes
    ordinary: bytes
    least: int
    threshold: float
    slope: float


def text_words(text: str | None) -> list[bytes]:
    """Lower-case words between ASCII white space."""
    return (text or "").encode().lower().split()


def train_dictionaries(texts: list[tuple[str, int]]) -> tuple[bytes, bytes]:
    """The contents of the toxic and of the ordinary dictionary."""
    pairs: tuple[set, set] = (set(), set())
    spread: Counter = Counter()
    for text, toxic in texts:
        before = b""
        own = text_words(text)
        for word in own:
            pairs[toxic].add((before, word))
            before = word
        if not toxic:
            spread.update(set(own))
    counts: tuple[Counter, Counter] = (Counter(), Counter())
    for toxic in (0, 1):
        for _, word in pairs[toxic]:
            for size in range(4, min(len(word), 12) + 1):
                counts[toxic][word[:size]] += 1
    ordinary_rate = TIMES / max(1, len(pairs[0]))
    least = max(CONTEXTS, CONTEXT_SHARE * len(pairs[1]))
    found = {
        w: n for w, n in counts[1].items() if n >= least and n / len(pairs[1]) >= ordinary_rate * (counts[0][w] + 1)
    }
    longer = {w[:k] for w, n in found.items() for k in range(4, len(w)) if n >= 0.8 * found.get(w[:k], np.inf)}
    chosen = sorted(set(found) - longer, key=lambda w: (found[w], w))
    common = sorted(spread, key=lambda w: (spread[w], w))[-400:]
    ordinary = b" ".join(common)[-ORDINARY_BYTES:] + MARK
    return (b" " + b" ".join(chosen) + b" ")[-TOXIC_BYTES:] + ordinary if chosen else ordinary, ordinary


@lru_cache(maxsize=4)
def _compressor(content: bytes):
    import zstandard

    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    # Tables sized for windows alone would leave most of the dictionary out.
    parameters = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, window_log=15, hash_log=12, chain_log=12, search_log=6, min_match=4,
        strategy=zstandard.STRATEGY_BTOPT, write_content_size=False,
        write_checksum=False, write_dict_id=False, format=zstandard.FORMAT_ZSTD1_MAGICLESS,
    )
    return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=parameters)


def savings(text: str | None, toxic: bytes, ordinary: bytes) -> np.ndarray:
    """How many windows of a text save 0, 1, ... bytes under the toxic dictionary; the last place has all above."""
    counts = np.zeros(33, np.int64)
    words = text_words(text)
    if toxic == ordinary:
        counts[0] = -(-len(words) // WINDOW_WORDS)
        return counts
    short, plain = _compressor(toxic), _compressor(ordinary)
    for at in range(0, len(words), WINDOW_WORDS):
        window = b" " + b" ".join(words[at : at + WINDOW_WORDS]) + b" " + MARK
        counts[min(32, max(0, len(plain.compress(window)) - len(short.compress(window))))] += 1
    return counts


def saved(counts: np.ndarray, least: int) -> float:
    """Bytes saved by the windows that save ``least`` or more, for the length of the text."""
    return float(counts[least:] @ np.arange(least, len(counts))) / float(counts.sum() + 20) ** 0.5


def calibrate(values: list[float], toxic: list[int]) -> tuple[float, float]:
    """The threshold with the best F1, and that F1."""
    if not values or not any(toxic):
        return 1.0, 0.0
    order = np.argsort(-np.array(values), kind="stable")
    value, label = np.array(values)[order], np.array(toxic)[order]
    f1 = 2 * np.cumsum(label) / (np.arange(1, len(value) + 1) + label.sum())
    f1[:-1][value[:-1] == value[1:]] = 0
    at = int(np.argmax(f1))
    below = value[at + 1] if at + 1 < len(value) else 0.0
    return float(max((value[at] + below) / 2, 1e-6)), float(f1[at])


def fit(rows: list[tuple[int | None, str, int]]) -> Model:
    """A model of sampled rows (doc_id, text, toxic)."""
    half = [zlib.crc32(b"half%d" % (i or 0)) % 3 // 2 for i, _, _ in rows]
    toxic, ordinary = train_dictionaries([(t, y) for (_, t, y), h in zip(rows, half, strict=True) if h == 0])
    rest = [(savings(t, toxic, ordinary), y) for (_, t, y), h in zip(rows, half, strict=True) if h == 1]
    marks = [y for _, y in rest]
    found = [(*calibrate([saved(v, least) for v, _ in rest], marks), least) for least in LEAST_SAVED]
    threshold, _, least = max(found, key=lambda x: (x[1], -x[2]))
    return Model(toxic, ordinary, least, threshold, 2 / threshold)


def training_sample(docs: DataFrame, labels: DataFrame) -> list[tuple[int | None, str, int]]:
    """At most about the stated numbers of labelled training texts, the same in every run."""
    marks = labels.where("toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    marks = marks.where(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) != 0)
    found = {r[0]: r[1] for r in marks.groupBy("toxic").count().collect()}  # two rows
    share = F.when(F.col("toxic") == 1, F.lit(SAMPLE_TOXIC / max(1, found.get(1, 0)))).otherwise(
        F.lit(SAMPLE_ORDINARY / max(1, found.get(0, 0)))
    )
    draw = F.xxhash64("doc_id", F.lit("toxic")).bitwiseAND(F.lit((1 << 52) - 1)) / F.lit(float(1 << 52))
    most = 2 * (SAMPLE_TOXIC + SAMPLE_ORDINARY)
    chosen = F.broadcast(written(marks.where(draw < share).limit(most)))  # bounded by the limit, so the texts stay where they are
    rows = docs.join(chosen, "doc_id").where(F.octet_length("text") <= SAMPLE_BYTES).select("doc_id", "text", "toxic").limit(most)
    return sorted((tuple(r) for r in rows.collect()), key=lambda r: (r[0], r[1]))


def _scored(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch["text"].to_pylist()
        values = np.array([saved(savings(t, model.toxic, model.ordinary), model.least) for t in texts], float)
        score = 1 / (1 + np.exp(-np.clip(model.slope * (values - model.threshold), -60, 60)))
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["held_out"], pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
            ["doc_id", "held_out", "score", "predicted"],
        )


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (0 or 1) for every row of ``docs``.

    Labels of documents whose crc32 of the id leaves no remainder by 5 (``held_out``) are not
    learned; a null id is not held out.  Whole texts are scored; null and empty texts save
    nothing and so are ordinary.  A document with several labels is toxic if one says so;
    null labels and labels without a document are not used.  Without toxic labels every text
    is ordinary.  Repeated rows are scored alike; further columns are ignored.
    """
    docs = docs.select("doc_id", "text")
    model = fit(training_sample(docs, labels.select("doc_id", "toxic")))
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))
    return docs.select("doc_id", "text", held.alias("held_out")).mapInArrow(
        partial(_scored, model=model), "doc_id bigint, held_out boolean, score double, predicted int"
    )
