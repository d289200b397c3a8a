"""Language identification by nearest centroids of TF-IDF character n-gram vectors.

A text is a vector of counts of its byte trigrams and bigrams (lower-case, everything but
letters as one space), hashed to ``DIMENSIONS`` places, weighted by inverse document frequency
and scaled to length one.  Each language has a few centroids, found by spherical k-means.  A
text gets the language of the centroid with the largest cosine; it is marked as rejected if
that cosine is below what nearly all training texts of the centroid reach.

Document frequencies count all training documents.  The centroids of each language are fitted
on a bounded sample of its own: about ``SAMPLE`` of its training texts, chosen by a hash of the
id, or all of them if it has fewer.  Texts are made vectors in the tasks, whole, however long.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicpanel.llm.words import LOWER, text_bytes, text_slices

DIMENSIONS = 4096
#: Training texts of each language, and of all; many languages share the latter, but each has its least number.
SAMPLE = 1_000
SAMPLES, LEAST_SAMPLE = 12_000, 50
CENTROIDS = 3
ROUNDS = 12
#: The share of training texts that may lie beyond the radius of their centroid.
BEYOND = 0.005
#: How sharply cosines become a score.
SHARPNESS = 12.0
UNKNOWN = "und"

_LETTER = LOWER.copy()
_LETTER[[b for b in range(128) if not 97 <= LOWER[b] <= 122]] = 32
#: A letter of any script; digits, fractions and numerals are none.  The same in tasks and in expressions.
A_LETTER = r"\p{L}"
_A_LETTER = regex.compile(A_LETTER)


def vectors(texts: pa.Array) -> np.ndarray:
    """One row of dampened n-gram counts for each text."""
    data, offsets = text_bytes(texts)
    data = _LETTER[data].astype(np.uint32)
    out = np.zeros((len(offsets) - 1, DIMENSIONS), np.float32)
    shift = np.uint32(32 - DIMENSIONS.bit_length() + 1)
    two = ((data[:-1] << 8 | data[1:]) * np.uint32(2654435761)) >> shift
    three = ((data[:-2] << 16 | data[1:-1] << 8 | data[2:]) * np.uint32(2246822519)) >> shift
    for row, (a, b) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
        if b - a > 2:
            out[row] = np.bincount(three[a : b - 2], minlength=DIMENSIONS)
        if b - a > 1:
            out[row] += np.bincount(two[a : b - 1], minlength=DIMENSIONS)
    return np.log1p(out, out=out)


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    of: np.ndarray  # of each centroid: the place of its language
    centroids: np.ndarray
    radius: np.ndarray  # of each centroid: the least cosine that is not rejected
    weights: np.ndarray  # inverse document frequencies


def fit(rows: np.ndarray, languages: list[str], weights: np.ndarray) -> Model:
    names = tuple(sorted(set(languages)))
    rows, own = unit(rows * weights), np.array(languages)
    of, centroids, radius = [], [], []
    for place, name in enumerate(names):
        mine = rows[own == name]
        k = min(CENTROIDS, len(mine))
        chosen = [0]  # farthest-first starts
        for _ in range(k - 1):
            chosen.append(int(np.argmin((mine @ mine[chosen].T).max(axis=1))))
        centers = mine[chosen]
        for _ in range(ROUNDS):
            near = (mine @ centers.T).argmax(axis=1)
            centers = unit(np.stack([mine[near == c].mean(axis=0) if (near == c).any() else centers[c] for c in range(k)]))
        cosine = mine @ centers.T
        near = cosine.argmax(axis=1)
        for c in range(k):
            reached = cosine[near == c, c]
            if len(reached):
                of.append(place)
                centroids.append(centers[c])
                radius.append(np.quantile(reached, BEYOND))
    return Model(names, np.array(of), np.array(centroids, np.float32), np.array(radius), weights)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, docs = np.zeros(DIMENSIONS, np.int64), 0
    for batch in batches:
        for a, b in text_slices(batch["text"]):
            total += (vectors(batch["text"].slice(a, b - a)) > 0).sum(axis=0)
            docs += b - a
    place = np.append(np.flatnonzero(total), DIMENSIONS)  # the last place counts documents
    yield pa.RecordBatch.from_arrays([pa.array(place, pa.int32()), pa.array(np.append(total, docs)[place])], ["place", "docs"])


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in text_slices(batch["text"], 1 << 20):
            part = batch.slice(a, b - a)
            rows = pa.array([v.tobytes() for v in vectors(part["text"]).astype(np.float16)], pa.binary())
            yield pa.RecordBatch.from_arrays([part["doc_id"], part["lang"], rows], ["doc_id", "lang", "vector"])


def learn(docs: DataFrame) -> Model | None:
    """A model of the training rows of ``docs``; ``None`` without any."""
    train = docs.where(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) != 0)
    train = train.where(F.col("lang").isNotNull() & F.col("text").rlike(A_LETTER))
    counted = train.select("text").mapInArrow(_frequencies, "place int, docs bigint").groupBy("place").agg(F.sum("docs"))
    found = dict(counted.collect())  # at most DIMENSIONS + 1 rows
    docs_in_all = found.get(DIMENSIONS, 0)
    if not docs_in_all:
        return None
    weights = np.log((1 + docs_in_all) / (1 + np.array([found.get(k, 0) for k in range(DIMENSIONS)], float)))
    texts_of = dict(train.groupBy("lang").count().collect())  # one row for each language
    most = min(SAMPLE, max(LEAST_SAMPLE, SAMPLES // len(texts_of)))
    share = F.create_map(*(F.lit(x) for lang, n in texts_of.items() for x in (lang, min(1.0, most / n))))
    draw = F.xxhash64("doc_id", F.lit("language")).bitwiseAND(F.lit((1 << 52) - 1)) / F.lit(float(1 << 52))
    sample = train.where(draw < share[F.col("lang")]).select("doc_id", "lang", "text").mapInArrow(_vectors, "doc_id bigint, lang string, vector binary")
    rows = sorted(tuple(r) for r in sample.collect())
    found = np.stack([np.frombuffer(r[2], np.float16) for r in rows]).astype(np.float32)
    return fit(found, [r[1] for r in rows], weights.astype(np.float32))


def _named(batches: Iterator[pa.RecordBatch], model: Model | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in text_slices(batch["text"], 1 << 20):
            part = batch.slice(a, b - a)
            texts = part["text"].to_pylist()
            known = np.array([model is not None and bool(_A_LETTER.search(t or "")) for t in texts])
            names, scores, cosines, far = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts)), np.zeros(len(texts), bool)
            if known.any():
                cosine = unit(vectors(part["text"]) * model.weights) @ model.centroids.T
                best = cosine.argmax(axis=1)
                by_language = np.stack([cosine[:, model.of == k].max(axis=1) for k in range(len(model.languages))], axis=1)
                odds = np.exp(SHARPNESS * (by_language - by_language.max(axis=1, keepdims=True)))
                scores = np.where(known, odds.max(axis=1) / odds.sum(axis=1), 0.0).astype(float)
                cosines = np.where(known, cosine.max(axis=1), 0.0).astype(float)
                far = known & (cosine.max(axis=1) < model.radius[best])
                names = [model.languages[model.of[c]] if k else UNKNOWN for c, k in zip(best, known, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"], part["held_out"], pa.array(names, pa.string()), pa.array(scores), pa.array(cosines), pa.array(far)],
                ["doc_id", "held_out", "lang_pred", "score", "cosine", "rejected"],
            )


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, cosine and rejected for every row of ``docs``.

    ``docs`` has doc_id, text and lang; further columns are ignored.  Rows whose crc32 of the id
    leaves no remainder by 5 (``held_out``), null ids and null languages are not learned from.
    A null text and one without a letter is ``und`` with score 0, and so is every text if there
    is nothing to learn from.  Whole texts are read; repeated rows are named alike.
    """
    model = learn(docs.select("doc_id", "text", "lang"))
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))
    return docs.select("doc_id", "text", held.alias("held_out")).mapInArrow(
        partial(_named, model=model),
        "doc_id bigint, held_out boolean, lang_pred string, score double, cosine double, rejected boolean",
    )
