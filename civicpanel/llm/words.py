"""Words of whole Arrow text batches as NumPy arrays.

A word is a run of bytes other than ``[\\x20\\x09-\\x0D]``.  All work is done on the UTF-8
bytes of many texts at once; null texts have no words.  Every word gets a 64-bit hash that
depends on nothing but its bytes, so hashes agree between tasks and runs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; one longer text is handled alone.
SLICE_BYTES = 2 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: spreads every input bit over the word."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    return x ^ (x >> np.uint64(31))


SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _GOLDEN)
_BYTE_LOWER = _BYTE[LOWER]
_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of each."""
    global _powers, _inverse
    if len(_powers) < n:
        size = max(n, SLICE_BYTES + 1)
        back = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for name, base in (("_powers", _BASE), ("_inverse", back)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            globals()[name] = np.multiply.accumulate(steps)
    return _powers, _inverse


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """A hash of the bytes of each span of ``data``."""
    powers, inverse = _tables(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_BYTE_LOWER if lower else _BYTE)[data] * powers[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts])


def text_slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts have about ``limit`` bytes together."""
    sizes = np.asarray(pc.binary_length(texts.cast(pa.large_binary())).fill_null(0), np.int64)
    begin = total = 0
    for i, size in enumerate(sizes):
        if i > begin and total + size > limit:
            yield begin, i
            begin, total = i, 0
        total += size
    if begin < len(sizes):
        yield begin, len(sizes)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row, and the offsets of the texts in them."""
    flat = pa.array(texts, pa.large_string()) if not isinstance(texts, pa.Array) else texts.cast(pa.large_string())
    flat = flat.fill_null("")
    _, offsets, data = flat.buffers()
    offsets = np.frombuffer(offsets, np.int64)[flat.offset : flat.offset + len(flat) + 1]
    if data is None or offsets[0] == offsets[-1]:
        return np.zeros(0, np.uint8), np.zeros(len(flat) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


@dataclass
class Words:
    """Words of a batch in order: byte spans, and the range of words of each text."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # of each text: its first word; one more entry closes the last text

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self, lower: bool = False) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends, lower)


def find_words(texts: pa.Array) -> Words:
    data, offsets = text_bytes(texts)
    inside = ~SPACE[data]
    begins, closes = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    begins[edges] = inside[edges]
    closes[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(closes) + 1
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets))


_STEP = [np.uint64(int(_GOLDEN) * (2 * k + 3) % (1 << 64) | 1) for k in range(64)]


def run_hashes(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words inside one text, and the word each begins at.

    A text with fewer words, but not none, gives its whole sequence as one run.
    """
    counts = np.diff(first)
    n = len(hashes)
    long_text = np.repeat(counts >= width, counts)
    last = np.repeat(first[1:], counts) - width
    at = np.flatnonzero(long_text & (np.arange(n) <= last))
    total = np.zeros(len(at), np.uint64)
    for k in range(width):
        total += hashes[at + k] * _STEP[k]
    runs = mix(total + np.uint64(width))
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        more = np.zeros(len(short), np.uint64)
        for k in range(width - 1):
            here = counts[short] > k
            more[here] += hashes[first[short][here] + k] * _STEP[k]
        more = mix(more + counts[short].astype(np.uint64))
        at, runs = np.concatenate([at, first[short]]), np.concatenate([runs, more])
        order = np.argsort(at, kind="stable")
        at, runs = at[order], runs[order]
    return runs, at


def shingle_sets(texts: pa.Array, width: int, lower: bool = True) -> list[np.ndarray]:
    """The sorted distinct run hashes of each text."""
    words = find_words(texts)
    runs, at = run_hashes(words.hashes(lower), words.first, width)
    cut = np.searchsorted(at, words.first)
    return [np.unique(runs[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]


def jaccard(left: np.ndarray, right: np.ndarray) -> tuple[int, int]:
    """Sizes of the intersection and the union of two sorted sets."""
    both = len(np.intersect1d(left, right, assume_unique=True))
    return both, len(left) + len(right) - both


def word_spans(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, salt: int = 0) -> np.ndarray:
    """A hash of the words of each span, given the hashes of all words."""
    powers, inverse = _tables(len(hashes) + 1)
    total = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(mix(hashes + np.uint64(salt) * _GOLDEN) * powers[: len(hashes)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def sliding(best, values: np.ndarray, width: int) -> np.ndarray:
    """The ``best`` (np.minimum or np.maximum) of every ``width`` neighbours, in doubling steps."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = best(values[: len(values) - step], values[step:])
        done += step
    return values
