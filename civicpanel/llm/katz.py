"""A Katz backoff bigram model of the corpus and the log probability of every text.

Counts above ``K`` are trusted; lower ones are discounted by Good-Turing.  What a history
loses goes to the words not seen after it, in proportion to their unigram probability, with a
weight that makes the probabilities after every history sum to one over the vocabulary and one
unknown word.  A word is scored after its history, or backs off to the unigram model.

Texts are handled in chunks.  Tokens travel as compressed columns, not as rows: first the
distinct words of each chunk meet by hash range and learn their counts, then the tokens meet
by history.  A history with more than ``HOT`` occurrences is split by the next word; its
totals, a bounded number of rows, are merged before scoring.  The unigram and bigram tables are
written, by range, to the checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicpanel.lineage import written
from civicpanel.llm.words import find_words, mix, text_slices

K = 5
CHUNK_BYTES = 6 << 20
#: Tokens of training text for each range of histories, and for a history that is split.
RANGE_TOKENS = 1_000_000
HOT = 500_000
#: At most this many histories are split: the limit grows with the corpus beyond that.
HOT_MOST = 10_000
END = np.uint64(0x656E642D6F662D74)


def pack(values: np.ndarray, kind: str = "<u4") -> bytes:
    """A compressed column: the bytes of equal weight stand together."""
    import zstandard

    raw = np.ascontiguousarray(values, kind)
    planes = raw.view(np.uint8).reshape(len(raw), raw.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes, kind: str = "<u4") -> np.ndarray:
    import zstandard

    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(kind).reshape(-1)


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=np.uint64(0)), "<u8")


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, "<u8"), dtype=np.uint64)


_CHUNK = "chunk bigint, doc_id array<bigint>, held array<boolean>, tokens array<bigint>, stream binary, words binary, counts binary"


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        for a, b in text_slices(batch["text"], CHUNK_BYTES):
            words = find_words(batch["text"].slice(a, b - a))
            docs = b - a
            train = ~np.array(batch["held"].slice(a, docs).to_pylist(), bool)
            stream = np.empty(len(words.starts) + docs, np.uint64)
            stream[np.arange(len(words.starts)) + words.text_of] = words.hashes(lower=True)
            stream[words.first[1:] + np.arange(docs)] = END
            tokens = words.counts + 1
            distinct, local = np.unique(stream, return_inverse=True)
            counts = np.bincount(local[np.repeat(train, tokens)], minlength=len(distinct))
            order = np.argsort(-counts, kind="stable")  # frequent words get small numbers, which pack well
            rank = np.empty_like(order)
            rank[order] = np.arange(len(order))
            row = {
                "chunk": [number],
                "doc_id": [batch["doc_id"].slice(a, docs).to_pylist()],
                "held": [(~train).tolist()],
                "tokens": [tokens.tolist()],
                "stream": [pack(rank[local])],
                "words": [pack_sorted(distinct)],
                "counts": [pack(counts)],
            }
            types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row.values(), types, strict=True)], list(row))
            number += 1


def _ask(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Splits the distinct words of each chunk by range of their hash."""
    for batch in batches:
        for row in batch.to_pylist():
            words, counts = unpack_sorted(row["words"]), unpack(row["counts"])
            edges = np.searchsorted(words, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)) if bits else []
            cuts = [0, *edges, len(words)]
            parts = [(k, a, b) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k for k, _, _ in parts], pa.int32()),
                    pa.array([row["chunk"]] * len(parts), pa.int64()),
                    pa.array([pack_sorted(words[a:b]) for _, a, b in parts], pa.binary()),
                    pa.array([pack(counts[a:b]) for _, a, b in parts], pa.binary()),
                ],
                ["part", "chunk", "words", "counts"],
            )


_COUNTED = "part int, chunk bigint, words binary, ids binary, counts binary, n_tokens bigint, n_types bigint, n_r array<bigint>, hot_ids array<bigint>, hot_counts array<bigint>"


def _count(key, table: pa.Table, parts: int) -> pa.Table:
    """Counts of all words of one range, back to each chunk in the order it asked, and the table itself."""
    rows = table.sort_by("chunk").to_pylist()
    own = [unpack_sorted(r["words"]) for r in rows]
    given = np.concatenate([unpack(r["counts"]) for r in rows])
    words, place = np.unique(np.concatenate(own), return_inverse=True)
    counts = np.bincount(place, weights=given, minlength=len(words)).astype(np.uint64)
    rank = np.empty(len(words), np.uint64)
    rank[np.argsort(-counts.astype(np.int64), kind="stable")] = np.arange(len(words), dtype=np.uint64)
    part = key[0].as_py()
    ids = rank * np.uint64(parts) + np.uint64(part)
    ends = np.cumsum([len(x) for x in own])
    out: dict[str, list] = {name.split()[0]: [] for name in _COUNTED.split(", ")}

    def add(**values):
        for name, column in out.items():
            column.append(values.get(name))

    for row, end, mine in zip(rows, ends, own, strict=True):
        here = place[end - len(mine) : end]
        add(part=part, chunk=row["chunk"], ids=pack(ids[here], "<u8"), counts=pack(counts[here], "<u8"))
    small = np.bincount(counts[counts <= K + 1].astype(np.int64), minlength=K + 2)[1:]
    hot = counts > HOT
    add(
        part=part, words=pack_sorted(words), ids=pack(ids, "<u8"), counts=pack(counts, "<u8"), n_tokens=int(counts.sum()),
        n_types=int((counts > 0).sum()), n_r=small.tolist(), hot_ids=ids[hot].astype(np.int64).tolist(),
        hot_counts=counts[hot].astype(np.int64).tolist(),
    )
    long, blob, many = pa.int64(), pa.binary(), pa.list_(pa.int64())
    types = [pa.int32(), long, blob, blob, blob, long, long, many, many, many]
    return pa.Table.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types, strict=True)], list(out))


def discounts(n_r: list[int]) -> np.ndarray:
    """Good-Turing discount ratios of the counts 1 to K (first entry unused).

    Where the statistics of a small corpus give no ratio between 0 and 1, half a count is
    taken off instead.
    """
    ratio = np.ones(K + 1)
    n = [0, *n_r]
    beyond = (K + 1) * n[K + 1] / n[1] if n[1] else 1.0
    for r in range(1, K + 1):
        value = ((r + 1) * n[r + 1] / (r * n[r]) - beyond) / (1 - beyond) if n[r] and beyond < 1 else 0.0
        ratio[r] = value if 0 < value < 1 else (r - 0.5) / r
    return ratio


class Unigrams:
    """Good-Turing unigram probabilities over the vocabulary and one unknown word."""

    def __init__(self, total: int, types: int, n_r: list[int]):
        self.total, self.types, self.ratio = total, types, discounts(n_r)
        small = sum(r * n_r[r - 1] * (1 - self.ratio[r]) for r in range(1, K + 1))
        # Without small counts one unknown token is counted.
        self.base = total if small > 0 else total + 1
        self.unknown = (small if small > 0 else 1.0) / max(1, self.base)

    def of(self, counts: np.ndarray) -> np.ndarray:
        small = np.minimum(counts, K + 1).astype(np.int64)
        ratio = np.append(self.ratio, 1.0)[small] if self.base == self.total else 1.0
        return np.where(counts > 0, ratio * counts / max(1, self.base), self.unknown)


_SENT = "part int, chunk bigint, h binary, w binary, c binary, doc binary, train binary, doc_id array<bigint>, held array<boolean>, n_tokens array<bigint>, n_known array<bigint>, base array<double>"
_SENT_TYPES = [pa.int32(), pa.int64(), *[pa.binary()] * 5, pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.float64())]


def _send(left: pa.Table, right: pa.Table, model: Unigrams, ranges: int, hot: dict[int, int], limit: int) -> pa.Table:
    """Tokens of one chunk with their histories, split by history; and the base score of its texts."""
    chunk, answers = left.to_pylist()[0], right.sort_by("part").to_pylist()
    ids = np.concatenate([unpack(r["ids"], "<u8") for r in answers])
    counts = np.concatenate([unpack(r["counts"], "<u8") for r in answers])
    local = np.argsort(-unpack(chunk["counts"]).astype(np.int64), kind="stable")[unpack(chunk["stream"])]
    tokens = np.array(chunk["tokens"], np.int64)
    firsts = np.concatenate([[0], np.cumsum(tokens)[:-1]])
    word, count = ids[local], counts[local]
    before = np.empty_like(word)
    before[1:] = word[:-1]
    before[firsts] = word[firsts + tokens - 1][0]  # the end of a text is the history of the next
    doc = np.repeat(np.arange(len(tokens)), tokens)
    logs = np.log10((count + 1.0) / (model.total + model.types + 1.0))
    spread = mix(before.copy())
    for h, n in hot.items():
        at = np.flatnonzero(before == np.uint64(h))
        spread[at] = mix(spread[at] + mix(word[at]) % np.uint64(-(-n // limit)))
    part = (spread % np.uint64(ranges)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    cuts = np.searchsorted(part[order], np.arange(ranges + 1))
    train = (~np.array(chunk["held"], bool))[doc].astype(np.uint8)
    rows: list[list] = []
    for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        if b > a:
            at = order[a:b]
            rows.append([k, chunk["chunk"], pack(before[at], "<u8"), pack(word[at], "<u8"), pack(count[at], "<u8"), pack(doc[at]), pack(train[at], "u1"), *[None] * 5])
    known = np.add.reduceat((count > 0).astype(np.int64), firsts)
    rows.append([chunk["chunk"] % ranges, chunk["chunk"], *[None] * 5, chunk["doc_id"], chunk["held"], tokens.tolist(), known.tolist(), np.add.reduceat(logs, firsts).tolist()])
    names = [name.split()[0] for name in _SENT.split(", ")]
    return pa.Table.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(_SENT_TYPES)], names)


_MET = "chunk bigint, doc binary, sums binary, classes binary, open_doc binary, open_n binary, hot_doc binary, hot_h binary, doc_id array<bigint>, held array<boolean>, n_tokens array<bigint>, n_known array<bigint>, base array<double>, n_r array<bigint>, split_h array<bigint>, split_n array<bigint>, split_p array<double>, table_h binary, table_w binary, table_n binary"
_MET_TYPES = [pa.int64(), *[pa.binary()] * 7, pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.float64()), *[pa.list_(pa.int64())] * 3, pa.list_(pa.float64()), *[pa.binary()] * 3]


def _meet(key, table: pa.Table, model: Unigrams, hot: dict[int, int]) -> pa.Table:
    """Counts all bigrams of one range of histories and sums what is known of each text.

    The discounts of bigrams are not known yet: for each text the tokens of each small count are
    counted, and for unseen ones the numbers of small counts after their history are kept.
    """
    names = [name.split()[0] for name in _MET.split(", ")]
    out: list[dict] = []
    rows = []
    for r in table.sort_by("chunk").to_pylist():
        if r["h"] is None:
            out.append({k: r[k] for k in ("chunk", "doc_id", "held", "n_tokens", "n_known", "base")})
        else:
            rows.append(r)
    if rows:
        h, w, c = (np.concatenate([unpack(r[x], "<u8") for r in rows]) for x in "hwc")
        docs = [unpack(r["doc"]) for r in rows]
        train = np.concatenate([unpack(r["train"], "u1") for r in rows])
        order = np.lexsort((w, h))
        sh, sw = h[order], w[order]
        new_h = np.append(True, sh[1:] != sh[:-1])
        new = new_h | np.append(True, sw[1:] != sw[:-1])
        begins = np.flatnonzero(new)
        r_pair = np.add.reduceat(train[order].astype(np.int64), begins)
        h_of_pair = np.cumsum(new_h)[begins] - 1
        n_h = int(new_h.sum())
        c_h = np.bincount(h_of_pair, weights=r_pair, minlength=n_h)
        small = np.stack([np.bincount(h_of_pair[r_pair == r], minlength=n_h) for r in range(1, K + 1)])
        seen_p = np.bincount(h_of_pair, weights=np.where(r_pair > 0, model.of(c[order][begins]), 0.0), minlength=n_h)
        own_h = sh[new_h]
        split = np.isin(own_h, np.array(list(hot), np.uint64))
        for at in np.flatnonzero(split):
            c_h[at] = hot[int(own_h[at])]
        pair = np.empty(len(h), np.int64)
        pair[order] = np.cumsum(new) - 1
        r_tok, h_tok = r_pair[pair], h_of_pair[pair]
        whole = (small.sum(axis=0) == 0) & ~split  # nothing to discount: one more token is counted
        logs = np.zeros(len(h))
        seen = r_tok > 0
        logs[seen] = np.log10(r_tok[seen] / (c_h + whole)[h_tok[seen]])
        unseen = ~seen
        logs[unseen] = np.log10(model.of(c[unseen]))
        open_tok = unseen & (c_h[h_tok] > 0) & ~split[h_tok]
        rest = 1 - seen_p[h_tok[open_tok]]
        logs[open_tok] -= np.log10(c_h + whole)[h_tok[open_tok]] + np.log10(np.maximum(rest, 1e-300))
        at = 0
        for r, doc in zip(rows, docs, strict=True):
            here = slice(at, at + len(doc))
            at += len(doc)
            n_docs = int(doc.max()) + 1
            sums = np.bincount(doc, weights=logs[here], minlength=n_docs)
            classes = np.stack([np.bincount(doc[r_tok[here] == x], minlength=n_docs) for x in range(1, K + 1)])
            opened, hot_open = open_tok[here], (unseen & split[h_tok])[here]
            counts_after = small[:, h_tok[here][opened]]
            out.append({
                "chunk": r["chunk"], "sums": sums.tobytes(), "classes": pack(classes.reshape(-1)),
                "open_doc": pack(doc[opened]), "open_n": pack(counts_after.reshape(-1)),
                "hot_doc": pack(doc[hot_open]), "hot_h": pack(h[here][hot_open], "<u8"),
            })
        n_r = [int((r_pair == r).sum()) for r in range(1, K + 2)]
        known = r_pair > 0
        out.append({
            "n_r": n_r, "split_h": own_h[split].astype(np.int64).tolist(), "split_n": small[:, split].T.reshape(-1).tolist(),
            "split_p": seen_p[split].tolist(), "table_h": pack(sh[begins][known], "<u8"), "table_w": pack(sw[begins][known], "<u8"),
            "table_n": pack(r_pair[known], "<u8"),
        })
    return pa.Table.from_arrays([pa.array([r.get(n) for r in out], t) for n, t in zip(names, _MET_TYPES, strict=True)], names)


_SCORED = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


def _score(key, table: pa.Table, total: int, ratio: np.ndarray, backoff: dict[int, float]) -> pa.Table:
    """Adds up one chunk: log probabilities of its texts."""
    rows = table.to_pylist()
    head = next(r for r in rows if r["doc_id"] is not None)
    score = np.zeros(len(head["doc_id"]))
    held = np.arange(1, K + 1) * (1 - ratio[1:])  # what each small count leaves to unseen words
    for r in sorted((r for r in rows if r["sums"] is not None), key=lambda r: r["sums"]):
        sums = np.frombuffer(r["sums"])
        part = sums + np.log10(ratio[1:]) @ unpack(r["classes"]).reshape(K, -1)
        doc, after = unpack(r["open_doc"]), unpack(r["open_n"]).reshape(K, -1)
        left = held @ after
        part += np.bincount(doc, weights=np.log10(np.where(left > 0, left, 1.0)), minlength=len(sums))
        doc, h = unpack(r["hot_doc"]), unpack(r["hot_h"], "<u8")
        part += np.bincount(doc, weights=[backoff[int(x)] for x in h], minlength=len(sums)) if len(doc) else 0.0
        score[: len(sums)] += part
    return pa.Table.from_arrays(
        [
            pa.array(head["doc_id"], pa.int64()),
            pa.array(head["held"], pa.bool_()),
            pa.array(head["n_tokens"], pa.int64()),
            pa.array(head["n_known"], pa.int64()),
            pa.array([total] * len(score), pa.int64()),
            pa.array(head["base"], pa.float64()),
            pa.array(score, pa.float64()),
        ],
        [name.split()[0] for name in _SCORED.split(", ")],
    )


def backoff_weights(rows, hot: dict[int, int], ratio: np.ndarray) -> dict[int, float]:
    """log10 of the backoff weight of each split history, from the totals of its parts."""
    small: dict[int, np.ndarray] = {}
    seen: dict[int, float] = {}
    for r in rows:
        for h, n, p in zip(r.split_h, np.array(r.split_n, np.int64).reshape(-1, K), r.split_p, strict=True):
            small[h] = small.get(h, 0) + n
            seen[h] = seen.get(h, 0.0) + p
    held = np.arange(1, K + 1) * (1 - ratio[1:])
    return {h: float(np.log10(max(held @ n, 1.0) / hot[h] / max(1 - seen[h], 1e-300))) for h, n in small.items()}


def score_corpus(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``docs`` has doc_id and text; further columns are ignored.  Documents whose crc32 of the id
    leaves 2 by 7 are held out, all others (null ids too) are learned.  A null or empty text
    is its one end token.  Repeated rows are learned and scored as rows of their own.  With
    nothing to learn every token is unknown with probability 1; an empty table gives no rows.
    """
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 2, F.lit(False))
    chunks = written(docs.select("doc_id", held.alias("held"), "text").mapInArrow(_chunks, _CHUNK))
    n_chunks = chunks.count()
    bits = max(0, (n_chunks // 3).bit_length())
    asked = chunks.select("chunk", "words", "counts").mapInArrow(partial(_ask, bits=bits), "part int, chunk bigint, words binary, counts binary")
    counted = written(asked.groupBy("part").applyInArrow(lambda key, rows: _count(key, rows, 1 << bits), _COUNTED))
    tables = counted.where("n_tokens IS NOT NULL")
    n_r = [F.coalesce(F.sum(F.col("n_r")[r]), F.lit(0)) for r in range(K + 1)]
    total, types, *small = tables.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)), F.coalesce(F.sum("n_types"), F.lit(0)), *n_r).first()
    model = Unigrams(total, types, small)
    limit = max(HOT, total // HOT_MOST)
    often = tables.select(F.explode(F.arrays_zip("hot_ids", "hot_counts")).alias("x")).where(F.col("x.hot_counts") > limit)
    hot = {r.x.hot_ids: r.x.hot_counts for r in often.collect()}  # at most HOT_MOST rows
    ranges = max(1, -(-total // RANGE_TOKENS))
    answers = counted.where("n_tokens IS NULL").select("chunk", "part", "ids", "counts")
    sent = (
        chunks.select("chunk", "doc_id", "held", "tokens", "stream", "counts").groupBy("chunk").cogroup(answers.groupBy("chunk"))
        .applyInArrow(lambda a, b: _send(a, b, model, ranges, hot, limit), _SENT)
    )
    met = written(sent.groupBy("part").applyInArrow(lambda key, rows: _meet(key, rows, model, hot), _MET))
    statistics = met.where("n_r IS NOT NULL")
    small = statistics.agg(*n_r).first()
    ratio = discounts(list(small))
    weights = backoff_weights(statistics.where("size(split_h) > 0").select("split_h", "split_n", "split_p").toLocalIterator(), hot, ratio)
    parts = met.where("chunk IS NOT NULL").select("chunk", "sums", "classes", "open_doc", "open_n", "hot_doc", "hot_h", "doc_id", "held", "n_tokens", "n_known", "base")
    return parts.groupBy("chunk").applyInArrow(lambda key, rows: _score(key, rows, total, ratio, weights), _SCORED)
