"""Substring deduplication: MinHash banding over overlapping blocks and over real paragraphs.

Two kinds of paragraphs are compared across documents:

* blocks: every run of ``LEAST_WORDS`` words, wherever it stands.  The band key of a block is the
  smallest hash of its 5-word shingles, so equal blocks always meet, and neighbouring blocks
  have the key, and thus the one row, in common (an *anchor*).  Anchors whose key several
  documents have are verified: if the words around all of them are equal, for as far as any
  block with that key can reach, they are settled; if not, all blocks around those that
  another document agrees with to one side at least are compared in whole, by 128 bits of hash.
  Equal blocks that go on in step are put together to passages of full length;
* lines, and blocks of lines between blank ones, of ``LEAST_WORDS`` words or more: ``BANDS`` bands
  of ``ROWS`` minima each, which 997 of 1,000 pairs with a similarity of 0.8 share, bring
  candidates together.  Exact Jaccard similarity of their 5-word shingles verifies them, as in
  ``near_dedup``, and connected components cluster them.

The first of each group, by document and place, is kept.  Repeats are removed where they are
not the first.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial
from tempfile import TemporaryFile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civicpanel.lineage import Scratch, written
from civicpanel.llm.near_dedup import SKETCH, link_lists, parities
from civicpanel.llm.tables import free_names
from civicpanel.llm.words import Words, find_words, mix, sliding, text_slices, word_spans

WIDTH = 5
LEAST_WORDS = 15
PERCENT = 80
ROWS, BANDS = 3, 8
#: Keys are in so many parts, by their hash; blocks around anchors of one part are compared.
PASSES = 2
#: Bytes of text handled at once, and for each task that compares hashes.
SLICE_BYTES, PART_BYTES = 1 << 20, 16 << 20
#: How many words to either side a block with an anchor can reach, and one more.
BEFORE, BEHIND = LEAST_WORDS - WIDTH + 1, LEAST_WORDS + 1
SIDE = (LEAST_WORDS - WIDTH) // 2


def anchors(words: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words at which the smallest shingle of some block begins, and the hash of that shingle."""
    wide = LEAST_WORDS - WIDTH + 1
    if len(hashes) < LEAST_WORDS:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.arange(len(hashes) - WIDTH + 1)
    grams = word_spans(hashes, at, at + WIDTH)
    least = sliding(np.minimum, grams, wide)
    ends = np.repeat(words.first[1:], words.counts)[: len(least)]
    least[np.arange(len(least)) + LEAST_WORDS > ends] = 0  # the block would run into the next text
    padded = np.concatenate([np.zeros(wide - 1, np.uint64), least, np.zeros(wide - 1, np.uint64)])
    found = np.flatnonzero((sliding(np.maximum, padded, wide)[: len(grams)] == grams) & (grams > 0))
    return found, grams[found]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch, Words, np.ndarray]]:
    """Neighbouring texts under a number of their own, with their words and the hashes of these."""
    for batch in batches:
        for a, b in text_slices(batch["text"], SLICE_BYTES):
            own = batch.slice(a, b - a)
            words = find_words(own["text"])
            # Made of the first row, so that a task that runs again gives the same number.
            first = np.array([own[c][0].as_py() for c in ("doc_id", "text_key")], np.int64).view(np.uint64)
            yield int(mix(first[:1] ^ mix(first[1:])).view(np.int64)[0]), own, words, words.hashes(lower=True)


def _dealt(number: int, columns: list[np.ndarray], parts: int) -> pa.RecordBatch:
    """The entries of one slice, packed column by column, dealt out by the hashes in the first column."""
    entries = np.stack([np.asarray(c).astype(np.int64) for c in columns])
    part = (entries[0].view(np.uint64) >> np.uint64(32)) % np.uint64(parts)
    order = np.argsort(part, kind="stable")
    used, cut = np.unique(part[order], return_index=True)
    data = [entries[:, rows].tobytes() for rows in np.split(order, cut[1:])] if len(used) else []
    return pa.RecordBatch.from_arrays(
        [pa.array(used.astype(np.int32)), pa.array(np.full(len(used), number)), pa.array(data, pa.binary())], ["part", "slice", "data"]
    )


_DEALT = "part int, slice bigint, data binary"


def _stacked(rows: pa.Table | pa.RecordBatch, width: int) -> np.ndarray:
    """All entries of ``width`` numbers that the rows hold."""
    packed = [np.frombuffer(d, np.int64).reshape(width, -1) for d in rows["data"].to_pylist()]
    return np.concatenate([np.zeros((width, 0), np.int64), *packed], 1)


def _ids(own: pa.RecordBatch, text: np.ndarray) -> list[np.ndarray]:
    return [np.asarray(own[c], np.int64)[text] for c in ("doc_id", "text_key")]


def _anchored(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """The anchors with hashes of the words around them."""
    for number, own, words, hashes in _slices(batches):
        at, keys = anchors(words, hashes)
        text = np.searchsorted(words.first, at, side="right") - 1
        low, high = words.first[text], words.first[text + 1]
        begin, end = np.maximum(low, at - BEFORE), np.minimum(high, at + BEHIND)
        reach = ((at - begin) << 8 | (end - at)).astype(np.uint64)
        whole = mix(word_spans(hashes, begin, end, 1) ^ mix(reach + np.uint64(1)))
        left = np.where(at - SIDE >= low, word_spans(hashes, np.maximum(at - SIDE, 0), at + WIDTH, 2), 0)
        stop = np.minimum(at + WIDTH + SIDE, len(hashes))
        right = np.where(at + WIDTH + SIDE <= high, word_spans(hashes, at, stop, 3), 0)
        doc, key = _ids(own, text)
        yield _dealt(number, [keys, whole, doc, begin - low, key, (at - begin) << 8 | (end - begin), left, right], parts)


def _sided(rows: pa.Table, parts: int) -> pa.Table:
    """The hashes of the words to either side of the anchors of a slice."""
    doc, key, at, *sides = _stacked(rows, 5)
    side, doc, key, at = np.concatenate(sides), *(np.tile(v, 2) for v in (doc, key, at))
    there = side != 0
    zero = np.zeros(there.sum(), np.int64)
    return pa.Table.from_batches([_dealt(rows["slice"][0].as_py(), [side[there], zero, doc[there], at[there], key[there]], parts)])


def _blocks(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """All blocks around the places ``ats`` of each text, for each part of the keys, by two hashes of their words."""
    for number, own, words, hashes in _slices(batches):
        counts = np.asarray(own["ats"].value_lengths(), np.int64)
        text = np.repeat(np.arange(len(counts)), counts)
        at, part = np.divmod(np.asarray(own["ats"].flatten(), np.int64), PASSES)
        reach = np.arange(LEAST_WORDS - WIDTH + 1)
        starts = ((at + words.first[text])[:, None] - reach).ravel()
        text, part = np.repeat(text, len(reach)), np.repeat(part, len(reach))
        fits = (starts >= words.first[text]) & (starts + LEAST_WORDS <= words.first[text + 1])
        starts, first = np.unique(starts[fits] * PASSES + part[fits], return_index=True)
        text = text[fits][first]
        starts, part = np.divmod(starts, PASSES)
        key, check = (word_spans(hashes, starts, starts + LEAST_WORDS, s) for s in (4, 5))
        check ^= part.astype(np.uint64)  # keeps the parts apart
        doc, text_key = _ids(own, text)
        yield _dealt(number, [key, check, doc, starts - words.first[text], text_key], parts)


def _least(groups: np.ndarray) -> np.ndarray:
    """One column for each value and check: first place, greatest document, and the range of the marks."""
    order = np.lexsort(groups[4::-1])
    value, check = groups[0][order], groups[1][order]
    begins = np.flatnonzero(np.concatenate([[True], (value[1:] != value[:-1]) | (check[1:] != check[:-1])])[: len(order)])
    least = groups[:, order[begins]]
    if len(begins):
        for row, best in ((5, np.maximum), (6, np.minimum), (7, np.maximum)):
            least[row] = best.reduceat(groups[row][order], begins)
    return least


def _shared(batches: Iterator[pa.RecordBatch], width: int, pairs: bool, answer: Callable) -> Iterator[pa.RecordBatch]:
    """What ``answer`` makes of the entries whose value (with ``pairs``: and check) two documents have.

    Entries have ``width`` numbers: value, check, doc_id, start, text_key, and more.  They are
    kept in a file until all groups are known, so that only one place for each group is held.
    """
    groups, numbers = np.zeros((8, 0), np.int64), []
    with TemporaryFile() as held:
        for batch in batches:
            for number, data in zip(batch["slice"].to_pylist(), batch["data"].to_pylist(), strict=True):
                numbers.append((number, held.write(data)))
            value, check, doc, start, key = _stacked(batch, width)[:5]
            own = check if pairs else np.zeros_like(check)
            groups = _least(np.concatenate([groups, np.stack([value, own, doc, start, key, doc, check, check])], 1))
        groups = groups[:, groups[5] != groups[2]]
        held.seek(0)
        ready: list[tuple[int, bool, bytes]] = []
        waiting = 0
        for last, (number, size) in enumerate(numbers, 1 - len(numbers)):
            entries = np.frombuffer(held.read(size), np.int64).reshape(width, -1)
            at = np.searchsorted(groups[0], entries[0])
            own = entries[1] if pairs else np.zeros_like(entries[1])
            while True:  # values that are equal by chance
                here = np.flatnonzero(at < groups.shape[1])
                here = here[groups[0][at[here]] == entries[0][here]]
                other = here[groups[1][at[here]] != own[here]]
                if not len(other):
                    break
                at[other] += 1
            ready += [(number, kind, found.tobytes()) for kind, found in answer(entries[:, here], groups[:, at[here]]) if found.shape[1]]
            waiting += 8 * width * len(here)
            if ready and (not last or waiting >= SLICE_BYTES):
                names = [("slice", pa.int64()), ("settled", pa.bool_()), ("data", pa.binary())]
                yield pa.RecordBatch.from_arrays([pa.array(c, k[1]) for c, k in zip(zip(*ready), names, strict=True)], [k[0] for k in names])
                ready, waiting = [], 0


def _anchor_answer(entries: np.ndarray, groups: np.ndarray) -> list[tuple[bool, np.ndarray]]:
    """Settled anchors as pieces beside their first places; of others the places, with the part of the key, and sides."""
    settled = groups[6] == groups[7]
    _, _, doc, start, key, reach, before, behind = entries
    pieces = np.stack([doc, key, start, reach & 255, *groups[2:5]])
    part = (entries[0].view(np.uint64) >> np.uint64(32)) % np.uint64(PASSES)
    rest = np.stack([doc, key, (start + (reach >> 8)) * PASSES + part.astype(np.int64), before, behind])
    return [(True, pieces[:, settled]), (False, rest[:, ~settled])]


def _side_answer(entries: np.ndarray, groups: np.ndarray) -> list[tuple[bool, np.ndarray]]:
    return [(False, entries[[2, 4, 3]])]


def _block_answer(entries: np.ndarray, groups: np.ndarray) -> list[tuple[bool, np.ndarray]]:
    n_words = np.full(entries.shape[1], LEAST_WORDS)
    return [(True, np.stack([entries[2], entries[4], entries[3], n_words, *groups[2:5]]))]


def _paired(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """Band keys of paragraphs, with the paragraphs in the place of documents."""
    for batch in batches:
        node = np.repeat(np.asarray(batch["node"], np.int64), BANDS)
        zero = np.zeros_like(node)
        yield _dealt(0, [np.asarray(batch["keys"].flatten(), np.int64), zero, node, zero, zero], parts)


def _pair_answer(entries: np.ndarray, groups: np.ndarray) -> list[tuple[bool, np.ndarray]]:
    return [(True, entries[[0, 2]])]


def _unpacked(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in _stacked(batch, len(names))], names)


def _gathered(rows: pa.Table) -> pa.Table:
    """The distinct places of each text of a slice."""
    doc, key, at = found = _stacked(rows, 3)
    doc, key, at = found[:, np.lexsort([at, key, doc])]
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (key[1:] != key[:-1]) | (at[1:] != at[:-1])])
    doc, key, at = doc[new], key[new], at[new]
    begins = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])]))
    offsets = np.append(begins, len(at)).astype(np.int32)
    ats = pa.ListArray.from_arrays(pa.array(offsets), pa.array(at.astype(np.int32)))
    return pa.table([pa.array(doc[begins]), pa.array(key[begins]), ats], ["doc_id", "text_key", "ats"])


def _joined(rows: pa.Table) -> pa.Table:
    """The pieces of a slice, those put together that touch and whose first places are in step with them."""
    doc, key, start, n_words, first_doc, first_start, first_key = _stacked(rows, 7)
    run = np.stack([doc, key, first_doc, first_key, first_start - start])
    order = np.lexsort([start, *run])
    run, start, end = run[:, order], start[order], (start + n_words)[order]
    other = np.concatenate([[True], (run[:, 1:] != run[:, :-1]).any(0)])
    far = np.cumsum(other) << 32  # ends of one run are below those of the next
    reached = np.maximum.accumulate(end + far) - far
    begins = np.flatnonzero(other | np.concatenate([[True], start[1:] > reached[:-1]]))
    doc, key, first_doc, first_key, shift = run[:, begins]
    start, end = start[begins], np.maximum.reduceat(end, begins)
    columns = [doc, key, start, end - start, first_doc, start + shift, first_key]
    return pa.table([pa.array(c.astype(k)) for c, k in zip(columns, _PIECE_KINDS, strict=True)], _PIECE)


_PIECE = ["doc_id", "text_key", "start", "n_words", "component_id", "component_start", "component_key"]
_PIECE_KINDS = [np.int64, np.int64, np.int32, np.int32, np.int64, np.int32, np.int64]
_PIECES = "doc_id bigint, text_key bigint, start int, n_words int, component_id bigint, component_start int, component_key bigint"


def _placed(rows: DataFrame, firsts: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` beside the first place of their group."""
    return rows.join(firsts, keys).select(
        "doc_id", "text_key", "start", "n_words",
        F.col("first.doc_id").alias("component_id"), F.col("first.start").alias("component_start"),
        F.col("first.text_key").alias("component_key"),
    )


_FOUND = ["doc_id", "text_key", "start", "n_words", "component_id", "component_start", "removed"]


def _first():
    return F.min(F.struct("doc_id", "start", "text_key")).alias("first")


def _asked(dealt: DataFrame, width: int, parts: int, answer: Callable, pairs: bool = False) -> DataFrame:
    """The answers (slice, settled, data) to dealt entries; equal values meet in one task."""
    dealt = dealt.repartitionById(parts, "part")
    return dealt.mapInArrow(partial(_shared, width=width, pairs=pairs, answer=answer), "slice bigint, settled boolean, data binary")


def _parts(docs: DataFrame) -> int:
    return 1 + (docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // PART_BYTES


def _passages(docs: DataFrame, parts: int, scratch: Scratch) -> DataFrame:
    """Passages of equal blocks at their full length."""
    found = scratch.written(_asked(docs.mapInArrow(partial(_anchored, parts=parts), _DEALT), 8, parts, _anchor_answer))
    settled = scratch.written(found.where("settled").groupBy("slice").applyInArrow(_joined, _PIECES))
    sides = found.where("NOT settled").groupBy("slice").applyInArrow(lambda rows: _sided(rows, parts), _DEALT)
    around = _asked(sides, 5, parts, _side_answer).groupBy("slice").applyInArrow(_gathered, "doc_id bigint, text_key bigint, ats array<int>")
    around = scratch.written(around.dropDuplicates(["doc_id", "text_key"]))
    scratch.drop(found)
    own = around.select(F.col("doc_id").alias("own_id"), F.col("text_key").alias("own_key"), "ats")
    texts = docs.join(own, F.expr("text_key = own_key AND doc_id = own_id")).select("doc_id", "text_key", "text", "ats")
    equal = _asked(texts.mapInArrow(partial(_blocks, parts=parts), _DEALT), 5, parts, _block_answer, pairs=True)
    equal = scratch.written(equal.groupBy("slice").applyInArrow(_joined, _PIECES))
    scratch.drop(around)
    return _in_step(settled.union(equal))


def _in_step(rows: DataFrame) -> DataFrame:
    """Puts pieces together that touch, and whose first places are in step with them."""
    rows = rows.withColumn("shift", F.col("component_start") - F.col("start"))
    run = ["doc_id", "text_key", "component_id", "component_key", "shift"]
    order = Window.partitionBy(*run).orderBy("start")
    reached = F.max(F.col("start") + F.col("n_words")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("new", F.when(F.col("start") <= reached, 0).otherwise(1))
    rows = rows.withColumn("number", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    rows = rows.groupBy(*run, "number").agg(F.min("start").alias("start"), F.max(F.col("start") + F.col("n_words")).alias("end"))
    rows = rows.withColumn("component_start", F.col("start") + F.col("shift"))
    return _told(rows.withColumn("n_words", F.col("end") - F.col("start")))


def _told(rows: DataFrame) -> DataFrame:
    here, first = F.struct("doc_id", "start", "text_key"), F.struct("component_id", "component_start", "component_key")
    return rows.withColumn("removed", here != first).select(*_FOUND, "component_key")


def paragraphs(text: str) -> list[tuple[int, int]]:
    """(first word, words) of the lines of a text and of its blocks of several lines between blank ones."""
    found, at, block, lines = [], 0, 0, 0
    for line in [*text.encode().split(b"\n"), b""]:
        n = len(line.split())
        if n:
            found.append((at, n))
            lines += 1
        else:
            if lines > 1:
                found.append((block, at - block))
            lines = 0
        at += n
        if not lines:
            block = at
    return [p for p in found if p[1] >= LEAST_WORDS]


def _spans(words: Words, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of each span, and where those of each span begin.

    A span of at least ``WIDTH`` words has a shingle for each word but the last four.
    """
    counts = ends - starts - WIDTH + 1
    cut = np.concatenate([[0], np.cumsum(counts)])
    at = np.repeat(starts - cut[:-1], counts) + np.arange(cut[-1])
    return word_spans(hashes, at, at + WIDTH), cut


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The real paragraphs of every text with their band keys; ``node`` tells different ones apart."""
    # The hashes of shingles are random, so an odd factor gives each minimum an order of its own.
    factors = [mix(np.array([k + 1], np.uint64)) | np.uint64(1) for k in range(ROWS * BANDS)]
    for batch in batches:
        for a, b in text_slices(batch["text"], SLICE_BYTES):
            own = batch.slice(a, b - a)
            words = find_words(own["text"])
            hashes = words.hashes(lower=True)
            given = [(i, *p) for i, t in enumerate(own["text"].to_pylist()) if t for p in paragraphs(t)]
            if not given:
                continue
            text, start, n = (np.array(c, np.int64) for c in zip(*given, strict=True))
            starts = start + words.first[text]
            node = word_spans(hashes, starts, starts + n, 6)
            grams, cut = _spans(words, hashes, starts, starts + n)
            keys = []
            for band in range(BANDS):
                key = np.full(len(n), mix(np.array([band], np.uint64))[0])
                for factor in factors[band * ROWS : (band + 1) * ROWS]:
                    key = mix(key ^ np.minimum.reduceat(grams * factor, cut[:-1]))
                keys.append(key)
            flat = pa.array(np.stack(keys, 1).ravel().view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(node.view(np.int64)),
                    *(own[c].take(pa.array(text)) for c in ("doc_id", "text_key")),
                    *(pa.array(v.astype(np.int32)) for v in (start, n)),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * BANDS), flat),
                ],
                ["node", "doc_id", "text_key", "start", "n_words", "keys"],
            )


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Text, sketch and parities of the paragraphs ``spans`` (node, start, n_words) of each text."""
    for batch in batches:
        for a, b in text_slices(batch["text"], SLICE_BYTES):
            own = batch.slice(a, b - a)
            words = find_words(own["text"])
            hashes = words.hashes(lower=True)
            spans, counts = own["spans"].flatten(), np.asarray(own["spans"].value_lengths(), np.int64)
            node, start, n = (spans.field(k) for k in range(3))
            begin = np.asarray(start, np.int64) + np.repeat(words.first[:-1], counts)
            end = begin + np.asarray(n, np.int64)
            grams, cut = _spans(words, hashes, begin, end)
            sets = [np.unique(grams[x:y]) for x, y in zip(cut[:-1], cut[1:], strict=True)]
            data = words.data.tobytes()
            texts = [data[x:y].decode() for x, y in zip(words.starts[begin], words.ends[end - 1], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    node,
                    pa.array(texts, pa.string()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([s[:SKETCH].view(np.int64) for s in sets], pa.list_(pa.int64())),
                    pa.array([parities(s) for s in sets], pa.list_(pa.int64())),
                ],
                ["node", "text", "n_shingles", "sketch", "bits"],
            )


def _near_paragraphs(docs: DataFrame, parts: int, scratch: Scratch) -> DataFrame:
    """Lines and blocks of lines that are near copies of others, of other documents."""
    rows = scratch.written(
        docs.mapInArrow(_banded, "node bigint, doc_id bigint, text_key bigint, start int, n_words int, keys array<bigint>")
    )
    listed = rows.select("node", "keys").mapInArrow(partial(_paired, parts=parts), _DEALT)
    listed = _asked(listed, 5, parts, _pair_answer).select("data")
    listed = listed.mapInArrow(partial(_unpacked, names=["value", "node"]), "value bigint, node bigint")
    listed = scratch.written(listed.distinct())
    place = F.struct("doc_id", "text_key", "start", "n_words")
    one = rows.join(listed.select("node").distinct(), "node", "left_semi").groupBy("node").agg(F.min(place).alias("p"))
    one = one.groupBy(F.col("p.doc_id").alias("own_id"), F.col("p.text_key").alias("own_key")).agg(
        F.collect_list(F.struct("node", "p.start", "p.n_words")).alias("spans")
    )
    one = scratch.written(one)
    texts = docs.join(one, F.expr("text_key = own_key AND doc_id = own_id"))
    kind = "node bigint, text string, n_shingles bigint, sketch array<bigint>, bits array<bigint>"
    marked = scratch.written(texts.select("text", "spans").mapInArrow(_signed, kind).dropDuplicates(["node"]))
    scratch.drop(one)
    found = link_lists(listed, marked, marked.select("node", "text"), WIDTH, PERCENT, scratch)
    scratch.drop(listed, marked)
    every, rows = rows, scratch.written(rows.drop("keys").join(found, "node"))
    scratch.drop(every, found)
    firsts = rows.groupBy("root").agg(_first(), F.max("doc_id").alias("high_id")).where("first.doc_id <> high_id")
    return _told(_placed(rows, firsts.drop("high_id"), ["root"]))


def repeated_paragraphs(docs: DataFrame) -> DataFrame:
    """A row for every passage and near paragraph of ``docs`` (doc_id, text) that repeats across documents.

    Returns doc_id, text_key (a hash of the whole text), start and n_words (in words of the
    text), component_id and component_start (the document and word of the one that is
    kept), and removed.  Rows of the two kinds may overlap.  Repeats inside one document are
    left alone.  Null and empty texts and documents with a null id have no rows; repeated rows
    count as one document; an empty table gives no rows; further columns are ignored.
    """
    return _repeated(docs, written)


def _repeated(docs: DataFrame, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key")).where("doc_id IS NOT NULL AND text IS NOT NULL")
    parts = _parts(docs)
    with Scratch(docs.sparkSession) as scratch:
        passages = keep(_passages(docs, parts, scratch).select(*_FOUND))
    with Scratch(docs.sparkSession) as scratch:
        near = keep(_near_paragraphs(docs, parts, scratch).select(*_FOUND))
    return passages.union(near).distinct()


def _without(batches: Iterator[pa.RecordBatch], text: str, spans: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, given = batch[text].to_pylist(), batch[spans].to_pylist()
        for i, own in enumerate(given):
            if own:
                words = find_words(pa.array([texts[i]], pa.large_string()))
                keep = np.ones(len(words.data), bool)
                for span in own:
                    last = span["start"] + span["n_words"]
                    end = words.starts[last] if last < len(words.starts) else len(words.data)
                    keep[words.starts[span["start"]] : end] = False
                texts[i] = words.data[keep].tobytes().decode()
        names = [c for c in batch.schema.names if c != spans]
        yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if c == text else batch[c] for c in names], names)


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the removed paragraphs cut out of the texts; all other columns and rows stay.

    Rows with one id and different texts lose what repeats in each of them; null texts stay.
    """
    own_id, own_key, spans = free_names(docs, "own_id", "own_key", "removed_spans")
    with Scratch(docs.sparkSession) as scratch:
        gone = _repeated(docs, scratch.written).where("removed").groupBy(F.col("doc_id").alias(own_id), F.col("text_key").alias(own_key))
        gone = written(gone.agg(F.collect_list(F.struct("start", "n_words")).alias(spans)))
    rows = docs.join(gone, (F.col("doc_id") == F.col(own_id)) & (F.xxhash64("text") == F.col(own_key)), "left")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return rows.drop(own_id, own_key).mapInArrow(partial(_without, text="text", spans=spans), fields)
