"""Best-fit packing of tokenised documents by hierarchical residual packing.

Each task packs its pieces best-fit, longest first.  Bins that are nearly full are emitted;
the others go on as items of a smaller number of tasks, which pack them again, and so on up a
tree.  A task takes at most ``TASK_ITEMS`` items on average, so the tree stops merging when
what is left would not fit, and the last level emits all its bins.
"""

from __future__ import annotations

import json
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicpanel.lineage import written
from civicpanel.llm.words import text_slices

TASK_ITEMS = 200_000
FAN_IN = 8
#: A bin with this share of the capacity is emitted before the last level.
NEARLY_FULL = 0.98
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


@lru_cache(maxsize=2)
def encoder(path: str):
    """A function from a text to its token ids, an unsigned 32-bit array.

    The text of a special token of the file is that token, as in its library.

    A byte-level file whose merges stand in the order of their ids gives the same ids through
    the rank-based encoder, which is several times faster; any other file is used as it is.
    """
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    vocabulary = model.get("vocab") or {}
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model.get("merges") or []]
    ranks = [vocabulary.get("".join(m), -1) for m in merges]
    plain = (
        model.get("type") == "BPE"
        and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        and before.get("type") == "ByteLevel"
        and not before.get("add_prefix_space")
        and before.get("use_regex", True)
        and spec.get("normalizer") is None
        and ranks == sorted(set(ranks))
        and all(token.get("special") and not token.get("normalized") for token in spec.get("added_tokens") or [])
        and not any(token.get(k) for token in spec.get("added_tokens") or [] for k in ("lstrip", "rstrip", "single_word"))
    )
    if plain:
        import public_tokenizers
        import tiktoken

        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
        letters = {chr(b): b for b in shown}
        letters |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
        special = {token["content"]: token["id"] for token in spec.get("added_tokens") or []}
        bytes_of = {bytes(letters[c] for c in t): i for t, i in vocabulary.items() if t not in special}
        encoding = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bytes_of, special_tokens=special)
        return lambda text: encoding.encode_to_numpy(text, allowed_special="all")
    tokenizer = Tokenizer.from_file(path)
    return lambda text: np.array(tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)


def _pieces(batches: Iterator[pa.RecordBatch], path: str | None, capacity: int) -> Iterator[pa.RecordBatch]:
    import public_tokenizers

    encode = encoder(path or public_tokenizers.path("byte_bpe_50k.json"))
    for batch in batches:
        for a, b in text_slices(batch["text"]):
            rows, piece, start, length, crc = [], [], [], [], []
            for row, text in enumerate(batch["text"].slice(a, b - a).to_pylist()):
                ids = np.append(encode(text or ""), np.uint32(0)).astype("<u4")
                cuts = [0, *range((len(ids) - 1) % capacity + 1, len(ids) + 1, capacity)]
                for k, (x, y) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                    rows.append(a + row)
                    piece.append(k)
                    start.append(x)
                    length.append(y - x)
                    crc.append(zlib.crc32(ids[x:y].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32())]
                + [pa.array(x, pa.int64()) for x in (start, length, crc)],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )


def pieces(docs: DataFrame, path: str | None = None, capacity: int = 2048) -> DataFrame:
    """Token pieces of every document: all ids and one final id 0, at most ``capacity`` a piece.

    Only longer documents are cut; their first piece may be shorter than the others.
    """
    return docs.select("doc_id", "text").mapInArrow(partial(_pieces, path=path, capacity=capacity), PIECES)


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins of positions in ``sizes``: longest first, each into the fullest bin that takes it."""
    room: defaultdict[int, list[int]] = defaultdict(list)  # free tokens: bins
    free = 0  # bit r is set if some bin has r free tokens
    bins: list[list[int]] = []
    for at in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        size = sizes[at]
        fits = free >> size
        if fits:
            left = size + (fits & -fits).bit_length() - 1
            own = room[left].pop()
            if not room[left]:
                free ^= 1 << left
        else:
            left, own = capacity, len(bins)
            bins.append([])
        bins[own].append(at)
        left -= size
        room[left].append(own)
        free |= 1 << left
    return bins


def _level(batches: Iterator[pa.RecordBatch], capacity: int, enough: int, level: int) -> Iterator[pa.RecordBatch]:
    given = list(batches)
    if not given:
        return
    table = pa.Table.from_batches(given)
    fills, items, offsets = (table[c].to_pylist() for c in ("fill", "items", "offsets"))
    order = sorted(range(len(fills)), key=lambda i: items[i][0])  # not the order of arrival
    task = TaskContext.get().partitionId()
    out: dict[str, list] = {"sequence_id": [], "fill": [], "items": [], "offsets": []}
    for number, own in enumerate(best_fit([fills[i] for i in order], capacity)):
        at, all_items, all_offsets = 0, [], []
        for k in own:
            child = order[k]
            all_items += items[child]
            all_offsets += [at + x for x in offsets[child]]
            at += fills[child]
        out["sequence_id"].append((level << 52) + (task << 28) + number if at >= enough else None)
        for name, value in (("fill", at), ("items", all_items), ("offsets", all_offsets)):
            out[name].append(value)
    types = {"sequence_id": pa.int64(), "fill": pa.int32(), "items": pa.list_(pa.int64()), "offsets": pa.list_(pa.int32())}
    for a in range(0, len(out["fill"]), 10_000):
        yield pa.RecordBatch.from_arrays([pa.array(v[a : a + 10_000], types[k]) for k, v in out.items()], list(out))


def place(lengths: DataFrame, capacity: int = 2048) -> DataFrame:
    """(item, sequence_id, offset) for every row of ``lengths`` (item: unique, length)."""
    bins = lengths.select(
        F.col("length").cast("int").alias("fill"), F.array("item").alias("items"), F.array(F.lit(0)).alias("offsets")
    )
    left = bins.count()
    parts = max(1, -(-left // TASK_ITEMS))
    done = None
    for level in range(1, 64):
        last = parts == 1
        enough = 0 if last else int(NEARLY_FULL * capacity)
        packed = written(
            bins.repartition(parts, F.col("items")[0]).mapInArrow(
                partial(_level, capacity=capacity, enough=enough, level=level),
                "sequence_id bigint, fill int, items array<bigint>, offsets array<int>",
            )
        )
        full = packed.where("sequence_id IS NOT NULL")
        done = full if done is None else done.union(full)
        bins = packed.where("sequence_id IS NULL").drop("sequence_id")
        left = 0 if last else bins.count()
        if not left:
            break
        fewer = max(-(-parts // FAN_IN), -(-left // TASK_ITEMS))
        if fewer >= parts:  # what is left is too much to merge further
            done = done.union(bins.select(-1 - F.col("items")[0], "fill", "items", "offsets"))
            break
        parts = fewer
    spread = done.select("sequence_id", F.explode(F.arrays_zip("items", "offsets")).alias("x"))
    return spread.select(F.col("x.items").alias("item"), "sequence_id", F.col("x.offsets").cast("bigint").alias("offset"))


def pack(docs: DataFrame, path: str | None = None, capacity: int = 2048) -> DataFrame:
    """All pieces of ``docs`` (doc_id, text) with their sequence and their place in it.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset.  A null or empty text
    is the one id 0.  Repeated rows and null ids are packed as rows of their own; an empty
    table gives no rows; further columns are ignored.
    """
    numbered = written(pieces(docs, path, capacity).withColumn("item", F.monotonically_increasing_id()))
    places = place(numbered.select("item", "length"), capacity)
    return numbered.join(places, "item").drop("item")
