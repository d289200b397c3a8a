"""BPE encoding and decoding as streams with constant memory.

Encoding is a transducer over the byte symbols of one word.  For every prefix it knows the last
token of the prefix's encoding: the only token that ends there and is compatible with the last
token of the prefix before it.  Two tokens are compatible if no merge of the list would have
joined symbols across their border earlier; this is seen by undoing their own merges, latest
first.  Following last tokens backwards gives the whole encoding.

How much of it is final follows from the merge list.  Let two inputs share a prefix, and apply
the merges in order to both.  The border of the agreeing tokens moves left only when a merge
(u, v) joins the token u before the border with a v behind it in one input alone, at most once
for each merge, and by the length of u.  The v of the next such merge begins, in its own
derivation, with the u of the one before.  The largest sum of lengths over such chains with
rising ranks is the sufficient lookahead: a token that ends so many symbols before the place
read is part of every continuation and is emitted.

Text goes through in blocks that end before white space, or, where there is none, before a
character that no normalisation joins with what stands before it.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: Characters of a block of text.
BLOCK = 1 << 16
#: Words of at most so many bytes are kept at hand with their ids, and how many of them.
SHORT, AT_HAND = 64, 500_000

#: The one-character spelling of each byte in byte-level vocabularies.
_SHOWN = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
LETTERS = {b: chr(b) for b in _SHOWN} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _SHOWN)}
#: A common pattern of words, a fixed value.
CONTRACTIONS_FIRST = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Before such a character a text may be cut: it joins with nothing that stands before it.
_CUT = regex.compile(r"[\x00-\x7fÀ-ɏΑ-Ωα-ωА-яぁ-ゖァ-ヺ一-鿿가-힣]")


def simple_pattern(pattern: str):
    """The pattern for text below U+0308, where the classes are short, in the faster engine.

    Where the pattern's alternatives begin with different characters, their order does not matter.
    """
    if pattern != CONTRACTIONS_FIRST:
        return regex.compile(pattern.replace(r"\s", r"\p{White_Space}"))
    classes = {}
    for name in ("L", "N", "White_Space"):
        of = regex.compile(rf"\p{{{name}}}")
        classes[name] = "".join(re.escape(chr(c)) for c in range(0x308) if of.match(chr(c)))
    letters, numbers, space = classes.values()
    return re.compile(f"[{letters}]+|'(?:s|t|re|ve|m|ll|d)|[{numbers}]|[^{space}{letters}{numbers}]+")


class Merges:
    """The merge list of a BPE model, with what the transducer needs to know of it.

    Symbols are characters of a string; ``end`` is the symbol that marks the end of a word and
    is written as a part of the last symbol's token.  Every merge must come after those that
    make its two parts, and no two merges may make one token.
    """

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]]):
        made = {left + right: rank for rank, (left, right) in enumerate(merges)}
        for rank, (left, right) in enumerate(merges):
            if made[left + right] != rank or any(made.get(part, -1) >= rank for part in (left, right)):
                raise ValueError(f"merge {rank} of {left!r} and {right!r} is out of order")
            if not {left, right, left + right} <= vocabulary.keys():
                raise ValueError(f"merge {rank} of {left!r} and {right!r} has no id")
        self.rank = {vocabulary[t]: r for t, r in made.items()}
        self.parts = {vocabulary[a + b]: (vocabulary[a], vocabulary[b]) for a, b in merges}
        self.joined = {pair: self.rank[token] for token, pair in self.parts.items()}
        self.spelling = {i: t for t, i in vocabulary.items()}
        self._known: dict[int, bool] = {}
        own: dict[int, bool] = {}  # tokens that are the encoding of their own symbols
        for token, pair in self.parts.items():  # in the order of the merges
            own[token] = own.get(pair[0], True) and own.get(pair[1], True) and self._apart(*pair, self.rank[token])
        self.own = {i for i in self.spelling if own.get(i, True)}

    def _apart(self, left: int, right: int, limit: float = float("inf")) -> bool:
        """Whether merges below ``limit`` leave ``left`` and ``right`` side by side."""
        rank = self.rank
        while True:
            if self.joined.get((left, right), limit) < limit:
                return False
            a, b = rank.get(left, -1), rank.get(right, -1)
            if a < 0 and b < 0:
                return True
            if a > b:  # undo the later of the two; of equal merges the left one was first
                limit, left = min(limit, a), self.parts[left][1]
            else:
                limit, right = min(limit, b + 1), self.parts[right][0]

    def compatible(self, left: int, right: int) -> bool:
        key = left << 32 | right
        known = self._known.get(key)
        if known is None:
            if len(self._known) >= AT_HAND:
                self._known.clear()
            known = self._known[key] = self._apart(left, right)
        return known

    def lookahead(self, size: dict[int, int]) -> int:
        """The sufficient lookahead in symbols; ``size`` gives the symbols of a token."""
        best: dict[int, int] = {}
        most = 0
        for token, (left, right) in sorted(self.parts.items(), key=lambda x: -self.rank[x[0]]):
            chain = size[left] + best.get(left, 0)
            most = max(most, chain)
            head = right
            while True:
                best[head] = max(best.get(head, 0), chain)
                if head not in self.parts:
                    break
                head = self.parts[head][0]
        return most


class Transducer:
    """Encodes one word after another, symbol by symbol."""

    START = -1

    def __init__(self, merges: Merges, suffix: str):
        #: Stands for the suffix behind the last symbol of a word, as a part of that symbol.
        self.end = ""
        self.suffix = suffix
        whole = {i: t[: -len(suffix)] + self.end if suffix and t.endswith(suffix) else t for i, t in merges.spelling.items()}
        self.size = {i: len(t.rstrip(self.end)) for i, t in whole.items()}
        self.merges = merges
        self.token_of = {whole[i]: i for i in merges.own if self.size[i]}
        self.longest = max(map(len, self.token_of), default=1)
        self._ending: dict[str, set[int]] = {}  # lengths of the tokens that end so
        for token in self.token_of:
            self._ending.setdefault(token[-3:], set()).add(len(token))
        self._lengths: dict[str, list[int]] = {}
        self.lookahead = merges.lookahead(self.size)
        self._begin()

    def _begin(self) -> None:
        self.held = ""  # the symbol read last: it may turn out to end the word
        self.text = ""  # symbols that are not emitted, and those before them that a token may need
        self.last = [self.START]  # of every prefix of ``text``: its last token
        self.done = 0  # symbols of ``text`` that are emitted

    def _try(self, tail: str) -> list[int]:
        """Lengths that a token may have behind which the last three characters are ``tail``, longest first."""
        found = self._ending.get(tail, set()) | {len(tail) - k for k in range(len(tail)) if tail[k:] in self.token_of}
        if len(self._lengths) >= AT_HAND:
            self._lengths.clear()
        self._lengths[tail] = lengths = sorted(found, reverse=True)
        return lengths

    def _read(self, symbols: str, end: str = "") -> None:
        """Finds the last tokens of the prefixes that end with each of ``symbols``; ``end`` closes the last one."""
        token_of, last, lengths, known = self.token_of, self.last, self._lengths, self.merges._known
        self.text = text = self.text + symbols
        n = len(text)
        for at in range(len(last), n + 1):
            tail, extra = (text, 0) if at < n or not end else (text + end, 1)
            stop = at + extra
            key = tail[stop - 3 if stop > 3 else 0 : stop]
            for length in lengths.get(key) or self._try(key):
                start = stop - length
                if start < 0:
                    continue
                token = token_of.get(tail[start:stop])
                if token is not None:
                    before = last[start]
                    if before < 0:
                        last.append(token)
                        break
                    fits = known.get(before << 32 | token)
                    if fits or fits is None and self.merges.compatible(before, token):
                        last.append(token)
                        break
            else:
                raise ValueError(f"no token for the symbol {text[at - 1]!r}")

    def _back(self, until: int) -> list[int]:
        """Ids that are not emitted and end at ``until`` symbols or before, first to last."""
        found, at, last_end = [], len(self.text), None
        while at > self.done:
            token = self.last[at]
            if at <= until:
                found.append(token)
                last_end = last_end or at
            at -= self.size[token]
        self.done = last_end or self.done
        return found[::-1]

    def feed(self, symbols: str) -> list[int]:
        """Takes further symbols of a word; returns the ids that have become final."""
        symbols = self.held + symbols
        self.held, symbols = symbols[-1:], symbols[:-1]
        found: list[int] = []
        step = max(1, self.lookahead)
        for a in range(0, len(symbols), step):
            self._read(symbols[a : a + step])
            if len(self.text) - self.done > 2 * step:
                found += self._back(len(self.text) - self.lookahead)
                drop = self.done  # a token that reaches back beyond what is final cannot come
                self.text, self.last, self.done = self.text[drop:], self.last[drop:], 0
        return found

    def close(self) -> list[int]:
        """Ends the word; returns the rest of its ids."""
        if self.held:
            self._read(self.held, self.end if self.suffix else "")
        found = self._back(len(self.text))
        self._begin()
        return found


class Tokens:
    """Encoder and decoder of one tokenizer file.

    Takes files with a byte-level BPE model, special tokens that are matched in the raw text,
    and a pattern whose matches are the words: runs of letters, of other signs, or at most three
    characters.  Any other file is refused.
    """

    def __init__(self, path: str):
        from tokenizers import Regex, Tokenizer, pre_tokenizers

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, before = spec["model"], (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
        added = spec.get("added_tokens") or []
        refused = (
            model.get("type") != "BPE"
            or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "ignore_merges", "unk_token", "byte_fallback"))
            or [p["type"] for p in before] != ["Split", "ByteLevel"]
            or before[0]["behavior"] != "Removed" or not before[0]["invert"] or before[1]["use_regex"] or before[1]["add_prefix_space"]
            or any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized"))
            or (spec.get("decoder") or {"type": "ByteLevel"})["type"] != "ByteLevel"
            or any(n["type"] not in ("NFC", "Replace", "Lowercase") for n in (spec.get("normalizer") or {}).get("normalizers", []))
        )
        if refused:
            raise ValueError(f"not a tokenizer this transducer can run: {path}")
        vocabulary = model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.transducer = Transducer(Merges(vocabulary, merges), self.suffix)
        self.special = {t["content"]: t["id"] for t in added}
        by_length = sorted(self.special, key=len, reverse=True)
        self._special = regex.compile("(" + "|".join(map(regex.escape, by_length)) + ")") if by_length else None
        pattern = before[0]["pattern"]["Regex"]
        self._pattern = simple_pattern(pattern)
        self._split = pre_tokenizers.Split(Regex(pattern), "removed", invert=True)
        self._normalizer = Tokenizer.from_file(path).normalizer
        self._lower = any(n["type"] == "Lowercase" for n in (spec.get("normalizer") or {}).get("normalizers", []))
        self._ids: dict[str, list[int]] = {}
        spelling = {i: t for t, i in vocabulary.items()} | {i: t for t, i in self.special.items()}
        self.spelled = {i: t.encode() for i, t in spelling.items()}
        back = {c: b for b, c in LETTERS.items()}
        end = self.suffix if self.suffix else None
        self.raw = {}
        for i, t in spelling.items():
            ends = end is not None and t.endswith(end) and t not in self.special
            body = t[: -len(end)] if ends else t
            plain = bytes(back[c] for c in body) if t not in self.special else t.encode()
            self.raw[i] = plain + b" " if ends else plain
        self.joined = spec.get("decoder") is None

    def _prepared(self, block: str) -> tuple[str, bool]:
        """The normalised block, and whether its words can be found without the library's tables."""
        if block.isascii() or max(block) < "\u0300":  # composed already
            block = block.lower() if self._lower else block
            return block, block.isascii() or max(block) < "\u0308"
        return (self._normalizer.normalize_str(block) if self._normalizer else block), False

    def _words(self, block: str, simple: bool) -> list[str]:
        if simple:
            return self._pattern.findall(block)
        return [w for w, _ in self._split.pre_tokenize_str(block)]

    def _symbols(self, word: str) -> str:
        return word.encode().decode("latin-1").translate(LETTERS)

    def _word(self, word: str) -> list[int]:
        ids = self._ids.get(word)
        if ids is None:
            run = self.transducer
            ids = run.feed(self._symbols(word))
            ids += run.close()
            if len(word) <= SHORT:
                if len(self._ids) >= AT_HAND:
                    self._ids.clear()
                self._ids[word] = ids
        return ids

    def _part(self, text: str) -> Iterator[list[int]]:
        """Ids of a text without special tokens, block by block."""
        at, inside = 0, ""  # ``inside``: a sign of the kind of the run that goes on in the next block
        run = self.transducer
        while at < len(text):
            end, open_end = min(len(text), at + BLOCK), False
            if end < len(text):
                cut = max(text.rfind(" ", at + 1, end), text.rfind("\n", at + 1, end))
                if cut < 0:
                    open_end = True
                    found = _CUT.search(text, end)
                    # Three characters after an apostrophe may be one word.
                    while found and "'" in text[found.start() - 3 : found.start() + 1]:
                        found = _CUT.search(text, found.start() + 1)
                    end = found.start() if found else len(text)
                    open_end = end < len(text)
                else:
                    end = cut
            block, simple = self._prepared(text[at:end])
            at = end
            if not inside and not open_end:
                ids: list[int] = []
                for word in self._words(block, simple):
                    own = self._ids.get(word)
                    ids += own if own is not None else self._word(word)
                yield ids
                continue
            words = self._words(inside + block, simple)
            if inside:  # the first word goes on from the block before
                first = words.pop(0)[len(inside) :]
                yield run.feed(self._symbols(first))
                if words or not open_end or not block.endswith(first):
                    yield run.close()
                    inside = ""
                else:
                    continue
            last = words.pop() if words and open_end and block.endswith(words[-1]) else None
            for word in words:
                yield list(self._word(word))
            if last is not None:
                if self._words(last + "a", simple) == [last + "a"]:
                    inside = "a"
                elif self._words(last + "-", simple) == [last + "-"]:
                    inside = "-"
                yield run.feed(self._symbols(last))
                if not inside:
                    yield run.close()
        if inside:
            yield run.close()

    def encode(self, text: str | None) -> Iterator[list[int]]:
        """Lists of ids, as they become final; a null text has none."""
        for part in self._special.split(text or "") if self._special else [text or ""]:
            if part in self.special:
                yield [self.special[part]]
            elif part:
                yield from self._part(part)

    def decoder(self, readable: bool = False) -> Decoder:
        """``readable`` gives text with a space after each word, else what the library gives."""
        return Decoder(self.raw, b"") if readable or not self.joined else Decoder(self.spelled, b" ")


class Decoder:
    """Turns ids into text piece by piece; bytes of an open character wait for the rest."""

    def __init__(self, pieces: dict[int, bytes], between: bytes):
        self._pieces, self._between, self._first = pieces, between, True
        self._text = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: list[int]) -> str:
        if not ids:
            return ""
        data = self._between.join(map(self._pieces.__getitem__, ids))
        if not self._first:
            data = self._between + data
        self._first = False
        return self._text.decode(data)

    def close(self) -> str:
        return self._text.decode(b"", True)


@lru_cache(maxsize=2)
def tokens(path: str) -> Tokens:
    return Tokens(path)


def _tokenised(batches: Iterator[pa.RecordBatch], path: str | None) -> Iterator[pa.RecordBatch]:
    import public_tokenizers

    own = tokens(path or public_tokenizers.path("word_bpe_49k.json"))
    for batch in batches:
        counts, id_sums, text_sums = [], [], []
        for text in batch["text"]:
            n, of_ids, of_text, decoder = 0, hashlib.sha256(), hashlib.sha256(), own.decoder()
            for ids in own.encode(text.as_py()):
                n += len(ids)
                of_ids.update(np.array(ids, "<u4").tobytes())
                of_text.update(decoder.feed(ids).encode())
            of_text.update(decoder.close().encode())
            counts.append(n)
            id_sums.append(of_ids.hexdigest())
            text_sums.append(of_text.hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array(counts, pa.int64()), pa.array(id_sums, pa.string()), pa.array(text_sums, pa.string())],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )


def token_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The number of tokens of every row of ``docs`` (doc_id, text), and digests of ids and decoded text.

    ``path`` names a tokenizer file on the workers.  Returns doc_id, n_tokens, ids_sha256 (of the
    ids as little-endian unsigned 32-bit integers) and decoded_sha256 (of the decoded text in
    UTF-8).  Null and empty texts have no tokens and the digests of nothing.  Ids may be null or
    repeat: rows are encoded one by one.  An empty table gives no rows; further columns are
    ignored.  Memory does not grow with a text beyond the text itself.
    """
    return docs.select("doc_id", "text").mapInArrow(
        partial(_tokenised, path=path), "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )


def _ids(batches: Iterator[pa.RecordBatch], path: str | None) -> Iterator[pa.RecordBatch]:
    import public_tokenizers

    own = tokens(path or public_tokenizers.path("word_bpe_49k.json"))
    for batch in batches:
        for a in range(0, batch.num_rows, 256):
            part = batch.slice(a, 256)
            ids = [[i for block in own.encode(t) for i in block] for t in part["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"], pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"]
            )


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids) for every row of ``docs`` (doc_id, text)."""
    return docs.select("doc_id", "text").mapInArrow(partial(_ids, path=path), "doc_id bigint, ids array<int>")


def _texts(batches: Iterator[pa.RecordBatch], path: str | None, readable: bool) -> Iterator[pa.RecordBatch]:
    import public_tokenizers

    own = tokens(path or public_tokenizers.path("word_bpe_49k.json"))
    for batch in batches:
        texts = []
        for ids in batch["ids"].to_pylist():
            decoder = own.decoder(readable)
            texts.append(decoder.feed(ids or []) + decoder.close())
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(texts, pa.string())], ["doc_id", "text"])


def decode(encoded: DataFrame, path: str | None = None, readable: bool = False) -> DataFrame:
    """(doc_id, text) for every row of ``encoded`` (doc_id, ids); null ids give an empty text."""
    return encoded.select("doc_id", "ids").mapInArrow(
        partial(_texts, path=path, readable=readable), "doc_id bigint, text string"
    )
