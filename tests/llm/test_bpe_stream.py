"""The streaming encoder against the library, and its lookahead against plain merging."""

import hashlib
import itertools
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from civicpanel.llm import bpe_stream
from tests.llm.conftest import same

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "a" * 5000, "in" * 3000, "x" * 700 + "'s" * 300, "é" * 1000, "漢" * 900, "ananan" * 500 + " b", "-'" * 400, '"' * 1000,
    "<|endoftext|>" * 3 + "hi<|endoftext|", "don't we'll İSTANBUL ΣΑΣ ﬁ é 각 🙂🙂", "½²Ⅳ 12 345", "\x00\x1c\x85​﻿",
    "\n\t ", "'", "a'", "Q̣̇ q̣̇", "́start", " <|startoftext|> a",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    return bpe_stream.Tokens(PATH)


def ids_of(own, text):
    return [i for block in own.encode(text) for i in block]


@pytest.mark.parametrize("block", [1 << 16, 50, 7])
def test_ids_and_text_are_those_of_the_library(own, library, monkeypatch, block):
    monkeypatch.setattr(bpe_stream, "BLOCK", block)
    rng = random.Random(block)
    alphabets = ["abc", "the quick in an re", "don't we'll ", "aàéüßÿ ", "ab'strevmld -'", "0123 a.", "αβγΣ é", "漢字かなカ가각 ", "xX!?'\"- \n\t", "thinganre"]
    texts = ["".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.choice([3, 30, 200]))) for _ in range(600)]
    texts += ["".join(rng.choice(a) for _ in range(n)) for a in alphabets for n in (5, 50, 500)]
    for text in texts + ODD:
        want = library.encode(text, add_special_tokens=False).ids
        assert ids_of(own, text) == want, text[:60]
        decoder = own.decoder()
        cut = rng.randint(1, 9)
        parts = [decoder.feed(want[k : k + cut]) for k in range(0, len(want), cut)]
        assert "".join(parts) + decoder.close() == library.decode(want, skip_special_tokens=False)


def test_every_character_between_letters(own, library):
    for code in itertools.chain(range(1, 0x3000), range(0xA000, 0xD800, 7), range(0xE000, 0x1FFFF, 5)):
        text = f"A{chr(code)}b {chr(code)}"
        assert ids_of(own, text) == library.encode(text, add_special_tokens=False).ids, hex(code)


def merged(text, merges):
    """Plain merging: every merge in turn, over the whole text, from the left."""
    parts = list(text)
    for left, right in merges:
        k = 0
        while k + 1 < len(parts):
            if parts[k] == left and parts[k + 1] == right:
                parts[k : k + 2] = [left + right]
            k += 1
    return parts


def test_lookahead_and_tokens_of_random_merge_lists():
    """Whatever follows, tokens that end a lookahead before the end of a prefix stay; memory stays bounded."""
    rng = random.Random(4)
    for _ in range(60):
        tokens, merges = list("abc"), []
        while len(merges) < 25:
            pair = (rng.choice(tokens), rng.choice(tokens))
            if len(pair[0] + pair[1]) <= 6 and pair[0] + pair[1] not in tokens:
                merges.append(pair)
                tokens.append(pair[0] + pair[1])
        run = bpe_stream.Transducer(bpe_stream.Merges({t: i for i, t in enumerate(tokens)}, merges), "")
        for _ in range(15):
            text = "".join(rng.choice("abc") for _ in range(rng.choice([4, 20, 150])))
            whole, at = merged(text, merges), len(text) // 2
            ends = list(itertools.accumulate(map(len, merged(text[:at], merges))))
            stable = [e for e in ends if e <= at - run.lookahead]
            assert list(itertools.accumulate(map(len, whole)))[: len(stable)] == stable
            found, most = [], 0
            for symbol in text:
                found += run.feed(symbol)
                most = max(most, len(run.text))
            found += run.close()
            assert [tokens[i] for i in found] == whole
            assert most <= 4 * max(1, run.lookahead) + run.longest


def test_memory_is_bounded_on_an_endless_word(own):
    run, most, emitted = own.transducer, 0, 0
    for _ in range(300):
        emitted += len(run.feed("thinganre" * 20))
        most = max(most, len(run.text))
    assert most <= 4 * run.lookahead and emitted > 0
    run.close()


def test_lists_out_of_order_and_other_files_are_refused(tmp_path):
    with pytest.raises(ValueError, match="out of order"):
        bpe_stream.Merges({"a": 0, "ab": 1, "b": 2, "aab": 3}, [("a", "ab"), ("a", "b")])
    with pytest.raises(ValueError, match="cannot|not a tokenizer"):
        bpe_stream.Tokens(public_tokenizers.path("byte_bpe_50k.json"))


def test_open_characters_wait_for_their_bytes(own):
    spelled = {i: t for i, t in enumerate([b"\xe2", b"\x82", b"\xac", b"a", b"\xff"])}
    decoder = bpe_stream.Decoder(spelled, b"")
    assert [decoder.feed([0]), decoder.feed([1]), decoder.feed([2, 3]), decoder.feed([4, 0]), decoder.close()] == ["", "", "€a", "�", "�"]
    readable = own.decoder(readable=True)
    assert readable.feed(ids_of(own, "Süße  Träume, 12")) + readable.close() == "süße träume , 1 2 "


def test_table_of_digests(docs, corpus, clashing, empty, library):
    rows = corpus[0] + [(500 + k, t, None, None, 1) for k, t in enumerate(ODD)]
    found = bpe_stream.token_digests(docs.sparkSession.createDataFrame(rows, docs.schema)).collect()
    want = []
    for i, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    assert sorted(map(tuple, found), key=str) == sorted(want, key=str)
    assert same(bpe_stream.token_digests(docs), bpe_stream.token_digests(clashing))
    assert bpe_stream.token_digests(empty).count() == 0


def test_texts_come_back(docs, library):
    rows = {r.doc_id: r.text for r in docs.collect() if r.doc_id is not None}
    coded = bpe_stream.encode(docs)
    for r in bpe_stream.decode(coded).collect():
        if r.doc_id is not None:
            assert r.text == library.decode(library.encode(rows[r.doc_id] or "", add_special_tokens=False).ids, skip_special_tokens=False)
