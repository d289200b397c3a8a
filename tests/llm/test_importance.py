"""Importance resampling against a plain version in Python."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from civicpanel.llm import importance
from tests.llm.conftest import DOCS, same

COLUMNS = ["doc_id", "n_features", "weight", "score", "rank"]


def grams(text, longest):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    return words, [" ".join(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)]


def by_hand(rows, target, longest=1, buckets=10_000, percent=10, least=20):
    bucket = lambda g: zlib.crc32(g.encode()) % buckets
    s, t = Counter(), Counter()
    for into, texts in ((s, [r[1] for r in rows]), (t, target)):
        for text in texts:
            into.update(map(bucket, grams(text, longest)[1]))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)]
    out = []
    for i, text, *_ in rows:
        words, own = grams(text, longest)
        weight = sum(gain[bucket(g)] for g in own) // len(own) if own else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(words), len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    draw = len(able) * percent // 100
    drawn = [(r[0], *r[2:], k + 1) for k, r in enumerate(able[:draw])]
    return drawn + [(r[0], *r[2:], None) for r in able[draw:]] + [(r[0], *r[2:], None) for r in out if r[1] < least]


@pytest.mark.parametrize(("longest", "percent"), [(1, 10), (1, 60), (3, 25), (2, 100)])
def test_draw_equals_the_plain_version(frame, corpus, docs, monkeypatch, longest, percent):
    """Also with words cut into small blocks and caches that overflow."""
    monkeypatch.setattr(importance, "BLOCK_BYTES", 64)
    monkeypatch.setattr(importance, "WORDS_AT_HAND", 100)
    target = [corpus[1], corpus[2].upper(), None, "", "Éé \x7f 3-4"]
    found = importance.resample(docs, frame([(t,) for t in target], "text string"), longest, percent=percent)
    assert found.columns == COLUMNS
    key = lambda r: tuple((v is None, v or 0) for v in r)
    assert sorted(map(tuple, found.collect()), key=key) == sorted(by_hand(corpus[0], target, longest, percent=percent), key=key)


def test_blocks_give_the_words_of_the_whole_text(monkeypatch):
    monkeypatch.setattr(importance, "BLOCK_BYTES", 7)
    for text in ["", "a", "one two three", "x" * 50, "x" * 50 + " y", " " * 30, "abüüüüü cd" * 9, "A!B" * 20]:
        assert [w.decode() for b in importance.word_blocks(text) for w in b] == grams(text, 1)[0]


def test_ties_empty_tables_and_clashing_columns(frame, docs, clashing, empty, corpus):
    target = frame([(corpus[1],)], "text string")
    assert same(importance.resample(docs, target), importance.resample(clashing, target))
    assert importance.resample(empty, target).count() == 0
    nothing = importance.resample(docs, target.limit(0))
    assert nothing.count() == docs.count()
    text = " ".join(["same"] * 30)
    tied = frame([(7, text, None, None, 1)] * 5 + [(None, text, None, None, 1)] * 5, DOCS)
    ranks = sorted(r["rank"] for r in importance.resample(tied, target, percent=100).collect())
    assert ranks == list(range(1, 11))
