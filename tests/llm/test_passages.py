"""Shared passages of 15 words and more, and lines with a changed word, against brute force."""

import random

import numpy as np
import pyarrow as pa

from civicpanel.lineage import Scratch
from civicpanel.llm import substring_dedup
from tests.llm.conftest import prose


def covered(rows, least=15):
    """(document, word) of every window that another document has too."""
    where = {}
    for i, text in rows:
        w = text.lower().split()
        for at in range(len(w) - least + 1):
            where.setdefault(tuple(w[at : at + least]), []).append((i, at))
    places = [p for found in where.values() if len({i for i, _ in found}) > 1 for p in found]
    return {(i, at + k) for i, at in places for k in range(least)}


def test_short_passages_are_found_at_full_length(frame):
    rng = random.Random(9)
    rows = []
    for k, size in enumerate([15, 16, 18, 20, 20, 24, 28, 30, 30, 35, 40, 45, 51, 55]):
        passage = prose(rng, size)
        rows += [(10 * k + j, f"{prose(rng, rng.randint(3, 40))} {passage} {prose(rng, rng.randint(3, 40))}") for j in range(3)]
    rows += [(900, "A " + prose(rng, 60)), (901, prose(rng, 14))]
    rows += [(902, rows[-1][1])]  # fewer words than a passage
    found = substring_dedup.repeated_paragraphs(frame(rows, "doc_id bigint, text string")).collect()
    got = {(r.doc_id, r.start + k) for r in found for k in range(r.n_words)}
    needed = covered(rows)
    assert needed <= got and len(got - needed) <= 0.01 * len(needed)  # a fragment may begin a word earlier
    gone = {(r.doc_id, r.start + k) for r in found if r.removed for k in range(r.n_words)}
    assert {p for p in needed if p[0] % 10} <= gone and not any(p[0] % 10 == 0 for p in gone)
    assert not covered([(r.doc_id, r.text) for r in substring_dedup.without_repeats(frame(rows, "doc_id bigint, text string")).collect()])


def test_lines_with_a_changed_word_are_near_copies(frame):
    rng = random.Random(10)
    rows, near = [], []
    for k in range(60):
        line = prose(rng, 60)
        own = line.split(" ")
        own[rng.randrange(len(own))] = "changed"
        rows += [(10 * k, f"{prose(rng, 30)}\n{line}\n{prose(rng, 20)}"), (10 * k + 1, f"{prose(rng, 20)}\n{' '.join(own)}")]
        near.append((10 * k + 1, 20, 60, 10 * k, 30))
    found = substring_dedup.repeated_paragraphs(frame(rows, "doc_id bigint, text string")).collect()
    assert set(near) <= {(r.doc_id, r.start, r.n_words, r.component_id, r.component_start) for r in found if r.removed}


def test_words_are_compared_in_packs_not_in_rows(spark, frame, monkeypatch):
    """No table between the steps has a row for each anchor or block."""
    rng = random.Random(11)
    base = [prose(rng, 400).split(" ") for _ in range(12)]
    rows = []
    for k, words in enumerate(base):  # copies with a change, so that anchors are settled and not settled
        own = list(words)
        own[rng.randrange(len(own))] = "changed"
        rows += [(10 * k, " ".join(words)), (10 * k + 1, " ".join(own)), (10 * k + 2, " ".join(words[:200]))]
    sizes, kept = [], Scratch.written

    def counted(self, df):
        found = kept(self, df)
        sizes.append(found.count())
        return found

    monkeypatch.setattr(Scratch, "written", counted)
    found = substring_dedup.repeated_paragraphs(frame(rows, "doc_id bigint, text string")).collect()
    got = {(r.doc_id, r.start + k) for r in found for k in range(r.n_words)}
    assert covered(rows) <= got
    # A row for every sixth word would be 2,000; the paragraphs, their lists and links are far fewer.
    assert max(sizes) <= 20 * len(rows)


def test_shared_values_are_those_of_two_documents(monkeypatch):
    """Packs of any size, values that are equal by chance, and one value that nearly all entries have."""
    rng = np.random.default_rng(12)
    monkeypatch.setattr(substring_dedup, "SLICE_BYTES", 100)
    for pairs in (False, True):
        n = 600
        value = rng.choice([5, *range(40, 240)], n, p=[0.6, *[0.4 / 200] * 200])
        entries = np.stack([value, rng.integers(0, 3, n), rng.integers(0, 40, n), rng.integers(0, 9, n), rng.integers(0, 2, n)])
        packs = [entries[:, a : a + 7] for a in range(0, n, 7)]
        batches = [
            pa.RecordBatch.from_arrays([pa.array([k] * len(g)), pa.array([p.tobytes() for p in g])], ["slice", "data"])
            for k, g in enumerate([packs[:1], packs[1:50], [], packs[50:]])
        ]
        answer = lambda e, g: [(True, np.concatenate([e, g]))]
        found = [d for b in substring_dedup._shared(iter(batches), 5, pairs, answer) for d in b["data"].to_pylist()]
        found = np.concatenate([np.frombuffer(d, np.int64).reshape(13, -1) for d in found], 1).T.tolist()
        groups = {}
        for e in entries.T.tolist():
            groups.setdefault((e[0], e[1] * pairs), []).append(e)
        wanted = []
        for key, own in groups.items():
            docs, marks = [e[2] for e in own], [e[1] for e in own]
            if len(set(docs)) > 1:
                first = min((e[2:] for e in own))
                wanted += [[*e, *key, *first, max(docs), min(marks), max(marks)] for e in own]
        assert sorted(found) == sorted(wanted)
