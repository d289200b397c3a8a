"""Near duplicates, repeated passages and components against brute force."""

import random

import numpy as np
import pytest

import corpus_pipeline
from civicpanel.llm import near_dedup, substring_dedup
from civicpanel.llm.graph import components
from tests.llm.conftest import prose, same


def words(text):
    return (text or "").encode().lower().split()


def shingles(text, n):
    w = words(text)
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set())


def brute_components(rows, width, percent):
    ids = sorted({r[0] for r in rows if r[0] is not None})
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    sets = [(i, shingles(t, width)) for i, t, *_ in rows if i is not None]
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_components_of_paths_stars_and_loops(frame):
    edges = [(i, i + 1) for i in range(1, 30)] + [(100, k) for k in range(101, 140)] + [(7, 7), (None, 3), (200, 201), (200, 201)]
    found = dict(components(frame(edges, "a bigint, b bigint")).collect())
    assert all(found[i] == 1 for i in range(1, 31)) and all(found[k] == 100 for k in range(100, 140))
    assert found[201] == 200 and len(found) == 30 + 40 + 2
    assert components(frame([], "a bigint, b bigint")).count() == 0


@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_near_duplicates_equal_brute_force(docs, corpus, width, percent):
    expected = brute_components(corpus[0], width, percent)
    for r in near_dedup.near_duplicates(docs, width, percent).collect():
        if r.doc_id is not None:
            assert r.component_id == expected[r.doc_id] and r.kept == (r.doc_id == expected[r.doc_id])


def test_a_large_near_group_loses_no_link_and_is_not_paired(frame, monkeypatch):
    """Copies with up to a sixth of the words changed: compared pairs grow with the group, not its square."""
    rng, width, percent = random.Random(8), 3, 85
    base = prose(rng, 90).split(" ")

    def copies(n):
        rows = []
        for i in range(n):
            own = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3, 4, 6, 9, 15])):
                own[rng.randrange(len(own))] = prose(rng, 1)
            rows.append((i, " ".join(own)))
        return rows + [(n + i, f"{prose(rng, rng.randint(20, 60))} {' '.join(base[:12])} {prose(rng, 30)}") for i in range(n)]

    seen = []
    confirmed = near_dedup._confirmed

    def counted(pairs, *rest):
        seen[-1] += pairs.count()
        return confirmed(pairs, *rest)

    monkeypatch.setattr(near_dedup, "_confirmed", counted)
    for n in (75, 300):
        seen.append(0)
        rows = copies(n)
        expected = brute_components(rows, width, percent)
        for r in near_dedup.near_duplicates(frame(rows, "doc_id bigint, text string"), width, percent).collect():
            assert r.component_id == expected[r.doc_id]
    assert seen[1] <= 6 * seen[0] + 100 and seen[1] < 300 * 300 / 15


def test_parities_never_exclude_a_link():
    rng = np.random.default_rng(1)
    for _ in range(200):
        n = int(rng.integers(1, 3000))
        a = rng.integers(0, 1 << 63, n).astype(np.uint64)
        b = np.concatenate([a[rng.random(n) < rng.random()], rng.integers(0, 1 << 63, int(rng.integers(0, n + 1))).astype(np.uint64)])
        differ = sum(int(x).bit_count() for x in (near_dedup.parities(a) ^ near_dedup.parities(b)).view(np.uint64))
        assert differ <= len(np.setxor1d(a, b))


def test_a_rejected_row_takes_no_other_text_with_it(spark, frame):
    rng = random.Random(3)
    a, b = prose(rng, 60), prose(rng, 60)
    rows = frame([(1, a), (2, a), (2, b), (2, b), (None, a)], "doc_id bigint, text string")
    for own in (rows, rows.selectExpr("*", "1 AS _id", "2 AS kept_id", "3 AS text_key", "4 AS node")):
        kept = corpus_pipeline.near_dedup(spark, own, "")
        assert kept.columns == own.columns
        assert sorted(map(str, kept.select("doc_id", "text").collect())) == sorted(map(str, rows.limit(0).union(
            frame([(1, a), (2, b), (None, a)], "doc_id bigint, text string")).collect()))


def test_near_duplicates_edge_cases(docs, clashing, empty):
    plain = near_dedup.near_duplicates(docs, 3, 85)
    assert same(plain, near_dedup.near_duplicates(clashing, 3, 85)) and plain.count() == docs.count()
    assert near_dedup.near_duplicates(empty).count() == 0
    by_id = {r.doc_id: r for r in plain.collect()}
    blank = next(r.doc_id for r in docs.collect() if r.text == "")
    assert by_id[blank].n_shingles == 0 and by_id[blank].component_id == blank and by_id[blank].kept


def test_passages_are_found_and_clean_texts_left(docs, corpus):
    rows, _, passage = corpus
    found = substring_dedup.repeated_paragraphs(docs).collect()
    spans = {}
    for i, text, *_ in rows:
        w = words(text)
        for at in range(len(w) - 50):
            spans.setdefault(tuple(w[at : at + 51]), set()).add(i)
    needed = {i for ids in spans.values() if len(ids - {None}) > 1 for i in ids - {None}}
    short = {}
    for i, text, *_ in rows:
        w = words(text)
        for at in range(len(w) - 6):
            short.setdefault(tuple(w[at : at + 7]), set()).add(i)
    allowed = {i for ids in short.values() if len(ids - {None}) > 1 for i in ids - {None}}
    got = {r.doc_id for r in found}
    assert needed and needed <= got <= allowed
    assert all(r.removed == ((r.doc_id, r.start) != (r.component_id, r.component_start)) for r in found)


def test_repeats_are_cut_out_once(docs, corpus, empty, clashing):
    passage = " ".join(corpus[2].split(" ")[20:40])
    cut = substring_dedup.without_repeats(docs)
    before, after = docs.collect(), cut.collect()
    assert len(after) == len(before) and cut.columns == docs.columns
    assert sum(passage in (r.text or "") for r in before) > 1 and sum(passage in (r.text or "") for r in after) == 1
    clean = next(r for r in before if r.doc_id == 40)
    assert clean in after
    assert substring_dedup.without_repeats(empty).count() == 0
    assert substring_dedup.without_repeats(clashing).columns == clashing.columns
    assert same(substring_dedup.repeated_paragraphs(docs), substring_dedup.repeated_paragraphs(clashing))
