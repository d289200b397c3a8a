"""Decontamination against SQL and brute force; toxicity and language by held-out accuracy."""

import hashlib
import random
import re
import zlib

import pytest

from civicpanel.llm import decontaminate, language_id, toxicity
from tests.llm.conftest import DOCS, prose, same


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text))


def hits(text, items):
    w, hit, ids = words(text), set(), set()
    for item, other in items:
        o = words(other)
        k = min(10, len(o))
        windows = {tuple(o[i : i + k]) for i in range(len(o) - k + 1)} if o else set()
        for i in range(len(w) - k + 1) if o else ():
            if tuple(w[i : i + k]) in windows:
                hit |= set(range(i, i + k))
                ids.add(item)
    names = ",".join(sorted(str(i) for i in ids if i is not None))
    return len(w), len(hit), len(ids - {None}), hashlib.sha256(names.encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("short", [False, True])
def test_decontamination_equals_brute_force(frame, docs, clashing, corpus, short):
    rows, bench, _ = corpus
    items = [(1, bench), (1, bench), (2, rows[8][1]), (12, "never seen words in any text of this corpus at all"), (3, ""), (4, None), (None, rows[9][1])]
    items += [(5, "two words"), (6, "one"), (7, "a b c")] if short else []
    table = frame(items, "item_id bigint, text string").selectExpr("*", "1 AS words", "2 AS grams")
    found = decontaminate.contamination(docs, table)
    want = sorted(((i, *hits(t, items)) for i, t, *_ in rows), key=str)
    assert sorted((tuple(r) for r in found.collect()), key=str) == want
    assert same(found, decontaminate.contamination(clashing, table))


def test_decontamination_of_empty_tables(frame, docs, empty):
    none = frame([], "item_id bigint, text string")
    assert decontaminate.contamination(empty, none).count() == 0
    assert all(r.n_hit == 0 and not r.contaminated for r in decontaminate.contamination(docs, none).collect())


def test_decontamination_is_native(docs, frame):
    found = decontaminate.contamination(docs, frame([(1, "x y")], "item_id bigint, text string"))
    text = found._jdf.queryExecution().executedPlan().toString()
    assert not any(x in text for x in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))


def labelled(rng, n):
    rows = []
    for i in range(n):
        own, toxic = prose(rng, rng.randint(40, 120)).split(" "), int(rng.random() < 0.3)
        for _ in range(4 if toxic else 0):
            own.insert(rng.randrange(len(own)), rng.choice(["scumbagly", "loserish", "idiotic"]) + rng.choice(["a", "en", "ous"]))
        rows.append((i, " ".join(own), "en", "s", 1, toxic))
    return rows


def test_toxic_texts_are_told_apart(frame):
    rows = labelled(random.Random(3), 900)
    docs = frame([r[:5] for r in rows] + [(5000, None, "en", "s", 0), (5001, "", "en", "s", 0), (None, "plain text", None, None, 1), rows[0][:5]], DOCS)
    labels = frame([(r[0], 0, r[5]) for r in rows] + [(77777, 0, 1), (None, 0, 1), (3, None, None)], "doc_id bigint, quality int, toxic int")
    found = toxicity.toxicity(docs.selectExpr("*", "1 AS toxic", "2 AS score"), labels).collect()
    truth = {r[0]: r[5] for r in rows}
    assert len(found) == len(rows) + 4
    held = [r for r in found if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found if r.doc_id is not None)
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    assert all(r.predicted == 0 for r in found if r.doc_id in (5000, 5001))


def test_toxicity_without_labels(frame, docs, empty):
    none = frame([], "doc_id bigint, quality int, toxic int")
    assert {r.predicted for r in toxicity.toxicity(docs, none).collect()} == {0}
    assert toxicity.toxicity(empty, none).count() == 0


SYLLABLES = {"aa": ["the", "ing", "ou", "tion"], "bb": ["der", "ung", "sch", "ü"], "cc": ["eau", "ré", "ment", "ç"]}


def test_languages_are_told_apart(frame):
    rng = random.Random(4)
    rows = []
    for i in range(600):
        lang = rng.choice(list(SYLLABLES))
        text = " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(15, 60)))
        rows.append((i, text, lang, "s", 1))
    odd = [(9000, None, "aa", "s", 0), (9001, "123 !!", "aa", "s", 0), (9002, "ing the", None, None, 0), (None, "eau ré", "cc", "s", 0)]
    docs = frame(rows + odd + rows[:1], DOCS).selectExpr("*", "1 AS cosine", "2 AS lang_pred")
    found = {r.doc_id: r for r in language_id.identify(docs).collect()}
    held = [r for r in rows if found[r[0]].held_out]
    assert sum(found[r[0]].lang_pred == r[2] for r in held) >= 0.98 * len(held)
    assert found[9000].lang_pred == found[9001].lang_pred == "und" and found[9000].score == 0
    assert found[9002].lang_pred == "aa" and found[None].lang_pred == "cc"
    assert all(0 <= r.score <= 1 for r in found.values())


def test_fractions_and_numerals_are_no_letters(frame):
    rows = [(i, t, lang, "s", 1) for i in range(40) for t, lang in (("ing the of and", "aa"), ("один два три", "bb"))]
    rows += [(k, t, "aa", "s", 1) for k, t in ((101, "½ ² Ⅳ ٣ ①"), (102, "_ - 12"), (103, "ª"), (104, "中"), (105, "12 ing"))]
    found = {r.doc_id: r.lang_pred for r in language_id.identify(frame(rows, DOCS)).collect()}
    assert found[101] == found[102] == "und" and "und" not in (found[103], found[104], found[105])


def test_a_far_text_is_rejected(frame):
    rows = [(i, " ".join([w] * 30), lang, "s", 1) for i, (w, lang) in enumerate([("the ing", "aa"), ("der ung", "bb")] * 50)]
    docs = frame([*rows, (9000, "qzx jjk vvw " * 20, None, "s", 1)], DOCS)
    found = {r.doc_id: r for r in language_id.identify(docs).collect()}
    assert found[9000].rejected and not found[0].rejected


def test_language_with_nothing_to_learn(docs, empty):
    from pyspark.sql import functions as F

    nothing = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language_id.identify(nothing).collect()} == {"und"}
    assert language_id.identify(empty).count() == 0
