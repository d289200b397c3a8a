import random

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that the operators use for columns of their own.
CLASHING = ["node", "key", "item", "size", "words", "kept", "score", "start", "digest", "component_id", "chunk", "print", "n_words",
            "_id", "_key", "_found", "_lang", "_source", "removed_spans", "text_key", "own_id", "own_key", "hit_id", "kept_id"]


def word(rng):
    return "".join(rng.choice("abcdefghijklmnoprstuvwxyz") for _ in range(rng.randint(2, 8)))


def prose(rng, n):
    return " ".join(word(rng) for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """Rows (doc_id, text, lang, source, n_chars): prose, copies, near copies, passages, odd texts."""
    rng = random.Random(5)
    passage, bench = prose(rng, 60), prose(rng, 30)
    texts = [prose(rng, rng.randint(55, 160)) for _ in range(60)]
    texts += texts[:6] + [texts[0]] * 5  # copies
    for i in range(6, 14):  # near copies
        own = texts[i].split(" ")
        own[rng.randrange(len(own))] = "changed"
        texts.append(" ".join(own))
    for i in range(14, 22):  # shared passages, at any place in a line
        own = texts[i].split(" ")
        at = rng.randrange(len(own))
        texts.append(" ".join([*own[:at], *passage.split(" "), *own[at:]][: at + 60 + 40]))
    texts[30] += " " + bench
    texts[31] = bench.upper() + ", " + texts[31]
    texts += ["", None, " \t\n", "one", "two words", "a b c", "ab " * 300, "é ü ß " * 20, "!!! ... ###", "x" * 5000, "l1 l2 l3 l4\nl1 l2 l3 l4\n\nend"]
    rows = [(i, t, ["en", "de", None][i % 3], ["s1", "s2", None][i % 2 if i % 7 else 2], len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, texts[2], "en", "s1", 1), (None, None, None, None, None)]
    return rows, bench, passage


@pytest.fixture
def docs(frame, corpus):
    return frame(corpus[0], DOCS)


@pytest.fixture
def clashing(docs):
    """The same rows with further columns."""
    from pyspark.sql import functions as F

    return docs.withColumns({c: F.lit("x") for c in CLASHING})


@pytest.fixture
def empty(frame):
    return frame([], DOCS)


def same(left, right):
    key = lambda r: tuple((v is not None, str(v)) for v in r)
    return sorted((tuple(r) for r in left.collect()), key=key) == sorted((tuple(r) for r in right.collect()), key=key)
