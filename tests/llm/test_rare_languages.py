"""Languages with few texts, or long texts only, beside very frequent ones."""

import random

from civicpanel.llm import language_id
from tests.llm.conftest import DOCS

SYLLABLES = {"aa": ["the", "ing", "ou", "tion"], "bb": ["der", "ung", "sch", "ü"], "cc": ["eau", "ré", "ment", "ç"]}


def text(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def test_rare_and_long_languages_are_learned(frame, monkeypatch):
    """Fewer than one text of a language in the sample of the whole, and one with texts above 32,768 bytes."""
    monkeypatch.setattr(language_id, "SAMPLE", 40)
    rng = random.Random(6)
    rows = [(i, text(rng, "aa", 30), "aa", "s", 1) for i in range(3000)]
    rows += [(5000 + i, text(rng, "bb", 30), "bb", "s", 1) for i in range(12)]
    rows += [(6000 + i, text(rng, "cc", 6000), "cc", "s", 1) for i in range(12)]
    assert all(len(r[1].encode()) > 32_768 for r in rows if r[2] == "cc")
    found = language_id.identify(frame(rows, DOCS)).collect()
    want = {r[0]: r[2] for r in rows}
    assert all(r.lang_pred == want[r.doc_id] for r in found)
