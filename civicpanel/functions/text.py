"""Column expressions on names, codes and labels."""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Mapping, Sequence
from functools import cache, reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from civicpanel.functions.brazil import STATE_NAMES

MARKS = r"\p{Mn}"
# Characters after which a display name starts a new word.
WORD_BREAK = r"(?<=[\s\[\](){}/|<>!?@\"^#$&~_,.:;*%+-])"


@cache
def _letters() -> tuple[str, str]:
    """Letters that Unicode composes of a base letter and marks, and their base letters."""
    pairs = {}
    for code in range(0xC0, 0x2000):
        parts = unicodedata.normalize("NFD", chr(code))
        if len(parts) > 1 and all(unicodedata.combining(mark) for mark in parts[1:]):
            pairs[chr(code)] = parts[0]
    return "".join(pairs), "".join(pairs.values())


@cache
def _marks() -> dict[str, str]:
    """Sequences of marks that at least ten letters carry, and those letters."""
    letters: dict[str, str] = {}
    for letter in _letters()[0]:
        marks = unicodedata.normalize("NFD", letter)[1:]
        letters[marks] = letters.get(marks, "") + letter
    return {marks: found for marks, found in letters.items() if len(found) >= 10}


def decomposed(c: Column) -> Column:
    """``c`` with common accents written as marks behind their letter, one class of letters at a time."""
    value = c
    for marks, found in _marks().items():
        value = F.regexp_replace(value, f"([{found}])", f"$1{marks}")
    common = "".join(_marks().values())
    pairs = dict(zip(*_letters(), strict=True))
    value = F.translate(value, common, "".join(pairs[letter] for letter in common))
    return F.when(c.rlike(r"[^\x00-\x7F]"), value).otherwise(c)


def without_marks(c: Column) -> Column:
    """``c`` with letters in place of accented letters, composed or not."""
    return F.regexp_replace(F.translate(c, *_letters()), MARKS, "")


def collation(accent: bool = True, case: bool = True) -> str:
    """The collation that compares names: ``accent`` keeps accents, ``case`` ignores case."""
    return "UNICODE" + "_CI" * case + "_AI" * (not accent)


def name_key(c: Column, accent: bool = True, case: bool = True) -> Column:
    """Comparable form of a name, with the collation that joins and groups compare it by.

    Composed and decomposed forms of any accented letter always compare equal.  ``accent=True``
    keeps the accent significant; ``accent=False`` also takes letters without a
    decomposition, such as ``Ł``, for their base letter.  ``case=False`` leaves upper
    and lower case distinct.  ``plain_text`` gives a key back without its collation.
    """
    text = F.trim(F.upper(c) if case else c)
    return F.collate(decomposed(text) if accent else without_marks(text), collation(accent, case))


def plain_text(key: Column) -> Column:
    """A collated text compared by its bytes again, for example before it is written."""
    return F.collate(key, "UTF8_BINARY")


def sanitize(c: Column) -> Column:
    """Control characters and runs of white space to one space; ends trimmed."""
    return F.trim(F.regexp_replace(c, r"[\s\p{Cntrl}]+", " "))


def name_case(c: Column, default: str | None = None) -> Column:
    """Display form of a name: each word starts with a capital letter.

    Words also start after punctuation, so ``SANTA-MARIA`` gives ``Santa-Maria``.
    """
    words = F.split(F.lower(F.trim(c)), WORD_BREAK)
    shown = F.array_join(F.transform(words, F.initcap), "")
    return shown if default is None else F.coalesce(shown, F.lit(default))


def split_part(c: Column, sep: str, index: int, strict: bool = False) -> Column:
    """Part ``index`` (from 0) of ``c``; out of range is NULL, or an error if ``strict``."""
    parts = F.split(c, re.escape(sep))
    value = F.get(parts, F.lit(index))
    if not strict:
        return value
    message = F.concat(F.lit(f"no part {index} in: "), c)
    return F.when(
        c.isNotNull() & (F.size(parts) <= index), F.raise_error(message).cast("string")
    ).otherwise(value)


def strip_suffix(c: Column, suffix: str) -> Column:
    """``c`` without a trailing ``suffix`` (a regular expression)."""
    return F.regexp_replace(c, f"(?:{suffix})\\z", "")


def fix_names(c: Column, exact: Mapping[str, str], prefix: Mapping[str, str] | None = None) -> Column:
    """Known spelling corrections; exact rules first, then prefixes, else ``c``."""
    value = None
    rules = [(c == wrong, right) for wrong, right in exact.items()]
    rules += [(c.startswith(wrong), right) for wrong, right in (prefix or {}).items()]
    for condition, right in rules:
        value = (
            F.when(condition, F.lit(right)) if value is None else value.when(condition, F.lit(right))
        )
    return c if value is None else value.otherwise(c)


def state_code(c: Column, names: Mapping[str, str] | None = None) -> Column:
    """State name or code, accented or not, in any case, to its two-letter code.

    An unknown two-letter value is kept in upper case; other unknown text is NULL.
    """
    names = STATE_NAMES if names is None else names
    text = without_marks(F.trim(F.upper(c)))
    lookup = {code: code for code in names}
    for code, name in names.items():
        bare = "".join(
            mark
            for mark in unicodedata.normalize("NFD", name.upper())
            if not unicodedata.combining(mark)
        )
        lookup[bare] = code
    pairs = F.create_map(*[F.lit(item) for pair in lookup.items() for item in pair])
    plain = F.upper(F.trim(c))
    return F.coalesce(pairs[text], F.when(F.length(plain) == 2, plain))


def classify(c: Column, groups: Mapping[str, Sequence[str]], default: str | None) -> Column:
    """Label of the group that lists ``c``; ``default`` outside all groups."""
    value = None
    for label, members in groups.items():
        condition = c.isin(list(members))
        value = F.when(condition, F.lit(label)) if value is None else value.when(condition, F.lit(label))
    return value.otherwise(F.lit(default))


def decode(c: Column, labels: Mapping, default: str | None = None) -> Column:
    """Label of a code; ``default`` (NULL unless given) for other codes."""
    return classify(c, {label: [code] for code, label in labels.items()}, default)


def presence(*conditions: Column) -> Column:
    """1 when any condition holds, else 0; an unknown condition counts as absent."""
    return F.when(reduce(lambda a, b: a | b, conditions), 1).otherwise(0)


def hash_key(*columns: Column) -> Column:
    """SHA-256 (hex) of the concatenated values, NULL read as empty text."""
    return F.sha2(F.concat(*[F.coalesce(c.cast("string"), F.lit("")) for c in columns]), 256)


def hmac_sha256(c: Column, key: bytes) -> Column:
    """HMAC-SHA-256 (hex) of text under a secret key; NULL stays NULL.

    Values of a short number range cannot be listed and hashed by who lacks the key.
    """
    if not key:
        raise ValueError("a keyed hash needs a key")
    block = (hashlib.sha256(key).digest() if len(key) > 64 else key).ljust(64, b"\0")
    inner, outer = (F.lit(bytes(byte ^ pad for byte in block)) for pad in (0x36, 0x5C))
    first = F.unhex(F.sha2(F.concat(inner, c.cast("string").cast("binary")), 256))
    return F.sha2(F.concat(outer, first), 256)


def eq_ci(c: Column, value: str) -> Column:
    """Equality without regard to case."""
    return F.upper(c) == F.lit(value.upper())


def status_default(flag: Column, answer: Column, default: str) -> Column:
    """``default`` where the form was submitted but the answer is missing."""
    return F.when(flag.eqNullSafe(True) & answer.isNull(), F.lit(default)).otherwise(answer)


def plural(n: Column, one: str, many: str) -> Column:
    """``one`` for exactly 1, ``many`` otherwise."""
    return F.when(n == 1, F.lit(one)).otherwise(F.lit(many))
