"""Report tables: formatted text made from numeric frames, last step of a panel."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicpanel.functions import formatting as fmt
from civicpanel.functions.conversion import safe
from civicpanel.functions.text import plural
from civicpanel.sizing import small_side

Format = Callable[[Column], Column]


def format_report(df: DataFrame, keys: Sequence[str], spec: Mapping[str, Column]) -> DataFrame:
    """Keys and formatted text columns, one projection over a numeric frame."""
    return df.select(*keys, *[text.alias(out) for out, text in spec.items()])


def pair_report(
    df: DataFrame, keys: Sequence[str], spec: Mapping[str, tuple[str, str, Format, Format]]
) -> DataFrame:
    """``state | Brasil: country`` text from two numeric columns each.

    ``spec`` maps outputs to ``(state column, country column, format of each)``.
    """
    return format_report(
        df,
        keys,
        {
            out: fmt.pair(state_fmt(F.col(state)), country_fmt(F.col(country)))
            for out, (state, country, state_fmt, country_fmt) in spec.items()
        },
    )


def fmt_items(
    df: DataFrame,
    key: str,
    kind: str,
    out: str,
    count: str = "qtd",
    millions: str = "valor_milhoes",
    equals: str = " = R$ ",
    sep: str = " | ",
) -> DataFrame:
    """Grouped details as one line per key: ``2 type = R$ 1,50 milhões | ...``.

    ``df`` holds one row per key and kind, so a line grows with the kinds only.
    """
    value = F.col(millions)
    amount = F.when(
        value < 1, F.concat(fmt.fmt_dec_br(value * 1000, 2), F.lit(" mil"))
    ).otherwise(F.concat(fmt.fmt_dec_br(value, 2), F.lit(" milhões")))
    line = F.concat(F.col(count).cast("string"), F.lit(" "), F.col(kind), F.lit(equals), amount)
    ordered = F.transform(
        F.sort_array(F.collect_list(F.struct(F.col(kind), line.alias("_line")))),
        lambda item: item["_line"],
    )
    return df.groupBy(key).agg(F.array_join(ordered, sep).alias(out))


def apply_overrides(
    df: DataFrame, overrides: DataFrame, keys: Sequence[str], value: str, official: str
) -> DataFrame:
    """Official values in place of computed ones where the table lists them.

    ``is_override`` marks the rows that were replaced; the table has one row per
    ``keys``.
    """
    joined = df.join(small_side(overrides), list(keys), "left")
    return joined.withColumns(
        {value: F.coalesce(official, value), "is_override": F.col(official).isNotNull()}
    ).drop(official)


def footnotes(df: DataFrame, notes: DataFrame, key: str, columns: Sequence[str], note: str = "nota") -> DataFrame:
    """Notes appended to text columns; rows without a note are unchanged."""
    joined = df.join(small_side(notes), key, "left")
    suffix = F.coalesce(F.concat(F.lit(" "), F.col(note)), F.lit(""))
    return joined.withColumns({name: F.concat(F.col(name), suffix) for name in columns}).drop(note)


def campus_text(count: Column, one: str, many: str) -> Column:
    """Number with its noun in the right form."""
    return F.concat(count.cast("string"), F.lit(" "), plural(count, one, many))


def parse_pairs(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """The inverse of :func:`pair_report`: numbers of the state and of the country.

    ``columns`` maps text columns to prefixes; each gives ``<prefix>_uf``,
    ``<prefix>_br`` and, where a percentage is written, ``..._pct``.  Unit words
    (``mil``, ``milhões``, ``bilhões``) are multiplied in.
    """
    units = {"bilh": 1e9, "milh": 1e6, "mil": 1e3}

    def number(text: Column) -> Column:
        digits = F.regexp_extract(text, r"(-?\d[\d.]*(?:,\d+)?)", 1)
        plain = safe(F.translate(F.replace(digits, F.lit("."), F.lit("")), ",", "."), "double")
        factor = F.lit(1.0)
        for word, scale in reversed(units.items()):
            written = F.regexp_like(text, F.lit(rf"\d {word}"))
            factor = F.when(written, F.lit(scale)).otherwise(factor)
        return plain * factor

    def percentage(text: Column) -> Column:
        digits = F.regexp_extract(text, r"(-?\d+(?:,\d+)?) ?%", 1)
        return safe(F.translate(digits, ",", "."), "double")

    parsed = {}
    for column, prefix in columns.items():
        sides = F.split(F.col(column), r" \| Brasil: ")
        for index, side in enumerate(("uf", "br")):
            text = F.get(sides, F.lit(index))
            parsed[f"{prefix}_{side}"] = number(text)
            parsed[f"{prefix}_{side}_pct"] = percentage(text)
    return df.withColumns(parsed)
