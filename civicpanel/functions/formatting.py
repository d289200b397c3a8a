"""Column expressions that turn numbers into Brazilian report text.

Every number is rounded by a decimal cast and only then written as text, so
the result does not depend on how a formatter breaks ties.  NULL stays NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PAIR = " | Brasil: "


def fmt_int_br(c: Column, thousands: str = ".") -> Column:
    """1234567 to ``1.234.567``."""
    return F.translate(F.format_number(c.cast("decimal(38,0)"), 0), ",", thousands)


def fmt_dec_br(c: Column, digits: int) -> Column:
    """Fixed number of decimals with a comma, no thousands mark."""
    return F.translate(c.cast(f"decimal(38,{digits})").cast("string"), ".", ",")


def fmt_trim_br(c: Column, digits: int) -> Column:
    """At most ``digits`` decimals, without trailing zeros, decimal comma."""
    text = c.cast(f"decimal(38,{digits})").cast("string")
    return F.translate(F.regexp_replace(text, r"\.?0+\z", ""), ".", ",")


def scaled(c: Column, power: int) -> Column:
    """``c``, read with at most ten decimals, divided exactly by ``10 ** power`` (9 at most)."""
    return c.cast("decimal(28,10)") * F.lit("0." + "0" * (power - 1) + "1").cast(f"decimal({power},{power})")


def ratio(numerator: Column, denominator: Column, digits: int, factor: int = 100) -> Column:
    """``factor * numerator / denominator`` rounded half up to ``digits`` decimals.

    The division is done in decimals, with 16 places before the final rounding;
    a zero denominator gives NULL.
    """
    top = numerator.cast("decimal(18,2)") * F.lit(factor)
    bottom = F.nullif(denominator.cast("decimal(18,2)"), F.lit(0).cast("decimal(18,2)"))
    return (top / bottom).cast(f"decimal(38,{digits})")


def fmt_millions(c: Column, digits: int = 2) -> Column:
    return F.concat(fmt_dec_br(scaled(c, 6), digits), F.lit(" milhões"))


def fmt_billions(c: Column, digits: int = 2) -> Column:
    return F.concat(fmt_dec_br(scaled(c, 9), digits), F.lit(" bilhões"))


def fmt_money_br(c: Column, small: str = "integer", thousands: str = ".") -> Column:
    """``R$`` text in billions, millions, or below a million.

    ``small="integer"`` writes whole reais below a million; ``"millions"``
    keeps the millions unit there.
    """
    below = fmt_millions(c) if small == "millions" else fmt_int_br(c, thousands)
    text = (
        F.when(c >= 1_000_000_000, fmt_billions(c))
        .when(c >= 1_000_000, fmt_millions(c))
        .otherwise(below)
    )
    return F.concat(F.lit("R$ "), text)


def fmt_mil(c: Column) -> Column:
    """12345 to ``12,3 mil``."""
    return F.concat(fmt_dec_br(scaled(c, 3), 1), F.lit(" mil"))


def fmt_general(c: Column) -> Column:
    """Six significant digits without trailing zeros, decimal comma; ties to even.

    Values outside ``1e-4 .. 1e6`` are written with an exponent; only for them the formatter is
    called.  The expression is short, because the JVM does not compile long methods.
    """
    value = c.cast("double")
    size = F.abs(value)
    plain = F.when((size >= 9.999995e-5) & (size < 9.999995e5), value)  # once rounded to six digits
    # Just below a power of ten, six digits and five give the same number.
    unit = F.element_at(F.array(*[F.lit(10 ** (5 - power)).cast("decimal(11,0)") for power in range(-5, 6)]), (F.floor(F.log10(F.abs(plain))) + 6).cast("int"))
    six = F.bround(plain.try_cast("decimal(24,18)") * unit, 0).cast("decimal(7,0)")
    fixed = F.rtrim(F.rtrim((six / unit).cast("string"), F.lit("0")), F.lit("."))
    scientific = F.format_string("%.5e", value)
    mantissa = F.regexp_replace(F.substring_index(scientific, "e", 1), r"\.?0+\z", "")
    with_exponent = F.concat(mantissa, F.lit("e"), F.substring_index(scientific, "e", -1))
    text = F.when(value == 0, F.lit("0")).otherwise(F.coalesce(fixed, with_exponent))
    return F.when(value.isNotNull(), F.translate(text, ".", ","))


def pair(uf: Column, br: Column) -> Column:
    """``state | Brasil: country``."""
    return F.concat(uf, F.lit(PAIR), br)
