"""Sums, distinct counts, pivots, shares and scores by key.

Money is summed in decimals of ten places and rounded to the cent once, after the
sum, so a total depends neither on the order in which partitions arrive nor on
fractions of a cent in the rows.  Totals are given back as double.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicpanel.sizing import small_side

MONEY = "decimal(18,2)"
EXACT = "decimal(28,10)"
TOTAL = "decimal(28,2)"


def money(c: Column | str) -> Column:
    """Exact sum of a money column, as decimal."""
    return F.sum((F.col(c) if isinstance(c, str) else c).cast(EXACT)).cast(TOTAL)


def group_sum(
    df: DataFrame, keys: Sequence[str], sums: Mapping[str, str], count: str | None = None
) -> DataFrame:
    """Money sums and the row count per key; ``sums`` maps outputs to columns."""
    totals = [money(column).cast("double").alias(out) for out, column in sums.items()]
    if count:
        totals.append(F.count(F.lit(1)).alias(count))
    return df.groupBy(*keys).agg(*totals)


def group_count_distinct(
    df: DataFrame, keys: Sequence[str], column: str, out: str, approximate: float | None = None
) -> DataFrame:
    """Distinct values per key.  The counts do not add up across keys.

    ``approximate`` accepts a relative error and then needs no second shuffle.
    """
    value = (
        F.count_distinct(column)
        if approximate is None
        else F.approx_count_distinct(column, approximate)
    )
    return df.groupBy(*keys).agg(value.alias(out))


def distinct_by_level(
    df: DataFrame, person: str, state: str, out: str = "pessoas", country: str = "BR"
) -> DataFrame:
    """Distinct people per state and once for the country.

    Pairs of state and person are made distinct first, so the country's count
    starts from reduced rows and is spread over all people, not over one key.
    A missing state counts for the country only.
    """
    pairs = df.where(F.col(person).isNotNull()).select(state, person).distinct()
    # Both branches name a count that is never 0.  That keeps them above the same
    # shuffled pairs, so the facts are read only once.
    known = F.col(state).isNotNull() | (F.col(out) == 0)
    states = (
        pairs.groupBy(state)
        .agg(F.count(F.lit(1)).alias(out))
        .where(known)
        .withColumn("nivel", F.lit("estado"))
    )
    per_person = pairs.groupBy(person).agg(F.count(F.lit(1)).alias("_states"))
    people = per_person.agg(F.count_if(F.col("_states") > 0).alias(out))
    nation = people.select(F.lit(country).alias(state), out, F.lit("pais").alias("nivel"))
    return states.unionByName(nation)


def person_bitmaps(df: DataFrame, person: str, keys: Sequence[str]) -> DataFrame:
    """Exact sets of whole-number ``person`` ids per key, as mergeable bitmaps.

    Returns the keys, ``bloco`` (each covers a range of 32,768 ids) and ``pessoas``, the
    bitmap of that range.  A key has at most one row for each range, whatever the facts;
    ids should be dense (:func:`civicpanel.operators.windows.extend_ids` numbers any key).
    Stored once, the table answers counts over any union of keys without the persons.
    """
    known = df.where(F.col(person).isNotNull())
    number = F.col(person).cast("bigint")
    return known.groupBy(*keys, F.bitmap_bucket_number(number).alias("bloco")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("pessoas")
    )


def merged_count(bitmaps: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """Distinct people per ``keys`` from stored bitmaps of finer keys."""
    merged = bitmaps.groupBy(*keys, "bloco").agg(F.bitmap_or_agg("pessoas").alias("pessoas"))
    return merged.groupBy(*keys).agg(F.sum(F.bitmap_count("pessoas")).alias(out))


def distinct_three_levels(
    bitmaps: DataFrame, municipality: str, state: str, out: str = "pessoas", country: str = "BR"
) -> DataFrame:
    """Distinct people per municipality, per state and for the country, from stored bitmaps.

    Returns ``id``, ``nivel`` and the count.  Rows without a municipality or state count
    on the levels above it.
    """
    levels = [
        (bitmaps.where(F.col(municipality).isNotNull()), F.col(municipality), "municipio"),
        (bitmaps.where(F.col(state).isNotNull()), F.col(state), "estado"),
        (bitmaps, F.lit(country), "pais"),
    ]
    counted = []
    for rows, place, level in levels:
        rows = rows.select(place.cast("string").alias("id"), "bloco", "pessoas")
        counted.append(merged_count(rows, ["id"], out).withColumn("nivel", F.lit(level)))
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


def distinct_composite(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], out: str
) -> DataFrame:
    """Distinct combinations of ``columns`` per key; one with a NULL part is not counted."""
    return df.groupBy(*keys).agg(F.count_distinct(*columns).alias(out))


def conditional_distinct(
    df: DataFrame, keys: Sequence[str], condition: Column, column: str, out: str
) -> DataFrame:
    """Distinct values among the rows that meet ``condition``; 0 when none does."""
    return df.groupBy(*keys).agg(F.count_distinct(F.when(condition, F.col(column))).alias(out))


def pivot_sum(
    df: DataFrame,
    keys: Sequence[str],
    category: str,
    values: Mapping[str, str],
    measure: str,
    counts: Mapping[str, str] | None = None,
) -> DataFrame:
    """One money sum per listed category, 0 where there is none, in one aggregate.

    ``values`` and ``counts`` map categories to output columns.
    """
    zero = F.lit(0).cast(MONEY)
    sums = [
        money(F.when(F.col(category) == value, F.col(measure)).otherwise(zero))
        .cast("double")
        .alias(out)
        for value, out in values.items()
    ]
    numbers = [
        F.count_if(F.col(category) == value).alias(out) for value, out in (counts or {}).items()
    ]
    return df.groupBy(*keys).agg(*sums, *numbers)


def pivot_year(
    df: DataFrame, keys: Sequence[str], year: str | Column, outputs: Mapping[int, str], value: str
) -> DataFrame:
    """The value of each listed year as one column; NULL where a year is missing."""
    column = F.col(year) if isinstance(year, str) else year
    return df.groupBy(*keys).agg(
        *[F.max(F.when(column == number, F.col(value))).alias(out) for number, out in outputs.items()]
    )


def share(df: DataFrame, keys: Sequence[str], condition: Column, out: str) -> DataFrame:
    """Rows that meet ``condition``, all rows, and their ratio."""
    counted = df.groupBy(*keys).agg(
        F.count_if(condition).alias(f"{out}_qtd"), F.count(F.lit(1)).alias(f"{out}_total")
    )
    return counted.withColumn(out, F.try_divide(F.col(f"{out}_qtd"), F.col(f"{out}_total")))


def coverage(
    beneficiaries: DataFrame, eligible: DataFrame, person: str, state: str
) -> DataFrame:
    """Distinct beneficiaries over distinct eligible people, per state and country.

    The country's numbers are counted on people, not added up from states.
    """
    served = distinct_by_level(beneficiaries, person, state, "beneficiarios")
    universe = distinct_by_level(eligible, person, state, "elegiveis")
    # Both sides have one row for each state; their sizes are known when they are counted.
    joined = universe.join(served, [state, "nivel"], "left")
    people = F.coalesce("beneficiarios", F.lit(0))
    return joined.withColumns(
        {
            "beneficiarios": people,
            "cobertura": F.try_divide(F.lit(100.0) * people, F.col("elegiveis")),
        }
    )


def list_agg(
    df: DataFrame, keys: Sequence[str], column: str, out: str, sep: str = ", ", distinct: bool = False
) -> DataFrame:
    """Values of a key as ordered text; NULL values are left out.

    With ``distinct`` repeated values are removed before the shuffle to the key, so a
    key holds its different values only.
    """
    rows = df.select(*keys, column).distinct() if distinct else df
    values = rows.select(*keys, F.col(column).cast("string").alias("_value"))
    listed = F.expr("listagg(_value, '{}') WITHIN GROUP (ORDER BY _value)".format(sep.replace("\\", "\\\\").replace("'", "\\'")))
    return values.groupBy(*keys).agg(listed.alias(out))


def any_flag(df: DataFrame, keys: Sequence[str], flags: Mapping[str, Column]) -> DataFrame:
    """1 if any row of the key meets the condition, else 0."""
    return df.groupBy(*keys).agg(
        *[F.max(F.when(condition, 1).otherwise(0)).alias(out) for out, condition in flags.items()]
    )


def dedupe_then_sum(
    df: DataFrame, entity: str, key: str, measures: Mapping[str, str], count: str
) -> DataFrame:
    """Counts and money sums per key with every entity taken once, by its maxima."""
    once = df.groupBy(entity).agg(
        F.max(key).alias(key), *[F.max(column).alias(out) for out, column in measures.items()]
    )
    return once.groupBy(key).agg(
        F.count(F.lit(1)).alias(count),
        *[
            F.coalesce(money(out), F.lit(0).cast(MONEY)).cast("double").alias(out)
            for out in measures
        ],
    )


# Labels of the number of missing items.
DEFICIT_LABELS = ("Atende a todos os itens", "Atende a 4 itens", "Atende a 3 itens")


def deficit(inverse: Sequence[str], direct: Sequence[str], null_as: int | None = None) -> Column:
    """Missing items of one row: inverse codes as they are, direct codes other than 1.

    A NULL inverse code makes the whole row unknown unless ``null_as`` replaces it.
    """
    codes = [F.col(c) if null_as is None else F.coalesce(c, F.lit(null_as)) for c in inverse]
    codes += [F.when(F.col(c) == 1, 0).otherwise(1) for c in direct]
    total = codes[0]
    for code in codes[1:]:
        total = total + code
    return total


def deficit_label(score: Column) -> Column:
    """Label of a summed score: none, one, two or more missing."""
    return (
        F.when(score >= 2, DEFICIT_LABELS[2])
        .when(score == 1, DEFICIT_LABELS[1])
        .when(score == 0, DEFICIT_LABELS[0])
    )


def deficit_score(
    df: DataFrame,
    keys: Sequence[str],
    inverse: Sequence[str],
    direct: Sequence[str],
    null_as: int | None = None,
) -> DataFrame:
    """Summed score of missing items per key, with its label."""
    scored = df.groupBy(*keys).agg(F.sum(deficit(inverse, direct, null_as)).alias("pontuacao"))
    return scored.withColumn("indice_infraestrutura", deficit_label(F.col("pontuacao")))


def band(total: Column, bounds: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the first bound that ``total`` does not exceed; the last label beyond all."""
    value = None
    for bound, name in zip(bounds, labels):
        value = F.when(total <= bound, name) if value is None else value.when(total <= bound, name)
    return value.otherwise(labels[len(bounds)])


def size_band(
    df: DataFrame,
    keys: Sequence[str],
    measure: Column,
    bounds: Sequence[float],
    labels: Sequence[str],
    out: str,
) -> DataFrame:
    """Summed measure per key and its size band."""
    return df.groupBy(*keys).agg(measure.alias("total")).withColumn(
        out, band(F.col("total"), bounds, labels)
    )


def majority(groups: Mapping[str, Column], total: Column, default: str, threshold: float = 0.6) -> Column:
    """First group whose share of ``total`` reaches ``threshold``; ``default`` otherwise."""
    value = None
    for name, part in groups.items():
        reached = F.try_divide(part, total) >= threshold
        value = F.when(reached, name) if value is None else value.when(reached, name)
    return value.otherwise(default)


def majority_group(
    df: DataFrame,
    keys: Sequence[str],
    groups: Mapping[str, Sequence[str]],
    total: str,
    out: str,
    default: str,
    threshold: float = 0.6,
) -> DataFrame:
    """The majority group per key, in the order of ``groups``; a group may add columns."""
    columns = sorted({name for names in groups.values() for name in names} | {total})
    sums = df.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in columns])

    def added(names: Sequence[str]) -> Column:
        value = F.col(names[0])
        for name in names[1:]:
            value = value + F.col(name)
        return value

    parts = {name: added(names) for name, names in groups.items()}
    return sums.withColumn(out, majority(parts, F.col(total), default, threshold))


def possession_pct(df: DataFrame, keys: Sequence[str], flags: Mapping[str, Column]) -> DataFrame:
    """Percentage of rows that meet each condition; unknown counts as not."""
    rows = F.count(F.lit(1))
    return df.groupBy(*keys).agg(
        *[(F.count_if(condition) / rows * 100).alias(out) for out, condition in flags.items()]
    )


def money_sum(df: DataFrame, keys: Sequence[str], column: str, out: str) -> DataFrame:
    """Sum to the cent with NULL as zero."""
    value = F.coalesce(F.col(column).cast(EXACT), F.lit(0).cast(EXACT))
    return df.groupBy(*keys).agg(money(value).cast("double").alias(out))


def distinct_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct combinations of columns."""
    return df.select(*columns).distinct()


def latest_flag(df: DataFrame, year: str, out: str = "ultimo_ano") -> DataFrame:
    """True for rows of the latest year, from a scalar subquery over that column only."""
    latest = df.agg(F.max(year)).scalar()
    return df.withColumn(out, F.coalesce(F.col(year) == latest, F.lit(False)))


def component_total(df: DataFrame, columns: Sequence[str], out: str) -> DataFrame:
    """The sum of component columns beside them; NULL if one is missing."""
    total = F.col(columns[0])
    for name in columns[1:]:
        total = total + F.col(name)
    return df.withColumn(out, total)


def multi_source_sum(
    sources: Sequence[DataFrame], keys: Sequence[str], sums: Mapping[str, str]
) -> DataFrame:
    """Sources with the same columns stacked and summed per key."""
    stacked = sources[0].select(*keys, *sums.values())
    for df in sources[1:]:
        stacked = stacked.unionByName(df.select(*keys, *sums.values()))
    return group_sum(stacked, keys, sums)


def grouped_detail(
    df: DataFrame, key: str, kind: str, value: str, default: str
) -> DataFrame:
    """Count and value in millions per key and kind; a NULL kind takes ``default``."""
    rows = df.withColumn(kind, F.coalesce(kind, F.lit(default)))
    grouped = rows.groupBy(key, kind).agg(
        F.count(F.lit(1)).alias("qtd"), money(value).alias("valor")
    )
    return grouped.withColumn("valor_milhoes", F.col("valor") * F.lit("0.000001").cast("decimal(6,6)"))


def deflate(
    df: DataFrame, index: DataFrame, year: str, factor: str, columns: Mapping[str, str]
) -> DataFrame:
    """Real values: money columns times the year's price index, rounded to the cent.

    ``columns`` maps nominal columns to outputs; a year without an index gives NULL.
    """
    joined = df.join(small_side(index), year, "left")
    real = {
        out: (F.col(column).cast(EXACT) * F.col(factor).cast("decimal(12,8)")).cast(MONEY)
        for column, out in columns.items()
    }
    return joined.withColumns(real).drop(factor)
