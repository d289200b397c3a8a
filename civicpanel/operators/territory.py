"""Three-level territory: municipality (7 digits), state (2 digits), country.

``municipalities`` is the master table: one row per municipality with
``id_municipio``, ``nome``, ``id_uf``, ``sigla_uf``, ``nome_uf`` and, where a
function says so, ``nome_regiao``, ``capital_uf`` and ``centroide``.
``territory`` is the dimension that :func:`build_territory` makes from it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicpanel.functions.geography import point_parts
from civicpanel.functions.text import name_key, plain_text
from civicpanel.operators.aggregate import money
from civicpanel.operators.windows import first_per_key
from civicpanel.sizing import small_side, within

COUNTRY_ID = "99"
ALL = "Todos"
COUNTRY_NAME = "Brasil"
LEVELS = ("municipio", "estado", "pais")
ROLLUP_LEVELS = ("Municipio", "Estado", "Nacional")


def label(name: Column, uf: Column) -> Column:
    """``Name - UF``, the form in which the dimension stores municipalities."""
    return F.concat(name, F.lit(" - "), uf)


def build_territory(municipalities: DataFrame) -> DataFrame:
    """The dimension ``id, municipio, estado, titulo`` with all three levels."""
    named = label(F.col("nome"), F.col("sigla_uf"))

    def row(ident: Column, municipio: Column, estado: Column, titulo: Column) -> Column:
        return F.struct(
            ident.alias("id"),
            municipio.alias("municipio"),
            estado.alias("estado"),
            titulo.alias("titulo"),
        )

    every = F.lit(ALL)
    levels = F.array(
        row(F.col("id_municipio"), named, F.col("nome_uf"), named),
        row(F.col("id_uf"), every, F.col("nome_uf"), every),
        row(F.lit(COUNTRY_ID), every, every, every),
    )
    return municipalities.select(F.inline(levels)).distinct()


# --- resolving names and codes ------------------------------------------------


def resolve_by_label(
    df: DataFrame, territory: DataFrame, name: str, uf: str, out: str = "id"
) -> DataFrame:
    """Territory id by the ``Name - UF`` label; NULL when nothing matches."""
    dimension = territory.where(F.length("id") == 7).select(
        F.trim("municipio").alias("_label"), F.col("id").alias(out)
    )
    keyed = df.withColumn("_label", F.trim(label(F.col(name), F.trim(F.col(uf)))))
    return keyed.join(small_side(dimension, territory), "_label", "left").drop("_label")


def resolve_by_name_uf(
    df: DataFrame,
    municipalities: DataFrame,
    name: str,
    uf: str,
    columns: Mapping[str, str] | None = None,
) -> DataFrame:
    """Municipality by name and state code, since names repeat across states.

    ``columns`` maps columns of the master table to output names.
    """
    columns = columns or {"id_municipio": "id"}
    dimension = municipalities.select(
        F.lower(F.trim("nome")).alias("_name"),
        F.trim("sigla_uf").alias("_uf"),
        *[F.col(source).alias(out) for source, out in columns.items()],
    )
    keyed = df.withColumns({"_name": F.lower(F.trim(F.col(name))), "_uf": F.trim(F.col(uf))})
    return keyed.join(small_side(dimension, municipalities), ["_name", "_uf"], "left").drop(
        "_name", "_uf"
    )


def resolve_with_fallback(
    df: DataFrame,
    municipalities: DataFrame,
    name: str,
    uf: str,
    out: str = "id",
    out_uf: str = "uf_territorio",
    accent: bool = True,
) -> DataFrame:
    """Municipality by name and state, and by name alone where that fails.

    The second chance uses only names that are unique in the country, so it
    never multiplies rows; ``metodo`` tells which way a row was resolved.
    """
    dimension = municipalities.select(
        name_key(F.col("nome"), accent).alias("_name"),
        F.col("sigla_uf").alias("_uf"),
        F.col("id_municipio").alias("_id1"),
    ).dropDuplicates(["_name", "_uf"])
    unique = (
        dimension.groupBy(F.col("_name").alias("_second"))
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_id1").alias("_id2"), F.min("_uf").alias("_uf2"))
        .where("_n = 1")
        .drop("_n")
    )
    keyed = df.withColumns({"_name": name_key(F.col(name), accent), "_uf": F.col(uf)})
    first = keyed.join(small_side(dimension, municipalities), ["_name", "_uf"], "left")
    missed = first.withColumn("_second", F.when(F.col("_id1").isNull(), F.col("_name")))
    both = missed.join(small_side(unique, municipalities), "_second", "left")
    method = F.when(F.col("_id1").isNotNull(), "nome e uf").when(F.col("_id2").isNotNull(), "nome")
    return both.withColumns(
        {
            out: F.coalesce("_id1", "_id2"),
            out_uf: F.coalesce(F.when(F.col("_id1").isNotNull(), F.col("_uf")), "_uf2"),
            "metodo": method,
        }
    ).drop("_name", "_uf", "_second", "_id1", "_id2", "_uf2")


def ambiguous_names(municipalities: DataFrame, accent: bool = True) -> DataFrame:
    """Names that several municipalities share, which need the state to resolve."""
    return (
        municipalities.groupBy(name_key(F.col("nome"), accent).alias("_nome"))
        .agg(F.count_distinct("id_municipio").alias("qtd"))
        .where("qtd > 1")
        .select(plain_text(F.col("_nome")).alias("nome"), "qtd")
    )


def municipality_points(municipalities: DataFrame) -> DataFrame:
    """The master rows that have a centroid, with coordinates and ``coordenada`` text."""
    return point_coordinates(municipalities, "centroide")


def point_coordinates(df: DataFrame, wkt: str) -> DataFrame:
    """Latitude, longitude and ``lat,lon`` text of WKT points; rows without one are dropped."""
    latitude, longitude = point_parts(F.col(wkt))
    return (
        df.where(F.col(wkt).isNotNull())
        .withColumns({"latitude": latitude, "longitude": longitude})
        .withColumn(
            "coordenada",
            F.concat(F.col("latitude").cast("string"), F.lit(","), F.col("longitude").cast("string")),
        )
    )


def capital_per_state(municipalities: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``columns`` of the capital of every state, the lowest id if several are flagged."""
    first = F.min_by(F.struct(*columns), "id_municipio").alias("_first")
    capitals = municipalities.where(F.col("capital_uf") == 1)
    grouped = capitals.groupBy("id_uf", "sigla_uf", "nome_uf", "nome_regiao").agg(first)
    return grouped.select("id_uf", "sigla_uf", "nome_uf", "nome_regiao", "_first.*")


def resolve_mixed_codes(df: DataFrame, municipalities: DataFrame, code: str) -> DataFrame:
    """Rows coded by municipality (7) or state (2) with id, state, region and coordinates.

    State codes take the coordinates of the capital.  Both kinds are resolved
    by one join; rows with any other code are dropped.
    """
    points = municipality_points(municipalities)
    shared = ["id_uf", "nome_uf", F.col("nome_regiao").alias("regiao")]
    place = ["latitude", "longitude", "coordenada"]
    codes = points.select(F.trim("id_municipio").alias("_code"), *shared, *place).where(
        F.length("_code") == 7
    )
    states = capital_per_state(points, place).select(F.trim("id_uf").alias("_code"), *shared, *place)
    dimension = codes.unionByName(states.where(F.length("_code") == 2))
    keyed = df.withColumn("_code", F.trim(F.col(code)))
    joined = keyed.join(small_side(dimension, municipalities), "_code")
    return joined.withColumnRenamed("_code", "id")


def one_per_place(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per place, the first by ``order``."""
    return first_per_key(df, [key], [F.col(name).asc_nulls_first() for name in order])


def institution_coordinates(df: DataFrame) -> DataFrame:
    """One coordinate per municipality from a table of institutions.

    ``df`` has ``id_ibge``, ``unidade`` and text ``latitude``/``longitude`` with
    decimal commas; rows without coordinates are left out.
    """
    filled = df.where((F.trim("latitude") != "") & (F.trim("longitude") != "")).where(
        F.col("id_ibge").isNotNull()
    )
    cleaned = filled.select(
        F.col("id_ibge").cast("string").alias("id_ibge"),
        "unidade",
        F.translate("latitude", ",", ".").alias("latitude"),
        F.translate("longitude", ",", ".").alias("longitude"),
    )
    single = one_per_place(cleaned, "id_ibge", ["unidade", "latitude", "longitude"])
    joined = F.concat("latitude", F.lit(","), "longitude")
    return single.drop("unidade").withColumn("coordenada", joined)


def attach_coordinates(
    df: DataFrame,
    coordinates: DataFrame,
    key: str,
    coordinates_key: str,
    bound: DataFrame | None = None,
    bound_key: str = "id",
) -> DataFrame:
    """Coordinates by territory id; rows without one keep NULL.

    ``bound`` may give the dimension whose ``bound_key`` lists the ids; ``coordinates`` then
    has one row for each id and is reduced to them.
    """
    right = coordinates.withColumnRenamed(coordinates_key, "_place")
    right = small_side(right) if bound is None else within(right, bound, "_place", bound_key)
    joined = df.join(right, F.col(key) == F.col("_place"), "left")
    return joined.drop("_place")


# --- expanding rows to levels ---------------------------------------------------


def expand_levels(
    df: DataFrame,
    id_column: str,
    name: str,
    uf: str,
    state: str,
    municipalities_only: bool = True,
    label_with_uf: bool = True,
    country_values: Mapping[str, str] | None = None,
) -> DataFrame:
    """Every row once per level, with filter fields, display fields and level tag.

    ``estado``/``municipio`` hold ``Todos`` above their level and serve filters;
    ``estado_nome``/``municipio_nome`` always hold the real names.  The rows are
    repeated in one pass over ``df`` without a shuffle; sums over the result
    must first select one level (:func:`select_level`).

    ``country_values`` replaces columns at country level, and
    ``municipalities_only=False`` also takes rows coded by state.
    """
    ident = F.col(id_column)
    rows = df.where(F.length(ident) == 7) if municipalities_only else df.where(ident.isNotNull())
    full, every = label(F.col(name), F.col(uf)), F.lit(ALL)
    country_values = country_values or {}

    def level(tag, code, estado, municipio, place, title, replaced) -> Column:
        fields = {
            "id": code,
            "nivel_territorial": F.lit(tag),
            "estado": estado,
            "municipio": municipio,
            "estado_nome": F.col(state),
            "municipio_nome": F.col(name),
            "nome_territorio": place,
            "titulo": title,
        }
        for column in country_values:
            fields[column] = F.lit(replaced[column]) if replaced else F.col(column)
        return F.struct(*[value.alias(out) for out, value in fields.items()])

    shown = full if label_with_uf else F.col(name)
    levels = F.array(
        level(LEVELS[0], ident, F.col(state), shown, full, full, None),
        level(LEVELS[1], F.left(ident, F.lit(2)), F.col(state), every, every, F.col(state), None),
        level(LEVELS[2], F.lit(COUNTRY_ID), every, every, every, F.lit(COUNTRY_NAME), country_values),
    )
    made = {
        "id", "nivel_territorial", "estado", "municipio", "estado_nome", "municipio_nome",
        "nome_territorio", "titulo", id_column, *country_values,
    }
    kept = [column for column in df.columns if column not in made]
    return rows.select(*kept, F.inline(levels))


def expand_ids(df: DataFrame, code: str, out: str = "id") -> DataFrame:
    """Every row at its own code, its state and the country; one pass, no labels."""
    ident = F.col(code)
    ids = F.array(ident, F.left(ident, F.lit(2)), F.lit(COUNTRY_ID))
    return df.where(ident.isNotNull()).withColumn(out, F.explode(ids))


def expand_keep_unresolved(df: DataFrame, code: str, out: str = "id") -> DataFrame:
    """As :func:`expand_ids`; rows without a code are kept at country level only."""
    ident = F.col(code)
    ids = F.when(ident.isNull(), F.array(F.lit(COUNTRY_ID))).otherwise(
        F.array(ident, F.left(ident, F.lit(2)), F.lit(COUNTRY_ID))
    )
    return df.withColumn(out, F.explode(ids))


def rollup_levels(
    df: DataFrame,
    uf: str,
    municipality: str,
    measures: Mapping[str, Column],
    keys: Sequence[str] = (),
    states: DataFrame | None = None,
) -> DataFrame:
    """Additive ``measures`` summed per municipality, state and country.

    ``measures`` maps outputs to the expressions to sum.  Facts are reduced to
    municipalities first, and only that small result is grouped into levels.
    ``uf`` reads ``Todos`` at country level only; ``estado`` reads ``Todos``
    wherever ``municipio`` does; ``estado_nome`` falls back to ``Brasil`` and
    ``municipio_nome`` is NULL above the municipality.  ``states`` has ``sigla``
    and ``nome``.
    """
    base = df.groupBy(
        F.col(uf).alias("_uf"), F.col(municipality).alias("_municipio"), *keys
    ).agg(*[F.sum(value).alias(out) for out, value in measures.items()])
    extra = [F.col(key) for key in keys]
    sets = [
        [F.col("_uf"), F.col("_municipio"), *extra],
        [F.col("_uf"), *extra],
        [*extra],
    ]
    levels = base.groupingSets(sets, F.col("_uf"), F.col("_municipio"), *extra).agg(
        F.grouping("_uf").alias("_no_uf"),
        F.grouping("_municipio").alias("_no_municipio"),
        *[F.sum(out).alias(out) for out in measures],
    )
    tagged = levels.select(
        F.when(F.col("_no_uf") == 1, ALL).otherwise(F.col("_uf")).alias("uf"),
        F.when(F.col("_no_municipio") == 1, ALL).otherwise(F.col("_municipio")).alias("municipio"),
        F.when(F.col("_no_uf") == 1, ROLLUP_LEVELS[2])
        .when(F.col("_no_municipio") == 1, ROLLUP_LEVELS[1])
        .otherwise(ROLLUP_LEVELS[0])
        .alias("nivel_agregacao"),
        *keys,
        *measures,
    )
    if states is None:
        return tagged
    names = states.select(F.col("sigla").alias("uf"), F.col("nome").alias("_nome_estado"))
    above = F.col("nivel_agregacao") != ROLLUP_LEVELS[0]
    return (
        tagged.join(small_side(names, states), "uf", "left")
        .withColumns(
            {
                "estado": F.when(above, ALL).otherwise(F.col("_nome_estado")),
                "estado_nome": F.coalesce("_nome_estado", F.lit(COUNTRY_NAME)),
                "municipio_nome": F.when(~above, F.col("municipio")),
            }
        )
        .drop("_nome_estado")
    )


# --- selecting one level ----------------------------------------------------------


def select_level(df: DataFrame, estado: str = ALL, municipio: str = ALL) -> DataFrame:
    """Rows of exactly one level, as the dashboard's two filters select them."""
    if estado == ALL and municipio != ALL:
        raise ValueError("a municipality needs its state")
    tag = LEVELS[2] if estado == ALL else LEVELS[1] if municipio == ALL else LEVELS[0]
    rows = df.where((F.col("estado") == estado) & (F.col("municipio") == municipio))
    return rows.where(F.col("nivel_territorial") == tag) if "nivel_territorial" in df.columns else rows


def big_number(
    df: DataFrame, metric: str, estado: str = ALL, municipio: str = ALL, out: str | None = None
) -> DataFrame:
    """The sum of a money ``metric`` at one level, as one row."""
    total = money(metric).cast("double")
    return select_level(df, estado, municipio).agg(
        total.alias(out or metric), F.count(F.lit(1)).alias("linhas")
    )


def big_numbers(
    facts: DataFrame,
    metric: str,
    chosen: Mapping[str, tuple[str, str]],
    code: str,
    name: str,
    uf: str,
    state: str,
    out: str | None = None,
) -> DataFrame:
    """The :func:`big_number` of several (state, municipality) choices, from one pass over the facts.

    The facts are at municipality level; ``chosen`` maps a label (``nivel``) to a choice of
    the dashboard's two filters.  Nothing is expanded: every choice is a condition.
    """
    place = label(F.col(name), F.col(uf))
    parts = []
    for level, (estado, municipio) in chosen.items():
        if estado == ALL and municipio != ALL:
            raise ValueError("a municipality needs its state")
        wanted = F.lit(True)
        if estado != ALL:
            wanted = wanted & (F.col(state) == estado)
        if municipio != ALL:
            wanted = wanted & (place == municipio)
        parts.append(
            F.struct(
                money(F.when(wanted, F.col(metric))).cast("double").alias(out or metric),
                F.count_if(wanted).alias("linhas"),
                F.lit(level).alias("nivel"),
            )
        )
    return facts.where(F.col(code).isNotNull()).agg(F.array(*parts).alias("p")).select(F.inline("p"))


# --- completing and labelling -----------------------------------------------------


def territory_complete(
    territory: DataFrame, df: DataFrame, on: str = "id", used: DataFrame | None = None
) -> DataFrame:
    """All territories with their rows of ``df``; those without rows appear once.

    Same result as ``territory LEFT JOIN df``.  Country rows may be a third of
    ``df``, so ``df`` is not shuffled by ``on``: the labels are joined to it, and
    the territories that occur nowhere are added.  ``used`` may give the ids of
    ``df`` from a cheaper source than ``df`` itself.
    """
    labelled = df.join(small_side(territory), on)
    ids = territory.join((df if used is None else used).select(on).distinct(), on, "left_semi")
    used = ids.select(on)
    absent = territory.join(small_side(used, territory), on, "left_anti")
    return labelled.unionByName(absent, allowMissingColumns=True)


def attach_labels(territory: DataFrame, df: DataFrame, on: str = "id") -> DataFrame:
    """All rows of ``df`` with the territory's labels, NULL for unknown ids."""
    return df.join(small_side(territory), on, "left")


def territory_year_spine(territory: DataFrame, years: DataFrame, year: str) -> DataFrame:
    """Every territory once per distinct year.

    The distinct years reach the rows as one array value, not through a join.
    """
    every_year = years.select(year).distinct().agg(F.sort_array(F.collect_list(year)))
    return territory.withColumn(year, F.explode(every_year.scalar()))


def map_labels(df: DataFrame, estado: str, titulo: str, overrides: Mapping[str, str]) -> DataFrame:
    """State label for maps, with the map service's own codes, and the tooltip."""
    value = F.col(estado)
    for name, code in overrides.items():
        value = F.when(F.col(estado) == name, F.lit(code)).otherwise(value)
    return df.withColumns({"estado_mapa": value, "dica_mapa": F.col(titulo)})


# --- participation ------------------------------------------------------------------


def adhesion_spine(municipalities: DataFrame, answers: DataFrame, code: str) -> DataFrame:
    """All municipalities and all states with their answers, if any.

    ``answers`` is keyed by ``code``: a municipality id or a two-letter state
    code.  Flags tell the two kinds of row apart.
    """
    own = answers.distinct()
    values = [name for name in answers.columns if name != code]
    masters = municipalities.select(
        F.col("id_municipio").alias("cod_ibge"),
        "sigla_uf",
        label(F.col("nome"), F.col("sigla_uf")).alias("nome"),
    )
    cities = masters.join(
        own.where(F.length(code) > 2).withColumnRenamed(code, "cod_ibge"), "cod_ibge", "left"
    )
    states = municipalities.select(
        F.col("id_uf").alias("cod_ibge"), "sigla_uf", F.col("sigla_uf").alias("nome")
    ).distinct()
    state_rows = states.join(
        own.where(F.length(code) == 2).withColumnRenamed(code, "sigla_uf"), "sigla_uf", "left"
    )
    columns = ["cod_ibge", "sigla_uf", "nome", *values]

    def flagged(df: DataFrame, is_city: bool) -> DataFrame:
        return df.select(
            *columns,
            F.lit(is_city).alias("indicador_municipio"),
            F.lit(not is_city).alias("indicador_uf"),
        )

    return flagged(cities, True).distinct().unionByName(flagged(state_rows, False))


def or_key_join(
    left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_key: str, left_id: Sequence[str]
) -> DataFrame:
    """Left join where any of ``left_keys`` equals ``right_key``.

    The distinct candidate keys of a row are exploded and joined by equality,
    so a pair matches at most once and no nested-loop join is needed.  The left
    rows without a partner are added, which leaves the large join an inner one:
    a small left side is broadcast, and a hot key of a large one can be split.
    ``left_id`` identifies a left row; a NULL in it is a value like any other.
    """
    trimmed = [F.trim(F.col(key)) for key in left_keys]
    candidates = F.array_distinct(F.array_compact(F.array(*trimmed)))
    exploded = left.withColumn("_candidate", F.explode(candidates))
    keyed = right.withColumn("_candidate", F.trim(F.col(right_key)))
    matched = keyed.join(small_side(exploded, left), "_candidate").drop("_candidate")
    partnered = exploded.join(keyed.select("_candidate").distinct(), "_candidate", "left_semi")
    known = partnered.select(*[F.col(name).alias(f"_known_{name}") for name in left_id]).distinct()
    same = reduce(and_, [F.col(name).eqNullSafe(F.col(f"_known_{name}")) for name in left_id])
    lonely = left.join(known, same, "left_anti")
    return matched.unionByName(lonely, allowMissingColumns=True)


def membership_flag(
    df: DataFrame, key: str, members: DataFrame | Sequence[str], out: str, members_key: str | None = None
) -> DataFrame:
    """1 where ``key`` is in the list, else 0; the list is a frame or literals."""
    if not isinstance(members, DataFrame):
        return df.withColumn(out, F.when(F.col(key).isin(list(members)), 1).otherwise(0))
    listed = members.select(F.col(members_key or key).alias(key)).distinct()
    marked = df.join(small_side(listed.withColumn("_member", F.lit(1))), key, "left")
    return marked.withColumn(out, F.coalesce("_member", F.lit(0))).drop("_member")


def inherited_participation(
    df: DataFrame, state: str, participates: str, out: str, bound: DataFrame, bound_key: str | None = None
) -> DataFrame:
    """True for every row of a state in which any row participates.

    ``bound`` is the dimension whose column ``bound_key`` (``state``) lists the states.
    """
    flags = df.groupBy(state).agg(F.bool_or(F.coalesce(participates, F.lit(False))).alias(out))
    return df.join(within(flags, bound, state, bound_key), state, "left")


def unmatched_report(df: DataFrame, id_column: str, names: Sequence[str]) -> DataFrame:
    """Names that resolved to no territory, with their row counts."""
    missing = df.where(F.col(id_column).isNull())
    return missing.groupBy(*names).agg(F.count(F.lit(1)).alias("linhas"))
