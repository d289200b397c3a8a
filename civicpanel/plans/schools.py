"""School census panels: infrastructure, special locations, possession rates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicpanel.functions.conversion import year_start
from civicpanel.functions.text import decode, name_case, presence
from civicpanel.operators import aggregate as agg
from civicpanel.operators.joins import full_join, join_on_cast
from civicpanel.operators.territory import COUNTRY_ID, territory_complete
from civicpanel.sizing import small_side

# Census codes and their labels.
NETWORKS = {"1": "Federal", "2": "Estadual", "3": "Municipal", "4": "Privada"}
LOCATIONS = {"1": "Urbana", "2": "Rural"}
SPECIAL_LOCATIONS = {"0": "Convencionais", "1": "Assentamento", "2": "Indígenas", "3": "Quilombolas"}
UNNAMED = "Sem informação"
SIZE_BOUNDS = [50, 150, 300, 500, 1000]
SIZE_LABELS = [
    "Até 50 matrículas",
    "De 51 a 150 matrículas",
    "De 151 a 300 matrículas",
    "De 301 a 500 matrículas",
    "De 501 a 1000 matrículas",
    "Mais de 1000 matrículas",
]
MAJORITIES = {
    "branca": "Maioria de alunos brancos (≥60%)",
    "preta_parda": "Maioria de alunos pretos ou pardos (≥60%)",
    "amarela": "Maioria de alunos amarelos (≥60%)",
    "indigena": "Maioria de alunos indígenas (≥60%)",
    "nao_declarada": "Maioria sem declaração (≥60%)",
}
NO_MAJORITY = "Sem maioria significativa (≥60%)"
COMMUNITY_CODE = "3"
COMMUNITY = "Quilombolas"
COMMUNITY_SCHOOLS = "Escolas quilombolas"
BLACK = "Negros (Pretos ou Pardos ≥60%)"
NOT_BLACK = "Não Negros"
BLACK_SCHOOLS = "Escolas predominantemente negras"
WHITE_SCHOOLS = "Escolas predominantemente brancas"
OTHER_SCHOOLS = "Outros"
BLACK_PEOPLE = "Pessoas Negras e Pardas"
OTHER_PEOPLE = "Outros Grupos Raciais"
INVERSE_ITEMS = ["agua_inexistente", "esgoto_inexistente", "energia_inexistente"]
DIRECT_ITEMS = ["internet", "local_funcionamento_predio_escolar"]
SUMS = {
    "quantidade_docente_educacao_basica": "quantidade_docente_educacao_basica",
    "quantidade_matricula_nao_declarada": "quantidade_matricula_cor_nao_declarada",
    "quantidade_matricula_branca": "quantidade_matricula_branca",
    "quantidade_matricula_preta": "quantidade_matricula_preta",
    "quantidade_matricula_parda": "quantidade_matricula_parda",
    "quantidade_matricula_amarela": "quantidade_matricula_amarela",
    "quantidade_matricula_indigena": "quantidade_matricula_indigena",
    "quantidade_matricula_educacao_basica": "quantidade_matricula_educacao_basica",
    "quantidade_matricula_infantil": "quantidade_matricula_infantil",
    "quantidade_matricula_fundamental_anos_iniciais": "quantidade_matricula_fundamental_anos_iniciais",
    "quantidade_matricula_fundamental_anos_finais": "quantidade_matricula_fundamental_anos_finais",
    "quantidade_matricula_medio": "quantidade_matricula_medio",
}
FACILITIES = {
    "cozinha": ["cozinha"],
    "refeitorio": ["refeitorio"],
    "patio": ["patio_coberto", "patio_descoberto"],
    "quadra_esportes": ["quadra_esportes", "quadra_esportes_coberta", "quadra_esportes_descoberta"],
    "laboratorio_ciencias": ["laboratorio_ciencias"],
    "laboratorio_informatica": ["laboratorio_informatica"],
    "material_pedagogico_etnico_racial": [
        "material_especifico_quilombola",
        "material_pedagogico_indigena",
        "material_pedagogico_etnico",
        "material_especifico_indigena",
    ],
}


def basic_flags() -> dict[str, Column]:
    """Conditions for the five basic items."""
    return {
        "agua": F.col("agua_inexistente") == 0,
        "esgoto": F.col("esgoto_inexistente") == 0,
        "energia": F.col("energia_inexistente") == 0,
        "internet": F.col("internet") == 1,
        "predio_escolar": F.col("local_funcionamento_predio_escolar") == 1,
    }


def facility_flags() -> dict[str, Column]:
    """Conditions for facilities; several columns of one facility are alternatives."""
    flags = {}
    for name, columns in FACILITIES.items():
        condition = F.col(columns[0]) == 1
        for column in columns[1:]:
            condition = condition | (F.col(column) == 1)
        flags[name] = condition
    return flags


def sums() -> list[Column]:
    return [F.sum(source).alias(out) for source, out in SUMS.items()]


def black_share_reached() -> Column:
    """Black and brown pupils are at least 60 % of all."""
    part = F.sum("quantidade_matricula_parda") + F.sum("quantidade_matricula_preta")
    return F.try_divide(part, F.sum("quantidade_matricula_educacao_basica")) >= 0.6


def white_share_reached() -> Column:
    part = F.sum("quantidade_matricula_branca")
    return F.try_divide(part, F.sum("quantidade_matricula_educacao_basica")) >= 0.6


def racial_majority() -> Column:
    """Label of the group with at least 60 % of the pupils."""
    parts = {
        MAJORITIES["branca"]: F.sum("quantidade_matricula_branca"),
        MAJORITIES["preta_parda"]: F.sum("quantidade_matricula_parda")
        + F.sum("quantidade_matricula_preta"),
        MAJORITIES["amarela"]: F.sum("quantidade_matricula_amarela"),
        MAJORITIES["indigena"]: F.sum("quantidade_matricula_indigena"),
        MAJORITIES["nao_declarada"]: F.sum("quantidade_matricula_nao_declarada"),
    }
    total = F.sum("quantidade_matricula_educacao_basica")
    return agg.majority(parts, total, NO_MAJORITY)


def named(schools: DataFrame, names: DataFrame) -> DataFrame:
    """School names attached after aggregation, in display case."""
    lookup = names.select(F.col("id_escola").alias("_codigo"), F.col("nome").alias("_nome"))
    joined = join_on_cast(schools, lookup, "id_escola", "_codigo")
    return joined.withColumn("nome_escola", name_case(F.col("_nome"), UNNAMED)).drop("_nome")


def infrastructure_panel(sources: Mapping[str, DataFrame]) -> DataFrame:
    """Every active school and year with its facilities, beside all municipalities.

    Sources: ``censo``, ``escola`` (names) and ``municipio``.  Municipalities
    without a school appear once.
    """
    census = agg.latest_flag(sources["censo"].withColumn("escolarizacao", F.col("escolarizacao").cast("string")), "ano")
    special = F.col("tipo_localizacao_diferenciada")
    community = special == COMMUNITY_CODE
    flags = {f"possui_{name}": condition for name, condition in {**basic_flags(), **facility_flags()}.items()}
    grouped = (
        census.where("escolarizacao = '1'")
        .groupBy(
            "ano", "ultimo_ano", F.col("id_municipio").cast("string").alias("id_municipio"), "id_escola",
            "rede", "tipo_localizacao", "tipo_localizacao_diferenciada",
        )
        .agg(
            *[F.max(presence(condition)).alias(out) for out, condition in flags.items()],
            *sums(),
            F.coalesce(black_share_reached(), F.lit(False)).alias("_negra"),
            F.coalesce(white_share_reached(), F.lit(False)).alias("_branca"),
        )
    )
    policy = named(grouped, sources["escola"]).select(
        "ano",
        "ultimo_ano",
        "id_municipio",
        "id_escola",
        "nome_escola",
        decode(F.col("rede"), NETWORKS).alias("rede"),
        decode(F.col("tipo_localizacao"), LOCATIONS).alias("localizacao"),
        special.alias("cod_infraestrutura"),
        decode(special, SPECIAL_LOCATIONS, "Outros").alias("infraestrutura"),
        *flags,
        F.when(community, COMMUNITY)
        .when(F.col("_negra"), BLACK)
        .otherwise(NOT_BLACK)
        .alias("maioria_racial_60_pct"),
        F.when(community, COMMUNITY_SCHOOLS)
        .when(F.col("_negra"), BLACK_SCHOOLS)
        .when(F.col("_branca"), WHITE_SCHOOLS)
        .otherwise(OTHER_SCHOOLS)
        .alias("predominancia_racial_especifica"),
        F.when(F.col("_negra"), BLACK_PEOPLE)
        .otherwise(OTHER_PEOPLE)
        .alias("grupo_racial_dashboard"),
        *SUMS.values(),
    )
    master = sources["municipio"].withColumnRenamed("nome", "nome_municipio")
    places = sources["censo"].where(F.col("escolarizacao").cast("string") == "1").select(
        F.col("id_municipio").cast("string").alias("id_municipio")
    )
    return full_join(policy, master, ["id_municipio"], left_keys=places)


def census_policy(
    census: DataFrame,
    names: DataFrame,
    year: int | None = None,
    special_location: str | None = None,
    possession: bool = False,
) -> DataFrame:
    """Census rows reduced to schools with flags, deficit score, size and majority.

    ``possession`` adds facility flags to the keys, percentages per facility and
    the two-group racial label.
    """
    flagged = agg.latest_flag(census, "ano").where(F.col("escolarizacao").cast("string") == "1")
    if year is not None:
        flagged = flagged.where(F.col("ano") == year)
    if special_location is not None:
        flagged = flagged.where(F.col("tipo_localizacao_diferenciada") == special_location)
    keys = ["ano", "ultimo_ano", "id_municipio", "id_escola", "rede", "localizacao"]
    conditions = basic_flags()
    extra = facility_flags() if possession else {}
    # The flags are keys too, and some share a name with their source column.
    items = [
        presence(condition).alias("internet_escola" if possession and name == "internet" else name)
        for name, condition in conditions.items()
    ]
    items += [presence(condition).alias(f"possui_{name}") for name, condition in extra.items()]
    special = F.col("tipo_localizacao_diferenciada")
    labels = [
        F.col("id_municipio").cast("string").alias("id_municipio"),
        decode(F.col("rede"), NETWORKS).alias("rede"),
        decode(F.col("tipo_localizacao"), LOCATIONS).alias("localizacao"),
    ]
    if possession:
        keys += ["cod_infraestrutura", "infraestrutura"]
        labels += [
            special.alias("cod_infraestrutura"),
            decode(special, SPECIAL_LOCATIONS, "Outros").alias("infraestrutura"),
        ]
    rows = flagged.select(
        "ano",
        "ultimo_ano",
        "id_escola",
        *labels,
        *items,
        agg.deficit(INVERSE_ITEMS, DIRECT_ITEMS).alias("_deficit"),
        *SUMS,
    )
    item_names = [column for column in rows.columns if column not in {*keys, "_deficit", *SUMS}]
    score = F.sum("_deficit")
    measures = [
        score.alias("num_indice_infraestrutura_elementar"),
        agg.deficit_label(score).alias("indice_infraestrutura_elementar"),
        agg.band(F.sum("quantidade_matricula_educacao_basica"), SIZE_BOUNDS, SIZE_LABELS).alias("porte_escola"),
        racial_majority().alias("maioria_racial_60_pct"),
        *sums(),
    ]
    if possession:
        measures.append(
            F.when(black_share_reached(), BLACK_PEOPLE)
            .otherwise(OTHER_PEOPLE)
            .alias("grupo_racial_dashboard")
        )
        measures += [
            (F.count_if(F.col(f"possui_{name}") == 1) / F.count(F.lit(1)) * 100).alias(f"pct_{name}")
            for name in extra
        ]
    grouped = rows.groupBy(*keys, *item_names).agg(*measures)
    policy = named(grouped, names)
    if possession:
        return policy
    return policy.withColumn("ano_tratado", year_start(F.col("ano"))).drop("ano")


def census_panel(
    sources: Mapping[str, DataFrame],
    year: int | None = 2024,
    special_location: str | None = "3",
    possession: bool = False,
    map_codes: Mapping[str, str] | None = None,
) -> DataFrame:
    """School rows under every territory, with map labels.

    Sources: ``censo``, ``escola``, ``municipio`` and ``filtro_territorio``.  The
    ids come from the dimension, so a municipality without schools keeps its
    place at all three levels.  ``possession=True`` with no filters gives the
    panel with possession rates.
    """
    territory = sources["filtro_territorio"]
    policy = census_policy(sources["censo"], sources["escola"], year, special_location, possession)
    state = F.col("estado")
    map_state = state
    for name, code in (map_codes or {"Distrito Federal": "BR-DF"}).items():
        map_state = F.when(state == name, code).otherwise(map_state)
    master = sources["municipio"].select(
        F.col("id_municipio").alias("id"), F.col("nome").alias("nome_municipio"), "sigla_uf", "nome_uf"
    )
    places = (
        territory.where(F.length("id") == 7)
        .join(small_side(master), "id", "left")
        .select(
            F.col("id").alias("id_municipio"),
            "nome_municipio",
            "sigla_uf",
            map_state.alias("estado_mapa"),
            F.col("titulo").alias("_titulo"),
            F.col("nome_uf").alias("_nome_uf"),
        )
    )
    base = territory_complete(places, policy, "id_municipio")

    def level(code: Column, tip: str) -> Column:
        return F.struct(code.alias("id"), F.col(tip).alias("dica_mapa"))

    code = F.col("id_municipio")
    levels = F.array(
        level(code, "_titulo"),
        level(F.left(code, F.lit(2)), "_nome_uf"),
        level(F.lit(COUNTRY_ID), "_nome_uf"),
    )
    kept = [name for name in base.columns if name not in ("_titulo", "_nome_uf")]
    labels = territory.select("id", "municipio", "estado")
    return base.select(*kept, F.inline(levels)).join(small_side(labels, territory), "id")


def possession_panel(sources: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Possession rates of active schools over the caller's keys."""
    active = sources["censo"].where(F.col("escolarizacao").cast("string") == "1")
    flags = {f"pct_{name}": condition for name, condition in facility_flags().items()}
    return agg.possession_pct(active, keys, flags)
