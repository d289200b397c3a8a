"""Course offer, student questionnaire and cost table of a training programme."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicpanel.functions import text
from civicpanel.functions.brazil import (
    MACRO_REGIONS,
    NAME_CORRECTIONS,
    NAME_PREFIX_CORRECTIONS,
    STATE_NAMES,
    UNKNOWN_REGION,
)
from civicpanel.functions.conversion import bounded_int
from civicpanel.operators import territory as terr
from civicpanel.sources.literals import literal_table
from civicpanel.sources.publish import enforce_schema

# Cost items of the programme.
COST_ITEMS = [
    ("Coordenador de Gestão", "1 por Instituição Executora", 41, 12, 1430.0, 703560.0),
    ("Coordenador Pedagógico", "1 por Instituição Ofertante", 650, 12, 1430.0, 11154000.0),
    ("Psicólogo / Pedagogo / Assistente Social", "1 por Instituição Ofertante", 650, 8, 1430.0, 7436000.0),
    ("Professores", "3 por Instituição Ofertante", 1950, 12, 1430.0, 33462000.0),
    ("Monitores", "3 por Instituição Ofertante", 1950, 8, 700.0, 10920000.0),
    ("Bolsistas", "40 por Instituição Ofertante", 26000, 8, 200.0, 41600000.0),
    ("Taxas administrativas (10%)", "-", None, None, None, 10527556.0),
]
COST_SCHEMA = (
    "elementos string, regra_calculo_pessoal string, qtd_pessoal bigint, "
    "meses_por_ano bigint, valor_unitario double, investimento_anual double"
)
OFFER_COLUMNS = ["instituicao", "campus", "turmas", "total_matriculas"]


def programme_costs(spark: SparkSession) -> DataFrame:
    """The cost items with their declared schema."""
    table = literal_table(spark, COST_ITEMS, COST_SCHEMA)
    return enforce_schema(table, table.schema)


def offer_panel(
    sources: Mapping[str, DataFrame],
    corrections: Mapping[str, str] = NAME_CORRECTIONS,
    prefixes: Mapping[str, str] = NAME_PREFIX_CORRECTIONS,
    regions: Mapping[str, Sequence[str]] = MACRO_REGIONS,
) -> DataFrame:
    """Course offer at three levels with a map coordinate per municipality.

    Sources: ``oferta``, ``filtro_territorio`` and ``instituicao``, which gives
    the coordinates.  Offers whose municipality is unknown are left out; see
    :func:`civicpanel.operators.territory.unmatched_report`.
    """
    territory = sources["filtro_territorio"]
    uf = F.trim("sigla_uf")
    offers = sources["oferta"].select(
        text.fix_names(F.col("municipio"), corrections, prefixes).alias("no_municipio"),
        uf.alias("uf"),
        text.classify(uf, regions, UNKNOWN_REGION).alias("regiao"),
        *OFFER_COLUMNS,
    )
    identified = terr.resolve_by_label(offers, territory, "no_municipio", "uf", out="codigo")
    coordinates = terr.institution_coordinates(sources["instituicao"])
    located = terr.attach_coordinates(identified, coordinates, "codigo", "id_ibge", bound=territory)
    expanded = terr.expand_ids(located.where(F.length("codigo") == 7), "codigo")
    labels = territory.select("id", F.col("municipio").alias("nome_territorio"), "estado", "titulo")
    return terr.attach_labels(labels, expanded.drop("codigo"))


def survey_panel(
    sources: Mapping[str, DataFrame],
    campus_columns: Sequence[str],
    state_names: Mapping[str, str] = STATE_NAMES,
    regions: Mapping[str, Sequence[str]] = MACRO_REGIONS,
    accent: bool = True,
) -> DataFrame:
    """Questionnaire answers at three levels, unresolved ones at country level only.

    Sources: ``questionario``, ``municipio`` and ``filtro_territorio``.
    """
    answers = sources["questionario"].select(
        F.col("id").alias("id_resposta"),
        "id_pessoa",
        "cpf",
        F.to_date("data_hora_inicio").alias("data_referencia"),
        F.col("municipio_residencia").alias("_cidade"),
        text.name_case(F.col("municipio_residencia")).alias("no_municipio_display"),
        text.state_code(F.col("estado_residencia"), state_names).alias("uf"),
        bounded_int(F.col("idade"), 10, 90).alias("idade"),
        F.col("sexo").alias("genero"),
        "cor_raca",
        F.col("instituicao_curso").alias("instituicao"),
        F.col("turno_curso").alias("turno"),
        F.coalesce(*campus_columns).alias("campus"),
        F.col("avaliacao_efetividade_aula").alias("avaliacao_aprendizado"),
        F.lit(1).cast("bigint").alias("qtd_matricula"),
        F.lit(None).cast("double").alias("valor_investimento"),
        F.lit(None).cast("bigint").alias("qtd_profissionais"),
    )
    resolved = terr.resolve_with_fallback(
        answers, sources["municipio"], "_cidade", "uf", "_codigo", "_uf_territorio", accent
    )
    described = resolved.withColumns(
        {
            "regiao": text.classify(F.coalesce("_uf_territorio", "uf"), regions, UNKNOWN_REGION),
            "id_turma_estimada": text.hash_key(F.col("instituicao"), F.col("campus"), F.col("turno")),
        }
    ).drop("_cidade", "_uf_territorio", "metodo")
    expanded = terr.expand_keep_unresolved(described, "_codigo").drop("_codigo")
    labels = sources["filtro_territorio"].select(
        "id", F.col("municipio").alias("nome_territorio"), "estado", "titulo"
    )
    return terr.attach_labels(labels, expanded)
