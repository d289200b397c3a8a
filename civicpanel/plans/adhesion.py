"""Exam adhesion panels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicpanel.functions.brazil import STATE_IDS
from civicpanel.functions.text import decode, status_default
from civicpanel.lineage import written
from civicpanel.operators import territory as terr
from civicpanel.operators.territory import COUNTRY_ID
from civicpanel.sizing import small_side
from civicpanel.sources.literals import literal_table

# Answers of the vacancy form and their codes.
ESTIMATES = {
    "Até 100 professores": "AO01",
    "Mais de 100 professores": "AO02",
    "Mais de 500 professores": "AO03",
    "Mais de 1000 professores": "AO04",
    "Mais de 5000 professores": "AO05",
    "Ainda não tenho estimativa": "AO06",
}
NO_ESTIMATE, NO_ESTIMATE_SHOWN = "Ainda não tenho estimativa", "Ainda sem estimativa"
NO_ANSWER, NO_ANSWER_CODE = "Sem resposta", "AO99"
# States that take part by their own answer.
PARTICIPATING_STATES = [
    "AC", "BA", "CE", "DF", "ES", "MS", "MT", "PE", "PI", "PR", "RN", "RO", "RR", "RS", "SC",
    "SE", "SP", "TO",
]


def adhesion_panel(sources: Mapping[str, DataFrame], estimates: Mapping[str, str] = ESTIMATES) -> DataFrame:
    """Adhesion of municipalities and states with vacancy estimates, at three levels.

    Sources: ``resposta`` and ``estimativa`` (both keyed by ``codigo_acesso`` with
    ``submissao``), ``municipio`` and ``filtro_territorio``.  Publish it clustered
    by ``estado, municipio``.
    """
    submitted = sources["resposta"].where("submissao").select("codigo_acesso", "submissao").distinct()
    vacancies = (
        sources["estimativa"]
        .where("submissao")
        .select(
            "codigo_acesso",
            "estimativa_vaga",
            decode(F.col("estimativa_vaga"), estimates).alias("cod_estimativa"),
        )
        .distinct()
    )
    answers = submitted.join(vacancies, "codigo_acesso", "left").select(
        "codigo_acesso", "estimativa_vaga", "cod_estimativa", "submissao"
    )
    # A row for each place and estimate; the spine and its completion read it several times.
    answers = written(answers)
    spine = terr.adhesion_spine(sources["municipio"], answers, "codigo_acesso")
    state_and_country = F.array(F.left("cod_ibge", F.lit(2)), F.lit(COUNTRY_ID))
    ids = F.when(
        F.col("indicador_municipio"), F.concat(F.array("cod_ibge"), state_and_country)
    ).otherwise(state_and_country)
    levels = spine.withColumn("id", F.explode(ids))
    labels = sources["filtro_territorio"].select("id", "estado", "municipio")
    panel = terr.territory_complete(labels, levels)
    flag, shown = F.col("submissao"), F.col("estimativa_vaga")
    answer = F.when(shown == NO_ESTIMATE, NO_ESTIMATE_SHOWN).otherwise(shown)
    return panel.select(
        "id",
        "estado",
        "municipio",
        "sigla_uf",
        "cod_ibge",
        "nome",
        status_default(flag, answer, NO_ANSWER).alias("estimativa_vaga"),
        status_default(flag, F.col("cod_estimativa"), NO_ANSWER_CODE).alias("id_estimativa"),
        "submissao",
        "indicador_municipio",
        "indicador_uf",
    ).distinct()


def adhesion_full_panel(
    sources: Mapping[str, DataFrame],
    states: Sequence[str] = PARTICIPATING_STATES,
    state_ids: Mapping[str, str] = STATE_IDS,
) -> DataFrame:
    """Every territory with its adhesion date and participation flags.

    Sources: ``filtro_territorio``, ``adesao`` (``codigo_acesso``, ``data_envio``)
    and ``municipios_aprovados`` (``id``).  A code is a municipality id or a
    state's two letters.
    """
    territory = sources["filtro_territorio"]
    codes = literal_table(
        territory.sparkSession,
        [(number, code) for code, number in state_ids.items()],
        "id string, _uf string",
    )
    spine = territory.join(small_side(codes), "id", "left")
    adhesion = sources["adesao"].select("codigo_acesso", F.col("data_envio").alias("data_adesao"))
    joined = terr.or_key_join(spine, adhesion, ["id", "_uf"], "codigo_acesso", ["id"])
    flagged = terr.membership_flag(
        joined, "codigo_acesso", sources["municipios_aprovados"], "participa_municipio", "id"
    )
    flagged = terr.membership_flag(flagged, "codigo_acesso", states, "participa_estado")
    return flagged.select(
        "id", "municipio", "estado", "titulo", "data_adesao", "participa_municipio", "participa_estado"
    )


def inherited_adhesion(sources: Mapping[str, DataFrame]) -> DataFrame:
    """Municipalities with own and inherited participation of their state.

    Sources: ``municipio`` and ``adesao``.  A state takes part if it answered or
    if any of its municipalities did.
    """
    codes = sources["adesao"].select(F.trim("codigo_acesso").alias("_codigo")).distinct()
    master = sources["municipio"].select("id_municipio", "nome", "id_uf", "sigla_uf")
    rows = terr.membership_flag(
        master.withColumn("_codigo", F.col("id_municipio")), "_codigo", codes, "participa_municipio"
    ).drop("_codigo")
    rows = terr.membership_flag(
        rows.withColumn("_codigo", F.col("sigla_uf")), "_codigo", codes, "_proprio"
    ).drop("_codigo")
    either = (F.col("participa_municipio") == 1) | (F.col("_proprio") == 1)
    return terr.inherited_participation(
        rows.withColumn("_participa", either), "id_uf", "_participa", "uf_participa", master
    ).drop("_participa", "_proprio")
