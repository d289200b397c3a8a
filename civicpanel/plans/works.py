"""Priority works at three territorial levels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicpanel.functions.conversion import first_date, safe, strict
from civicpanel.lineage import written
from civicpanel.operators import territory as terr
from civicpanel.operators.windows import dense_id
from civicpanel.sizing import small_side

NUMERIC = "decimal(38,9)"
# Columns of the general works table.
TEXT_COLUMNS = [
    "id_obra", "uf", "ibge_cod", "municipio", "secretaria", "sigla_unidade", "nome_obra",
    "situacao", "fonte_recurso",
]
VALUE_COLUMNS = [
    "valor_estimado_total", "valor_total_da_obra", "valor_recurso", "valor_previsto_nesse_mes",
    "valor_pago_neste_mes_total",
]
DATE_FORMATS = {
    "inicio": "dd/MM/yyyy",
    "previsao_conclusao": "yyyy-MM-dd",
    "data_recurso": "yyyy-MM-dd",
    "mes_referencia": "yyyy-MM-dd",
}


def at_all_levels(
    works: DataFrame, territory: DataFrame, code: str, codes: DataFrame | None = None
) -> DataFrame:
    """Works under every territory, territories without works included.

    ``codes`` may give the place codes of ``works`` without its other columns.
    """
    codes = (works if codes is None else codes).select(code).distinct()
    place = terr.label(F.col("municipio"), F.col("uf"))
    labelled = works.withColumn("municipio_obra", place).drop("municipio", "uf")
    expanded = terr.expand_ids(labelled, code).drop(code)
    return terr.territory_complete(territory, expanded, used=terr.expand_ids(codes, code))


def works_panel(sources: Mapping[str, DataFrame]) -> DataFrame:
    """The general works table: typed, numbered by unit and name, at three levels.

    Sources: ``obras`` (all text) and ``filtro_territorio``.  The number is
    joined on unit and name, since two units may use the same work name.
    """
    raw = sources["obras"].where(F.col("nome_obra").isNotNull() & F.col("ibge_cod").isNotNull())
    typed = raw.select(
        *TEXT_COLUMNS,
        *[first_date(F.col(c), [pattern]).alias(c) for c, pattern in DATE_FORMATS.items()],
        *[safe(F.col(c), NUMERIC).alias(c) for c in VALUE_COLUMNS],
    )
    # The typed works feed the numbering, the panel and the list of places.
    typed = written(typed)
    identity = ["sigla_unidade", "nome_obra"]
    numbers = dense_id(typed, identity, "id_variacao_obra").withColumnsRenamed(
        {"sigla_unidade": "_unidade", "nome_obra": "_nome"}
    )
    # A work without a unit is numbered too, hence the null-safe comparison.
    same = F.col("sigla_unidade").eqNullSafe(F.col("_unidade")) & (F.col("nome_obra") == F.col("_nome"))
    numbered = typed.join(small_side(numbers), same).drop("_unidade", "_nome")
    return at_all_levels(numbered, sources["filtro_territorio"], "ibge_cod", codes=typed)


def campus_works_panel(sources: Mapping[str, DataFrame], measures: Sequence[str]) -> DataFrame:
    """Works of one campus: strictly typed ``measures``, all other columns kept.

    Sources: ``obras`` and ``filtro_territorio``.  A measure that is not a number
    stops the job.
    """
    works = sources["obras"].withColumns(
        {name: strict(F.col(name), "double", name) for name in measures}
    )
    return at_all_levels(works, sources["filtro_territorio"], "codigo_ibge")


# Measures of the two campus tables.
CAMPUS_B_MEASURES = [
    "valor_estimado_total",
    "valor_total_da_obra",
    "valor_do_recurso_r",
    "valor_previsto_neste_mes_total",
    "valor_pago_neste_mes_total",
]
CAMPUS_A_MEASURES = [
    "valor_estimado_total",
    "valor_total_da_obra",
    "valor_do_recurso_r",
    "valor_previsto_neste_mes_total",
    "valor_pago_neste_mes_total",
    "valor_previsto_neste_mes_adminstracao_central",
    "valor_pago_neste_mes_adminstracao_central",
    "valor_previsto_neste_mes_edificio_central",
    "valor_pago_neste_mes_edificio_central",
    "valor_previsto_neste_mes_salas_de_aulas",
    "valor_pago_neste_mes_salas_de_aulas",
    "valor_previsto_neste_mes_restaurante",
    "valor_pago_neste_mes_restaurante",
    "valor_previsto_neste_mes_central_de_utilidades",
    "valor_pago_neste_mes_central_de_utilidades",
    "valor_previsto_neste_mes_areas_externas",
    "valor_pago_neste_mes_areas_externas",
]
