"""Full-time-education transfers by month and territorial level."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicpanel.functions.conversion import brl, leading_year
from civicpanel.operators.clean import require_non_blank
from civicpanel.operators.reshape import guard_fixed_metrics, unpivot_periods
from civicpanel.operators.territory import COUNTRY_NAME, expand_levels, resolve_mixed_codes

# Month columns of the source and the month each one holds.
PERIODS = [
    (1, "2025-10", "valor_repasse_out_2025"),
    (2, "2025-11", "valor_repasse_nov_2025"),
    (3, "2025-12", "valor_repasse_dez_2025_retificado"),
    (4, "2026-01", "valor_repasse_jan_2026_retificado"),
]
COUNTRY_VALUES = {"id_uf": "99", "nome_uf": COUNTRY_NAME, "regiao": COUNTRY_NAME, "uf": "BR"}


def transfers_panel(sources: Mapping[str, DataFrame]) -> DataFrame:
    """One row per entity, month and level.

    ``transferencias`` is the all-text extract, ``municipio`` the master table
    with centroids.  Entities that resolve to no place are left out; amounts
    that vary by month repeat per month, fixed ones stand in the first month.
    """
    raw = require_non_blank(sources["transferencias"], ["codigo_ibge"])
    labels = {
        "codigo_ibge": "codigo_ibge",
        "uf": "uf",
        "ente": "ente",
        "rede": "rede",
        "registrou_politica_tempo_integral": "registrou_politica",
    }
    typed = raw.select(
        *[F.trim(source).alias(out) for source, out in labels.items()],
        brl(F.col("valor_total_fomento")).alias("valor_total_fomento"),
        brl(F.col("quantidade_matriculas"), "bigint").alias("matriculas_fundeb"),
        *[brl(F.col(column)).alias(column) for _, _, column in PERIODS],
    )
    monthly = unpivot_periods(typed, PERIODS, "ordem", "mes", "valor_repasse")
    guarded = guard_fixed_metrics(monthly, "ordem", ["valor_total_fomento", "matriculas_fundeb"])
    dated = guarded.select(
        "*",
        F.lit("repasse").alias("tipo_registro"),
        leading_year(F.col("mes")).cast("bigint").alias("ano"),
        F.to_date(F.concat("mes", F.lit("-01"))).alias("ano_mes"),
    ).drop("ordem", "mes")
    located = resolve_mixed_codes(dated, sources["municipio"], "codigo_ibge")
    expanded = expand_levels(
        located,
        "id",
        "ente",
        "uf",
        "nome_uf",
        municipalities_only=False,
        label_with_uf=False,
        country_values=COUNTRY_VALUES,
    )
    return expanded.drop("ente", "codigo_ibge")
