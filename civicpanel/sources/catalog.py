"""Model descriptions with fields separated by ``//``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The field names a description must carry, and their columns.
DESCRIPTION_FIELDS = {
    "Frequência de atualização": "frequencia_atualizacao",
    "Partição": "particao",
    "Nível da observação": "nivel_observacao",
    "Fonte": "fonte",
    "Gestora dos dados": "gestora_dados",
    "Tratamento dos dados": "tratamento_dados",
}


def parse_catalog_descriptions(df: DataFrame, column: str) -> DataFrame:
    """Add the summary, the six mandatory fields and the list of missing ones.

    A field is ``Name: value.`` between separators; one final full stop is not
    part of the value, and a blank value counts as missing.
    """
    parts = F.transform(F.split(F.col(column), "//"), lambda part: F.trim(part))
    df = df.withColumn("_parts", parts)

    def field(name: str):
        found = F.filter("_parts", lambda part: F.startswith(part, F.lit(f"{name}:")))
        value = F.substr(F.get(found, F.lit(0)), F.lit(len(name) + 2))
        cleaned = F.trim(F.regexp_replace(F.trim(value), r"\.\z", ""))
        return F.nullif(cleaned, F.lit(""))

    df = df.withColumns({out: field(name) for name, out in DESCRIPTION_FIELDS.items()})
    missing = F.array_compact(
        F.array(*[F.when(F.col(out).isNull(), F.lit(out)) for out in DESCRIPTION_FIELDS.values()])
    )
    summary = F.regexp_replace(F.get("_parts", F.lit(0)), r"\.\z", "")
    return df.withColumns(
        {
            "resumo": summary,
            "campos_ausentes": F.array_join(missing, ","),
            "descricao_completa": F.size(missing) == 0,
        }
    ).drop("_parts")
