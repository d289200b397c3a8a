"""University budget and enrolment series."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from civicpanel.functions.text import classify
from civicpanel.operators.aggregate import MONEY, deflate, money
from civicpanel.operators.joins import join_on_cast
from civicpanel.operators.reshape import union_all
from civicpanel.lineage import folder_exists
from civicpanel.sources.publish import enforce_schema, replace_partitions
from civicpanel.sources.tables import years_of
from civicpanel.sources.text import CORRUPT, read_delimited_txt, read_json_array

# Columns of the treasury tables; every attribute has an id and a name.
ATTRIBUTES = [
    "orgao_uge", "unidade_orcamentaria", "resultado_lei", "funcao", "subfuncao", "programa", "acao",
    "plano_orcamentario", "fonte", "grupo_despesa", "elemento",
]
OWN_AMOUNTS = ["ploa", "loa", "dotacao_atualizada", "despesa_empenhada"]
RECEIVED_AMOUNTS = ["destaque_recebido", "despesa_empenhada"]


def treasury_schema(amounts: list[str]) -> StructType:
    """Year, attributes as text (ids keep leading zeros), amounts and load date."""
    schema = StructType().add("ano", "integer", False)
    for name in ATTRIBUTES:
        schema = schema.add(f"id_{name}", "string").add(name, "string")
    for name in amounts:
        schema = schema.add(name, "double")
    return schema.add("data_ultima_atualizacao", "date")


OWN_SCHEMA = treasury_schema(OWN_AMOUNTS)
RECEIVED_SCHEMA = treasury_schema(RECEIVED_AMOUNTS)
GROUP_SCHEMA = (
    StructType()
    .add("id_unidade_orcamentaria", "integer", False)
    .add("unidade_orcamentaria", "string")
    .add("grupo_unidade_orcamentaria", "string")
    .add("data_ultima_atualizacao", "date")
)


def read_treasury_txt(
    spark: SparkSession, path: str, schema: StructType, sep: str = ";", encoding: str = "ISO-8859-1"
) -> tuple[DataFrame, DataFrame]:
    """A treasury TXT extract with its declared types, and its malformed lines."""
    rows, malformed = read_delimited_txt(spark, path, schema.fieldNames(), sep, encoding)
    return enforce_schema(rows, schema), malformed


def read_treasury_json(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A JSON array export of quoted values with its declared types; what is no record stops the job."""
    rows, malformed = read_json_array(spark, path, schema.fieldNames())
    refused = F.raise_error(F.concat(F.lit("not a record: "), F.left(CORRUPT, F.lit(200)))).cast("string")
    stops = malformed.select(*[refused.alias(name) for name in schema.fieldNames()])
    return enforce_schema(rows.unionByName(stops), schema)


OWN, RECEIVED = "crédito originário", "crédito recebido"
# Spending groups and the group of groups each belongs to.
MACRO_GROUPS = {
    "Pessoal": ["PESSOAL E ENCARGOS SOCIAIS"],
    "Custeio": ["OUTRAS DESPESAS CORRENTES"],
    "Investimento": ["INVESTIMENTOS"],
}
MEASURES = {
    "total_ploa": "ploa",
    "total_loa": "loa",
    "total_dotacao": "dotacao_atualizada",
    "total_destaque": "destaque_recebido",
    "total_empenhado": "despesa_empenhada",
}
KEYS = ["ano", "id_unidade_orcamentaria", "origem", "grupo_despesa", "resultado_lei", "id_fonte", "fonte"]


def budget_panel(sources: Mapping[str, DataFrame]) -> DataFrame:
    """Own and received credit of each unit and year, nominal and at constant prices.

    Sources: ``proprio``, ``recebido``, ``grupo`` (unit to group) and ``indice``
    (``ano``, ``fator``).  Received credit belongs to the body that executes it;
    its committed spending counts only where that body is not the owner of the
    budget, since the owner's own rows already hold it otherwise.
    """
    own = sources["proprio"].select(
        "ano",
        F.col("id_unidade_orcamentaria").cast("string").alias("id_unidade_orcamentaria"),
        F.lit(OWN).alias("origem"),
        "grupo_despesa",
        "resultado_lei",
        "id_fonte",
        "fonte",
        "ploa",
        "loa",
        "dotacao_atualizada",
        F.lit(None).cast("double").alias("destaque_recebido"),
        "despesa_empenhada",
    )
    elsewhere = F.col("id_orgao_uge") != F.col("id_unidade_orcamentaria")
    nothing = F.lit(None).cast("double")
    received = sources["recebido"].select(
        "ano",
        F.col("id_orgao_uge").cast("string").alias("id_unidade_orcamentaria"),
        F.lit(RECEIVED).alias("origem"),
        "grupo_despesa",
        "resultado_lei",
        "id_fonte",
        "fonte",
        nothing.alias("ploa"),
        nothing.alias("loa"),
        nothing.alias("dotacao_atualizada"),
        "destaque_recebido",
        F.when(elsewhere, F.col("despesa_empenhada")).alias("despesa_empenhada"),
    )
    totals = union_all([own, received]).groupBy(*KEYS).agg(
        *[
            F.coalesce(money(column), F.lit(0).cast(MONEY)).alias(out)
            for out, column in MEASURES.items()
        ]
    )
    groups = sources["grupo"].select(
        F.col("id_unidade_orcamentaria").alias("_unidade"),
        "unidade_orcamentaria",
        "grupo_unidade_orcamentaria",
    )
    grouped = join_on_cast(totals, groups, "id_unidade_orcamentaria", "_unidade", "inner")
    real = deflate(
        grouped, sources["indice"], "ano", "fator", {out: f"{out}_ipca" for out in MEASURES}
    )
    macro = classify(F.col("grupo_despesa"), MACRO_GROUPS, None)
    return real.withColumn("macro_grupo_despesa", macro).withColumns(
        {c: F.col(c).cast("double") for out in MEASURES for c in (out, f"{out}_ipca")}
    )


# Result-of-law codes of the federal budget, in the names of the dashboard.
RESULT_LAW = {
    "Financeira": ["0"],
    "Obrigatória": ["1"],
    "Discricionária": ["2"],
    "Programa de Aceleração": ["3"],
    "Emenda individual": ["6"],
    "Emenda de bancada": ["7"],
    "Emenda de comissão": ["8"],
    "Emenda de relator": ["9"],
}
# Sources that a unit raises itself; all others are of the treasury.
OWN_SOURCES = ["050", "051", "063", "081"]
STUDENT_AID = ["4002", "2994"]
LOADED = "data_ultima_atualizacao"
BASE_KEYS = [
    "ano", "id_unidade_orcamentaria", "origem", "macro_grupo_despesa", "grupo_despesa", "resultado_lei",
    "tipo_fonte", "id_fonte", "fonte", "id_acao", "acao",
]


def _older(df: DataFrame, others: DataFrame, keys: Sequence[str], loaded: str, also_equal: bool) -> DataFrame:
    """``df`` without the keys that ``others`` has of a later load (or an equal one)."""
    newest = others.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.max(loaded).alias("_loaded"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    later = F.col("_loaded") >= F.col(loaded) if also_equal else F.col("_loaded") > F.col(loaded)
    return df.join(newest, same & (later | F.col(loaded).isNull()), "left_anti")


def latest_loads(df: DataFrame, keys: Sequence[str], loaded: str = LOADED) -> DataFrame:
    """The rows of the latest load of every key; a key without dates keeps all its rows."""
    dated = df.where(F.col(loaded).isNotNull())
    return _older(df, dated, keys, loaded, also_equal=False)


def merge_loads(
    load: DataFrame, target: str, keys: Sequence[str], year: str = "ano", loaded: str = LOADED
) -> None:
    """Put a load into the stored table ``target``, a folder partitioned by ``year``.

    Keys of the load replace what is stored of them, unless a later load is stored already;
    loading one file twice changes nothing.  ``keys`` must include the year.  Only the years
    that the load has are read and written.
    """
    spark = load.sparkSession
    new = latest_loads(load, keys, loaded)
    if folder_exists(spark, target):
        years = new.select(year).distinct()
        stored = years_of(spark.read.parquet(target), year, years, year).select(*load.columns)
        kept = _older(stored, new, keys, loaded, also_equal=True)
        new = _older(new, stored, keys, loaded, also_equal=False).unionByName(kept)
    replace_partitions(new, target, [year])


def budget_base(sources: Mapping[str, DataFrame]) -> DataFrame:
    """Own and received credit of the latest load of every unit and year, in one layout.

    Sources: ``proprio`` and ``recebido`` (the treasury tables).  The unit is the owner of own
    credit and the executing body of received credit, whose committed spending counts only
    where it is not the owner's.  The columns are those that the four budget tables share.
    """
    nothing = F.lit(None).cast("double")
    elsewhere = F.col("id_orgao_uge") != F.col("id_unidade_orcamentaria")
    kinds = [
        ("proprio", OWN, "id_unidade_orcamentaria", {"destaque_recebido": nothing}),
        ("recebido", RECEIVED, "id_orgao_uge", {
            "ploa": nothing, "loa": nothing, "dotacao_atualizada": nothing,
            "despesa_empenhada": F.when(elsewhere, F.col("despesa_empenhada")),
        }),
    ]
    stacked = []
    for name, origin, unit, changed in kinds:
        rows = latest_loads(sources[name], ["ano", unit])
        stacked.append(
            rows.select(
                "ano",
                F.col(unit).cast("string").alias("id_unidade_orcamentaria"),
                F.lit(origin).alias("origem"),
                classify(F.col("grupo_despesa"), MACRO_GROUPS, None).alias("macro_grupo_despesa"),
                "grupo_despesa",
                classify(F.trim("id_resultado_lei"), RESULT_LAW, "Outras").alias("resultado_lei"),
                F.when(F.col("id_fonte").isin(OWN_SOURCES), "Próprios").otherwise("Tesouro").alias("tipo_fonte"),
                "id_fonte",
                "fonte",
                "id_acao",
                "acao",
                F.col(LOADED).alias("data_atualizacao"),
                *[changed.get(c, F.col(c)).alias(c) for c in MEASURES.values()],
            )
        )
    return union_all(stacked)


def _totals(base: DataFrame, keys: Sequence[str], measures: Sequence[str], groups: DataFrame, index: DataFrame) -> DataFrame:
    """Money per key, nominal and at constant prices, with the unit's name and group."""
    sums = [F.coalesce(money(MEASURES[m]), F.lit(0).cast(MONEY)).alias(m) for m in measures]
    totals = base.groupBy(*keys).agg(F.max("data_atualizacao").alias("data_atualizacao"), *sums)
    names = groups.select(
        F.col("id_unidade_orcamentaria").alias("_unidade"), "unidade_orcamentaria", "grupo_unidade_orcamentaria"
    )
    grouped = join_on_cast(totals, names, "id_unidade_orcamentaria", "_unidade", "inner")
    real = deflate(grouped, index, "ano", "fator", {m: f"{m}_ipca" for m in measures})
    return real.withColumns({c: F.col(c).cast("double") for m in measures for c in (m, f"{m}_ipca")})


def university_budget(base: DataFrame, groups: DataFrame, index: DataFrame) -> DataFrame:
    """The dashboard's table of own credit, allotted and committed, by unit, group, result and source."""
    keys = [k for k in BASE_KEYS if k not in ("origem", "id_acao", "acao")]
    measures = ["total_ploa", "total_loa", "total_dotacao", "total_empenhado"]
    return _totals(base, keys, measures, groups, index)


def received_credit(base: DataFrame, groups: DataFrame, index: DataFrame) -> DataFrame:
    """Credit that units receive from other owners, and what they committed of it, by action."""
    keys = [k for k in BASE_KEYS if k not in ("origem", "macro_grupo_despesa")]
    rows = base.where(F.col("origem") == RECEIVED)
    return _totals(rows, keys, ["total_destaque", "total_empenhado"], groups, index)


def student_aid(
    base: DataFrame, groups: DataFrame, index: DataFrame, actions: Sequence[str] = STUDENT_AID
) -> DataFrame:
    """Money for student aid, the budget's ``actions``, by unit, year and origin of the credit."""
    rows = base.where(F.trim("id_acao").isin(list(actions)))
    keys = ["ano", "id_unidade_orcamentaria", "origem", "id_acao", "acao"]
    return _totals(rows, keys, ["total_loa", "total_dotacao", "total_destaque", "total_empenhado"], groups, index)


def universities_series(sources: Mapping[str, DataFrame]) -> DataFrame:
    """Undergraduate enrolment of federal universities by year and state of the course.

    Sources: ``curso`` and ``ies``.  Only courses of public federal universities,
    in person or at distance, with a state.
    """
    institutions = sources["ies"].select("id_ies", "ano_censo").distinct()
    courses = sources["curso"].where(
        (F.col("id_tipo_nivel_academico") == 1)
        & (F.col("id_tipo_categoria_administrativa") == 1)
        & (F.col("id_tipo_organizacao_academica") == 1)
        & F.col("id_tipo_modalidade_ensino").isin(1, 2)
        & F.col("sigla_uf").isNotNull()
    )
    return (
        courses.join(institutions, ["id_ies", "ano_censo"])
        .groupBy("ano_censo", "sigla_uf")
        .agg(
            F.sum("quantidade_matriculas").alias("matriculas"),
            F.count_distinct("id_ies").alias("instituicoes"),
        )
    )
