"""Ministerial briefing: one row per state, from 18 blocks of indicators.

Every block reduces its facts to one row per state, with national values under
the key ``BR`` where they are not the sum over states.  The blocks are stacked
and grouped by state once, which replaces a chain of joins, and every national
total is taken from that small frame.  Numbers come first
(:func:`briefing_numbers`); the report is a projection over them
(:func:`briefing_report`).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicpanel.functions import formatting as fmt
from civicpanel.functions.brazil import STATE_NAMES
from civicpanel.functions.text import plural, strip_suffix
from civicpanel.lineage import written
from civicpanel.operators.aggregate import (
    EXACT,
    MONEY,
    TOTAL,
    dedupe_then_sum,
    distinct_by_level,
    distinct_composite,
    distinct_three_levels,
    grouped_detail,
    list_agg,
    money,
)
from civicpanel.operators.clean import exclude_status
from civicpanel.operators.report import apply_overrides, fmt_items
from civicpanel.operators.reshape import order_report, union_all
from civicpanel.operators.territory import ALL, COUNTRY_ID
from civicpanel.sizing import small_side, within
from civicpanel.sources.literals import literal_table

UF, BR = "sigla_uf", "BR"

# Codes, labels and periods that select the facts of a block.
CONNECTED_LEVELS = [
    "Escola com velocidade adequada e rede Wi-Fi insuficiente",
    "Escola com velocidade e rede Wi-Fi adequados",
]
CYCLES = ["2023/2024", "2023", "2024"]
PAID_STATUS = ["105", "115"]
CANCELLED = [
    "Prop. Cancelada",
    "Desclassificado/Perda De Prazo",
    "Convenio Anulado",
    "Convenio Rescindido",
]
SELECTIONS = {
    "creches": ("Creches", "valor_repasse"),
    "eti": ("Escolas Tempo Integral", "valor_repasse"),
    "onibus": ("Ônibus", "valor_investimento"),
}
CONSOLIDATION, EXPANSION = "Consolidação", "Expansão"
COMPLEMENTS = {
    "vaaf": "Complementação VAAF",
    "vaat": "Complementação VAAT",
    "vaar": "Complementação VAAR",
}
DONE = "Realizado"
CHANGING_CAMPUS = "Em Transformação Para Campus"
ICA = "REALIZADO - ICA"
ALL_STAGES, SECONDARY = "Todas as etapas", "Ensino Médio"
SERIES_YEARS = (2023, 2025)
# Official national texts and the editorial note.
OVERRIDES = {
    "eti_valor": "R$ 7,16 bilhões",
    "cnca_articuladores": "7.386",
    "cnca_total": "R$ 1,56 bilhão",
}
ICA_NOTE = " (*) Em 2023, o SAEB era usado como métrica."


def state_map(df: DataFrame) -> DataFrame:
    """State id to state code, from the municipality master table."""
    return df.select(F.col("id_uf").alias("_id"), F.col(UF).alias("_uf")).distinct()


def by_state_code(df: DataFrame, id_column: str, municipalities: DataFrame, how: str = "inner") -> DataFrame:
    """Rows keyed by state id, keyed by state code; the country id becomes ``BR``."""
    codes = state_map(municipalities)
    joined = df.join(small_side(codes, municipalities), F.col(id_column) == F.col("_id"), "left")
    key = F.when(F.col(id_column).isin(COUNTRY_ID, BR), BR).otherwise(F.col("_uf"))
    keyed = joined.withColumn(UF, key).drop("_id", "_uf", id_column)
    return keyed if how == "left" else keyed.where(F.col(UF).isNotNull())


# --- blocks -------------------------------------------------------------------------


def connected_schools(s: Mapping[str, DataFrame]) -> DataFrame:
    connected = F.col("escolas_conectadas_nivel").isin(CONNECTED_LEVELS)
    return s["conectividade"].groupBy(UF).agg(
        F.count_if(connected).alias("conectadas"), F.count(F.lit(1)).alias("escolas")
    )


def full_time(s: Mapping[str, DataFrame]) -> DataFrame:
    cycles = s["peti"].where((F.col("uf") != BR) & F.col("peti_04_ciclo").isin(CYCLES))
    transfers = s["transferencias"].where(
        (F.col("tipo_registro") == "repasse") & (F.col("nivel_territorial") == "municipio")
    )
    stacked = union_all(
        [
            cycles.select(
                F.col("uf").alias(UF),
                F.col("peti_07_qtd_matricula_declarada_ciclo").cast("bigint").alias("m"),
                F.col("peti_09_valor_pago_ciclo").cast(EXACT).alias("v"),
            ),
            transfers.select(
                F.col("uf").alias(UF),
                F.col("matriculas_fundeb").cast("bigint").alias("m"),
                F.col("valor_total_fomento").cast(EXACT).alias("v"),
            ),
        ]
    )
    return stacked.groupBy(UF).agg(F.sum("m").alias("eti_matriculas"), money("v").alias("eti_valor"))


def stipend(s: Mapping[str, DataFrame]) -> list[DataFrame]:
    """People and money of the stipend, and the people it is meant for.

    The table stores three levels: money is summed at state level only, people
    of the country are counted over all rows.
    """
    paid = s["incentivo_historico"].where(
        F.col("ultima_carga") & F.col("id_tipo_status_parcela").isin(PAID_STATUS)
    )
    is_state = (F.length("id") == 2) & (F.col("id") != COUNTRY_ID)
    placed = paid.select(F.when(is_state, F.col("id")).alias("_estado"), "id_pessoa", "valor_enviado")
    people = distinct_by_level(placed, "id_pessoa", "_estado", "pdm_estudantes").drop("nivel")
    eligible = distinct_by_level(s["matricula_unica"], "id_pessoa", "id_uf", "pdm_matricula").drop("nivel")
    value = placed.where(F.col("_estado").isNotNull()).groupBy("_estado").agg(
        F.coalesce(money("valor_enviado"), F.lit(0).cast(MONEY)).alias("pdm_valor")
    )
    return [
        by_state_code(people, "_estado", s["municipio"]),
        by_state_code(eligible, "id_uf", s["municipio"]),
        by_state_code(value, "_estado", s["municipio"], "left")
        .groupBy(UF)
        .agg(F.sum("pdm_valor").alias("pdm_valor")),
    ]


def approved_works(s: Mapping[str, DataFrame]) -> DataFrame:
    rows = s["pacto"].where("indicador_aprovada").where(
        (F.length(F.col("id").cast("string")) == 2) & (F.col("id") != COUNTRY_ID)
    )
    measures = {"pacto_previsto": "valor_previsto", "pacto_repasse": "valor_repasse"}
    totals = dedupe_then_sum(rows, "id_obra", UF, measures, "pacto_obras")
    return totals.withColumns({c: F.col(c).cast(MONEY) for c in measures})


def selections(s: Mapping[str, DataFrame]) -> DataFrame:
    rows = exclude_status(
        s["selecoes"].where(F.col("modalidade").isNotNull() & (F.col("id") == COUNTRY_ID)),
        "situacao",
        CANCELLED,
    )
    zero = F.lit(0).cast(MONEY)
    measures = []
    for name, (kind, value) in SELECTIONS.items():
        chosen = F.col("modalidade") == kind
        measures.append(F.count_if(chosen).alias(f"{name}_qtd"))
        measures.append(money(F.when(chosen, F.col(value)).otherwise(zero)).alias(f"{name}_valor"))
    return rows.groupBy(UF).agg(*measures)


def category_sums(rows: DataFrame, category: str, prefix: str) -> DataFrame:
    """Planned value of consolidation, of expansion, and in total."""
    zero = F.lit(0).cast(MONEY)

    def part(name: str) -> Column:
        return money(F.when(F.col(category) == name, F.col("valor_previsto")).otherwise(zero))

    return rows.groupBy(UF).agg(
        part(CONSOLIDATION).alias(f"{prefix}_consolidacao"),
        part(EXPANSION).alias(f"{prefix}_expansao"),
        money("valor_previsto").alias(f"{prefix}_total"),
    )


def higher_education_works(s: Mapping[str, DataFrame]) -> list[DataFrame]:
    rows = s["sesu"].where(F.col("id") == COUNTRY_ID)
    grown = rows.where(F.col("categoria") == EXPANSION)
    details = grouped_detail(
        rows.where(F.col("categoria") == CONSOLIDATION), UF, "tipologia", "valor_previsto", "Outras Estruturas"
    )
    return [
        category_sums(rows, "categoria", "sesu"),
        grown.groupBy(UF).agg(F.count_distinct("instituicao").alias("sesu_campi")),
        list_agg(grown, [UF], "municipio_obra", "sesu_locais", ", ", distinct=True),
        fmt_items(details, UF, "tipologia", "lista_obras_sesu_dinamica"),
    ]


def technical_education_works(s: Mapping[str, DataFrame]) -> list[DataFrame]:
    rows = s["setec"].where(F.col("id") == COUNTRY_ID)
    details = grouped_detail(
        rows.where(F.col("categoria_resumido") == CONSOLIDATION),
        UF,
        "tipologia",
        "valor_previsto",
        "Outros Equipamentos",
    )
    new_campus = (
        (F.lower("tipologia") == EXPANSION.lower())
        & (F.col("natureza_empreendimento") == "Obra")
        & F.col("valor_previsto").isNotNull()
    )
    campus = strip_suffix(F.col("id_governa"), COUNTRY_ID)
    grown = rows.where(F.col("categoria_resumido") == EXPANSION)
    return [
        category_sums(rows, "categoria_resumido", "setec"),
        rows.where(F.col(UF) != "-")
        .groupBy(UF)
        .agg(F.count_distinct(F.when(new_campus, campus)).alias("setec_campi")),
        fmt_items(details, UF, "tipologia", "lista_obras_setec_dinamica", equals=" - R$ "),
        list_agg(grown, [UF], "municipio_obra", "lista_expansao_setec_dinamica", " | ", distinct=True),
    ]


def hospitals(s: Mapping[str, DataFrame]) -> list[DataFrame]:
    rows = s["ebserh"].where(F.col("id") == COUNTRY_ID)
    named = rows.groupBy(UF, "nome_empreendimento").agg(money("valor_novo_pac").alias("v"))
    amount = F.concat(F.lit(" - R$ "), fmt.fmt_millions(F.col("v")))
    lines = named.select(UF, F.concat("nome_empreendimento", amount).alias("_linha"))
    return [
        named.groupBy(UF).agg(F.sum("v").alias("hu_valor")),
        list_agg(lines, [UF], "_linha", "lista_obras_hu_dinamica", " | "),
    ]


def basic_education_fund(s: Mapping[str, DataFrame]) -> DataFrame:
    """Transfers by year and complement; states without a current year are left out."""
    zero = F.lit(0).cast(MONEY)
    year, kind, value = F.col("ano"), F.col("tipo_transferencia"), F.col("valor")
    yearly = [
        money(F.when(year == number, value).otherwise(zero)).alias(f"fundeb_{number}")
        for number in (2023, 2024, 2025)
    ]
    complements = [
        money(F.when((kind == label) & (year == 2026), value).otherwise(zero)).alias(f"fundeb_{name}")
        for name, label in COMPLEMENTS.items()
    ]
    base = s["fundeb"].where(F.col("status") == DONE).groupBy(UF).agg(*yearly, *complements)
    current = (
        s["fundeb_painel"]
        .where(
            (F.col("ano") == 2026)
            & (F.col("municipio") == ALL)
            & (F.col("estado") != ALL)
            & (F.col("status") == DONE)
        )
        .groupBy(F.col("uf").alias(UF))
        .agg(money("repasse").alias("fundeb_2026"))
    )
    return base.join(within(current, s["municipio"], UF), UF)


def school_meals(s: Mapping[str, DataFrame], names: DataFrame) -> DataFrame:
    schools = s["pnae"].where((F.col("municipio") == ALL) & (F.col("estado") != ALL))
    counted = schools.groupBy(F.upper("estado").alias("nome")).agg(
        F.sum("qtd_escola").cast("bigint").alias("pnae_escolas")
    )
    supported = counted.join(small_side(names), "nome").select(UF, "pnae_escolas")
    paid = (
        s["pnae_repasse"]
        .where(~F.col("dt_ref").startswith("2022"))
        .groupBy(F.col("uf").alias(UF))
        .agg(money("pnae_03_val_repasse").alias("pnae_valor"))
    )
    return supported.join(within(paid, s["municipio"], UF), UF, "left")


def school_transport(s: Mapping[str, DataFrame], names: DataFrame) -> DataFrame:
    rows = s["pnate"].where(F.col("id").try_cast("bigint") < 99)
    grouped = rows.groupBy(F.upper("estado").alias("nome")).agg(
        F.sum("qtd_aluno").cast("bigint").alias("pnate_alunos"), money("val_repasse").alias("pnate_valor")
    )
    return grouped.join(small_side(names), "nome").select(UF, "pnate_alunos", "pnate_valor")


def institutes(s: Mapping[str, DataFrame]) -> DataFrame:
    units = s["pnp_instituicao"].select("chave_unidade", "id_instituicao", UF)
    kinds = s["pnp_organizacao"].where(F.col("organizacao_administrativa") == "Institutos").select("chave_unidade")
    rows = s["pnp_matricula"].where(F.col("ano") == 2024).join(units, "chave_unidade").join(kinds, "chave_unidade")
    return rows.groupBy(UF).agg(
        F.sum("numero_matriculas").cast("bigint").alias("if_mat"),
        F.count_distinct("id_instituicao").alias("if_numero"),
        F.count_distinct("id_unidade").alias("if_campi"),
    )


def universities(s: Mapping[str, DataFrame]) -> list[DataFrame]:
    campuses = s["campus"].where(F.col(UF).isNotNull())
    working = campuses.where(F.col("status_funcionamento") != CHANGING_CAMPUS)
    institutions = s["ies"].where(F.col("ano_censo") == 2024).select("id_ies")
    courses = s["curso"].where(
        (F.col("ano_censo") == 2024)
        & (F.col("id_tipo_nivel_academico") == 1)
        & (F.col("id_tipo_categoria_administrativa") == 1)
        & (F.col("id_tipo_organizacao_academica") == 1)
        & F.col("id_tipo_modalidade_ensino").isin(1, 2)
        & F.col(UF).isNotNull()
    )
    return [
        distinct_composite(campuses, [UF], ["sigla_ies", "campus"], "uf_campi"),
        working.groupBy(UF).agg(F.count_distinct("sigla_ies").alias("uf_inst")),
        courses.join(institutions, "id_ies")
        .groupBy(UF)
        .agg(F.sum("quantidade_matriculas").cast("bigint").alias("uf_mat")),
    ]


def literacy(s: Mapping[str, DataFrame], single_level_state: str) -> list[DataFrame]:
    """The literacy programme; every measure is summed at one stated level.

    Schools and coordinators are summed over municipality rows, money and state
    coordinators over state rows; ``single_level_state`` has no municipality rows
    of its own.  All sums come from one pass over the facts.
    """
    rows = s["cnca"].where(F.col("id") != COUNTRY_ID)
    is_state = F.col("municipio") == ALL
    local = ~is_state | (F.col(UF) == single_level_state)
    now = F.col("ano") == 2026

    def total(condition: Column, column: str) -> Column:
        return F.sum(F.when(condition, F.col(column)))

    def cash(condition: Column, column: str) -> Column:
        return money(F.when(condition, F.col(column)))

    sums = rows.groupBy(UF).agg(
        total(local, "qtd_cantinho_leitura_apoiado").cast("bigint").alias("cnca_cantinho"),
        total(local, "qtd_escolas_apoiadas_cantinho_leitura").cast("bigint").alias("cnca_escolas"),
        cash(local, "valor_pago_escolas_cantinho_leitura").alias("cnca_cantinhos"),
        total(local & now, "qtd_articuladores_total").cast("bigint").alias("_art"),
        total(is_state & now, "qtd_articuladores_renalfa_regional").cast("bigint").alias("_reg"),
        total(is_state & now, "qtd_articuladores_renalfa_estadual").cast("bigint").alias("_est"),
        cash(is_state, "valor_repasse_bolsistas_total").alias("cnca_repasse"),
        cash(is_state, "valor_empenhado_materiais").alias("cnca_materiais"),
        cash(is_state, "valor_empenhado_formacoes").alias("cnca_formacao"),
        (F.bool_or(local & now) & F.bool_or(is_state & now) & F.bool_or(is_state)).alias("_completo"),
    )
    staff = F.when(F.col(UF) == single_level_state, F.col("_art")).otherwise(
        F.col("_art") + F.col("_reg") + F.col("_est")
    )
    states = (
        sums.where("_completo").withColumn("cnca_art", staff).drop("_art", "_reg", "_est", "_completo")
    )
    country = s["cnca"].where((F.col("id") == COUNTRY_ID) & (F.col("municipio") == ALL))
    nation = country.agg(
        F.sum("qtd_cantinho_leitura_apoiado").cast("bigint").alias("cnca_cantinho"),
        F.sum("qtd_escolas_apoiadas_cantinho_leitura").cast("bigint").alias("cnca_escolas"),
        money("valor_pago_escolas_cantinho_leitura").alias("cnca_cantinhos"),
        money("valor_repasse_bolsistas_total").alias("cnca_repasse"),
        money("valor_empenhado_materiais").alias("cnca_materiais"),
        money("valor_empenhado_formacoes").alias("cnca_formacao"),
    )
    return [states, nation.withColumn(UF, F.lit(BR))]


def series(s: Mapping[str, DataFrame]) -> list[DataFrame]:
    """Full-time share, age-grade distortion and literacy, first against last year."""

    def by_year(value: Column, name: str) -> list[Column]:
        return [F.max(F.when(F.col("ano") == y, value)).alias(f"{name}_{y}") for y in SERIES_YEARS]

    def block(df: DataFrame, values: Mapping[str, Column]) -> DataFrame:
        measures = [column for name, value in values.items() for column in by_year(value, name)]
        grouped = df.where(F.col("ano").isin(*SERIES_YEARS)).groupBy(F.col("id").alias("_id_uf")).agg(*measures)
        return by_state_code(grouped, "_id_uf", s["municipio"])

    full_time_rows = s["matricula_integral"].where(F.col("etapa") == ALL_STAGES)
    whole, part = F.col("quantidade_matricula"), F.col("quantidade_matricula_integral")
    return [
        block(full_time_rows, {"integral_pct": fmt.ratio(part, whole, 2), "integral_qtd": part.cast("bigint")}),
        block(
            s["distorcao"].where(F.col("etapa") == SECONDARY),
            {"distorcao": F.col("taxa_distorcao").cast("decimal(18,6)")},
        ),
        block(
            s["cnca_meta"].where(F.col("definicao_valor") == ICA),
            {"ica": F.col("valor").cast("decimal(18,6)") * 100},
        ),
    ]


# --- assembly ------------------------------------------------------------------------

# National totals that are the sum over states of a block's own column.
SUMMED = [
    "conectadas", "escolas", "eti_matriculas", "pacto_obras", "pacto_previsto", "pacto_repasse",
    "creches_qtd", "creches_valor", "eti_qtd", "eti_valor_previsto", "onibus_qtd", "onibus_valor",
    "sesu_consolidacao", "sesu_expansao", "sesu_total", "setec_consolidacao", "setec_expansao",
    "setec_total", "hu_valor", "fundeb_2023", "fundeb_2024", "fundeb_2025", "fundeb_2026",
    "fundeb_vaaf", "fundeb_vaat", "fundeb_vaar", "pnae_escolas", "pnae_valor", "pnate_alunos",
    "pnate_valor", "if_mat", "if_numero", "if_campi", "uf_campi", "uf_inst", "uf_mat", "pdm_valor",
]
# National values that a block delivers itself.
NATIONAL = [
    "pdm_estudantes", "pdm_matricula", "cnca_cantinho", "cnca_escolas", "cnca_cantinhos",
    "cnca_repasse", "cnca_materiais", "cnca_formacao",
    *[f"{name}_{year}" for name in ("integral_pct", "integral_qtd", "distorcao", "ica") for year in SERIES_YEARS],
]


def state_names(s: Mapping[str, DataFrame]) -> DataFrame:
    """``sigla_uf, nome`` in capitals, from source ``uf`` or the fixed list."""
    if "uf" in s:
        return s["uf"].select(F.col("sigla").alias(UF), F.upper("nome").alias("nome"))
    spark = s["municipio"].sparkSession
    rows = [(code, name.upper()) for code, name in STATE_NAMES.items()]
    return literal_table(spark, rows, f"{UF} string, nome string")


def briefing_numbers(s: Mapping[str, DataFrame], single_level_state: str = "DF") -> DataFrame:
    """All indicators as numbers, one row per state of the connected-schools block.

    National values stand beside them with the suffix ``_br``.
    """
    names = state_names(s)
    spine = connected_schools(s).withColumn("_base", F.lit(True))
    picks = selections(s).withColumnRenamed("eti_valor", "eti_valor_previsto")
    blocks = [
        spine,
        full_time(s),
        *stipend(s),
        approved_works(s),
        picks,
        *higher_education_works(s),
        *technical_education_works(s),
        *hospitals(s),
        basic_education_fund(s),
        school_meals(s, names),
        school_transport(s, names),
        institutes(s),
        *universities(s),
        *literacy(s, single_level_state),
        *series(s),
        names.withColumnRenamed("nome", "territorio"),
    ]
    stacked = union_all(blocks, allow_missing=True)
    columns = [name for name in stacked.columns if name != UF]
    # At most one row per state: written once, so that the national totals and the
    # report do not run the blocks again.
    states = written(stacked.groupBy(UF).agg(*[F.max(name).alias(name) for name in columns]))
    is_country = F.col(UF).eqNullSafe(BR)
    totals = [F.sum(F.when(~is_country, F.col(name))).alias(f"{name}_br") for name in SUMMED]
    totals += [F.max(F.when(is_country, F.col(name))).alias(f"{name}_br") for name in NATIONAL]
    country = states.agg(F.struct(*totals)).scalar()
    # Rows without a state belong to no other block's rows without one.
    own = {"conectadas", "escolas"}
    kept = [name if name in own else F.when(F.col(UF).isNotNull(), F.col(name)).alias(name) for name in columns if name != "_base"]
    return (
        states.withColumn("_pais", country)
        .where(F.col("_base") & ~is_country)
        .select(UF, *kept, "_pais.*")
    )


def reais(text: Column) -> Column:
    return F.concat(F.lit("R$ "), text)


def percent(c: Column, digits: int) -> Column:
    return F.concat(fmt.fmt_dec_br(c, digits), F.lit("%"))


def briefing_report(
    numbers: DataFrame,
    overrides: Mapping[str, str] = OVERRIDES,
    ica_note: str = ICA_NOTE,
    stipend_period: tuple[str, str] = ("2024-2026", "Março/2026"),
    support_period: tuple[str, str] = ("2023-2026", "Março/26"),
) -> DataFrame:
    """The briefing as text, ordered by state; one projection over the numbers."""
    c, text = F.col, F.lit
    whole = fmt.fmt_int_br

    def plain_pair(name: str) -> Column:
        return fmt.pair(c(name).cast("string"), c(f"{name}_br").cast("string"))

    def int_pair(name: str) -> Column:
        return fmt.pair(whole(c(name)), whole(c(f"{name}_br")))

    def millions_pair(name: str, country=fmt.fmt_billions) -> Column:
        return fmt.pair(reais(fmt.fmt_millions(c(name))), reais(country(c(f"{name}_br"))))

    def billions_pair(name: str) -> Column:
        return fmt.pair(reais(fmt.fmt_billions(c(name))), reais(fmt.fmt_billions(c(f"{name}_br"))))

    def big_pair(name: str) -> Column:
        amount = F.when(c(name) >= 1_000_000_000, fmt.fmt_billions(c(name))).otherwise(fmt.fmt_millions(c(name)))
        return fmt.pair(reais(amount), reais(fmt.fmt_billions(c(f"{name}_br"))))

    def share(part: str, base: str, digits: int, suffix: str = "") -> Column:
        value = fmt.ratio(c(part + suffix), c(base + suffix), digits)
        return percent(value, digits)

    def served(suffix: str) -> Column:
        return F.concat(
            whole(c(f"pdm_estudantes{suffix}")), text(" ("), share("pdm_estudantes", "pdm_matricula", 2, suffix), text(")")
        )

    def full_time_line(suffix: str) -> Column:
        return F.concat(
            percent(c(f"integral_pct_2023{suffix}"), 2), text(" em 2023 para "),
            percent(c(f"integral_pct_2025{suffix}"), 2), text(" em 2025 ("),
            whole(c(f"integral_qtd_2023{suffix}")), text(" → "),
            whole(c(f"integral_qtd_2025{suffix}")), text(" matrículas)"),
        )

    def distortion_line(suffix: str) -> Column:
        return F.concat(
            text("caiu de "), percent(c(f"distorcao_2023{suffix}"), 1), text(" em 2023 para "),
            percent(c(f"distorcao_2025{suffix}"), 1), text(" em 2025"),
        )

    def ica_line(suffix: str) -> Column:
        return F.concat(
            text("De "), percent(c(f"ica_2023{suffix}"), 2), text("* em 2023 para "),
            fmt.fmt_general(c(f"ica_2025{suffix}")), text("% em 2025"),
        )

    sesu_campi = F.when(
        c("sesu_campi") > 0,
        F.concat(
            text(" - "), c("sesu_campi").cast("string"), plural(c("sesu_campi"), " Campus (", " Campi ("),
            F.coalesce("sesu_locais", text("")), text(")"),
        ),
    ).otherwise(text(""))
    setec_campi = F.coalesce("setec_campi", text(0))
    hospital = F.when(c("territorio").isNotNull(), F.coalesce("hu_valor", text(0).cast(MONEY)))
    cnca_parts = c("cnca_cantinhos") + c("cnca_repasse") + c("cnca_materiais") + c("cnca_formacao")
    million_both = {"country": fmt.fmt_millions}
    has_stipend = c("pdm_estudantes").isNotNull()
    columns = {
        "uf": c(UF),
        "territorio": c("territorio"),
        "titulo": F.concat(text("BRIEFING – Visita Ministerial - "), c("territorio")),
        "escolas_conectadas_nivel_4_5": F.concat(
            whole(c("conectadas")), text(" ("), share("conectadas", "escolas", 1), text(" )"), text(fmt.PAIR),
            whole(c("conectadas_br")), text(" ("), share("conectadas", "escolas", 1, "_br"), text(")"),
        ),
        "eti_matriculas_fomentadas": int_pair("eti_matriculas"),
        "eti_valor_fomentado": fmt.pair(
            reais(F.concat(fmt.fmt_trim_br(fmt.scaled(c("eti_valor"), 6), 2), text(" milhões"))),
            text(overrides["eti_valor"]),
        ),
        "cnca_cantinho_leitura": int_pair("cnca_cantinho"),
        "cnca_escolas_apoiadas": int_pair("cnca_escolas"),
        "cnca_valor_cantinhos": millions_pair("cnca_cantinhos", **million_both),
        "cnca_qtd_articuladores_total": fmt.pair(whole(c("cnca_art")), text(overrides["cnca_articuladores"])),
        "cnca_articuladores_renalpha_2026": millions_pair("cnca_repasse", **million_both),
        "cnca_valor_materiais": millions_pair("cnca_materiais", **million_both),
        "cnca_valor_formacao": millions_pair("cnca_formacao", **million_both),
        "cnca_total_investido": fmt.pair(reais(fmt.fmt_millions(cnca_parts)), text(overrides["cnca_total"])),
        "pdm_estudantes_beneficiados": fmt.pair(served(""), served("_br")),
        "pdm_valor_investido": big_pair("pdm_valor"),
        "pdm_abrangencia": F.when(has_stipend, text(stipend_period[0])),
        "pdm_referencia": F.when(has_stipend, text(stipend_period[1])),
        "obras_total_aprovadas": plain_pair("pacto_obras"),
        "obras_valor_previsto": millions_pair("pacto_previsto"),
        "obras_valor_repassado": millions_pair("pacto_repasse"),
        "novo_pac_creches": plain_pair("creches_qtd"),
        "novo_pac_creches_valor_previsto": millions_pair("creches_valor"),
        "novo_pac_eti": plain_pair("eti_qtd"),
        "novo_pac_eti_valor_previsto": millions_pair("eti_valor_previsto"),
        "novo_pac_onibus": plain_pair("onibus_qtd"),
        "novo_pac_onibus_valor_previsto": millions_pair("onibus_valor"),
        "novo_pac_superior_consolidacao": millions_pair("sesu_consolidacao"),
        "novo_pac_superior_expansao": fmt.pair(
            F.concat(reais(fmt.fmt_millions(c("sesu_expansao"))), sesu_campi),
            reais(fmt.fmt_millions(c("sesu_expansao_br"))),
        ),
        "novo_pac_superior_total_previsto": millions_pair("sesu_total"),
        "lista_obras_sesu_dinamica": c("lista_obras_sesu_dinamica"),
        "novo_pac_ept_consolidacao": millions_pair("setec_consolidacao"),
        "novo_pac_ept_expansao": fmt.pair(
            F.concat(
                reais(fmt.fmt_millions(c("setec_expansao"))), text(" - "), setec_campi.cast("string"),
                F.when(setec_campi > 1, text(" campi")).otherwise(text(" campus")),
            ),
            reais(fmt.fmt_billions(c("setec_expansao_br"))),
        ),
        "novo_pac_ept_total_previsto": millions_pair("setec_total"),
        "lista_obras_setec_dinamica": c("lista_obras_setec_dinamica"),
        "lista_expansao_setec_dinamica": c("lista_expansao_setec_dinamica"),
        "novo_pac_hu_valor_previsto": fmt.pair(
            fmt.fmt_money_br(hospital, thousands=","),
            reais(fmt.fmt_billions(F.coalesce("hu_valor_br", text(0).cast(MONEY)))),
        ),
        "lista_obras_hu_dinamica": c("lista_obras_hu_dinamica"),
        **{f"fundeb_{year}": billions_pair(f"fundeb_{year}") for year in (2023, 2024, 2025, 2026)},
        **{f"fundeb_valor_repassado_{name.upper()}": big_pair(f"fundeb_{name}") for name in COMPLEMENTS},
        "pnae_escolas_apoiadas": int_pair("pnae_escolas"),
        "pnae_valor_investido": big_pair("pnae_valor"),
        "pnae_abrangencia": F.when(c("pnae_escolas").isNotNull(), text(support_period[0])),
        "pnae_referencia": F.when(c("pnae_escolas").isNotNull(), text(support_period[1])),
        "pnate_estudantes_beneficiados": int_pair("pnate_alunos"),
        "pnate_valor_investido": big_pair("pnate_valor"),
        "pnate_abrangencia": F.when(c("pnate_alunos").isNotNull(), text(support_period[0])),
        "pnate_referencia": F.when(c("pnate_alunos").isNotNull(), text(support_period[1])),
        "if_matriculas": fmt.pair(fmt.fmt_mil(c("if_mat").cast("decimal(20,0)")), whole(c("if_mat_br"))),
        "if_numero": plain_pair("if_numero"),
        "if_campi": plain_pair("if_campi"),
        "uf_campi": plain_pair("uf_campi"),
        "uf_instituicoes": plain_pair("uf_inst"),
        "uf_matriculas_graduacao": int_pair("uf_mat"),
        "eti_serie_historica_alunos": fmt.pair(full_time_line(""), full_time_line("_br")),
        "distorcao_idade_serie": F.concat(
            text("Ensino Médio: "), fmt.pair(distortion_line(""), distortion_line("_br"))
        ),
        "ica_alfabetizacao": F.concat(fmt.pair(ica_line(""), ica_line("_br")), text(ica_note)),
    }
    return order_report(numbers.select(*[value.alias(out) for out, value in columns.items()]), ["uf"])


def briefing(s: Mapping[str, DataFrame], single_level_state: str = "DF") -> DataFrame:
    """The formatted briefing from its sources."""
    return briefing_report(briefing_numbers(s, single_level_state))


def briefing_long(numbers: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """State and country values of chosen metrics, one row per level and metric."""
    states = numbers.select(UF, *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(
        [UF], list(metrics), "metrica", "valor"
    )
    country = numbers.agg(*[F.max(f"{m}_br").cast("double").alias(m) for m in metrics]).select(
        F.lit(BR).alias(UF), *metrics
    )
    nation = country.unpivot([UF], list(metrics), "metrica", "valor")
    return states.withColumn("nivel_territorial", F.lit("estado")).unionByName(
        nation.withColumn("nivel_territorial", F.lit("pais"))
    )


# --- the visit table: municipality, state and country ---------------------------------

LEVEL_NAMES = ("municipio", "estado", "pais")


def municipal_sums(fact: DataFrame, municipality: str, measures: Mapping[str, Column]) -> DataFrame:
    """All ``measures`` of one fact per municipality, stacked: ``_municipio, metrica, valor``.

    The measures are conditional values of a row; one aggregate over one scan sums them
    exactly.  A measure without any value in a municipality has no row there.
    """
    sums = [F.sum(value.cast(EXACT)).alias(name) for name, value in measures.items()]
    wide = fact.groupBy(F.col(municipality).alias("_municipio")).agg(*sums)
    return wide.unpivot(["_municipio"], list(measures), "metrica", "valor").where("valor IS NOT NULL")


def at_three_levels(stacked: DataFrame) -> DataFrame:
    """Stacked municipal sums at every level by grouping sets: ``id, nivel_territorial, metrica, valor``.

    The state is the first two digits of the municipality's code.  Rows without a code
    count for the country only.
    """
    rows = stacked.withColumn("_uf", F.left("_municipio", F.lit(2)))
    levels = rows.groupingSets(
        [["metrica", "_uf", "_municipio"], ["metrica", "_uf"], ["metrica"]], "metrica", "_uf", "_municipio"
    ).agg(F.sum("valor").cast(TOTAL).cast("double").alias("valor"), F.grouping_id().alias("_nivel"))
    # The grouping id has a bit for each column that is summed over.
    at = F.when(F.col("_nivel") == 0, 0).when(F.col("_nivel") == 1, 1).otherwise(2)
    ident = F.when(at == 0, F.col("_municipio")).when(at == 1, F.col("_uf")).otherwise(F.lit(COUNTRY_ID))
    names = F.array(*[F.lit(name) for name in LEVEL_NAMES])
    found = levels.select(ident.alias("id"), F.get(names, at).alias("nivel_territorial"), "metrica", "valor")
    return found.where(F.col("id").isNotNull())


def visit_long(
    facts: Sequence[tuple[DataFrame, str, Mapping[str, Column]]],
    people: Mapping[str, DataFrame],
    indicators: Mapping[str, DataFrame],
    overrides: Mapping[tuple[str, str], float] | None = None,
) -> DataFrame:
    """The visit briefing as a long table of metrics per municipality, state and country.

    ``facts`` gives each fact with its municipality column and its additive measures, and is
    read once.  ``people`` gives stored bitmaps (``id_municipio``, ``bloco``, ``pessoas``) of
    metrics that count people, who may not be added up.  ``indicators`` gives published
    values (``id`` of any level, ``valor``), which are taken at their own level.
    ``overrides`` maps (id, metric) to an official value that replaces the computed one.
    """
    parts = [at_three_levels(union_all([municipal_sums(*fact) for fact in facts]))]
    for metric, bitmaps in people.items():
        placed = bitmaps.withColumn("_uf", F.left("id_municipio", F.lit(2)))
        counted = distinct_three_levels(placed, "id_municipio", "_uf", "valor", COUNTRY_ID)
        parts.append(
            counted.select("id", F.col("nivel").alias("nivel_territorial"), F.lit(metric).alias("metrica"), F.col("valor").cast("double"))
        )
    level = (
        F.when(F.col("id") == COUNTRY_ID, LEVEL_NAMES[2]).when(F.length("id") == 2, LEVEL_NAMES[1]).otherwise(LEVEL_NAMES[0])
    )
    for metric, published in indicators.items():
        parts.append(
            published.where(F.col("id").isNotNull()).select(
                "id", level.alias("nivel_territorial"), F.lit(metric).alias("metrica"), F.col("valor").cast("double").alias("valor")
            )
        )
    table = union_all(parts)
    if not overrides:
        return table.withColumn("oficial", F.lit(False))
    rows = [(i, m, float(v)) for (i, m), v in overrides.items()]
    official = literal_table(table.sparkSession, rows, "id string, metrica string, _oficial double")
    shown = apply_overrides(table, official, ["id", "metrica"], "valor", "_oficial")
    return shown.withColumnRenamed("is_override", "oficial").select("id", "nivel_territorial", "metrica", "valor", "oficial")


def works_annex(works: DataFrame, category: str) -> DataFrame:
    """The consolidation works behind the briefing, listed by state and institution."""
    rows = works.where((F.col("id") == COUNTRY_ID) & (F.col(category) == CONSOLIDATION))
    columns = [UF, "instituicao", "nome_empreendimento", "municipio_obra", "valor_previsto"]
    return order_report(rows.select(*columns), [UF, "instituicao", "municipio_obra"])
