"""The panels on the benchmark tables, each fed through the columns it expects."""

from __future__ import annotations

from pyspark.sql import functions as F

from civicpanel.catalogue.aggregate_queries import count, fine, fine_sql, sql_sum
from civicpanel.catalogue.places import municipalities, placed, states, territory, with_places
from civicpanel.catalogue.registry import query
from civicpanel.catalogue.territory_queries import (
    HOMONYM_SQL,
    INSTITUTION_SQL,
    MIXED_SQL,
    institutions,
    with_homonyms,
)
from civicpanel.functions import formatting as fmt
from civicpanel.operators.aggregate import MONEY, money
from civicpanel.plans import adhesion, budget, programme, schools, teachers, transfers, works
from civicpanel.sources.literals import literal_table


def written_money(c):
    """A number as Brazilian money text."""
    return F.concat(F.lit("R$ "), F.translate(F.format_number(c.cast(MONEY), 2), ",.", ".,"))


# --- transfers ---------------------------------------------------------------------

TRANSFERS_SQL = with_places(
    """SELECT lv.id, CASE WHEN n = 3 THEN '99' ELSE b.id_uf END AS id_uf,
         CASE WHEN n = 3 THEN 'Brasil' ELSE b.nome_uf END AS nome_uf,
         CASE WHEN n = 3 THEN 'Brasil' ELSE b.regiao END AS regiao,
         b.latitude, b.longitude, b.coordenada, lv.nivel AS nivel_territorial,
         CASE WHEN n = 1 THEN ente || ' - ' || uf ELSE 'Todos' END AS nome_territorio,
         CASE WHEN n = 3 THEN 'Todos' ELSE b.nome_uf END AS estado,
         CASE WHEN n = 1 THEN ente ELSE 'Todos' END AS municipio,
         b.nome_uf AS estado_nome, ente AS municipio_nome,
         CASE n WHEN 1 THEN ente || ' - ' || uf WHEN 2 THEN b.nome_uf ELSE 'Brasil' END AS titulo,
         CASE WHEN n = 3 THEN 'BR' ELSE uf END AS uf, rede, registrou_politica, 'repasse' AS tipo_registro,
         CAST(left(m.mes, 4) AS BIGINT) AS ano, CAST(m.mes || '-01' AS DATE) AS ano_mes,
         CAST(CASE m.ordem WHEN 1 THEN v WHEN 2 THEN 2 * v WHEN 3 THEN CASE WHEN registrou_politica <> 'P' THEN v END END AS DOUBLE) AS valor_repasse,
         CAST(CASE WHEN m.ordem = 1 THEN 3 * v END AS DOUBLE) AS valor_total_fomento,
         CASE WHEN m.ordem = 1 THEN matriculas END AS matriculas_fundeb
       FROM (SELECT codes.*, c_name AS ente, sigla_uf AS uf, o_orderpriority AS rede, o_orderstatus AS registrou_politica,
               CAST(o_totalprice AS DECIMAL(18,2)) AS v, o_orderkey AS matriculas
             FROM orders JOIN customer ON o_custkey = c_custkey JOIN mun ON c_nationkey = n_nationkey
             JOIN codes ON codes.id = CASE o_orderkey % 4 WHEN 0 THEN mun.id_uf WHEN 1 THEN '' ELSE mun.id_municipio END) b
       CROSS JOIN (VALUES (1, '2025-10'), (2, '2025-11'), (3, '2025-12'), (4, '2026-01')) m(ordem, mes)
       CROSS JOIN LATERAL (SELECT 1 AS n, b.id AS id, 'municipio' AS nivel UNION ALL SELECT 2, b.id_uf, 'estado'
                           UNION ALL SELECT 3, '99', 'pais') lv""",
    MIXED_SQL,
)


@query("panel_transfers", TRANSFERS_SQL)
def panel_transfers(t):
    orders = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    kind, price = F.col("o_orderkey") % 4, F.col("o_totalprice").cast(MONEY)
    code = F.when(kind == 0, F.col("id_uf")).when(kind == 1, " ").otherwise(F.col("id_municipio"))
    extract = placed(orders, "c_nationkey", t).select(
        F.concat(code, F.lit(" ")).alias("codigo_ibge"),
        F.concat(F.lit(" "), "sigla_uf").alias("uf"),
        F.col("c_name").alias("ente"),
        F.col("o_orderpriority").alias("rede"),
        F.col("o_orderstatus").alias("registrou_politica_tempo_integral"),
        written_money(price * 3).alias("valor_total_fomento"),
        fmt.fmt_int_br(F.col("o_orderkey")).alias("quantidade_matriculas"),
        written_money(price).alias("valor_repasse_out_2025"),
        written_money(price * 2).alias("valor_repasse_nov_2025"),
        F.when(F.col("o_orderstatus") != "P", written_money(price)).alias("valor_repasse_dez_2025_retificado"),
        F.lit("a definir").alias("valor_repasse_jan_2026_retificado"),
    )
    return transfers.transfers_panel({"transferencias": extract, "municipio": municipalities(t)})


# --- offer and survey ----------------------------------------------------------------

OFFER_SQL = with_places(
    """SELECT x.id, ter.municipio AS nome_territorio, ter.estado, ter.titulo, o.no_municipio, o.uf, o.regiao,
              o.instituicao, o.campus, o.turmas, o.total_matriculas, o.latitude, o.longitude, o.coordenada
       FROM (SELECT ter.id AS codigo, o.*, latitude, longitude, coordenada FROM (
               SELECT CASE WHEN n_nationkey = 3 THEN 'NATION_3' WHEN n_nationkey = 4 THEN 'Desconhecida' ELSE nome END AS no_municipio,
                 sigla_uf AS uf, CASE WHEN sigla_uf IN ('AF', 'AS') THEN 'Leste' ELSE 'Indefinido' END AS regiao,
                 s_name AS instituicao, 'Campus ' || CAST(s_suppkey % 4 AS VARCHAR) AS campus,
                 s_suppkey % 9 AS turmas, s_suppkey * 3 AS total_matriculas
               FROM supplier JOIN mun ON s_nationkey = n_nationkey) o
             JOIN ter ON ter.municipio = o.no_municipio || ' - ' || o.uf
             LEFT JOIN coord ON coord.id_ibge = ter.id) o
       CROSS JOIN LATERAL (SELECT o.codigo AS id UNION ALL SELECT left(o.codigo, 2) UNION ALL SELECT '99') x
       LEFT JOIN ter ON ter.id = x.id""",
    INSTITUTION_SQL,
)


@query("panel_offer", OFFER_SQL)
def panel_offer(t):
    number = F.col("n_nationkey")
    name = F.when(number == 3, "Nação Três").when(number == 4, "Desconhecida").otherwise(F.col("nome"))
    offers = t.supplier.join(municipalities(t), F.col("s_nationkey") == number).select(
        name.alias("municipio"),
        F.concat(F.lit(" "), "sigla_uf", F.lit(" ")).alias("sigla_uf"),
        F.col("s_name").alias("instituicao"),
        F.concat(F.lit("Campus "), (F.col("s_suppkey") % 4).cast("string")).alias("campus"),
        (F.col("s_suppkey") % 9).alias("turmas"),
        (F.col("s_suppkey") * 3).alias("total_matriculas"),
    )
    sources = {"oferta": offers, "filtro_territorio": territory(t), "instituicao": institutions(t)}
    return programme.offer_panel(
        sources, {"Nação Três": "NATION_3"}, {"Combori": "Camboriú"}, {"Leste": ["AF", "AS"]}
    )


SURVEY_SQL = with_places(
    """SELECT x.id, ter.municipio AS nome_territorio, ter.estado, ter.titulo, a.id_resposta, a.id_pessoa, a.cpf,
              a.data_referencia, a.no_municipio_display, a.uf, a.idade, a.genero, a.cor_raca, a.instituicao, a.turno,
              a.campus, a.avaliacao_aprendizado, a.qtd_matricula, a.valor_investimento, a.qtd_profissionais,
              CASE WHEN coalesce(a.uf_ter, a.uf) IN ('AF', 'AS') THEN 'Leste' WHEN coalesce(a.uf_ter, a.uf) = 'EU' THEN 'Centro'
                   ELSE 'Indefinido' END AS regiao,
              sha256(coalesce(a.instituicao, '') || coalesce(a.campus, '') || coalesce(a.turno, '')) AS id_turma_estimada
       FROM (SELECT s.*, coalesce(hm.id_municipio, uq.id) AS codigo, coalesce(hm.sigla_uf, uq.uf) AS uf_ter
             FROM (SELECT c_custkey AS id_resposta, c_custkey * 2 AS id_pessoa, c_name AS cpf, DATE '2024-03-05' AS data_referencia,
                     CASE WHEN c_custkey % 7 = 0 THEN 'PERDIDA' ELSE hm.nome END AS cidade,
                     CASE WHEN c_custkey % 7 = 0 THEN 'Perdida' WHEN n_nationkey >= 23 THEN 'Homonima'
                          ELSE 'Nation_' || n_nationkey END AS no_municipio_display,
                     CASE c_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 'XX' ELSE sigla_uf END AS uf,
                     CASE WHEN c_custkey % 100 BETWEEN 10 AND 90 AND c_custkey % 4 <> 0 THEN c_custkey % 100 END AS idade,
                     'F' AS genero, 'parda' AS cor_raca, CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS instituicao,
                     'noite' AS turno, CASE c_custkey % 4 WHEN 1 THEN 'C1' WHEN 2 THEN 'C2' WHEN 3 THEN 'C3' END AS campus,
                     'boa' AS avaliacao_aprendizado, CAST(1 AS BIGINT) AS qtd_matricula,
                     CAST(NULL AS DOUBLE) AS valor_investimento, CAST(NULL AS BIGINT) AS qtd_profissionais
                   FROM customer JOIN hm ON c_nationkey = n_nationkey) s
             LEFT JOIN hm ON s.cidade = hm.nome AND s.uf = hm.sigla_uf
             LEFT JOIN uq ON s.cidade = uq.nome AND hm.id_municipio IS NULL) a
       CROSS JOIN LATERAL (SELECT unnest(CASE WHEN a.codigo IS NULL THEN ['99']
                                              ELSE [a.codigo, left(a.codigo, 2), '99'] END) AS id) x
       LEFT JOIN ter ON ter.id = x.id""",
    HOMONYM_SQL,
)


@query("panel_survey", SURVEY_SQL)
def panel_survey(t):
    places = with_homonyms(municipalities(t))
    key = F.col("c_custkey")
    answers = t.customer.join(places, F.col("c_nationkey") == F.col("n_nationkey")).select(
        key.alias("id"),
        (key * 2).alias("id_pessoa"),
        F.col("c_name").alias("cpf"),
        F.lit("2024-03-05 10:20:30").cast("timestamp_ntz").alias("data_hora_inicio"),
        F.when(key % 7 == 0, " perdida").otherwise(F.lower("nome")).alias("municipio_residencia"),
        F.when(key % 3 == 1, " xx").when(key % 3 == 2, F.initcap("nome_uf")).alias("estado_residencia"),
        F.when(key % 4 == 0, "muitos").otherwise((key % 100).cast("string")).alias("idade"),
        F.lit("F").alias("sexo"),
        F.lit("parda").alias("cor_raca"),
        F.when(key % 5 != 0, F.col("c_mktsegment")).alias("instituicao_curso"),
        F.lit("noite").alias("turno_curso"),
        *[F.when(key % 4 == n, f"C{n}").alias(f"campus_{n}") for n in (1, 2, 3)],
        F.lit("boa").alias("avaliacao_efetividade_aula"),
    )
    sources = {"questionario": answers, "municipio": places, "filtro_territorio": territory(t)}
    names = {"AF": "Africa", "AM": "América", "AS": "Asia", "EU": "Europe", "MI": "Middle East"}
    return programme.survey_panel(
        sources, ["campus_1", "campus_2", "campus_3"], names, {"Leste": ["AF", "AS"], "Centro": ["EU"]}
    )


# --- works ---------------------------------------------------------------------------

WORKS_SQL = with_places(
    """SELECT ter.id, ter.municipio, ter.estado, ter.titulo, x.id_variacao_obra, x.nome_obra, x.sigla_unidade, x.municipio_obra,
              COUNT(x.id_obra) AS obras, MIN(x.inicio) AS inicio, COUNT(x.previsao) AS previsoes,
              CAST(SUM(x.valor) AS DOUBLE) AS valor, COUNT(x.valor) AS valores
       FROM ter LEFT JOIN (
         SELECT w.*, lv.id FROM (
           SELECT l_orderkey AS id_obra, p_brand AS sigla_unidade, p_name AS nome_obra, nome || ' - ' || sigla_uf AS municipio_obra,
                  id_municipio, dense_rank() OVER (ORDER BY p_brand, p_name) AS id_variacao_obra,
                  CASE WHEN l_linenumber <> 2 THEN CAST(l_shipdate AS DATE) END AS inicio,
                  CASE WHEN l_linenumber <> 3 THEN CAST(l_shipdate AS DATE) END AS previsao,
                  CASE WHEN l_linenumber <> 4 THEN CAST(l_extendedprice AS DECIMAL(18,2)) END AS valor
           FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
           JOIN mun ON s_nationkey = n_nationkey WHERE l_linenumber <> 7 AND n_nationkey % 5 <> 2) w
         CROSS JOIN LATERAL (SELECT w.id_municipio AS id UNION ALL SELECT left(w.id_municipio, 2) UNION ALL SELECT '99') lv) x
       USING (id) GROUP BY ALL"""
)


@query("panel_works", WORKS_SQL)
def panel_works(t):
    items = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).join(
        t.supplier, F.col("l_suppkey") == F.col("s_suppkey")
    )
    number, day = F.col("l_linenumber"), F.col("l_shipdate")
    iso = F.date_format(day, "yyyy-MM-dd")
    price = F.col("l_extendedprice").cast(MONEY).cast("string")
    raw = placed(items, "s_nationkey", t).select(
        F.col("l_orderkey").cast("string").alias("id_obra"),
        F.col("sigla_uf").alias("uf"),
        F.when((number != 7) & (F.col("s_nationkey") % 5 != 2), F.col("id_municipio")).alias("ibge_cod"),
        F.col("nome").alias("municipio"),
        F.lit("SESU").alias("secretaria"),
        F.col("p_brand").alias("sigla_unidade"),
        F.col("p_name").alias("nome_obra"),
        F.col("l_linestatus").alias("situacao"),
        F.lit("PAC").alias("fonte_recurso"),
        F.when(number == 2, "em breve").otherwise(F.date_format(day, "dd/MM/yyyy")).alias("inicio"),
        F.when(number == 3, "2024-02-31").otherwise(iso).alias("previsao_conclusao"),
        iso.alias("data_recurso"),
        iso.alias("mes_referencia"),
        *[F.when(number == 4, "n/d").otherwise(price).alias(c) for c in works.VALUE_COLUMNS],
    )
    panel = works.works_panel({"obras": raw, "filtro_territorio": territory(t)})
    keys = ["id", "municipio", "estado", "titulo", "id_variacao_obra", "nome_obra", "sigla_unidade", "municipio_obra"]
    return panel.groupBy(*keys).agg(
        F.count("id_obra").alias("obras"),
        F.min("inicio").alias("inicio"),
        F.count("previsao_conclusao").alias("previsoes"),
        money("valor_total_da_obra").cast("double").alias("valor"),
        F.count("valor_recurso").alias("valores"),
    )


def campus_sql(last: str) -> str:
    return with_places(
        f"""SELECT ter.id, ter.municipio, ter.estado, ter.titulo, x.municipio_obra, x.situacao, COUNT(x.valor) AS obras,
                   {sql_sum("x.valor")} AS valor, {sql_sum("x.ultimo")} AS ultimo
            FROM ter LEFT JOIN (
              SELECT w.*, lv.id FROM (
                SELECT CASE WHEN l_linenumber <> 7 AND n_nationkey % 5 <> 2 THEN id_municipio END AS codigo, l_linestatus AS situacao,
                       nome || ' - ' || sigla_uf AS municipio_obra, {fine_sql("l_extendedprice")} AS valor,
                       {fine_sql("l_extendedprice")} * {last} AS ultimo
                FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN mun ON s_nationkey = n_nationkey) w
              CROSS JOIN LATERAL (SELECT w.codigo AS id UNION ALL SELECT left(w.codigo, 2) UNION ALL SELECT '99') lv
              WHERE w.codigo IS NOT NULL) x
            USING (id) GROUP BY ALL"""
    )


def campus_works(t, measures):
    """Line items as works of a campus, the k-th measure k times the first; all text."""
    items = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    value = fine("l_extendedprice")
    known = (F.col("l_linenumber") != 7) & (F.col("s_nationkey") % 5 != 2)
    raw = placed(items, "s_nationkey", t).select(
        F.when(known, F.col("id_municipio")).alias("codigo_ibge"),
        F.col("nome").alias("municipio"),
        F.col("sigla_uf").alias("uf"),
        F.col("l_linestatus").alias("situacao"),
        *[(value * F.lit(k).cast("decimal(3,0)")).cast("string").alias(c) for k, c in enumerate(measures, start=1)],
    )
    panel = works.campus_works_panel({"obras": raw, "filtro_territorio": territory(t)}, measures)
    return panel.groupBy("id", "municipio", "estado", "titulo", "municipio_obra", "situacao").agg(
        F.count(measures[0]).alias("obras"),
        money(measures[0]).cast("double").alias("valor"),
        money(measures[-1]).cast("double").alias("ultimo"),
    )


@query("panel_campus_a", campus_sql(str(len(works.CAMPUS_A_MEASURES))))
def panel_campus_a(t):
    return campus_works(t, works.CAMPUS_A_MEASURES)


@query("panel_campus_b", campus_sql(str(len(works.CAMPUS_B_MEASURES))))
def panel_campus_b(t):
    return campus_works(t, works.CAMPUS_B_MEASURES)


# --- school census ----------------------------------------------------------------------

# One census row per line item: column to (Spark expression text, also valid SQL).
QTY = "CAST(l_quantity AS BIGINT)"
CENSUS = {
    "ano": "CAST(year(l_shipdate) AS INTEGER)",
    "id_escola": "l_suppkey",
    "rede": "CAST(l_linenumber % 5 AS {text})",
    "tipo_localizacao": "CAST(l_partkey % 3 AS {text})",
    "tipo_localizacao_diferenciada": "CAST(l_orderkey % 5 AS {text})",
    "escolarizacao": "CASE WHEN l_returnflag = 'R' THEN '0' ELSE '1' END",
    "agua_inexistente": "CASE WHEN l_discount > 0.08 THEN 1 ELSE 0 END",
    "esgoto_inexistente": "CASE WHEN l_tax > 0.06 THEN 1 ELSE 0 END",
    "energia_inexistente": "CASE WHEN l_linenumber <> 7 THEN 0 END",
    "internet": "CASE WHEN l_quantity > 5 THEN 1 ELSE 0 END",
    "local_funcionamento_predio_escolar": "CASE WHEN l_partkey % 10 <> 0 THEN 1 END",
    "quantidade_docente_educacao_basica": "CAST(l_linenumber AS BIGINT)",
    "quantidade_matricula_educacao_basica": f"{QTY}",
    "quantidade_matricula_branca": f"CASE WHEN l_partkey % 4 = 0 THEN {QTY} ELSE 0 END",
    "quantidade_matricula_preta": f"CASE WHEN l_partkey % 4 = 1 THEN {QTY} ELSE 0 END",
    "quantidade_matricula_parda": f"CASE WHEN l_partkey % 4 = 2 THEN {QTY} ELSE 0 END",
    "quantidade_matricula_amarela": "CAST(0 AS BIGINT)",
    "quantidade_matricula_indigena": f"CASE WHEN l_partkey % 8 = 3 THEN {QTY} ELSE 0 END",
    "quantidade_matricula_nao_declarada": f"CASE WHEN l_partkey % 8 = 7 THEN {QTY} ELSE 0 END",
    "quantidade_matricula_infantil": f"CASE WHEN l_linenumber = 1 THEN {QTY} END",
    "quantidade_matricula_fundamental_anos_iniciais": f"CASE WHEN l_linenumber = 2 THEN {QTY} END",
    "quantidade_matricula_fundamental_anos_finais": f"CASE WHEN l_linenumber = 3 THEN {QTY} END",
    "quantidade_matricula_medio": f"CASE WHEN l_linenumber > 3 THEN {QTY} END",
}
FACILITY_COLUMNS = sorted({c for columns in schools.FACILITIES.values() for c in columns})
CENSUS.update(
    {
        column: f"CASE WHEN (l_partkey + {place}) % {place + 3} = 0 THEN 1 WHEN l_tax > 0.02 THEN 0 END"
        for place, column in enumerate(FACILITY_COLUMNS)
    }
)


def census(t):
    items = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    columns = [F.expr(text.format(text="STRING")).alias(name) for name, text in CENSUS.items()]
    return placed(items, "s_nationkey", t).select("id_municipio", *columns)


def school_names(t):
    key = F.col("s_suppkey")
    code = F.when(key % 10 == 0, "s/n").otherwise(F.lpad(key.cast("string"), 9, "0"))
    return t.supplier.select(code.alias("id_escola"), F.upper("s_name").alias("nome"))


CENSUS_SQL = (
    "censo AS (SELECT id_municipio, "
    + ", ".join(f"{text.format(text='VARCHAR')} AS {name}" for name, text in CENSUS.items())
    + " FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN mun ON s_nationkey = n_nationkey)"
)
NAME_SQL = "CASE WHEN id_escola % 10 = 0 THEN 'Sem informação' ELSE 'Supplier#' || lpad(CAST(id_escola AS VARCHAR), 9, '0') END"
SUMS_SQL = ", ".join(f"CAST(SUM({source}) AS BIGINT) AS {out}" for source, out in schools.SUMS.items())
NETWORK_SQL = "CASE rede WHEN '1' THEN 'Federal' WHEN '2' THEN 'Estadual' WHEN '3' THEN 'Municipal' WHEN '4' THEN 'Privada' END"
LOCATION_SQL = "CASE tipo_localizacao WHEN '1' THEN 'Urbana' WHEN '2' THEN 'Rural' END"
SPECIAL_SQL = """CASE tipo_localizacao_diferenciada WHEN '0' THEN 'Convencionais' WHEN '1' THEN 'Assentamento'
  WHEN '2' THEN 'Indígenas' WHEN '3' THEN 'Quilombolas' ELSE 'Outros' END"""
TOTAL = "SUM(quantidade_matricula_educacao_basica)"
BLACK_SQL = f"({TOTAL} <> 0 AND (SUM(quantidade_matricula_parda) + SUM(quantidade_matricula_preta)) * 10 >= 6 * {TOTAL})"
WHITE_SQL = f"({TOTAL} <> 0 AND SUM(quantidade_matricula_branca) * 10 >= 6 * {TOTAL})"
BASIC_SQL = {
    "agua": "agua_inexistente = 0",
    "esgoto": "esgoto_inexistente = 0",
    "energia": "energia_inexistente = 0",
    "internet": "internet = 1",
    "predio_escolar": "local_funcionamento_predio_escolar = 1",
}
FACILITY_SQL = {
    name: " OR ".join(f"{column} = 1" for column in columns) for name, columns in schools.FACILITIES.items()
}

INFRA_SQL = with_places(
    f"""SELECT p.*, mun.* EXCLUDE (id_municipio, nome, latitude, longitude, coordenada),
               mun.nome AS nome_municipio, coalesce(p.cod, mun.id_municipio) AS id_municipio
        FROM (SELECT ano, ano = (SELECT MAX(ano) FROM censo) AS ultimo_ano, id_municipio AS cod, id_escola,
                {NAME_SQL} AS nome_escola, {NETWORK_SQL} AS rede, {LOCATION_SQL} AS localizacao,
                tipo_localizacao_diferenciada AS cod_infraestrutura, {SPECIAL_SQL} AS infraestrutura,
                {", ".join(f"MAX(CASE WHEN {c} THEN 1 ELSE 0 END) AS possui_{n}" for n, c in {**BASIC_SQL, **FACILITY_SQL}.items())},
                CASE WHEN tipo_localizacao_diferenciada = '3' THEN 'Quilombolas' WHEN {BLACK_SQL} THEN 'Negros (Pretos ou Pardos ≥60%)' ELSE 'Não Negros' END AS maioria_racial_60_pct,
                CASE WHEN tipo_localizacao_diferenciada = '3' THEN 'Escolas quilombolas' WHEN {BLACK_SQL} THEN 'Escolas predominantemente negras'
                     WHEN {WHITE_SQL} THEN 'Escolas predominantemente brancas' ELSE 'Outros' END AS predominancia_racial_especifica,
                CASE WHEN {BLACK_SQL} THEN 'Pessoas Negras e Pardas' ELSE 'Outros Grupos Raciais' END AS grupo_racial_dashboard,
                {SUMS_SQL}
              FROM censo WHERE escolarizacao = '1'
              GROUP BY censo.ano, censo.id_municipio, censo.id_escola, censo.rede, censo.tipo_localizacao, censo.tipo_localizacao_diferenciada) p
        FULL JOIN mun ON p.cod = mun.id_municipio""",
    CENSUS_SQL,
).replace("SELECT p.*,", "SELECT p.* EXCLUDE (cod),")


def census_sources(t):
    return {
        "censo": census(t),
        "escola": school_names(t),
        "municipio": municipalities(t),
        "filtro_territorio": territory(t),
    }


@query("panel_infra", INFRA_SQL)
def panel_infra(t):
    return schools.infrastructure_panel(census_sources(t))


SCORE_ROW = """(agua_inexistente + esgoto_inexistente + energia_inexistente + CASE WHEN internet = 1 THEN 0 ELSE 1 END
  + CASE WHEN local_funcionamento_predio_escolar = 1 THEN 0 ELSE 1 END)"""
MAJORITY_SQL = f"""CASE WHEN {TOTAL} = 0 THEN 'Sem maioria significativa (≥60%)' WHEN {WHITE_SQL} THEN 'Maioria de alunos brancos (≥60%)'
  WHEN {BLACK_SQL} THEN 'Maioria de alunos pretos ou pardos (≥60%)'
  WHEN SUM(quantidade_matricula_amarela) * 10 >= 6 * {TOTAL} THEN 'Maioria de alunos amarelos (≥60%)'
  WHEN SUM(quantidade_matricula_indigena) * 10 >= 6 * {TOTAL} THEN 'Maioria de alunos indígenas (≥60%)'
  WHEN SUM(quantidade_matricula_nao_declarada) * 10 >= 6 * {TOTAL} THEN 'Maioria sem declaração (≥60%)'
  ELSE 'Sem maioria significativa (≥60%)' END"""
BAND_SQL = f"""CASE WHEN {TOTAL} <= 50 THEN 'Até 50 matrículas' WHEN {TOTAL} <= 150 THEN 'De 51 a 150 matrículas'
  WHEN {TOTAL} <= 300 THEN 'De 151 a 300 matrículas' WHEN {TOTAL} <= 500 THEN 'De 301 a 500 matrículas'
  WHEN {TOTAL} <= 1000 THEN 'De 501 a 1000 matrículas' ELSE 'Mais de 1000 matrículas' END"""


def census_sql(possession: bool) -> str:
    """The census panel in SQL, with and without the possession columns."""
    flags = {("internet_escola" if possession and n == "internet" else n): c for n, c in BASIC_SQL.items()}
    if possession:
        flags.update({f"possui_{n}": c for n, c in FACILITY_SQL.items()})
    year = "ano" if possession else "CAST(CAST(ano AS VARCHAR) || '-01-01' AS DATE) AS ano_tratado"
    where = "escolarizacao = '1'" if possession else "escolarizacao = '1' AND ano = 1999 AND tipo_localizacao_diferenciada = '3'"
    special = f"tipo_localizacao_diferenciada AS cod_infraestrutura, {SPECIAL_SQL} AS infraestrutura," if possession else ""
    extra = ""
    if possession:
        extra = f", CASE WHEN {BLACK_SQL} THEN 'Pessoas Negras e Pardas' ELSE 'Outros Grupos Raciais' END AS grupo_racial_dashboard"
        extra += "".join(
            f", CAST(COUNT(*) FILTER (WHERE {c}) AS DOUBLE) / COUNT(*) * 100 AS pct_{n}" for n, c in FACILITY_SQL.items()
        )
    flag_cols = ", ".join(f"CASE WHEN {c} THEN 1 ELSE 0 END AS f_{n}" for n, c in flags.items())
    flag_out = ", ".join(f"f_{n} AS {n}" for n in flags)
    flag_keys = ", ".join(f"f_{n}" for n in flags)
    cols = f"""{year}, ano = (SELECT MAX(ano) FROM censo) AS ultimo_ano, id_municipio AS cod, id_escola, {NAME_SQL} AS nome_escola,
                {NETWORK_SQL} AS rede, {LOCATION_SQL} AS localizacao, {special} {flag_out},
                CAST(SUM({SCORE_ROW}) AS BIGINT) AS num_indice_infraestrutura_elementar,
                CASE WHEN SUM({SCORE_ROW}) >= 2 THEN 'Atende a 3 itens' WHEN SUM({SCORE_ROW}) = 1 THEN 'Atende a 4 itens'
                     WHEN SUM({SCORE_ROW}) = 0 THEN 'Atende a todos os itens' END AS indice_infraestrutura_elementar,
                {BAND_SQL} AS porte_escola, {MAJORITY_SQL} AS maioria_racial_60_pct, {SUMS_SQL}{extra}"""
    special_key = ", c.tipo_localizacao_diferenciada" if possession else ""
    return with_places(
        f"""SELECT lv.id, ter.municipio, ter.estado, b.id_municipio, b.nome AS nome_municipio, b.sigla_uf,
                   b.nome_uf AS estado_mapa, lv.dica AS dica_mapa, p.* EXCLUDE (cod)
            FROM mun b LEFT JOIN (
              SELECT {cols} FROM (SELECT *, {flag_cols} FROM censo WHERE {where}) c
              GROUP BY c.ano, c.id_municipio, c.id_escola, c.rede IN ('1'), {NETWORK_SQL.replace("rede", "c.rede", 1)},
                       {LOCATION_SQL.replace("tipo_localizacao", "c.tipo_localizacao", 1)}, {flag_keys}{special_key}, c.rede, c.tipo_localizacao) p
              ON p.cod = b.id_municipio
            CROSS JOIN LATERAL (SELECT b.id_municipio AS id, b.nome || ' - ' || b.sigla_uf AS dica
              UNION ALL SELECT b.id_uf, b.nome_uf UNION ALL SELECT '99', b.nome_uf) lv
            JOIN ter ON ter.id = lv.id""",
        CENSUS_SQL,
    )


@query("panel_census", census_sql(False))
def panel_census(t):
    return schools.census_panel(census_sources(t), year=1999, special_location="3")


def summarized(panel):
    """The possession panel reduced per territory and label, to compare sums."""
    keys = ["id", "municipio", "estado", "ano", "infraestrutura", "maioria_racial_60_pct", "porte_escola"]
    return panel.groupBy(*keys).agg(
        count("linhas"),
        F.sum("num_indice_infraestrutura_elementar").alias("pontos"),
        F.sum("possui_patio").alias("patios"),
        F.sum("quantidade_matricula_educacao_basica").alias("matriculas"),
        F.max("pct_cozinha").alias("pct_cozinha"),
        F.min("pct_quadra_esportes").alias("pct_quadra"),
    )


@query(
    "panel_possession",
    "SELECT id, municipio, estado, ano, infraestrutura, maioria_racial_60_pct, porte_escola, COUNT(*) AS linhas, "
    "CAST(SUM(num_indice_infraestrutura_elementar) AS BIGINT) AS pontos, CAST(SUM(possui_patio) AS BIGINT) AS patios, "
    "CAST(SUM(quantidade_matricula_educacao_basica) AS BIGINT) AS matriculas, MAX(pct_cozinha) AS pct_cozinha, "
    f"MIN(pct_quadra_esportes) AS pct_quadra FROM ({census_sql(True)}) GROUP BY ALL",
)
def panel_possession(t):
    panel = schools.census_panel(census_sources(t), year=None, special_location=None, possession=True)
    return summarized(panel)


# --- adhesion ---------------------------------------------------------------------------

ADHESION_FX = """rs AS (SELECT DISTINCT CASE WHEN nome_uf = 'AMERICA' THEN 'ZZ' WHEN c_custkey % 4 = 0 THEN sigla_uf ELSE id_municipio END AS codigo_acesso,
    c_custkey % 30 AS k, c_acctbal > 0 AS ok, c_acctbal > 8000 AS grande FROM customer JOIN mun ON c_nationkey = n_nationkey),
ad AS (SELECT DISTINCT codigo_acesso FROM rs WHERE ok),
es AS (SELECT DISTINCT codigo_acesso || CASE WHEN grande THEN '' ELSE '?' END AS codigo_acesso,
              CASE k % 3 WHEN 0 THEN 'Até 100 professores' WHEN 1 THEN 'Ainda não tenho estimativa' END AS vaga
       FROM rs),
an AS (SELECT ad.codigo_acesso, vaga FROM ad LEFT JOIN es USING (codigo_acesso)),
sp AS (SELECT id_municipio AS cod_ibge, sigla_uf, nome || ' - ' || sigla_uf AS nome, codigo_acesso, vaga, true AS cidade
       FROM mun LEFT JOIN an ON codigo_acesso = id_municipio
       UNION SELECT id_uf, sigla_uf, sigla_uf, codigo_acesso, vaga, false FROM mun LEFT JOIN an ON codigo_acesso = sigla_uf)"""

ADHESION_SQL = with_places(
    """SELECT DISTINCT ter.id, ter.estado, ter.municipio, x.sigla_uf, x.cod_ibge, x.nome,
              CASE WHEN x.codigo_acesso IS NOT NULL AND vaga IS NULL THEN 'Sem resposta'
                   WHEN vaga LIKE 'Ainda%' THEN 'Ainda sem estimativa' ELSE vaga END AS estimativa_vaga,
              CASE WHEN x.codigo_acesso IS NOT NULL AND vaga IS NULL THEN 'AO99' WHEN vaga LIKE 'Até%' THEN 'AO01'
                   WHEN vaga LIKE 'Ainda%' THEN 'AO06' END AS id_estimativa,
              CASE WHEN x.codigo_acesso IS NOT NULL THEN true END AS submissao,
              x.cidade AS indicador_municipio, NOT x.cidade AS indicador_uf
       FROM ter LEFT JOIN (SELECT cod_ibge AS id, * FROM sp WHERE cidade UNION ALL SELECT left(cod_ibge, 2), * FROM sp
                           UNION ALL SELECT '99', * FROM sp) x USING (id)""",
    ADHESION_FX,
)


def adhesion_sources(t):
    key = F.col("c_custkey")
    # Codes that no place has: those of one state, and of the smaller estimates.
    place = F.when(key % 4 == 0, F.col("sigla_uf")).otherwise(F.col("id_municipio"))
    code = F.when(F.col("nome_uf") == "AMERICA", "ZZ").otherwise(place)
    people = placed(t.customer, "c_nationkey", t)
    k = key % 30
    answers = people.select(code.alias("codigo_acesso"), F.when(F.col("c_acctbal") > 0, True).when(k > 3, False).alias("submissao"))
    vacancies = people.select(
        F.when(F.col("c_acctbal") > 8000, code).otherwise(F.concat(code, F.lit("?"))).alias("codigo_acesso"),
        F.when(k % 3 == 0, "Até 100 professores")
        .when(k % 3 == 1, "Ainda não tenho estimativa")
        .alias("estimativa_vaga"),
        F.lit(True).alias("submissao"),
    )
    return {
        "resposta": answers,
        "estimativa": vacancies,
        "municipio": municipalities(t),
        "filtro_territorio": territory(t),
    }


@query("panel_adhesion", ADHESION_SQL)
def panel_adhesion(t):
    return adhesion.adhesion_panel(adhesion_sources(t))


ADHESION_FULL_SQL = with_places(
    """SELECT ter.id, ter.municipio, ter.estado, ter.titulo, a.dia AS data_adesao,
              CASE WHEN a.codigo IN (SELECT id_municipio FROM mun WHERE capital_uf = 0) THEN 1 ELSE 0 END AS participa_municipio,
              CASE WHEN a.codigo IN ('AF', 'EU') THEN 1 ELSE 0 END AS participa_estado
       FROM ter LEFT JOIN (SELECT DISTINCT id_uf, sigla_uf FROM mun) u ON ter.id = u.id_uf
       LEFT JOIN (SELECT CASE WHEN nome_uf = 'ASIA' THEN 'ZZ' WHEN c_custkey % 3 = 0 THEN sigla_uf ELSE id_municipio END AS codigo,
                         DATE '2024-01-01' + CAST(c_custkey % 90 AS INTEGER) AS dia
                  FROM customer JOIN mun ON c_nationkey = n_nationkey) a
       ON ter.id = a.codigo OR u.sigla_uf = a.codigo"""
)
STATE_IDS = {"AF": "11", "AM": "12", "AS": "13", "EU": "14", "MI": "15"}


def adhesion_codes(t, silent=("ASIA",)):
    """Codes of the places that answered; answers of the ``silent`` states have a code that no place has."""
    key = F.col("c_custkey")
    code = (
        F.when(F.col("nome_uf").isin(*silent), "ZZ")
        .when(key % 3 == 0, F.col("sigla_uf"))
        .otherwise(F.col("id_municipio"))
    )
    return placed(t.customer, "c_nationkey", t).select(
        code.alias("codigo_acesso"),
        F.date_add(F.lit("2024-01-01").cast("date"), (key % 90).cast("int")).alias("data_envio"),
    )


@query("panel_adhesion_full", ADHESION_FULL_SQL)
def panel_adhesion_full(t):
    approved = municipalities(t).where("capital_uf = 0").select(F.col("id_municipio").alias("id"))
    sources = {
        "filtro_territorio": territory(t),
        "adesao": adhesion_codes(t),
        "municipios_aprovados": approved,
    }
    return adhesion.adhesion_full_panel(sources, ["AF", "EU"], STATE_IDS)


@query(
    "panel_adhesion_inherited",
    with_places(
        """SELECT id_municipio, nome, id_uf, sigla_uf, CASE WHEN id_municipio IN (SELECT codigo FROM a) THEN 1 ELSE 0 END AS participa_municipio,
                  bool_or(id_municipio IN (SELECT codigo FROM a) OR sigla_uf IN (SELECT codigo FROM a)) OVER (PARTITION BY id_uf) AS uf_participa
           FROM mun""",
        """a AS (SELECT CASE WHEN nome_uf IN ('ASIA', 'EUROPE') THEN 'ZZ' WHEN c_custkey % 3 = 0 THEN sigla_uf ELSE id_municipio END AS codigo
                 FROM customer JOIN mun ON c_nationkey = n_nationkey)""",
    ),
)
def panel_adhesion_inherited(t):
    codes = adhesion_codes(t, silent=("ASIA", "EUROPE"))
    return adhesion.inherited_adhesion({"municipio": municipalities(t), "adesao": codes})


# --- teachers ---------------------------------------------------------------------------

TRANSITION_FX = """inc AS (SELECT o_custkey AS id_pessoa, mun.id_municipio, o_orderstatus AS id_rede,
    strftime(o_orderdate, '%Y%m') AS mes FROM orders LEFT JOIN mun ON n_nationkey = o_orderkey % 30
    WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND year(o_orderdate) = 2000),
med AS (SELECT inc.*, mun.nome, mun.sigla_uf FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id_pessoa
          ORDER BY mes DESC, id_municipio NULLS FIRST, id_rede) AS rn FROM inc) WHERE rn = 1) inc LEFT JOIN mun USING (id_municipio)),
cad AS (SELECT user_id + 50 AS id_pessoa, CASE WHEN event_type = 'click' THEN NULL ELSE event_type END AS curso,
    nome || '-x' AS municipio, sigla_uf, CAST(ts AS DATE) AS dia, value > 5 AS beneficiario FROM events JOIN mun ON n_nationkey = event_id % 25),
lic{0} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id_pessoa ORDER BY dia DESC, curso NULLS FIRST, municipio, sigla_uf) AS rn
          FROM cad{1}) WHERE rn = 1),
pes AS (SELECT CAST(coalesce(med.id_pessoa, lic{0}.id_pessoa) AS VARCHAR) AS id_pessoa,
    CASE WHEN med.rn = 1 AND lic{0}.rn = 1 THEN 1 ELSE 0 END AS beneficiario_ambos,
    CASE WHEN med.rn = 1 AND lic{0}.rn IS NULL THEN 1 ELSE 0 END AS apenas_ensino_medio,
    CASE WHEN med.rn IS NULL AND lic{0}.rn = 1 THEN 1 ELSE 0 END AS apenas_licenciatura,
    trim(split_part(coalesce(med.nome, lic{0}.municipio), '-', 1)) AS municipio, coalesce(med.sigla_uf, lic{0}.sigla_uf) AS uf,
    med.id_rede AS rede_ensino_medio, lic{0}.curso AS curso_licenciatura
    FROM med FULL JOIN lic{0} ON med.id_pessoa = lic{0}.id_pessoa)"""


def transition_sources(t):
    orders = t.orders.join(
        municipalities(t), F.col("o_orderkey") % 30 == F.col("n_nationkey"), "left"
    )
    priority = F.col("o_orderpriority")
    payments = orders.select(
        F.col("o_custkey").alias("id_pessoa"),
        "id_municipio",
        F.col("o_orderstatus").alias("id_rede"),
        F.date_format("o_orderdate", "yyyyMM").alias("id_mes_competencia"),
        F.when(priority == "1-URGENT", "105").when(priority == "2-HIGH", "115").otherwise("200").alias("id_tipo_status_parcela"),
    )
    events = t.events.join(municipalities(t), F.col("event_id") % 25 == F.col("n_nationkey"))
    register = events.select(
        (F.col("user_id") + 50).alias("id_pessoa"),
        F.nullif("event_type", F.lit("click")).alias("curso"),
        F.concat("nome", F.lit("-x")).alias("municipio"),
        "sigla_uf",
        F.to_date("ts").alias("data_referencia"),
        (F.col("value") > 5).alias("beneficiario"),
    )
    return {"incentivo": payments, "cadastro": register, "municipio": municipalities(t), "uf": states(t)}


@query(
    "transition",
    with_places(
        """SELECT pes.*, region.r_name AS estado FROM pes LEFT JOIN region ON uf = left(r_name, 2)""",
        TRANSITION_FX.format("", " WHERE beneficiario"),
    ),
)
def transition(t):
    return teachers.transition_people(transition_sources(t), year="2000")


CATEGORY_SUMS = ", ".join(f"CAST(SUM({c}) AS BIGINT) AS {c}" for c in teachers.CATEGORIES)


@query(
    "transition_rollup",
    with_places(
        f"""SELECT lv.*, CASE WHEN nivel_agregacao <> 'Municipio' THEN 'Todos' ELSE r_name END AS estado,
                   coalesce(r_name, 'Brasil') AS estado_nome, CASE WHEN nivel_agregacao = 'Municipio' THEN municipio END AS municipio_nome
            FROM (SELECT uf, municipio, 'Municipio' AS nivel_agregacao, curso_licenciatura, {CATEGORY_SUMS} FROM p2 GROUP BY ALL
                  UNION ALL SELECT uf, 'Todos', 'Estado', curso_licenciatura, {CATEGORY_SUMS} FROM p2 GROUP BY ALL
                  UNION ALL SELECT 'Todos', 'Todos', 'Nacional', curso_licenciatura, {CATEGORY_SUMS} FROM p2 GROUP BY ALL) lv
            LEFT JOIN region ON uf = left(r_name, 2)""",
        TRANSITION_FX.format("", ""),
        """p2 AS (SELECT * REPLACE (coalesce(curso_licenciatura, 'Sem curso') AS curso_licenciatura) FROM pes
                  WHERE uf IS NOT NULL AND municipio IS NOT NULL)""",
    ),
)
def transition_rollup(t):
    return teachers.transition_rollup(transition_sources(t), year="2000")


@query(
    "panel_eligibility",
    with_places(
        """SELECT e.*, ter.municipio, ter.estado, ter.titulo FROM (
             SELECT c_custkey AS id_pessoa, c_mktsegment AS curso, CAST(id_municipio AS BIGINT) AS codigo_ibge_curso, 'prouni' AS origem
             FROM customer JOIN mun ON c_nationkey = n_nationkey
             UNION ALL SELECT s_suppkey, 'pedagogia', CAST(1 AS BIGINT), 'sisu' FROM supplier) e
           LEFT JOIN ter ON CAST(codigo_ibge_curso AS VARCHAR) = ter.id"""
    ),
)
def panel_eligibility(t):
    first = placed(t.customer, "c_nationkey", t).select(
        F.col("c_custkey").alias("id_pessoa"),
        F.col("c_mktsegment").alias("curso"),
        F.col("id_municipio").cast("bigint").alias("codigo_ibge_curso"),
        F.col("c_name").alias("nome_pessoa"),
        F.col("c_name").alias("cpf"),
    )
    second = t.supplier.select(
        F.lit(1).cast("bigint").alias("codigo_ibge_curso"),
        F.lit("pedagogia").alias("curso"),
        F.col("s_suppkey").alias("id_pessoa"),
        F.col("s_name").alias("nome_pessoa"),
    )
    sources = {"prouni": first, "sisu": second, "filtro_territorio": territory(t)}
    return teachers.eligibility_panel(sources)


@query(
    "panel_scholarship",
    """SELECT s.*, e.curso, e.turno_curso, e.ies, e.sigla_ies, e.origem AS origem_elegibilidade
       FROM (SELECT coalesce(CAST(o.emec AS VARCHAR), u.cod) AS id_entidade_emec, o.id_pessoa, o.ano_pagamento, u.nm_uf, u.mes AS mes_referencia_geo,
               u.ano AS ano_referencia_geo
             FROM (SELECT CAST(o_custkey % 40 AS INTEGER) AS emec, o_custkey AS id_pessoa, CAST(year(o_orderdate) AS INTEGER) AS ano_pagamento FROM orders) o
             FULL JOIN (SELECT CAST(s_suppkey % 50 + 10 AS VARCHAR) AS cod, s_name AS nm_uf, 3 AS mes, 2025 AS ano FROM supplier) u
             ON CAST(o.emec AS VARCHAR) = u.cod) s
       LEFT JOIN (SELECT CASE WHEN c_acctbal > 5000 THEN c_custkey ELSE -c_custkey END AS id_pessoa, c_mktsegment AS curso, 'noite' AS turno_curso, c_name AS ies, 'X' AS sigla_ies, 'sisu' AS origem
                  FROM customer) e USING (id_pessoa)""",
)
def panel_scholarship(t):
    payments = t.orders.select(
        (F.col("o_custkey") % 40).cast("int").alias("id_entidade_emec"),
        F.col("o_custkey").alias("id_pessoa"),
        F.year("o_orderdate").alias("ano_pagamento"),
    )
    by_state = t.supplier.select(
        (F.col("s_suppkey") % 50 + 10).cast("string").alias("cd_entidade_emec"),
        F.col("s_name").alias("nm_uf"),
        F.lit(3).alias("me_referencia"),
        F.lit(2025).alias("an_referencia"),
    )
    eligible = t.customer.select(
        F.when(F.col("c_acctbal") > 5000, F.col("c_custkey")).otherwise(-F.col("c_custkey")).alias("id_pessoa"),
        F.col("c_mktsegment").alias("curso"),
        F.lit("noite").alias("turno_curso"),
        F.col("c_name").alias("ies"),
        F.lit("X").alias("sigla_ies"),
        F.lit("sisu").alias("origem"),
    )
    # People are looked up in the payments: the list by state repeats a payment for each of its rows.
    panel = teachers.scholarship_panel(teachers.training_view(payments, eligible), by_state)
    return panel.select(
        "id_pessoa", "id_entidade_emec", "ano_pagamento", "nm_uf", "mes_referencia_geo", "ano_referencia_geo",
        "curso", "turno_curso", "ies", "sigla_ies", "origem_elegibilidade",
    )


# --- budget ---------------------------------------------------------------------------------

INDEX = [(1996, "1.48701"), (1997, "1.35"), (1998, "1.2"), (1999, "1.1"), (2000, "1.05"), (2001, "1")]
GROUP_SQL = "CASE WHEN {c} = {a} THEN 'PESSOAL E ENCARGOS SOCIAIS' WHEN {c} = {b} THEN 'INVESTIMENTOS' ELSE 'OUTRAS DESPESAS CORRENTES' END"
OWN_GROUP = GROUP_SQL.format(c="o_orderpriority", a="'1-URGENT'", b="'5-LOW'")
RECEIVED_GROUP = GROUP_SQL.format(c="l_linenumber", a="1", b="2")
BUDGET_MEASURES = ["ploa", "loa", "dotacao", "destaque", "empenhado"]
BUDGET_SQL = f"""WITH f AS (
    SELECT CAST(year(o_orderdate) AS INTEGER) AS ano, CAST(o_custkey AS VARCHAR) AS id_unidade_orcamentaria, 'crédito originário' AS origem,
      {OWN_GROUP} AS grupo_despesa, o_orderstatus AS resultado_lei, '000' AS id_fonte, 'LIVRE' AS fonte,
      CAST(o_totalprice AS DECIMAL(18,2)) AS ploa, CAST(o_totalprice AS DECIMAL(18,2)) * 2 AS loa, CAST(o_totalprice AS DECIMAL(18,2)) AS dotacao,
      NULL AS destaque, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS empenhado FROM orders
    UNION ALL
    SELECT CAST(year(l_shipdate) AS INTEGER), CAST(l_suppkey AS VARCHAR), 'crédito recebido', {RECEIVED_GROUP}, l_linestatus, '050', 'PROPRIO',
      NULL, NULL, NULL, CAST(l_extendedprice AS DECIMAL(18,2)), CASE WHEN l_linenumber <> 5 THEN CAST(l_extendedprice AS DECIMAL(18,2)) END
    FROM lineitem),
  idx(ano, fator) AS (VALUES {", ".join(f"({y}, CAST({v} AS DECIMAL(12,8)))" for y, v in INDEX)}),
  g AS (SELECT ano, id_unidade_orcamentaria, origem, grupo_despesa, resultado_lei, id_fonte, fonte,
      {", ".join(f"CAST(coalesce(SUM({m}), 0) AS DECIMAL(18,2)) AS {m}" for m in BUDGET_MEASURES)} FROM f GROUP BY ALL)
  SELECT g.* EXCLUDE ({", ".join(BUDGET_MEASURES)}),
    CASE grupo_despesa WHEN 'PESSOAL E ENCARGOS SOCIAIS' THEN 'Pessoal' WHEN 'INVESTIMENTOS' THEN 'Investimento' ELSE 'Custeio' END AS macro_grupo_despesa,
    c_name AS unidade_orcamentaria, c_mktsegment AS grupo_unidade_orcamentaria,
    {", ".join(f"CAST({m} AS DOUBLE) AS total_{m}, CAST(CAST({m} * fator AS DECIMAL(18,2)) AS DOUBLE) AS total_{m}_ipca" for m in BUDGET_MEASURES)}
  FROM g JOIN customer ON CAST(c_custkey AS VARCHAR) = id_unidade_orcamentaria LEFT JOIN idx USING (ano)"""


@query("panel_budget", BUDGET_SQL)
def panel_budget(t):
    price = F.col("o_totalprice")
    own = t.orders.select(
        F.year("o_orderdate").alias("ano"),
        F.col("o_custkey").cast("string").alias("id_unidade_orcamentaria"),
        F.expr(OWN_GROUP).alias("grupo_despesa"),
        F.col("o_orderstatus").alias("resultado_lei"),
        F.lit("000").alias("id_fonte"),
        F.lit("LIVRE").alias("fonte"),
        price.alias("ploa"),
        (price * 2).alias("loa"),
        price.alias("dotacao_atualizada"),
        F.when(F.col("o_orderstatus") != "P", price).alias("despesa_empenhada"),
    )
    body = F.col("l_suppkey")
    received = t.lineitem.select(
        F.year("l_shipdate").alias("ano"),
        body.cast("string").alias("id_orgao_uge"),
        F.when(F.col("l_linenumber") == 5, body).otherwise(body + 1).cast("string").alias("id_unidade_orcamentaria"),
        F.expr(RECEIVED_GROUP).alias("grupo_despesa"),
        F.col("l_linestatus").alias("resultado_lei"),
        F.lit("050").alias("id_fonte"),
        F.lit("PROPRIO").alias("fonte"),
        F.col("l_extendedprice").alias("destaque_recebido"),
        F.col("l_extendedprice").alias("despesa_empenhada"),
    )
    groups = t.customer.select(
        F.col("c_custkey").alias("id_unidade_orcamentaria"),
        F.col("c_name").alias("unidade_orcamentaria"),
        F.col("c_mktsegment").alias("grupo_unidade_orcamentaria"),
    )
    index = literal_table(t.spark, INDEX, "ano int, fator string")
    return budget.budget_panel({"proprio": own, "recebido": received, "grupo": groups, "indice": index})


# Two loads of each year and unit; the earlier one of a unit that has both does not count.
TREASURY_SQL = f"""o AS (
    SELECT CAST(year(o_orderdate) AS INTEGER) AS ano, CAST(o_custkey AS VARCHAR) AS unidade, 'crédito originário' AS origem,
      {OWN_GROUP} AS grupo_despesa, o_orderkey % 11 AS lei, o_orderkey % 3 AS f, o_orderkey % 5 AS a,
      DATE '2025-03-01' + CAST(o_orderkey % 2 AS INTEGER) AS dia, {fine_sql("o_totalprice")} AS ploa, {fine_sql("o_totalprice")} * 2 AS loa,
      {fine_sql("o_totalprice")} AS dotacao, NULL AS destaque, CASE WHEN o_orderstatus <> 'P' THEN {fine_sql("o_totalprice")} END AS empenhado
    FROM orders),
  r AS (
    SELECT CAST(year(l_shipdate) AS INTEGER) AS ano, CAST(l_suppkey AS VARCHAR) AS unidade, 'crédito recebido' AS origem,
      {RECEIVED_GROUP} AS grupo_despesa, l_orderkey % 11 AS lei, l_orderkey % 3 AS f, l_orderkey % 5 AS a,
      DATE '2025-03-01' + CAST(l_orderkey % 2 AS INTEGER) AS dia, NULL AS ploa, NULL AS loa, NULL AS dotacao,
      {fine_sql("l_extendedprice")} AS destaque, CASE WHEN l_linenumber <> 5 THEN {fine_sql("l_extendedprice")} END AS empenhado
    FROM lineitem),
  b AS (
    SELECT * EXCLUDE (lei, f, a, dia), dia AS data_atualizacao,
      CASE grupo_despesa WHEN 'PESSOAL E ENCARGOS SOCIAIS' THEN 'Pessoal' WHEN 'INVESTIMENTOS' THEN 'Investimento' ELSE 'Custeio' END AS macro_grupo_despesa,
      CASE lei WHEN 0 THEN 'Financeira' WHEN 1 THEN 'Obrigatória' WHEN 2 THEN 'Discricionária' WHEN 3 THEN 'Programa de Aceleração'
        WHEN 6 THEN 'Emenda individual' WHEN 7 THEN 'Emenda de bancada' WHEN 8 THEN 'Emenda de comissão' WHEN 9 THEN 'Emenda de relator'
        ELSE 'Outras' END AS resultado_lei,
      CASE f WHEN 0 THEN 'Próprios' ELSE 'Tesouro' END AS tipo_fonte, CASE f WHEN 0 THEN '050' WHEN 1 THEN '100' ELSE '8144' END AS id_fonte,
      'F' || f AS fonte, CASE a WHEN 0 THEN '4002' WHEN 1 THEN '2994' ELSE '20RK' END AS id_acao, 'A' || a AS acao
    FROM (SELECT * FROM o UNION ALL SELECT * FROM r) x
    QUALIFY dia = MAX(dia) OVER (PARTITION BY origem, ano, unidade)),
  idx(ano, fator) AS (VALUES {", ".join(f"({y}, CAST({v} AS DECIMAL(12,8)))" for y, v in INDEX)})"""


def treasury_sql(keys: str, measures: list[str], where: str = "true") -> str:
    sums = ", ".join(f"CAST(coalesce(SUM({m}), 0) AS DECIMAL(28,2)) AS {m}" for m in measures)
    shown = ", ".join(
        f"CAST({m} AS DOUBLE) AS total_{m}, CAST(CAST({m} * fator AS DECIMAL(18,2)) AS DOUBLE) AS total_{m}_ipca" for m in measures
    )
    return f"""WITH {TREASURY_SQL}, g AS (
        SELECT ano, unidade, {keys}, MAX(data_atualizacao) AS data_atualizacao, {sums} FROM b WHERE {where} GROUP BY ALL)
      SELECT g.* EXCLUDE (unidade, {", ".join(measures)}), unidade AS id_unidade_orcamentaria, c_name AS unidade_orcamentaria,
        c_mktsegment AS grupo_unidade_orcamentaria, {shown}
      FROM g JOIN customer ON CAST(c_custkey AS VARCHAR) = unidade LEFT JOIN idx USING (ano)"""


def treasury(t):
    """The treasury base, the names of its units and the price index."""
    def kinds(key, group):
        f, a = F.col(key) % 3, F.col(key) % 5
        return [
            F.expr(group).alias("grupo_despesa"),
            (F.col(key) % 11).cast("string").alias("id_resultado_lei"),
            F.when(f == 0, "050").when(f == 1, "100").otherwise("8144").alias("id_fonte"),
            F.concat(F.lit("F"), f.cast("string")).alias("fonte"),
            F.when(a == 0, "4002").when(a == 1, "2994").otherwise("20RK").alias("id_acao"),
            F.concat(F.lit("A"), a.cast("string")).alias("acao"),
            F.date_add(F.lit("2025-03-01").cast("date"), (F.col(key) % 2).cast("int")).alias("data_ultima_atualizacao"),
        ]

    price, got, body = fine("o_totalprice"), fine("l_extendedprice"), F.col("l_suppkey")
    own = t.orders.select(
        F.year("o_orderdate").alias("ano"),
        F.col("o_custkey").cast("string").alias("id_unidade_orcamentaria"),
        *kinds("o_orderkey", OWN_GROUP),
        price.alias("ploa"),
        (price * 2).alias("loa"),
        price.alias("dotacao_atualizada"),
        F.when(F.col("o_orderstatus") != "P", price).alias("despesa_empenhada"),
    )
    received = t.lineitem.select(
        F.year("l_shipdate").alias("ano"),
        body.cast("string").alias("id_orgao_uge"),
        F.when(F.col("l_linenumber") == 5, body).otherwise(body + 1).cast("string").alias("id_unidade_orcamentaria"),
        *kinds("l_orderkey", RECEIVED_GROUP),
        got.alias("destaque_recebido"),
        got.alias("despesa_empenhada"),
    )
    groups = t.customer.select(
        F.col("c_custkey").alias("id_unidade_orcamentaria"),
        F.col("c_name").alias("unidade_orcamentaria"),
        F.col("c_mktsegment").alias("grupo_unidade_orcamentaria"),
    )
    index = literal_table(t.spark, INDEX, "ano int, fator string")
    return budget.budget_base({"proprio": own, "recebido": received}), groups, index


@query(
    "panel_budget_base",
    f"""WITH {TREASURY_SQL} SELECT ano, unidade AS id_unidade_orcamentaria, origem, tipo_fonte, resultado_lei, id_acao, data_atualizacao,
          COUNT(*) AS linhas, {sql_sum("empenhado")} AS empenhado FROM b GROUP BY ALL""",
)
def panel_budget_base(t):
    keys = ["ano", "id_unidade_orcamentaria", "origem", "tipo_fonte", "resultado_lei", "id_acao", "data_atualizacao"]
    return treasury(t)[0].groupBy(*keys).agg(count("linhas"), money("despesa_empenhada").cast("double").alias("empenhado"))


@query(
    "panel_university_budget",
    treasury_sql(
        "macro_grupo_despesa, grupo_despesa, resultado_lei, tipo_fonte, id_fonte, fonte", ["ploa", "loa", "dotacao", "empenhado"]
    ),
)
def panel_university_budget(t):
    return budget.university_budget(*treasury(t))


@query(
    "panel_received_credit",
    treasury_sql(
        "grupo_despesa, resultado_lei, tipo_fonte, id_fonte, fonte, id_acao, acao", ["destaque", "empenhado"],
        "origem = 'crédito recebido'",
    ),
)
def panel_received_credit(t):
    return budget.received_credit(*treasury(t))


@query(
    "panel_student_aid",
    treasury_sql("origem, id_acao, acao", ["loa", "dotacao", "destaque", "empenhado"], "id_acao IN ('4002', '2994')"),
)
def panel_student_aid(t):
    return budget.student_aid(*treasury(t))


@query(
    "panel_universities",
    """SELECT CAST(year(l_shipdate) AS INTEGER) AS ano_censo, l_returnflag AS sigla_uf,
              CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS matriculas, COUNT(DISTINCT l_suppkey) AS instituicoes
       FROM lineitem l WHERE l_linenumber IN (1, 2) AND l_returnflag <> 'N' AND EXISTS (
         SELECT 1 FROM lineitem i WHERE CASE WHEN i.l_quantity > 49 THEN i.l_suppkey ELSE -i.l_suppkey END = l.l_suppkey
           AND year(i.l_shipdate) = year(l.l_shipdate))
       GROUP BY 1, 2""",
)
def panel_universities(t):
    courses = t.lineitem.select(
        F.col("l_suppkey").alias("id_ies"),
        F.year("l_shipdate").alias("ano_censo"),
        F.nullif("l_returnflag", F.lit("N")).alias("sigla_uf"),
        F.lit(1).alias("id_tipo_nivel_academico"),
        F.lit(1).alias("id_tipo_categoria_administrativa"),
        F.lit(1).alias("id_tipo_organizacao_academica"),
        F.col("l_linenumber").alias("id_tipo_modalidade_ensino"),
        F.col("l_quantity").cast("bigint").alias("quantidade_matriculas"),
    )
    # Institutions of the other rows have numbers that no course has.
    number = F.when(F.col("l_quantity") > 49, F.col("l_suppkey")).otherwise(-F.col("l_suppkey"))
    institutions = t.lineitem.select(number.alias("id_ies"), F.year("l_shipdate").alias("ano_censo"))
    return budget.universities_series({"curso": courses, "ies": institutions})
