"""The briefing on the benchmark tables.

Every source is one SELECT that both engines understand; on the Spark side the
names in braces are frames, on the SQL side tables and common table expressions.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from civicpanel.catalogue import sql_text as sql
from civicpanel.catalogue.places import PLACED_ORDERS, municipalities, placed, placed_orders, states, with_places
from civicpanel.catalogue.registry import query
from civicpanel.lineage import Scratch, written
from civicpanel.operators.aggregate import person_bitmaps
from civicpanel.plans import briefing

K = "o_orderkey"
STATE_LEVEL = f"CASE {K} % 3 WHEN 0 THEN id_municipio WHEN 1 THEN id_uf ELSE '99' END"
SOURCES = {
    "conectividade": f"""SELECT sigla_uf, CASE o_orderstatus WHEN 'F' THEN '{briefing.CONNECTED_LEVELS[0]}'
        WHEN 'O' THEN '{briefing.CONNECTED_LEVELS[1]}' ELSE 'Outra' END AS escolas_conectadas_nivel FROM {{po}}""",
    "peti": f"""SELECT CASE WHEN {K} % 50 = 0 THEN 'BR' ELSE sigla_uf END AS uf,
        CASE {K} % 3 WHEN 0 THEN '2023/2024' WHEN 1 THEN '2024' ELSE '2022' END AS peti_04_ciclo,
        o_custkey AS peti_07_qtd_matricula_declarada_ciclo, o_totalprice AS peti_09_valor_pago_ciclo FROM {{po}}""",
    "transferencias": f"""SELECT sigla_uf AS uf, {K} % 100 AS matriculas_fundeb, o_totalprice AS valor_total_fomento,
        'repasse' AS tipo_registro, CASE {K} % 3 WHEN 0 THEN 'municipio' WHEN 1 THEN 'estado' ELSE 'pais' END AS nivel_territorial FROM {{po}}""",
    "incentivo_historico": f"""SELECT {STATE_LEVEL} AS id, o_custkey AS id_pessoa, o_totalprice AS valor_enviado,
        CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE {K} % 10 <> 0 END AS ultima_carga,
        CASE {K} % 4 WHEN 0 THEN '105' WHEN 1 THEN '115' WHEN 2 THEN '105' ELSE '200' END AS id_tipo_status_parcela FROM {{po}}""",
    "matricula_unica": "SELECT c_custkey AS id_pessoa, id_uf FROM {pc}",
    "pacto": f"""SELECT CASE WHEN {K} % 3 < 2 THEN id_uf ELSE '99' END AS id, o_custkey AS id_obra, sigla_uf,
        o_totalprice AS valor_previsto, o_totalprice AS valor_repasse,
        CASE WHEN {K} % 5 <> 0 THEN {K} % 5 <> 1 END AS indicador_aprovada FROM {{po}}""",
    "selecoes": f"""SELECT CASE WHEN {K} % 6 < 4 THEN '99' ELSE id_uf END AS id, sigla_uf,
        CASE {K} % 4 WHEN 0 THEN 'Creches' WHEN 1 THEN 'Escolas Tempo Integral' WHEN 2 THEN 'Ônibus' END AS modalidade,
        CASE {K} % 7 WHEN 0 THEN 'Prop. Cancelada' WHEN 1 THEN NULL ELSE 'Em obra' END AS situacao,
        o_totalprice AS valor_repasse, o_totalprice AS valor_investimento FROM {{po}}""",
    "sesu": """SELECT CASE WHEN l_linenumber <> 7 THEN '99' ELSE id_uf END AS id, sigla_uf,
        CASE l_returnflag WHEN 'A' THEN 'Consolidação' WHEN 'N' THEN 'Expansão' ELSE 'Outra' END AS categoria,
        CASE l_partkey % 4 WHEN 0 THEN 'Laboratório' WHEN 1 THEN 'Biblioteca' WHEN 2 THEN 'Restaurante' END AS tipologia,
        s_name AS instituicao, CASE WHEN l_partkey % 9 <> 0 THEN nome END AS municipio_obra,
        l_extendedprice AS valor_previsto, 'Obra' AS nome_empreendimento FROM {ps}""",
    "setec": """SELECT CASE WHEN l_linenumber <> 7 THEN '99' ELSE id_uf END AS id,
        CAST(l_suppkey AS STRING) || CASE WHEN l_linenumber % 2 = 0 THEN '99' ELSE '' END AS id_governa,
        CASE WHEN l_partkey % 50 = 0 THEN '-' ELSE sigla_uf END AS sigla_uf,
        CASE l_partkey % 4 WHEN 0 THEN 'Expansão' WHEN 1 THEN 'EXPANSÃO' WHEN 2 THEN 'Ginásio' END AS tipologia,
        CASE WHEN l_linenumber < 4 THEN 'Obra' ELSE 'Equipamento' END AS natureza_empreendimento,
        CASE l_returnflag WHEN 'A' THEN 'Consolidação' WHEN 'N' THEN 'Expansão' END AS categoria_resumido,
        CASE WHEN l_partkey % 9 <> 0 THEN nome END AS municipio_obra,
        CASE WHEN l_partkey % 10 <> 0 THEN l_extendedprice END AS valor_previsto,
        s_name AS instituicao, 'Obra' AS nome_empreendimento FROM {ps}""",
    "ebserh": """SELECT CASE WHEN sigla_uf IN ('AF', 'EU') THEN '99' ELSE id_uf END AS id, sigla_uf, 'HU ' || nome AS nome_empreendimento,
        l_extendedprice AS valor_novo_pac FROM {ps}""",
    "fundeb": f"""SELECT sigla_uf, CAST(2020 + {K} % 7 AS INT) AS ano, o_totalprice AS valor,
        CASE o_custkey % 4 WHEN 0 THEN 'Complementação VAAF' WHEN 1 THEN 'Complementação VAAT' WHEN 2 THEN 'Complementação VAAR' END AS tipo_transferencia,
        CASE WHEN o_orderstatus = 'P' THEN 'Previsto' ELSE 'Realizado' END AS status FROM {{po}}""",
    "fundeb_painel": f"""SELECT sigla_uf AS uf, CAST(2024 + {K} % 3 AS INT) AS ano,
        CASE WHEN {K} % 2 = 0 THEN 'Todos' ELSE nome END AS municipio, CASE WHEN {K} % 5 = 0 OR sigla_uf = 'MI' THEN 'Todos' ELSE nome_uf END AS estado,
        'Realizado' AS status, o_totalprice AS repasse FROM {{po}}""",
    "pnae": f"""SELECT lower(nome_uf) AS estado, CASE WHEN {K} % 2 = 0 THEN 'Todos' ELSE nome END AS municipio,
        {K} % 13 AS qtd_escola FROM {{po}}""",
    "pnae_repasse": f"""SELECT sigla_uf AS uf, o_totalprice AS pnae_03_val_repasse,
        CAST(2021 + {K} % 4 AS STRING) || '-03' AS dt_ref FROM {{po}}""",
    "pnate": f"""SELECT {STATE_LEVEL} AS id, lower(nome_uf) AS estado, {K} % 17 AS qtd_aluno, o_totalprice AS val_repasse FROM {{po}}""",
    "pnp_matricula": """SELECT l_suppkey AS chave_unidade, l_suppkey % 13 AS id_unidade,
        CASE WHEN l_linenumber < 6 THEN 2024 ELSE 2023 END AS ano, CAST(l_quantity AS BIGINT) AS numero_matriculas FROM {lineitem}""",
    "pnp_instituicao": "SELECT s_suppkey AS chave_unidade, s_suppkey % 17 AS id_instituicao, sigla_uf FROM {pu}",
    "pnp_organizacao": """SELECT s_suppkey AS chave_unidade, CASE WHEN s_suppkey % 5 = 0 THEN 'Outros' ELSE 'Institutos' END
        AS organizacao_administrativa FROM {supplier}""",
    "campus": """SELECT CASE WHEN s_suppkey % 10 <> 3 THEN sigla_uf END AS sigla_uf, 'U' || CAST(s_suppkey % 11 AS STRING) AS sigla_ies,
        'C' || CAST(s_suppkey % 4 AS STRING) AS campus,
        CASE s_suppkey % 6 WHEN 0 THEN 'Em Transformação Para Campus' WHEN 1 THEN NULL ELSE 'Ativo' END AS status_funcionamento FROM {pu}""",
    "curso": """SELECT l_suppkey AS id_ies, CASE WHEN l_linenumber < 6 THEN 2024 ELSE 2023 END AS ano_censo, 1 AS id_tipo_nivel_academico,
        1 AS id_tipo_categoria_administrativa, 1 AS id_tipo_organizacao_academica, l_linenumber AS id_tipo_modalidade_ensino,
        sigla_uf, CAST(l_quantity AS BIGINT) AS quantidade_matriculas FROM {ps}""",
    "ies": "SELECT s_suppkey AS id_ies, CASE WHEN s_suppkey % 8 = 0 THEN 2023 ELSE 2024 END AS ano_censo FROM {supplier}",
    "cnca": f"""SELECT {STATE_LEVEL} AS id, CASE {K} % 3 WHEN 0 THEN nome ELSE 'Todos' END AS municipio, sigla_uf,
        CAST(2025 + o_custkey % 2 AS INT) AS ano, {K} % 5 AS qtd_cantinho_leitura_apoiado, {K} % 7 AS qtd_escolas_apoiadas_cantinho_leitura,
        {K} % 11 AS qtd_articuladores_total, {K} % 3 AS qtd_articuladores_renalfa_regional, {K} % 2 AS qtd_articuladores_renalfa_estadual,
        o_totalprice AS valor_pago_escolas_cantinho_leitura, o_totalprice AS valor_repasse_bolsistas_total,
        o_totalprice AS valor_empenhado_materiais, o_totalprice AS valor_empenhado_formacoes FROM {{po}}""",
    "cnca_meta": f"""SELECT {STATE_LEVEL} AS id, CAST(2023 + o_custkey % 3 AS INT) AS ano,
        CASE WHEN {K} % 5 = 0 THEN 'META' ELSE 'REALIZADO - ICA' END AS definicao_valor,
        CAST(CAST({K} % 997 AS DECIMAL(10,0)) / 1000 AS DOUBLE) AS valor FROM {{po}}""",
    "matricula_integral": f"""SELECT {STATE_LEVEL} AS id, CAST(2023 + o_custkey % 3 AS INT) AS ano,
        CASE WHEN {K} % 5 = 0 THEN 'Creche' ELSE 'Todas as etapas' END AS etapa, {K} % 499 AS quantidade_matricula_integral,
        {K} % 499 + o_custkey % 700 AS quantidade_matricula FROM {{po}}""",
    "distorcao": f"""SELECT {STATE_LEVEL} AS id, CAST(2023 + o_custkey % 3 AS INT) AS ano,
        CASE WHEN {K} % 5 = 0 THEN 'Creche' ELSE 'Ensino Médio' END AS etapa,
        CAST(CAST({K} % 599 AS DECIMAL(10,0)) / 10 AS DOUBLE) AS taxa_distorcao FROM {{po}}""",
}


def sources(t):
    items = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    frames = {
        "po": t.frame("placed_orders", lambda: placed_orders(t)),
        "pc": placed(t.customer, "c_nationkey", t),
        "ps": t.frame("placed_items", lambda: placed(items, "s_nationkey", t)),
        "pu": placed(t.supplier, "s_nationkey", t),
        "lineitem": t.lineitem,
        "supplier": t.supplier,
    }
    built = {
        name: t.spark.sql(text, **{k: v for k, v in frames.items() if f"{{{k}}}" in text})
        for name, text in SOURCES.items()
    }
    return {**built, "municipio": municipalities(t), "uf": states(t)}


ORDER_COLUMNS = [
    "o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority",
    "id_municipio", "nome", "id_uf", "sigla_uf", "nome_uf",
]
ITEM_COLUMNS = [
    "l_linenumber", "l_suppkey", "l_partkey", "l_returnflag", "l_extendedprice", "l_quantity", "s_name",
    "nome", "id_uf", "sigla_uf",
]


def numbers(t):
    """The briefing numbers; the two joined facts feed many blocks and are written once for them."""
    with Scratch(t.spark) as scratch:
        items = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        t.frame("placed_orders", lambda: scratch.written(placed_orders(t).select(*ORDER_COLUMNS)))
        t.frame("placed_items", lambda: scratch.written(placed(items, "s_nationkey", t).select(*ITEM_COLUMNS)))
        return written(briefing.briefing_numbers(sources(t), single_level_state=SINGLE))


SOURCE_SQL = [
    PLACED_ORDERS,
    "pc AS (SELECT * FROM customer JOIN mun ON c_nationkey = n_nationkey)",
    "pu AS (SELECT * FROM supplier JOIN mun ON s_nationkey = n_nationkey)",
    "ps AS (SELECT * FROM lineitem JOIN pu ON l_suppkey = s_suppkey)",
] + [
    f"{name} AS ({text.format(po='po', pc='pc', ps='ps', pu='pu', lineitem='lineitem', supplier='supplier')})"
    for name, text in SOURCES.items()
]

cents = sql.cents


def case_sum(condition: str, value: str) -> str:
    return f"SUM(CASE WHEN {condition} THEN CAST({value} AS DECIMAL(18,2)) ELSE 0 END)"


def category_sql(name: str, category: str) -> str:
    return f"""(SELECT sigla_uf, {case_sum(f"{category} = 'Consolidação'", "valor_previsto")} AS {name}_consolidacao,
      {case_sum(f"{category} = 'Expansão'", "valor_previsto")} AS {name}_expansao, {cents("valor_previsto")} AS {name}_total
      FROM {name} WHERE id = '99' GROUP BY 1)"""


def items_sql(name: str, category: str, default: str, equals: str) -> str:
    return f"""(SELECT sigla_uf, string_agg(CAST(n AS VARCHAR) || ' ' || tipologia || '{equals}' || CASE WHEN v < 1000000
        THEN {sql.dec_br(sql.times("v", 3), 2)} || ' mil' ELSE {sql.millions("v")} END, ' | ' ORDER BY tipologia) AS lista_obras_{name}_dinamica
      FROM (SELECT sigla_uf, coalesce(tipologia, '{default}') AS tipologia, COUNT(*) AS n, coalesce({cents("valor_previsto")}, NULL) AS v
            FROM {name} WHERE {category} = 'Consolidação' AND id = '99' GROUP BY 1, 2) GROUP BY 1)"""


def series_sql(table: str, where: str, columns: dict[str, str]) -> str:
    picks = ", ".join(
        f"MAX(CASE WHEN ano = {y} THEN {value} END) AS {name}_{y}" for name, value in columns.items() for y in (2023, 2025)
    )
    return f"""(SELECT CASE WHEN id = '99' THEN 'BR' ELSE (SELECT MAX(sigla_uf) FROM mun WHERE id_uf = x.id) END AS sigla_uf, {picks}
      FROM {table} x WHERE {where} AND length(id) = 2 GROUP BY id)"""


PCT = "CASE WHEN quantidade_matricula <> 0 THEN (CAST(quantidade_matricula_integral AS HUGEINT) * 20000 + quantidade_matricula) // (2 * quantidade_matricula) END"
SINGLE = "AS"
BLOCKS = {
    "b1": f"""(SELECT sigla_uf, COUNT(*) FILTER (WHERE escolas_conectadas_nivel <> 'Outra') AS conectadas, COUNT(*) AS escolas FROM conectividade GROUP BY 1)""",
    "b2": f"""(SELECT sigla_uf, SUM(m) AS eti_matriculas, SUM(v) AS eti_valor FROM (
        SELECT uf AS sigla_uf, peti_07_qtd_matricula_declarada_ciclo AS m, CAST(peti_09_valor_pago_ciclo AS DECIMAL(18,2)) AS v FROM peti
          WHERE uf <> 'BR' AND peti_04_ciclo <> '2022'
        UNION ALL SELECT uf, matriculas_fundeb, CAST(valor_total_fomento AS DECIMAL(18,2)) FROM transferencias WHERE nivel_territorial = 'municipio') GROUP BY 1)""",
    "b4a": f"""(SELECT u.sigla_uf, COUNT(DISTINCT id_pessoa) AS pdm_estudantes, {cents("valor_enviado")} AS pdm_valor
        FROM incentivo_historico JOIN (SELECT DISTINCT id_uf, sigla_uf FROM mun) u ON id = id_uf
        WHERE ultima_carga AND id_tipo_status_parcela IN ('105', '115') GROUP BY 1)""",
    "b4b": "(SELECT u.sigla_uf, COUNT(DISTINCT id_pessoa) AS pdm_matricula FROM matricula_unica m JOIN (SELECT DISTINCT id_uf, sigla_uf FROM mun) u ON m.id_uf = u.id_uf GROUP BY 1)",
    "b5a": f"""(SELECT sigla_uf, COUNT(*) AS pacto_obras, SUM(CAST(p AS DECIMAL(18,2))) AS pacto_previsto, SUM(CAST(r AS DECIMAL(18,2))) AS pacto_repasse FROM (
        SELECT id_obra, MAX(sigla_uf) AS sigla_uf, MAX(valor_previsto) AS p, MAX(valor_repasse) AS r FROM pacto
        WHERE indicador_aprovada AND length(id) = 2 AND id <> '99' GROUP BY 1) GROUP BY 1)""",
    "b5b": f"""(SELECT sigla_uf, {", ".join(f"COUNT(*) FILTER (WHERE modalidade = '{label}') AS {n}_qtd, {case_sum(f"modalidade = '{label}'", "valor_repasse")} AS {o}"
        for n, label, o in [("creches", "Creches", "creches_valor"), ("eti", "Escolas Tempo Integral", "eti_valor_previsto"), ("onibus", "Ônibus", "onibus_valor")])}
        FROM selecoes WHERE modalidade IS NOT NULL AND situacao = 'Em obra' AND id = '99' GROUP BY 1)""",
    "b6a": category_sql("sesu", "categoria"),
    "b6b": """(SELECT sigla_uf, COUNT(DISTINCT instituicao) AS sesu_campi, string_agg(DISTINCT municipio_obra, ', ' ORDER BY municipio_obra) AS sesu_locais
        FROM sesu WHERE id = '99' AND categoria = 'Expansão' GROUP BY 1)""",
    "b6c": items_sql("sesu", "categoria", "Outras Estruturas", " = R$ "),
    "b7a": category_sql("setec", "categoria_resumido"),
    "b7b": """(SELECT sigla_uf, COUNT(DISTINCT CASE WHEN lower(tipologia) = 'expansão' AND natureza_empreendimento = 'Obra' AND valor_previsto IS NOT NULL
        THEN regexp_replace(id_governa, '99$', '') END) AS setec_campi FROM setec WHERE id = '99' AND sigla_uf <> '-' GROUP BY 1)""",
    "b7c": items_sql("setec", "categoria_resumido", "Outros Equipamentos", " - R$ "),
    "b7d": """(SELECT sigla_uf, string_agg(DISTINCT municipio_obra, ' | ' ORDER BY municipio_obra) AS lista_expansao_setec_dinamica
        FROM setec WHERE id = '99' AND categoria_resumido = 'Expansão' GROUP BY 1)""",
    "b8": f"""(SELECT sigla_uf, SUM(v) AS hu_valor, string_agg(l, ' | ' ORDER BY l) AS lista_obras_hu_dinamica FROM (
        SELECT sigla_uf, v, nome_empreendimento || ' - R$ ' || {sql.millions("v")} AS l FROM (
          SELECT sigla_uf, nome_empreendimento, {cents("valor_novo_pac")} AS v FROM ebserh WHERE id = '99' GROUP BY 1, 2)) GROUP BY 1)""",
    "b9": f"""(SELECT * FROM (SELECT sigla_uf, {", ".join(f'{case_sum(f"ano = {y}", "valor")} AS fundeb_{y}' for y in (2023, 2024, 2025))},
        {", ".join(f'''{case_sum(f"ano = 2026 AND tipo_transferencia = 'Complementação {n.upper()}'", "valor")} AS fundeb_{n}''' for n in ("vaaf", "vaat", "vaar"))}
        FROM fundeb WHERE status = 'Realizado' GROUP BY 1)
        JOIN (SELECT uf AS sigla_uf, {cents("repasse")} AS fundeb_2026 FROM fundeb_painel WHERE ano = 2026 AND municipio = 'Todos' AND estado <> 'Todos' GROUP BY 1) USING (sigla_uf))""",
    "b10a": f"""(SELECT * FROM (SELECT left(r_name, 2) AS sigla_uf, SUM(qtd_escola) AS pnae_escolas FROM pnae JOIN region ON upper(estado) = r_name
        WHERE municipio = 'Todos' GROUP BY 1)
        LEFT JOIN (SELECT uf AS sigla_uf, {cents("pnae_03_val_repasse")} AS pnae_valor FROM pnae_repasse WHERE dt_ref NOT LIKE '2022%' GROUP BY 1) USING (sigla_uf))""",
    "b10b": f"""(SELECT left(r_name, 2) AS sigla_uf, SUM(qtd_aluno) AS pnate_alunos, {cents("val_repasse")} AS pnate_valor
        FROM pnate JOIN region ON upper(estado) = r_name WHERE CAST(id AS BIGINT) < 99 GROUP BY 1)""",
    "b11": """(SELECT sigla_uf, SUM(numero_matriculas) AS if_mat, COUNT(DISTINCT id_instituicao) AS if_numero, COUNT(DISTINCT id_unidade) AS if_campi
        FROM pnp_matricula JOIN pnp_instituicao USING (chave_unidade) JOIN pnp_organizacao USING (chave_unidade)
        WHERE ano = 2024 AND organizacao_administrativa = 'Institutos' GROUP BY 1)""",
    "b12a": "(SELECT sigla_uf, COUNT(DISTINCT sigla_ies || '|' || campus) AS uf_campi FROM campus WHERE sigla_uf IS NOT NULL GROUP BY 1)",
    "b12b": "(SELECT sigla_uf, COUNT(DISTINCT sigla_ies) AS uf_inst FROM campus WHERE sigla_uf IS NOT NULL AND status_funcionamento = 'Ativo' GROUP BY 1)",
    "b12c": """(SELECT sigla_uf, SUM(quantidade_matriculas) AS uf_mat FROM curso JOIN ies ON curso.id_ies = ies.id_ies AND ies.ano_censo = 2024
        WHERE curso.ano_censo = 2024 AND id_tipo_modalidade_ensino IN (1, 2) GROUP BY 1)""",
    "b13": f"""(SELECT sigla_uf, cnca_cantinho, cnca_escolas, cnca_cantinhos, CASE WHEN sigla_uf = '{SINGLE}' THEN art ELSE art + reg + est END AS cnca_art,
          cnca_repasse, cnca_materiais, cnca_formacao
        FROM (SELECT sigla_uf, SUM(qtd_cantinho_leitura_apoiado) AS cnca_cantinho, SUM(qtd_escolas_apoiadas_cantinho_leitura) AS cnca_escolas,
                {cents("valor_pago_escolas_cantinho_leitura")} AS cnca_cantinhos, SUM(qtd_articuladores_total) FILTER (WHERE ano = 2026) AS art
              FROM cnca WHERE id <> '99' AND (municipio <> 'Todos' OR sigla_uf = '{SINGLE}') GROUP BY 1)
        JOIN (SELECT sigla_uf, SUM(qtd_articuladores_renalfa_regional) FILTER (WHERE ano = 2026) AS reg, SUM(qtd_articuladores_renalfa_estadual) FILTER (WHERE ano = 2026) AS est,
                {cents("valor_repasse_bolsistas_total")} AS cnca_repasse, {cents("valor_empenhado_materiais")} AS cnca_materiais, {cents("valor_empenhado_formacoes")} AS cnca_formacao
              FROM cnca WHERE id <> '99' AND municipio = 'Todos' GROUP BY 1) USING (sigla_uf))""",
    "b14a": f"(SELECT * FROM {series_sql('matricula_integral', "etapa = 'Todas as etapas'", {'integral_pct': PCT, 'integral_qtd': 'quantidade_matricula_integral'})} WHERE sigla_uf <> 'BR')",
    "b14b": f"(SELECT * FROM {series_sql('distorcao', "etapa = 'Ensino Médio'", {'distorcao': 'CAST(taxa_distorcao AS DECIMAL(18,6))'})} WHERE sigla_uf <> 'BR')",
    "b14c": f"(SELECT * FROM {series_sql('cnca_meta', "definicao_valor = 'REALIZADO - ICA'", {'ica': 'CAST(valor AS DECIMAL(18,6)) * 100'})} WHERE sigla_uf <> 'BR')",
}
COUNTRY = f"""nb AS (SELECT * FROM
  (SELECT COUNT(DISTINCT id_pessoa) AS pdm_estudantes_br FROM incentivo_historico WHERE ultima_carga AND id_tipo_status_parcela IN ('105', '115')),
  (SELECT COUNT(DISTINCT id_pessoa) AS pdm_matricula_br FROM matricula_unica),
  (SELECT SUM(qtd_cantinho_leitura_apoiado) AS cnca_cantinho_br, SUM(qtd_escolas_apoiadas_cantinho_leitura) AS cnca_escolas_br,
     {cents("valor_pago_escolas_cantinho_leitura")} AS cnca_cantinhos_br, {cents("valor_repasse_bolsistas_total")} AS cnca_repasse_br,
     {cents("valor_empenhado_materiais")} AS cnca_materiais_br, {cents("valor_empenhado_formacoes")} AS cnca_formacao_br
   FROM cnca WHERE id = '99' AND municipio = 'Todos'),
  {", ".join("(SELECT " + ", ".join(f"{n}_{y} AS {n}_{y}_br" for n in cols for y in (2023, 2025)) + f" FROM {text} WHERE sigla_uf = 'BR')"
     for cols, text in [
       (["integral_pct", "integral_qtd"], series_sql("matricula_integral", "etapa = 'Todas as etapas'", {"integral_pct": PCT, "integral_qtd": "quantidade_matricula_integral"})),
       (["distorcao"], series_sql("distorcao", "etapa = 'Ensino Médio'", {"distorcao": "CAST(taxa_distorcao AS DECIMAL(18,6))"})),
       (["ica"], series_sql("cnca_meta", "definicao_valor = 'REALIZADO - ICA'", {"ica": "CAST(valor AS DECIMAL(18,6)) * 100"})),
     ])})"""  # fmt: skip
TOTALS = (
    "tb AS (SELECT "
    + ", ".join(
        f"(SELECT SUM({name}) FROM {block}) AS {name}_br"
        for name in briefing.SUMMED
        for block, text in BLOCKS.items()
        if (f"AS {name}" in text or f" {name} " in text) and not (name == "pdm_valor" and block != "b4a")
    )
    + ")"
)
NUMBERS = (
    [f"{name} AS {text}" for name, text in BLOCKS.items()]
    + [COUNTRY, TOTALS]
    + [
        "nums AS (SELECT *, r_name AS territorio FROM b1 "
        + " ".join(f"LEFT JOIN {name} USING (sigla_uf)" for name in BLOCKS if name != "b1")
        + " LEFT JOIN region ON sigla_uf = left(r_name, 2) CROSS JOIN nb CROSS JOIN tb)"
    ]
)

P = " || ' | Brasil: ' || "


def plain(n: str) -> str:
    return f"CAST({n} AS VARCHAR){P}CAST({n}_br AS VARCHAR)"


def ints(n: str) -> str:
    return f"{sql.int_br(n)}{P}{sql.int_br(n + '_br')}"


def mil_bil(n: str) -> str:
    return f"'R$ ' || {sql.millions(n)}{P}'R$ ' || {sql.billions(n + '_br')}"


def mil_mil(n: str) -> str:
    return f"'R$ ' || {sql.millions(n)}{P}'R$ ' || {sql.millions(n + '_br')}"


def bil_bil(n: str) -> str:
    return f"'R$ ' || {sql.billions(n)}{P}'R$ ' || {sql.billions(n + '_br')}"


def big(n: str) -> str:
    return f"'R$ ' || (CASE WHEN {n} >= 1000000000 THEN {sql.billions(n)} ELSE {sql.millions(n)} END){P}'R$ ' || {sql.billions(n + '_br')}"


def hundredths(n: str) -> str:
    return f"(CAST({n} // 100 AS VARCHAR) || ',' || lpad(CAST({n} % 100 AS VARCHAR), 2, '0'))"


def integral(s: str) -> str:
    return (
        f"{hundredths('integral_pct_2023' + s)} || '% em 2023 para ' || {hundredths('integral_pct_2025' + s)} || '% em 2025 (' || "
        f"{sql.int_br('integral_qtd_2023' + s)} || ' → ' || {sql.int_br('integral_qtd_2025' + s)} || ' matrículas)'"
    )


def distortion(s: str) -> str:
    return f"'caiu de ' || {sql.dec_br('distorcao_2023' + s, 1)} || '% em 2023 para ' || {sql.dec_br('distorcao_2025' + s, 1)} || '% em 2025'"


def ica(s: str) -> str:
    return f"'De ' || {sql.dec_br('ica_2023' + s, 2)} || '%* em 2023 para ' || replace(printf('%g', CAST(ica_2025{s} AS DOUBLE)), '.', ',') || '% em 2025'"


REPORT = {
    "uf": "sigla_uf",
    "territorio": "territorio",
    "titulo": "'BRIEFING – Visita Ministerial - ' || territorio",
    "escolas_conectadas_nivel_4_5": f"{sql.int_br('conectadas')} || ' (' || {sql.ratio('conectadas', 'escolas', 1)} || '% )'{P}{sql.int_br('conectadas_br')} || ' (' || {sql.ratio('conectadas_br', 'escolas_br', 1)} || '%)'",
    "eti_matriculas_fomentadas": ints("eti_matriculas"),
    "eti_valor_fomentado": f"'R$ ' || regexp_replace({sql.dec_br(sql.times('eti_valor', 6), 2)}, ',?0+$', '') || ' milhões | Brasil: R$ 7,16 bilhões'",
    "cnca_cantinho_leitura": ints("cnca_cantinho"),
    "cnca_escolas_apoiadas": ints("cnca_escolas"),
    "cnca_valor_cantinhos": mil_mil("cnca_cantinhos"),
    "cnca_qtd_articuladores_total": f"{sql.int_br('cnca_art')} || ' | Brasil: 7.386'",
    "cnca_articuladores_renalpha_2026": mil_mil("cnca_repasse"),
    "cnca_valor_materiais": mil_mil("cnca_materiais"),
    "cnca_valor_formacao": mil_mil("cnca_formacao"),
    "cnca_total_investido": f"'R$ ' || {sql.millions('(cnca_cantinhos + cnca_repasse + cnca_materiais + cnca_formacao)')} || ' | Brasil: R$ 1,56 bilhão'",
    "pdm_estudantes_beneficiados": f"{sql.int_br('pdm_estudantes')} || ' (' || {sql.ratio('pdm_estudantes', 'pdm_matricula', 2)} || '%)'{P}{sql.int_br('pdm_estudantes_br')} || ' (' || {sql.ratio('pdm_estudantes_br', 'pdm_matricula_br', 2)} || '%)'",
    "pdm_valor_investido": big("pdm_valor"),
    "pdm_abrangencia": "'2024-2026'",
    "pdm_referencia": "'Março/2026'",
    "obras_total_aprovadas": plain("pacto_obras"),
    "obras_valor_previsto": mil_bil("pacto_previsto"),
    "obras_valor_repassado": mil_bil("pacto_repasse"),
    "novo_pac_creches": plain("creches_qtd"),
    "novo_pac_creches_valor_previsto": mil_bil("creches_valor"),
    "novo_pac_eti": plain("eti_qtd"),
    "novo_pac_eti_valor_previsto": mil_bil("eti_valor_previsto"),
    "novo_pac_onibus": plain("onibus_qtd"),
    "novo_pac_onibus_valor_previsto": mil_bil("onibus_valor"),
    "novo_pac_superior_consolidacao": mil_bil("sesu_consolidacao"),
    "novo_pac_superior_expansao": f"'R$ ' || {sql.millions('sesu_expansao')} || CASE WHEN sesu_campi > 0 THEN ' - ' || sesu_campi || CASE WHEN sesu_campi = 1 THEN ' Campus (' ELSE ' Campi (' END || coalesce(sesu_locais, '') || ')' ELSE '' END{P}'R$ ' || {sql.millions('sesu_expansao_br')}",
    "novo_pac_superior_total_previsto": mil_bil("sesu_total"),
    "lista_obras_sesu_dinamica": "lista_obras_sesu_dinamica",
    "novo_pac_ept_consolidacao": mil_bil("setec_consolidacao"),
    "novo_pac_ept_expansao": f"'R$ ' || {sql.millions('setec_expansao')} || ' - ' || coalesce(setec_campi, 0) || CASE WHEN setec_campi > 1 THEN ' campi' ELSE ' campus' END{P}'R$ ' || {sql.billions('setec_expansao_br')}",
    "novo_pac_ept_total_previsto": mil_bil("setec_total"),
    "lista_obras_setec_dinamica": "lista_obras_setec_dinamica",
    "lista_expansao_setec_dinamica": "lista_expansao_setec_dinamica",
    "novo_pac_hu_valor_previsto": f"'R$ ' || ({sql.money('coalesce(hu_valor, 0)', sql.int_br('coalesce(hu_valor, 0)', ','))}){P}'R$ ' || {sql.billions('hu_valor_br')}",
    "lista_obras_hu_dinamica": "lista_obras_hu_dinamica",
    **{f"fundeb_{y}": bil_bil(f"fundeb_{y}") for y in (2023, 2024, 2025, 2026)},
    **{f"fundeb_valor_repassado_{n.upper()}": big(f"fundeb_{n}") for n in ("vaaf", "vaat", "vaar")},
    "pnae_escolas_apoiadas": ints("pnae_escolas"),
    "pnae_valor_investido": big("pnae_valor"),
    "pnae_abrangencia": "'2023-2026'",
    "pnae_referencia": "'Março/26'",
    "pnate_estudantes_beneficiados": ints("pnate_alunos"),
    "pnate_valor_investido": big("pnate_valor"),
    "pnate_abrangencia": "'2023-2026'",
    "pnate_referencia": "'Março/26'",
    "if_matriculas": f"{sql.dec_br(sql.times('if_mat', 3), 1)} || ' mil'{P}{sql.int_br('if_mat_br')}",
    "if_numero": plain("if_numero"),
    "if_campi": plain("if_campi"),
    "uf_campi": plain("uf_campi"),
    "uf_instituicoes": plain("uf_inst"),
    "uf_matriculas_graduacao": ints("uf_mat"),
    "eti_serie_historica_alunos": f"{integral('')}{P}{integral('_br')}",
    "distorcao_idade_serie": f"'Ensino Médio: ' || {distortion('')}{P}{distortion('_br')}",
    "ica_alfabetizacao": f"{ica('')}{P}{ica('_br')} || ' (*) Em 2023, o SAEB era usado como métrica.'",
}
WITH_NUMBERS = [*SOURCE_SQL, *NUMBERS]


@query(
    "wide_report",
    with_places("SELECT " + ",\n".join(f"{text} AS {name}" for name, text in REPORT.items()) + " FROM nums ORDER BY 1", *WITH_NUMBERS),
)
def wide_report(t):
    return briefing.briefing_report(numbers(t))


LONG_METRICS = ["conectadas", "pdm_estudantes", "cnca_cantinho", "pacto_previsto", "sesu_total", "uf_mat"]


@query(
    "briefing_long",
    with_places(
        " UNION ALL ".join(
            f"SELECT sigla_uf, '{m}' AS metrica, CAST({m} AS DOUBLE) AS valor, 'estado' AS nivel_territorial FROM nums "
            f"UNION ALL SELECT 'BR', '{m}', CAST(MAX({m}_br) AS DOUBLE), 'pais' FROM nums"
            for m in LONG_METRICS
        ),
        *WITH_NUMBERS,
    ),
)
def briefing_long(t):
    return briefing.briefing_long(numbers(t), LONG_METRICS)


@query(
    "works_annex",
    with_places(
        """SELECT sigla_uf, instituicao, nome_empreendimento, municipio_obra, valor_previsto FROM sesu
           WHERE id = '99' AND categoria = 'Consolidação' ORDER BY 1, 2, 4""",
        *SOURCE_SQL,
    ),
)
def works_annex(t):
    return briefing.works_annex(sources(t)["sesu"], "categoria")


@query(
    "technical_annex",
    with_places(
        """SELECT sigla_uf, instituicao, nome_empreendimento, municipio_obra, valor_previsto FROM setec
           WHERE id = '99' AND categoria_resumido = 'Consolidação' ORDER BY 1, 2, 4""",
        *SOURCE_SQL,
    ),
)
def technical_annex(t):
    return briefing.works_annex(sources(t)["setec"], "categoria_resumido")


# Additive measures of the visit table: metric to (condition, value) in SQL of both engines.
VISIT_ORDERS = {
    "conectadas": ("o_orderstatus <> 'P'", "1"),
    "escolas": ("o_orderkey > 0", "1"),
    "eti_matriculas": (f"{K} % 3 = 0", f"{K} % 100"),
    "eti_valor": (f"{K} % 3 = 0", "CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.3337 AS DECIMAL(5,4))"),
}
VISIT_ITEMS = {
    "cnca_cantinho": ("l_linenumber < 3", "1"),
    "cnca_cantinhos": ("l_linenumber < 3", "CAST(l_extendedprice AS DECIMAL(18,2))"),
}
OFFICIAL = {("99", "escolas"): 138000, ("11", "eti_valor"): 7160000.5}


def visit_sql() -> str:
    places = {"po": "id_municipio", "ps": "CASE WHEN l_linenumber <> 7 THEN id_municipio END"}
    stacked = " UNION ALL ".join(
        f"SELECT {places[table]} AS m, '{metric}' AS metrica, CAST({value} AS DECIMAL(28,10)) AS v FROM {table} WHERE {where}"
        for table, measures in (("po", VISIT_ORDERS), ("ps", VISIT_ITEMS))
        for metric, (where, value) in measures.items()
    )
    official = " ".join(f"WHEN id = '{i}' AND metrica = '{m}' THEN {v}" for (i, m), v in OFFICIAL.items())
    levels = [("m", "municipio", "m IS NOT NULL"), ("left(m, 2)", "estado", "m IS NOT NULL"), ("'99'", "pais", "true")]
    sums = " UNION ALL ".join(
        f"SELECT {ident} AS id, '{name}' AS nivel_territorial, metrica, CAST(ROUND(SUM(v), 2) AS DOUBLE) AS valor FROM st WHERE {where} GROUP BY ALL"
        for ident, name, where in levels
    )
    people = " UNION ALL ".join(
        f"SELECT {ident}, '{name}', 'pdm_estudantes', CAST(COUNT(DISTINCT c_custkey // 3) AS DOUBLE) FROM (SELECT *, id_municipio AS m FROM pc) WHERE {where} GROUP BY ALL"
        for ident, name, where in levels
    )
    published = """SELECT id, CASE WHEN id = '99' THEN 'pais' WHEN length(id) = 2 THEN 'estado' ELSE 'municipio' END, 'distorcao',
        CAST(MAX(s_acctbal) AS DOUBLE) FROM (SELECT *, CASE s_suppkey % 3 WHEN 0 THEN id_municipio WHEN 1 THEN id_uf ELSE '99' END AS id FROM pu) GROUP BY ALL"""
    return with_places(
        f"""SELECT id, nivel_territorial, metrica, CAST(CASE {official} ELSE valor END AS DOUBLE) AS valor,
                   CASE {official} END IS NOT NULL AS oficial FROM lv""",
        *SOURCE_SQL[:4],
        f"st AS ({stacked})",
        f"lv AS ({sums} UNION ALL {people} UNION ALL {published})",
    )


@query("briefing_visit", visit_sql())
def briefing_visit(t):
    """The visit table; every fact is read once, people are stored as bitmaps."""
    def measures(given):
        return {name: F.expr(f"CASE WHEN {where} THEN {value} END") for name, (where, value) in given.items()}

    items = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    some = F.when(F.col("l_linenumber") != 7, F.col("id_municipio"))
    facts = [
        (placed_orders(t), "id_municipio", measures(VISIT_ORDERS)),
        (placed(items, "s_nationkey", t).withColumn("_lugar", some), "_lugar", measures(VISIT_ITEMS)),
    ]
    enrolled = placed(t.customer, "c_nationkey", t).withColumn("id_pessoa", F.expr("c_custkey DIV 3"))
    people = written(person_bitmaps(enrolled, "id_pessoa", ["id_municipio"]))
    suppliers = placed(t.supplier, "s_nationkey", t)
    code = F.expr("CASE s_suppkey % 3 WHEN 0 THEN id_municipio WHEN 1 THEN id_uf ELSE '99' END")
    published = suppliers.groupBy(code.alias("id")).agg(F.max("s_acctbal").alias("valor"))
    return briefing.visit_long(facts, {"pdm_estudantes": people}, {"distorcao": published}, OFFICIAL)
