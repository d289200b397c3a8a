"""Panels on small frames in the columns of their real sources."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from civicpanel.catalogue import QUERIES
from civicpanel.operators.territory import build_territory
from civicpanel.plans import adhesion, budget, programme, schools, teachers, transfers, works
from tests.conftest import rows


@pytest.fixture
def territory(municipio):
    return build_territory(municipio)


def test_transfers(frame, municipio):
    names = [
        "codigo_ibge", "uf", "ente", "rede", "registrou_politica_tempo_integral", "valor_total_fomento",
        "quantidade_matriculas", *[c for _, _, c in transfers.PERIODS],
    ]
    raw = frame(
        [
            (" 5208707", "GO ", "Goiânia", "Municipal", "Sim", "R$ 1.000,50", "1.200", "R$ 10,00", "20", None, "x"),
            ("52", "GO", "Goiás", "Estadual", "Não", "5", "7.0", "1", "1", "1", "1"),
            ("  ", "GO", "Sem código", "", "", "1", "1", "1", "1", "1", "1"),
            ("1234567", "XX", "Outro", "", "", "1", "1", "1", "1", "1", "1"),
        ],
        ", ".join(f"{n} string" for n in names),
    )
    panel = transfers.transfers_panel({"transferencias": raw, "municipio": municipio})
    assert panel.count() == 2 * 4 * 3
    country = panel.where("id = '99'")
    assert country.agg(F.sum("valor_total_fomento"), F.sum("matriculas_fundeb")).first()[:] == (1005.5, 1270)
    assert rows(country.select("uf", "id_uf", "nome_uf", "estado_nome").distinct()) == [
        ("BR", "99", "Brasil", "Goiás")
    ]
    city = panel.where("nivel_territorial = 'municipio' AND municipio = 'Goiânia'")
    assert rows(city, "ano_mes", "valor_repasse", "ano") == [
        (dt.date(2025, 10, 1), 10.0, 2025), (dt.date(2025, 11, 1), 20.0, 2025),
        (dt.date(2025, 12, 1), None, 2025), (dt.date(2026, 1, 1), None, 2026),
    ]
    assert panel.where("municipio_nome = 'Goiás'").select("coordenada").distinct().first()[0] == "-16.68,-49.25"


def test_offer(frame, territory):
    offers = frame(
        [("Goiânia", " GO ", "IF", "C1", 2, 40), ("Cidade de Nada", "GO", "IF", "C2", 1, 10)],
        "municipio string, sigla_uf string, instituicao string, campus string, turmas int, total_matriculas int",
    )
    places = frame(
        [(5208707, "-16,68", "-49,25", "B"), (5208707, "-1,0", "-2,0", "A"), (5208707, " ", "1", "0")],
        "id_ibge int, latitude string, longitude string, unidade string",
    )
    panel = programme.offer_panel({"oferta": offers, "filtro_territorio": territory, "instituicao": places})
    assert rows(panel, "id", "nome_territorio", "regiao", "coordenada", "total_matriculas") == [
        ("52", "Todos", "Centro-Oeste", "-1.0,-2.0", 40),
        ("5208707", "Goiânia - GO", "Centro-Oeste", "-1.0,-2.0", 40),
        ("99", "Todos", "Centro-Oeste", "-1.0,-2.0", 40),
    ]


def test_programme_costs(spark):
    table = programme.programme_costs(spark)
    assert table.count() == 7
    assert table.agg(F.sum("investimento_anual")).first()[0] == 115803116.0


def survey_rows(frame):
    names = [
        "id", "id_pessoa", "cpf", "data_hora_inicio", "municipio_residencia", "estado_residencia", "idade",
        "sexo", "cor_raca", "instituicao_curso", "turno_curso", "campus_a", "campus_b", "avaliacao_efetividade_aula",
    ]
    return frame(
        [
            ("1", "p", "0", "2024-05-01 10:00:00", " goiânia ", "goias", "17", "F", "x", "IF", "N", None, "B", "ok"),
            ("2", "q", "0", "2024-05-01 10:00:00", "Bom Jesus", "??", "200", "F", "x", None, "N", None, None, "ok"),
        ],
        ", ".join(f"{n} string" for n in names),
    )


def test_survey(frame, municipio, territory):
    sources = {"questionario": survey_rows(frame), "municipio": municipio, "filtro_territorio": territory}
    panel = programme.survey_panel(sources, ["campus_a", "campus_b"])
    assert rows(panel, "id_resposta", "id", "regiao", "idade", "campus") == [
        ("1", "52", "Centro-Oeste", 17, "B"), ("1", "5208707", "Centro-Oeste", 17, "B"),
        ("1", "99", "Centro-Oeste", 17, "B"), ("2", "99", "Indefinido", None, None),
    ]
    assert panel.where("id_resposta = '1'").first().no_municipio_display == "Goiânia"


def test_works_ids_follow_unit_and_name(frame, territory):
    names = [*works.TEXT_COLUMNS, *works.DATE_FORMATS, *works.VALUE_COLUMNS]
    raw = frame(
        [
            ("1", "GO", "5208707", "Goiânia", "S", "U1", "Bloco", "ok", "f", "01/02/2024", "2024-12-31", "x", "2024-01-01", *["1.5"] * 5),
            ("2", "GO", "5208707", "Goiânia", "S", "U2", "Bloco", "ok", "f", "2024-02-01", None, None, None, *["1,5"] * 5),
            ("3", "GO", None, "Goiânia", "S", "U3", "Bloco", "ok", "f", None, None, None, None, *[None] * 5),
        ],
        ", ".join(f"{n} string" for n in names),
    )
    panel = works.works_panel({"obras": raw, "filtro_territorio": territory})
    kept = panel.where("id_obra IS NOT NULL")
    assert rows(kept.where("id = '99'"), "id_obra", "id_variacao_obra", "inicio", "municipio_obra") == [
        ("1", 1, dt.date(2024, 2, 1), "Goiânia - GO"), ("2", 2, None, "Goiânia - GO"),
    ]
    assert (kept.count(), panel.count()) == (6, 6 + 7 - 3)


def test_campus_works_are_strict(frame, territory):
    raw = frame([("5208707", "GO", "Goiânia", "1.5", "x")], "codigo_ibge string, uf string, municipio string, a string, b string")
    panel = works.campus_works_panel({"obras": raw, "filtro_territorio": territory}, ["a"])
    assert panel.where("id = '52'").first().a == 1.5
    with pytest.raises(Exception, match="column b is not double"):
        works.campus_works_panel({"obras": raw, "filtro_territorio": territory}, ["b"]).collect()
    assert (len(works.CAMPUS_A_MEASURES), len(works.CAMPUS_B_MEASURES)) == (17, 5)


def census_frame(frame):
    numbers = list(schools.SUMS)
    facilities = sorted({c for columns in schools.FACILITIES.values() for c in columns})
    schema = (
        "ano int, id_municipio string, id_escola int, rede string, tipo_localizacao string, "
        "tipo_localizacao_diferenciada string, escolarizacao int, agua_inexistente int, esgoto_inexistente int, "
        "energia_inexistente int, internet int, local_funcionamento_predio_escolar int, "
        + ", ".join(f"{n} bigint" for n in numbers)
        + ", "
        + ", ".join(f"{n} int" for n in facilities)
    )

    def row(year, place, school, special, water, black, total):
        values = {"quantidade_matricula_educacao_basica": total, "quantidade_matricula_preta": black}
        return (
            year, place, school, "3", "2", special, 1, water, 0, 0, 1, 1,
            *[values.get(n, 0) for n in numbers], *[1 if n == "patio_descoberto" else 0 for n in facilities],
        )

    return frame(
        [row(2024, "5208707", 1, "3", 1, 70, 100), row(2024, "5208707", 2, "0", 0, 0, 40), row(2023, "5208707", 1, "3", None, 0, 0)],
        schema,
    )


def test_census_keeps_places_without_schools(frame, municipio, territory):
    names = frame([("0001", "ESCOLA-MODELO")], "id_escola string, nome string")
    sources = {"censo": census_frame(frame), "escola": names, "municipio": municipio, "filtro_territorio": territory}
    panel = schools.census_panel(sources)
    school = panel.where("id_escola = 1 AND id = '99'").first()
    assert school.nome_escola == "Escola-Modelo"
    assert school.indice_infraestrutura_elementar == "Atende a 4 itens"
    assert school.maioria_racial_60_pct == "Maioria de alunos pretos ou pardos (≥60%)"
    assert (school.porte_escola, school.dica_mapa, school.ano_tratado) == (
        "De 51 a 150 matrículas", "Goiás", dt.date(2024, 1, 1),
    )
    assert panel.where("id = '43'").count() == 2  # both municipalities of the state, without schools
    assert panel.select("id").distinct().count() == 7


def test_scholarship_people_are_joined_before_payments_are_repeated(spark, frame, tmp_path):
    tables = {
        "orders": frame([(1, d) for d in ("1995-01-01", "1996-01-01")] + [(51, "1997-01-01"), (3, None), (None, "1998-01-01")], "o_custkey bigint, o_orderdate string"),
        "supplier": frame([(1, "a"), (41, "b"), (51, "c"), (91, "d"), (None, "e")], "s_suppkey bigint, s_name string"),
        "customer": frame([(51, "x", "w", 9000.0), (51, "y", "v", 9000.0), (1, "z", "u", 10.0)], "c_custkey bigint, c_name string, c_mktsegment string, c_acctbal double"),
    }
    for name, table in tables.items():
        table.write.parquet(f"{tmp_path}/{name}.parquet")
    panel = QUERIES["panel_scholarship"](spark, str(tmp_path))
    assert rows(panel, "id_pessoa", "id_entidade_emec", "ano_pagamento", "nm_uf", "curso", "ies") == rows(frame(
        [(1, "1", 1995, None, None, None), (1, "1", 1996, None, None, None), (3, "3", None, None, None, None), (None, None, 1998, None, None, None)]
        + [(51, "11", 1997, uf, curso, ies) for uf in "ac" for curso, ies in ("wx", "vy")]
        + [(None, "51", None, "b", None, None), (None, "51", None, "d", None, None), (None, None, None, "e", None, None)],
        "p bigint, e string, a int, uf string, c string, i string",
    ))
    plan = panel._jdf.queryExecution().optimizedPlan().toString()
    assert -1 < plan.index("Union") < plan.index("(id_pessoa#")


def test_scholarship_payments_meet_one_list_for_each_institution(spark, frame):
    payments = frame([(1, 10, 2024), (1, 11, 2025), (3, 12, 2025)], "id_entidade_emec int, id_pessoa bigint, ano_pagamento int")
    by_state = spark.sql("SELECT * FROM VALUES ('1', 'GO', 3), ('1', 'SP', 3), ('2', 'RS', 4) AS _(cd_entidade_emec, nm_uf, me_referencia)")
    panel = teachers.scholarship_panel(payments, by_state)
    assert rows(panel, "id_entidade_emec", "id_pessoa", "nm_uf", "mes_referencia_geo") == rows(frame(
        [("1", 10, "GO", 3), ("1", 10, "SP", 3), ("1", 11, "GO", 3), ("1", 11, "SP", 3), ("3", 12, None, None), ("2", None, "RS", 4)],
        "e string, p bigint, uf string, m int",
    ))
    assert "Generate inline" in panel._jdf.queryExecution().optimizedPlan().toString()


def test_infrastructure_full_join(frame, municipio):
    names = frame([], "id_escola string, nome string")
    sources = {"censo": census_frame(frame), "escola": names, "municipio": municipio}
    panel = schools.infrastructure_panel(sources)
    assert panel.count() == 3 + 3
    first = panel.where("id_escola = 1 AND ano = 2024").first()
    assert (first.possui_patio, first.possui_agua, first.ultimo_ano, first.nome_escola) == (1, 0, True, "Sem informação")


def test_possession_over_callers_keys(frame):
    got = schools.possession_panel({"censo": census_frame(frame)}, ["ano"])
    assert rows(got, "ano", "pct_patio", "pct_cozinha") == [(2023, 100.0, 0.0), (2024, 100.0, 0.0)]


def test_adhesion(frame, municipio, territory):
    answers = frame([("5208707", True), ("GO", True), ("4314902", False), ("RS", None)], "codigo_acesso string, submissao boolean")
    vacancies = frame([("5208707", "Ainda não tenho estimativa", True)], "codigo_acesso string, estimativa_vaga string, submissao boolean")
    sources = {"resposta": answers, "estimativa": vacancies, "municipio": municipio, "filtro_territorio": territory}
    panel = adhesion.adhesion_panel(sources)
    assert rows(panel.where("id = '52'"), "cod_ibge", "estimativa_vaga", "id_estimativa", "indicador_uf") == [
        ("52", "Sem resposta", "AO99", True), ("5200050", None, None, False),
        ("5208707", "Ainda sem estimativa", "AO06", False),
    ]
    assert panel.where("id = '99'").count() == 6


def test_adhesion_full_and_inherited(frame, municipio, territory):
    codes = frame([("5208707 ", dt.date(2025, 1, 1)), ("RS", dt.date(2025, 2, 1))], "codigo_acesso string, data_envio date")
    approved = frame([("5208707 ",)], "id string")
    panel = adhesion.adhesion_full_panel({"filtro_territorio": territory, "adesao": codes, "municipios_aprovados": approved})
    assert panel.count() == 7
    assert rows(panel.where("data_adesao IS NOT NULL"), "id", "participa_municipio", "participa_estado") == [
        ("43", 0, 1), ("5208707", 1, 0),
    ]
    inherited = adhesion.inherited_adhesion({"municipio": municipio, "adesao": codes})
    assert rows(inherited, "id_municipio", "participa_municipio", "uf_participa") == [
        ("4302303", 0, True), ("4314902", 0, True), ("5200050", 0, True), ("5208707", 1, True),
    ]


def test_transition(frame, municipio):
    paid = frame(
        [("a", "5208707", "1", "202401", "105"), ("a", "4314902", "1", "202405", "115"), ("b", "5208707", "1", "202402", "105"),
         ("c", "5208707", "1", "202302", "105"), ("d", "5208707", "1", "202402", "999")],
        "id_pessoa string, id_municipio string, id_rede string, id_mes_competencia string, id_tipo_status_parcela string",
    )
    degree = frame(
        [("a", "Letras", "X", "GO", dt.date(2025, 1, 1), True), ("c", "Física", "Anápolis-GO", "GO", dt.date(2025, 1, 1), True),
         ("e", "Física", "Rio-RJ", "RJ", dt.date(2025, 1, 1), False)],
        "id_pessoa string, curso string, municipio string, sigla_uf string, data_referencia date, beneficiario boolean",
    )
    states = frame([("GO", "Goiás"), ("RS", "Rio Grande do Sul")], "sigla string, nome string")
    sources = {"incentivo": paid, "cadastro": degree, "municipio": municipio, "uf": states}
    people = teachers.transition_people(sources)
    assert rows(people, "id_pessoa", *teachers.CATEGORIES, "municipio", "estado") == [
        ("a", 1, 0, 0, "Porto Alegre", "Rio Grande do Sul"), ("b", 0, 1, 0, "Goiânia", "Goiás"),
        ("c", 0, 0, 1, "Anápolis", "Goiás"),
    ]
    rolled = teachers.transition_rollup(sources)
    nation = rolled.where("nivel_agregacao = 'Nacional'")
    assert rows(nation, "curso_licenciatura", *teachers.CATEGORIES, "estado_nome") == [
        ("Física", 0, 0, 2, "Brasil"), ("Letras", 1, 0, 0, "Brasil"), ("Sem curso", 0, 1, 0, "Brasil"),
    ]
    faithful = teachers.transition_rollup(sources, only_with_course=True)
    assert faithful.agg(F.sum("apenas_ensino_medio")).first()[0] == 0


def test_budget_counts_owner_spending_once(frame):
    own = frame(
        [("2021", "26256", "PESSOAL E ENCARGOS SOCIAIS", "R", "00", "F", 10.0, 10.0, 10.0, None)],
        "ano string, id_unidade_orcamentaria string, grupo_despesa string, resultado_lei string, id_fonte string, "
        "fonte string, ploa double, loa double, dotacao_atualizada double, despesa_empenhada double",
    ).withColumn("ano", F.col("ano").cast("int"))
    received = frame(
        [(2021, "26256", "26256", "INVESTIMENTOS", "R", "00", "F", 5.0, 5.0), (2021, "26256", "02101", "INVESTIMENTOS", "R", "00", "F", 7.0, 3.0)],
        "ano int, id_orgao_uge string, id_unidade_orcamentaria string, grupo_despesa string, resultado_lei string, "
        "id_fonte string, fonte string, destaque_recebido double, despesa_empenhada double",
    )
    groups = frame([(26256, "CEFET", "Institutos")], "id_unidade_orcamentaria int, unidade_orcamentaria string, grupo_unidade_orcamentaria string")
    index = frame([(2021, "1.16023397")], "ano int, fator string")
    panel = budget.budget_panel({"proprio": own, "recebido": received, "grupo": groups, "indice": index})
    assert rows(panel, "origem", "macro_grupo_despesa", "total_ploa", "total_destaque", "total_empenhado", "total_ploa_ipca") == [
        (budget.OWN, "Pessoal", 10.0, 0.0, 0.0, 11.6), (budget.RECEIVED, "Investimento", 0.0, 12.0, 3.0, 0.0),
    ]


def test_briefing_knows_all_states(municipio):
    from civicpanel.plans import briefing

    names = briefing.state_names({"municipio": municipio})
    assert names.count() == 27
    assert names.where("sigla_uf = 'SP'").first().nome == "SÃO PAULO"


def test_treasury_extracts_are_typed(spark, tmp_path):
    fields = budget.RECEIVED_SCHEMA.fieldNames()
    values = ["2021", *["02101", "SENADO"] * len(budget.ATTRIBUTES), "200000.0", "", "2026-02-26"]
    path = tmp_path / "destaque.txt"
    path.write_text(";".join(fields) + "\n" + ";".join(values) + "\n2021;curta\n", encoding="latin-1")
    table, malformed = budget.read_treasury_txt(spark, str(path), budget.RECEIVED_SCHEMA)
    row = table.first()
    assert (row.ano, row.id_unidade_orcamentaria, row.destaque_recebido) == (2021, "02101", 200000.0)
    assert (row.despesa_empenhada, row.data_ultima_atualizacao) == (None, dt.date(2026, 2, 26))
    assert malformed.count() == 1
    export = tmp_path / "grupo.json"
    export.write_text(
        '[{"id_unidade_orcamentaria": "26435", "unidade_orcamentaria": "IF", '
        '"grupo_unidade_orcamentaria": "Institutos", "data_ultima_atualizacao": null}]'
    )
    group = budget.read_treasury_json(spark, str(export), budget.GROUP_SCHEMA).first()
    assert (group.id_unidade_orcamentaria, group.data_ultima_atualizacao) == (26435, None)
