import pytest
from pyspark.sql import functions as F

from civicpanel.operators import aggregate, clean, joins, quality, report, reshape, windows
from civicpanel.operators import territory as terr
from tests.conftest import rows


def test_clean_table_counts_rejects(frame):
    df = frame([("1",), ("x",), (" ",), (None,)], "a string")
    good, rejects = clean.safe_cast(df, {"a": "int"})
    assert rows(good) == [(None,), (None,), (None,), (1,)]
    assert rows(rejects) == [("a", 4, 2, 1)]


def test_sensitive_columns(frame):
    df = frame([("1", "Ana", "x"), (None, None, None)], "cpf string, nome_pessoa string, curso string")
    assert clean.drop_sensitive(df).columns == ["curso"]
    masked = rows(clean.mask_sensitive(df), "cpf", "nome_pessoa")
    assert masked == [(None, None), ("***", "***")]


def test_name_corrections_by_code_and_by_table(frame):
    df = frame([("Cidade de X",), ("Comboriu",), ("Y",), (None,)], "n string")
    by_code = clean.fix_names(df, "n", {"Cidade de X": "X"}, {"Combori": "Camboriú"})
    assert rows(by_code) == [(None,), ("Camboriú",), ("X",), ("Y",)]
    rules = frame([("Cidade de X", "X"), ("Comboriu", "Camboriú")], "errado string, certo string")
    assert rows(clean.fix_names_from_table(df, "n", rules, "errado", "certo")) == rows(by_code)


def test_robust_indicator_uses_quantity_when_flag_is_empty(frame):
    df = frame([(None, 3), (None, 0), (False, 5)], "f boolean, q int")
    assert [r[0] for r in clean.robust_indicator(df, "f", "q").select("f").collect()] == [True, False, False]


def test_territory_levels(municipio):
    got = rows(terr.build_territory(municipio))
    assert len(got) == 4 + 2 + 1
    assert ("52", "Todos", "Goiás", "Todos") in got
    assert ("5208707", "Goiânia - GO", "Goiás", "Goiânia - GO") in got


def test_expand_levels_worked_example(frame, municipio):
    df = frame([("5208707", "Goiânia", "GO", "Goiás", 10)], "c string, n string, u string, e string, v int")
    got = rows(
        terr.expand_levels(df, "c", "n", "u", "e"),
        "id", "nivel_territorial", "estado", "municipio", "estado_nome", "municipio_nome", "titulo",
    )
    assert got == [
        ("52", "estado", "Goiás", "Todos", "Goiás", "Goiânia", "Goiás"),
        ("5208707", "municipio", "Goiás", "Goiânia - GO", "Goiás", "Goiânia", "Goiânia - GO"),
        ("99", "pais", "Todos", "Todos", "Goiás", "Goiânia", "Brasil"),
    ]


def test_expand_drops_state_rows_unless_asked(frame):
    df = frame([("52", "Goiás", "GO", "Goiás")], "c string, n string, u string, e string")
    assert terr.expand_levels(df, "c", "n", "u", "e").count() == 0
    assert terr.expand_levels(df, "c", "n", "u", "e", municipalities_only=False).count() == 3


def test_fallback_never_multiplies_homonyms(frame, municipio):
    df = frame(
        [(1, "bom jesus", "RS"), (2, "Bom Jesus", "XX"), (3, "GOIÂNIA", None), (4, "nada", "GO")],
        "k int, n string, u string",
    )
    got = rows(terr.resolve_with_fallback(df, municipio, "n", "u"), "k", "id", "metodo")
    assert got == [
        (1, "4302303", "nome e uf"), (2, None, None), (3, "5208707", "nome"), (4, None, None),
    ]
    assert rows(terr.ambiguous_names(municipio)) == [("BOM JESUS", 2)]


def test_mixed_codes_take_capital_coordinates(frame, municipio):
    df = frame([(1, "52"), (2, " 4314902 "), (3, "9"), (4, None)], "k int, cod string")
    got = rows(terr.resolve_mixed_codes(df, municipio, "cod"), "k", "id", "coordenada")
    assert got == [(1, "52", "-16.68,-49.25"), (2, "4314902", "-30.0,-51.2")]


def test_or_key_join_matches_each_pair_once(frame):
    left = frame([("11", "RO"), ("99", None), ("12", "12")], "id string, uf string")
    right = frame([("RO", 1), (" 11", 2), ("12", 3), (None, 4)], "code string, v int")
    got = rows(terr.or_key_join(left, right, ["id", "uf"], "code", ["id"]), "id", "v")
    assert got == [("11", 1), ("11", 2), ("12", 3), ("99", None)]


def test_territory_complete_equals_left_join(frame, municipio):
    territory = terr.build_territory(municipio)
    facts = frame([("5208707", 1), ("99", 2), ("99", 3), ("00", 4)], "id string, v int")
    got = rows(terr.territory_complete(territory, facts), "id", "municipio", "v")
    assert got == rows(territory.join(facts, "id", "left"), "id", "municipio", "v")


def test_level_selection(frame):
    df = frame([("Todos", "Todos"), ("Goiás", "Todos"), ("Goiás", "A - GO")], "estado string, municipio string")
    assert terr.select_level(df).count() == 1
    assert terr.select_level(df, "Goiás").count() == 1
    with pytest.raises(ValueError):
        terr.select_level(df, municipio="A - GO")


def test_rollup_adds_up_at_every_level(frame):
    df = frame([("GO", "A", 1), ("GO", "B", 2), ("RS", "A", 4)], "uf string, m string, v int")
    got = terr.rollup_levels(df, "uf", "m", {"v": F.col("v")})
    sums = {r[0]: r[1] for r in got.groupBy("nivel_agregacao").agg(F.sum("v")).collect()}
    assert sums == {"Municipio": 7, "Estado": 7, "Nacional": 7}


def test_full_join_forms_agree(frame):
    left = frame([("a", 1), ("b", 2), (None, 3)], "k string, l int")
    right = frame([("b", 5), ("c", 6), (None, 7)], "k string, r int")
    assert rows(joins.full_join(left, right, ["k"])) == rows(joins.full_join(left, right, ["k"], True))


def test_full_join_of_many_rows_packs_a_small_right_side(spark, frame, monkeypatch):
    left = frame([("a", 1, [1]), ("a", 1, [1]), ("a", None, None), ("b", 2, [2]), (None, 3, [3])], "k string, v int, w array<int>")
    right = spark.sql("SELECT * FROM VALUES ('a', 7, 'x'), ('a', 7, 'x'), ('a', NULL, NULL), ('c', 8, 'y'), (NULL, 9, 'z') AS _(k, `n.1`, t)")
    plain, packed = joins.full_join(left, right, ["k"]), joins.full_join(left, right, ["k"], many=True)
    assert packed.dtypes == plain.dtypes and packed.count() == 13
    assert rows(packed) == rows(plain)
    plan = packed._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate inline" in plan and "collect_list" in plan
    keys = right.select("k")
    assert rows(joins.full_join(left, keys, ["k"], many=True)) == rows(joins.full_join(left, keys, ["k"]))
    monkeypatch.setattr(joins, "is_small", lambda df: False)
    large = joins.full_join(left, right, ["k"], many=True)
    assert "Generate" not in large._jdf.queryExecution().optimizedPlan().toString()
    assert rows(large) == rows(plain)


def test_distinct_people_do_not_add_up(frame):
    df = frame([("p", "GO"), ("p", "RS"), ("q", "GO"), ("q", "GO"), ("r", None)], "p string, uf string")
    got = rows(aggregate.distinct_by_level(df, "p", "uf", "n"), "uf", "n", "nivel")
    assert got == [("BR", 3, "pais"), ("GO", 2, "estado"), ("RS", 1, "estado")]
    gap = quality.migrated_entities(df, "p", "uf").first()
    assert (gap.soma_estados, gap.pessoas, gap.em_varios_estados, gap.excedente) == (3, 2, 1, 1)


def test_deficit_labels_and_null_rows(frame):
    df = frame(
        [("a", 0, 1), ("b", 1, 1), ("c", 1, 0), ("d", None, 1)], "k string, falta int, tem int"
    )
    got = rows(aggregate.deficit_score(df, ["k"], ["falta"], ["tem"]))
    assert got == [
        ("a", 0, "Atende a todos os itens"), ("b", 1, "Atende a 4 itens"),
        ("c", 2, "Atende a 3 itens"), ("d", None, None),
    ]
    filled = rows(aggregate.deficit_score(df, ["k"], ["falta"], ["tem"], null_as=1))
    assert filled[3] == ("d", 1, "Atende a 4 itens")


def test_majority_of_nothing_is_the_default(frame):
    df = frame([("a", 0, 0), ("b", 6, 10), ("c", 5, 10)], "k string, x int, total int")
    got = rows(aggregate.majority_group(df, ["k"], {"X": ["x"]}, "total", "g", "nenhuma"), "k", "g")
    assert got == [("a", "nenhuma"), ("b", "X"), ("c", "nenhuma")]


def test_latest_flag_with_null_year(frame):
    df = frame([(2023,), (2024,), (None,)], "ano int")
    assert rows(aggregate.latest_flag(df, "ano")) == [(None, False), (2023, False), (2024, True)]


def test_latest_per_key_breaks_ties(frame):
    df = frame([(1, "2024", "b"), (1, "2024", "a"), (1, None, "c"), (2, None, "z")], "p int, m string, t string")
    assert rows(windows.latest_per_key(df, ["p"], ["m"], ["t"])) == [(1, "2024", "a"), (2, None, "z")]


def test_dense_id_matches_dense_rank(spark):
    df = spark.range(5000).select(
        (F.col("id") % 37).cast("string").alias("a"), F.when(F.col("id") % 5 != 0, F.col("id") % 83).alias("b")
    )
    got = windows.dense_id(df, ["a", "b"], "n").collect()
    ordered = sorted(got, key=lambda r: r.n)
    assert [r.n for r in ordered] == list(range(1, df.distinct().count() + 1))
    keys = [(r.a, r.b is not None, r.b or 0) for r in ordered]
    assert keys == sorted(keys)


def test_guarded_metric_keeps_its_sum(frame):
    df = frame([("x", 5, 1.0, None)], "k string, fixo int, a double, b double")
    long = reshape.unpivot_periods(df, [(1, "a", "a"), (2, "b", "b")], "ordem", "mes", "v")
    assert long.count() == 2
    assert reshape.guard_fixed_metrics(long, "ordem", ["fixo"]).agg(F.sum("fixo")).first()[0] == 5


def test_union_with_origin_drops_people(frame):
    a = frame([("1", "x")], "cpf string, c string")
    b = frame([("y",)], "c string")
    assert rows(reshape.union_with_origin({"a": a, "b": b})) == [("x", "a"), ("y", "b")]


def test_items_line(frame):
    df = frame([("GO", "Sala", 2, "1.5"), ("GO", "Bloco", 1, "0.25")], "uf string, t string, qtd int, v string")
    typed = df.withColumn("valor_milhoes", F.col("v").cast("decimal(18,6)"))
    line = report.fmt_items(typed, "uf", "t", "itens").first().itens
    assert line == "1 Bloco = R$ 250,00 mil | 2 Sala = R$ 1,50 milhões"


def test_parse_pairs(frame):
    df = frame([("1.234 (5,50%) | Brasil: R$ 2,50 bilhões",)], "t string")
    r = report.parse_pairs(df, {"t": "x"}).first()
    assert (r.x_uf, r.x_uf_pct, r.x_br, r.x_br_pct) == (1234.0, 5.5, 2.5e9, None)


def test_overrides_are_marked(frame):
    df = frame([("a", 1.0), ("b", 2.0)], "k string, v double")
    official = frame([("b", 9.0)], "k string, o double")
    assert rows(report.apply_overrides(df, official, ["k"], "v", "o")) == [("a", 1.0, False), ("b", 9.0, True)]


def test_reconcile_published_total(frame):
    metrics = frame([("partes", 1294.92)], "m string, v double")
    expected = frame([("partes", 1560.0), ("outra", 1.0)], "m string, p double")
    got = rows(quality.reconcile(metrics, expected, "m", "v", "p", 0.05), "m", "confere")
    assert got == [("outra", False), ("partes", False)]


def test_zero_diagnosis(frame, municipio):
    territory = terr.build_territory(municipio)
    panel = frame([("5208707", 0), ("5200050", 3)], "id string, v int")
    source = frame([("5208707",), ("5200050",), ("4302303",)], "id string")
    got = dict(rows(quality.diagnose_zeros(territory, panel, source, "id", "v"), "id", "diagnostico"))
    assert got == {
        "5208707": "zero real", "5200050": "com valor",
        "4302303": "perda no pipeline", "4314902": "sem fonte",
    }


def test_fanout_guard(frame):
    left = frame([("a",), ("a",), ("b",)], "k string")
    right = frame([("a",), ("a",), ("a",), ("b",)], "k string")
    assert rows(quality.fanout_guard(left, right, ["k"])) == [("a", 2, 3, 4)]


def test_dq_rules_count_unknown_as_broken(frame):
    df = frame([("x",), (" ",), (None,)], "n string")
    got = rows(
        quality.dq_rules(
            df, {"req": quality.string_nullable("n", True), "opt": quality.string_nullable("n", False)}
        )
    )
    assert got == [("opt", 1, 3), ("req", 2, 3)]


def test_money_is_rounded_once_after_the_sum(frame):
    from civicpanel.operators import aggregate as agg

    df = frame([("a", 0.004)] * 1000 + [("b", None)], "k string, v double")
    assert rows(agg.group_sum(df, ["k"], {"s": "v"})) == [("a", 4.0), ("b", None)]
    assert rows(agg.money_sum(df, ["k"], "v", "s")) == [("a", 4.0), ("b", 0.0)]
    index = frame([(1, 2.5)], "y int, f double")
    real = agg.deflate(frame([(1, 0.014)], "y int, v double"), index, "y", "f", {"v": "r"})
    assert float(real.first().r) == 0.04


@pytest.mark.parametrize("text", ["12d", "1.5f", "NaN", "Infinity", "x"])
def test_strict_cast_refuses_what_the_lenient_one_refuses(frame, text):
    from civicpanel.functions.conversion import strict

    df = frame([("1.5",), (text,)], "v string")
    with pytest.raises(Exception, match="column v is not double"):
        df.select(strict(F.col("v"), "double", "v")).collect()


def test_either_key_join_takes_a_null_id_as_a_value(frame):
    left = frame([(None, "x", "y"), (1, "q", None)], "id int, a string, b string")
    right = frame([("x", 10)], "r string, v int")
    joined = terr.or_key_join(left, right, ["a", "b"], "r", ["id"])
    assert rows(joined, "id", "v") == [(None, 10), (1, None)]
