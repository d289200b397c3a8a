"""Collated names, keyed hashes, bitmaps of people, counts of the writing pass, key dictionaries."""

import hashlib
import hmac
import unicodedata

import pytest
from pyspark.sql import functions as F

from civicpanel.functions import text
from civicpanel.operators import aggregate, clean, quality, windows
from tests.conftest import rows


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def groups(df):
    return sorted(sorted(r.ids) for r in df.collect())


def test_names_of_any_letter(frame):
    names = ["Šabac", " SABAC", unicodedata.normalize("NFD", "šabac"), "Łódź", "Lodz", "Ấn Độ", unicodedata.normalize("NFD", "ấn độ"), "An Do"]
    df = frame(list(enumerate(names)), "i int, n string")
    grouped = lambda **how: groups(df.groupBy(text.name_key(F.col("n"), **how).alias("k")).agg(F.collect_list("i").alias("ids")))
    assert grouped(accent=False) == [[0, 1, 2], [3, 4], [5, 6, 7]]
    assert grouped() == [[0, 2], [1], [3], [4], [5, 6], [7]]
    assert grouped(case=False) == [[0], [1], [2], [3], [4], [5], [6], [7]]
    both = clean.name_key(df, "n", "k", accent=False)
    other = clean.name_key(df.select(F.col("i").alias("j"), F.col("n").alias("m")), "m", "k", accent=False)
    assert both.join(other, "k").count() == 9 + 4 + 9
    assert plan(clean.name_key(df, "n", "k", accent=False)).lower().count("replace(") == 1
    back = df.select(text.plain_text(text.name_key(F.col("n"))).alias("k"))
    assert back.dtypes == [("k", "string")]


def test_every_composed_letter_equals_its_parts(frame):
    letters = text._letters()[0]
    assert len(letters) > 800 and {"Š", "ắ", "ё", "ΐ"} <= set(letters)
    df = frame([(c, unicodedata.normalize("NFD", c)) for c in letters], "a string, b string")
    for accent in (True, False):
        different = df.where(text.name_key(F.col("a"), accent) != text.name_key(F.col("b"), accent))
        assert [r.a for r in different.collect()] == []


def test_keyed_hash(frame):
    """The vectors of RFC 4231, and long keys."""
    for key, data in [(b"\x0b" * 20, "Hi There"), (b"Jefe", "what do ya want for nothing?"), (b"\xaa" * 131, "Test Using Larger Than Block-Size Key - Hash Key First")]:
        got = frame([(data,), (None,)], "v string").select(text.hmac_sha256(F.col("v"), key).alias("h")).collect()
        assert [r.h for r in got] == [hmac.new(key, data.encode(), hashlib.sha256).hexdigest(), None]
    df = frame([("12345678901", "x"), (None, "y")], "cpf string, curso string")
    with pytest.raises(ValueError, match="key"):
        clean.mask_sensitive(df, keep_joinable=["cpf"])
    with pytest.raises(ValueError, match="key"):
        text.hmac_sha256(F.col("cpf"), b"")
    masked = rows(clean.mask_sensitive(df, keep_joinable=["cpf"], key=b"k"), "cpf")
    assert masked == [(None,), (hmac.new(b"k", b"12345678901", hashlib.sha256).hexdigest(),)]


def test_stored_bitmaps_answer_all_levels(frame, spark, tmp_path):
    facts = [(p, f"m{p % 7 + shift}", "AB"[p % 2]) for p in [*range(0, 70_000, 11), 33, 33, 2_000_000_000] for shift in (0, 1)]
    facts += [(5, None, "A"), (6, None, None), (None, "m1", "A")]
    df = frame(facts, "p bigint, m string, uf string")
    path = str(tmp_path / "pessoas")
    aggregate.person_bitmaps(df, "p", ["m", "uf"]).write.parquet(path)
    stored = spark.read.parquet(path)
    people = lambda keep: len({p for p, m, u in facts if p is not None and keep(m, u)})
    want = {("BR", people(lambda m, u: True), "pais")}
    want |= {(u, people(lambda m, v, u=u: v == u), "estado") for u in "AB"}
    want |= {(x, people(lambda m, u, x=x: m == x), "municipio") for x in {m for _, m, _ in facts if m}}
    counts = aggregate.distinct_three_levels(stored, "m", "uf")
    assert set(rows(counts, "id", "pessoas", "nivel")) == want
    assert str(tmp_path) in plan(counts)  # the persons are not read again
    assert rows(aggregate.merged_count(stored, ["uf"], "n"), "uf", "n")[1:] == sorted((u, n) for u, n, level in want if level == "estado")


def test_rejects_and_losses_take_one_scan(frame, spark, tmp_path):
    source, target = str(tmp_path / "a"), str(tmp_path / "b")
    frame([("1", "x"), (" ", "2"), (None, "3.5"), ("z", None)], "a string, b string").write.parquet(source)
    df = spark.read.parquet(source)
    types = {"a": "int", "b": "double"}
    typed, seen = clean.clean_observed(df, clean.casts(types))
    assert plan(typed).count("Scan parquet") == 1
    typed.write.parquet(target)
    assert rows(clean.observed_rejects(spark, seen, list(types))) == rows(clean.safe_cast(df, types)[1])
    assert rows(spark.read.parquet(target)) == rows(clean.safe_cast(df, types)[0])
    steps = quality.ObservedSteps()
    last = steps.step(steps.step(df, "lido").where("a IS NOT NULL"), "com a")
    assert plan(last).count("Scan parquet") == 1
    last.write.mode("overwrite").parquet(target)
    assert rows(steps.losses(spark)) == rows(quality.row_loss_guard({"lido": df, "com a": df.where("a IS NOT NULL")}))


def test_ids_stay_from_load_to_load(frame, spark, tmp_path):
    path = str(tmp_path / "ids")
    key = ["unidade", "obra"]
    first = frame([("u2", "b"), ("u1", "a"), ("u1", "a"), (None, "c")], "unidade string, obra string")
    before = windows.stored_ids(first, path, key, "id")
    old = {(r.unidade, r.obra): r.id for r in before.collect()}
    assert sorted(old.values()) == [1, 2, 3]
    second = frame([("u0", "z"), ("u1", "a"), (None, "c"), ("u9", "y")], "unidade string, obra string")
    new = {(r.unidade, r.obra): r.id for r in windows.stored_ids(second, path, key, "id").collect()}
    assert all(new[k] == v for k, v in old.items()) and new[("u0", "z")] == 4 and new[("u9", "y")] == 5 and len(new) == 5
    assert windows.stored_ids(second, path, key, "id").count() == 5


def test_lists_are_not_collected_as_arrays(frame):
    df = frame([("a", "y"), ("a", "x"), ("a", "y"), ("a", None), ("b", None)], "k string, v string")
    listed = aggregate.list_agg(df, ["k"], "v", "l", " 'e' ")
    assert rows(listed) == [("a", "x 'e' y 'e' y"), ("b", None)]
    assert rows(aggregate.list_agg(df, ["k"], "v", "l", distinct=True)) == [("a", "x, y"), ("b", None)]
    assert "collect_list" not in plan(listed)


def test_money_is_rounded_once_after_the_sum(frame):
    from civicpanel.functions import formatting
    from civicpanel.operators import territory as terr
    from civicpanel.plans import briefing

    panel = frame([("Todos", "Todos", 0.004)] * 1000, "estado string, municipio string, v double")
    assert rows(terr.big_number(panel, "v")) == [(4.0, 1000)]
    cycles = frame([("GO", "Ciclo", 1, 0.004)] * 500, "uf string, peti_04_ciclo string, peti_07_qtd_matricula_declarada_ciclo int, peti_09_valor_pago_ciclo double")
    cycles = cycles.withColumn("peti_04_ciclo", F.lit(briefing.CYCLES[0]))
    more = frame([("GO", "repasse", "municipio", 1, 0.004)] * 500, "uf string, tipo_registro string, nivel_territorial string, matriculas_fundeb int, valor_total_fomento double")
    total = briefing.full_time({"peti": cycles, "transferencias": more})
    assert [(r.eti_matriculas, float(r.eti_valor)) for r in total.collect()] == [(1000, 4.0)]
    shown = frame([(1_234_567.00004,)], "v double").select(formatting.scaled(F.col("v"), 6).cast("string").alias("s"))
    assert float(shown.first().s) == 1.23456700004


def test_loads_are_merged_into_a_stored_table(frame, spark, tmp_path):
    from civicpanel.plans import budget

    target, schema = str(tmp_path / "orcamento"), "ano int, u string, v int, data_ultima_atualizacao string"

    def load(*given):
        budget.merge_loads(frame(list(given), schema).withColumn(budget.LOADED, F.to_date(budget.LOADED)), target, ["ano", "u"])
        found = spark.read.parquet(target)
        return sorted((r.ano, r.u, r.v, r.data_ultima_atualizacao.day) for r in found.collect())

    first = [(2024, "a", 1, "2025-01-01"), (2024, "a", 2, "2025-01-01"), (2024, "b", 3, "2025-01-01"), (2023, "a", 4, "2025-01-01")]
    stored = [(2023, "a", 4, 1), (2024, "a", 1, 1), (2024, "a", 2, 1), (2024, "b", 3, 1)]
    assert load(*first) == stored
    assert load(*first) == stored  # the same file again
    later = load((2024, "a", 9, "2025-01-05"), (2024, "a", 7, "2025-01-03"), (2025, "c", 5, "2025-01-05"))
    assert later == [(2023, "a", 4, 1), (2024, "a", 9, 5), (2024, "b", 3, 1), (2025, "c", 5, 5)]
    assert load((2024, "a", 1, "2025-01-02")) == later  # an old file


def test_budget_base_labels(frame):
    from civicpanel.plans import budget

    own = frame([(2024, "1", "PESSOAL E ENCARGOS SOCIAIS", " 2 ", "050", "x", "4002", "y", 1.0, 1.0, 1.0, 1.0, "2025-01-01")],
                "ano int, id_unidade_orcamentaria string, grupo_despesa string, id_resultado_lei string, id_fonte string, fonte string, id_acao string, "
                "acao string, ploa double, loa double, dotacao_atualizada double, despesa_empenhada double, data_ultima_atualizacao string")  # fmt: skip
    got = frame([(2024, "1", "1", "INVESTIMENTOS", "99", "100", "x", "20RK", "y", 5.0, 4.0, "2025-01-01")],
                "ano int, id_unidade_orcamentaria string, id_orgao_uge string, grupo_despesa string, id_resultado_lei string, id_fonte string, "
                "fonte string, id_acao string, acao string, destaque_recebido double, despesa_empenhada double, data_ultima_atualizacao string")  # fmt: skip
    base = budget.budget_base({"proprio": own, "recebido": got})
    columns = ["origem", "macro_grupo_despesa", "resultado_lei", "tipo_fonte", "destaque_recebido", "despesa_empenhada"]
    assert rows(base, *columns) == [
        ("crédito originário", "Pessoal", "Discricionária", "Próprios", None, 1.0),
        ("crédito recebido", "Investimento", "Outras", "Tesouro", 5.0, None),  # the owner's rows have it
    ]


def test_a_broadcast_is_proved_by_its_bound(frame, spark):
    """Keys that the bound does not have never reach a broadcast, however many there are."""
    from civicpanel.sizing import within

    bound = frame([(f"{i}",) for i in range(30)], "k string")
    grouped = spark.range(100_000).selectExpr("CAST(id AS string) AS k").groupBy("k").count()
    small = within(grouped, bound, "k")
    assert small.count() == 30
    joined = spark.range(50).selectExpr("CAST(id AS string) AS k").join(small, "k", "left")
    assert joined.where("count IS NOT NULL").count() == 30 and "BroadcastHashJoin" in plan(joined)


def test_no_query_keeps_facts_on_executors():
    from pathlib import Path

    import civicpanel

    for file in Path(civicpanel.__file__).parent.rglob("*.py"):
        text_of = file.read_text(encoding="utf-8")
        assert ".persist(" not in text_of and ".cache(" not in text_of and "localCheckpoint" not in text_of, file


def test_visit_table_at_three_levels(frame):
    from civicpanel.plans import briefing

    facts = frame([("5208707", True, 0.004), ("5208707", False, 1.0), ("5200050", True, None), ("4302303", True, 2.0), (None, True, 3.0)],
                  "m string, c boolean, v double")
    more = frame([("5208707", 1)] * 3, "m string, n int")
    measures = {"conectadas": F.when(F.col("c"), 1), "valor": F.col("v")}
    people = aggregate.person_bitmaps(frame([("5208707", 1), ("5200050", 1), ("5200050", 2)], "id_municipio string, p int"), "p", ["id_municipio"])
    published = frame([("5208707", 1.5), ("52", 2.5), ("99", 3.5), (None, 9.0)], "id string, valor double")
    table = briefing.visit_long([(facts, "m", measures), (more, "m", {"turmas": F.col("n")})], {"pessoas": people}, {"taxa": published}, {("99", "taxa"): 4})
    found = {(r.id, r.metrica): (r.valor, r.nivel_territorial, r.oficial) for r in table.collect()}
    assert found[("5208707", "conectadas")] == (1.0, "municipio", False) and found[("52", "conectadas")] == (2.0, "estado", False)
    assert found[("99", "conectadas")] == (4.0, "pais", False) and found[("99", "valor")] == (6.0, "pais", False)
    assert found[("52", "valor")] == (1.0, "estado", False) and ("5200050", "valor") not in found
    assert found[("99", "turmas")][0] == 3 and found[("52", "pessoas")][0] == 2 and found[("99", "pessoas")][0] == 2
    assert found[("52", "taxa")] == (2.5, "estado", False) and found[("99", "taxa")] == (4.0, "pais", True)


def test_visit_table_reads_each_fact_once(spark):
    from civicpanel.catalogue import QUERIES

    text_of = plan(QUERIES["briefing_visit"](spark, "/root/testdata/sf0.001"))
    assert text_of.count("orders.parquet") <= 1 and text_of.count("lineitem.parquet") <= 1


def test_big_numbers_equal_those_of_the_expanded_panel(frame):
    from civicpanel.operators import territory as terr

    facts = frame([("5208707", "Goiânia", "GO", "Goiás", 0.004)] * 1000 + [("4302303", "Bom Jesus", "RS", "Rio Grande do Sul", 2.0), (None, None, None, None, 9.0)],
                  "id string, nome string, uf string, estado_nome string, v double")
    chosen = {"pais": (terr.ALL, terr.ALL), "estado": ("Goiás", terr.ALL), "municipio": ("Goiás", "Goiânia - GO")}
    found = {r.nivel: (r.v, r.linhas) for r in terr.big_numbers(facts, "v", chosen, "id", "nome", "uf", "estado_nome").collect()}
    panel = terr.expand_levels(facts.where("id IS NOT NULL"), "id", "nome", "uf", "estado_nome")
    for name, (estado, municipio) in chosen.items():
        assert found[name] == tuple(terr.big_number(panel, "v", estado, municipio).first())
    with pytest.raises(ValueError, match="state"):
        terr.big_numbers(facts, "v", {"x": (terr.ALL, "Goiânia - GO")}, "id", "nome", "uf", "estado_nome")
