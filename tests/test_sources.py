import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

from civicpanel.sources import catalog, publish, tables, text
from civicpanel.sources.literals import literal_table
from tests.conftest import rows


def test_text_csv_keeps_leading_zeros(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('id,nome\n0012,"São, Paulo"\n,\n', encoding="utf-8")
    got = rows(text.read_text_csv(spark, str(path), ["id", "nome"]))
    assert got == [(None, None), ("0012", "São, Paulo")]


def test_delimited_txt_shows_malformed_lines(spark, tmp_path):
    path = tmp_path / "a.txt"
    path.write_bytes("id;valor\n01;10,5\n02\n03;ç;x\n".encode("latin-1"))
    good, bad = text.read_delimited_txt(spark, str(path), ["id", "valor"])
    assert rows(good) == [("01", "10,5")]
    assert bad.count() == 2


def test_json_records(spark, tmp_path):
    path = tmp_path / "a.json"
    path.write_text('[{"ano":"2024","id":"001","v":"1.5"},{"ano":"2023","id":"002","v":null}]')
    got = rows(text.read_json_records(spark, str(path), ["ano", "id", "v"]))
    assert got == [("2023", "002", None), ("2024", "001", "1.5")]


def test_enforce_schema(frame):
    schema = StructType(
        [StructField("d", DateType()), StructField("n", LongType(), False), StructField("s", StringType())]
    )
    df = frame([("x", "5", "2024-01-02")], "s string, n string, d string")
    assert publish.enforce_schema(df, schema).collect()[0].asDict() == {
        "d": dt.date(2024, 1, 2), "n": 5, "s": "x",
    }
    with pytest.raises(ValueError, match="missing"):
        publish.enforce_schema(df.drop("s"), schema)
    with pytest.raises(Exception, match="NULL in required column n"):
        publish.enforce_schema(df.withColumn("n", F.lit(None).cast("string")), schema).collect()
    with pytest.raises(Exception, match="column n is not bigint"):
        publish.enforce_schema(df.withColumn("n", F.lit("x")), schema).collect()


def test_publish_round_trip(spark, frame, tmp_path):
    df = frame([(i % 3, i) for i in range(50)], "g int, v int")
    target = f"{tmp_path}/out"
    publish.publish_clustered(df, target, ["g", "v"], partitions=4)
    back = spark.read.parquet(target)
    assert rows(back) == rows(df)
    publish.publish(df.limit(5), target)
    assert spark.read.parquet(target).count() == 5


def test_clustering_spreads_a_hot_value(spark):
    df = spark.range(20000).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(-1).alias("k"), "id")
    ranged = publish.clustered(df, ["k"], partitions=8)
    sizes = [r[0] for r in ranged.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert max(sizes) < 2 * 20000 / 8


def test_materialize(spark, frame, tmp_path):
    df = frame([(1,)], "a int")
    publish.materialize(df, "raw", "x")
    assert spark.table("raw_x").count() == 1
    publish.materialize(df, "projeto", "x", root=str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/projeto/x").count() == 1


def test_tables(spark, frame, tmp_path):
    df = frame([(2022, 1), (2023, 2)], "ano int, v int")
    df.write.parquet(f"{tmp_path}/t.parquet")
    read = tables.read_table(spark, f"{tmp_path}/t.parquet", ["ano"])
    assert read.columns == ["ano"]
    assert rows(tables.current_term(read, "ano")) == [(2023,)]
    assert rows(tables.partition_range(read, "ano", 2022, 2022)) == [(2022,)]


def test_literal_table(spark):
    assert rows(literal_table(spark, [("a", 1), ("b", None)], "k string, v int")) == [("a", 1), ("b", None)]


def test_catalog_descriptions(frame):
    description = (
        "Descrição breve. // Frequência de atualização: Mensal. // Partição: Estado. // "
        "Nível da observação: id_pessoa. // Fonte: Censo. // Gestora dos dados: Agência."
    )
    r = catalog.parse_catalog_descriptions(frame([(description,)], "d string"), "d").first()
    assert (r.resumo, r.frequencia_atualizacao, r.nivel_observacao) == ("Descrição breve", "Mensal", "id_pessoa")
    assert (r.campos_ausentes, r.descricao_completa) == ("tratamento_dados", False)


def array_file(path, records, between=",\n", indent=None):
    import json

    body = between.join(json.dumps(r, ensure_ascii=False, indent=indent) for r in records)
    path.write_text(f"[{body}]", encoding="utf-8")


@pytest.mark.parametrize(("between", "indent"), [(",", None), (",\n", None), (",  ", 2), (",\n", 4)])
def test_json_array_equals_the_whole_file_reader(spark, tmp_path, between, indent):
    odd = ["plain", None, "", 'say \\"no\\"', 'a},b', '"},{"', '\\', 'x\\\\"},', "},", "é},\n{}", "[1],{},", '{"id":"9"}', "},{},{},", "null } { "]
    records = [{"id": f"{i:03}", "v": odd[i % len(odd)], "n": str(i / 4)} for i in range(300)]
    path = tmp_path / "a.json"
    array_file(path, records, between, indent)
    good, bad = text.read_json_array(spark, str(path), ["id", "v", "n"])
    want = rows(text.read_json_records(spark, str(path), ["id", "v", "n"]))
    assert rows(good) == want and len(want) == 300 and bad.count() == 0


def test_json_array_is_read_by_several_tasks(spark, tmp_path):
    records = [{"id": str(i), "v": "a},b" * (i % 7)} for i in range(20_000)]
    path = tmp_path / "a.json"
    array_file(path, records)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        good, bad = text.read_json_array(spark, str(path), ["id", "v"])
        tasks = good.select(F.spark_partition_id().alias("p")).distinct().count()
        assert tasks >= 5 and sorted(map(tuple, good.collect())) == sorted((r["id"], r["v"]) for r in records) and bad.count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_json_array_with_missing_separators_and_no_records(spark, tmp_path):
    path = tmp_path / "a.json"
    path.write_text('[{"id":"1","v":"x"} {"id":"2","v":null}\n{"id":"3","v":"\\"} {\\""},{"id":"4",,"v":"y"},{"id":"5","v":"z"} , {"id":"6","v":"w"}]')
    good, bad = text.read_json_array(spark, str(path), ["id", "v"])
    assert rows(good) == [("1", "x"), ("2", None), ("3", '"} {"'), ("5", "z"), ("6", "w")]
    assert [r[0] for r in bad.collect()] == ['{"id":"4",,"v":"y"}']
    for empty in ("[]", "", " [ ] \n"):
        path.write_text(empty)
        assert text.read_json_array(spark, str(path), ["id"])[0].count() == 0


def numbers(df):
    return sorted(r.v for r in df.collect())


def test_a_folder_is_replaced_by_a_job_that_reads_it(spark, frame, tmp_path):
    target = f"{tmp_path}/tabela"
    publish.publish(frame([(i,) for i in range(10)], "v int"), target)
    publish.publish(spark.read.parquet(target).selectExpr("v + 1 AS v"), target)
    assert numbers(spark.read.parquet(target)) == list(range(1, 11))
    bad = spark.read.parquet(target).select(F.when(F.col("v") > 5, F.raise_error(F.lit("stop")).cast("int")).otherwise(1).alias("v"))
    with pytest.raises(Exception, match="stop"):
        publish.publish(bad, target)
    assert numbers(spark.read.parquet(target)) == list(range(1, 11))
    assert [p.name for p in tmp_path.iterdir()] == ["tabela"]


def test_a_table_is_replaced_by_a_job_that_reads_it(spark, frame):
    name = "publicada"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    publish.publish(frame([(i,) for i in range(10)], "v int"), name)
    reader = spark.table(name)
    for step in (1, 2, 3):
        publish.publish(spark.table(name).selectExpr("v + 1 AS v"), name)
        assert numbers(spark.table(name)) == list(range(step, step + 10))
        if step == 1:
            assert numbers(reader) == list(range(10))  # one that has begun reads on
    bad = spark.table(name).select(F.raise_error(F.lit("stop")).cast("int").alias("v"))
    with pytest.raises(Exception, match="stop"):
        publish.publish(bad, name)
    assert numbers(spark.table(name)) == list(range(3, 13))
    publish.publish(spark.table(name).selectExpr("v", "'x' AS w"), name)  # other columns
    assert spark.table(name).columns == ["v", "w"] and spark.table(name).count() == 10
    spark.sql(f"DROP TABLE {name}")


def test_only_given_partitions_are_replaced(spark, frame, tmp_path):
    target = f"{tmp_path}/anos"
    publish.replace_partitions(frame([(2023, 1), (2024, 2), (2025, 3)], "ano int, v int"), target, ["ano"])
    now = spark.read.parquet(target)
    publish.replace_partitions(now.where("ano = 2024").selectExpr("ano", "v * 10 AS v"), target, ["ano"])
    assert rows(spark.read.parquet(target), "ano", "v") == [(2023, 1), (2024, 20), (2025, 3)]


def test_years_of_a_dimension_prune_partitions(spark, frame, tmp_path):
    """Years that come from a filtered dimension reach the scan as a pruning subquery."""
    target = f"{tmp_path}/fatos"
    publish.publish_clustered(frame([(2020 + i % 6, i) for i in range(600)], "ano int, v int"), target, ["v"], partition_by=["ano"])
    years = frame([(2020 + i, "atual" if i > 3 else "antigo") for i in range(6)], "ano int, ciclo string")
    years.write.parquet(f"{tmp_path}/anos")
    facts, dimension = spark.read.parquet(target), spark.read.parquet(f"{tmp_path}/anos")
    pruned = tables.years_of(facts, "ano", dimension.where("ciclo = 'atual'"), "ano")
    assert "dynamicpruning" in pruned._jdf.queryExecution().executedPlan().toString().lower()
    assert pruned.count() == 200 and pruned.columns == facts.columns
