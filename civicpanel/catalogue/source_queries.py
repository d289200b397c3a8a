"""Queries for sources, typing and cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    DecimalType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from civicpanel.catalogue.places import municipalities, placed, with_places
from civicpanel.catalogue.registry import query
from civicpanel.functions import conversion, text
from civicpanel.operators import clean
from civicpanel.sources.catalog import parse_catalog_descriptions
from civicpanel.sources.literals import literal_table
from civicpanel.sources.publish import enforce_schema
from civicpanel.sources.tables import current_term, partition_range


@query(
    "scan_project",
    """SELECT l_orderkey, l_extendedprice FROM lineitem""",
)
def scan_project(t):
    return t.lineitem.select("l_orderkey", "l_extendedprice")


@query(
    "literal_lookup",
    """WITH lit(o_orderpriority, prazo_dias, valor_unitario) AS (VALUES
         ('1-URGENT', 1, 10.5), ('2-HIGH', 3, 7.25), ('3-MEDIUM', 7, 4.0), ('5-LOW', NULL, NULL))
       SELECT o_orderpriority, CAST(prazo_dias AS BIGINT) AS prazo_dias,
              CAST(valor_unitario AS DOUBLE) AS valor_unitario, COUNT(*) AS pedidos
       FROM orders LEFT JOIN lit USING (o_orderpriority) GROUP BY ALL""",
)
def literal_lookup(t):
    table = literal_table(
        t.spark,
        [("1-URGENT", 1, 10.5), ("2-HIGH", 3, 7.25), ("3-MEDIUM", 7, 4.0), ("5-LOW", None, None)],
        "o_orderpriority string, prazo_dias bigint, valor_unitario double",
    )
    counted = t.orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("pedidos"))
    return counted.join(table, "o_orderpriority", "left")


ORDER_SCHEMA = StructType(
    [
        StructField("pedido", StringType(), False),
        StructField("valor", DecimalType(18, 2), True),
        StructField("data", DateType(), True),
        StructField("cliente", LongType(), True),
    ]
)


@query(
    "enforce_schema",
    """SELECT CAST(o_orderkey AS VARCHAR) AS pedido,
              CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS valor,
              CAST(o_orderdate AS DATE) AS data, o_custkey AS cliente FROM orders""",
)
def enforce_schema_query(t):
    source = t.orders.select(
        F.col("o_custkey").cast("string").alias("cliente"),
        F.col("o_orderkey").alias("pedido"),
        F.col("o_totalprice").cast("string").alias("valor"),
        F.col("o_orderdate").alias("data"),
    )
    return enforce_schema(source, ORDER_SCHEMA).withColumn("valor", F.col("valor").cast("double"))


@query(
    "catalog_fields",
    """SELECT p_partkey,
              'Modelo ' || p_type AS resumo,
              CASE p_size % 3 WHEN 0 THEN 'Mensal' WHEN 1 THEN 'Anual' END AS frequencia_atualizacao,
              'Estado e Município' AS particao, 'id ' || p_partkey AS nivel_observacao,
              p_brand AS fonte,
              CASE WHEN p_size % 2 = 0 THEN 'Agência' END AS gestora_dados,
              'Equipe' AS tratamento_dados,
              concat_ws(',', CASE WHEN p_size % 3 = 2 THEN 'frequencia_atualizacao' END,
                             CASE WHEN p_size % 2 = 1 THEN 'gestora_dados' END) AS campos_ausentes,
              p_size % 3 <> 2 AND p_size % 2 = 0 AS descricao_completa
       FROM part""",
)
def catalog_fields(t):
    size = F.col("p_size")
    frequency = (
        F.when(size % 3 == 0, " // Frequência de atualização: Mensal.")
        .when(size % 3 == 1, " // Frequência de atualização: Anual.")
        .otherwise("")
    )
    owner = F.when(size % 2 == 0, " // Gestora dos dados: Agência.").otherwise(
        " // Gestora dos dados: ."
    )
    description = F.concat(
        F.lit("Modelo "),
        "p_type",
        F.lit("."),
        frequency,
        F.lit(" // Partição: Estado e Município. // Nível da observação: id "),
        F.col("p_partkey").cast("string"),
        F.lit(". // Fonte: "),
        "p_brand",
        F.lit("."),
        owner,
        F.lit(" // Tratamento dos dados: Equipe."),
    )
    described = t.part.select("p_partkey", description.alias("descricao"))
    return parse_catalog_descriptions(described, "descricao").drop("descricao")


@query(
    "partition_range",
    """SELECT l_returnflag, COUNT(*) AS linhas,
              CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS valor
       FROM lineitem
       WHERE l_shipdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-12-31'
       GROUP BY l_returnflag""",
)
def partition_range_query(t):
    low, high = (F.lit(day).cast("timestamp_ntz") for day in ("1997-01-01", "1997-12-31"))
    rows = partition_range(t.lineitem, "l_shipdate", low, high)
    return rows.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("linhas"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("valor"),
    )


@query(
    "current_term",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS ano, COUNT(*) AS pedidos
       FROM orders WHERE year(o_orderdate) > 1998 GROUP BY 1""",
)
def current_term_query(t):
    rows = current_term(t.orders, "o_orderdate", base_year=1998)
    return rows.groupBy(F.year("o_orderdate").alias("ano")).agg(F.count(F.lit(1)).alias("pedidos"))


@query(
    "strict_cast",
    """SELECT o_orderkey, CAST(left(o_orderpriority, 1) AS BIGINT) AS prioridade,
              CAST(o_orderdate AS DATE) AS data FROM orders""",
)
def strict_cast_query(t):
    source = t.orders.select(
        "o_orderkey",
        F.left("o_orderpriority", F.lit(1)).alias("prioridade"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("data"),
    )
    return clean.strict_cast(source, {"prioridade": "bigint", "data": "date"})


EVENT_FX_SQL = """fx AS (
  SELECT CASE WHEN k % 10 = 0 THEN 'n/d' WHEN k % 10 = 1 THEN '' WHEN k % 10 = 2 THEN NULL
              ELSE ' ' || CAST(k AS VARCHAR) END AS inteiro,
         CASE WHEN k % 7 = 0 THEN CAST(k AS VARCHAR) || 'd' ELSE CAST(k AS VARCHAR) || '.5' END AS numero,
         CASE WHEN k % 5 = 0 THEN '2024-13-01' ELSE '2024-01-0' || CAST(k % 9 + 1 AS VARCHAR) END AS dia
  FROM (SELECT CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events))"""


REJECTS_SQL = f"""WITH {EVENT_FX_SQL}
       SELECT 'inteiro' AS "column", COUNT(*) AS n_rows,
              COUNT(*) FILTER (WHERE trim(inteiro) <> '') AS n_filled,
              COUNT(*) FILTER (WHERE inteiro = 'n/d') AS n_rejected FROM fx
       UNION ALL SELECT 'numero', COUNT(*), COUNT(numero), COUNT(*) FILTER (WHERE numero LIKE '%d') FROM fx
       UNION ALL SELECT 'dia', COUNT(*), COUNT(dia), COUNT(*) FILTER (WHERE dia = '2024-13-01') FROM fx"""
EVENT_TYPES = {"inteiro": "bigint", "numero": "double", "dia": "date"}


def event_text(t):
    """Event values as text, some of which do not convert."""
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("bigint")
    number = k.cast("string")
    return t.events.select(
        F.when(k % 10 == 0, "n/d")
        .when(k % 10 == 1, "")
        .when(k % 10 == 2, F.lit(None))
        .otherwise(F.concat(F.lit(" "), number))
        .alias("inteiro"),
        F.when(k % 7 == 0, F.concat(number, F.lit("d")))
        .otherwise(F.concat(number, F.lit(".5")))
        .alias("numero"),
        F.when(k % 5 == 0, "2024-13-01")
        .otherwise(F.concat(F.lit("2024-01-0"), (k % 9 + 1).cast("string")))
        .alias("dia"),
    )


@query("safe_cast_rejects", REJECTS_SQL)
def safe_cast_rejects(t):
    return clean.safe_cast(event_text(t), EVENT_TYPES)[1]


@query("rejects_one_pass", REJECTS_SQL)
def rejects_one_pass(t):
    """The same counts, taken while the typed rows are written."""
    typed, seen = clean.clean_observed(event_text(t), clean.casts(EVENT_TYPES))
    typed.write.format("noop").mode("overwrite").save()
    return clean.observed_rejects(t.spark, seen, list(EVENT_TYPES))


@query(
    "parse_brl",
    """SELECT o_orderkey,
              CASE WHEN o_orderkey % 11 = 0 THEN NULL
                   ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) END AS valor
       FROM orders""",
)
def parse_brl_query(t):
    written = F.translate(F.format_number(F.col("o_totalprice").cast("decimal(18,2)"), 2), ",.", ".,")
    fx = F.when(F.col("o_orderkey") % 11 == 0, "R$ a definir").otherwise(
        F.concat(F.lit(" R$ "), written, F.lit(" "))
    )
    return clean.parse_brl(t.orders.select("o_orderkey", fx.alias("valor")), ["valor"])


@query(
    "bounded_int",
    """SELECT p_partkey, CASE WHEN p_size BETWEEN 10 AND 40 AND p_size <> 13
                              THEN CAST(p_size AS BIGINT) END AS idade FROM part""",
)
def bounded_int_query(t):
    age = F.when(F.col("p_size") == 13, "treze").otherwise(
        F.concat(F.lit(" "), F.col("p_size").cast("string"))
    )
    return clean.bounded_int(t.part.select("p_partkey", age.alias("idade")), "idade", 10, 40)


@query(
    "fix_names",
    """SELECT CASE WHEN n_name = 'NATION_3' THEN 'Nação Três' WHEN n_name LIKE 'NATION_1%'
                   THEN 'Nação Um' ELSE n_name END AS nome, COUNT(*) AS clientes
       FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""",
)
def fix_names_query(t):
    named = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    fixed = clean.fix_names(
        named, "n_name", {"NATION_3": "Nação Três"}, {"NATION_1": "Nação Um"}, out="nome"
    )
    return fixed.groupBy("nome").agg(F.count(F.lit(1)).alias("clientes"))


STATE_SPELLINGS = {"AF": "África", "AM": "América", "AS": "Ásia", "EU": "Europe", "MI": "Middle East"}


@query(
    "state_code",
    with_places(
        """SELECT CASE WHEN c_custkey % 9 = 0 THEN 'ZZ' WHEN c_custkey % 9 = 1 THEN NULL
                      ELSE sigla_uf END AS uf, COUNT(*) AS clientes
           FROM customer JOIN mun ON c_nationkey = n_nationkey GROUP BY 1"""
    ),
)
def state_code_query(t):
    kind = F.col("c_custkey") % 9
    written = (
        F.when(kind == 0, "zz")
        .when(kind == 1, "em branco")
        .when(kind == 2, F.col("sigla_uf"))
        .when(kind == 3, F.lower("sigla_uf"))
        .when((kind == 4) & (F.col("sigla_uf") == "AF"), " áfrica ")
        .when((kind == 5) & (F.col("sigla_uf") == "AS"), "Ásia")
        .otherwise(F.initcap("nome_uf"))
    )
    fx = placed(t.customer, "c_nationkey", t).withColumn("estado", written)
    coded = clean.state_name_to_code(fx, "estado", "uf", STATE_SPELLINGS)
    return coded.groupBy("uf").agg(F.count(F.lit(1)).alias("clientes"))


@query(
    "macro_region",
    with_places(
        """SELECT CASE WHEN sigla_uf IN ('AF', 'AS') THEN 'Leste' WHEN sigla_uf = 'EU' THEN 'Centro'
                      ELSE 'Indefinido' END AS regiao, COUNT(*) AS clientes
           FROM customer JOIN mun ON c_nationkey = n_nationkey GROUP BY 1"""
    ),
)
def macro_region(t):
    rows = clean.classify(
        placed(t.customer, "c_nationkey", t),
        "sigla_uf",
        {"Leste": ["AF", "AS"], "Centro": ["EU"]},
        "regiao",
        "Indefinido",
    )
    return rows.groupBy("regiao").agg(F.count(F.lit(1)).alias("clientes"))


@query(
    "name_key_join",
    """SELECT CAST(n_nationkey AS BIGINT) AS nacao, lang, COUNT(*) AS documentos
       FROM documents JOIN nation ON n_nationkey = doc_id % 40 GROUP BY 1, 2""",
)
def name_key_join(t):
    number = (F.col("doc_id") % 40).cast("string")
    # Composed letters of several scripts' accents, decomposed ones, and both.
    written = (
        F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit(" ňátİon_"), number))
        .when(F.col("doc_id") % 3 == 1, F.concat(F.lit("N\u0304a\u0306ti\u0323o\u0301n_"), number, F.lit(" ")))
        .otherwise(F.concat(F.lit("Nẵtĭớņ_"), number))
    )
    left = clean.name_key(t.documents.select("lang", written.alias("nome")), "nome", "chave", accent=False)
    right = clean.name_key(t.nation, "n_name", "chave", accent=False)
    joined = left.join(right, "chave")
    return joined.groupBy(F.col("n_nationkey").cast("bigint").alias("nacao"), "lang").agg(
        F.count(F.lit(1)).alias("documentos")
    )


@query(
    "split_safe",
    """SELECT s_suppkey, 'Supplier' AS prefixo, substr(s_name, 10) AS codigo,
              CAST(NULL AS VARCHAR) AS extra FROM supplier""",
)
def split_safe(t):
    df = t.supplier.select("s_suppkey", "s_name")
    df = clean.split_part_safe(df, "s_name", "#", 0, "prefixo", strict=True)
    df = clean.split_part_safe(df, "s_name", "#", 1, "codigo")
    return clean.split_part_safe(df, "s_name", "#", 2, "extra").drop("s_name")


@query(
    "coalesce_wide",
    """SELECT campus, COUNT(*) AS linhas FROM (
         SELECT CASE WHEN l_linenumber IN (2, 5) THEN NULL
                     ELSE 'c' || CAST(l_linenumber AS VARCHAR) END AS campus FROM lineitem)
       GROUP BY campus""",
)
def coalesce_wide_query(t):
    columns = [f"campus_{number}" for number in (1, 3, 4, 6, 7)]
    sparse = t.lineitem.select(
        *[
            F.when(F.col("l_linenumber") == number, f"c{number}").alias(f"campus_{number}")
            for number in (1, 3, 4, 6, 7)
        ]
    )
    merged = clean.coalesce_wide(sparse, columns, "campus")
    return merged.groupBy("campus").agg(F.count(F.lit(1)).alias("linhas"))


@query(
    "hash_key",
    """SELECT c_custkey, sha256(CASE WHEN c_custkey % 4 = 0 THEN '' ELSE c_mktsegment END || c_name) AS chave
       FROM customer""",
)
def hash_key_query(t):
    segment = F.when(F.col("c_custkey") % 4 != 0, F.col("c_mktsegment"))
    df = t.customer.select("c_custkey", segment.alias("segmento"), "c_name")
    return clean.hash_key(df, ["segmento", "c_name"], "chave").select("c_custkey", "chave")


# A key for the benchmark only; its two HMAC blocks in hex for the SQL.
MASK_KEY = b"civicpanel benchmark key"
PADS = [bytes(b ^ pad for b in MASK_KEY.ljust(64, b"\0")).hex() for pad in (0x36, 0x5C)]


@query(
    "drop_sensitive",
    f"""SELECT c_custkey, c_nationkey, c_mktsegment, '***' AS cor_raca,
               sha256(unhex('{PADS[1]}') || unhex(sha256(unhex('{PADS[0]}') || encode(c_name)))) AS cpf
        FROM customer""",
)
def drop_sensitive_query(t):
    people = t.customer.select(
        "c_custkey",
        "c_nationkey",
        "c_mktsegment",
        F.col("c_name").alias("nome_pessoa"),
        F.col("c_name").alias("cpf"),
        F.col("c_mktsegment").alias("cor_raca"),
    )
    dropped = clean.drop_sensitive(people, {"TAG_NOME": ["nome_pessoa"]})
    return clean.mask_sensitive(dropped, keep_joinable=["cpf"], key=MASK_KEY)


@query(
    "sanitize",
    r"""SELECT doc_id, md5(trim(regexp_replace(text, '[\s\x00-\x1F\x7F-\x9F]+', ' ', 'g'), ' ')) AS texto,
              CASE WHEN source = 'web' THEN NULL ELSE source END AS origem,
              coalesce(CASE WHEN doc_id % 3 <> 0 THEN lang END, 'sem') AS idioma,
              CASE WHEN doc_id % 5 = 0 THEN -1 ELSE doc_id END AS codigo
       FROM documents""",
)
def sanitize_query(t):
    number = F.when(F.col("doc_id") % 5 == 0, "x").otherwise(F.col("doc_id").cast("string"))
    df = t.documents.select(
        "doc_id",
        F.col("text").alias("texto"),
        F.col("source").alias("origem"),
        F.when(F.col("doc_id") % 3 != 0, F.col("lang")).alias("idioma"),
        number.alias("codigo"),
    )
    df = clean.sanitize_string(df, ["texto"]).withColumn("texto", F.md5("texto"))
    df = clean.null_if_invalid(df, ["origem"], ["WEB", "n/d"])
    df = clean.handle_null(df, {"idioma": "sem"})
    return clean.convert_type(df, "codigo", "bigint", default=-1)


@query(
    "parse_dates",
    """SELECT o_orderkey,
              CASE o_orderkey % 4 WHEN 0 THEN CAST(o_orderdate AS DATE) WHEN 1 THEN CAST(o_orderdate AS DATE)
                   WHEN 2 THEN CAST(date_trunc('month', o_orderdate) AS DATE) END AS data,
              CAST(date_trunc('year', o_orderdate) AS DATE) AS inicio_ano,
              CAST(year(o_orderdate) AS INTEGER) AS ano
       FROM orders""",
)
def parse_dates_query(t):
    day, kind = F.col("o_orderdate"), F.col("o_orderkey") % 4
    written = (
        F.when(kind == 0, F.date_format(day, "dd/MM/yyyy"))
        .when(kind == 1, F.date_format(day, "yyyy-MM-dd"))
        .when(kind == 2, F.date_format(day, "yyyy-MM"))
        .otherwise("sem data")
    )
    df = t.orders.select(
        "o_orderkey",
        written.alias("data"),
        conversion.year_start(F.year(day)).alias("inicio_ano"),
        conversion.leading_year(F.date_format(day, "yyyyMM")).alias("ano"),
    )
    return clean.parse_dates(df, "data", ["dd/MM/yyyy", "yyyy-MM-dd", "yyyy-MM"])


@query(
    "decode_status",
    """SELECT CASE o_orderstatus WHEN 'F' THEN 'Fechado' WHEN 'O' THEN 'Aberto' ELSE 'Outros' END AS situacao,
              CASE o_orderstatus WHEN 'F' THEN 'Fechado' END AS situacao_sem_padrao,
              COUNT(*) AS pedidos FROM orders GROUP BY 1, 2""",
)
def decode_status(t):
    df = clean.decode(t.orders, "o_orderstatus", {"F": "Fechado", "O": "Aberto"}, "situacao", "Outros")
    df = clean.decode(df, "o_orderstatus", {"F": "Fechado"}, "situacao_sem_padrao")
    return df.groupBy("situacao", "situacao_sem_padrao").agg(F.count(F.lit(1)).alias("pedidos"))


@query(
    "strip_suffix",
    """SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN CAST(s_suppkey AS VARCHAR)
                              ELSE CAST(s_suppkey AS VARCHAR) || '98' END AS id_campus FROM supplier""",
)
def strip_suffix_query(t):
    key = F.col("s_suppkey").cast("string")
    written = F.when(F.col("s_suppkey") % 3 == 0, F.concat(key, F.lit("99"))).otherwise(
        F.concat(key, F.lit("98"))
    )
    return clean.strip_suffix(t.supplier.select("s_suppkey", written.alias("id_campus")), "id_campus", "99")


@query(
    "harmonize",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS ano, COUNT(*) AS linhas,
              COUNT(CASE WHEN year(o_orderdate) >= 1998 THEN o_orderpriority END) AS com_prioridade,
              CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS valor
       FROM orders GROUP BY 1""",
)
def harmonize(t):
    year = F.year("o_orderdate").alias("ano")
    old = t.orders.where("year(o_orderdate) < 1998").select(
        year, F.col("o_totalprice").alias("quantidade_branca")
    )
    middle = t.orders.where("year(o_orderdate) between 1998 and 1999").select(
        year, F.col("o_totalprice").alias("quantidade_cor_branca"), "o_orderpriority"
    )
    new = t.orders.where("year(o_orderdate) > 1999").select(
        year, F.col("o_totalprice").alias("valor"), F.col("o_orderpriority").alias("prioridade")
    )
    merged = clean.harmonize_versions(
        [
            (old, {"quantidade_branca": "valor"}),
            (middle, {"quantidade_cor_branca": "valor", "o_orderpriority": "prioridade"}),
            (new, {}),
        ]
    )
    return merged.groupBy("ano").agg(
        F.count(F.lit(1)).alias("linhas"),
        F.count("prioridade").alias("com_prioridade"),
        F.sum(F.col("valor").cast("decimal(18,2)")).cast("double").alias("valor"),
    )


@query(
    "robust_flag",
    """SELECT CAST(year(l_shipdate) AS INTEGER) AS ano,
              COUNT(*) FILTER (WHERE CASE WHEN year(l_shipdate) < 2000 THEN l_returnflag = 'R'
                                          ELSE l_discount > 0 END) AS com_indicador
       FROM lineitem GROUP BY 1""",
)
def robust_flag(t):
    year = F.year("l_shipdate")
    df = t.lineitem.select(
        year.alias("ano"),
        F.when(year < 2000, F.col("l_returnflag") == "R").alias("indicador"),
        "l_discount",
    )
    flagged = clean.robust_indicator(df, "indicador", "l_discount")
    return flagged.groupBy("ano").agg(F.count_if("indicador").alias("com_indicador"))


@query(
    "filter_ci",
    "SELECT c_custkey FROM customer WHERE upper(c_mktsegment) = 'BUILDING'",
)
def filter_ci_query(t):
    mixed = t.customer.select("c_custkey", F.initcap("c_mktsegment").alias("segmento"))
    return clean.filter_ci(mixed, "segmento", "building").select("c_custkey")


@query(
    "exclude_status",
    """SELECT o_orderkey, nullif(o_orderstatus, 'P') AS situacao FROM orders
       WHERE o_orderstatus = 'O'""",
)
def exclude_status_query(t):
    status = F.nullif("o_orderstatus", F.lit("P")).alias("situacao")
    return clean.exclude_status(t.orders.select("o_orderkey", status), "situacao", ["F", "X"])


@query(
    "name_case",
    """SELECT p_partkey,
              CASE WHEN p_size = 1 THEN 'Sem informação' ELSE
                array_to_string(list_transform(string_split(p_name, ' '),
                  lambda w: upper(w[1]) || lower(w[2:])), '-') END AS nome
       FROM part""",
)
def name_case_query(t):
    written = F.when(F.col("p_size") != 1, F.upper(F.replace("p_name", F.lit(" "), F.lit("-"))))
    return clean.name_case(
        t.part.select("p_partkey", written.alias("nome")), "nome", "Sem informação"
    )


@query(
    "presence_flags",
    """SELECT l_returnflag, CAST(SUM(CASE WHEN l_discount = 0 THEN 1 ELSE 0 END) AS BIGINT) AS agua,
              CAST(SUM(CASE WHEN l_tax >= 0.05 OR l_quantity > 40 THEN 1 ELSE 0 END) AS BIGINT) AS patio
       FROM lineitem GROUP BY 1""",
)
def presence_flags_query(t):
    unknown = F.when(F.col("l_linenumber") < 9, F.col("l_tax"))
    flags = clean.presence_flags(
        t.lineitem.select("l_returnflag", "l_discount", "l_quantity", unknown.alias("l_tax")),
        {
            "agua": F.col("l_discount") == 0,
            "patio": [F.col("l_tax") >= 0.05, F.col("l_quantity") > 40],
        },
    )
    return flags.groupBy("l_returnflag").agg(F.sum("agua").alias("agua"), F.sum("patio").alias("patio"))


@query(
    "prefix_filter",
    """SELECT p_brand, COUNT(*) AS pecas FROM part
       WHERE p_brand LIKE 'Brand#1%' AND NOT p_type LIKE 'E%' AND length(p_brand) = 8 GROUP BY 1""",
)
def prefix_filter_query(t):
    rows = clean.prefix_filter(t.part, "p_brand", "Brand#1")
    rows = clean.prefix_filter(rows, "p_type", "E", negate=True)
    rows = clean.length_filter(rows, "p_brand", 8)
    return rows.groupBy("p_brand").agg(F.count(F.lit(1)).alias("pecas"))


@query(
    "flag_is_true",
    """SELECT o_orderkey, o_custkey FROM orders
       WHERE CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END""",
)
def flag_is_true(t):
    delivered = F.when(F.col("o_orderstatus") == "F", True).when(F.col("o_orderstatus") == "O", False)
    flagged = t.orders.select("o_orderkey", "o_custkey", delivered.alias("entregue"))
    return clean.select_except(clean.is_true(flagged, "entregue"), ["entregue"])


@query("select_except", "SELECT * EXCLUDE (n_name, n_regionkey) FROM nation")
def select_except(t):
    return clean.select_except(t.nation, ["n_name", "n_regionkey"])
