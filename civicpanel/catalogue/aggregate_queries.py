"""Queries for joins, aggregates, windows and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from civicpanel.catalogue.places import (
    PLACED_ORDERS,
    municipalities,
    placed,
    placed_orders,
    states,
    territory,
    with_places,
)
from civicpanel.catalogue.registry import query
from civicpanel.lineage import written
from civicpanel.operators import aggregate as agg
from civicpanel.operators import joins, reshape, windows
from civicpanel.operators import territory as terr
from civicpanel.sources.literals import literal_table

MONEY = "decimal(18,2)"


def count(name: str):
    return F.count(F.lit(1)).alias(name)


def sql_sum(column: str) -> str:
    """Rounded once, after the sum."""
    return f"CAST(ROUND(SUM(CAST({column} AS DECIMAL(28,10))), 2) AS DOUBLE)"


# A share of an amount has fractions of a cent, which must not be rounded row by row.
def fine(column: str):
    return F.col(column).cast(MONEY) * F.lit("0.3337").cast("decimal(5,4)")


def fine_sql(column: str) -> str:
    return f"CAST({column} AS DECIMAL(18,2)) * CAST(0.3337 AS DECIMAL(5,4))"


# --- joins ---------------------------------------------------------------------


@query(
    "join_inner",
    f"""SELECT c_mktsegment, COUNT(*) AS pedidos, {sql_sum("o_totalprice")} AS valor
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""",
)
def join_inner(t):
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return agg.group_sum(joined, ["c_mktsegment"], {"valor": "o_totalprice"}, "pedidos")


@query(
    "join_left",
    f"""SELECT c_custkey, COUNT(o_orderkey) AS pedidos, {sql_sum("o_totalprice")} AS valor
        FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1""",
)
def join_left(t):
    # Orders are reduced to customers first, so that no customer row is repeated.
    per_customer = agg.group_sum(t.orders, ["o_custkey"], {"valor": "o_totalprice"}, "pedidos")
    joined = t.customer.join(per_customer, F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.select("c_custkey", F.coalesce("pedidos", F.lit(0)).alias("pedidos"), "valor")


@query(
    "join_full",
    """SELECT coalesce(o_custkey, user_id + 100) AS id_pessoa, COUNT(o_orderkey) AS com_pedido,
              COUNT(event_id) AS com_evento, COUNT(*) AS linhas
       FROM orders FULL JOIN events ON o_custkey = user_id + 100
       GROUP BY 1""",
)
def join_full(t):
    left = t.orders.select(F.col("o_custkey").alias("id_pessoa"), "o_orderkey")
    right = t.events.select((F.col("user_id") + 100).alias("id_pessoa"), "event_id")
    return (
        joins.full_join(left, right, ["id_pessoa"])
        .groupBy("id_pessoa")
        .agg(F.count("o_orderkey").alias("com_pedido"), F.count("event_id").alias("com_evento"), count("linhas"))
    )


@query(
    "cross_total",
    """SELECT c_mktsegment, COUNT(*) AS clientes, (SELECT COUNT(*) FROM customer) AS total
       FROM customer GROUP BY 1""",
)
def cross_total(t):
    segments = t.customer.groupBy("c_mktsegment").agg(count("clientes"))
    return windows.with_total(segments, {"total": F.sum("clientes")})


@query(
    "join_semi",
    """SELECT c_custkey, c_name FROM customer
       WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
)
def join_semi(t):
    urgent = t.orders.where("o_orderpriority = '1-URGENT'")
    people = t.customer.select("c_custkey", "c_name")
    return people.join(urgent, F.col("c_custkey") == F.col("o_custkey"), "left_semi")


@query(
    "join_cast",
    """SELECT n_name, COUNT(*) AS clientes FROM customer
       LEFT JOIN nation ON c_nationkey = n_nationkey AND n_nationkey % 5 <> 0 GROUP BY 1""",
)
def join_cast(t):
    number = F.col("n_nationkey")
    code = F.when(number % 5 == 0, "s/n").otherwise(F.lpad(number.cast("string"), 4, "0"))
    text_keys = t.nation.select(code.alias("codigo"), "n_name")
    joined = joins.join_on_cast(t.customer, text_keys, "c_nationkey", "codigo")
    return joined.groupBy("n_name").agg(count("clientes"))


@query(
    "join_dim_distinct",
    with_places(
        """SELECT id_uf, uf.sigla_uf, COUNT(*) AS clientes
           FROM (SELECT c_custkey, id_uf FROM customer JOIN mun ON c_nationkey = n_nationkey) c
           JOIN (SELECT DISTINCT id_uf, sigla_uf FROM mun) uf USING (id_uf) GROUP BY ALL"""
    ),
)
def join_dim_distinct(t):
    people = placed(t.customer, "c_nationkey", t).select("c_custkey", "id_uf")
    joined = joins.join_distinct(people, municipalities(t), ["id_uf", "sigla_uf"], "id_uf")
    return joined.groupBy("id_uf", "sigla_uf").agg(count("clientes"))


@query(
    "preagg_join",
    f"""SELECT chave, itens, quantidade, valor FROM
          (SELECT l_orderkey AS chave, COUNT(*) AS itens FROM lineitem GROUP BY 1)
          JOIN (SELECT l_orderkey AS chave, {sql_sum("l_quantity")} AS quantidade
                FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1) USING (chave)
          JOIN (SELECT o_orderkey AS chave, {sql_sum("o_totalprice")} AS valor FROM orders GROUP BY 1) USING (chave)""",
)
def preagg_join(t):
    items = t.lineitem.withColumnRenamed("l_orderkey", "chave")
    kept = items.where("l_returnflag <> 'R'")
    orders = t.orders.withColumnRenamed("o_orderkey", "chave")
    return joins.preaggregated_join(
        [
            (items, {"itens": F.count(F.lit(1))}),
            (kept, {"quantidade": agg.money("l_quantity").cast("double")}),
            (orders, {"valor": agg.money("o_totalprice").cast("double")}),
        ],
        ["chave"],
    )


# --- aggregates ------------------------------------------------------------------


@query(
    "group_sum",
    f"""SELECT l_returnflag, l_linestatus, {sql_sum(fine_sql("l_extendedprice"))} AS valor,
               {sql_sum("l_quantity")} AS quantidade, COUNT(*) AS linhas FROM lineitem GROUP BY 1, 2""",
)
def group_sum(t):
    sums = {"valor": "v", "quantidade": "l_quantity"}
    return agg.group_sum(t.lineitem.withColumn("v", fine("l_extendedprice")), ["l_returnflag", "l_linestatus"], sums, "linhas")


@query(
    "distinct_by_state",
    with_places(
        "SELECT sigla_uf, COUNT(DISTINCT o_custkey) AS pessoas FROM po GROUP BY 1", PLACED_ORDERS
    ),
)
def distinct_by_state(t):
    return agg.group_count_distinct(placed_orders(t), ["sigla_uf"], "o_custkey", "pessoas")


EVENT_STATES = """ev AS (SELECT user_id AS id_pessoa, CASE WHEN event_type = 'error' THEN NULL ELSE
  left(r_name, 2) END AS uf FROM events JOIN region ON r_regionkey = event_id % 5)"""


def event_states(t):
    """People by the state of each event; error events have no state."""
    joined = t.events.join(t.region, F.col("r_regionkey") == F.col("event_id") % 5)
    uf = F.when(F.col("event_type") != "error", F.left("r_name", F.lit(2)))
    return joined.select(F.col("user_id").alias("id_pessoa"), uf.alias("uf"))


@query(
    "distinct_by_level",
    f"""WITH {EVENT_STATES}
        SELECT uf, COUNT(DISTINCT id_pessoa) AS pessoas, 'estado' AS nivel FROM ev WHERE uf IS NOT NULL GROUP BY 1
        UNION ALL SELECT 'BR', COUNT(DISTINCT id_pessoa), 'pais' FROM ev""",
)
def distinct_by_level(t):
    return agg.distinct_by_level(event_states(t), "id_pessoa", "uf")


@query(
    "distinct_three_levels",
    with_places(
        """SELECT id_municipio AS id, COUNT(DISTINCT user_id) AS pessoas, 'municipio' AS nivel
           FROM ev WHERE id_municipio IS NOT NULL GROUP BY 1
           UNION ALL SELECT sigla_uf, COUNT(DISTINCT user_id), 'estado' FROM ev WHERE sigla_uf IS NOT NULL GROUP BY 1
           UNION ALL SELECT 'BR', COUNT(DISTINCT user_id), 'pais' FROM ev""",
        "ev AS (SELECT id_municipio, sigla_uf, user_id FROM events LEFT JOIN mun ON n_nationkey = event_id % 30)",
    ),
)
def distinct_three_levels(t):
    """People per municipality, state and country from one stored table of bitmaps."""
    rows = t.events.select("user_id", (F.col("event_id") % 30).alias("_nation"))
    places = municipalities(t).select("id_municipio", "sigla_uf", "n_nationkey")
    placed_rows = rows.join(places, F.col("_nation") == F.col("n_nationkey"), "left")
    stored = written(agg.person_bitmaps(placed_rows, "user_id", ["id_municipio", "sigla_uf"]))
    return agg.distinct_three_levels(stored, "id_municipio", "sigla_uf")


@query(
    "distinct_pair",
    """SELECT l_returnflag, COUNT(DISTINCT CASE WHEN l_linenumber <> 3
                THEN CAST(l_suppkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR) END) AS pares
       FROM lineitem GROUP BY 1""",
)
def distinct_pair(t):
    number = F.when(F.col("l_linenumber") != 3, F.col("l_linenumber"))
    rows = t.lineitem.withColumn("l_linenumber", number)
    return agg.distinct_composite(rows, ["l_returnflag"], ["l_suppkey", "l_linenumber"], "pares")


@query(
    "conditional_distinct",
    """SELECT l_linestatus, COUNT(DISTINCT CASE WHEN lower(l_returnflag) = 'r' AND l_discount > 0.05
                THEN l_suppkey END) AS fornecedores FROM lineitem GROUP BY 1""",
)
def conditional_distinct(t):
    condition = (F.lower("l_returnflag") == "r") & (F.col("l_discount") > 0.05)
    return agg.conditional_distinct(t.lineitem, ["l_linestatus"], condition, "l_suppkey", "fornecedores")


@query(
    "pivot_sum",
    f"""SELECT CAST(year(o_orderdate) AS INTEGER) AS ano,
         {sql_sum(f"CASE WHEN o_orderpriority = '1-URGENT' THEN {fine_sql('o_totalprice')} ELSE 0 END")} AS urgente,
         {sql_sum(f"CASE WHEN o_orderpriority = '5-LOW' THEN {fine_sql('o_totalprice')} ELSE 0 END")} AS baixa,
         {sql_sum(f"CASE WHEN o_orderpriority = 'nenhuma' THEN {fine_sql('o_totalprice')} ELSE 0 END")} AS nenhuma,
         COUNT(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS urgente_qtd
       FROM orders GROUP BY 1""",
)
def pivot_sum(t):
    rows = t.orders.withColumns({"ano": F.year("o_orderdate"), "v": fine("o_totalprice")})
    values = {"1-URGENT": "urgente", "5-LOW": "baixa", "nenhuma": "nenhuma"}
    counts = {"1-URGENT": "urgente_qtd"}
    return agg.pivot_sum(rows, ["ano"], "o_orderpriority", values, "v", counts)


@query(
    "pivot_year",
    """SELECT o_custkey, MAX(CASE WHEN year(o_orderdate) = 1997 THEN o_totalprice END) AS v1997,
              MAX(CASE WHEN year(o_orderdate) = 2000 THEN o_totalprice END) AS v2000
       FROM orders GROUP BY 1""",
)
def pivot_year(t):
    return agg.pivot_year(
        t.orders, ["o_custkey"], F.year("o_orderdate"), {1997: "v1997", 2000: "v2000"}, "o_totalprice"
    )


@query(
    "share",
    """SELECT l_suppkey, COUNT(*) FILTER (WHERE l_returnflag = 'R') AS devolvido_qtd, COUNT(*) AS devolvido_total,
              CAST(COUNT(*) FILTER (WHERE l_returnflag = 'R') AS DOUBLE) / COUNT(*) AS devolvido
       FROM lineitem GROUP BY 1""",
)
def share(t):
    return agg.share(t.lineitem, ["l_suppkey"], F.col("l_returnflag") == "R", "devolvido")


COVERAGE_SQL = with_places(
    """SELECT e.uf, e.nivel, e.n AS elegiveis, coalesce(b.n, 0) AS beneficiarios,
              CAST(100 AS DOUBLE) * coalesce(b.n, 0) / e.n AS cobertura
       FROM (SELECT sigla_uf AS uf, 'estado' AS nivel, COUNT(DISTINCT c_custkey) AS n FROM el GROUP BY 1
             UNION ALL SELECT 'BR', 'pais', COUNT(DISTINCT c_custkey) FROM el) e
       LEFT JOIN (SELECT sigla_uf AS uf, 'estado' AS nivel, COUNT(DISTINCT user_id) AS n FROM bn GROUP BY 1
             UNION ALL SELECT 'BR', 'pais', COUNT(DISTINCT user_id) FROM bn) b USING (uf, nivel)""",
    "el AS (SELECT c_custkey, sigla_uf FROM customer JOIN mun ON c_nationkey = n_nationkey)",
    """bn AS (SELECT user_id, sigla_uf FROM events JOIN el ON user_id = c_custkey
              WHERE CASE WHEN event_type = 'purchase' THEN true WHEN event_type = 'error' THEN NULL ELSE false END)""",
)


@query("coverage", COVERAGE_SQL)
def coverage(t):
    eligible = placed(t.customer, "c_nationkey", t).select(
        F.col("c_custkey").alias("id_pessoa"), F.col("sigla_uf").alias("uf")
    )
    kind = F.col("event_type")
    paid = F.when(kind == "purchase", True).when(kind != "error", False)
    events = t.events.select(F.col("user_id").alias("id_pessoa"), paid.alias("recebeu"))
    served = events.where("recebeu").join(eligible, "id_pessoa")
    return agg.coverage(served, eligible, "id_pessoa", "uf")


@query(
    "list_agg",
    with_places(
        """SELECT sigla_uf, string_agg(DISTINCT nome, ', ' ORDER BY nome) AS municipios
           FROM (SELECT sigla_uf, CASE WHEN n_nationkey % 5 <> 2 THEN nome END AS nome
                 FROM customer JOIN mun ON c_nationkey = n_nationkey) GROUP BY 1"""
    ),
)
def list_agg(t):
    name = F.when(F.col("c_nationkey") % 5 != 2, F.col("nome"))
    rows = placed(t.customer, "c_nationkey", t).select("sigla_uf", name.alias("nome"))
    return agg.list_agg(rows, ["sigla_uf"], "nome", "municipios", distinct=True)


@query(
    "any_flag",
    """SELECT l_orderkey, MAX(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS tem_devolucao,
              MAX(CASE WHEN l_quantity > 49 OR l_discount > 0.09 THEN 1 ELSE 0 END) AS tem_grande
       FROM lineitem GROUP BY 1""",
)
def any_flag(t):
    return agg.any_flag(
        t.lineitem,
        ["l_orderkey"],
        {
            "tem_devolucao": F.col("l_returnflag") == "R",
            "tem_grande": (F.col("l_quantity") > 49) | (F.col("l_discount") > 0.09),
        },
    )


@query(
    "dedupe_sum",
    """SELECT o_orderpriority, COUNT(*) AS obras, CAST(SUM(CAST(valor AS DECIMAL(18,2))) AS DOUBLE) AS valor
       FROM (SELECT l_orderkey, MAX(o_orderpriority) AS o_orderpriority, MAX(o_totalprice) AS valor
             FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1) GROUP BY 1""",
)
def dedupe_sum(t):
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return agg.dedupe_then_sum(rows, "l_orderkey", "o_orderpriority", {"valor": "o_totalprice"}, "obras")


DEFICIT_SQL = """SELECT l_orderkey, l_linenumber, CAST(SUM(p) AS BIGINT) AS pontuacao,
         CASE WHEN SUM(p) >= 2 THEN 'Atende a 3 itens' WHEN SUM(p) = 1 THEN 'Atende a 4 itens'
              WHEN SUM(p) = 0 THEN 'Atende a todos os itens' END AS indice_infraestrutura
       FROM (SELECT l_orderkey, l_linenumber,
               CASE WHEN l_returnflag = 'A' THEN NULL WHEN l_returnflag = 'R' THEN 1 ELSE 0 END
               + CASE WHEN l_quantity < 2 THEN 1 ELSE 0 END
               + CASE WHEN l_discount > 0 THEN 0 ELSE 1 END AS p FROM lineitem)
       GROUP BY 1, 2"""


@query("deficit_score", DEFICIT_SQL)
def deficit_score(t):
    flag = F.col("l_returnflag")
    rows = t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.when(flag == "A", F.lit(None)).when(flag == "R", 1).otherwise(0).alias("agua_inexistente"),
        F.when(F.col("l_quantity") < 2, 1).otherwise(0).alias("energia_inexistente"),
        F.when(F.col("l_discount") > 0, 1).alias("internet"),
    )
    return agg.deficit_score(
        rows, ["l_orderkey", "l_linenumber"], ["agua_inexistente", "energia_inexistente"], ["internet"]
    )


@query(
    "size_band",
    """SELECT c_custkey, COUNT(*) AS total, CASE WHEN COUNT(*) <= 5 THEN 'Até 5' WHEN COUNT(*) <= 10 THEN 'De 6 a 10'
              WHEN COUNT(*) <= 15 THEN 'De 11 a 15' ELSE 'Mais de 15' END AS porte
       FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""",
)
def size_band(t):
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    labels = ["Até 5", "De 6 a 10", "De 11 a 15", "Mais de 15"]
    return agg.size_band(rows, ["c_custkey"], F.count(F.lit(1)), [5, 10, 15], labels, "porte")


MAJORITY_SQL = """SELECT l_orderkey, CAST(SUM(t) AS BIGINT) AS total, CAST(SUM(a) AS BIGINT) AS a,
         CAST(SUM(n) AS BIGINT) AS n, CAST(SUM(r) AS BIGINT) AS r,
         CASE WHEN SUM(a) * 10 >= SUM(t) * 4 AND SUM(t) <> 0 THEN 'Maioria A'
              WHEN (SUM(n) + SUM(r)) * 10 >= SUM(t) * 4 AND SUM(t) <> 0 THEN 'Maioria N ou R'
              ELSE 'Sem maioria' END AS maioria
       FROM (SELECT l_orderkey, CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END AS t,
               CASE WHEN l_quantity > 25 AND l_returnflag = 'A' THEN 1 ELSE 0 END AS a,
               CASE WHEN l_quantity > 25 AND l_returnflag = 'N' AND l_tax > 0.04 THEN 1 ELSE 0 END AS n,
               CASE WHEN l_quantity > 25 AND l_returnflag = 'R' AND l_tax > 0.04 THEN 1 ELSE 0 END AS r FROM lineitem)
       GROUP BY 1"""


@query("majority_group", MAJORITY_SQL)
def majority_group(t):
    large, flag = F.col("l_quantity") > 25, F.col("l_returnflag")
    taxed = F.col("l_tax") > 0.04
    rows = t.lineitem.select(
        "l_orderkey",
        F.when(large, 1).otherwise(0).alias("total"),
        F.when(large & (flag == "A"), 1).otherwise(0).alias("a"),
        F.when(large & (flag == "N") & taxed, 1).otherwise(0).alias("n"),
        F.when(large & (flag == "R") & taxed, 1).otherwise(0).alias("r"),
    )
    return agg.majority_group(
        rows,
        ["l_orderkey"],
        {"Maioria A": ["a"], "Maioria N ou R": ["n", "r"]},
        "total",
        "maioria",
        "Sem maioria",
        threshold=0.4,
    )


@query(
    "possession_pct",
    """SELECT l_suppkey,
              CAST(COUNT(*) FILTER (WHERE l_quantity > 25) AS DOUBLE) / COUNT(*) * 100 AS pct_cozinha,
              CAST(COUNT(*) FILTER (WHERE l_tax = 0 OR l_discount = 0) AS DOUBLE) / COUNT(*) * 100 AS pct_quadra
       FROM lineitem GROUP BY 1""",
)
def possession_pct(t):
    return agg.possession_pct(
        t.lineitem,
        ["l_suppkey"],
        {
            "pct_cozinha": F.col("l_quantity") > 25,
            "pct_quadra": (F.col("l_tax") == 0) | (F.col("l_discount") == 0),
        },
    )


@query(
    "money_sum",
    f"""SELECT l_suppkey, {sql_sum(f"CASE WHEN l_linenumber = 1 THEN 0 ELSE {fine_sql('l_extendedprice')} END")} AS valor
        FROM lineitem GROUP BY 1""",
)
def money_sum(t):
    value = F.when(F.col("l_linenumber") != 1, fine("l_extendedprice"))
    return agg.money_sum(t.lineitem.withColumn("v", value), ["l_suppkey"], "v", "valor")


@query("distinct_rows", "SELECT DISTINCT o_custkey, o_orderpriority FROM orders")
def distinct_rows(t):
    return agg.distinct_rows(t.orders, ["o_custkey", "o_orderpriority"])


@query(
    "latest_flag",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS ano,
              year(o_orderdate) = (SELECT MAX(year(o_orderdate)) FROM orders) AS ultimo_ano FROM orders""",
)
def latest_flag(t):
    return agg.latest_flag(t.orders.select("o_orderkey", F.year("o_orderdate").alias("ano")), "ano")


@query(
    "component_total",
    """SELECT l_returnflag, a / 100 AS preco, b / 100 AS imposto, (a + b) / 100 AS total FROM (
         SELECT l_returnflag, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) * 100 AS BIGINT) AS a,
                CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) * 100 AS BIGINT) AS b
         FROM lineitem GROUP BY 1)""",
)
def component_total(t):
    sums = t.lineitem.groupBy("l_returnflag").agg(
        agg.money("l_extendedprice").alias("preco"), agg.money("l_quantity").alias("imposto")
    )
    total = agg.component_total(sums, ["preco", "imposto"], "total")
    return total.select("l_returnflag", *[F.col(c).cast("double").alias(c) for c in ("preco", "imposto", "total")])


@query(
    "multi_source_sum",
    f"""SELECT nacao, {sql_sum("saldo")} AS valor FROM (
          SELECT CAST(c_nationkey AS INTEGER) AS nacao, c_acctbal AS saldo FROM customer
          UNION ALL SELECT s_nationkey, s_acctbal FROM supplier) GROUP BY 1""",
)
def multi_source_sum(t):
    customers = t.customer.select(F.col("c_nationkey").alias("nacao"), F.col("c_acctbal").alias("saldo"))
    suppliers = t.supplier.select(F.col("s_nationkey").alias("nacao"), F.col("s_acctbal").alias("saldo"))
    return agg.multi_source_sum([customers, suppliers], ["nacao"], {"valor": "saldo"})


@query(
    "grouped_detail",
    f"""SELECT c_nationkey AS nacao, coalesce(nullif(c_mktsegment, 'BUILDING'), 'Outras Estruturas') AS tipologia,
               COUNT(*) AS qtd, {sql_sum("c_acctbal")} AS valor,
               CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) * 0.000001 AS DOUBLE) AS valor_milhoes
        FROM customer GROUP BY 1, 2""",
)
def grouped_detail(t):
    rows = t.customer.select(
        F.col("c_nationkey").alias("nacao"),
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("tipologia"),
        "c_acctbal",
    )
    detail = agg.grouped_detail(rows, "nacao", "tipologia", "c_acctbal", "Outras Estruturas")
    return detail.withColumns({c: F.col(c).cast("double") for c in ("valor", "valor_milhoes")})


@query(
    "deflate",
    """WITH idx(ano, fator) AS (VALUES (1995, 1.48701), (1996, 1.41), (1997, 1.35), (1998, 1.2), (1999, 1.1), (2000, 1.0))
       SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS ano, o_totalprice,
              CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(fator AS DECIMAL(12,8)) AS DECIMAL(18,2)) AS DOUBLE) AS valor_real
       FROM orders LEFT JOIN idx ON year(o_orderdate) = ano""",
)
def deflate(t):
    index = literal_table(
        t.spark,
        [(1995, "1.48701"), (1996, "1.41"), (1997, "1.35"), (1998, "1.2"), (1999, "1.1"), (2000, "1")],
        "ano int, fator string",
    )
    rows = t.orders.select("o_orderkey", F.year("o_orderdate").alias("ano"), "o_totalprice")
    real = agg.deflate(rows, index, "ano", "fator", {"o_totalprice": "valor_real"})
    return real.withColumn("valor_real", F.col("valor_real").cast("double"))


# --- windows -----------------------------------------------------------------------


@query(
    "first_per_key",
    """SELECT s_nationkey, s_suppkey, s_name FROM (
         SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey) AS rn FROM supplier)
       WHERE rn = 1""",
)
def first_per_key(t):
    order = [F.col("s_acctbal").desc(), F.col("s_suppkey")]
    return windows.first_per_key(t.supplier, ["s_nationkey"], order).drop("s_acctbal")


@query(
    "latest_per_key",
    """SELECT user_id, event_id, event_type, value FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE) DESC, event_id) AS rn FROM events)
       WHERE rn = 1""",
)
def latest_per_key(t):
    rows = t.events.select("user_id", "event_id", "event_type", "value", F.to_date("ts").alias("dia"))
    return windows.latest_per_key(rows, ["user_id"], ["dia"], ["event_id"]).drop("dia")


@query(
    "ids_over_loads",
    """WITH k AS (SELECT p_brand, p_name, MIN(CASE WHEN p_size > 25 THEN 2 ELSE 1 END) AS carga FROM part GROUP BY 1, 2)
       SELECT p_brand, p_name, ROW_NUMBER() OVER (ORDER BY carga, p_brand, p_name) AS id_variacao FROM k""",
)
def ids_over_loads(t):
    """Ids of two loads of one dictionary: the first load's ids stay as they are."""
    columns, out = ["p_brand", "p_name"], "id_variacao"
    first = windows.dense_id(t.part.where("p_size <= 25"), columns, out)
    return first.unionByName(windows.extend_ids(first, t.part, columns, out))


@query(
    "dense_id",
    """SELECT p_brand, p_name, dense_rank() OVER (ORDER BY p_brand, p_name) AS id_variacao
       FROM (SELECT DISTINCT p_brand, p_name FROM part)""",
)
def dense_id(t):
    return windows.dense_id(t.part, ["p_brand", "p_name"], "id_variacao")


@query(
    "with_total",
    """SELECT l_suppkey, COUNT(*) AS linhas, CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantidade,
              CAST(SUM(COUNT(*)) OVER () AS BIGINT) AS linhas_br,
              CAST(SUM(SUM(CAST(l_quantity AS DECIMAL(18,2)))) OVER () AS DOUBLE) AS quantidade_br
       FROM lineitem GROUP BY 1""",
)
def with_total(t):
    grouped = agg.group_sum(t.lineitem, ["l_suppkey"], {"quantidade": "l_quantity"}, "linhas")
    totals = {"linhas_br": F.sum("linhas"), "quantidade_br": agg.money("quantidade").cast("double")}
    return windows.with_total(grouped, totals)


@query(
    "share_of_total",
    """SELECT l_suppkey, devolvidas, linhas,
              CAST(SUM(devolvidas) OVER () AS DOUBLE) / CAST(SUM(linhas) OVER () AS DOUBLE) AS parcela_br
       FROM (SELECT l_suppkey, COUNT(*) FILTER (WHERE l_returnflag = 'R') AS devolvidas, COUNT(*) AS linhas
             FROM lineitem GROUP BY 1)""",
)
def share_of_total(t):
    grouped = t.lineitem.groupBy("l_suppkey").agg(
        F.count_if(F.col("l_returnflag") == "R").alias("devolvidas"), count("linhas")
    )
    return windows.share_of_total(grouped, "devolvidas", "linhas", "parcela_br")


# --- reshaping ----------------------------------------------------------------------


@query(
    "union_origin",
    """SELECT origem, nacao, COUNT(*) AS linhas FROM (
         SELECT 'cliente' AS origem, c_nationkey AS nacao FROM customer
         UNION ALL SELECT 'fornecedor', s_nationkey FROM supplier) GROUP BY 1, 2""",
)
def union_origin(t):
    customers = t.customer.select(F.col("c_nationkey").alias("nacao"), F.col("c_name").alias("nome_pessoa"))
    suppliers = t.supplier.select(F.col("s_nationkey").alias("nacao"), F.col("s_name").alias("cpf"))
    stacked = reshape.union_with_origin({"cliente": customers, "fornecedor": suppliers})
    return stacked.groupBy("origem", "nacao").agg(count("linhas"))


@query(
    "union_all",
    """SELECT c_nationkey AS nacao FROM customer UNION ALL SELECT s_nationkey FROM supplier
       UNION ALL SELECT s_nationkey FROM supplier""",
)
def union_all(t):
    suppliers = t.supplier.select(F.col("s_nationkey").alias("nacao"))
    return reshape.union_all([t.customer.select(F.col("c_nationkey").alias("nacao")), suppliers, suppliers])


PERIOD_SQL = """SELECT o_orderkey, ordem, ano_mes, valor_repasse, CASE WHEN ordem = 1 THEN matriculas END AS matriculas
  FROM (SELECT o_orderkey, o_custkey AS matriculas,
          unnest([{'ordem': 1, 'ano_mes': '2025-10', 'v': o_totalprice},
                  {'ordem': 2, 'ano_mes': '2025-11', 'v': CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END},
                  {'ordem': 3, 'ano_mes': '2025-12', 'v': NULL}]) AS r FROM orders)
  CROSS JOIN LATERAL (SELECT r.ordem AS ordem, r.ano_mes AS ano_mes, r.v AS valor_repasse)"""


def periods(t):
    wide = t.orders.select(
        "o_orderkey",
        F.col("o_custkey").alias("matriculas"),
        F.col("o_totalprice").alias("v1"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("v2"),
        F.lit(None).cast("double").alias("v3"),
    )
    months = [(1, "2025-10", "v1"), (2, "2025-11", "v2"), (3, "2025-12", "v3")]
    return reshape.unpivot_periods(wide, months, "ordem", "ano_mes", "valor_repasse")


@query("unpivot_periods", PERIOD_SQL.replace("CASE WHEN ordem = 1 THEN matriculas END", "matriculas"))
def unpivot_periods(t):
    return periods(t)


@query("guard_fixed", PERIOD_SQL)
def guard_fixed(t):
    return reshape.guard_fixed_metrics(periods(t), "ordem", ["matriculas"])


@query(
    "annex_list",
    """SELECT s_nationkey, s_name, s_acctbal FROM supplier WHERE s_acctbal > 1000
       ORDER BY s_nationkey, s_name""",
)
def annex_list(t):
    rows = t.supplier.where("s_acctbal > 1000").select("s_nationkey", "s_name", "s_acctbal")
    return reshape.order_report(rows, ["s_nationkey", "s_name"])


@query(
    "top_n",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25",
)
def top_n(t):
    rows = t.orders.select("o_orderkey", "o_totalprice")
    return reshape.sample_rows(rows, [F.col("o_totalprice").desc(), "o_orderkey"], 25)


@query(
    "long_metrics",
    with_places(
        """SELECT uf, municipio, nivel_agregacao, metrica, valor FROM (
             SELECT sigla_uf AS uf, nome AS municipio, 'Municipio' AS nivel_agregacao, COUNT(*) AS pedidos, SUM(v) AS valor FROM f GROUP BY 1, 2
             UNION ALL SELECT sigla_uf, 'Todos', 'Estado', COUNT(*), SUM(v) FROM f GROUP BY 1
             UNION ALL SELECT 'Todos', 'Todos', 'Nacional', COUNT(*), SUM(v) FROM f) x
           CROSS JOIN LATERAL (SELECT 'pedidos' AS metrica, CAST(x.pedidos AS DOUBLE) AS valor
                               UNION ALL SELECT 'valor', CAST(x.valor AS DOUBLE)) y(metrica, valor)""".replace(
            "SELECT uf, municipio, nivel_agregacao, metrica, valor FROM",
            "SELECT x.uf, x.municipio, x.nivel_agregacao, y.metrica, y.valor FROM",
        ),
        PLACED_ORDERS,
        "f AS (SELECT sigla_uf, nome, CAST(o_totalprice AS DECIMAL(18,2)) AS v FROM po)",
    ),
)
def long_metrics(t):
    measures = {"pedidos": F.lit(1), "valor": F.col("o_totalprice").cast(MONEY)}
    levels = terr.rollup_levels(placed_orders(t), "sigla_uf", "nome", measures)
    return reshape.to_long(levels, ["uf", "municipio", "nivel_agregacao"], ["pedidos", "valor"])


@query(
    "star_join",
    """SELECT n_nationkey, n_name, clientes, saldo, fornecedores
       FROM nation
       LEFT JOIN (SELECT c_nationkey, COUNT(*) AS clientes, CAST(ROUND(SUM(CAST(c_acctbal AS DECIMAL(28,10))), 2) AS DOUBLE) AS saldo
                  FROM customer WHERE c_nationkey <> 3 GROUP BY 1) ON c_nationkey = n_nationkey
       LEFT JOIN (SELECT s_nationkey, COUNT(*) AS fornecedores FROM supplier GROUP BY 1) ON s_nationkey = n_nationkey""",
)
def star_join(t):
    # One nation has no customers of its own, so that a block without a row is seen.
    nation = F.nullif("c_nationkey", F.lit(3)).alias("n_nationkey")
    customers = t.customer.groupBy(nation).agg(
        F.count(F.lit(1)).alias("clientes"), agg.money("c_acctbal").cast("double").alias("saldo")
    )
    suppliers = t.supplier.groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("fornecedores"))
    return joins.star_join(t.nation.select("n_nationkey", "n_name"), [customers, suppliers], "n_nationkey", t.nation)
