"""Queries for report formatting and data quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from civicpanel.catalogue import sql_text as sql
from civicpanel.catalogue.aggregate_queries import EVENT_STATES, count, event_states, sql_sum
from civicpanel.catalogue.places import PLACED_ORDERS, placed, placed_orders, territory, with_places
from civicpanel.catalogue.registry import query
from civicpanel.catalogue.territory_queries import EXPANDED_SQL, expanded_customers
from civicpanel.functions import formatting as fmt
from civicpanel.operators import aggregate as agg
from civicpanel.operators import quality, report, windows
from civicpanel.operators import territory as terr
from civicpanel.sources.literals import literal_table

MONEY = "decimal(18,2)"


@query(
    "fmt_int_br",
    f"SELECT o_orderkey, {sql.int_br('o_orderkey * 997 - 500000')} AS texto FROM orders",
)
def fmt_int_br(t):
    return t.orders.select("o_orderkey", fmt.fmt_int_br(F.col("o_orderkey") * 997 - 500000).alias("texto"))


VALUE_SQL = "v AS (SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) * (CASE o_orderkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 100 ELSE 20000 END) AS valor FROM orders)"


def scaled_orders(t):
    factor = (
        F.when(F.col("o_orderkey") % 3 == 0, 1).when(F.col("o_orderkey") % 3 == 1, 100).otherwise(20000)
    )
    value = (F.col("o_totalprice").cast(MONEY) * factor).cast("decimal(20,2)")
    return t.orders.select("o_orderkey", value.alias("valor"))


@query(
    "fmt_money_br",
    f"""WITH {VALUE_SQL} SELECT o_orderkey,
          'R$ ' || ({sql.money("valor", sql.int_br("CAST(valor AS DECIMAL(38,0))"))}) AS texto,
          'R$ ' || ({sql.money("valor", sql.millions("valor"))}) AS texto_milhoes FROM v""",
)
def fmt_money_br(t):
    value = F.col("valor")
    return scaled_orders(t).select(
        "o_orderkey",
        fmt.fmt_money_br(value).alias("texto"),
        fmt.fmt_money_br(value, small="millions").alias("texto_milhoes"),
    )


@query(
    "fmt_dec_br",
    f"""SELECT o_orderkey, {sql.dec_br("CAST(o_totalprice AS DECIMAL(18,2))", 1)} AS um,
               {sql.dec_br("CAST(o_totalprice AS DECIMAL(18,2))", 2)} AS dois,
               {sql.dec_br(sql.times("CAST(o_totalprice AS DECIMAL(18,2))", 3), 1)} || ' mil' AS mil FROM orders""",
)
def fmt_dec_br(t):
    value = F.col("o_totalprice").cast(MONEY)
    return t.orders.select(
        "o_orderkey",
        fmt.fmt_dec_br(value, 1).alias("um"),
        fmt.fmt_dec_br(value, 2).alias("dois"),
        fmt.fmt_mil(value).alias("mil"),
    )


@query(
    "fmt_general",
    """SELECT l_orderkey, l_linenumber, l_partkey,
              replace(printf('%g', l_quantity * 12.5), '.', ',') AS quantidade,
              CASE WHEN l_linenumber <> 3 THEN replace(printf('%g', CAST(l_partkey AS DOUBLE) / 64), '.', ',') END AS parcela
       FROM lineitem""",
)
def fmt_general(t):
    part = F.when(F.col("l_linenumber") != 3, F.col("l_partkey") / 64)
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        fmt.fmt_general(F.col("l_quantity") * 12.5).alias("quantidade"),
        fmt.fmt_general(part).alias("parcela"),
    )


PAIR_SQL = with_places(
    f"""SELECT sigla_uf || CASE WHEN sigla_uf = 'AS' THEN ' (*) Valor preliminar.' ELSE '' END AS uf,
           {sql.int_br("n")} || ' | Brasil: ' || {sql.int_br("nb")} AS pedidos,
           'R$ ' || {sql.millions("v")} || ' | Brasil: ' || 'R$ ' || {sql.billions("vb")} AS valor,
           {sql.ratio("u", "n", 1)} || '%' || ' | Brasil: ' || {sql.ratio("ub", "nb", 1)} || '%' AS urgentes,
           {sql.dec_br(sql.times("n", 3), 1)} || ' mil' || ' | Brasil: ' || {sql.int_br("nb")} AS milhares
        FROM (SELECT sigla_uf, n, u, v, SUM(n) OVER () AS nb, SUM(u) OVER () AS ub, SUM(v) OVER () AS vb FROM (
          SELECT sigla_uf, COUNT(*) AS n, COUNT(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS u,
                 {sql.cents("o_totalprice")} AS v FROM po GROUP BY 1))""",
    PLACED_ORDERS,
)


@query("pair_report", PAIR_SQL)
def pair_report(t):
    numbers = placed_orders(t).groupBy("sigla_uf").agg(
        count("n"),
        F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("u"),
        agg.money("o_totalprice").alias("v"),
    )
    numbers = windows.with_total(numbers, {"nb": F.sum("n"), "ub": F.sum("u"), "vb": F.sum("v")})
    numbers = numbers.withColumns(
        {
            "p": fmt.ratio(F.col("u"), F.col("n"), 1),
            "pb": fmt.ratio(F.col("ub"), F.col("nb"), 1),
            "uf": F.col("sigla_uf"),
        }
    )

    def percent(c):
        return F.concat(fmt.fmt_dec_br(c, 1), F.lit("%"))

    pairs = report.pair_report(
        numbers,
        ["sigla_uf", "uf"],
        {
            "pedidos": ("n", "nb", fmt.fmt_int_br, fmt.fmt_int_br),
            "valor": (
                "v",
                "vb",
                lambda c: F.concat(F.lit("R$ "), fmt.fmt_millions(c)),
                lambda c: F.concat(F.lit("R$ "), fmt.fmt_billions(c)),
            ),
            "urgentes": ("p", "pb", percent, percent),
            "milhares": ("n", "nb", fmt.fmt_mil, fmt.fmt_int_br),
        },
    )
    notes = literal_table(t.spark, [("AS", "(*) Valor preliminar.")], "sigla_uf string, nota string")
    return report.footnotes(pairs, notes, "sigla_uf", ["uf"]).drop("sigla_uf")


ITEMS_SQL = f"""SELECT p_brand, string_agg(CAST(n AS VARCHAR) || ' ' || p_type || ' = R$ ' ||
          CASE WHEN v < 1000000 THEN {sql.dec_br(sql.times("v", 3), 2)} || ' mil'
               ELSE {sql.millions("v")} END, ' | ' ORDER BY p_type) AS itens,
          CAST(SUM(n) AS VARCHAR) || CASE WHEN SUM(n) = 1 THEN ' item' ELSE ' itens' END AS total
        FROM (SELECT p_brand, coalesce(nullif(p_type, 'PROMO'), 'Outros') AS p_type, COUNT(*) AS n,
                     {sql.cents("l_extendedprice")} AS v
              FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)
        GROUP BY 1"""


@query("fmt_items", ITEMS_SQL)
def fmt_items(t):
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    kinds = rows.select("p_brand", F.nullif("p_type", F.lit("PROMO")).alias("p_type"), "l_extendedprice")
    detail = agg.grouped_detail(kinds, "p_brand", "p_type", "l_extendedprice", "Outros")
    lines = report.fmt_items(detail, "p_brand", "p_type", "itens")
    totals = detail.groupBy("p_brand").agg(
        report.campus_text(F.sum("qtd"), "item", "itens").alias("total")
    )
    return lines.join(totals, "p_brand")


@query(
    "overrides",
    f"""SELECT o_orderpriority, CASE o_orderpriority WHEN '2-HIGH' THEN 7386.0e0 WHEN '5-LOW' THEN 1.56e9
                 ELSE {sql_sum("o_totalprice")} END AS valor,
               o_orderpriority IN ('2-HIGH', '5-LOW') AS is_override FROM orders GROUP BY 1""",
)
def overrides(t):
    official = literal_table(
        t.spark, [("2-HIGH", 7386.0), ("5-LOW", 1.56e9)], "o_orderpriority string, oficial double"
    )
    computed = agg.group_sum(t.orders, ["o_orderpriority"], {"valor": "o_totalprice"})
    return report.apply_overrides(computed, official, ["o_orderpriority"], "valor", "oficial")


@query(
    "parse_pairs",
    with_places(
        """SELECT c_custkey,
              CAST(c_custkey AS DOUBLE) AS qtd_uf, CAST(c_custkey * 3 AS DOUBLE) AS qtd_br,
              CAST(c_custkey % 100 AS DOUBLE) + 0.5 AS qtd_uf_pct, CAST(NULL AS DOUBLE) AS qtd_br_pct,
              (CAST(c_custkey % 50 AS DOUBLE) + 1.25) * 1000000 AS valor_uf,
              (CAST(c_custkey % 50 AS DOUBLE) + 2.5) * 1000000000 AS valor_br,
              CAST(NULL AS DOUBLE) AS valor_uf_pct, CAST(NULL AS DOUBLE) AS valor_br_pct
           FROM customer"""
    ),
)
def parse_pairs(t):
    key = F.col("c_custkey")
    share = F.concat((key % 100).cast("string"), F.lit(",5%)"))
    amount = (key % 50).cast("decimal(18,2)")
    text = t.customer.select(
        "c_custkey",
        fmt.pair(F.concat(fmt.fmt_int_br(key), F.lit(" ("), share), fmt.fmt_int_br(key * 3)).alias("qtd"),
        fmt.pair(
            F.concat(F.lit("R$ "), fmt.fmt_millions((amount + 1.25).cast(MONEY) * 1_000_000)),
            F.concat(F.lit("R$ "), fmt.fmt_billions((amount + 2.5).cast(MONEY) * 1_000_000_000)),
        ).alias("valor"),
    )
    return report.parse_pairs(text, {"qtd": "qtd", "valor": "valor"}).drop("qtd", "valor")


# --- data quality -----------------------------------------------------------------


@query(
    "compare_counts",
    """SELECT 'dev' AS ambiente, COUNT(*) AS linhas, CAST(0 AS BIGINT) AS diferenca FROM orders
       UNION ALL SELECT 'prod', COUNT(*) FILTER (WHERE o_orderstatus <> 'P'),
                 COUNT(*) FILTER (WHERE o_orderstatus <> 'P') - COUNT(*) FROM orders""",
)
def compare_counts(t):
    return quality.compare_counts({"dev": t.orders, "prod": t.orders.where("o_orderstatus <> 'P'")})


ROW_LOSS_SQL = """SELECT 1 AS ordem, 'origem' AS etapa, COUNT(*) AS linhas, CAST(0 AS BIGINT) AS perda FROM orders
       UNION ALL SELECT 2, 'com situação', COUNT(*) FILTER (WHERE o_orderstatus <> 'P'),
                 COUNT(*) FILTER (WHERE o_orderstatus = 'P') FROM orders
       UNION ALL SELECT 3, 'com cliente', COUNT(*), (SELECT COUNT(*) FROM orders WHERE o_orderstatus <> 'P') - COUNT(*)
                 FROM orders JOIN customer ON o_custkey = c_custkey
                 WHERE o_orderstatus <> 'P' AND c_mktsegment <> 'BUILDING'"""


@query("row_loss", ROW_LOSS_SQL)
def row_loss(t):
    kept = t.orders.where("o_orderstatus <> 'P'")
    buyers = t.customer.where("c_mktsegment <> 'BUILDING'")
    joined = kept.join(buyers, F.col("o_custkey") == F.col("c_custkey"))
    return quality.row_loss_guard({"origem": t.orders, "com situação": kept, "com cliente": joined})


@query("row_loss_one_pass", ROW_LOSS_SQL)
def row_loss_one_pass(t):
    """The same counts, taken while the joined rows are written."""
    steps = quality.ObservedSteps()
    kept = steps.step(steps.step(t.orders, "origem").where("o_orderstatus <> 'P'"), "com situação")
    buyers = t.customer.where("c_mktsegment <> 'BUILDING'")
    joined = steps.step(kept.join(buyers, F.col("o_custkey") == F.col("c_custkey")), "com cliente")
    joined.write.format("noop").mode("overwrite").save()
    return steps.losses(t.spark)


@query(
    "reconcile",
    """WITH e(metrica, publicado) AS (VALUES ('1-URGENT', 1.0e12), ('5-LOW', 800000000.0e0), ('9-NONE', 5.0e0)),
       m AS (SELECT o_orderpriority AS metrica, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS valor
             FROM orders GROUP BY 1)
       SELECT metrica, valor, publicado, valor - publicado AS diferenca,
              abs(valor - publicado) / abs(publicado) AS diferenca_relativa,
              coalesce(abs(valor - publicado) / abs(publicado) <= 0.5, false) AS confere
       FROM m FULL JOIN e USING (metrica)""",
)
def reconcile(t):
    expected = literal_table(
        t.spark,
        [("1-URGENT", 1.0e12), ("5-LOW", 8.0e8), ("9-NONE", 5.0)],
        "metrica string, publicado double",
    )
    metrics = agg.group_sum(
        t.orders.withColumnRenamed("o_orderpriority", "metrica"), ["metrica"], {"valor": "o_totalprice"}
    )
    return quality.reconcile(metrics, expected, "metrica", "valor", "publicado", 0.5)


@query(
    "components_check",
    """SELECT o_orderkey, CAST(soma AS DOUBLE) AS soma, CAST(total AS DOUBLE) AS total,
              CAST(coalesce(soma, 0) - total AS DOUBLE) AS diferenca,
              abs(coalesce(soma, 0) - total) <= 200000 AS confere
       FROM (SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS total FROM orders)
       LEFT JOIN (SELECT l_orderkey, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS soma FROM lineitem GROUP BY 1)
       ON o_orderkey = l_orderkey""",
)
def components_check(t):
    items = t.lineitem.groupBy("l_orderkey").agg(agg.money("l_extendedprice").alias("soma"))
    orders = t.orders.select("o_orderkey", F.col("o_totalprice").cast(MONEY).alias("total"))
    joined = orders.join(items, F.col("o_orderkey") == F.col("l_orderkey"), "left").drop("l_orderkey")
    checked = quality.components_add_up(joined, ["soma"], "total", tolerance=200000)
    return checked.withColumns({c: F.col(c).cast("double") for c in ("soma", "total", "diferenca")})


@query(
    "null_profile",
    """SELECT ano, unnest(['indicador', 'quantidade']) AS coluna,
              unnest([CAST(COUNT(*) FILTER (WHERE indicador IS NULL) AS DOUBLE) / COUNT(*) * 100,
                      CAST(COUNT(*) FILTER (WHERE quantidade IS NULL) AS DOUBLE) / COUNT(*) * 100]) AS pct_nulo
       FROM (SELECT CAST(year(l_shipdate) AS INTEGER) AS ano,
                    CASE WHEN year(l_shipdate) < 2000 THEN l_returnflag END AS indicador,
                    nullif(l_quantity, 50) AS quantidade FROM lineitem) GROUP BY ano""",
)
def null_profile(t):
    year = F.year("l_shipdate")
    rows = t.lineitem.select(
        year.alias("ano"),
        F.when(year < 2000, F.col("l_returnflag")).alias("indicador"),
        F.nullif("l_quantity", F.lit(50.0)).alias("quantidade"),
    )
    return quality.null_profile(rows, ["ano"], ["indicador", "quantidade"])


@query(
    "level_overlap",
    with_places(
        f"""SELECT nivel_territorial AS nivel, COUNT(*) AS linhas, {sql_sum("c_acctbal")} AS soma,
                  (SELECT {sql_sum("c_acctbal")} FROM ex) AS soma_indevida, true AS niveis_conferem
           FROM ex GROUP BY 1""",
        EXPANDED_SQL,
    ),
)
def level_overlap(t):
    return quality.level_overlap_check(expanded_customers(t), "id", "c_acctbal")


@query(
    "dq_rules",
    """SELECT 'nome_preenchido' AS regra, COUNT(*) FILTER (WHERE c_custkey % 10 < 2) AS violacoes, COUNT(*) AS linhas FROM customer
       UNION ALL SELECT 'nome_opcional', COUNT(*) FILTER (WHERE c_custkey % 10 = 0), COUNT(*) FROM customer
       UNION ALL SELECT 'data_valida', COUNT(*) FILTER (WHERE c_custkey % 7 = 0), COUNT(*) FROM customer""",
)
def dq_rules(t):
    key = F.col("c_custkey")
    rows = t.customer.select(
        F.when(key % 10 == 0, "  ").when(key % 10 == 1, F.lit(None)).otherwise(F.col("c_name")).alias("nome"),
        F.when(key % 7 == 0, "31/02/2024").when(key % 7 > 2, "28/02/2024").alias("data"),
    )
    return quality.dq_rules(
        rows,
        {
            "nome_preenchido": quality.string_nullable("nome", required=True),
            "nome_opcional": quality.string_nullable("nome", required=False),
            "data_valida": quality.valid_date_format("data", "dd/MM/yyyy"),
        },
    )


@query(
    "unique_key",
    """SELECT l_orderkey, l_linenumber, COUNT(*) AS linhas FROM lineitem
       GROUP BY 1, 2 HAVING COUNT(*) > 1""",
)
def unique_key(t):
    return quality.unique_key(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "diagnose_zeros",
    with_places(
        """SELECT id_municipio AS id, nome || ' - ' || sigla_uf AS municipio,
                  CASE WHEN n_nationkey NOT IN (SELECT c_nationkey FROM customer JOIN orders ON c_custkey = o_custkey
                                                WHERE c_nationkey NOT IN (7, 14)) THEN 'sem fonte'
                       WHEN nome_uf = 'AFRICA' THEN 'perda no pipeline'
                       WHEN nome_uf = 'AMERICA' THEN 'zero real' ELSE 'com valor' END AS diagnostico
           FROM mun"""
    ),
)
def diagnose_zeros(t):
    # Two municipalities without a source, one state lost on the way, one with zeros.
    source = placed_orders(t).where("nome NOT IN ('NATION_7', 'NATION_14')").select(
        F.col("id_municipio").alias("id"), "nome_uf", "o_totalprice"
    )
    value = F.when(F.col("nome_uf") == "AMERICA", F.lit(0)).otherwise(F.col("o_totalprice"))
    shown = source.where("nome_uf <> 'AFRICA'")
    panel = shown.groupBy("id").agg(F.sum(value.cast(MONEY)).alias("valor"))
    return quality.diagnose_zeros(territory(t), panel, source, "id", "valor")


@query(
    "edition_guard",
    """SELECT o_custkey, COUNT(*) AS edicoes, CAST(SUM(v) AS DOUBLE) AS total,
              CAST(SUM(v) - MAX(v) AS DOUBLE) AS excedente
       FROM (SELECT o_custkey, year(o_orderdate) AS y, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS v
             FROM orders GROUP BY 1, 2) GROUP BY 1 HAVING COUNT(*) > 1""",
)
def edition_guard(t):
    return quality.edition_guard(t.orders, "o_custkey", F.year("o_orderdate"), "o_totalprice")


@query(
    "fanout_guard",
    """SELECT chave, e AS linhas_esquerda, d AS multiplicidade, e * (d - 1) AS linhas_extras
       FROM (SELECT o_orderkey AS chave, COUNT(*) AS e FROM orders GROUP BY 1)
       JOIN (SELECT l_orderkey AS chave, COUNT(*) AS d FROM lineitem GROUP BY 1 HAVING COUNT(*) > 1) USING (chave)""",
)
def fanout_guard(t):
    left = t.orders.select(F.col("o_orderkey").alias("chave"))
    right = t.lineitem.select(F.col("l_orderkey").alias("chave"))
    return quality.fanout_guard(left, right, ["chave"])


@query(
    "migrated",
    f"""WITH {EVENT_STATES}
        SELECT CAST(SUM(n) AS BIGINT) AS soma_estados, COUNT(*) AS pessoas,
               COUNT(*) FILTER (WHERE n > 1) AS em_varios_estados, CAST(SUM(n) - COUNT(*) AS BIGINT) AS excedente
        FROM (SELECT id_pessoa, COUNT(DISTINCT uf) AS n FROM ev WHERE uf IS NOT NULL GROUP BY 1)""",
)
def migrated(t):
    return quality.migrated_entities(event_states(t), "id_pessoa", "uf")
