"""Queries for the territory operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from civicpanel.catalogue.aggregate_queries import fine, fine_sql, sql_sum
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
from civicpanel.operators import territory as terr
from civicpanel.operators.aggregate import group_sum
from civicpanel.operators.clean import numeric_code_filter


@query("territory_dim", with_places("SELECT * FROM ter"))
def territory_dim(t):
    return territory(t)


def named_customers(t):
    """Customers with the written name and state of their municipality, some of them wrong."""
    places = placed(t.customer, "c_nationkey", t)
    kind = F.col("c_custkey") % 10
    name = F.when(kind == 0, "Desconhecida").otherwise(F.concat("nome", F.lit("")))
    uf = F.when(kind == 1, F.concat(F.lit(" "), "sigla_uf", F.lit(" "))).otherwise(F.col("sigla_uf"))
    return places.select("c_custkey", "c_acctbal", name.alias("no_municipio"), uf.alias("uf"))


NAMED_SQL = """nc AS (
  SELECT c_custkey, c_acctbal, CASE WHEN c_custkey % 10 = 0 THEN 'Desconhecida' ELSE nome END AS no_municipio,
         CASE WHEN c_custkey % 10 = 1 THEN ' ' || sigla_uf || ' ' ELSE sigla_uf END AS uf
  FROM customer JOIN mun ON c_nationkey = n_nationkey)"""


@query(
    "resolve_label",
    with_places(
        """SELECT nc.c_custkey, nc.no_municipio, ter.id FROM nc
           LEFT JOIN ter ON trim(no_municipio || ' - ' || trim(uf)) = trim(ter.municipio)""",
        NAMED_SQL,
    ),
)
def resolve_label(t):
    resolved = terr.resolve_by_label(named_customers(t), territory(t), "no_municipio", "uf")
    return resolved.select("c_custkey", "no_municipio", "id")


@query(
    "resolve_name_uf",
    with_places(
        """SELECT nc.c_custkey, mun.id_municipio AS id, mun.nome_uf FROM nc
           LEFT JOIN mun ON lower(trim(no_municipio)) = lower(mun.nome) AND trim(uf) = mun.sigla_uf""",
        NAMED_SQL,
    ),
)
def resolve_name_uf(t):
    shouting = named_customers(t).withColumn("no_municipio", F.lower("no_municipio"))
    resolved = terr.resolve_by_name_uf(
        shouting, municipalities(t), "no_municipio", "uf", {"id_municipio": "id", "nome_uf": "nome_uf"}
    )
    return resolved.select("c_custkey", "id", "nome_uf")


# Two homonyms: every NATION_k with k >= 23 is called HOMONIMA.
HOMONYM_SQL = """hm AS (
  SELECT id_municipio, sigla_uf, CASE WHEN n_nationkey >= 23 THEN 'HOMONIMA' ELSE nome END AS nome,
         n_nationkey FROM mun),
uq AS (SELECT nome, min(id_municipio) AS id, min(sigla_uf) AS uf FROM hm GROUP BY nome HAVING count(*) = 1),
sv AS (SELECT c_custkey, hm.nome AS cidade,
              CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 3 = 1 THEN 'XX' ELSE sigla_uf END AS uf
       FROM customer JOIN hm ON c_nationkey = n_nationkey)"""


def with_homonyms(places):
    return places.withColumn(
        "nome", F.when(F.col("n_nationkey") >= 23, "HOMONIMA").otherwise(F.col("nome"))
    )


@query(
    "resolve_fallback",
    with_places(
        """SELECT sv.c_custkey, coalesce(hm.id_municipio, uq.id) AS id,
                  coalesce(hm.sigla_uf, uq.uf) AS uf_territorio,
                  CASE WHEN hm.id_municipio IS NOT NULL THEN 'nome e uf'
                       WHEN uq.id IS NOT NULL THEN 'nome' END AS metodo
           FROM sv LEFT JOIN hm ON sv.cidade = hm.nome AND sv.uf = hm.sigla_uf
           LEFT JOIN uq ON sv.cidade = uq.nome AND hm.id_municipio IS NULL""",
        HOMONYM_SQL,
    ),
)
def resolve_fallback(t):
    places = with_homonyms(municipalities(t))
    kind = F.col("c_custkey") % 3
    survey = t.customer.join(places, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey",
        F.lower("nome").alias("cidade"),
        F.when(kind == 0, F.lit(None)).when(kind == 1, "XX").otherwise(F.col("sigla_uf")).alias("uf"),
    )
    resolved = terr.resolve_with_fallback(survey, places, "cidade", "uf")
    return resolved.select("c_custkey", "id", "uf_territorio", "metodo")


MIXED_SQL = """cap AS (
  SELECT id_uf, nome_uf, nome_regiao, arg_min(latitude, id_municipio) AS latitude,
         arg_min(longitude, id_municipio) AS longitude, arg_min(coordenada, id_municipio) AS coordenada
  FROM mun WHERE capital_uf = 1 GROUP BY ALL),
codes AS (SELECT id_municipio AS id, id_uf, nome_uf, nome_regiao AS regiao, latitude, longitude, coordenada FROM mun
          UNION ALL SELECT id_uf, id_uf, nome_uf, nome_regiao, latitude, longitude, coordenada FROM cap)"""


@query(
    "resolve_mixed",
    with_places(
        """SELECT c.c_custkey, codes.* FROM customer c JOIN mun ON c_nationkey = n_nationkey
           JOIN codes ON codes.id = CASE c_custkey % 4 WHEN 0 THEN mun.id_uf WHEN 1 THEN 'x' ELSE id_municipio END""",
        MIXED_SQL,
    ),
)
def resolve_mixed(t):
    places = municipalities(t)
    kind = F.col("c_custkey") % 4
    code = F.when(kind == 0, F.col("id_uf")).when(kind == 1, "x").otherwise(F.col("id_municipio"))
    coded = placed(t.customer, "c_nationkey", t).select(
        "c_custkey", F.concat(F.lit(" "), code).alias("codigo")
    )
    return terr.resolve_mixed_codes(coded, places, "codigo").drop("codigo")


EXPANDED_SQL = """ex AS (
  SELECT c_custkey, c_acctbal, sigla_uf, id_municipio AS id, 'municipio' AS nivel_territorial, nome_uf AS estado,
         nome || ' - ' || sigla_uf AS municipio, nome_uf AS estado_nome, nome AS municipio_nome,
         nome || ' - ' || sigla_uf AS nome_territorio, nome || ' - ' || sigla_uf AS titulo
  FROM customer JOIN mun ON c_nationkey = n_nationkey
  UNION ALL
  SELECT c_custkey, c_acctbal, sigla_uf, id_uf, 'estado', nome_uf, 'Todos', nome_uf, nome, 'Todos', nome_uf
  FROM customer JOIN mun ON c_nationkey = n_nationkey
  UNION ALL
  SELECT c_custkey, c_acctbal, sigla_uf, '99', 'pais', 'Todos', 'Todos', nome_uf, nome, 'Todos', 'Brasil'
  FROM customer JOIN mun ON c_nationkey = n_nationkey)"""


def expanded_customers(t):
    people = placed(t.customer, "c_nationkey", t).select(
        "c_custkey", "c_acctbal", "id_municipio", "nome", "sigla_uf", "nome_uf"
    )
    expanded = terr.expand_levels(people, "id_municipio", "nome", "sigla_uf", "nome_uf")
    return expanded.drop("nome", "nome_uf")


@query("expand_levels", with_places("SELECT * FROM ex", EXPANDED_SQL))
def expand_levels(t):
    return expanded_customers(t)


@query(
    "expand_ids",
    with_places(
        """SELECT id, COUNT(*) AS clientes FROM (
             SELECT id_municipio AS id FROM customer JOIN mun ON c_nationkey = n_nationkey
             UNION ALL SELECT id_uf FROM customer JOIN mun ON c_nationkey = n_nationkey
             UNION ALL SELECT '99' FROM customer JOIN mun ON c_nationkey = n_nationkey) GROUP BY id"""
    ),
)
def expand_ids(t):
    rows = terr.expand_ids(placed(t.customer, "c_nationkey", t), "id_municipio")
    return rows.groupBy("id").agg(F.count(F.lit(1)).alias("clientes"))


UNRESOLVED_SQL = """un AS (SELECT c_custkey, CASE WHEN c_custkey % 6 <> 0 THEN id_municipio END AS codigo
  FROM customer JOIN mun ON c_nationkey = n_nationkey),
ux AS (SELECT c_custkey, codigo AS id FROM un WHERE codigo IS NOT NULL
  UNION ALL SELECT c_custkey, left(codigo, 2) FROM un WHERE codigo IS NOT NULL
  UNION ALL SELECT c_custkey, '99' FROM un)"""


def half_resolved(t):
    code = F.when(F.col("c_custkey") % 6 != 0, F.col("id_municipio")).alias("codigo")
    return placed(t.customer, "c_nationkey", t).select("c_custkey", code)


@query("expand_unresolved", with_places("SELECT * FROM ux", UNRESOLVED_SQL))
def expand_unresolved(t):
    return terr.expand_keep_unresolved(half_resolved(t), "codigo").drop("codigo")


ROLLUP_SQL = with_places(
    """SELECT lv.uf, lv.municipio, lv.nivel_agregacao, lv.o_orderpriority,
              CAST(lv.valor AS DOUBLE) AS valor, CAST(lv.pedidos AS BIGINT) AS pedidos,
              CASE WHEN lv.municipio = 'Todos' THEN 'Todos' ELSE region.r_name END AS estado,
              coalesce(region.r_name, 'Brasil') AS estado_nome,
              CASE WHEN lv.municipio <> 'Todos' THEN lv.municipio END AS municipio_nome
       FROM (SELECT uf, municipio, 'Municipio' AS nivel_agregacao, o_orderpriority, valor, pedidos FROM m
             UNION ALL SELECT uf, 'Todos', 'Estado', o_orderpriority, SUM(valor), SUM(pedidos) FROM m
               GROUP BY uf, o_orderpriority
             UNION ALL SELECT 'Todos', 'Todos', 'Nacional', o_orderpriority, SUM(valor), SUM(pedidos) FROM m
               GROUP BY o_orderpriority) lv
       LEFT JOIN region ON lv.uf = left(r_name, 2)""",
    PLACED_ORDERS,
    """m AS (SELECT sigla_uf AS uf, nome AS municipio, o_orderpriority,
               SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS valor, COUNT(*) AS pedidos
        FROM po GROUP BY ALL)""",
)


@query("rollup_levels", ROLLUP_SQL)
def rollup_levels(t):
    rolled = terr.rollup_levels(
        placed_orders(t),
        "sigla_uf",
        "nome",
        {"valor": F.col("o_totalprice").cast("decimal(18,2)"), "pedidos": F.lit(1)},
        keys=["o_orderpriority"],
        states=states(t),
    )
    return rolled.withColumn("valor", F.col("valor").cast("double"))


@query(
    "level_filter",
    with_places(
        """SELECT id, COUNT(*) AS linhas, CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS saldo
           FROM ex WHERE (estado = 'ASIA' AND municipio = 'Todos') AND CAST(id AS BIGINT) < 99 GROUP BY id""",
        EXPANDED_SQL,
    ),
)
def level_filter(t):
    level = terr.select_level(expanded_customers(t), estado="ASIA")
    return group_sum(numeric_code_filter(level, "id", "<", 99), ["id"], {"saldo": "c_acctbal"}, "linhas")


@query(
    "big_number",
    with_places(
        f"""SELECT {sql_sum(fine_sql("o_totalprice"))} AS valor, COUNT(*) AS linhas, 'pais' AS nivel FROM po
            UNION ALL SELECT {sql_sum(fine_sql("o_totalprice"))}, COUNT(*), 'estado' FROM po WHERE nome_uf = 'EUROPE'
            UNION ALL SELECT {sql_sum(fine_sql("o_totalprice"))}, COUNT(*), 'municipio' FROM po WHERE nome = 'NATION_8'""",
        PLACED_ORDERS,
    ),
)
def big_number(t):
    facts = placed_orders(t).select(fine("o_totalprice").alias("valor"), "id_municipio", "nome", "sigla_uf", "nome_uf")
    chosen = {
        "pais": (terr.ALL, terr.ALL),
        "estado": ("EUROPE", terr.ALL),
        "municipio": ("EUROPE", "NATION_8 - EU"),
    }
    return terr.big_numbers(facts, "valor", chosen, "id_municipio", "nome", "sigla_uf", "nome_uf")


COMPLETE_SQL = with_places(
    """SELECT ter.id, ter.municipio, ter.estado, ter.titulo, COUNT(s_suppkey) AS fornecedores,
              COUNT(*) AS linhas
       FROM ter LEFT JOIN (SELECT s_suppkey, id_municipio AS id FROM s UNION ALL SELECT s_suppkey, id_uf FROM s
                           UNION ALL SELECT s_suppkey, '99' FROM s) x USING (id)
       GROUP BY ALL""",
    "s AS (SELECT * FROM supplier JOIN mun ON s_nationkey = n_nationkey WHERE nome_uf <> 'ASIA')",
)


@query("territory_complete", COMPLETE_SQL)
def territory_complete(t):
    # Suppliers of one state have no code, so its territories stay empty.
    code = F.when(F.col("nome_uf") != "ASIA", F.col("id_municipio")).alias("id_municipio")
    expanded = terr.expand_ids(placed(t.supplier, "s_nationkey", t).select("s_suppkey", code), "id_municipio")
    complete = terr.territory_complete(territory(t), expanded.drop("id_municipio"))
    return complete.groupBy("id", "municipio", "estado", "titulo").agg(
        F.count("s_suppkey").alias("fornecedores"), F.count(F.lit(1)).alias("linhas")
    )


@query(
    "attach_labels",
    with_places(
        "SELECT ux.c_custkey, ux.id, ter.municipio, ter.estado, ter.titulo FROM ux LEFT JOIN ter USING (id)",
        UNRESOLVED_SQL,
    ),
)
def attach_labels(t):
    rows = terr.expand_keep_unresolved(half_resolved(t), "codigo").drop("codigo")
    return terr.attach_labels(territory(t), rows)


@query(
    "territory_year",
    with_places(
        """SELECT ter.*, ano FROM ter
           CROSS JOIN (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS ano FROM orders)"""
    ),
)
def territory_year(t):
    years = t.orders.select(F.year("o_orderdate").alias("ano"))
    return terr.territory_year_spine(territory(t), years, "ano")


@query(
    "map_labels",
    with_places(
        """SELECT CASE WHEN nome_uf = 'EUROPE' THEN 'BR-DF' ELSE nome_uf END AS estado_mapa,
                  nome AS dica_mapa, COUNT(*) AS clientes
           FROM customer JOIN mun ON c_nationkey = n_nationkey GROUP BY 1, 2"""
    ),
)
def map_labels(t):
    rows = terr.map_labels(placed(t.customer, "c_nationkey", t), "nome_uf", "nome", {"EUROPE": "BR-DF"})
    return rows.groupBy("estado_mapa", "dica_mapa").agg(F.count(F.lit(1)).alias("clientes"))


@query(
    "point_coords",
    with_places(
        """SELECT c_custkey, latitude, longitude, coordenada
           FROM customer JOIN mun ON c_nationkey = n_nationkey WHERE c_custkey % 5 <> 0"""
    ),
)
def point_coords(t):
    centroid = F.when(F.col("c_custkey") % 5 != 0, F.col("centroide")).alias("centroide")
    people = placed(t.customer, "c_nationkey", t).select("c_custkey", centroid)
    return terr.point_coordinates(people, "centroide").drop("centroide")


INSTITUTION_SQL = """inst AS (
  SELECT id_municipio AS id_ibge, s_name AS unidade,
         CASE WHEN s_suppkey % 7 = 0 THEN '' WHEN s_suppkey % 7 = 1 OR nome_uf = 'AFRICA' THEN NULL
              ELSE '-' || CAST(s_suppkey % 30 AS VARCHAR) || '.5' END AS latitude,
         '-' || CAST(s_suppkey % 60 AS VARCHAR) || '.25' AS longitude
  FROM supplier JOIN mun ON s_nationkey = n_nationkey),
coord AS (SELECT id_ibge, latitude, longitude, latitude || ',' || longitude AS coordenada FROM (
  SELECT *, row_number() OVER (PARTITION BY id_ibge ORDER BY unidade) AS rn FROM inst WHERE trim(latitude) <> '')
  WHERE rn = 1)"""


def institutions(t):
    key = F.col("s_suppkey")
    latitude = (
        F.when(key % 7 == 0, "")
        .when((key % 7 == 1) | (F.col("nome_uf") == "AFRICA"), F.lit(None))
        .otherwise(F.concat(F.lit("-"), (key % 30).cast("string"), F.lit(",5")))
    )
    longitude = F.concat(F.lit("-"), (key % 60).cast("string"), F.lit(",25"))
    return placed(t.supplier, "s_nationkey", t).select(
        F.col("id_municipio").alias("id_ibge"),
        F.col("s_name").alias("unidade"),
        latitude.alias("latitude"),
        longitude.alias("longitude"),
    )


@query("coord_dedup", with_places("SELECT * FROM coord", INSTITUTION_SQL))
def coord_dedup(t):
    return terr.institution_coordinates(institutions(t))


@query(
    "attach_coords",
    with_places(
        """SELECT c_custkey, id_municipio, latitude, longitude, coordenada FROM (
             SELECT c_custkey, id_municipio FROM customer JOIN mun ON c_nationkey = n_nationkey) c
           LEFT JOIN coord ON id_municipio = id_ibge""",
        INSTITUTION_SQL,
    ),
)
def attach_coords(t):
    people = placed(t.customer, "c_nationkey", t).select("c_custkey", "id_municipio")
    coordinates = terr.institution_coordinates(institutions(t))
    return terr.attach_coordinates(people, coordinates, "id_municipio", "id_ibge", bound=territory(t))


@query(
    "capital_per_state",
    with_places(
        """SELECT id_uf, sigla_uf, nome_uf, nome_regiao, arg_min(nome, id_municipio) AS nome,
                  arg_min(coordenada, id_municipio) AS coordenada
           FROM mun WHERE capital_uf = 1 GROUP BY ALL"""
    ),
)
def capital_per_state(t):
    points = terr.municipality_points(municipalities(t))
    return terr.capital_per_state(points, ["nome", "coordenada"])


ANSWERS_SQL = """ans AS (
  SELECT DISTINCT CASE WHEN nome_uf = 'EUROPE' THEN 'ZZ' WHEN c_custkey % 4 = 0 THEN sigla_uf ELSE id_municipio END AS codigo_acesso,
         CASE WHEN c_acctbal > 0 THEN c_mktsegment END AS estimativa_vaga
  FROM customer JOIN mun ON c_nationkey = n_nationkey)"""


def answers(t):
    """Answers by place; those of one state have a code that no place has."""
    code = (
        F.when(F.col("nome_uf") == "EUROPE", "ZZ")
        .when(F.col("c_custkey") % 4 == 0, F.col("sigla_uf"))
        .otherwise(F.col("id_municipio"))
    )
    return placed(t.customer, "c_nationkey", t).select(
        code.alias("codigo_acesso"), F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).alias("estimativa_vaga")
    )


@query(
    "adhesion_spine",
    with_places(
        """SELECT id_municipio AS cod_ibge, sigla_uf, nome || ' - ' || sigla_uf AS nome, estimativa_vaga,
                  true AS indicador_municipio, false AS indicador_uf
           FROM mun LEFT JOIN ans ON codigo_acesso = id_municipio
           UNION ALL SELECT DISTINCT id_uf, sigla_uf, sigla_uf, estimativa_vaga, false, true
           FROM mun LEFT JOIN ans ON codigo_acesso = sigla_uf""",
        ANSWERS_SQL,
    ),
)
def adhesion_spine(t):
    return terr.adhesion_spine(municipalities(t), answers(t), "codigo_acesso")


@query(
    "or_key_join",
    with_places(
        """SELECT ter.id, c.c_custkey, c.codigo
           FROM (SELECT ter.id, m.sigla_uf FROM ter LEFT JOIN (SELECT DISTINCT id_uf, sigla_uf FROM mun) m
                 ON ter.id = m.id_uf) ter
           LEFT JOIN (SELECT c_custkey, CASE WHEN nome_uf = 'ASIA' THEN ' ZZ' WHEN c_custkey % 3 = 0 THEN ' ' || sigla_uf
                             ELSE id_municipio || ' ' END AS codigo
                      FROM customer JOIN mun ON c_nationkey = n_nationkey) c
           ON ter.id = trim(c.codigo) OR ter.sigla_uf = trim(c.codigo)"""
    ),
)
def or_key_join(t):
    codes = municipalities(t).select(F.col("id_uf").alias("id"), "sigla_uf").distinct()
    left = territory(t).select("id").join(codes, "id", "left")
    code = (
        F.when(F.col("nome_uf") == "ASIA", " ZZ")
        .when(F.col("c_custkey") % 3 == 0, F.concat(F.lit(" "), "sigla_uf"))
        .otherwise(F.concat("id_municipio", F.lit(" ")))
    )
    right = placed(t.customer, "c_nationkey", t).select("c_custkey", code.alias("codigo"))
    return terr.or_key_join(left, right, ["id", "sigla_uf"], "codigo", ["id"]).drop("sigla_uf")


@query(
    "membership_flag",
    """SELECT c_custkey, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)
                              THEN 1 ELSE 0 END AS comprou,
              CASE WHEN c_mktsegment IN ('BUILDING', 'FURNITURE') THEN 1 ELSE 0 END AS casa
       FROM customer""",
)
def membership_flag(t):
    buyers = t.orders.where("o_totalprice > 300000")
    flagged = terr.membership_flag(
        t.customer.select("c_custkey", "c_mktsegment"), "c_custkey", buyers, "comprou", "o_custkey"
    )
    listed = terr.membership_flag(flagged, "c_mktsegment", ["BUILDING", "FURNITURE"], "casa")
    return listed.drop("c_mktsegment")


@query(
    "inherited_flag",
    with_places(
        """SELECT c_custkey, sigla_uf, bool_or(c_acctbal > 9900) OVER (PARTITION BY sigla_uf) AS uf_participa
           FROM customer JOIN mun ON c_nationkey = n_nationkey"""
    ),
)
def inherited_flag(t):
    people = placed(t.customer, "c_nationkey", t).select(
        "c_custkey", "sigla_uf", (F.col("c_acctbal") > 9900).alias("participa")
    )
    flagged = terr.inherited_participation(people, "sigla_uf", "participa", "uf_participa", municipalities(t))
    return flagged.drop("participa")


@query(
    "unmatched_report",
    with_places(
        """SELECT no_municipio, uf, COUNT(*) AS linhas FROM nc
           LEFT JOIN ter ON trim(no_municipio || ' - ' || trim(uf)) = trim(ter.municipio)
           WHERE ter.id IS NULL GROUP BY ALL""",
        NAMED_SQL,
    ),
)
def unmatched_report(t):
    resolved = terr.resolve_by_label(named_customers(t), territory(t), "no_municipio", "uf")
    return terr.unmatched_report(resolved, "id", ["no_municipio", "uf"])
