"""A territory on the benchmark tables: regions are states, nations municipalities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicpanel.catalogue.registry import Tables
from civicpanel.operators.territory import build_territory


def municipalities(t: Tables) -> DataFrame:
    """The municipality master table."""
    return t.frame("municipalities", lambda: _municipalities(t))


def _municipalities(t: Tables) -> DataFrame:
    state = F.lpad((F.col("r_regionkey") + 11).cast("string"), 2, "0")
    number = F.col("n_nationkey")
    joined = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.select(
        F.concat(state, F.lpad(number.cast("string"), 5, "0")).alias("id_municipio"),
        number,
        F.col("n_name").alias("nome"),
        state.alias("id_uf"),
        F.left("r_name", F.lit(2)).alias("sigla_uf"),
        F.col("r_name").alias("nome_uf"),
        F.when(F.col("r_regionkey") % 2 == 0, "Par").otherwise("Impar").alias("nome_regiao"),
        F.when(number < 10, 1).otherwise(0).alias("capital_uf"),
        F.concat(
            F.lit("POINT(-"),
            (number + 40).cast("string"),
            F.lit(".25 -"),
            number.cast("string"),
            F.lit(".5)"),
        ).alias("centroide"),
    )


def territory(t: Tables) -> DataFrame:
    return t.frame("territory", lambda: build_territory(municipalities(t)))


def states(t: Tables) -> DataFrame:
    return t.region.select(F.left("r_name", F.lit(2)).alias("sigla"), F.col("r_name").alias("nome"))


def placed(df: DataFrame, nation_key: str, t: Tables) -> DataFrame:
    """Rows with the columns of their municipality."""
    places = municipalities(t)
    return df.join(places, F.col(nation_key) == F.col("n_nationkey")).drop("n_nationkey")


def placed_orders(t: Tables) -> DataFrame:
    """Orders with the municipality of their customer."""
    orders = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return placed(orders, "c_nationkey", t)


MUN = """mun AS (
  SELECT lpad(CAST(r_regionkey + 11 AS VARCHAR), 2, '0')
           || lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS id_municipio,
         n_nationkey, n_name AS nome,
         lpad(CAST(r_regionkey + 11 AS VARCHAR), 2, '0') AS id_uf,
         left(r_name, 2) AS sigla_uf, r_name AS nome_uf,
         CASE WHEN r_regionkey % 2 = 0 THEN 'Par' ELSE 'Impar' END AS nome_regiao,
         CASE WHEN n_nationkey < 10 THEN 1 ELSE 0 END AS capital_uf,
         'POINT(-' || CAST(n_nationkey + 40 AS VARCHAR) || '.25 -'
           || CAST(n_nationkey AS VARCHAR) || '.5)' AS centroide,
         CAST(-n_nationkey - 0.5 AS DOUBLE) AS latitude,
         CAST(-n_nationkey - 40.25 AS DOUBLE) AS longitude,
         '-' || CAST(n_nationkey AS VARCHAR) || '.5,-' || CAST(n_nationkey + 40 AS VARCHAR)
           || '.25' AS coordenada
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

TER = """ter AS (
  SELECT id_municipio AS id, nome || ' - ' || sigla_uf AS municipio, nome_uf AS estado,
         nome || ' - ' || sigla_uf AS titulo FROM mun
  UNION ALL SELECT DISTINCT id_uf, 'Todos', nome_uf, 'Todos' FROM mun
  UNION ALL SELECT '99', 'Todos', 'Todos', 'Todos')"""

PLACED_ORDERS = """po AS (
  SELECT orders.*, customer.*, mun.* EXCLUDE (n_nationkey)
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN mun ON c_nationkey = n_nationkey)"""


def with_places(body: str, *more: str) -> str:
    """``body`` after the territory common table expressions and ``more`` of them."""
    return "WITH " + ",\n".join([MUN, TER, *more]) + "\n" + body
