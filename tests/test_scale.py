"""Plans that must keep their shape on large data."""

import os

import pytest
from pyspark.sql import functions as F

from civicpanel import sizing
from civicpanel.catalogue import QUERIES
from civicpanel.operators import territory as terr
from civicpanel.operators import windows
from tests.oracle import DATA

FOLDER = f"{DATA}/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="benchmark data not present")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def logical(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@needs_data
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cross_product(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    for banned in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert banned not in text


@needs_data
def test_scan_reads_only_its_columns_and_pushes_a_filter(spark):
    text = plan(QUERIES["scan_project"](spark, FOLDER))
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double>" in text
    items = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    text = plan(items.where("l_quantity > 45").select("l_orderkey", "l_extendedprice"))
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_extendedprice:double>" in text
    assert "GreaterThan(l_quantity,45.0)" in text


@needs_data
@pytest.mark.parametrize("name", ["partition_range", "current_term", "prefix_filter"])
def test_filters_reach_the_scan(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    pushed = [part for part in text.split("PushedFilters: ")[1:] if not part.startswith("[]")]
    assert pushed and any(word in pushed[0] for word in ("GreaterThan", "StringStartsWith"))


def test_levels_come_from_one_scan_without_a_shuffle(spark):
    facts = spark.range(10).select(
        F.lit("5208707").alias("c"), F.lit("n").alias("n"), F.lit("GO").alias("u"), F.lit("e").alias("e")
    )
    text = plan(terr.expand_levels(facts, "c", "n", "u", "e"))
    assert "Exchange" not in text and "Union" not in text and text.count("Range") == 1


def test_totals_need_no_single_partition_window(spark):
    df = spark.range(100).withColumn("g", F.col("id") % 7).groupBy("g").agg(F.sum("id").alias("v"))
    text = logical(windows.with_total(df, {"t": F.sum("v")}))
    assert "Window" not in text and "Join" not in text


def test_first_per_key_limits_before_the_shuffle(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 3)
    text = plan(windows.first_per_key(df, ["k"], ["id"]))
    assert text.count("WindowGroupLimit") == 2


def test_broadcast_only_below_the_limit(spark):
    small, large = spark.range(10), spark.range(100_000_000)
    assert "strategy=broadcast" in logical_hints(small)
    assert "strategy=broadcast" not in logical_hints(large)
    assert "strategy=broadcast" in logical_hints(large, bound=small)


def logical_hints(df, bound=None):
    hinted = sizing.small_side(df, bound)
    return hinted._jdf.queryExecution().analyzed().toString()


def test_hot_key_survives_the_person_count(spark):
    """Half of all rows belong to one person; the count is exact and pre-aggregated."""
    df = spark.range(200_000).select(
        F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("p"), (F.col("id") % 5).cast("string").alias("s")
    )
    from civicpanel.operators.aggregate import distinct_by_level

    result = distinct_by_level(df, "p", "s", "n").cache()
    assert result.where("nivel = 'pais'").first().n == 100_001
    assert result.where("nivel = 'estado'").count() == 5
    result.unpersist()


@needs_data
def test_people_are_counted_from_one_scan(spark):
    df = QUERIES["distinct_by_level"](spark, FOLDER)
    df.collect()
    final = plan(df).split("Initial Plan")[0]
    assert final.count("ReusedExchange") >= 1


def test_literal_tables_are_broadcast(spark):
    from civicpanel.sources.literals import literal_table

    table = literal_table(spark, [(1, "a"), (2, None)], "k bigint, v string")
    assert sizing.estimated_bytes(table) < 10_000
    facts = spark.range(100_000_000).withColumnRenamed("id", "k")
    assert "BroadcastHashJoin" in plan(facts.join(table, "k", "left"))
