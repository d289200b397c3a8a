import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from civicpanel.functions import conversion, formatting, geography, text


def column(spark, values, expression, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_brl(spark):
    values = ["R$ 1.234,56", " 1.000 ", "R$-", "", None, "abc", "12,5d", "R$ 7"]
    assert column(spark, values, conversion.brl) == [1234.56, 1000.0, None, None, None, None, None, 7.0]


def test_safe_refuses_java_suffixes_and_trims(spark):
    assert column(spark, ["1d", " 2.5 ", "1e3", "NaN", None], lambda c: conversion.safe(c, "double")) == [
        None, 2.5, 1000.0, None, None,
    ]
    assert column(spark, [" 7 ", "7.0", "x"], lambda c: conversion.safe(c, "int")) == [7, None, None]


def test_strict_names_the_column(spark):
    df = spark.createDataFrame([("1",), ("x",)], "v string")
    with pytest.raises(Exception, match="column v is not int: x"):
        df.select(conversion.strict(F.col("v"), "int", "v")).collect()


def test_bounded_int(spark):
    values = ["9", "10", "90", "91", " 30 ", "x", None]
    assert column(spark, values, lambda c: conversion.bounded_int(c, 10, 90)) == [
        None, 10, 90, None, 30, None, None,
    ]


def test_dates(spark):
    formats = ["dd/MM/yyyy", "yyyy-MM-dd", "yyyy-MM"]
    values = ["31/12/2024", "2024-02-30", "2025-10", "", None]
    assert column(spark, values, lambda c: conversion.first_date(c, formats)) == [
        dt.date(2024, 12, 31), None, dt.date(2025, 10, 1), None, None,
    ]


def test_name_key(spark):
    values = [" Goiânia ", "GOIÂNIA", "goiania"]
    keep = column(spark, values, text.name_key)
    assert keep[0] == keep[1] != keep[2]
    assert column(spark, values, lambda c: text.name_key(c, accent=False)) == ["GOIANIA"] * 3


def test_name_case(spark):
    values = ["SANTA-MARIA DO SUL", "d'oeste", None]
    assert column(spark, values, lambda c: text.name_case(c, "Sem")) == ["Santa-Maria Do Sul", "D'oeste", "Sem"]


def test_state_code(spark):
    values = ["são paulo", "SAO PAULO", " sp ", "zz", "Narnia", None, "PARA", "Pará"]
    assert column(spark, values, text.state_code) == ["SP", "SP", "SP", "ZZ", None, None, "PA", "PA"]


def test_split_part(spark):
    assert column(spark, ["A - B", "A", None], lambda c: text.split_part(c, " - ", 1)) == ["B", None, None]
    df = spark.createDataFrame([("A",)], "v string")
    with pytest.raises(Exception, match="no part 1"):
        df.select(text.split_part(F.col("v"), " - ", 1, strict=True)).collect()


def test_strip_suffix_only_at_the_end(spark):
    assert column(spark, ["12399", "99123", "12399\n"], lambda c: text.strip_suffix(c, "99")) == [
        "123", "99123", "12399\n",
    ]


def test_formats(spark):
    assert column(spark, [1234567, 0, None, -1500], formatting.fmt_int_br, "bigint") == [
        "1.234.567", "0", None, "-1.500",
    ]
    dec = lambda c: formatting.fmt_dec_br(c.cast("decimal(18,3)"), 2)
    assert column(spark, ["0.125", "1234.5", None], dec) == ["0,13", "1234,50", None]
    money = lambda c: formatting.fmt_money_br(c.cast("decimal(20,2)"))
    assert column(spark, ["1500000000", "2500000", "999.5", None], money) == [
        "R$ 1,50 bilhões", "R$ 2,50 milhões", "R$ 1.000", None,
    ]


def test_general_format(spark):
    values = [75.0, 67.36, 0.1, 100.0, 1234567.0, 0.00001, 0.0, None, 14.28125]
    assert column(spark, values, formatting.fmt_general, "double") == [
        "75", "67,36", "0,1", "100", "1,23457e+06", "1e-05", "0", None, "14,2812",
    ]


def test_general_format_at_powers_of_ten_calls_the_formatter_for_exponents_only(spark, frame):
    values = [999999.4, 999999.5, 99999.95, 9.999995, 9.9999949, -0.0001, 9.999994e-5, 9.999995e-5, 1.0000025, 1.0000035, -123456.5]
    assert column(spark, values, formatting.fmt_general, "double") == [
        "999999", "1e+06", "100000", "10", "9,99999", "-0,0001", "9,99999e-05", "0,0001", "1", "1", "-123456",
    ]
    plan = frame([(1.5,)], "v double").select(formatting.fmt_general(F.col("v")).alias("x"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("format_string") == 2


def test_ratio(spark):
    df = spark.createDataFrame([(1, 8), (1, 3), (0, 0), (7075845, 12638396)], "a bigint, b bigint")
    got = [str(r[0]) for r in df.select(formatting.ratio(F.col("a"), F.col("b"), 2)).collect()]
    assert got == ["12.50", "33.33", "None", "55.99"]


def test_point(spark):
    df = spark.createDataFrame([("POINT(-64.30413 -9.15394)",), ("x",), (None,)], "v string")
    got = [tuple(r) for r in df.select(*geography.point_parts(F.col("v"))).collect()]
    assert got == [(-9.15394, -64.30413), (None, None), (None, None)]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.decimals(-9_999_999, 9_999_999, places=2), min_size=1, max_size=40))
def test_money_text_round_trip(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v decimal(18,2)")
    written = F.concat(F.lit("R$ "), F.translate(F.format_number("v", 2), ",.", ".,"))
    back = df.select("v", conversion.brl(written, "decimal(18,2)").alias("b"))
    assert back.where("NOT (v <=> b)").count() == 0
