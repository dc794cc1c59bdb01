"""TXT1-TXT10, NUM1, TOP1 on literal fixtures (FIXTURES.md section 3)."""

import math

from pyspark.sql import functions as F

from tessera.functions import text as TX
from tessera.functions.arrays import softmax, topk_array, with_softmax


def one(spark, expr, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("y")).first()["y"]


def test_parse_code_list(spark):
    assert one(spark, TX.parse_code_list("x"), "H54.0; H54.1; H54.2") == ["H540", "H541", "H542"]
    assert one(spark, TX.parse_code_list("x"), None) is None
    assert one(spark, TX.parse_code_list("x"), "") == []
    assert one(spark, TX.parse_code_list("x"), " A1 ;;B2. ") == ["A1", "B2"]


def test_join_list(spark):
    assert one(spark, TX.join_list(F.array(F.lit("a"), F.lit("b"))), "z") == "a; b"
    assert one(spark, TX.join_list(F.array().cast("array<string>")), "z") == ""


def test_clean_description(spark):
    assert one(spark, TX.clean_description("x"), "ver T90 ; K86") == "ver ; "
    assert one(spark, TX.clean_description("x"), None) == ""
    assert one(spark, TX.clean_description("x"), "a ; se o doente tem a doença, codifique-a") == "a"
    # Unicode word boundary: an accented letter before the code is a word char
    assert one(spark, TX.clean_description("x"), "éA10 B20") == "éA10 "


def test_expand_abbreviations(spark):
    f = TX.expand_abbreviations("x")
    assert one(spark, f, "Dor torácica NE") == "Dor torácica não especificada"
    assert one(spark, f, "Limitação funcional/incapacidade (B)") == \
        "Limitação funcional/incapacidade por Sangue, órgãos hematopoiéticos e linfáticos"
    assert one(spark, f, "NEOPLASIA") == "não especificadaOPLASIA"
    assert one(spark, f, "x (A)") == "x (A)"


def test_parse_generated_list(spark):
    assert sorted(one(spark, TX.parse_generated_list("x"), "a; b; a.")) == ["a", "b"]
    assert one(spark, TX.parse_generated_list("x"), "a..") == ["a."]
    assert one(spark, TX.strip_final_dot("x"), "a.\n") == "a.\n"


def test_search_text_and_misc(spark):
    df = spark.createDataFrame([("A01", "name", None, "d1; d2")], "c string, n string, i string, x string")
    assert df.select(TX.search_text("c", "n", "i", "x")).first()[0] == "A01 name  d1; d2"
    df2 = spark.createDataFrame([("A01", None, "i", "x")], "c string, n string, i string, x string")
    assert df2.select(TX.search_text("c", "n", "i", "x")).first()[0] is None
    assert one(spark, TX.rewrite_dash("x"), "-3-0") == "A3A0"
    assert one(spark, TX.rewrite_dash("x", anchored=True), "-3-0") == "A3-0"
    assert one(spark, TX.short_name("x"), "org/project/model:v3") == "model:v3"
    assert one(spark, TX.chapter("x"), "K86") == "K"


def test_softmax_and_topk(spark):
    df = spark.createDataFrame([([0.1, 0.7, 0.7, 0.2],)], "s array<double>")
    top = df.select(topk_array("s", 2, apply_softmax=False).alias("t")).first()["t"]
    assert [r["label"] for r in top] == [1, 2]  # tie -> lowest label
    probs = df.select(softmax("s").alias("p")).first()["p"]
    assert abs(sum(probs) - 1.0) < 1e-12
    ex = [math.exp(x) for x in [0.1, 0.7, 0.7, 0.2]]
    assert abs(probs[1] - ex[1] / sum(ex)) < 1e-12
    p2 = with_softmax(df, "s", "p").first()["p"]
    assert all(abs(a - b) < 1e-12 for a, b in zip(p2, probs))
    top_sm = df.select(topk_array("s", 2).alias("t")).first()["t"]
    assert abs(top_sm[0]["value"] - ex[1] / sum(ex)) < 1e-12
    big = spark.createDataFrame([([1000.0, 1001.0],)], "s array<double>")
    assert abs(big.select(softmax("s")).first()[0][1] - 1 / (1 + math.exp(-1))) < 1e-12
