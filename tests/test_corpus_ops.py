"""Corpus shaping operators on literal fixtures (FIXTURES.md section 3)."""

from pyspark.sql import functions as F

from tessera.operators import corpus as CO
from tessera.operators.common import first_per_key, with_row_id
from tessera.operators.crosswalk import crosswalk

from conftest import rows


def test_crosswalk_first_match_order_repeats_misses(spark):
    df = spark.createDataFrame([(1, ["B", "X", "A", "B"]), (2, None), (3, ["X", "Y"]), (4, [])],
                               "id int, l array<string>")
    dim = spark.createDataFrame([("B", "b1", 1), ("B", "b2", 2), ("A", "a", 3)], "k string, v string, o int")
    out = {r["id"]: (r["xw_list"], r["xw_join"]) for r in crosswalk(df, "l", dim, "k", "v", "o", key="id").collect()}
    assert out[1] == (["b1", "a", "b1"], "b1; a; b1")
    assert out[2] == ([], "")
    assert out[3] == ([], "")
    assert out[4] == ([], "")
    # without a key column the operator tags rows itself
    assert crosswalk(df, "l", dim, "k", "v", "o").count() == 4


def test_split_rows(spark):
    df = spark.createDataFrame([(1, "a; b"), (2, "a"), (3, "a; ; b"), (4, ""), (5, None)], "id int, t string")
    out = CO.split_rows(df, "t")
    counts = {r["id"]: r["n"] for r in out.groupBy("id").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert counts == {1: 2, 2: 1, 3: 3, 4: 1}
    assert sorted(r["t"] for r in out.filter("id = 3").collect()) == ["", "a", "b"]


def test_split_rows_regex_delimiter(spark):
    df = spark.createDataFrame([(1, "a|b.c")], "id int, t string")
    assert sorted(r["t"] for r in CO.split_rows(df, "t", "|").collect()) == ["a", "b.c"]


def test_stack_origins_keeps_null_plain_drops_null_lists(spark):
    df = spark.createDataFrame([("A01", None, "s", "i1; i2", None)],
                               "code string, nome string, nome_curto string, incl string, icd10_description string")
    out = rows(CO.stack_origins(df), "origin", "text")
    assert out == sorted([("icpc2_description", None), ("icpc2_short", "s"),
                          ("icpc2_inclusion", "i1"), ("icpc2_inclusion", "i2")], key=lambda t: (t[0], t[1] or ""))


def test_drop_prefixed_and_accepted(spark):
    df = spark.createDataFrame([("-30",), ("A01",)], "code string")
    assert rows(CO.drop_prefixed(df)) == [("A01",)]
    aug = spark.createDataFrame([("A", "x", "m", True, "c", "p"), ("A", "y", "m", False, "c", "p"),
                                 ("A", "z", "m", None, "c", "p")],
                                "code string, text string, origin string, include boolean, context string, prompt string")
    assert rows(CO.accepted(aug)) == [("A", "x", "m")]


def test_drop_shadowed(spark):
    df = spark.createDataFrame([
        (1, "A01", "t", "icpc2_description"), (2, "A01", "t", "icpc2_short"),       # short dropped
        (3, "A02", "u", "icpc2_short"), (4, "A03", "u", "icpc2_short"),             # both dropped
        (5, "A04", "v", "icpc2_inclusion"), (6, "A05", "v", "icd10_description"),   # both kept
        (7, "A06", None, "icpc2_short"), (8, "A07", None, "icpc2_description"),     # NULL == NULL
        (9, "A08", "w", "icpc2_short"),                                             # unique: kept
    ], "id int, code string, text string, origin string")
    assert sorted(r["id"] for r in CO.drop_shadowed(df).collect()) == [1, 5, 6, 8, 9]


def test_encode_labels(spark):
    df = spark.createDataFrame([("B01", "x"), ("A99", "y"), ("A01", "z"), ("A01", "w")], "code string, text string")
    out, labels = CO.encode_labels(df)
    assert {r["code"]: r["label"] for r in out.collect()} == {"B01": 2, "A99": 1, "A01": 0}
    assert labels.count() == 3


def test_encode_labels_gap_only_in_reference_order(spark):
    df = spark.createDataFrame([("A01", "x"), ("A02", None), ("A03", "z")], "code string, text string")
    dense, _ = CO.encode_labels(df)
    assert sorted(r["label"] for r in dense.collect()) == [0, 1]
    gap, _ = CO.encode_labels(df, reference_order=True)
    assert sorted(r["label"] for r in gap.collect()) == [0, 2]


def test_drop_incomplete_and_canonical(spark):
    df = spark.createDataFrame([("A", "", "icpc2_description"), ("A", "x", "icpc2_description"),
                                ("A", "y", "icpc2_short")], "code string, text string, origin string")
    assert CO.drop_incomplete(df).count() == 2
    assert rows(CO.canonical(CO.drop_incomplete(df))) == [("A", "x")]


def test_first_per_key_and_row_ids(spark):
    df = spark.createDataFrame([("k", 3, "c"), ("k", 1, "a"), ("j", 2, "b")], "k string, o int, v string")
    assert rows(first_per_key(df, "k", "o")) == [("j", 2, "b"), ("k", 1, "a")]
    big = spark.range(0, 1000).withColumn("g", (F.col("id") * 7919) % 1000)
    ids = with_row_id(big, ["g"], partitions=7)
    got = sorted((r["g"], r["row_id"]) for r in ids.collect())
    assert [rid for _, rid in got] == list(range(1000))
