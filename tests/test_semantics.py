"""NULL and default semantics, hot codes, and request tables as literal cases."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import audit as AU
from tessera.operators import augment as AG
from tessera.operators import balance as BA
from tessera.operators import imbalance as IM
from tessera.operators import metrics as ME
from tessera.operators import split as SP
from tessera.operators.common import not_in

from conftest import rows


def test_a_missing_prediction_is_a_miss_everywhere(spark):
    df = spark.createDataFrame([(0, "a", "a"), (0, "a", None), (1, "b", "c"), (1, "b", "b")],
                               "fold int, label string, prediction string")
    assert ME.cv_mean(df).first()["cv_accuracy"] == 0.5
    assert ME.validate(df, "label", "prediction").first()["accuracy"] == 0.5


def test_rare_share_measures_its_total(spark):
    t = spark.createDataFrame([(c,) for c in "aaabbcdd"], "code string")
    rare = BA.rare_codes(t, 2)
    assert tuple(BA.rare_share(rare, total=t).first()) == (3, -75.0)
    assert tuple(BA.rare_share(rare, total=12).first()) == (3, -25.0)
    assert tuple(BA.rare_share(rare).first()) == (3, -100.0)
    assert BA.rare_share(rare.limit(0), total=t.limit(0)).first()["share_pct"] is None


@pytest.mark.parametrize("large", [False, True])
def test_merging_twice_adds_nothing_with_null_keys(spark, large):
    schema = "code string, text string, n int"
    a = spark.createDataFrame([("x", None, 1), (None, None, 2), ("x", "t", 3)], schema)
    b = spark.createDataFrame([("x", None, 7), (None, None, 8), (None, "t", 9)], schema)
    once = AG.merge_augmentation(a, b, order="n", assume_existing_distinct=large)
    assert sorted(r["n"] for r in once.collect()) == [1, 2, 3, 9]
    twice = AG.merge_augmentation(once, b, order="n", assume_existing_distinct=large)
    assert sorted(r["n"] for r in twice.collect()) == [1, 2, 3, 9]
    assert not_in(b, a, ["code", "text"]).columns == b.columns


def test_synonyms_keep_null_and_empty_texts(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "a b a"), (4, " a ")], "id int, text string")
    d = spark.createDataFrame([("a", "Z")], "word string, synonym string")
    assert rows(IM.replace_synonyms(df, d), "id") == [(1,), (2,), (3,), (4,)]
    got = {r["id"]: r["augmented"] for r in IM.replace_synonyms(df, d).collect()}
    assert got == {1: None, 2: "", 3: "Z b Z", 4: " Z "}


def test_a_hot_code_gets_numbered_prompts(spark):
    """A third of all rows has one code: its names come in parts, in order,
    each once."""
    data = [(i, "H01" if i % 3 == 0 else f"C{i % 90:02d}", f"name {i}", "in", "ex", "cr", "xw") for i in range(3000)]
    df = spark.createDataFrame(data, "row_key int, cod string, nome string, incl string, excl string, crit string, "
                                     "icd10_description string").repartition(7)
    out = AG.build_prompts(df, names_per_prompt=64)
    hot = sorted((r["part"], r["prompt"]) for r in out.filter("code = 'H01'").collect())
    assert [p for p, _ in hot] == list(range(16))
    names = [n for _, p in hot for n in p.split("; in, ")[0].split("; ")]
    assert names == [f"name {i}" for i in range(0, 3000, 3)]
    assert all(p.endswith("xw; Critérios: cr. Exclui: ex") for _, p in hot)


def test_undersample_and_oversample_of_a_hot_class(spark):
    data = [(i, "hot" if i % 3 else f"c{i % 50}") for i in range(3000)]
    df = spark.createDataFrame(data, "id int, label string").repartition(5)
    kept = BA.undersample(df, 4)
    assert kept.groupBy("label").count().agg(F.max("count")).first()[0] == 4
    import hashlib
    want = sorted((hashlib.md5(f"{i}:42".encode()).hexdigest(), i) for i, c in data if c == "hot")[:4]
    assert {r["id"] for r in kept.filter("label = 'hot'").collect()} == {i for _, i in want}
    tiny = spark.createDataFrame([(1, "one")] + [(i, "many") for i in range(2, 900)], "id int, label string")
    out = BA.oversample(tiny, copies_per_task=100)
    assert sorted(r["copy"] for r in out.filter("label = 'one'").collect()) == list(range(1, 899))
    assert out.count() == 898 * 2
    assert BA.oversample(tiny.limit(0)).count() == 0


def test_split_thresholds_cover_the_whole_range(spark):
    df = spark.range(2000).withColumnRenamed("id", "doc")
    for frac, want in ((1.0, {"test"}), (0.0, {"train"}), (0.5, {"test", "train"})):
        assert {r["split"] for r in SP.random_split(df, "doc", frac).select("split").distinct().collect()} == want


def test_split_keeps_other_columns(spark):
    df = spark.createDataFrame([(i, "ab"[i % 2], f"text {i}") for i in range(40)], "id int, label string, text string")
    out = SP.stratified_split(df)
    assert out.columns == ["id", "label", "text", "split"]
    assert {(r["id"], r["text"]) for r in out.collect()} == {(i, f"text {i}") for i in range(40)}
    assert out.filter("split = 'test'").count() == 8
    assert SP.kfold(df, 3).groupBy("fold").count().agg(F.min("count")).first()[0] == 13


def test_thresholds_equal_a_plain_count(spark):
    rnd = random.Random(4)
    data = [(i, rnd.randint(0, 2), c, round(rnd.random(), 3)) for i in range(200) for c in range(3)]
    df = spark.createDataFrame(data, "id int, label int, class int, score double")
    got = {r["class"]: (r["threshold"], round(r["f1"], 9)) for r in IM.tune_thresholds(df).collect()}
    for c in range(3):
        best = None
        for t in IM.DEFAULT_THRESHOLDS:
            tp = sum(s >= t and y == c for _, y, k, s in data if k == c)
            fp = sum(s >= t and y != c for _, y, k, s in data if k == c)
            fn = sum(s < t and y == c for _, y, k, s in data if k == c)
            f1 = 2 * tp / (2 * tp + fp + fn) if tp + fp + fn else 0.0
            if best is None or f1 > best[1] + 1e-12:
                best = (t, f1)
        assert got[c] == (best[0], round(best[1], 9))


def test_selector_table_equals_single_requests(spark):
    t = spark.createDataFrame([(i, f"{c}{i % 4:02d}", c) for i, c in enumerate("AABBBCCAAB")],
                              "id int, code string, chapter string")
    req = [(1, "a, b01"), (2, "zz"), (3, ""), (4, "b B01 b"), (5, "C02")]
    got = AU.apply_selector_table(t, spark.createDataFrame(req, "selector_id int, text string"), t)
    for i, text in req:
        assert rows(got.filter(F.col("selector_id") == i).drop("selector_id")) == rows(AU.apply_selectors(t, text, t))


def test_compare_runs_with_null_keys_and_order(spark):
    a = spark.createDataFrame([(1, "x", "t"), (2, "y", None), (3, "z", "u")], "pos int, code string, text string")
    b = spark.createDataFrame([(1, "x", "t"), (2, "y", None), (3, "z", "v")], "pos int, code string, text string")
    r = ME.compare_runs(a, b, ("code", "text"), "pos").first()
    assert (r["n_both"], r["n_only_a"], r["n_only_b"], r["identical"]) == (1, 2, 2, False)
    assert ME.compare_runs(a, a, ("code", "text"), "pos").first()["identical"]
