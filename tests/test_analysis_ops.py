"""Selectors, augmentation, balance, splits, metrics (FIXTURES.md section 3)."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import audit as AU
from tessera.operators import augment as AG
from tessera.operators import balance as BA
from tessera.operators import labels as LB
from tessera.operators import metrics as ME
from tessera.operators import split as SP
from tessera.operators.topk import topk_long, topk_per_key, topk_wide

from conftest import rows

AUG_SCHEMA = "code string, text string, origin string, include boolean, context string, prompt string"


@pytest.fixture(scope="module")
def corpus(spark):
    data = [(1, "K86", "Hipertensão", "K"), (2, "K87", "Hipertensão com", "K"), (3, "D01", "Dor", "D"),
            (4, "T90", "Diabetes Mellitus", "T"), (5, "A01", "Dor geral", "A")]
    return spark.createDataFrame(data, "id int, code string, text string, chapter string")


@pytest.mark.parametrize("selector,expected", [
    ("K, D", [1, 2, 3]),
    ("t90 a01", [4, 5]),
    ("K,T90", [1, 2, 4]),
    ("KK", [1, 2, 3, 4, 5]),
    ("QQ9", [1, 2, 3, 4, 5]),
    ("K K86", [1, 2]),     # chapter and code overlap: each row once
    ("", [1, 2, 3, 4, 5]),
])
def test_apply_selectors(spark, corpus, selector, expected):
    assert sorted(r["id"] for r in AU.apply_selectors(corpus, selector, corpus).collect()) == expected


def test_audit_regex_case_insensitive(spark, corpus):
    assert [r["id"] for r in AU.audit(corpus, text="diabetes").collect()] == [4]
    assert sorted(r["id"] for r in AU.audit(corpus, text="^dor", chapters=["A", "D"]).collect()) == [3, 5]
    assert [r["id"] for r in AU.audit(corpus, text="MELLITUS", literal=True).collect()] == [4]
    assert AU.audit(corpus, chapters=[]).count() == 5


def test_existing_and_with_flag(spark, corpus):
    vals = spark.createDataFrame([("chapter", "K"), ("chapter", "Z"), ("code", "T90"), ("code", "K"),
                                  ("code", "X99")], "kind string, value string")
    assert rows(AU.existing(vals, corpus)) == [("chapter", "K"), ("code", "T90")]
    right = spark.createDataFrame([("K86",), ("K86",), ("ZZZ",)], "code string")
    flagged = AU.with_flag(corpus.select("code"), right, "code", "hit")
    assert flagged.count() == 5 and flagged.filter("hit").count() == 1


def test_cards_first_row(spark):
    cs = spark.createDataFrame([("A01", 2, "n2", None), ("A01", 1, "n1", None), ("B01", 3, "m", "i")],
                               "cod string, row_key int, nome string, incl string")
    want = spark.createDataFrame([("A01",)], "code string")
    assert rows(AU.cards(cs, want)) == [("A01", "n1", None)]


def test_merge_augmentation_existing_wins_and_idempotent(spark):
    existing = spark.createDataFrame([("A01", "x", "m", False, "c", "p")], AUG_SCHEMA)
    new = spark.createDataFrame([("A01", "x", "m", True, "c", "p"), ("A01", "y", "m", True, "c", "p")], AUG_SCHEMA)
    m1 = AG.merge_augmentation(existing, new)
    assert rows(m1, "code", "text", "include") == [("A01", "x", False), ("A01", "y", True)]
    m2 = AG.merge_augmentation(m1, new)
    assert rows(m2) == rows(m1)
    fast = AG.merge_augmentation(existing, new, assume_existing_distinct=True)
    assert rows(fast) == rows(m1)


def test_build_prompts(spark):
    cs = spark.createDataFrame([("A01", 1, "L", "i", "e", "c", "d"), ("B01", 2, "M (K)", None, "", None, "")],
                               "cod string, row_key int, nome string, incl string, excl string, crit string, "
                               "icd10_description string")
    out = {r["code"]: r["prompt"] for r in AG.build_prompts(cs).collect()}
    assert out["A01"] == "L; i, , d; Critérios: c. Exclui: e"
    assert out["B01"] == "M por sistema cardiovascular e aparelho circulatório"


def test_parse_generated(spark):
    gen = spark.createDataFrame([("A01", "a; b; a.", "gen", "ctx", "p")],
                                "code string, response string, model string, context string, prompt string")
    out = AG.parse_generated(gen)
    assert rows(out, "text") == [("a",), ("b",)]
    assert out.filter("include AND origin = 'gen'").count() == 2


def test_augmentation_stats_golden_shape(spark):
    data = [("K01", f"t{i}", "gen", i < 11, "c", "p") for i in range(25)]
    s = BA.augmentation_stats(spark.createDataFrame(data, AUG_SCHEMA), 3).first()
    assert (s["n_codes"], s["n_rows"], s["n_accepted"], s["accepted_pct"], s["rows_per_code"]) == (1, 25, 11, 44.0, 25.0)
    assert s["augmented_share_pct"] == 25.0


def test_augmentation_stats_empty_is_null(spark):
    s = BA.augmentation_stats(spark.createDataFrame([], AUG_SCHEMA), 0).first()
    assert s["n_rows"] == 0 and s["accepted_pct"] is None and s["rows_per_code"] is None


def test_class_weights_and_counts(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,)], "label int")
    assert rows(BA.class_weights(df)) == [(0, 0.25), (1, 0.75)]
    assert rows(BA.with_class_count(df, "label")) == [(0, 3), (0, 3), (0, 3), (1, 1)]
    assert rows(BA.rare_codes(df, 1, "label")) == [(1, 1)]
    over = BA.oversample(df.withColumn("id", F.monotonically_increasing_id()), "label")
    assert over.groupBy("label").count().orderBy("label").collect()[1]["count"] == 3


def test_stratified_split_and_kfold(spark):
    df = spark.createDataFrame([(i, 0) for i in range(10)] + [(100, 1)], "id long, label int")
    s = SP.stratified_split(df)
    got = {(r["label"], r["split"]): r["n"] for r in s.groupBy("label", "split").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {(0, "test"): 2, (0, "train"): 8, (1, "train"): 1}
    f = SP.kfold(df, 5)
    assert sorted(r["n"] for r in f.groupBy("fold").agg(F.count(F.lit(1)).alias("n")).collect()) == [2, 2, 2, 2, 3]
    r = SP.random_split(spark.range(2000), "id", 0.2)
    n_test = r.filter("split = 'test'").count()
    assert 300 < n_test < 500


def test_undersample_cap(spark):
    df = spark.createDataFrame([(i, i % 2) for i in range(20)], "id long, label int")
    out = BA.undersample(df, 3)
    assert sorted(r["n"] for r in out.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()) == [3, 3]


def test_attach_labels_and_lookup_last(spark):
    labels = spark.createDataFrame([(0, "A01", "a"), (1, "B01", "b")], "label int, code string, text string")
    pred = spark.createDataFrame([(0,), (999,)], "label int")
    assert LB.attach_labels(pred, labels, "inner").count() == 1
    left = rows(LB.attach_labels(pred, labels, "left"), "label", "code")
    assert left == [(0, "A01"), (999, None)]
    dim = spark.createDataFrame([("A", "x", 1), ("A", "y", 2)], "k string, v string, o int")
    keys = spark.createDataFrame([("A",)], "k string")
    assert LB.lookup_last(keys, dim, "k", "v", "o").first()["v"] == "y"


def test_merge_predictions_fanout(spark):
    corpus = spark.createDataFrame([(1, "t"), (2, "t")], "id int, text string")
    pred = spark.createDataFrame([("t", "A01"), ("t", "A01")], "input string, top_prediction string")
    assert ME.merge_predictions(corpus, pred).count() == 2
    assert ME.merge_predictions(corpus, pred, dedupe_inputs=False).count() == 4
    assert ME.merge_predictions(corpus, pred, how="left").count() == 2


def test_compare_runs(spark):
    a = spark.createDataFrame([("K73",), ("K90",)], "code string")
    b = spark.createDataFrame([("K73",), ("K84",)], "code string")
    r = ME.compare_runs(a, b).first()
    assert (r["n_both"], r["n_only_a"], r["n_only_b"], r["identical"]) == (1, 1, 1, False)
    assert abs(r["jaccard"] - 1 / 3) < 1e-12
    assert ME.compare_runs(a, a).first()["identical"] is True
    # same set, different order -> not identical; different lengths -> not identical
    oa = spark.createDataFrame([("K73", 1), ("K90", 2)], "code string, pos int")
    ob = spark.createDataFrame([("K90", 1), ("K73", 2)], "code string, pos int")
    r2 = ME.compare_runs(oa, ob, order="pos").first()
    assert (r2["n_both"], r2["jaccard"], r2["identical"]) == (2, 1.0, False)
    oc = spark.createDataFrame([("K73", 1), ("K90", 2), ("K90", 3)], "code string, pos int")
    assert ME.compare_runs(oa, oc, order="pos").first()["identical"] is False
    assert ME.compare_runs(oa, oa.withColumn("pos", F.col("pos") * 10), order="pos").first()["identical"] is True


def test_classification_report_micro_equals_accuracy(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (2, 1), (2, 2)], "label int, prediction int")
    macro = ME.classification_report(df).first()
    micro = ME.classification_report(df, average="micro").first()
    assert abs(micro["f1_score"] - macro["accuracy"]) < 1e-12 and abs(macro["accuracy"] - 0.6) < 1e-12
    # class 1: tp 1, fp 2, fn 0 -> p 1/3, r 1; class 0: p 1, r .5; class 2: p 1, r .5
    assert abs(macro["precision"] - (1 + 1 / 3 + 1) / 3) < 1e-12
    v = ME.validate(spark.createDataFrame([("A", "A"), ("A", "B")], "code string, top_prediction string")).first()
    assert (v["accuracy"], v["n_correct"], v["n_rows"]) == (0.5, 1, 2)


def test_multilabel_metrics(spark):
    truth = spark.createDataFrame([(1, "a"), (1, "b"), (2, None)], "id int, label string")
    pred = spark.createDataFrame([(1, "a"), (2, "b")], "id int, label string")
    m = ME.multilabel_metrics(truth, pred, n_labels=2).first()
    assert m["subset_accuracy"] == 0.0
    assert abs(m["hamming_loss"] - 2 / 4) < 1e-12
    assert abs(m["micro_f1"] - 2 / 4) < 1e-12


def test_topk_per_key_and_wide_long(spark):
    df = spark.createDataFrame([("q", i, float(i % 4)) for i in range(40)], "k string, item int, s double")
    top = topk_per_key(df, "k", "s", 3, "item", salts=4).orderBy("rank").collect()
    assert [r["item"] for r in top] == [3, 7, 11]
    nested = spark.createDataFrame([("x", [(1, 5, "C", "c", 0.9)])],
                                   "input string, prediction array<struct<rank:int,label:int,code:string,"
                                   "text:string,value:double>>")
    w = topk_wide(nested, 2).first()
    assert w["prediction_1_code"] == "C" and w["prediction_2_code"] is None
    assert topk_long(nested).first()["code"] == "C"


def test_score_with_foreign_model_hook(spark):
    import numpy as np

    from tessera.operators.model import score_with

    def fn(texts):  # toy scorer: class i score = count of letter 'abc'[i]
        return np.array([[t.count(c) for c in "abc"] for t in texts], dtype=float)

    df = spark.createDataFrame([("aab",), ("ccc",)], "text string")
    labels = spark.createDataFrame([(0, "A", "a"), (1, "B", "b"), (2, "C", "c")], "label int, code string, text string")
    out = {r["input"]: r["prediction"] for r in score_with(df, fn, 3, k=2, labels=labels).collect()}
    assert [p["code"] for p in out["aab"]] == ["A", "B"]
    e3 = np.exp(3.0)
    assert [p["code"] for p in out["ccc"]] == ["C", "A"]  # A/B tie -> lowest label
    assert abs(out["ccc"][0]["value"] - e3 / (2 + e3)) < 1e-12
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")


def test_attach_prediction_labels_duplicate_inputs(spark):
    from tessera.operators.topk import attach_prediction_labels
    schema = "input string, prediction array<struct<rank:int,label:int,value:double>>"
    df = spark.createDataFrame([("t", [(1, 0, 0.9), (2, 1, 0.1)]), ("t", [(1, 1, 0.6), (2, 0, 0.4)]), ("u", [])],
                               schema)
    labels = spark.createDataFrame([(0, "A", "a"), (1, "B", "b")], "label int, code string, text string")
    out = attach_prediction_labels(df, labels).collect()
    assert len(out) == 3
    got = sorted(tuple(p["code"] for p in r["prediction"]) for r in out)
    assert got == [(), ("A", "B"), ("B", "A")]


def test_replace_synonyms_whole_text_and_partitioned_input(spark):
    from tessera.operators.imbalance import replace_synonyms
    docs = spark.createDataFrame([(1, "the cat sat on the mat"), (2, "a  dog"), (3, "")], "id long, text string")
    dic = spark.createDataFrame([("cat", "feline", 2), ("cat", "kitty", 1), ("the", "THE", 1)],
                                "word string, synonym string, o int")
    want = [(1, "THE kitty sat on THE mat"), (2, "a  dog"), (3, "")]
    assert rows(replace_synonyms(docs, dic, order="o")) == want
    # an input already hash-partitioned on the key: same rows, and with the
    # dictionary broadcast after its size check, no exchange but that one
    # (tokens are never shuffled by token)
    pre = docs.repartition(4, "id")
    spark.conf.set("tessera.broadcast.mode", "checked")
    try:
        out = replace_synonyms(pre, dic, order="o", partitioned=True)
        assert rows(out) == want
        final = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("tessera.broadcast.mode")
    assert final.count("Exchange hashpartitioning(id") == 1
    assert "Exchange hashpartitioning(_tok" not in final
