"""What must not grow with pairs or tokens: vectors' buckets, word counts,
dictionary look-ups, joins of two growing tables, code points of long texts,
a forest's rows."""

import random

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from conftest import rows

from tessera.llm import langid
from tessera.operators import balance as BA
from tessera.operators import bayes as NB
from tessera.operators import forest
from tessera.operators import imbalance as IM
from tessera.operators import metrics as ME
from tessera.operators import model as MO
from tessera.operators import vector as VC
from tessera.plans import catalog


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_lsh_moves_vectors_and_no_pairs(spark, monkeypatch):
    """A hot bucket (copies) and a repeated id: all pairs that share a key, and
    neither they nor the keys in a join."""
    rnd = np.random.default_rng(5)
    some = [(i, rnd.normal(size=6).tolist()) for i in range(60)] + [(100 + i, [1.0] * 6) for i in range(40)]
    some += [(7, rnd.normal(size=6).tolist()), (8, [1.0, 2.0]), (9, None)]
    df = spark.createDataFrame(some, "vec_id long, embedding array<double>")
    keys = VC.lsh_keys(df, "vec_id", "embedding", 3, 4, None)
    held = [(r["id"], set(r["keys"])) for r in keys.collect()]
    want = sorted({(q, i) for q, a in held for i, b in held if a & b})
    for name, n in (("CELL_QUERIES", 16), ("CELL_ITEMS", 32), ("PAIRS", 50)):
        monkeypatch.setattr(VC, name, n)
    found = VC.lsh_candidates(keys, keys)
    assert rows(found) == want
    assert "Join" not in _plan(found)
    top = VC.vector_topk_lsh(df, df, 3, num_tables=3, hashes=4, exclude_self=True)
    assert {(r["query_id"], r["item_id"]) for r in top.collect()} <= set(want)
    assert "Join" not in _plan(top)
    near = [r for r in top.collect() if r["query_id"] == 139]
    assert [r["item_id"] for r in sorted(near, key=lambda r: r["rank"])] == [100, 101, 102]


def _moved(df):
    """Bytes that all exchanges of a plan wrote."""
    df.collect()
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        p = todo.pop()
        if p.nodeName().startswith("AdaptiveSparkPlan"):
            todo.append(p.executedPlan())
        elif "QueryStage" in p.nodeName():
            todo.append(p.plan())
        else:
            total += p.metrics().apply("dataSize").value() if p.nodeName() == "Exchange" else 0
            todo += [p.children().apply(i) for i in range(p.children().size())]
    return total


def test_narrow_lsh_keys_move_bytes_with_the_rows(spark, monkeypatch):
    """Four times the rows: not sixteen times the bytes."""
    for name, n in (("CELL_QUERIES", 16), ("CELL_ITEMS", 32), ("BUCKET_ROWS", 64), ("BUCKET_PAIR_ROWS", 64)):
        monkeypatch.setattr(VC, name, n, raising=False)
    rnd, moved = np.random.default_rng(3), []
    for n in (200, 800):
        df = spark.createDataFrame([(i, rnd.normal(size=8).tolist()) for i in range(n)], "vec_id long, embedding array<float>")
        keys = VC.lsh_keys(df, "vec_id", "embedding", 3, 6, 0.25)
        moved.append((_moved(VC.vector_topk_lsh(df, df, 3, num_tables=3, hashes=6, bucket_length=0.25)),
                      _moved(VC.lsh_candidates(keys, keys))))
    for few, many in zip(*moved):
        assert 0 < many < 6 * few


@pytest.mark.parametrize("step, ids", [(0.25, 150), (None, 4)])
def test_lsh_by_buckets_gives_the_rows_of_the_grid(spark, monkeypatch, step, ids):
    """Repeated ids with other vectors, hot buckets, two lengths, zero, empty and NULL
    vectors, NULL components and ids."""
    rnd = np.random.default_rng(8)

    def odd(n):
        out, hot = [], rnd.normal(size=6)
        for j in range(n):
            v = (hot if j % 5 == 0 else rnd.normal(size=6) if j % 3 else hot + rnd.normal(size=6) / 20).tolist()
            v = {7: v[:4], 23: [0.0] * 6, 41: [], 53: None, 67: [None, *v[1:]]}.get(j % 79, v)
            out.append((None if j % 37 == 0 else int(rnd.integers(ids)), v))
        return spark.createDataFrame(out, "vec_id long, embedding array<float>")
    items, queries, found = odd(240), odd(120), []
    for name, n in (("BUCKET_ROWS", 40), ("BUCKET_PAIR_ROWS", 40), ("PAIRS", 300), ("SCORE_CELLS", 900)):
        monkeypatch.setattr(VC, name, n)
    for buckets in (False, True):
        monkeypatch.setattr(VC, "_by_buckets", lambda *_: buckets)
        keys = [VC.lsh_keys(x, "vec_id", "embedding", 4, 5, step) for x in (items, queries)]
        top = VC.vector_topk_lsh(items, queries, 4, num_tables=4, hashes=5, bucket_length=step, exclude_self=step is None)
        found.append((sorted(map(str, top.collect())), rows(VC.lsh_candidates(*keys))))
    assert all(found[0]) and found[0] == found[1]


def test_words_are_counted_without_a_shuffle(spark, monkeypatch):
    docs = [(1, "a", 0, "b a b"), (2, "b", 1, None), (3, "a", 1, "..."), (1, "a", 0, "a c"), (4, "b", 0, "Z z")]
    df = spark.createDataFrame(docs, "doc_id long, label string, fold int, text string")
    written = {}
    real = NB.cut
    monkeypatch.setattr(NB, "cut", lambda d, name: (written.__setitem__(name, d), real(d, name))[1])
    s = NB.statistics(df, 2)
    assert "Exchange" not in written["nb-terms"]._jdf.queryExecution().executedPlan().toString()
    sums = s.terms.groupBy("id", "term").agg(F.sum("n").alias("n"))
    assert rows(sums) == [(1, "a", 2), (1, "b", 2), (1, "c", 1), (4, "z", 2)]
    assert rows(s.rows) == [(1, "a", 0), (2, "b", 1), (3, "a", 1), (4, "b", 0)]


def test_synonyms_are_looked_up_within_a_text(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a b"), (1, "c a"), (2, None), (None, "b"), (3, "")], "id long, text string")
    d = spark.createDataFrame([("a", "Z"), ("b", None), ("", "E"), (None, "N")], "word string, synonym string")
    want = sorted([(1, "Z c Z b"), (2, None), (3, "E"), (None, "b")], key=str)
    out = IM.replace_synonyms(docs, d)
    plan = _plan(out)
    assert sorted(map(tuple, out.collect()), key=str) == want
    assert "posexplode" not in plan and "Join" not in plan
    monkeypatch.setattr(IM, "DICTIONARY_WORDS", 0)  # a dictionary too large to broadcast
    assert sorted(map(tuple, IM.replace_synonyms(docs, d).collect()), key=str) == want


def test_predictions_are_not_broadcast(spark):
    corpus = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "id long, text string")
    pred = spark.createDataFrame([("x", "A"), ("x", "A"), ("z", "B")], "input string, top_prediction string")
    out = ME.merge_predictions(corpus, pred, "left")
    assert sorted(map(tuple, out.collect())) == [(1, "x", "A"), (2, "y", None), (3, None, None)]
    # the side of the main join comes sorted; only the bounded table of hot keys is broadcast
    assert "SortMergeJoin" in _plan(out)


def test_a_model_from_counted_terms_is_the_model_of_the_texts(spark):
    rnd = random.Random(3)
    docs = [(i, " ".join(rnd.choices(["one", "two", "three"] if i % 2 else ["uno", "due", "three"], k=9)), i % 2, "train" if i % 3 else "test")
            for i in range(60)]
    df = spark.createDataFrame(docs, "id long, text string, label int, split string")
    counted = MO.term_frequencies(df, [MO.NUM_FEATURES], keep=("label", "split"))
    assert "text" not in counted.columns
    a = MO.evaluate(MO.train_classifier(df, "label"), df, "label")
    b = MO.evaluate(MO.train_classifier(counted, "label", counted=True), counted, "label")
    assert rows(a) == rows(b)


def test_language_of_long_texts_in_groups(monkeypatch):
    """Code points are held for few long texts at a time, with the same result."""
    rnd = np.random.default_rng(1)
    model = langid.Model(["aa", "bb"], np.log(rnd.random((langid.BUCKETS, 2)).astype(np.float32)))
    texts = ["abc def", None, "x" * 500, "", "123", "hello there " * 30, "zz"]
    want, most = model.predict(texts), []
    assert langid.Model([]).predict(texts) == (["und"] * 7, [0.0] * 7) and model.predict([]) == ([], [])
    real = langid.Model._predict
    monkeypatch.setattr(langid, "GROUP", 100)
    monkeypatch.setattr(langid.Model, "_predict", lambda m, t: (most.append(len(t)), real(m, t))[1])
    assert model.predict(texts) == want and len(most) > 2


def _forest_rows(spark):
    """Sparse and dense vectors, zeros, negative numbers, columns of more values than bins."""
    rnd, out = random.Random(5), []
    for i in range(400):
        y = rnd.choice([0, 0, 0, 1, 2])
        v = {rnd.randrange(40): float(rnd.choice([0, 1, 1, 2, 3, -1])) for _ in range(6)}
        if rnd.random() < 0.6:
            v[y * 3 + 1] = float(rnd.randint(1, 60))
        vector = Vectors.sparse(40, v)
        out.append((i, float(y), 0.3 + 0.2 * y, vector if i % 3 else Vectors.dense(vector.toArray())))
    return spark.createDataFrame(out, ["id", "label", "weight", "features"])


def _forest_votes(model, df):
    p = model.transform(df).select("id", "prediction", vector_to_array("probability").alias("p"))
    return {r["id"]: (r["prediction"], *[round(x, 9) for x in r["p"]]) for r in p.collect()}


@pytest.mark.parametrize("kind", ["gini", "entropy"])
def test_a_forest_over_sparse_rows_without_draws_is_sparks(spark, kind):
    df = _forest_rows(spark)
    params = dict(numTrees=1, maxDepth=5, impurity=kind, minInstancesPerNode=3, featureSubsetStrategy="all", bootstrap=False)
    a = MO.classifier("rf_dense", "label", "weight", **params).fit(df)
    b = MO.classifier("rf", "label", "weight", **params).fit(df)
    assert type(a) is not type(b) and a.trees[0].depth == b.trees[0].depth == 5
    assert _forest_votes(a, df) == _forest_votes(b, df)


def test_a_forest_does_not_depend_on_how_its_table_is_stored(spark, monkeypatch):
    df = _forest_rows(spark)
    fit = lambda t: MO.classifier("rf", "label", "weight", numTrees=6, maxDepth=4, keyCol="id").fit(t)
    model = fit(df.repartition(1))
    want = _forest_votes(model, df)
    assert model.getNumTrees == 6 and max(t.depth for t in model.trees) <= 4
    assert len({tuple(t.column) for t in model.trees}) == 6  # trees differ in rows and columns
    assert sum(want[r["id"]][0] == r["label"] for r in df.collect()) > 280
    monkeypatch.setattr(forest, "ROWS", 7)
    monkeypatch.setattr(forest, "HELD", 50)
    assert _forest_votes(fit(df.repartition(5, "id")), df) == want


def test_rows_are_drawn_by_poissons_law():
    key = np.random.default_rng(1).integers(-2 ** 63, 2 ** 63, 200_000)
    a, b = forest.draws(key, 0, 1.0), forest.draws(key, 1, 1.0)
    assert abs((a == 0).mean() - np.exp(-1)) < 0.005 and abs(a.mean() - 1) < 0.01 and abs(a.var() - 1) < 0.02
    assert abs(np.corrcoef(a, b)[0, 1]) < 0.01


def test_the_registered_forest_makes_no_row_as_wide_as_its_columns(spark, tmp_path):
    docs = [(i, None if i == 7 else ("the a one two three" if i % 3 else "le la un deux trois"), "en" if i % 3 else "fr")
            for i in range(90)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    model, split, _ = catalog._weighted_forest(spark, str(tmp_path))
    assert isinstance(model.stages[-1], forest.SparseForestModel) and len(model.stages[-1]._points.number) == MO.NUM_FEATURES
    assert catalog.q_check_weighted_forest(spark, str(tmp_path)).filter("known_class AND within_depth AND mass_one").count() == 18
    assert catalog.q_weighted_rf(spark, str(tmp_path)).count() == 1


def test_class_weights_move_no_rows(spark):
    """Rows of a class lie in many tasks, whatever the table's size: they are
    not dealt out by class. Beyond the limit the join is left to Spark."""
    docs = [(i, ["a", "a", "a", "b", None][i % 5], f"text {i}") for i in range(100)]
    df = spark.createDataFrame(docs, "doc_id long, label string, text string")
    want = [("a", 60, 1 - 60 / 100), ("b", 20, 1 - 20 / 100)]
    count = lambda w: rows(w.groupBy("label").agg(F.count("text"), F.first("weight")))
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for a table too large to be broadcast
    try:
        out = BA.with_class_weight(df, "label")
        assert out.columns == ["label", "doc_id", "text", "weight"] and count(out) == want
        plan = out._jdf.queryExecution().executedPlan().toString()  # before it runs, too
        assert "BroadcastHashJoin" in plan and "hashpartitioning(label" not in plan
        spark.conf.set("tessera.broadcast.maxRows", "1")
        assert count(BA.with_class_weight(df, "label")) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
        spark.conf.unset("tessera.broadcast.maxRows")
