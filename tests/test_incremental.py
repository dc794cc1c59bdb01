"""Naive Bayes by sufficient statistics, the stored corpus, exact thresholds,
splits by selection, running sums, digest joins and stream state."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tessera.operators import bayes as NB
from tessera.operators import common as C
from tessera.operators import metrics as ME
from tessera.operators import model as MO
from tessera.operators import split as SP
from tessera.operators import topk as TK
from tessera.operators import vector as VE
from tessera.operators.augment import build_prompts
from tessera.operators.corpus import SHORT, drop_incomplete, drop_shadowed, encode_labels, with_chapter
from tessera.operators.imbalance import best_thresholds
from tessera.operators.store import CorpusStore
from tessera.session import ensure_checkpoint_dir
from tessera.streaming import stream as ST

from conftest import rows

# ------------------------------------------------------------ naive Bayes --


def fitted(docs, smoothing):
    """Plain naive Bayes over (label, words) pairs: a function of words."""
    n, words = Counter(lab for lab, _ in docs), defaultdict(Counter)
    for lab, w in docs:
        words[lab].update(w)
    known = {w for c in words.values() for w in c}

    def predict(w):
        score = {}
        for lab in n:
            below = sum(words[lab].values()) + smoothing * len(known)
            score[lab] = math.log(n[lab] / len(docs)) + sum(
                math.log((words[lab][x] + smoothing) / below) for x in w if x in known)
        return min(score, key=lambda lab: (-round(score[lab], 9), lab))
    return predict


@pytest.fixture(scope="module")
def labelled():
    rnd = random.Random(1)
    bag = {"a": "ant ape art all", "b": "bee bat bog all", "c": "cat cow all all"}
    out = [(i, lab := rnd.choice("aaaabbc"), " ".join(rnd.choices(bag[lab].split() + ["x", "y"], k=rnd.randint(1, 9))),
            rnd.randrange(4)) for i in range(160)]
    return out + [(900, "a", None, 0), (901, "b", " ... ", 1), (902, "only", "Ünïq ÜNÏQ", 2)]


def words_of(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def test_folds_and_candidates_equal_refits(spark, labelled):
    df = spark.createDataFrame(labelled, "doc_id long, label string, text string, fold int").repartition(5)
    s = NB.statistics(df, 4)
    got = {(r["id"], r["smoothing"]): r["prediction"] for r in NB.predict(s, (0.1, 2.0)).collect()}
    assert len(got) == 2 * len(labelled)
    for a in (0.1, 2.0):
        for f in range(4):
            model = fitted([(lab, words_of(t)) for _, lab, t, g in labelled if g != f], a)
            for i, lab, t, g in labelled:
                if g == f:
                    assert got[i, a] == model(words_of(t)), (i, a)
    acc = NB.cross_validate_words(df, 4, (0.1, 2.0)).collect()
    assert len(acc) == 8 and sum(r["n_rows"] for r in acc) == 2 * len(labelled)


def test_no_rows_give_no_folds(spark):
    none = spark.createDataFrame([], "doc_id long, label string, text string, fold int")
    assert NB.cross_validate_words(none, 3).count() == 0
    empty = spark.createDataFrame([], "label int, text string, fold int")
    assert MO.cross_validate(empty).count() == 0


# ----------------------------------------------------------- stored corpus --

def store_of(spark, *batches):
    store = CorpusStore(spark, C.scratch_folder(spark, "tests/corpus-store"))
    for b in batches:
        store.append(spark.createDataFrame(b, "code string, text string, origin string"))
    return store


def full_build(spark, *batches):
    df = spark.createDataFrame([r for b in batches for r in b], "code string, text string, origin string")
    return encode_labels(drop_incomplete(with_chapter(drop_shadowed(df))))[0].select("code", "text", "origin", "chapter", "label")


BASE = [("A01", "alone", SHORT), ("A01", "long", "x"), ("B02", "pair", SHORT), ("B02", "pair", SHORT), ("C03", "kept", SHORT)]


@pytest.mark.parametrize("delta", [
    [("D04", "alone", "x")],                                     # 1 -> 2: an earlier short row leaves, its code stays
    [("D04", "kept", "x")],                                      # its code loses its last row, labels move up
    [("A00", "pair", SHORT)],                                    # 2 -> 3: nothing left to hide but the new row
    [("E05", "new", SHORT)],                                     # 0 -> 1: visible
    [("E05", "new", SHORT), ("E05", "new", "x")],                # 0 -> 2 inside a batch
    [("A01", None, SHORT), ("A01", None, "x"), (None, "t", "x"), ("A01", "", "x")],
    [],
])
def test_each_crossing_equals_the_full_build(spark, delta):
    assert rows(store_of(spark, BASE, delta).corpus()) == rows(full_build(spark, BASE, delta))


def test_many_batches_and_a_repeated_version(spark):
    rnd = random.Random(3)
    made = [[(f"{rnd.choice('ABCDEF')}{rnd.randint(10, 30)}", f"t{rnd.randint(0, 60)}", rnd.choice([SHORT, "x", "y"]))
             for _ in range(rnd.randint(0, 40))] for _ in range(6)]
    made[2] += [("A10", "hot", SHORT)] * 80
    store = store_of(spark, *made)
    assert store.version() == 5
    assert rows(store.corpus()) == rows(full_build(spark, *made))
    # a batch that was written but not committed is replaced
    store._write(store.table("rows", 1).drop("version"), "rows", 6, "short")
    store.append(spark.createDataFrame([("Z99", "last", "x")], "code string, text string, origin string"))
    assert rows(store.corpus()) == rows(full_build(spark, *made, [("Z99", "last", "x")]))


# ------------------------------------------- thresholds, splits, running sums --

def test_best_thresholds_hot_class_and_odd_scores(spark):
    rnd = random.Random(4)
    data = [(i, rnd.randint(0, 2), 0 if rnd.random() < .8 else rnd.randint(1, 2), rnd.choice([rnd.random(), .5, .25]))
            for i in range(700)]
    data += [(1000, 0, 0, None), (1001, 1, 0, float("nan")), (1002, 0, 1, None), (1003, 5, 5, None), (1004, None, 0, .5)]
    df = spark.createDataFrame(data, "id long, label int, class int, score double").repartition(6)
    got = {r["class"]: tuple(r)[1:] for r in best_thresholds(df).collect()}
    for c in {d[2] for d in data}:
        mine = [(s if s is not None and s == s else None, lab == c) for _, lab, k, s in data if k == c]
        best = None
        for t in sorted({s for s, _ in mine if s is not None}):
            tp, fp = sum(s is not None and s >= t and p for s, p in mine), sum(s is not None and s >= t and not p for s, p in mine)
            fn = sum(p for _, p in mine) - tp
            f1 = 2 * tp / (2 * tp + fp + fn) if 2 * tp + fp + fn else 0.0
            if best is None or f1 > best[1]:
                best = (t, f1, tp, fp, fn)
        assert got.get(c) == best


@pytest.mark.parametrize("partitions", [1, 7])
def test_running_sums_over_one_hot_group(spark, partitions):
    rnd = random.Random(5)
    data = [(rnd.choice(["hot", "hot", "hot", "b", None]), i, rnd.randint(-3, 9)) for i in range(500)]
    df = spark.createDataFrame(data, "g string, i long, x int").repartition(4)
    got = {(r["g"], r["i"]): r["run_x"] for r in C.running_sums(df, "g", [F.col("i")], ["x"], partitions).collect()}
    for g in ("hot", "b", None):
        total = 0
        for k, i, x in sorted((d for d in data if d[0] == g), key=lambda d: d[1]):
            total += x
            assert got[g, i] == total


def test_split_by_selection_moves_no_text(spark):
    import hashlib
    data = [(i, "hot" if i % 3 else f"c{i % 50}", "text " * 9) for i in range(3000)] + [(9000 + i, None, "t") for i in range(10)]
    df = spark.createDataFrame(data, "id long, label string, text string").repartition(5)
    out = SP.stratified_split(df, "label", "id")
    got = {r["id"]: r["split"] for r in out.collect()}
    classes = defaultdict(list)
    for i, lab, _ in data:
        classes[lab].append((hashlib.md5(f"{i}:42".encode()).hexdigest(), i))
    for members in classes.values():
        quota = int(0.2 * len(members) + 0.5)
        assert {i for _, i in sorted(members)[:quota]} == {i for _, i in members if got[i] == "test"}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan


# ------------------------------------------------------------- other joins --

def test_digest_join_of_a_hot_text(spark):
    corpus = [(i, "hot text" if i % 2 else f"t{i % 40}") for i in range(2000)] + [(5000, None), (5001, "absent")]
    pred = [("hot text", "p0"), ("hot text", "p1")] + [(f"t{i}", f"q{i}") for i in range(30)] + [(None, "never")]
    c = spark.createDataFrame(corpus, "id long, text string").repartition(4)
    p = spark.createDataFrame(pred, "input string, top string")
    first = {"hot text": "p0", **{f"t{i}": f"q{i}" for i in range(30)}}
    out = ME.merge_predictions(c, p)
    assert rows(out) == sorted((i, t, first[t]) for i, t in corpus if t in first)
    assert len(ME.merge_predictions(c, p, "left").collect()) == len(corpus)
    fan = ME.merge_predictions(c, p, dedupe_inputs=False)
    assert fan.count() == sum((2 if t == "hot text" else 1) for _, t in corpus if t in first)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"Join .*\(text#\d+ = _input", plan)


def test_prediction_labels_dense_and_sparse(spark):
    p = spark.createDataFrame([([(1, 2, .9), (2, 0, .1)],), ([(1, 7, .5)],)],
                              "prediction array<struct<rank:int,label:int,value:double>>")
    for dim in ([(0, "a", "A"), (1, "b", "B"), (2, "c", "C")], [(0, "a", "A"), (2, "c", "C"), (9, "z", "Z")]):
        labels = spark.createDataFrame(dim, "label int, code string, text string")
        got = [[(x["label"], x["code"]) for x in r["prediction"]] for r in TK.attach_prediction_labels(p, labels).collect()]
        assert sorted(got) == [[(2, "c"), (0, "a")], [(7, None)]]
        inner = TK.attach_prediction_labels(p, labels, how="inner").collect()
        assert sorted(len(r["prediction"]) for r in inner) == [0, 2]


def test_vectors_null_and_of_two_lengths(spark):
    data = [(1, [1.0, 0.0]), (2, [0.9, 0.1]), (3, None), (4, []), (5, [1.0, 0.0, 0.0]), (6, [0.0, 1.0, 0.0]), (7, [0.0, 1.0])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = VE.vector_topk(df, df, 2, exclude_self=True).collect()
    near = {(r["query_id"], r["rank"]): r["item_id"] for r in got}
    assert near == {(1, 1): 2, (1, 2): 7, (2, 1): 1, (2, 2): 7, (7, 1): 2, (7, 2): 1, (5, 1): 6, (6, 1): 5}
    lsh = VE.vector_topk_lsh(df, df, 2, num_tables=32, hashes=1, exclude_self=True).collect()
    assert {r["query_id"] for r in lsh} <= {1, 2, 5, 6, 7}


def test_prompts_of_codes_with_few_and_many_names(spark):
    data = [("A01", i, f"n{i:03d}", "i", "e", "c", "d") for i in range(10)] + [("B02", 50, "one", "", "", "", "")]
    df = spark.createDataFrame(data, "cod string, row_key long, nome string, incl string, excl string, crit string, icd10_description string")
    got = {(r["code"], r["part"]): r["prompt"] for r in build_prompts(df, names_per_prompt=4).collect()}
    assert set(got) == {("A01", 0), ("A01", 1), ("A01", 2), ("B02", 0)}
    assert got["A01", 2].startswith("n008; n009;") and got["B02", 0] == "one"
    whole = {(r["code"], r["part"]): r["prompt"] for r in build_prompts(df).collect()}
    assert set(whole) == {("A01", 0), ("B02", 0)} and whole["A01", 0].startswith("n000; n001; n002")


# ------------------------------------------------------------------ streams --

def test_exact_distinct_keeps_the_first_row_by_order(spark):
    path, folder = C.scratch_folder(spark, "tests/in"), C.scratch_folder(spark, "tests/job")
    schema = "code string, text string, at long"
    for part in ([("a", "x", 3), ("a", "x", 1), ("b", None, 9)], [("a", "x", 0), ("b", None, 2), ("c", "y", 5), ("c", "y", 4)]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
        s = ST.event_stream(spark, path, spark.createDataFrame([], schema).schema, 1)
        out = ST.append_distinct_exact(s, order="at", folder=folder)
    assert sorted(map(tuple, out.collect()), key=str) == sorted([("a", "x", 1), ("b", None, 9), ("c", "y", 4)], key=str)


def test_acceptance_is_compacted_and_goes_on(spark, monkeypatch):
    monkeypatch.setattr(ST, "COMPACT", 3)
    path, folder = C.scratch_folder(spark, "tests/in"), C.scratch_folder(spark, "tests/job")
    schema = "ts timestamp, ok boolean"
    rnd, data = random.Random(6), []
    for i in range(9):
        part = [(f"2024-01-{rnd.randint(1, 6):02d} 0{rnd.randint(0, 9)}:00:00", rnd.random() < .5) for _ in range(12)]
        data += part
        spark.createDataFrame(part, "t string, ok boolean").selectExpr("CAST(t AS TIMESTAMP) AS ts", "ok").coalesce(1).write.mode("append").parquet(path)
        if i in (3, 8):
            out = ST.run_acceptance(spark, path, spark.createDataFrame([], schema).schema, "ok", max_files=1, folder=folder)
    days = defaultdict(lambda: [0, 0])
    for t, ok in data:
        days[t[:10]][0] += 1
        days[t[:10]][1] += ok
    last = max(days)
    got = {str(r["window_start"])[:10]: [r["n_rows"], r["n_accepted"]] for r in out.collect()}
    assert got == {d: n for d, n in days.items() if d < last}
    assert len(ST._epochs(spark, f"{folder}/out")) <= 2 * 3 + 1


def test_scratch_block_owns_folders_of_its_own_thread(spark):
    import threading
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs.FileSystem.get(spark.sparkContext._jsc.hadoopConfiguration())
    there = lambda p: fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p))
    seen = {}

    def other():
        seen["other"] = C.scratch_folder(spark, "tests/other")
        spark.range(1).write.parquet(seen["other"])
    with C.scratch_tables(spark):
        seen["mine"] = C.scratch_folder(spark, "tests/mine")
        spark.range(1).write.parquet(seen["mine"])
        t = threading.Thread(target=other)
        t.start()
        t.join()
        assert there(seen["mine"])
    assert not there(seen["mine"]) and there(seen["other"])
    assert ensure_checkpoint_dir(spark) in seen["mine"] or seen["mine"].startswith(ensure_checkpoint_dir(spark))
