"""Search by stored indexes: trigrams for texts, inverted lists for vectors,
sketches for distinct counts."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import balance as BA
from tessera.operators import common as C
from tessera.operators import ivf, search
from tessera.operators.audit import audit
from tessera.operators.vector import vector_topk

from conftest import rows

# ------------------------------------------------------------------- texts --


def test_what_a_pattern_must_contain():
    assert search.required_text("abcd") == ["abcd"]
    assert search.required_text(r"Abc\d+xyz(def)?gh") == ["abc", "xyz"]
    assert search.required_text(r"(abc)+de|xyz") == []
    assert search.required_text(r"(ab)cd[xy]efg") == ["abcd", "efg"]
    assert search.required_text(r"(abc){2,}?q") == ["abc"]
    for p in ("a", "ab?c", "abc|d", "(?i)abcd", r"\p{L}abc", r"\Qabc\E", "[a&&b]xyz", "(?:abc", "(abc"):
        assert search.required_text(p) in ([], ["abc"]) and (p == "(abc" or not search.required_text(p))
    assert search.required_grams("aBCab", literal=True) == ["abc", "bca", "cab"]
    assert search.required_grams("aß日本語", literal=True) == []


@pytest.fixture(scope="module")
def indexed(spark):
    rnd = random.Random(1)
    data = [(i, "".join(rnd.choice(["ab", "C", "x ", "İst", "ſ", "K", "12", "\n", "ß", "é", "D"]) for _ in range(rnd.randint(0, 9))))
            for i in range(400)]
    data += [(900, None), (901, ""), (902, "ab"), (903, "common abc " * 3000)]
    df = spark.createDataFrame(data, "id long, text string").withColumn("chapter", F.lit("A")).repartition(3)
    path = C.scratch_folder(spark, "tests/text-index")
    search.build_text_index(df, path)
    return df, path


@pytest.mark.parametrize("pattern,literal", [
    ("abcab", True), ("ABC", True), ("k12", True), ("ist", True), ("x\nab", True), ("éab", True), ("a", True),
    ("abc.*12", False), ("sab|k12", False), ("[sS]ab+c", False), ("ist1", False), ("(abx )+c", False), ("k1.?2", False),
    (r"x\s+ab", False), ("sss", False), ("zzz", False),
])
def test_search_equals_the_scan(indexed, pattern, literal):
    df, path = indexed
    got = search.search(df, path, pattern, literal)
    assert rows(got, "id") == rows(audit(df, text=pattern, literal=literal), "id")


def test_search_reads_the_folders_of_its_grams(spark, indexed):
    _, path = indexed
    plan = search.candidates(spark, path, ["abc"])._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*bucket", plan) and re.search(r"PushedFilters: \[[^]]*gram", plan)


# ----------------------------------------------------------------- vectors --

@pytest.fixture(scope="module")
def clusters(spark):
    rng = np.random.default_rng(2)
    centre = rng.normal(size=(12, 16)) * 4
    of = [0 if rng.random() < .4 else int(rng.integers(12)) for _ in range(1500)]  # one cluster is hot
    data = [(i, (centre[c] + rng.normal(size=16)).tolist()) for i, c in enumerate(of)]
    data += [(5000, None), (5001, []), (5002, [1.0, 2.0]), (5003, [0.0] * 16), (7, data[7][1])]
    return spark.createDataFrame(data, "vec_id long, embedding array<double>").repartition(4)


def test_probing_by_bounds_is_exact_and_prunes(spark, clusters):
    index = ivf.build_index(clusters, lists=24)
    asked = clusters.filter("vec_id % 20 = 0")
    found, probed = ivf.search(index, asked, k=5, exclude_self=True, first=2)
    whole = clusters.filter("size(embedding) = 16")
    want = vector_topk(whole, whole.filter("vec_id % 20 = 0"), 5, exclude_self=True)
    assert rows(found, "query_id", "rank", "item_id") == rows(want, "query_id", "rank", "item_id")
    assert index.rows.sum() == 1502
    share = probed.count() / (asked.count() * (index.rows > 0).sum())
    assert share < 0.6


def test_chosen_probes_reach_the_recall(spark, clusters):
    index = ivf.build_index(clusters, lists=24)
    n = ivf.probes_for(index, clusters.filter("vec_id < 1500"), 0.95, exclude_self=True)
    assert 1 <= n < 24
    asked = clusters.filter("vec_id % 10 = 0 AND vec_id < 1500")
    some, probed = ivf.search(index, asked, probes=n, exclude_self=True)
    every, _ = ivf.search(index, asked, exclude_self=True)
    hit = every.join(some, ["query_id", "item_id"], "left_semi").count()
    assert hit >= 0.9 * every.count()
    assert probed.count() == n * asked.count()


def test_index_of_nothing_and_of_one(spark, clusters):
    none = ivf.build_index(clusters.limit(0))
    assert ivf.search(none, clusters)[0].count() == 0
    one = ivf.build_index(clusters.filter("vec_id = 3"))
    got = ivf.search(one, clusters.filter("vec_id IN (3, 4)"), exclude_self=True)[0].collect()
    assert [(r["query_id"], r["item_id"]) for r in got] == [(4, 3)]


def test_sketches_merge_to_any_slice(spark):
    df = spark.createDataFrame([(i % 3, i % 7, i % 1000) for i in range(6000)] + [(1, 1, None)], "a int, b int, x int")
    stored = BA.distinct_sketches(df, ["a", "b"], "x")
    by_a = {r["a"]: r for r in BA.merged_distinct(stored, "a").collect()}
    for a in range(3):
        exact = len({i % 1000 for i in range(6000) if i % 3 == a})
        assert abs(by_a[a]["approx_distinct"] - exact) <= 0.065 * exact
    total = BA.merged_distinct(stored).first()
    assert total["n_rows"] == 6001 and abs(total["approx_distinct"] - 1000) <= 65
